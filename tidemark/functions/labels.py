"""Label, class and identifier expressions. Every function returns a Column."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from tidemark import fixed_values as V


def lookup(key: Column, table: dict[str, str]) -> Column:
    """Exact lookup in a small fixed table; null when absent."""
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), key)


def first_match(rules: list[tuple[Column, Column]], default: Column | None = None) -> Column:
    """Ordered rules, the first true condition wins."""
    head, *rest = rules
    chain = reduce(lambda acc, rule: acc.when(*rule), rest, F.when(*head))
    return chain if default is None else chain.otherwise(default)


def title_words(text: Column) -> Column:
    return F.initcap(F.replace(text, F.lit("_"), F.lit(" ")))


def id_head(source_id: Column) -> Column:
    """First token of an id, lower case, dashes read as underscores."""
    return F.split_part(F.replace(F.lower(source_id), F.lit("-"), F.lit("_")), F.lit("_"), F.lit(1))


# --- segments and products --------------------------------------------------------

def canonical_segment(segment: Column) -> Column:
    return F.coalesce(lookup(segment, V.SEGMENT_ALIASES), segment)


def segment_spellings(segment: str) -> list[str]:
    """The canonical name with every stored alias: a pushable IN list."""
    target = V.SEGMENT_ALIASES.get(segment, segment)
    return [target] + [alias for alias, name in V.SEGMENT_ALIASES.items() if name == target]


def product_for(product: Column, segment: Column) -> Column:
    return F.coalesce(F.nullif(product, F.lit("")), lookup(segment, V.SEGMENT_TO_PRODUCT), segment)


def segment_label(segment: Column) -> Column:
    text = title_words(segment)
    for wrong, right in (("Sme", "SME"), ("Adi", "ADI"), ("Lgd", "LGD")):
        text = F.replace(text, F.lit(wrong), F.lit(right))
    return text


def cohort_label(cohort: Column) -> Column:
    return F.coalesce(lookup(cohort, V.COHORT_LABELS), title_words(cohort))


def parameter_label(parameter: Column) -> Column:
    return F.coalesce(lookup(parameter, V.PARAMETER_LABELS), title_words(parameter))


def rank_in(value: Column, order: tuple[str, ...]) -> Column:
    """Position in a fixed display order, 99 when unknown."""
    pos = F.array_position(F.array(*[F.lit(x) for x in order]), value)
    return F.when(pos > 0, (pos - 1).cast("int")).otherwise(F.lit(99))


# --- cohorts ------------------------------------------------------------------------

def is_big4(source_id: Column) -> Column:
    return id_head(source_id).isin(*V.BIG4)


def cohort_for(source_type: Column, source_id: Column) -> Column:
    head = id_head(source_id)
    pillar3 = source_type.isin("bank_pillar3", "pillar3")
    return first_match(
        [
            (F.upper(source_id).contains("APS113"), F.lit("regulatory_floor")),
            (pillar3 & head.isin(*V.BIG4), F.lit("peer_big4")),
            (pillar3 & head.isin(*V.MACQUARIE_HEADS), F.lit("peer_other_major_bank")),
            (pillar3, F.lit("peer_non_bank")),
            (source_type.isin("apra_performance", "apra_qpex", "apra_adi", "apra_non_adi",
                              "rba_aggregate", "rba"), F.lit("regulator_aggregate")),
            (source_type.isin("rating_agency_index", "rating_agency"), F.lit("rating_agency")),
            (source_type == "regulatory", F.lit("regulatory_floor")),
            (source_type.isin("non_bank_listed", "listed_peer"), F.lit("peer_non_bank")),
        ],
        F.lit("industry_body"),
    )


def is_direct_lgd(parameter: Column, definition_class: Column, source_id: Column) -> Column:
    sid = F.upper(source_id)
    return (parameter == "lgd") & (
        (definition_class == "regulatory_floor_lgd")
        | (sid.contains("LGD") & ~sid.rlike("ECL|IMPAIR|LOSS_RATE|REALISED_LOSS"))
    )


def anchor_label(source_type: Column, source_id: Column) -> Column:
    """Short source label of the anchor view."""
    head = F.split_part(source_id, F.lit("_"), F.lit(1))
    return first_match(
        [(source_type == "apra_performance", F.lit("APRA floor")), (head == "MACQUARIE", F.lit("MQG"))],
        head,
    )


def friendly_name(source_id: Column) -> Column:
    """Readable publisher name; an unknown id is returned as it is."""
    low, up = F.lower(source_id), F.upper(source_id)
    head = id_head(source_id)
    after = F.regexp_replace(up, "^.*?PILLAR3", "")
    bank = lookup(head, V.BANK_NAMES)
    hint = first_match(
        [
            (up.contains("RES_LGD"), F.lit(" (residential LGD)")),
            (after.contains("RES"), F.lit(" (residential PD)")),
            (after.contains("CRE"), F.lit(" (commercial property PD)")),
            (up.contains("CORP_SME"), F.lit(" (corporate SME PD)")),
            (up.contains("SME_UNSECURED"), F.lit(" (SME unsecured LGD)")),
        ],
        F.lit(""),
    )
    slotting = up.startswith("APS113_SLOTTING_")
    kind = F.when(up.endswith("_PD"), F.lit("PD")).otherwise(F.lit("LGD"))
    rules = [
        (source_id == "", F.lit("")),
        (low == "sp_spin_prime", F.lit("S&P SPIN (prime RMBS, 30+ DPD)")),
        (low == "sp_spin_non_conforming", F.lit("S&P SPIN (non-conforming RMBS, 30+ DPD)")),
        (up.contains("PILLAR3") & bank.isNotNull(), F.concat(bank, hint)),
        (low.isin(*V.BANK_NAMES), lookup(low, V.BANK_NAMES)),
    ]
    for token, label in V.SLOTTING_LABELS.items():
        rules.append((
            slotting & F.concat(F.lit("_"), up, F.lit("_")).contains(f"_{token}_"),
            F.concat(F.lit(f"APS 113 slotting (Strong / Good / Satisfactory / Weak): {label} "), kind),
        ))
    rules.append((slotting, F.lit("APS 113 slotting")))
    rules += [(up.endswith(suffix), F.lit(label)) for suffix, label in V.LGD_FLOOR_LABELS.items()]
    series = r"^APRA_(QPEX|PERF)_(ALL_ADIS|BANKS|MAJOR_BANKS)_(.+)$"
    rules.append((
        up.rlike(series),
        F.concat(
            F.when(F.regexp_extract(up, series, 1) == "QPEX", "APRA QPEX (").otherwise("APRA performance ("),
            lookup(F.regexp_extract(up, series, 2), V.APRA_POPULATIONS),
            F.when(up.endswith("NPL_RATIO"), ", NPL)")
            .when(up.endswith("NINETY_DPD_RATE"), ", 90+ DPD)").otherwise(")"),
        ),
    ))
    rules += [(up.startswith(p), F.lit(label)) for p, label in V.SOURCE_PREFIX_LABELS.items()]
    rules += [(up.contains(t), F.lit(label)) for t, label in V.SOURCE_TOKEN_LABELS.items()]
    non_bank = lookup(head, V.NON_BANK_NAMES)
    rules.append((non_bank.isNotNull(), non_bank))
    return first_match(rules, source_id)


# --- ingest: units, publishers, classes, ids -------------------------------------------

def normalize_value(raw_value: Column, raw_unit: Column, strict: bool = False) -> Column:
    """Published number -> engine unit. Unknown unit: error when strict, else null."""
    unit = F.lower(F.trim(raw_unit))
    rules = [
        (unit.isin(*[u for u, d in V.UNIT_DIVISORS.items() if d == divisor]), raw_value / F.lit(divisor))
        for divisor in (1.0, 100.0, 10000.0)
    ]
    bad = F.raise_error(F.concat(F.lit("unknown raw_unit: "), raw_unit)).cast("double")
    return first_match(rules, bad if strict else F.lit(None).cast("double"))


def map_source_type(publisher: Column) -> Column:
    """Exact publisher, else the first listed prefix; null when unknown."""
    prefix = first_match([(publisher.startswith(p), F.lit(t)) for p, t in V.PUBLISHER_SOURCE_TYPES.items()])
    return F.coalesce(lookup(publisher, V.PUBLISHER_SOURCE_TYPES), prefix)


def map_asset_class(raw_label: Column, override: dict[str, str] | None = None) -> Column:
    key = F.lower(F.trim(raw_label))
    slug = F.replace(key, F.lit(" "), F.lit("_"))
    base = F.coalesce(lookup(key, V.ASSET_CLASS_LABELS), slug)
    if not override:
        return base
    return F.coalesce(lookup(key, {k.lower(): v for k, v in override.items()}), base)


def infer_data_type(metric_hint: Column) -> Column:
    return lookup(F.lower(F.trim(metric_hint)), V.METRIC_DATA_TYPES)


def period_slug(date: Column) -> Column:
    return F.concat(F.year(date).cast("string"), F.lit("Q"), F.quarter(date).cast("string"))


def generate_source_id(publisher: Column, asset_class: Column, data_type: Column, value_date: Column,
                       metric_code: Column | None = None, period_code: Column | None = None) -> Column:
    slug = F.replace(F.replace(F.upper(publisher), F.lit(" "), F.lit("_")), F.lit("&"), F.lit("AND"))
    metric = F.lit(None).cast("string") if metric_code is None else F.nullif(
        F.replace(F.upper(metric_code), F.lit(" "), F.lit("_")), F.lit(""))
    period = period_slug(value_date) if period_code is None else F.coalesce(
        F.nullif(period_code, F.lit("")), period_slug(value_date))
    return F.concat_ws("_", slug, F.upper(asset_class), metric, F.upper(data_type), period)


def one_of(hint: Column, allowed: tuple[str, ...]) -> Column:
    """Normalised hint when it is an allowed code, else null."""
    key = F.lower(F.trim(hint))
    return F.when(key.isin(*allowed), key)


def quality_notes(indicators: Column) -> Column:
    pairs = F.transform(F.map_entries(indicators), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return F.coalesce(F.array_join(pairs, "; "), F.lit(""))


def default_note(source_type: Column, publisher: Column, asset_class: Column, data_type: Column,
                 value_date: Column, url: Column, source_id: Column) -> Column:
    """Methodology note for a seed entry that carries none."""
    book = F.replace(asset_class, F.lit("_"), F.lit(" "))
    metric, period = F.upper(data_type), value_date.cast("string")

    def text(pattern: str, *args: Column) -> Column:
        return F.format_string(pattern, *args)

    return first_match(
        [
            (source_type == "pillar3", text("%s Pillar 3 %s %s disclosure (%s); %s", publisher, book, metric, period, url)),
            (source_type == "regulatory", text("APRA APS 113 %s %s reference (%s); %s", book, metric, period, url)),
            (source_type == "rba", text("RBA aggregate %s %s reference (%s); %s", book, metric, period, url)),
            (source_type == "rating_agency", text("%s rating-agency %s %s reference (%s); %s", publisher, book, metric, period, url)),
            (source_type == "industry_body", text("%s industry aggregate for %s (%s); %s", publisher, book, period, url)),
            (source_type == "bureau", text("%s bureau reference for %s (%s); %s", publisher, book, period, url)),
            (source_type == "listed_peer", text("%s listed-peer disclosure for %s (%s); %s", publisher, book, period, url)),
        ],
        text("%s source note for %s (%s); %s", publisher, F.coalesce(F.nullif(source_id, F.lit("")), book), period, url),
    )


# --- registry bridge ----------------------------------------------------------------------

def definition_class(source_id: Column, data_type: Column) -> Column:
    """Benchmark id and type -> definition class; null means outside the contract."""
    sid = F.upper(source_id)
    return first_match([
        (sid.contains("COMMENTARY") & sid.rlike("QUALITAS|METRICS"), F.lit("qualitative_commentary")),
        (sid.contains("APS113") & (data_type.isin("lgd", "supervisory_value") | sid.contains("_LGD")),
         F.lit("regulatory_floor_lgd")),
        (sid.contains("APS113"), F.lit("regulatory_floor_pd")),
        (sid.contains("QPEX"), F.lit("impaired_loans_ratio")),
        (sid.contains("APRA_PERF"), F.lit("npl_ratio")),
        (sid.rlike("RBA_FSR|SECURITISATION") & sid.contains("30PLUS"), F.lit("arrears_30_plus_days")),
        (sid.rlike("RBA_FSR|SECURITISATION"), F.lit("arrears_90_plus_days")),
        (sid.rlike("SPIN|DINKUM|MOODYS_AU_RMBS"), F.lit("arrears_30_plus_days")),
        (sid.contains("LATROBE") & sid.contains("REALISED_LOSS"), F.lit("realised_loss_rate")),
        (data_type == "pd", F.lit("basel_pd_one_year")),
        (data_type == "lgd", F.lit("realised_loss_rate")),
        (data_type == "impaired_ratio", F.lit("impaired_loans_ratio")),
        (data_type == "default_rate", F.lit("arrears_90_plus_days")),
    ])


def parameter_of(definition: Column, data_type: Column) -> Column:
    return first_match([
        (definition.isin("regulatory_floor_lgd"), F.lit("lgd")),
        (definition.isin("regulatory_floor_pd", "basel_pd_one_year"), F.lit("pd")),
        (definition.startswith("arrears_"), F.lit("arrears")),
        (definition == "impaired_loans_ratio", F.lit("impaired")),
        (definition == "npl_ratio", F.lit("npl")),
        (definition == "loss_expense_rate", F.lit("loss_rate")),
        ((definition == "realised_loss_rate") & (data_type == "lgd"), F.lit("lgd")),
        (definition == "realised_loss_rate", F.lit("loss_rate")),
        (definition == "qualitative_commentary", F.lit("commentary")),
    ])


def bridged_source_type(legacy: Column, source_id: Column) -> Column:
    return first_match(
        [
            ((legacy == "pillar3") & id_head(source_id).isin(*V.LEGACY_PILLAR3_HEADS), F.lit("bank_pillar3")),
            (legacy == "pillar3", F.lit("non_bank_listed")),
        ],
        F.coalesce(lookup(legacy, V.LEGACY_SOURCE_TYPES), legacy),
    )


def period_token(source_id: Column) -> Column:
    """First id token that reads as a period (FY2025, 2024H2, 2024Q4), else ''."""
    tokens = F.split(F.replace(source_id, F.lit("-"), F.lit("_")), "_")
    hits = F.filter(tokens, lambda t: t.rlike(r"^FY|H[12]$|^[0-9]{4}.*[A-Za-z]"))
    return F.coalesce(F.get(hits, F.lit(0)), F.lit(""))


def reporting_basis(source_type: Column, source_id: Column, notes: Column) -> Column:
    note = F.trim(F.coalesce(notes, F.lit("")))
    token = period_token(source_id)
    suffix = F.when(token != "", F.concat(F.lit(", "), token)).otherwise(F.lit(""))
    stated = F.trim(F.regexp_replace(note, r"^[^:]*:", ""))
    return first_match(
        [
            (F.upper(note).startswith("BASIS:"),
             F.when(stated == "", F.lit("Source disclosure")).otherwise(stated)),
            (source_type == "pillar3", F.concat(F.lit("Pillar 3 disclosure"), suffix)),
            (source_type == "apra_adi", F.lit("APRA quarterly statistics")),
            (source_type == "rating_agency", F.lit("S&P SPIN monthly aggregate")),
            (source_type == "rba", F.lit("RBA FSR / SMP aggregate")),
            (source_type == "industry_body", F.lit("Industry-body aggregate")),
            (source_type == "regulatory", F.lit("APS 113 supervisory floor")),
            (source_type == "listed_peer", F.concat(F.lit("Listed-peer disclosure"), suffix)),
            (source_type == "bureau", F.lit("Bureau aggregate")),
        ],
        F.concat(source_type, F.lit(" disclosure")),
    )
