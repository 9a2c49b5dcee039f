"""Report tables over the observation store. Tables only, no rendering."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from tidemark import fixed_values as V
from tidemark.functions import labels as L, text as X
from tidemark.functions.stats import exact_median, median_of_counts, value_counts
from tidemark.operators.flags import FlagRules, flagged_sources, segment_flags, source_counts, with_cohort
from tidemark.operators.latest import read_side
from tidemark.session import staged
from tidemark.sources.tables import dimension

PARAMETER_ORDER = V.PARAMETERS


def _newest() -> Column:
    return F.struct(-F.unix_date("as_of_date"), F.col("stored_segment"), F.col("obs_seq"))


def _newest_seq() -> Column:
    """The newest date and in it the lowest ``obs_seq`` as one number, which a hash aggregate can keep the least of.

    A step of 2e19 a day is wider than all that a long can hold. A missing date is the oldest.
    """
    day = F.coalesce(F.unix_date("as_of_date"), F.lit(-2**31)).cast("decimal(10,0)")
    seq = F.coalesce(F.col("obs_seq"), F.lit(-2**63)).cast("decimal(19,0)")
    return seq - day * F.lit(Decimal(2 * 10**19))


#: What a source's newest row is shown with.
SHOWN = ("reporting_basis", "methodology_note", "page_or_table_ref", "source_url")


def per_source_observations(observations: DataFrame, shown: Sequence[str] = SHOWN) -> DataFrame:
    """Latest value, vintage median and count per (parameter, segment, source).

    ``shown`` names the columns of the newest row that are carried along. Without any, the rows are counted
    by a hash aggregate over numbers only, which sorts nothing.
    """
    keys = ["source_id", "segment", "parameter"]  # the most telling first, which decides most comparisons of a sort
    row = [F.min_by(F.struct(*shown), "_at").alias("row")] if shown else []
    counts = value_counts(read_side(observations).withColumn("_at", _newest_seq()), [*keys, "stored_segment", "source_type"], "value",
                          F.min("_at").alias("at"), F.max("as_of_date").alias("as_of"), *row)
    newest = F.struct(F.col("as_of").isNull(), -F.unix_date("as_of"), F.col("stored_segment"), F.col("at"))
    latest = F.min_by(F.struct(F.col("value").alias("latest_value"), "source_type", *(["row"] if shown else [])), newest)
    out = median_of_counts(counts, keys, "value", "median_value", also=(
        latest.alias("l"), F.max("as_of").alias("latest_as_of"), F.sum("_c").alias("n_vintages")))
    out = out.select("parameter", "segment", "source_id", "l.latest_value", "l.source_type", *[f"l.row.{c}" for c in shown],
                     "latest_as_of", "n_vintages", "median_value")
    return out.withColumn(
        "cohort", L.cohort_for(F.col("source_type"), F.col("source_id"))).withColumns({
            "friendly_name": L.friendly_name(F.col("source_id")), "cohort_label": L.cohort_label(F.col("cohort")),
            "cohort_rank": L.rank_in(F.col("cohort"), V.COHORT_ORDER),
            "parameter_rank": L.rank_in(F.col("parameter"), PARAMETER_ORDER)})


def cohort_medians(per_source: DataFrame) -> DataFrame:
    """Median of latest values per (parameter, segment, cohort)."""
    out = exact_median(per_source, ["parameter", "segment", "cohort"], "latest_value", "median").drop("min", "max")
    return out.withColumn("cohort_label", L.cohort_label(F.col("cohort")))


def segments_missing_metric(observations: DataFrame) -> DataFrame:
    """(parameter, segment) pairs without data, over the published parameters.

    The pairs come from exploding the fixed parameter list per segment.
    """
    present = read_side(observations).select("segment", "parameter").distinct()
    every = F.array(*[F.lit(p) for p in V.PARAMETERS])
    pairs = present.groupBy("segment").agg(F.count(F.lit(1)).alias("_n")).select("segment", F.explode(every).alias("parameter"))
    return pairs.join(present, ["segment", "parameter"], "left_anti").withColumn("segment_label", L.segment_label(F.col("segment")))


def pd_overview(observations: DataFrame) -> DataFrame:
    """Per segment: peer PD medians and counts, and the other metrics published."""
    rows = with_cohort(observations)
    side = F.when((F.col("parameter") == "pd") & F.col("cohort").isin(*V.PEER_COHORTS), F.col("cohort"))
    med = exact_median(rows.withColumn("side", side).where(F.col("side").isNotNull()), ["segment", "side"], "value")

    def part(cohort: str, column: str) -> Column:
        return F.max(F.when(F.col("side") == cohort, F.col(column)))

    peers = med.groupBy("segment").agg(
        F.round(part("peer_big4", "median"), 8).alias("big4_median_pd"), part("peer_big4", "n").alias("big4_count"),
        F.round(part("peer_non_bank", "median"), 8).alias("nonbank_median_pd"), part("peer_non_bank", "n").alias("nonbank_count"))
    # the parameter list of a segment holds at most the seven parameters
    others = rows.groupBy("segment").agg(
        F.array_sort(F.collect_set(F.when(F.col("parameter") != "pd", F.col("parameter")))).alias("others"))
    return others.join(peers, "segment", "left").select(
        "segment", L.segment_label(F.col("segment")).alias("segment_label"), "big4_median_pd",
        F.coalesce("big4_count", F.lit(0)).alias("big4_count"), "nonbank_median_pd",
        F.coalesce("nonbank_count", F.lit(0)).alias("nonbank_count"),
        F.transform("others", L.parameter_label).alias("other_metrics"))


def big4_vs_nonbank(observations: DataFrame) -> DataFrame:
    """Medians over all parameters per segment, with their ratio."""
    rows = with_cohort(observations).where(F.col("cohort").isin(*V.PEER_COHORTS))
    med = exact_median(rows, ["segment", "cohort"], "value")

    def part(cohort: str, column: str) -> Column:
        return F.max(F.when(F.col("cohort") == cohort, F.col(column)))

    big4, non = part("peer_big4", "median"), part("peer_non_bank", "median")
    return med.groupBy("segment").agg(
        F.round(big4, 8).alias("big4_median"), F.round(non, 8).alias("nonbank_median"),
        F.round(F.when(big4 > 0, F.try_divide(non, big4)), 8).alias("ratio"),
        F.coalesce(part("peer_big4", "n"), F.lit(0)).alias("big4_count"),
        F.coalesce(part("peer_non_bank", "n"), F.lit(0)).alias("nonbank_count"))


def report_meta(observations: DataFrame) -> DataFrame:
    """Rows, segments, sources and date window of the store.

    Distinct counts come from one grouped pass over (segment, source).
    """
    pairs = read_side(observations).groupBy("segment", "source_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("as_of_date").alias("lo"), F.max("as_of_date").alias("hi"))
    sources = pairs.groupBy("source_id").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    per_source = sources.select("n", "lo", "hi", F.lit(1).alias("is_source"), F.lit(0).alias("is_segment"))
    segments = pairs.select("segment").distinct().select(
        F.lit(0).cast("long").alias("n"), F.lit(None).cast("date").alias("lo"), F.lit(None).cast("date").alias("hi"),
        F.lit(0).alias("is_source"), F.lit(1).alias("is_segment"))
    return per_source.unionByName(segments).agg(
        F.sum("n").alias("n_observations"), F.sum("is_segment").alias("n_segments"), F.sum("is_source").alias("n_sources"),
        F.min("lo").alias("data_as_of_min"), F.max("hi").alias("data_as_of_max"))


def executive_counts(observations: DataFrame) -> DataFrame:
    """Distinct sources per cohort group; a source keeps its first-seen type."""
    first = F.struct(F.col("stored_segment"), F.col("source_id"), -F.unix_date("as_of_date"), F.col("obs_seq"))
    types = read_side(observations).groupBy("source_id").agg(F.min_by("source_type", first).alias("source_type"))
    cohort = L.cohort_for(F.col("source_type"), F.col("source_id"))
    group = L.first_match(
        [(cohort == "peer_big4", F.lit("big4")), (cohort == "peer_non_bank", F.lit("non_bank")),
         (cohort == "peer_other_major_bank", F.lit("other_major"))], F.lit("reference"))
    return types.select(group.alias("cohort_group")).groupBy("cohort_group").agg(F.count(F.lit(1)).alias("n_sources"))


def headline_segment(observations: DataFrame, rules: FlagRules) -> DataFrame:
    """Headline pick with its Big-4 value range, coverage gaps and first outliers.

    Commercial property leads when present, else the segment with most rows.
    """
    counts = source_counts(observations, rules)
    sources = staged(flagged_sources(counts, rules), "sources")
    flags = segment_flags(sources, rules)
    # the segment list is the fixed canonical vocabulary, so these lists stay short
    lead = F.struct((F.col("segment") == "commercial_property").alias("c"), F.col("n_sources"), F.col("segment"))
    thin = F.array_sort(F.collect_set(F.when(F.col("n_sources") < 2, F.col("segment"))))
    pick = flags.agg(F.max_by("segment", lead).alias("segment"), F.array_join(thin, ", ").alias("thin_segments"), F.size(thin).cast("long").alias("n_thin"),
                     F.min(F.when(F.col("n_outlier_sources") > 0, F.col("segment"))).alias("outlier_segment"))
    big4 = counts.where(L.is_big4(F.col("source_id")) & F.col("value").isNotNull()).groupBy("segment", "value").agg(F.sum("_c").alias("_c"))
    spread = median_of_counts(big4, ["segment"], "value", "big4_median").select(
        "segment", F.col("min").alias("big4_low"), F.col("max").alias("big4_high"), "big4_median", F.col("n").alias("n_disclosures"))
    marked = sources.where("outlier").select(
        F.col("segment").alias("outlier_segment"), "source_id")
    ranked = marked.withColumn("_r", F.row_number().over(W.partitionBy("outlier_segment").orderBy("source_id"))).where("_r <= 3")
    firsts = ranked.groupBy("outlier_segment").agg(F.array_join(F.array_sort(F.collect_list("source_id")), ", ").alias("first_outliers"))
    # the first three names, as published, beside the number of all
    names = firsts.join(marked.groupBy("outlier_segment").agg(F.count("*").alias("n_outliers")), "outlier_segment")
    return (
        pick.join(spread, "segment", "left").join(names, "outlier_segment", "left")
        .select("segment", "big4_low", "big4_high", F.round("big4_median", 8).alias("big4_median"), "n_disclosures",
                "thin_segments", "n_thin", "outlier_segment", "first_outliers", F.coalesce("n_outliers", F.lit(0).cast("long")).alias("n_outliers")))


def provenance(observations: DataFrame) -> DataFrame:
    """First-seen type, basis and address of every source."""
    first = F.struct(F.col("segment"), F.col("stored_segment"), -F.unix_date("as_of_date"), F.col("obs_seq"))
    return read_side(observations).groupBy("source_id").agg(
        F.min_by(F.struct("source_type", "reporting_basis", "source_url"), first).alias("row")).select("source_id", "row.*")


def bank_avg_pd_lgd(observations: DataFrame) -> DataFrame:
    """Mean PD and LGD per segment over bank cohorts, both present."""
    rows = with_cohort(observations).where(F.col("cohort").isin("peer_big4", "peer_other_major_bank"))

    def mean(parameter: str) -> Column:
        exact = F.col("value").cast("decimal(18,8)")
        return F.round(F.avg(F.when(F.col("parameter") == parameter, exact)).cast("double"), 8).alias(parameter)

    return rows.where(F.col("parameter").isin("pd", "lgd")).groupBy("segment").agg(mean("pd"), mean("lgd")).dropna().orderBy("pd")


def nonbank_latest_rates(observations: DataFrame) -> DataFrame:
    """Newest non-bank rate per (lender, segment, class)."""
    rows = with_cohort(observations).where(
        (F.col("cohort") == "peer_non_bank") & F.col("value").isNotNull() & F.col("parameter").isin("arrears", "impaired", "lgd"))
    return rows.withColumn("lender", F.split_part("source_id", F.lit("_"), F.lit(1))).groupBy(
        "lender", "segment", "data_definition_class").agg(
        F.min_by("value", _newest()).alias("value"), F.max("as_of_date").alias("as_of_date"))


def anchor_view(inputs: DataFrame, rate: str) -> DataFrame:
    """Every source of a segment beside the segment median, where two or more disclose."""
    med = exact_median(inputs, ["segment"], rate, "segment_median").where("n >= 2").select("segment", "segment_median")
    return inputs.join(med, "segment").select(
        "segment", "source_id", L.anchor_label(F.col("source_type"), F.col("source_id")).alias("label"), rate,
        F.round("segment_median", 8).alias("segment_median"), (F.col("source_type") == "apra_performance").alias("is_floor"))


def segment_glossary(observations: DataFrame, glossary: DataFrame) -> DataFrame:
    """Definition of every segment that has data."""
    segments = read_side(observations).select("segment").distinct()
    return segments.join(F.broadcast(glossary), "segment", "left").select(
        "segment", F.coalesce("definition", F.lit(V.GLOSSARY_DEFAULT)).alias("definition"))


def band_references(spark: SparkSession) -> DataFrame:
    """(product or reference, source) pairs the reality-check bands rest on."""
    rows = [(p, s) for p, (_, _, up, low) in V.REALITY_CHECK_BANDS.items() for s in (*up, *low)]
    rows += list(V.BAND_REFERENCE_SOURCES.items())
    return dimension(spark, sorted(set(rows)), "used_by string, source_id string")


def band_source_check(references: DataFrame, observations: DataFrame) -> DataFrame:
    """Band sources that the store does not hold."""
    return references.join(observations.select("source_id"), "source_id", "left_anti")


def bands_export(bands: DataFrame) -> DataFrame:
    """The published columns in their order; a rationale of many lines becomes one, with its line ends written out."""
    flat = F.replace(F.trim(F.regexp_replace("rationale", r"^\s+|\s+$", "")), F.lit("\n"), F.lit("\\n"))
    return bands.select(
        "product", *(F.format_string("%.6f", c).alias(c) for c in ("lower_band_pd", "upper_band_pd")),
        *(F.array_join(c, "|").alias(c) for c in ("lower_sources", "upper_sources")), flat.alias("rationale"), "last_review_date", "next_review_due")


def bands_with_gaps(bands: DataFrame, observations: DataFrame) -> DataFrame:
    """Band export beside the number of its sources the store does not hold."""
    used = bands.select(F.col("product").alias("used_by"), F.explode(F.array_distinct(F.concat("upper_sources", "lower_sources"))).alias("source_id"))
    gaps = band_source_check(used, observations).groupBy(F.col("used_by").alias("product")).agg(F.count(F.lit(1)).alias("n_missing_sources"))
    return bands_export(bands).join(gaps, "product", "left").withColumn("n_missing_sources", F.coalesce("n_missing_sources", F.lit(0)))


def report_headline(meta: DataFrame, wide: DataFrame) -> DataFrame:
    """Headline counts beside the distinct banks of the industry view."""
    # the bank list is bounded by the industry label map
    banks = wide.agg(F.array_join(F.array_sort(F.collect_set("bank")), ", ").alias("banks"), F.count(F.lit(1)).alias("n_industry_rows"))
    both = meta.unionByName(banks, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


def newest_publications(links: DataFrame, limit: int = 3) -> DataFrame:
    """Top items per source by (date, title); the window keeps only ``limit`` rows per task."""
    order = W.partitionBy("source_key").orderBy(F.desc("published_date"), F.desc("title"), F.desc("url"))
    return links.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit)


def peer_table(observations: DataFrame) -> DataFrame:
    """Medians of the two peer groups per segment as they are printed: percentages, their ratio and signed gap, the gap in basis points."""
    rows = big4_vs_nonbank(observations)
    gap = F.col("nonbank_median") - F.col("big4_median")
    return rows.select(
        "segment", X.percent_places(F.col("big4_median")).alias("big4"), X.percent_places(F.col("nonbank_median")).alias("non_bank"),
        X.times(F.col("ratio")).alias("ratio"), X.percent_places(gap, 2, signed=True).alias("gap"), X.basis_points(gap).alias("gap_bps"))


def data_window(meta: DataFrame) -> DataFrame:
    """The printed date window of the store."""
    return meta.select(X.date_window(F.col("data_as_of_min"), F.col("data_as_of_max")).alias("data_as_of"))
