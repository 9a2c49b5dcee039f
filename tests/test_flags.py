"""Cross-source flags on literal peer sets."""

import datetime as dt

import pytest

from tidemark.operators import flags

RULES = flags.FlagRules(as_of=dt.date(2025, 3, 31))


def by_source(df, kind):
    return {r.source_id for r in df.collect() if r.flag_type == kind}


def test_spread_and_count(observe):
    obs = observe(*[{"source_id": s, "value": v} for s, v in (("cba", .02), ("nab", .025), ("wbc", .03))])
    row = flags.validation_flags(obs, RULES).first()
    assert (row.n_sources, row.n_distinct_sources) == (3, 3)
    assert row.spread_decimal == pytest.approx(.4) and row.big4_spread_decimal == pytest.approx(.4)
    assert row.peer_big4_vs_non_bank_ratio is None and row.n_outlier_sources == 0


def test_outlier_above_twice_the_median(observe):
    obs = observe(*[{"source_id": s, "value": v} for s, v in (("cba", .02), ("nab", .025), ("wbc", .03), ("anz", .09))])
    assert by_source(flags.validation_flag_sources(obs, RULES), "outlier") == {"anz"}


def test_floors_are_anchors_not_outliers(observe):
    peers = [{"source_id": s, "value": v} for s, v in (("cba", .02), ("nab", .021), ("wbc", .022), ("anz", .023))]
    floors = [{"source_id": f"APS113_SLOTTING_{g}_PD", "value": v, "source_type": "apra_performance"} for g, v in (("STRONG", .004), ("WEAK", .08))]
    obs = observe(*peers, *floors)
    assert by_source(flags.validation_flag_sources(obs, RULES), "outlier") == set()
    assert {r.source_id for r in flags.reference_anchors(obs).collect()} == {f["source_id"] for f in floors}


def test_peer_ratio_excludes_macquarie_and_regulator(observe):
    obs = observe(
        {"source_id": "cba", "value": .020}, {"source_id": "nab", "value": .024},
        {"source_id": "judo", "value": .060, "source_type": "non_bank_listed"}, {"source_id": "liberty", "value": .080, "source_type": "non_bank_listed"},
        {"source_id": "mqg", "value": .010}, {"source_id": "APRA_X", "value": .012, "source_type": "apra_performance"})
    assert flags.validation_flags(obs, RULES).first().peer_big4_vs_non_bank_ratio == pytest.approx(.07 / .022)
    assert {(r.source_id, r.cohort) for r in flags.reference_anchors(obs).collect()} == {
        ("mqg", "peer_other_major_bank"), ("APRA_X", "regulator_aggregate")}


def test_staleness_by_type_family_and_default(observe):
    def aged(source, kind, days):
        return {"source_id": source, "value": .01, "source_type": kind, "as_of_date": RULES.as_of - dt.timedelta(days=days)}

    obs = observe(aged("fresh", "bank_pillar3", 120), aged("old", "bank_pillar3", 121), aged("reg", "regulatory", 700),
                  aged("unknown", "insolvency", 211))
    assert by_source(flags.validation_flag_sources(obs, RULES), "stale") == {"old", "unknown"}


def test_quiet_pipeline_suppresses_stale_rows(observe):
    obs = observe({"source_id": "cba", "value": .01, "as_of_date": dt.date(2001, 1, 1)})
    row = flags.validation_flags(obs, flags.FlagRules(as_of=RULES.as_of, pipeline_quiet=True)).first()
    assert row.n_stale_sources == 0 and row.frozen_dataset_banner == flags.QUIET_BANNER


def test_commentary_counts_but_adds_no_arithmetic(observe):
    obs = observe({"source_id": "cba", "value": .02}, {"source_id": "qualitas", "value": None, "parameter": "commentary", "source_type": "non_bank_listed"})
    row = flags.validation_flags(obs, RULES).first()
    assert row.n_sources == 2 and row.spread_decimal == 0.0
