"""Two-verdict parsing: what a parser drops is kept with its reason, and split only where it is written."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import bands, checks, disclosures
from tidemark.plans import exports

CR6 = "CR6: IRB - credit risk\nResidential mortgage 0.00 to <0.15 1 2 3 4 0.50 6 150.0\nSME Retail\n0.15 to <0.25 1 2 3 4 - 6 20.0\n"
UPDATE = "Trading update for the quarter ended 31 March 2025\nAnnualised net losses of 116 bps\nAnnualised net losses of 350%\nAnnualised net losses of 350%\nAnnualised net losses of 116 bps"


def test_every_band_cell_has_a_verdict(pages):
    rows = bands.band_verdicts(pages(CR6, "CR6: IRB - x\nLeases 0.00 to <0.15 1 2 3 4 0.50 6 20.0"))
    got = sorted((r.doc_id, r.asset_class or "", r.metric_name, r.value, r.dropped) for r in rows.collect())
    assert [(g[0], g[1], g[2], g[4]) for g in got] == [
        ("d1", "residential_mortgage", "lgd", "out_of_range"), ("d1", "residential_mortgage", "pd", None), ("d1", "retail_sme", "lgd", None),
        ("d1", "retail_sme", "pd", "no_value"), ("d2", "", "lgd", "no_portfolio"), ("d2", "", "pd", "no_portfolio")]
    kept = bands.band_rows(pages(CR6))
    assert "dropped" not in kept.columns and kept.count() == 2 and checks.quarantined(rows).count() == 4


def test_repeats_merge_only_among_accepted_rows(pages):
    rows = disclosures.update_verdicts(pages(UPDATE), F.lit(None).cast("date"))
    assert sorted((round(r.value, 4), r.dropped) for r in rows.collect()) == [(0.0116, None), (3.5, "out_of_range"), (3.5, "out_of_range")]


def test_sink_splits_in_one_pass_and_rules_join_the_reasons(pages, tmp_path):
    rows = disclosures.update_verdicts(pages(UPDATE), F.lit(None).cast("date"))
    shaped = disclosures.disclosure_observations(rows, "plenti", "Quarterly update", "https://x.example", F.lit("net losses"), "p1")
    bad = shaped.withColumn("sample_size_n", F.when(F.col("dropped").isNull(), -1))
    checked = checks.observation_verdicts(bad, schemas.PARSED_OBSERVATION, "plenti")
    assert checked.columns == [*schemas.PARSED_OBSERVATION.fieldNames(), "dropped"]
    assert sorted(r.dropped for r in checked.collect()) == ["negative_sample_size", "out_of_range", "out_of_range"]
    exports.write_verdicts(checks.observation_verdicts(shaped, schemas.PARSED_OBSERVATION, "plenti"), f"{tmp_path}/v")
    written = bad.sparkSession.read.parquet(f"{tmp_path}/v")
    counts = {r.verdict: r["count"] for r in written.groupBy("verdict").count().collect()}
    assert counts == {"accepted": 1, "quarantine": 2}
    assert written.where("verdict = 'accepted'").first().as_of_date == dt.date(2025, 3, 31)


def test_adapter_contract_is_refused_before_any_work(spark):
    with pytest.raises(checks.RefusedError, match="segment"):
        checks.conform(spark.createDataFrame([("a",)], "source_id string"), schemas.PARSED_OBSERVATION, "adapter")
