"""Registered queries: shape, plan and agreement with their oracle at the smallest scale."""

import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import TABLES, rows_of
from tidemark import session
from tidemark.functions import stats
from tidemark.operators import industry_tables, reporting

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="driver tables absent")

SAMPLE = ("expected_loss_inputs", "validation_flag_sources", "segment_trend", "refresh_actions", "pillar3_divergence", "inter_bank_exposure",
          "coverage_ratios", "cr6_rows", "line_metric_regex", "industry_table_right_peel", "qpex_npl_ratio", "html_listing_entries")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return c


def test_registry_is_consistent():
    assert set(oracle_sql()) <= set(queries()) and len(queries()) > 120


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", SAMPLE)
def test_matches_oracle(spark, con, name):
    df = queries()[name](spark, SMALL)
    plan = df._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # pages are folded tag by tag; everything else is built-in functions
    assert name == "html_listing_entries" or "Python" not in plan and "InArrow" not in plan
    rel = con.sql(oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(rel.columns, rel.fetchall())


@pytest.mark.parametrize("name, fact", [
    ("validation_flags", "lineitem"), ("validation_flag_sources", "lineitem"), ("headline_segment", "lineitem"), ("per_source_observations", "lineitem"),
    ("by_source_type", "lineitem"), ("inter_bank_exposure", "orders"), ("industry_table_right_peel", "orders"), ("bank_industry_rows", "customer"),
    ("html_listing_entries", "pages")])
def test_the_fact_is_read_once(spark, monkeypatch, name, fact):
    """Scans of the fact table in the query's plan and in the plans of the tables that it writes on the way."""
    plans = []

    def watched(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return session.staged(df, label)

    for module in (stats, reporting, industry_tables):
        monkeypatch.setattr(module, "staged", watched)
    plans.append(queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString())
    assert sum(p.count(f"/{fact}.parquet]") for p in plans) == 1


@pytest.mark.parametrize("name", [
    "industry_matrix", "dropped_rows", "cr6_rows_dirty", "line_metric_regex", "cr6_rows_split_percent", "ead_weighted_portfolio", "segment_metric_regex",
    "bank_industry_rows", "refused_matrix_pages", "index_headline", "cr6_rows", "judo_style_pd_bands", "first_occurrence_dedupe", "peer_lookaround",
    "impaired_table", "industry_table_right_peel", "disclosure_rows", "section_carry_forward", "section_blocks"])
def test_pages_are_dealt_out_by_rows_before_any_text_is_made(spark, monkeypatch, name):
    """The parse runs above a shuffle into as many partitions as the rows ask for; nothing of it is moved below."""
    plans = []

    def watched(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return session.staged(df, label)

    monkeypatch.setattr(industry_tables, "staged", watched)
    plans.append(queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString())
    dealt = 0
    for plan in plans:
        lines = plan.split("\n")
        for i, line in enumerate(lines):
            if "REPARTITION_BY_NUM" in line:
                dealt += 1
                below = next(n for n in lines[i + 1:] if "FileScan" not in n and n.strip()) if "FileScan" not in lines[i + 1] else ""
                assert "RLIKE" not in below and "concat_ws" not in below and "Generate" not in below
    assert dealt >= 1


@pytest.mark.parametrize("name", ["line_metric_regex", "segment_metric_regex", "first_occurrence_dedupe", "impaired_table", "disclosure_rows", "dropped_rows"])
def test_first_occurrence_stays_in_the_page(spark, name):
    plan = queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan


def test_partitions_follow_the_rows(spark):
    from tidemark.sources import testbed

    assert testbed.pages_table(spark, SMALL, "lineitem", ("l_orderkey",), 500).rdd.getNumPartitions() == -(-spark.read.parquet(f"{SMALL}/lineitem.parquet").count() // 500)


def test_observations_are_counted_by_a_hash_and_joined_before_text_is_made(spark, con, monkeypatch):
    """The rows are not sorted to find the newest of a source, and a shuffle to the parts moves no text made of them."""
    plans = []

    def watched(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return session.staged(df, label)

    monkeypatch.setattr(stats, "staged", watched)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = queries()["per_source_observations"](spark, SMALL)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(plans) == 1 and "HashAggregate" in plans[0] and "SortAggregate" not in plans[0]
    joined = plans[0].split("SortMergeJoin")[1]
    assert "MACQUARIE" not in joined and "disclosure.example" not in joined
    rel = con.sql(oracle_sql()["per_source_observations"])
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(rel.columns, rel.fetchall())


def test_newest_row_of_a_source_by_date_then_stored_segment_then_place(spark, observe):
    import datetime as dt

    rows = observe(
        {"source_id": "a", "value": .3, "obs_seq": 7, "segment": "commercial_property_investment", "reporting_basis": "x"},
        {"source_id": "a", "value": .2, "obs_seq": 9, "reporting_basis": "y"}, {"source_id": "a", "value": .1, "obs_seq": 8, "reporting_basis": "z"},
        {"source_id": "a", "value": .9, "obs_seq": -2**62, "as_of_date": dt.date(2024, 9, 30)},
        {"source_id": "a", "value": .8, "obs_seq": 2**62, "as_of_date": dt.date(2024, 9, 30)}, {"source_id": "b", "value": None})
    full = {r.source_id: (r.latest_value, r.reporting_basis, r.n_vintages, r.median_value) for r in reporting.per_source_observations(rows).collect()}
    assert full == {"a": (.1, "z", 5, .3), "b": (None, "b", 1, None)}
    bare = reporting.per_source_observations(rows, shown=())
    assert "reporting_basis" not in bare.columns
    assert {r.source_id: (r.latest_value, r.n_vintages, r.median_value) for r in bare.collect()} == {"a": (.1, 5, .3), "b": (None, 1, None)}


def test_stream_entries_are_written_and_read_by_many_tasks(spark, con, monkeypatch, tmp_path):
    """Six days are one batch of many files, and the result is that of the one order of arrival."""
    from tidemark.plans import source_queries

    monkeypatch.setattr(source_queries, "work_folder", lambda spark, name: f"{tmp_path}/{name}")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so that few rows are not joined into one file
    try:
        df = queries()["refresh_stream"](spark, SMALL)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = spark.read.parquet(f"{tmp_path}/refresh/entries").inputFiles()
    assert len(files) >= 15
    assert [r.batch_id for r in spark.read.parquet(f"{tmp_path}/refresh/actions").select("batch_id").distinct().orderBy("batch_id").collect()] == [0, 1, 2, 3, 4]
    rel = con.sql(oracle_sql()["refresh_stream"])
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(rel.columns, rel.fetchall())
