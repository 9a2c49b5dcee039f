"""Versions, refresh policy, bridge, validation, writes and streams."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import checks, governance, latest, registry
from tidemark.sources import tables
from tidemark.streaming import refresh

D = dt.date


def bench(spark, *rows):
    out = []
    for r in rows:
        base = {"version": 1, "publisher": "CBA", "source_type": "pillar3", "data_type": "pd", "asset_class": "corporate_sme", "geography": "AU", "url": "u",
                "notes": "", "value": .02, "value_date": D(2024, 12, 31), "period_years": 1, "condition": None, "component": None,
                "retrieval_date": D(2025, 1, 10), "quality_score": "HIGH", "superseded_by": None, "inserted_at": dt.datetime(2025, 1, 1), **r}
        out.append(tuple(base[f] for f in schemas.BENCHMARKS.fieldNames()))
    return spark.createDataFrame(out, schemas.BENCHMARKS)


def sequential_actions(stored, entries):
    state, out = dict(stored), []
    for source, date, value in entries:
        if source not in state:
            action = "add"
        elif state[source][0] > date:
            action = "skip_newer_in_registry"
        elif state[source] == (date, value):
            action = "skip_unchanged"
        else:
            action = "supersede"
        if action in ("add", "supersede"):
            state[source] = (date, value)
        out.append(action)
    return out


def test_refresh_actions_equal_one_by_one_application(spark):
    rnd = random.Random(11)
    stored = {"a": (D(2024, 6, 30), .02), "hot": (D(2024, 3, 31), .01)}
    entries = [(rnd.choice(["a", "hot", "hot", "new", "b"]), D(2024, rnd.choice([3, 6, 9]), 30), rnd.choice([.01, .02])) for _ in range(300)]
    reg = bench(spark, *[{"source_id": s, "value_date": d, "value": v} for s, (d, v) in stored.items()])
    inc = spark.createDataFrame([(s, d, v, i) for i, (s, d, v) in enumerate(entries)], "source_id string, value_date date, value double, t long")
    got = {r.t: r.action for r in registry.refresh_actions(inc, reg, [F.col("t")], F.floor(F.col("t") / 20)).collect()}
    assert [got[i] for i in range(len(entries))] == sequential_actions(stored, entries)


def test_versions_continue_and_point_on(spark):
    prior = bench(spark, {"source_id": "a", "version": 4})
    arrivals = bench(spark, *[{"source_id": "a", "value": v, "inserted_at": dt.datetime(2025, 1, d)} for v, d in ((.1, 2), (.2, 3))], {"source_id": "b"})
    out = {(r.source_id, r.version): r.superseded_by for r in latest.assign_versions(
        arrivals, [F.col("inserted_at")], F.to_date("inserted_at"), prior).collect()}
    assert out == {("a", 5): "a", ("a", 6): None, ("b", 1): None}


def test_bridge_is_idempotent(spark):
    table = bench(spark, {"source_id": "CBA_PILLAR3_X_2024H2"}, {"source_id": "Q_RECOVERY", "data_type": "recovery_rate"},
                  {"source_id": "METRICS_COMMENTARY", "value": 0.0, "source_type": "listed_peer"})
    empty = bench(spark).select("source_id", F.col("asset_class").alias("segment"), F.col("data_type").alias("parameter"), F.col("value_date").alias("as_of_date"))
    first = registry.bridge_to_observations(table, empty)
    rows = {r.source_id: r for r in first.collect()}
    assert set(rows) == {"CBA_PILLAR3_X_2024H2", "METRICS_COMMENTARY"}
    assert rows["CBA_PILLAR3_X_2024H2"].reporting_basis == "Pillar 3 disclosure, 2024H2"
    assert rows["METRICS_COMMENTARY"].value is None and rows["METRICS_COMMENTARY"].parameter == "commentary"
    assert registry.bridge_to_observations(table, first).count() == 0


def test_observation_rules_split_and_strict(observe):
    obs = observe({"source_id": "ok", "value": .1}, {"source_id": "range", "value": 1.2}, {"source_id": "null", "value": None},
                  {"source_id": "class", "value": .1, "data_definition_class": "npl_ratio"},
                  {"source_id": "note", "value": .1, "methodology_note": "Migrated from old"},
                  {"source_id": "talk", "value": .1, "parameter": "commentary"},
                  {"source_id": "order", "value": .1, "period_start": D(2025, 1, 2), "period_end": D(2025, 1, 1)})
    good, bad = checks.split(checks.check_observations(obs))
    assert [r.source_id for r in good.collect()] == ["ok"]
    assert {r.source_id: r.errors for r in bad.collect()} == {
        "range": ["value_out_of_range"], "null": ["value_missing"], "class": ["definition_not_legal"], "note": ["placeholder_note"],
        "talk": ["commentary_has_value"], "order": ["period_order"]}
    with pytest.raises(Exception, match="value_out_of_range"):
        checks.strict(checks.check_observations(obs.where("source_id = 'range'"))).collect()
    assert checks.strict(checks.check_observations(obs.where("source_id = 'ok'"))).count() == 1


def test_benchmark_component_gate(spark):
    rows = bench(spark, {"source_id": "gate", "component": "haircut"}, {"source_id": "late", "retrieval_date": D(2024, 1, 1)},
                 {"source_id": "neg", "data_type": "lgd", "component": "time_to_recovery", "value": -1.0},
                 {"source_id": "months", "data_type": "lgd", "component": "time_to_recovery", "value": 18.0})
    got = {r.source_id: r.errors for r in checks.check_benchmarks(rows).collect()}
    assert got == {"gate": ["component_not_allowed"], "late": ["value_after_retrieval"], "neg": ["component_not_positive"], "months": []}


def test_divergence_zero_value_is_infinite_and_small_cohorts_skip(spark):
    rows = bench(spark, *[{"source_id": s, "value": v, "publisher": s} for s, v in (("a", .02), ("b", .02), ("c", .0), ("d", .07))],
                 {"source_id": "e", "asset_class": "sovereign"})
    got = {r.source_id: r for r in governance.pillar3_divergence(rows).collect()}
    assert got["c"].divergence_ratio == float("inf") and got["c"].breached and got["d"].breached and not got["a"].breached
    assert got[None].status == "skipped_incomplete_cohort"


def test_quality_and_staleness_defaults(spark):
    rows = bench(spark, {"source_id": "x", "source_type": "industry_body"}, {"source_id": "y", "source_type": "bank_pillar3", "retrieval_date": D(2024, 1, 1), "value_date": D(2023, 12, 31)})
    assert {r.source_id: r.low_dimensions for r in governance.quality_assessment(rows, tables.quality_matrix(spark)).collect()} == {"x": "regulatory_standing", "y": ""}
    assert {r.source_id: (r.threshold_days, r.stale) for r in governance.stale_benchmarks(rows, D(2025, 1, 11)).collect()} == {"x": (210, False), "y": (365, True)}


def test_both_sides_is_an_error(observe):
    with pytest.raises(ValueError):
        registry.by_source_type(observe({"source_id": "a", "value": .1}), big4_only=True, non_big4_only=True)


def test_append_is_additive_and_audited(spark, observe, tmp_path):
    obs = observe({"source_id": "a", "value": .1}, {"source_id": "b", "value": .2, "parameter": "npl"})
    for _ in range(2):
        registry.append_observations(obs, str(tmp_path / "obs"))
        registry.audit_append(spark, str(tmp_path / "audit"), [("append", None, {"rows": 2}, "2")], dt.datetime(2025, 1, 1))
    assert spark.read.parquet(str(tmp_path / "obs")).count() == 4
    assert spark.read.schema(schemas.AUDIT_LOG).parquet(str(tmp_path / "audit")).count() == 2


def test_refresh_stream_continues_versions_and_replays_cleanly(spark, tmp_path):
    base = str(tmp_path)
    first = bench(spark, {"source_id": "a", "value": .1, "inserted_at": dt.datetime(2025, 1, 1)})
    second = bench(spark, {"source_id": "a", "value": .2, "inserted_at": dt.datetime(2025, 2, 1)}, {"source_id": "a", "value": .2, "inserted_at": dt.datetime(2025, 2, 2)})
    for batch in (first, second):
        batch.coalesce(1).write.mode("append").parquet(f"{base}/in")
        refresh.refresh_stream(spark, f"{base}/in", f"{base}/reg", f"{base}/act", f"{base}/cp").awaitTermination()
    assert sorted(r.action for r in spark.read.parquet(f"{base}/act").collect()) == ["add", "skip_unchanged", "supersede"]
    stored = spark.read.parquet(f"{base}/reg")
    live = tables.live_versions(stored).first()
    assert (stored.count(), live.version, live.value) == (2, 2, .2)
    again = refresh.versions(refresh.decide(second, stored, 1), stored, 1)
    assert sorted((r.version, r.value) for r in again.collect()) == [(2, .2)]


def test_a_batch_reads_the_buckets_of_its_sources_only(spark, tmp_path):
    base = str(tmp_path)
    first = bench(spark, *[{"source_id": f"s{i}", "inserted_at": dt.datetime(2025, 1, 1)} for i in range(200)])
    first.coalesce(1).write.parquet(f"{base}/in")
    refresh.refresh_stream(spark, f"{base}/in", f"{base}/reg", f"{base}/act", f"{base}/cp").awaitTermination()
    bucket = spark.createDataFrame([("s7",)], "source_id string").select(refresh.bucket_of().alias("b")).first().b
    held = refresh.stored_versions(spark, f"{base}/reg", [bucket])
    assert {r.bucket for r in held.select("bucket").distinct().collect()} == {bucket} and 0 < held.count() < 20
    files = spark.read.parquet(f"{base}/reg").inputFiles()
    assert len({f.split("bucket=")[1].split("/")[0] for f in files}) > 50
    plan = held._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert refresh.stored_versions(spark, f"{base}/none", [1]).count() == 0


def test_superseding_nothing_live_is_refused(spark):
    stored = bench(spark, {"source_id": "a", "version": 3})
    entries = bench(spark, {"source_id": "a", "value": .2}, {"source_id": "zz", "value": .3})
    assert {r.source_id: (r.prior_version, r.dropped) for r in registry.supersede_verdicts(stored, entries.drop("version")).collect()} == {
        "a": (3, None), "zz": (None, "nothing_to_supersede")}
    order = [F.col("value")]
    good = registry.supersede(stored, entries.where("source_id = 'a'"), order, F.to_date("inserted_at"))
    assert [(r.source_id, r.version, r.superseded_by) for r in good.collect()] == [("a", 4, None)]
    with pytest.raises(Exception, match="no live benchmark to supersede: zz"):
        registry.supersede(stored, entries, order, F.to_date("inserted_at")).collect()


def test_counts_come_from_the_write_itself(spark, tmp_path):
    rows = bench(spark, {"source_id": "a", "value": .1}, {"source_id": "b", "value": .5}, {"source_id": "c", "value": .6})
    seen = spark.sparkContext.accumulator(0)
    watched = rows.rdd.map(lambda r: (seen.add(1), r)[1])
    frame = spark.createDataFrame(watched, rows.schema)
    registry.audited_write(frame, f"{tmp_path}/rows", f"{tmp_path}/log", "read", {"high": F.col("value") > .3, "all": F.lit(True)}, dt.datetime(2025, 1, 1))
    assert {r.entity_id: r.result_summary for r in spark.read.parquet(f"{tmp_path}/log").collect()} == {"high": "2", "all": "3"}
    assert spark.read.parquet(f"{tmp_path}/rows").count() == 3 and seen.value == 3
