"""CSV and Parquet exports, file scans and JSON sources."""

import datetime as dt
import json

from pyspark.sql import functions as F

from tidemark.operators.flags import FlagRules
from tidemark.plans import exports
from tidemark.sources import tables


def csv(spark, path):
    return spark.read.option("header", True).csv(path)


def test_exports(spark, observe, tmp_path):
    out = str(tmp_path)
    obs = observe({"source_id": "CBA_PD", "value": .02}, {"source_id": "CBA_PD", "value": .018, "as_of_date": dt.date(2023, 12, 31)},
                  {"source_id": "CBA_LGD", "value": .3, "parameter": "lgd"}, {"source_id": "Q", "value": None, "parameter": "commentary"})
    exports.export_model_inputs(obs, tables.stress_scenarios(), tables.reality_check_bands(spark), out)
    assert csv(spark, f"{out}/stress_testing_inputs.csv").count() == 3
    pd_rows = csv(spark, f"{out}/pd_inputs.csv")
    assert pd_rows.columns == ["segment", "segment_label", "product", "source_id", "source_type", "pd_decimal", "as_of_date"]
    assert spark.read.parquet(f"{out}/portfolio_monitor_inputs.parquet").count() == 0
    exports.export_raw_observations(obs, out)
    raw = {(r.source_id, r.as_of_date): r.value for r in csv(spark, f"{out}/raw_observations.csv").collect()}
    assert raw["CBA_PD", "2024-12-31"] == "0.020000" and raw["Q", "2024-12-31"] is None
    exports.export_validation_flags(obs, FlagRules(as_of=dt.date(2025, 1, 1)), out)
    assert csv(spark, f"{out}/validation_flags.csv").first().spread_decimal == "0.1053"
    exports.export_segment_trend(obs, out)
    assert csv(spark, f"{out}/segment_trend.csv").first().delta == "0.002000"
    exports.export_bands(tables.reality_check_bands(spark), out)
    assert {r["product"]: r.upper_sources for r in csv(spark, f"{out}/reality_check_bands.csv").collect()}["bridging"] == "LATROBE_BRIDGING_REALISED_LOSS|APS113_SLOTTING_SATIS_PD"


def test_file_inventory_and_json_sources(spark, tmp_path):
    for name in ("apra/insight/a.pdf", "rba/b_MANUAL.md", "rba/.gitkeep", "top.xlsx", "x/__pycache__/c.txt"):
        file = tmp_path / "raw" / name
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text("x")
    got = {r.relative_path: (r.source_family, r.subfamily, r.kind, r.size_bytes) for r in tables.raw_file_inventory(spark, str(tmp_path / "raw")).collect()}
    assert got == {"apra/insight/a.pdf": ("apra", "insight", "pdf", 1), "rba/b_MANUAL.md": ("rba", "", "manual_note", 1), "top.xlsx": ("top.xlsx", "", "xlsx", 1)}

    (tmp_path / "m.json").write_text(json.dumps({"source_key": "s", "items": [{"source_key": "s", "title": "t", "url": "u"}]}, indent=1))
    assert tables.read_manifest(spark, str(tmp_path / "m.json")).first().url == "u"
    for key, text in (("a", '{"source_key": "rba_smp",\n "source": "SMP", "period": "May 2025"}'), ("b", "{broken"), ("c", '{"source_key": "zzz"}')):
        (tmp_path / f"{key}.metadata.json").write_text(text)
    rows = tables.read_sidecars(spark, str(tmp_path)).collect()
    assert [(r.ord, r.source_key, r.period, r.url) for r in rows] == [(1, "rba_smp", "May 2025", "")]
    (tmp_path / "t.json").write_text(json.dumps({"bank": "anz", "tables": [
        {"name": "IRB Credit Risk", "rows": [{"asset_class_raw": "Residential Mortgage", "pd": .009, "lgd": None}]},
        {"name": "Specialised Lending", "rows": [{"grade": "strong", "pd": .004}]}]}, indent=1))
    points = tables.parsed_table_points(tables.read_parsed_tables(spark, str(tmp_path / "t.json")))
    assert {(r.source_name, r.raw_value) for r in points.collect()} == {
        ("ANZ_RESIDENTIAL_MORTGAGE_PD", .009), ("ANZ_SPECIALISED_LENDING_SLOTTING_STRONG_PD", .004)}


def test_seed_entries_pass_their_own_rules(spark):
    from tidemark.operators.checks import check_benchmarks

    seeds = tables.seed_benchmarks(spark)
    assert seeds.count() == 53 and seeds.select("source_id").distinct().count() == 53
    assert check_benchmarks(seeds).where(F.size("errors") > 0).count() == 0
    notes = {r.source_id: r.notes for r in seeds.collect()}
    assert notes["NAB_PILLAR3_RES_2024H2"] == "National Australia Bank Pillar 3 residential mortgage PD disclosure (2024-12-31); https://www.nab.com.au/pillar3"


def test_printed_formats(spark):
    from pyspark.sql import functions as F

    from tidemark.functions import text as X

    rows = spark.createDataFrame([(0.025, 1.5, "2024-01-01", "2024-03-31"), (-0.0014, 0.333, "2024-01-01", "2024-01-01"), (None, None, None, None), (0.0, 0.0, None, "2024-05-01")],
                                 "v double, r double, lo string, hi string")
    got = rows.select(X.percent_places(F.col("v")).alias("p"), X.percent_places(F.col("v"), 1, signed=True).alias("s"), X.basis_points(F.col("v")).alias("b"),
                      X.times(F.col("r")).alias("t"), X.date_window(F.col("lo"), F.col("hi")).alias("w")).collect()
    assert [tuple(r) for r in got] == [
        ("2.5000%", "+2.5%", "250 bps", "1.50x", "2024-01-01–2024-03-31"), ("-0.1400%", "-0.1%", "-14 bps", "0.33x", "2024-01-01"), ("-", "-", "-", "-", "-"),
        ("0.0000%", "0.0%", "0 bps", "0.00x", "–2024-05-01")]


def test_quarter_of_a_publication_period(spark):
    from pyspark.sql import functions as F

    from tidemark.functions import text as X

    rows = spark.createDataFrame([("March 2025",), ("Statement, Nov 2024",), ("undated",)], "t string")
    assert [tuple(r[0]) for r in rows.select(X.year_quarter(F.col("t"))).collect()] == [(2025, 1), (2024, 4), (None, None)]
