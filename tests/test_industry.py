"""Cross-bank sums, refusals, coverage and published table layouts."""

import datetime as dt
from decimal import Decimal

import pytest

from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import checks, industry, industry_tables as T
from tidemark.sources import tables

D = dt.date


@pytest.fixture
def rows(spark):
    def build(*items: dict):
        fields = [*schemas.INDUSTRY_ROWS.fieldNames(), "row_seq"]
        out = []
        for i, r in enumerate(items):
            base = dict.fromkeys(fields)
            base.update({"data_source": "d", "aggregation_level": "single_bank", "as_of_date": D(2025, 9, 30), "geography": "Total", "metric": "exposure_aud_m",
                         "source_publication": "p", "source_table_ref": "t", "source_page": 1, "row_seq": i, **r})
            if base["value_aud_m"] is not None:
                base["value_aud_m"] = Decimal(str(base["value_aud_m"]))
            out.append(tuple(base[f] for f in fields))
        return spark.createDataFrame(out, schemas.INDUSTRY_ROWS.__class__([*schemas.INDUSTRY_ROWS.fields, schemas.T.StructField("row_seq", schemas.T.LongType())]))

    return build


def anz(value, component, **more):
    return {"bank_code": "anz", "industry_published": "Manufacturing", "value_aud_m": value, "gross_carrying_component": component,
            "redaction_reason": None if value is not None else "published_as_dash", **more}


def test_one_null_sub_row_makes_the_group_null(rows):
    out = industry.intra_bank_totals(rows(anz(10, "loans"), anz(None, "other"))).first()
    assert (out.value_aud_m, out.null_reason, out.redaction_reason, out.derived_from_intra_bank_sum) == (
        None, "partial_redaction_in_subrows", "published_as_dash", True)


def test_pass_through_without_sub_row_columns(rows):
    plain = rows(anz(None, None)).drop("gross_carrying_component", "portfolio_type")
    out = industry.intra_bank_totals(plain).first()
    assert (out.null_reason, out.derived_from_intra_bank_sum) == ("published_as_dash", False)


def test_geographies_sum_and_totals_are_counted_once(spark, rows):
    wbc = [{"bank_code": "wbc", "industry_published": "Manufacturing", "value_aud_m": v, "geography": g} for v, g in ((11766, "Australia"), (882, "New Zealand"), (70, "Other overseas"))]
    labels = tables.industry_labels(spark)
    parts = industry.intra_bank_totals(rows(*wbc))
    assert industry.inter_bank_aggregate(parts, "exposure_aud_m", labels).first().value_aud_m == 12718.0
    both = industry.intra_bank_totals(rows(*wbc, {**wbc[0], "geography": "Total", "value_aud_m": 12718}))
    assert industry.inter_bank_aggregate(both, "exposure_aud_m", labels).first().value_aud_m == 12718.0
    assert industry.inter_bank_aggregate(both, "exposure_aud_m", labels, geography="sum_all").first().value_aud_m == 25436.0


def test_refusals(spark, rows):
    labels = tables.industry_labels(spark)
    totals = industry.intra_bank_totals(rows(
        {"bank_code": "cba", "industry_published": "Manufacturing", "metric": "individually_assessed_provision_aud_m", "value_aud_m": 1, "provision_basis": "aps220_specific"},
        {"bank_code": "nab", "industry_published": "Manufacturing", "metric": "individually_assessed_provision_aud_m", "value_aud_m": 1, "provision_basis": "aasb9_stage3_ecl"}))
    refused = []
    for attempt in (lambda: industry.inter_bank_aggregate(totals, "pd_value", labels), lambda: industry.inter_bank_aggregate(totals, "write_offs_aud_m", labels),
                    lambda: industry.provisions_same_basis(totals, "aps220_specific", labels), lambda: industry.provisions_same_basis(totals, "mixed", labels),
                    lambda: industry.intra_bank_totals(rows(anz(1, "loans")).drop("metric"))):
        with pytest.raises(checks.RefusedError) as error:
            attempt()
        refused.append(error.value)
    assert industry.refusal_log(spark, refused).count() == 5
    one = totals.where("bank_code = 'nab'")
    assert industry.provisions_same_basis(one, "aasb9_stage3_ecl", labels).first().value_aud_m == 1.0


def test_unknown_label_fails_and_is_listed(spark, rows):
    bad = rows({"bank_code": "cba", "industry_published": "Asteroids", "value_aud_m": 1})
    labels = tables.industry_labels(spark)
    with pytest.raises(Exception, match="Asteroids"):
        industry.harmonise(bad, labels).collect()
    assert [r.n for r in industry.unmatched_labels(bad, labels).collect()] == [1]


def test_consumer_buckets_never_add_up(spark, rows):
    totals = industry.intra_bank_totals(rows(
        {"bank_code": "cba", "industry_published": "Consumer", "value_aud_m": 5}, {"bank_code": "nab", "industry_published": "Personal", "value_aud_m": 7},
        {"bank_code": "nab", "industry_published": "Manufacturing", "value_aud_m": 9}))
    labels = tables.industry_labels(spark)
    assert [r.canonical_bucket for r in industry.inter_bank_aggregate(totals, "exposure_aud_m", labels).collect()] == ["manufacturing"]
    assert industry.inter_bank_aggregate(totals, "exposure_aud_m", labels, view="personal").first().value_aud_m == 7.0
    with pytest.raises(ValueError):
        industry.inter_bank_aggregate(totals, "exposure_aud_m", labels, view="all")


@pytest.mark.parametrize("ead, stock, ratio, low, caveat", [
    (30, 100, .3, True, "series_break_2019"), (80, 100, .8, False, "series_break_2019"), (80, None, None, False, "d14_1_suppressed")])
def test_coverage(spark, rows, ead, stock, ratio, low, caveat):
    labels = tables.industry_labels(spark)
    agg = industry.inter_bank_aggregate(industry.intra_bank_totals(rows({"bank_code": "cba", "industry_published": "Construction", "value_aud_m": ead})), "exposure_aud_m", labels)
    value = None if stock is None else Decimal(stock)
    table = spark.createDataFrame(
        [("rba", "m", D(2025, 9, 30), None, "Construction (total)", value, None, "2019", None, True, D(2025, 11, 1)),
         ("rba", "m", D(2025, 9, 30), None, "Other construction", Decimal(999), None, "2019", None, False, D(2025, 11, 1)),
         ("rba", "m", D(2025, 6, 30), None, "Construction (total)", Decimal(1), None, "2010", None, True, D(2025, 8, 1))], schemas.SYSTEM_STOCK)
    row = industry.coverage_ratios(agg, industry.system_stock_by_bucket(table, tables.system_labels(spark))).first()
    assert (row.coverage_ratio, row.low_coverage_flag) == (ratio, low) and caveat in row.coverage_ratio_caveat
    assert "d14_1_no_matching_bucket" not in row.coverage_ratio_caveat


def test_published_layouts(pages):
    text = "Header\nAs at 30 Sep 25\nIndustry sector $m $m $m $m $m\nManufacturing 16,717 1 22 3 (44)\nUtilities(3) 1 2 - 4 5\nGovernment and public authorities - - - - -\nTotal 1 1 1 1 1\nMining 1 1 1 1 1"
    got = {(r.industry_published, r.metric): (r.value_aud_m, r.redaction_reason) for r in T.table_rows(pages(text), T.LAYOUTS["nab"]).collect()}
    assert got["Manufacturing", "exposure_aud_m"] == (16717.0, None)
    assert got["Manufacturing", "individually_assessed_provision_aud_m"] == (44.0, None)
    assert got["Utilities", "npe_aud_m"] == (None, "published_as_dash")
    assert got["Government and public authorities", "npe_aud_m"] == (0.0, None)
    assert len(got) == 9


def test_unmatched_table_label_raises_or_is_quarantined(pages):
    bad = pages("As at 30 September 2025\nAsteroids 1 2 3 4 5")
    with pytest.raises(Exception, match="Asteroids"):
        T.table_rows(bad, T.LAYOUTS["nab"]).collect()
    assert {r.error for r in T.table_rows(bad, T.LAYOUTS["nab"], strict=False).collect()} == {"unmatched label: Asteroids"}


def test_page_without_a_date_is_quarantined(pages):
    undated = pages("Manufacturing 1 2 3 4 5")
    assert T.table_rows(undated, T.LAYOUTS["nab"]).count() == 0
    assert T.undated_pages(undated, "nab").first().reason == "no_as_of_date"


def test_labels_with_any_kind_of_space(spark):
    rows = spark.createDataFrame([("wbc", " Property services "), ("wbc", "Property  services")], "bank_code string, industry_published string")
    assert {r[0] for r in rows.select(industry.label_norm(F.col("industry_published"))).collect()} == {"property services"}


def test_figures_of_a_line_are_sought_once(pages):
    rows = T.table_rows(pages("Sep 25\n9 Manufacturing 1 2 3 4 5 6 7 (8)"), T.LAYOUTS["anz"])
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(T._peel(8)) == 1
    assert sorted(r.value_aud_m for r in rows.collect()) == [2, 3, 4, 5, 8]


def test_figures_begin_behind_letters_spaces_and_footnotes(pages):
    text = "As at 30 June 25\nUtilities(3)1 2 - 4 1,000\nManufacturing(1,5) 5 6 7 8\nConstruction 10 20 30 40 50 60\nTotal 1 1 1 1 1"
    rows = T.table_rows(pages(text), T.LAYOUTS["nab"], strict=False).where("metric = 'exposure_aud_m'").select("industry_published", "error", "value_aud_m").collect()
    assert len(rows) == 3
    assert {(r.industry_published, r.error, r.value_aud_m) for r in rows} == {
        ("Utilities", None, 1), ("Manufacturing", None, 15), (None, "unmatched label: Construction 10", 20)}


def test_figure_of_an_order_is_made_once_for_all_its_pages(spark, tmp_path):
    from tidemark.sources import testbed_pages as P

    spark.createDataFrame([(7, D(2005, 3, 9), 1234.5), (8, None, None)], "o_orderkey long, o_orderdate date, o_totalprice double").write.parquet(f"{tmp_path}/orders.parquet")
    made = P.industry_pages(spark, str(tmp_path))
    assert made._jdf.queryExecution().optimizedPlan().toString().count("format_number(") == 1
    text = {(r.doc_id, r.layout): r.text for r in made.collect()}
    assert len(text) == 10 and text["7", "nab"].split("\n")[1:4] == ["As at 9 Mar 25", "Industry sector $m 1 2 3 4 5", "Manufacturing 1,235 5 6 7 (1,235)"]
    assert "As at" not in text["8", "nab"]
