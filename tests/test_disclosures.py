"""Page-text extraction on literal pages."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import bands, disclosures, grids
from tidemark.operators.bands import bank_patterns

D = dt.date


def never():
    return F.lit(None).cast("date")



def test_prose_mention_is_not_a_table_and_next_table_is_not_read(pages):
    prose = "CR9 back-testing, as outlined in CR6: IRB tables\nResidential mortgage 0.00 to <0.15 1 1 1 1 0.10 1 20.0"
    real = "CR6: IRB - exposures\nResidential mortgage 0.00 to <0.15 1 1 1 1 0.10 1 20.0\nCR7: effect\nSovereign 0.00 to <0.15 1 1 1 1 0.20 1 30.0"
    rows = bands.band_rows(pages(prose, real)).collect()
    assert {(r.doc_id, r.asset_class, r.metric_name, round(r.value, 6)) for r in rows} == {
        ("d2", "residential_mortgage", "pd", .001), ("d2", "residential_mortgage", "lgd", .2)}


def test_bank_labels_and_row_index(pages):
    text = "CR6: IRB\n1 Large Corporate 0.00 to <0.15 1 1 1 1 0.10 1 20.0\n2 0.15 to <0.25 1 1 1 1 0.20 1 -\nQualifying revolving retail (QRR)\n19 0.25 to <0.50 1 1 1 1 0.30 1 n/a"
    rows = bands.band_rows(pages(text), bank_patterns("anz"), r"^\d{1,2}\s+").collect()
    assert [(r.asset_class, r.pd_band, r.metric_name) for r in rows] == [
        ("corporate_general", "0.00 to <0.15", "pd"), ("corporate_general", "0.00 to <0.15", "lgd"),
        ("corporate_general", "0.15 to <0.25", "pd"), ("retail_qrr", "0.25 to <0.50", "pd")]


def test_macquarie_pages_of_the_target_date_with_continuation(spark):
    band = "0.00 to <0.15 10 1 50 % {e} {p} % 3 {l} % 9"
    texts = [
        ("m", 1, "Table 7: CR6 - IRB\n31 March 2025\nCorporate\n" + band.format(e=5, p=9.99, l=99)),
        ("m", 2, "Table 7: CR6 - IRB\n30 September 2025\nCorporate\n" + band.format(e=100, p="0.10", l="48.60")),
        ("m", 3, "Corporate\n0.15 to <0.25 10 1 50 % 300 0.50 % 3 40.00 % 9\n100.00 (Non-\nPerforming) 1 1 50 % 7 100.00 % 1 30.00 %"),
        ("m", 4, "Market risk 31 March 2025\nCorporate\n" + band.format(e=5, p=9.99, l=99))]
    rows = bands.split_percent_rows(spark.createDataFrame(texts, "doc_id string, page_no int, text string"), "30 September 2025")
    got = {(r.page_no, r.metric_name, r.pd_band): (round(r.value, 6), r.ead_mn) for r in rows.collect()}
    assert got[2, "pd", "0.00 to <0.15"] == (.001, 100.0) and got[2, "lgd", "0.00 to <0.15"] == (.486, 100.0)
    assert got[3, "pd", "100.00 (Non-Performing)"] == (1.0, 7.0) and {k[0] for k in got} == {2, 3}
    mean = {r.metric_name: r.value for r in bands.ead_weighted_portfolio(rows).collect()}
    assert mean["pd"] == pytest.approx((.001 * 100 + .005 * 300) / 400)


def test_missing_exposure_falls_back_to_the_plain_mean(spark):
    df = spark.createDataFrame([("d", "x", "pd", .1, "a", None), ("d", "x", "pd", .3, "b", 0.0)],
                               "doc_id string, asset_class string, metric_name string, value double, pd_band string, ead_mn double")
    assert bands.ead_weighted_portfolio(df).first().value == .2


def test_trading_update(pages):
    text = ("Results for the quarter ended 31 December 2025\nLoan portfolio increased to $2.4B\nAnnualised net credit losses were 116 bps for the quarter\n"
            "Automotive loans with 90+ day arrears of 43 bps\nRepeated: 90+ day arrears of 43 bps")
    got = {(r.segment, r.parameter): r for r in disclosures.trading_update(pages(text), never()).collect()}
    assert got["consumer_unsecured", "loss_rate"].value == pytest.approx(.0116)
    arrears = got["consumer_secured", "arrears"]
    assert (arrears.value, arrears.sample_size_n, arrears.as_of_date) == (pytest.approx(.0043), 2400, D(2025, 12, 31))
    assert len(got) == 2


def test_annual_note(pages):
    text = "for the year ended 30 June 2025\nCredit risk\nResidential mortgages 234 12,540 1.87%\nCommercial property loans 5 200\nMotor finance 12 0.02\nLeases 1 2 1%\nLiquidity risk\nSME loans 1 2 9%"
    got = {r.segment: (round(r.value, 6), r.as_of_date) for r in disclosures.impaired_table(pages(text), never()).collect()}
    assert got == {"residential_mortgage": (.0187, D(2025, 6, 30)), "commercial_property": (.025, D(2025, 6, 30)), "consumer_secured": (.02, D(2025, 6, 30))}


def test_index_release(pages):
    table = "RMBS arrears as of June 30, 2025\nPrime SPIN 0.95 0.88 0.79\nNon-Conforming SPIN 4.10 4.00 3.90\nend"
    phrase = "Arrears for February 2026\nThe prime SPIN rose to 0.93% in the month"
    undated = "Prime SPIN 0.95 0.88"
    got = {(r.doc_id, r.source_id): (round(r.value, 6), r.as_of_date) for r in disclosures.index_headline(pages(table, phrase, undated)).collect()}
    assert got == {("d1", "sp_spin_prime"): (.0079, D(2025, 6, 30)), ("d1", "sp_spin_non_conforming"): (.039, D(2025, 6, 30)),
                   ("d2", "sp_spin_prime"): (.0093, D(2026, 2, 28))}


def test_results_pack_sections_and_first_occurrence(pages):
    text = "2H FY25\nResidential mortgage book: 90+ days arrears of 1.20%\nAsset finance: loss rate of 0.5% and again loss rate of 0.50%"
    got = [(r.segment, r.parameter, round(r.value, 6), r.as_of_date, r.snippet) for r in disclosures.results_pack(pages(text), never()).collect()]
    assert sorted(got) == [("consumer_secured", "loss_rate", .005, D(2025, 6, 30), "loss rate of 0.5%"),
                           ("residential_mortgage", "arrears", .012, D(2025, 6, 30), "90+ days arrears of 1.20%")]


def test_detected_table_points(spark):
    cells = [("d", "t1", 0, 0, "Other", None), ("d", "t2", 0, 0, "CR6 exposures", None), ("d", "t2", 3, 0, "Housing", None), ("d", "t2", 3, 2, "1.25%", None),
             ("d", "t2", 3, 3, "0.2", None), ("d", "t9", 0, 0, "CR6 later", None)]
    table = grids.detected_tables(spark.createDataFrame(cells, "doc_id string, sheet string, row_idx int, col_idx int, text string, num double"),
                                  "cr6", {"asset_class": 0, "pd": 2, "lgd": 3})
    assert {(r.asset_class, r.metric_name, r.value) for r in grids.irb_table_points(table).collect()} == {
        ("residential_mortgage", "pd", .0125), ("residential_mortgage", "lgd", .2)}


def test_plain_text_is_the_same_as_a_character_map(spark):
    from tidemark.functions import text as X

    odd = X._SPACES + X._BREAKS + X._NOTHING
    texts = [None, "", "plain\nlines ~", "".join("x" + c + c + "–é" for c in odd), odd, "a" + odd[::-1] + "\U0001f600"]
    table = str.maketrans(dict.fromkeys(X._SPACES, " ") | dict.fromkeys(X._BREAKS, "\n") | dict.fromkeys(X._NOTHING, ""))
    got = spark.createDataFrame([(t,) for t in texts], "text string").select("text", X.plain_text(F.col("text")).alias("plain")).collect()
    assert [r.plain for r in got] == [t and t.translate(table) for t in texts]


# --- how often a page is looked at: the same rows from fewer and cheaper looks ---------------


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_text_is_made_plain_by_one_map(pages):
    from tidemark.functions import text as X

    plan = plan_of(pages("a b").select(X.plain_text(F.col("text")).alias("t")))
    assert "regexp_replace" not in plan and plan.count("translate(") == 1


def test_control_characters_between_plain_ones_are_found(spark):
    from tidemark.functions import text as X

    texts = [f"a{chr(c)}b" for c in range(128)] + ["é", "a "]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "text string").select(X.plain_text(F.col("text"))).collect()]
    assert got == [t.translate(str.maketrans(dict.fromkeys(X._SPACES, " ") | dict.fromkeys(X._NOTHING, ""))) for t in texts]


def test_pages_that_all_decide_are_not_joined(spark):
    band = "Table 7: CR6 - IRB\n{}\nCorporate\n0.00 to <0.15 10 1 50 % 5 0.10 % 3 40.00 % 9"
    texts = [("m", 1, band.format("30 September 2025")), ("m", 2, band.format("31 March 2025")), ("m", 3, "no table")]
    rows = bands.split_percent_rows(spark.createDataFrame(texts, "doc_id string, page_no int, text string"), "30 September 2025")
    assert "Join" not in plan_of(rows)
    assert {(r.page_no, r.metric_name) for r in rows.collect()} == {(1, "pd"), (1, "lgd")}


def test_undecided_page_follows_the_page_before(spark):
    head, line = "Table 7: CR6 - IRB\n{}\nCorporate", "\n0.00 to <0.15 10 1 50 % 5 0.10 % 3 40.00 % 9"
    texts = [("a", 1, head.format("30 September 2025")), ("a", 2, "Corporate" + line), ("b", 1, head.format("31 March 2025")), ("b", 2, "Corporate" + line),
             ("c", 1, "Corporate" + line), ("d", 1, None), ("a", 1500, "Corporate" + line + " on 30 September 2025"), (None, 1, "Corporate" + line)]
    rows = bands.split_percent_rows(spark.createDataFrame(texts, "doc_id string, page_no int, text string"), "30 September 2025")
    assert sorted({(r.doc_id, r.page_no) for r in rows.collect()}) == [("a", 2), ("a", 1500)]


def test_a_line_of_a_note_is_cut_once(pages):
    plan = plan_of(disclosures.impaired_verdicts(pages("Credit risk\nSME loans 5 200"), never()))
    assert plan.count(disclosures.NOTE_ROW) == 1


def test_sort_keys_of_a_page_lie_flat(pages):
    from pyspark.sql import types as T

    for rows in (disclosures.results_verdicts, disclosures.update_verdicts, disclosures.impaired_verdicts):
        plan = rows(pages("x"), never())._jdf.queryExecution().optimizedPlan()
        nodes = [plan.apply(i) for i in range(6) if plan.apply(i) is not None]
        ranked = [a for n in nodes for a in (n.output().apply(i) for i in range(n.output().size())) if a.name() == "_ranked"]
        fields = T._parse_datatype_json_string(ranked[0].dataType().json()).elementType.fields
        assert not any(isinstance(f.dataType, T.StructType) for f in fields[:fields.index(next(f for f in fields if f.name == "_at"))])


def test_repeats_are_told_by_all_their_keys_in_page_order(pages):
    text = ("1H FY25\nResidential mortgages\nloss rate 0.5%, cost of risk 0.50%, 90+ days arrears of 0.5%, 30+ days arrears of 50 bps, loss rate 250%, loss rate 250%\n"
            "Asset finance\ncost of risk 50 basis points, loss rate 0.5%")
    got = sorted((r.segment, r.data_definition_class, r.snippet, round(r.value, 6), r.dropped or "") for r in disclosures.results_verdicts(pages(text), never()).collect())
    assert got == [
        ("consumer_secured", "loss_expense_rate", "cost of risk 50 basis points", .005, ""),
        ("residential_mortgage", "arrears_30_plus_days", "30+ days arrears of 50 bps", .005, ""),
        ("residential_mortgage", "arrears_90_plus_days", "90+ days arrears of 0.5%", .005, ""),
        ("residential_mortgage", "loss_expense_rate", "loss rate 0.5%", .005, ""),
        ("residential_mortgage", "loss_expense_rate", "loss rate 250%", 2.5, "out_of_range"),
        ("residential_mortgage", "loss_expense_rate", "loss rate 250%", 2.5, "out_of_range")]


def test_update_phrases_end_with_their_line_and_are_sought_once_a_piece(pages):
    text = "Annualised net losses of\n116 bps\nAuto loans\n90+ day arrears  of 43 bps\n90+ day arrears\nat 2%"
    rows = disclosures.update_verdicts(pages(text), never())
    assert [(r.segment, r.snippet, round(r.value, 6)) for r in rows.collect()] == [("consumer_secured", "90+ day arrears  of 43 bps", .0043)]
    assert r"day\s+arrears" not in plan_of(rows)


def test_dropped_rows_cut_each_note_line_once(spark, tmp_path):
    from tidemark.plans import extract_queries as Q

    spark.createDataFrame([(4, 1, 2, 3, D(2005, 3, 31), 0.05, 0.01, 45.0)], "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_shipdate date, l_discount double, "
                          "l_tax double, l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")
    rows = Q.dropped_rows(spark, str(tmp_path))
    assert plan_of(rows).count(disclosures.NOTE_ROW) == 1
    assert {(r.parser, r.metric_name, r.value, r.dropped) for r in rows.collect()} == {
        ("cr6", "pd", .06, "no_portfolio"), ("cr6", "lgd", .05, "no_portfolio"), ("alias", "pd", None, "no_value"),
        ("note", "impaired", .03, "no_segment"), ("update", "loss_rate", 1.35, "out_of_range"), ("results", "arrears", 1.125, "out_of_range")}
