"""Disclosure pages rendered from table rows: one page per source row.

Parsing jobs read these pages back; their oracles read the original columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions import labels as L, text as X
from tidemark.sources.testbed import pick, pages_table

LINE_ID = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(l_shipdate as date))"


def page(*lines: Column | str) -> Column:
    """Lines joined by newlines; null lines are left out."""
    return F.concat_ws("\n", *[F.lit(x) if isinstance(x, str) else x for x in lines])


def num(value: Column, digits: int = 2) -> Column:
    return F.format_string(f"%.{digits}f", value)


def row(*parts: Column | str) -> Column:
    return F.concat_ws(" ", *[F.lit(x) if isinstance(x, str) else x for x in parts])


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    return pages_table(spark, sf, "lineitem", ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), 40_000).withColumns({
        "doc_id": F.expr(LINE_ID), "page_no": F.lit(1),
        "pd_pct": num((F.col("l_discount") + F.col("l_tax")) * 100), "lgd_pct": num(F.col("l_discount") * 100, 1)})


def _rendered(spark: SparkSession, sf: str, text: Column, *keep: str) -> DataFrame:
    """The page of every row, its text made once, and the columns of the row to ``keep``."""
    return X.once(_lines(spark, sf), text=text).select("doc_id", "page_no", *keep, "text")


def band_pages(spark: SparkSession, sf: str, *keep: str) -> DataFrame:
    """Five label styles; every seventh line number mentions the table only in prose."""
    pd_, lgd, k = F.col("pd_pct"), F.col("lgd_pct"), F.col("l_orderkey") % 5
    body = L.first_match([
        (k == 0, page(row("Residential mortgage 0.00 to <0.15 1,210 250 50 1,335", pd_, "1,200", lgd, "800 60 1"),
                      row("100.00 (Default) 1 1 1 1 100.00 1", lgd, "2"))),
        (k == 1, page("SME Retail", row("0.15 to <0.25 10 2 50 12", pd_, "3", lgd, "4 5"))),
        (k == 2, page("RBNZ regulated entities", row("Non-retail 0.00 to <0.15 10 2 50 12", pd_, "3 - 4 5"))),
        (k == 3, page(row("Corporate 0.00 to <0.15 1 2 50 3", pd_, "4", lgd, "9"),
                      row("(incl. SME corporate) 0.15 to <0.25 1 2 50 3", pd_, "4 150.0 9"))),
    ], page(row("Leases 0.00 to <0.15 1 2 50 3", pd_, "4", lgd, "9")))
    header = F.when(F.col("l_linenumber") == 7, F.lit("as outlined in CR6: IRB approach above")).otherwise(
        F.lit("CR6: IRB - credit risk exposures by portfolio and probability of default range"))
    text = page("Annual disclosure", header, "PD range Original Off-balance CCF EAD PD Borrowers LGD", body,
                "CR7: IRB - effect on RWA", "Sovereign 0.00 to <0.15 1 1 1 1 0.50 1 40.0 2 1 1 1")
    return _rendered(spark, sf, text, *keep)


MACQUARIE_TARGET = "30 September 2001"


def split_percent_pages(spark: SparkSession, sf: str, *keep: str) -> DataFrame:
    """Detached percent signs; odd line numbers carry the target date."""
    date = F.when(F.col("l_linenumber") % 2 == 1, F.lit(MACQUARIE_TARGET)).otherwise(F.lit("31 March 2001"))
    text = page("Table 7: CR6 - IRB exposures", date, "PD Scale", "Residential Mortgage",
                row("0.00 to <0.15 1,210 250 50 %", num(F.col("l_quantity"), 0), F.col("pd_pct"), "% 1,200", F.col("lgd_pct"), "% 800"),
                "0.15 to <0.25 10 2 50 % 500 2.00 % 3 20.00 % 4", "100.00 (Non-", "Performing) 5 5 50 % 7 100.00 % 1 30.00 % 2")
    return _rendered(spark, sf, text, *keep)


def slotting_pages(spark: SparkSession, sf: str, *keep: str) -> DataFrame:
    text = page("CR10: Specialised lending", "Strong 10 20 70% 14", F.when(F.col("l_returnflag") == "R", F.lit("WEAK 1 2 250% 5")),
                F.when(F.col("l_linestatus") == "O", F.lit("Satisfactory 3 4 115% 4")))
    return _rendered(spark, sf, text, *keep)


def alias_band_pages(spark: SparkSession, sf: str, *keep: str) -> DataFrame:
    label = pick(F.col("l_orderkey") % 3, ["Commercial real estate", "Construction and land", "Leasing"])
    text = page("CR6 equivalent", row(label, "0.00 to < 0.15 1 2 3 4", F.col("pd_pct"), "6 7"), "SME lending",
                "100.00 (Default) 1 2 3 4 100.50 6 7", "0.15 to <0.25 1 2 3 4 n/a 6 7")
    return _rendered(spark, sf, text, *keep)


def _ship20(column: str = "l_shipdate") -> Column:
    return F.add_months(F.col(column).cast("date"), 240)


def index_pages(spark: SparkSession, sf: str, *keep: str) -> DataFrame:
    """Table rows on even orders, phrases on odd ones; every seventh line has no date."""
    month = F.date_format(_ship20(), "MMMM yyyy")
    even = F.col("l_orderkey") % 2 == 0
    prime = F.when(even, row("Prime SPIN 0.91 0.85", F.col("pd_pct"))).otherwise(row("The weighted-average prime SPIN rose to", F.concat(F.col("pd_pct"), F.lit("%"))))
    other = F.when(even, row("Non-Conforming SPIN 4.10 4.00", F.col("lgd_pct"))).otherwise(F.lit("The non-conforming pool was stable"))
    head = F.when(F.col("l_linenumber") == 7, F.lit("RMBS arrears, undated")).otherwise(row("RMBS arrears statistics for", month))
    return _rendered(spark, sf, page(head, prime, other, "End of release"), *keep)


def results_pages(spark: SparkSession, sf: str, *keep: str) -> DataFrame:
    text = page(F.concat(F.lit("1H FY"), F.date_format(_ship20(), "yy"), F.lit(" Results")),
                "Residential mortgages", F.concat(F.lit("Loan loss expense of "), F.col("pd_pct"), F.lit("% of average book. Loss rate "), F.col("pd_pct"), F.lit("%")),
                F.concat(F.lit("90+ days arrears of "), num(F.col("l_quantity"), 0), F.lit(" bps")),
                "Asset finance grew", F.concat(F.lit("cost of risk "), F.col("lgd_pct"), F.lit("%; 30+ dpd at "), F.col("lgd_pct"), F.lit(" %")))
    return _rendered(spark, sf, text, *keep)


def update_pages(spark: SparkSession, sf: str, *keep: str) -> DataFrame:
    text = page(F.concat(F.lit("Trading update for the quarter ended "), F.date_format(_ship20(), "d MMMM yyyy")),
                F.concat(F.lit("Loan portfolio of $"), num(F.col("l_quantity") / 10, 1), F.lit("B")),
                F.concat(F.lit("Annualised net losses of "), num(F.col("l_quantity"), 0), F.lit(" bps")),
                F.concat(F.lit("Automotive loans: 90+ day arrears of "), F.col("pd_pct"), F.lit("%, annualised net credit losses were 43 basis points")),
                F.concat(F.lit("with 90+ day arrears at "), F.col("lgd_pct"), F.lit(" %")))
    return _rendered(spark, sf, text, *keep)


def note_pages(spark: SparkSession, sf: str, *keep: str) -> DataFrame:
    q = num(F.col("l_quantity"), 0)
    text = page(F.concat(F.lit("Annual report for the year ended "), F.date_format(_ship20(), "d MMMM yyyy")), "Sme loans 1 2 99.0%", "Credit risk",
                row("Residential mortgages 234 12,540", F.concat(F.col("pd_pct"), F.lit("%"))), row("Commercial property loans", q, "12,540"),
                row("SME loans", q, "0.0345"), "Leases 1 2 3.0%", "Liquidity risk", "Personal loans 5 10 4.0%")
    return _rendered(spark, sf, text, *keep)


# --- industry tables: one page per order or customer -----------------------------------------


def industry_pages(spark: SparkSession, sf: str) -> DataFrame:
    """The published industry tables of every order, each page with its ``layout``; the orders are read once."""
    d = F.add_months(F.col("o_orderdate").cast("date"), 240)
    # the figure and the date that several pages print are made once an order
    orders = X.once(pages_table(spark, sf, "orders", ("o_orderkey",), 10_000), _n=F.format_number(F.round("o_totalprice"), 0),
                    _long=F.date_format(d, "d MMMM yyyy"))
    n, long = F.col("_n"), F.col("_long")
    paren = F.concat(F.lit("("), n, F.lit(")"))
    texts = {
        "wbc_exposure": page("CRB(e)", F.concat(F.lit("As at "), long), "Australia", row("Manufacturing 1 2 3 4", n), "Mining 1 2 3 4 -", "Total Australia 2 4 6 8 9",
                             "New Zealand", row("Property services and business services 1 2 3 4", n), "Total New Zealand 1 1 1 1 1"),
        "wbc_npe": page("CRB(f)", "Manufacturing 9 9 9 9 9 9 9 9 9", F.concat(F.lit("As at "), long), row("Manufacturing", n, "2 3 4 5 6 7", n, paren),
                        "Government, administration and defence - - - - - - - - -", "Total 1 1 1 1 1 1 1 1 1"),
        "nab": page("Industry", F.concat(F.lit("As at "), F.date_format(d, "d MMM yy")), "Industry sector $m 1 2 3 4 5", row("Manufacturing", n, "5 6 7", paren),
                    row("Utilities(3)", "1 2 - 4", n), "Total 9 9 9 9 9", "Construction 9 9 9 9 9"),
        "anz": page("Breakdown", F.concat(F.lit("Sep "), F.date_format(d, "yy")), row("1 Construction 100", n, "20 30 40 50 60", n),
                    "8 Government & Official Institutions 1 - 3 4 - 6 7 -", "16 Total 1 1 1 1 1 1 1 1", "9 Manufacturing 1 1 1 1 1 1 1 1"),
        "cba_npe": page("CRB(f)(i)", F.concat(F.lit("30 June "), F.date_format(d, "yyyy")), "Industry Sector $M 1 2 3", row("Manufacturing", n, "–", paren),
                        row("Wholesale & Retail Trade 1", n, "3"), "Total 9 9 9"),
    }
    each = F.explode(F.array(*[F.struct(F.lit(name).alias("layout"), text.alias("text")) for name, text in texts.items()]))
    return orders.select(F.col("o_orderkey").cast("string").alias("doc_id"), F.lit(1).alias("page_no"), each.alias("p")).select(
        "doc_id", "page_no", "p.*")


def _customers(spark: SparkSession, sf: str) -> DataFrame:
    return pages_table(spark, sf, "customer", ("c_custkey",), 2_000)


def matrix_pages(spark: SparkSession, sf: str) -> DataFrame:
    """A ten-portfolio matrix per customer; cell (portfolio i, column j) = key + 10 i + j."""
    k = F.col("c_custkey")

    def block(base: int) -> list[Column]:
        return [row(f"Portfolio {chr(65 + i)}", *[F.format_number(k + base + 10 * i + j, 0) if (i, j) != (0, 0) else F.lit("–") for j in range(8)])
                for i in range(10)]

    text = page("CRB(e)(ii): Credit exposures by portfolio type and industry sector (continued)", "30 June 2025", "Industry Sector", *block(0),
                "Total credit exposures 1 1 1 1 1 1 1 1", "Industry Sector (continued)", *block(1000), "Total credit exposures 1 1 1 1 1 1 1 1")
    return X.once(_customers(spark, sf), text=text).select(k.cast("string").alias("doc_id"), F.lit(36).alias("page_no"), "text")


def bank_document_pages(spark: SparkSession, sf: str) -> DataFrame:
    """All fixed pages of the four annual documents, one document per customer."""
    k = F.col("c_custkey")
    n = F.format_number(k + 1000, 0)
    pages = [
        ("wbc", 37, page("As at 30 September 2025", "Australia", row("Manufacturing 1 2 3 4", n), "Total Australia 1 1 1 1 1")),
        ("wbc", 38, page("As at 30 September 2025", row("Manufacturing 1 2 3", n, "5 6 7 8", n), "Total 1 1 1 1 1 1 1 1 1")),
        ("nab", 37, page("As at 30 September 2025", row("Manufacturing", n, "2 3 4 5"), "Total 1 1 1 1 1")),
        ("anz", 43, page("Sep 25", row("9 Manufacturing 1", n, "2 3 4 5 6 7"), "16 Total 1 1 1 1 1 1 1 1")),
        ("cba", 39, page("30 June 2025", row("Manufacturing 1 2", n), "Total 1 1 1")),
        ("cba", 40, page("31 December 2024", row("Manufacturing 1 2", n), "Total 1 1 1")),
        ("cba", 12, page("30 June 2025", "Manufacturing 7 7 7")),
    ]
    each = F.explode(F.array(*[F.struct(F.lit(b).alias("bank"), F.lit(p).alias("page_no"), t.alias("text")) for b, p, t in pages]))
    return _customers(spark, sf).select(k.cast("string").alias("doc_id"), each.alias("p")).select("doc_id", "p.*")
