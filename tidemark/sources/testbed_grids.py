"""Workbook grids, sheets and documents derived from the driver tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.sources.testbed import pick, quarter_end, table


def _cell(sheet: Column, row: int, col: Column, text: Column | None = None, number: Column | None = None) -> Column:
    return F.struct(
        sheet.alias("sheet"), F.lit(row).alias("row_idx"), col.cast("int").alias("col_idx"),
        (F.lit(None).cast("string") if text is None else text).alias("text"),
        (F.lit(None).cast("double") if number is None else number.cast("double")).alias("num"))


def _cells(base: DataFrame, doc: Column, cells: list[Column]) -> DataFrame:
    return base.select(doc.alias("doc_id"), F.explode(F.array(*cells)).alias("c")).select("doc_id", "c.*")


def _quarters(spark: SparkSession, sf: str) -> DataFrame:
    """lineitem with quarter ends moved 24 years on, and a column index per quarter."""
    as_of = quarter_end(F.add_months(F.col("l_shipdate").cast("date"), 288))
    return table(spark, sf, "lineitem").withColumn("as_of", as_of).withColumn(
        "col", (F.year("as_of") - 2018) * 4 + F.quarter("as_of")).withColumn("price", F.col("l_extendedprice").cast("decimal(18,2)"))


def exposure_cells(spark: SparkSession, sf: str, by_supplier: bool = False) -> DataFrame:
    """Six exposure sheets: header in row 3, role rows among look-alike rows; one workbook, or one of two sheets for each supplier."""
    sheet = pick((F.col("l_suppkey") % 3) * 2 + F.col("l_linenumber") % 2, ["Tab 1a", "Tab 1b", "Tab 2a", "Tab 2b", "Tab 4a", "Tab 4b"])
    doc = F.concat(F.lit("qpex-"), F.col("l_suppkey").cast("string")) if by_supplier else F.lit("qpex")
    base = _quarters(spark, sf).groupBy(doc.alias("book_id"), sheet.alias("sheet"), "as_of", "col").agg(
        F.sum("price").alias("total"), F.sum(F.when(F.col("l_quantity") <= 3, F.col("price"))).alias("bad"))
    s, col = F.col("sheet"), F.col("col")
    numbers = _cells(base, F.col("book_id"), [
        _cell(s, 3, col, F.date_format("as_of", "MMM yyyy")), _cell(s, 10, col, None, F.col("total") * 2), _cell(s, 11, col, None, F.col("total")),
        _cell(s, 12, col, None, F.col("total") / 2), _cell(s, 20, col, None, F.col("bad")), _cell(s, 21, col, None, F.col("bad") / 2)])
    commercial = s.endswith("a")

    def label(a: str, b: str) -> Column:
        return F.when(commercial, F.lit(a)).otherwise(F.lit(b))

    zero = F.lit(0)
    names = _cells(base.select("book_id", "sheet").distinct(), F.col("book_id"), [
        _cell(s, 10, zero, label("Total commercial property exposure limits", "Total credit limits")),
        _cell(s, 11, zero, label(" Total commercial property exposures ", "Total credit oustanding")),
        _cell(s, 12, zero, label("Total commercial property exposures of which: Australia", "Total credit outstanding by purpose")),
        _cell(s, 20, zero, label("Non-performing commercial property exposures", "Non-performing loans")),
        _cell(s, 21, zero, label("Non-performing commercial property exposures - provisions", "Non-performing loans of which: investor"))])
    return numbers.unionByName(names)


def performance_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Three sector sheets whose header stands in row 5, not the usual row 3."""
    sheet = pick(F.col("l_suppkey") % 3, ["Tab 1d", "Tab 2d", "Tab 4d"])
    base = _quarters(spark, sf).groupBy(sheet.alias("sheet"), "as_of", "col").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("l_quantity") <= 3).alias("bad"))
    s, col = F.col("sheet"), F.col("col")
    share = F.round(F.col("bad") / F.col("n"), 6)
    return _cells(base, F.lit("performance"), [
        _cell(s, 5, col, F.last_day("as_of").cast("string")), _cell(s, 53, col, None, share),
        _cell(s, 54, col, F.format_string("%.6f", share * 2)), _cell(s, 55, col, None, F.col("n"))])


def quarterly_cells(spark: SparkSession, sf: str) -> DataFrame:
    """A workbook per quarter: non-performing and exposure sheets by portfolio."""
    labels = ["Corporate (incl. Large and SME corporate)", "SME retail", "Residential mortgage", "Qualifying revolving retail", "Other retail",
              "Specialised lending", "Financial institution", "Sovereign", "Leases"]
    base = _quarters(spark, sf).groupBy("as_of", (F.col("l_suppkey") % 9).alias("k")).agg(
        F.sum("price").alias("ead"), F.sum(F.when(F.col("l_quantity") <= 4, F.col("price"))).alias("npe"))
    name, one, zero = pick(F.col("k"), labels), F.lit(1), F.lit(0)
    npe, ead = F.lit("CRB(f)(ii)"), F.lit("EAD & CRWA")

    def rows(sheet: Column, value: Column, offset: int) -> list[Column]:
        row = (F.col("k") + offset).cast("int")
        def cell(col: Column, text: Column | None, number: Column | None) -> Column:
            return _cell(sheet, 0, col, text, number).withField("row_idx", row)
        return [cell(zero, name, None), cell(one, F.lit("n/a"), None), cell(F.lit(2), None, value), cell(F.lit(3), None, F.when(value.isNotNull(), F.lit(7.0)))]

    later = [c for c in rows(ead, F.lit(1.0), 40)]
    return _cells(base, F.concat(F.lit("cba-"), F.col("as_of").cast("string")), rows(npe, F.col("npe"), 5) + rows(ead, F.col("ead"), 5) + later)


# --- canonical sheets and parsed documents ----------------------------------------------------


CATEGORIES = ["Residential", "Commercial", "Corporate", "Hotel Lending", "SME Retail"]


def canonical_sheet(spark: SparkSession, sf: str) -> DataFrame:
    """Period by category with two rate columns, one of them sometimes blank."""
    o = table(spark, sf, "orders")
    category = pick(F.substring("o_orderpriority", 1, 1).cast("int") - 1, CATEGORIES)
    return o.groupBy(quarter_end(F.col("o_orderdate").cast("date")).alias("period"), category.alias("category")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("o_orderstatus") == "P").alias("late"), F.count_if(F.col("o_custkey") % 97 == 0).alias("npl")
    ).select("period", "category", F.round(F.col("late") / F.col("n") / 2, 6).alias("90DPD_Rate"),
             F.when(F.col("npl") > 0, F.round(F.col("npl") / F.col("n"), 6)).alias("NPL_Rate"))


def portfolio_sheet(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """IRB portfolios and slotting grades, one row of each per customer."""
    c = table(spark, sf, "customer").withColumn("k", F.col("c_custkey"))
    portfolios = c.select(
        F.col("k").alias("doc_id"), pick(F.col("k") % 4, ["Residential Mortgage", "CRE Investment", "Corporate SME", "Sovereign"]).alias("portfolio"),
        F.round((F.col("k") % 97) / 1000, 6).alias("PD"), F.when(F.col("k") % 5 != 0, F.round((F.col("k") % 89) / 100, 6)).alias("LGD"))
    grades = c.select(F.col("k").alias("doc_id"), pick(F.col("k") % 4, ["Strong", "Good", "Satisfactory", "Weak"]).alias("grade"),
                      F.round((F.col("k") % 101) / 1000, 6).alias("PD"))
    return portfolios, grades


def parsed_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Parsed-table documents, one per customer, with a table nobody asked for."""
    portfolios, grades = portfolio_sheet(spark, sf)
    both = portfolios.join(grades.select("doc_id", "grade", F.col("PD").alias("gpd")), "doc_id")
    none = F.lit(None)

    def row(label: Column, pd_: Column, lgd: Column, grade: Column) -> Column:
        return F.struct(label.cast("string").alias("asset_class_raw"), pd_.cast("double").alias("pd"), lgd.cast("double").alias("lgd"),
                        none.cast("double").alias("exposure_ead_mn"), grade.cast("string").alias("grade"))

    def tab(name: str, r: Column) -> Column:
        return F.struct(F.lit(name).alias("name"), F.array(r).alias("rows"))

    return both.select(F.concat(F.lit("b"), F.col("doc_id").cast("string")).alias("bank"), F.lit("2025-06-30").alias("reporting_date"), F.array(
        tab("IRB Credit Risk", row(F.col("portfolio"), F.col("PD"), F.col("LGD"), none)),
        tab("Specialised Lending", row(none, F.col("gpd"), none, F.col("grade"))),
        tab("Other", row(none, F.col("PD"), none, none))).alias("tables"))


def manifests(spark: SparkSession, sf: str) -> DataFrame:
    """One manifest per page with two captured items."""
    p = table(spark, sf, "pages")

    def item(n: int) -> Column:
        return F.struct(F.lit("apra_insight").alias("source_key"), F.concat(F.lit(f"Issue {n} of "), F.col("page_id").cast("string")).alias("title"),
                        F.concat(F.col("url"), F.lit(f"#{n}")).alias("url"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 300 + n).cast("int")).cast("string").alias("published_date"),
                        F.lit("2025-01-01").alias("fetched_at"), F.lit("raw/x").alias("local_path"), F.sha2("url", 256).alias("sha256"))

    return p.select(F.lit("apra_insight").alias("source_key"), F.array(item(1), item(2)).alias("items"))


def sidecars(spark: SparkSession, sf: str) -> DataFrame:
    """Publication sidecars, some of other publications and some unreadable."""
    k = F.col("page_id")
    return table(spark, sf, "pages").select(
        pick(k % 5, ["rba_smp", "rba_fsr", "rba_chart_pack", "other", "rba_fsr"]).alias("source_key"), F.lit("Review").alias("source"),
        F.when(k % 2 == 0, F.lit("Reserve Bank")).alias("publisher"), "url", F.lit(None).cast("string").alias("local_cached_file"),
        F.concat(F.lit("Q1 "), (F.lit(2000) + k % 20).cast("string")).alias("period"), F.lit("2025-02-01").alias("retrieval_date"),
        F.when(k % 7 == 0, F.lit("{bad")).alias("_corrupt_record"))
