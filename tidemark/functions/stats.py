"""Group statistics that stay distributed when one group holds most of the rows.

Segments, classes and sources are few and very uneven, so nothing here gathers
a group into one task. Rows are first reduced to (key, distinct value, count)
with map-side combine; ranks are then found through pieces cut at quantiles, so
each sort or window partition is one piece of one group.

Key columns are the non-null identifiers of the data model.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidemark.session import staged

#: Stretches that the values of a group are cut into; their edges are quantiles of its own distinct values.
EDGES = 64
#: Distinct values up to which a group is ordered whole, in one task.
WHOLE = 1_000_000
#: Slots by hash of the keys, in which values are counted to find larger groups.
SLOTS = 65536


def value_counts(df: DataFrame, keys: Sequence[str], value: str, *carried: Column) -> DataFrame:
    """Rows per (keys, value) as ``_c``, nulls included, with further aggregates; a written table.

    Everything that a group's values are asked for can be read from it, so the rows are read once.
    """
    return staged(df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_c"), *carried), "counts")


def median_of_counts(counts: DataFrame, keys: Sequence[str], value: str, out: str = "median", newest: str | None = None,
                     also: Sequence[Column] = ()) -> DataFrame:
    """Exact median of ``value`` per key group from a table of values with counts ``_c``: keys + [out, n, min, max].

    Groups are ordered whole, by one shuffle, but for those that share a hash slot of more than ``WHOLE`` values:
    these are cut into pieces. No larger group escapes that, since its own values fill its slot. ``newest`` names
    a column whose maximum is carried along. ``also`` are further aggregates, over null values too; with them a
    group without any value stays, with a null median.
    """
    keys = list(keys)
    carried = [] if newest is None else [newest]
    rows = counts.withColumns({"_v": F.col(value), "_slot": F.pmod(F.xxhash64(*keys), F.lit(SLOTS)).cast("int")})
    if not also:
        rows = rows.where(F.col("_v").isNotNull())
    full = F.broadcast(rows.groupBy("_slot").agg(F.count("_v").alias("_k")).where(F.col("_k") > WHOLE).select("_slot"))
    whole = _median_of_whole(rows.join(full, "_slot", "left_anti"), keys, out, carried, also)
    large = rows.join(full, "_slot", "left_semi")
    pieces = _median_of_pieces(large.where(F.col("_v").isNotNull()).select(*keys, "_v", "_c", *carried), keys, out, carried)
    if also:
        pieces = large.groupBy(*keys).agg(*also).join(pieces, keys, "left")
    return whole.unionByName(pieces)


def _median_of_whole(rows: DataFrame, keys: list[str], out: str, carried: list[str], also: Sequence[Column]) -> DataFrame:
    """Medians by running counts along the ordered values of each group; nulls come first and count nothing."""
    by_key, counted = W.partitionBy(*keys), F.when(F.col("_v").isNotNull(), F.col("_c"))
    ranked = rows.withColumns({
        "_n": F.sum(counted).over(by_key), "_upto": F.sum(counted).over(by_key.orderBy("_v").rowsBetween(W.unboundedPreceding, 0))})
    return _middle_values(ranked.withColumns(_middle_ranks()), keys, out, F.max("_n"), F.min("_v"), F.max("_v"), carried, also)


def _middle_ranks() -> dict[str, Column]:
    return {"_lo": F.floor((F.col("_n") + 1) / 2), "_hi": F.floor(F.col("_n") / 2) + 1}


def _middle_values(ranked: DataFrame, keys: list[str], out: str, n: Column, least: Column, greatest: Column, carried: list[str],
                   also: Sequence[Column] = ()) -> DataFrame:
    """Mean of the values that hold the ranks ``_lo`` and ``_hi``; ``_upto`` counts the values up to a row's own."""
    def covers(rank: str) -> Column:
        return (F.col("_upto") >= F.col(rank)) & (F.col("_upto") - F.col("_c") < F.col(rank))

    return ranked.groupBy(*keys).agg(
        ((F.max(F.when(covers("_lo"), F.col("_v"))) + F.max(F.when(covers("_hi"), F.col("_v")))) / 2).alias(out),
        n.alias("n"), least.alias("min"), greatest.alias("max"), *[F.max(c).alias(c) for c in carried], *also,
    )


def _median_of_pieces(known: DataFrame, keys: list[str], out: str, carried: list[str]) -> DataFrame:
    """Medians of groups too large for one task.

    A group is cut at quantiles of its distinct values, whatever their unit; totals of the pieces locate the
    middle ranks, and only the pieces that hold these are ordered.
    """
    edges = known.groupBy(*keys).agg(F.percentile_approx("_v", [i / EDGES for i in range(1, EDGES)], 2000).alias("_edges"))
    binned = known.join(edges, keys).withColumn("_b", F.size(F.filter("_edges", lambda e: e < F.col("_v")))).drop("_edges")
    by_key = W.partitionBy(*keys)
    totals = binned.groupBy(*keys, "_b").agg(
        F.sum("_c").alias("_bc"), F.min("_v").alias("_min"), F.max("_v").alias("_max"), *[F.max(c).alias(c) for c in carried])
    middle = (
        totals
        .withColumns({
            "_n": F.sum("_bc").over(by_key), "_min": F.min("_min").over(by_key), "_max": F.max("_max").over(by_key),
            **{c: F.max(c).over(by_key) for c in carried},
            "_before": F.sum("_bc").over(by_key.orderBy("_b").rowsBetween(W.unboundedPreceding, 0)) - F.col("_bc")})
        .withColumns(_middle_ranks())
        .where((F.col("_before") < F.col("_hi")) & (F.col("_before") + F.col("_bc") >= F.col("_lo")))
        .select(*keys, "_b", "_n", "_min", "_max", "_before", "_lo", "_hi", *carried)
    )
    upto = F.sum("_c").over(W.partitionBy(*keys, "_b").orderBy("_v").rowsBetween(W.unboundedPreceding, 0)) + F.col("_before")
    ranked = binned.drop(*carried).join(middle, [*keys, "_b"]).withColumn("_upto", upto)
    return _middle_values(ranked, keys, out, F.max("_n"), F.max("_min"), F.max("_max"), carried)


def exact_median(df: DataFrame, keys: Sequence[str], value: str, out: str = "median",
                 newest: str | None = None) -> DataFrame:
    """Exact median of ``value`` per key group: keys + [out, n, min, max]; nulls are ignored, the rows are read once."""
    carried = [] if newest is None else [F.max(newest).alias(newest)]
    return median_of_counts(value_counts(df.where(F.col(value).isNotNull()), keys, value, *carried), keys, value, out, newest)


def number_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column], coarse: Column, out: str = "rn",
                total: str | None = None) -> DataFrame:
    """1-based position of each row in its key group, and the group's size where ``total`` names a column for it.

    ``coarse`` must not decrease along ``order`` (a day of a timestamp). The
    sort runs per (key, coarse) slice; slice offsets come from slice counts.
    """
    keys = list(keys)
    whole = {} if total is None else {total: F.sum("_sc").over(W.partitionBy(*keys))}
    sliced = df.withColumn("_slice", coarse)
    slices = sliced.groupBy(*keys, "_slice").agg(F.count(F.lit(1)).alias("_sc"))
    along = W.partitionBy(*keys).orderBy("_slice").rowsBetween(W.unboundedPreceding, 0)
    offsets = slices.withColumns({"_offset": F.sum("_sc").over(along) - F.col("_sc"), **whole}).drop("_sc")
    local = F.row_number().over(W.partitionBy(*keys, "_slice").orderBy(*order))
    return (
        sliced.withColumn("_local", local)
        .join(offsets, [*keys, "_slice"])
        .withColumn(out, (F.col("_local") + F.col("_offset")).cast("int"))
        .drop("_slice", "_local", "_offset")
    )


def state_before(df: DataFrame, keys: Sequence[str], order: Sequence[Column], coarse: Column, entry: Column, out: str) -> DataFrame:
    """Greatest ``entry`` (a struct) of all rows before each row in its key group, in two levels.

    Each (key, coarse) slice is folded by itself and gives one summary, its greatest entry; the
    summaries of a key are folded in turn and carried into their slices. The folded slices are a
    written table, so the input is read once and no key is ever one sort. ``coarse`` must not
    decrease along ``order``.
    """
    keys = list(keys)
    whole = W.partitionBy(*keys, "_slice")
    along = whole.orderBy(*order)
    folded = staged(df.withColumns({"_slice": coarse, "_entry": entry}).withColumns({
        "_local": F.max("_entry").over(along.rowsBetween(W.unboundedPreceding, -1)), "_sum": F.max("_entry").over(whole),
        "_opens": F.row_number().over(along) == 1}).drop("_entry"), "folded")
    earlier = W.partitionBy(*keys).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    carried = folded.where("_opens").select(*keys, "_slice", F.max("_sum").over(earlier).alias("_carry"))
    return folded.join(carried, [*keys, "_slice"]).withColumn(out, F.greatest("_local", "_carry")).drop("_slice", "_local", "_sum", "_opens", "_carry")


def safe_ratio(num: Column, den: Column, digits: int = 6) -> Column:
    """Rounded ratio, null unless the denominator is positive."""
    return F.when(den > 0, F.round(F.try_divide(num, den), digits))


def poisoned_sum(value: Column) -> Column:
    """Sum that is null as soon as one row of the group is null."""
    return F.when(F.count(value) == F.count(F.lit(1)), F.sum(value))
