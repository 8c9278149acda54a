"""Shards in Hilbert-curve order of the documents' metadata (operator 9), in DataFrame
operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verbaloom.llm.common import Aside, quoted, without
from verbaloom.sources.tables import stage

# A sort group has about this many rows, or a millionth of all rows if that is more.
GROUP_ROWS, MAX_GROUPS = 256, 1_000_000
# Cells per dimension are 2**BITS.
BITS = 5


def hilbert_index(df: DataFrame, axes: list[str], bits: int, name: str) -> DataFrame:
    """``df`` with the Hilbert-curve index of integer coordinates below 2**bits.

    Skilling's transform (AIP Conf. Proc. 707, 2004), one step per column so that each
    step reads the last one's result. A null coordinate counts as 0.
    """
    held = [f"_x{i}" for i in range(len(axes))]
    zero = F.lit(0).cast("bigint")
    df = df.withColumns({h: F.coalesce(F.col(a).cast("bigint"), zero) for h, a in zip(held, axes)})
    for bit in range(bits - 1, 0, -1):
        low = (1 << bit) - 1
        for i, h in enumerate(held):
            is_set = F.col(h).bitwiseAND(1 << bit) != 0
            swap = F.col(held[0]).bitwiseXOR(F.col(h)).bitwiseAND(low)
            if i == 0:
                df = df.withColumn(h, F.when(is_set, F.col(h).bitwiseXOR(low)).otherwise(F.col(h)))
            else:
                df = df.withColumns(
                    {
                        held[0]: F.when(is_set, F.col(held[0]).bitwiseXOR(low)).otherwise(
                            F.col(held[0]).bitwiseXOR(swap)
                        ),
                        h: F.when(is_set, F.col(h)).otherwise(F.col(h).bitwiseXOR(swap)),
                    }
                )
    for i in range(1, len(held)):
        df = df.withColumn(held[i], F.col(held[i]).bitwiseXOR(F.col(held[i - 1])))
    turn = zero
    for bit in range(bits - 1, 0, -1):
        is_set = F.col(held[-1]).bitwiseAND(1 << bit) != 0
        turn = turn.bitwiseXOR(F.when(is_set, F.lit((1 << bit) - 1).cast("bigint")).otherwise(zero))
    df = df.withColumn("_turn", turn)
    df = df.withColumns({h: F.col(h).bitwiseXOR(F.col("_turn")) for h in held})
    index = zero
    for bit in range(bits - 1, -1, -1):
        for h in held:
            index = index * 2 + F.shiftright(F.col(h), bit).bitwiseAND(1)
    return df.withColumn(name, index).drop(*held, "_turn")


def ordered_number(column: Column, kind: str) -> Column:
    """A number that orders as a column of numbers or times does."""
    if kind == "timestamp" or kind == "date":
        return F.unix_seconds(column.cast("timestamp")).cast("double")
    return column.cast("double")


def string_cuts(df: DataFrame, column: str, runs: int) -> list[str]:
    """The values at which rows in order of a string column pass each multiple of their
    number / ``runs``: under ``runs`` of them, each once, nulls left out.

    Whole values are compared, so long common prefixes do not matter. Rows are counted by
    value first; the counts are summed in even ranges of values, then inside each range.
    """
    counted = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("_value"))
    ranges = counted.agg(F.count("*").alias("_n")).repartitionByRange("_value")
    # Staged, so that all readers see the same ranges.
    dealt = stage(ranges.withColumn("_range", F.spark_partition_id()), "values")
    sums = dealt.groupBy("_range").agg(F.sum("_n").alias("_sum"), F.min("_value").alias("_least"))
    # One row per range.
    earlier = Window.orderBy("_least").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select(
        "_range",
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base"),
        F.sum("_sum").over(Window.partitionBy()).alias("_total"),
    )
    inside = Window.partitionBy("_range").orderBy("_value")
    upto = F.col("_base") + F.sum("_n").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    passed = f"least({runs - 1}, _upto * {runs} div _total) > (_upto - _n) * {runs} div _total"
    cuts = dealt.join(bases, "_range").withColumn("_upto", upto).where(passed)
    return [r["_value"] for r in cuts.select("_value").collect()]


def with_cells(df: DataFrame, dimensions: list[str], bits: int = BITS) -> DataFrame:
    """``df`` with ``cell``: the Hilbert index of its quantised dimensions.

    Each dimension is cut at quantiles of all rows, so that cells are even for any
    distribution; equal values share a cell coordinate. Numbers and times are cut
    approximately, in one pass over their columns, strings as ``string_cuts`` says. Nulls
    have coordinate 0. An empty table has no cuts.
    """
    # Bytes are cut like strings, in hexadecimal form, which keeps their order.
    names = [f"_dimension{i}" for i in range(len(dimensions))]
    own = dict(df.dtypes)
    df = df.withColumns(
        {n: F.hex(d) if own[d] == "binary" else F.col(d) for n, d in zip(names, dimensions)}
    )
    dimensions, kinds = names, dict(df.dtypes)
    numbers = {d: ordered_number(F.col(d), kinds[d]) for d in dimensions if kinds[d] != "string"}
    share = [i / (1 << bits) for i in range(1, 1 << bits)]
    found = {}
    if numbers:
        quantiles = [F.percentile_approx(n, share).alias(d) for d, n in numbers.items()]
        found = df.agg(*quantiles).first().asDict()
    axes = {}
    for i, d in enumerate(dimensions):
        if d not in numbers:
            found[d] = string_cuts(df, d, 1 << bits)
        axes[f"_axis{i}"] = _cuts_up_to(numbers.get(d, F.col(d)), sorted(set(found[d] or [])))
    placed = hilbert_index(df.withColumns(axes), list(axes), bits, "cell")
    return placed.drop(*axes, *names)


def _cuts_up_to(value: Column, cuts: list) -> Column:
    """How many of the cuts are at most the value; 0 for null."""
    if not cuts:
        return F.lit(0)
    return F.size(F.filter(F.lit(cuts), lambda c: c <= value))


# What assigned rows have more than before.
RESULTS = ["cell", "shard", "slot"]


def _internal(dimensions: int) -> list[str]:
    """The columns that shards are worked out in."""
    some = ["_turn", "_salt", "_rows", "_groups", "_group", "_rank", "_n", "_base", "_start", "_at"]
    return some + [f"{n}{i}" for n in ("_x", "_axis", "_dimension") for i in range(dimensions)]


def assign_shards(
    df: DataFrame, dimensions: list[str], shards: int, key: str = "doc_id", bits: int = BITS
) -> DataFrame:
    """``df`` with cell, shard (int, from 0) and slot (bigint, gapless from 0 in a shard).

    Rows are put in order of their cell on the Hilbert curve, inside a cell by that hash, and the order is cut into ``shards`` runs whose lengths differ by one at
    most. So a shard covers a compact box of metadata and readers skip it by statistics.

    No task sorts a whole cell: a cell's rows are spread by a hash of their key and of their
    place in the table (so those of one key too) over enough groups of even size (see GROUP_ROWS), and only group counts, some MAX_GROUPS at most,
    are summed along the curve. Repeated keys and rows each get a slot of their own (equal rows in any order);
    null keys and dimensions are allowed. ``df`` is read twice, and once more for each string
    dimension, and written once with its cells, so pass few columns. An empty table has no rows. Earlier columns of these three names
    are replaced.
    """
    beside = Aside(df.select(*quoted(without(df, RESULTS))), _internal(len(dimensions)))
    key, dimensions = beside.name(key), [beside.name(d) for d in dimensions]
    # Rows of one key, or of none, get numbers of their own, fixed as they are written.
    salted = with_cells(beside.df, dimensions, bits).withColumn("_salt", F.monotonically_increasing_id())
    placed = stage(salted, "cells")
    weights = placed.groupBy("cell").agg(F.count("*").alias("_rows"))
    # One row per cell of the grid at most: 2**(bits * dimensions) is the bound.
    total = weights.agg(F.coalesce(F.sum("_rows"), F.lit(0))).scalar()
    size = F.greatest(F.lit(GROUP_ROWS), F.floor(total / MAX_GROUPS))
    weights = weights.withColumn("_groups", F.ceil(F.col("_rows") / size))
    order = F.xxhash64(key, "_salt")
    spread = placed.join(weights.select("cell", "_groups"), "cell").withColumn(
        "_group", F.floor((F.shiftright(order, 32) + (1 << 31)) * F.col("_groups") / (1 << 32))
    )
    within = Window.partitionBy("cell", "_group").orderBy(order, "_salt")
    ranked = spread.withColumn("_rank", F.row_number().over(within) - 1)
    counts = spread.groupBy("cell", "_group").agg(F.count("*").alias("_n"))
    cells = counts.groupBy("cell").agg(F.sum("_n").alias("_n"))
    earlier = Window.unboundedPreceding, -1
    bases = cells.select(
        "cell",
        F.coalesce(F.sum("_n").over(Window.orderBy("cell").rowsBetween(*earlier)), F.lit(0)).alias("_base"),
    )
    inside = Window.partitionBy("cell").orderBy("_group").rowsBetween(*earlier)
    starts = counts.join(bases, "cell").select(
        "cell", "_group", (F.col("_base") + F.coalesce(F.sum("_n").over(inside), F.lit(0))).alias("_start")
    )
    # The first total % shards runs have one row more.
    at = F.col("_start") + F.col("_rank")
    small, longer = F.floor(total / shards), total % shards
    head = longer * (small + 1)
    shard = F.when(at < head, F.floor(at / (small + 1))).otherwise(
        longer + F.floor((at - head) / F.greatest(small, F.lit(1)))
    )
    begin = F.col("shard") * small + F.least(F.col("shard"), longer)
    out = ranked.join(starts, ["cell", "_group"]).withColumn("_at", at)
    out = out.withColumn("shard", shard.cast("int")).withColumn("slot", F.col("_at") - begin)
    return beside.back(out.select(*quoted(beside.df.columns), *RESULTS))


def write_shards(df: DataFrame, path: str, shards: int) -> None:
    """Write assigned rows as a folder per shard, rows in curve order, for readers that prune
    files by the statistics of the dimension columns.

    Tasks take even runs of the whole order, so a shard is several files if there are more
    tasks than shards, each a shorter run of the curve.
    """
    tasks = max(shards, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    laid = df.repartitionByRange(tasks, "shard", "slot").sortWithinPartitions("shard", "slot")
    laid.write.partitionBy("shard").parquet(path)
