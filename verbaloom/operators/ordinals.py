"""Global order without a global sort: running offsets, ordinals, shards, buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A window partition never spans more than 2**DIGIT_BITS values of one key digit.
DIGIT_BITS = 21
DIGITS = 3


def running_offsets(totals: DataFrame, keys: list[str], weights: list[str]) -> DataFrame:
    """keys, weights: each weight replaced by its sum over all earlier rows.

    ``totals`` has one row per distinct key; keys are integer columns and give the
    order. A null weight counts as 0. Null or repeated keys fail when they are met, other
    key types at once. One window over all rows would run in a single task. Instead each key is read
    as three 21-bit digits: rows are summed inside their digit group, the group totals
    inside the next coarser group, and so on, and the sums are joined back down. No
    window partition holds more than 2**22 rows whatever the key distribution, and
    groups are a function of the key alone, so a recomputed task always agrees with the
    first run.

    Each level reads its group totals off the last row of its own window, so both uses
    share one shuffle of the totals.
    """
    kinds = dict(totals.dtypes)
    for key in keys:
        if kinds[key] not in ("tinyint", "smallint", "int", "bigint"):
            raise TypeError(f"order key {key} must be an integer, not {kinds[key]}")
    # Finest to coarsest: the columns that identify a row at each level.
    levels = [
        keys[:i] + [_digit(keys[i], digit)]
        for i in reversed(range(len(keys)))
        for digit in range(DIGITS)
    ]
    parents = levels[1:] + [[]]
    frame = totals.select(
        *(_required(k).alias(k) for k in keys),
        F.shiftright(_required(keys[-1]), DIGIT_BITS).alias(parents[0][-1]),
        *(F.coalesce(F.col(w).cast("bigint"), F.lit(0)).alias(w) for w in weights),
    )
    scans = []
    for i, (level, parent) in enumerate(zip(levels, parents)):
        ordered = Window.partitionBy(*parent).orderBy(level[-1])
        before = ordered.rowsBetween(Window.unboundedPreceding, -1)
        sums = {w: F.coalesce(F.sum(w).over(before), F.lit(0)) for w in weights}
        if i == 0:
            # The finest window has each key's rows next to each other.
            again = F.lag(level[-1]).over(ordered) == F.col(level[-1])
            twice = F.raise_error(F.lit(f"repeated order key: {', '.join(keys)}")).cast("bigint")
            sums = {w: F.when(again, twice).otherwise(x) for w, x in sums.items()}
        scan = frame.select(
            *dict.fromkeys(level + parent),
            *weights,
            *(x.alias(f"_before_{w}") for w, x in sums.items()),
            F.lead(F.lit(True)).over(ordered).isNull().alias("_last"),
        )
        scans.append(scan)
        if parent:
            # One row per group, with the digit that groups the groups.
            coarser = [c for c in parents[i + 1][-1:] if c not in parent]
            frame = scan.where("_last").select(
                *parent,
                *(F.shiftright(parent[-1], DIGIT_BITS).alias(c) for c in coarser),
                *((F.col(f"_before_{w}") + F.col(w)).alias(w) for w in weights),
            )

    result = None
    for scan, level, parent in reversed(list(zip(scans, levels, parents))):
        sums = {w: F.col(f"_before_{w}") for w in weights}
        if result is not None:
            scan = scan.join(result, parent)
            sums = {w: before + F.col(f"_base_{w}") for w, before in sums.items()}
        result = scan.select(*level, *(x.alias(f"_base_{w}") for w, x in sums.items()))
    return result.select(*keys, *(F.col(f"_base_{w}").alias(w) for w in weights))


def with_offsets(df: DataFrame, keys: list[str], weights: dict[str, Column]) -> DataFrame:
    """Add to each row of a keyed table the running sum of each weight before it.

    The hint makes the narrow offsets the hashed side, never the wide rows, and spares
    those a sort; keys are unique, so the join cannot be skewed. The rows of a table that
    ``tables.stage_keyed`` wrote by these keys do not move at all.
    """
    totals = df.select(
        *keys,
        *(F.coalesce(w.cast("bigint"), F.lit(0)).alias(name) for name, w in weights.items()),
    )
    offsets = running_offsets(totals, keys, list(weights))
    # Keys of the table's own types, so that its buckets serve the join.
    typed = offsets.select(
        *(F.col(k).cast(df.schema[k].dataType).alias(k) for k in keys), *weights
    )
    return df.join(typed.hint("shuffle_hash"), keys)


def _required(key: str) -> Column:
    """A key that fails on null. Being non-null by type, it also keeps Spark from adding
    null filters to some uses of the totals only, which would stop the shuffle's reuse."""
    missing = F.raise_error(F.lit(f"null order key: {key}")).cast("bigint")
    return F.coalesce(F.col(key).cast("bigint"), missing, F.lit(0))


def _digit(key: str, digit: int) -> str:
    return key if digit == 0 else f"_{key}_{digit * DIGIT_BITS}"


def record_shard(ordinal: Column, records_per_shard: int) -> Column:
    """1-based shard of a record; counts the records that were written."""
    _positive(records_per_shard, "records_per_shard")
    return whole_div(ordinal, F.lit(records_per_shard)) + 1


def line_shard(line_ordinal: Column, lines_per_shard: int) -> Column:
    """0-based shard of an input line; empty lines count too."""
    _positive(lines_per_shard, "lines_per_shard")
    return whole_div(line_ordinal, F.lit(lines_per_shard))


def max_position(positions: DataFrame, position: str = "position") -> DataFrame:
    """One row: the largest position, 0 for an empty or all-negative table."""
    return positions.agg(
        F.greatest(F.coalesce(F.max(position), F.lit(0)), F.lit(0)).alias("max_position")
    )


def position_buckets(
    positions: DataFrame,
    buckets: int,
    position: str = "position",
    largest: Column | None = None,
    parts: int = 1,
) -> DataFrame:
    """Add ``bucket``: ``buckets`` equal, order-keeping ranges of ``[0, max position]``.

    With ``parts`` above 1 also ``part``: so many equal ranges of each bucket, from 0.

    ``largest`` is the maximum if it is known, such as ``words.last_position``; otherwise it
    is a scalar subquery over the positions. A table whose maximum is 0 lies in bucket 0,
    and so do negative positions.
    """
    _positive(buckets, "buckets")
    _positive(parts, "parts")
    largest = max_position(positions, position).scalar() if largest is None else largest
    # Rounded up in whole numbers: doubles are wrong above 2**53.
    count = F.lit(buckets).cast("bigint")
    up = whole_div(largest, count) + (largest % count > 0).cast("bigint")
    width = F.greatest(up, F.lit(1))
    place = F.greatest(F.col(position).cast("bigint"), F.lit(0))
    bucket = F.least(whole_div(place, width), count - 1)
    found = positions.withColumn("bucket", bucket.cast("int"))
    if parts == 1:
        return found
    # The last bucket holds its end as well, which may lie beyond its width.
    share = whole_div(width, F.lit(parts).cast("bigint")) + 1
    part = F.least(whole_div(place - bucket * width, share), F.lit(parts - 1))
    return found.withColumn("part", part.cast("int"))


def range_layout(positions: DataFrame, partitions: int, position: str = "position") -> DataFrame:
    """Lay rows out in position order over ``partitions`` tasks, for ordered writing."""
    return positions.repartitionByRange(partitions, position).sortWithinPartitions(position)


def whole_div(a: Column, b: Column) -> Column:
    """Whole-number division of numbers that are not negative."""
    return F.call_function("div", a, b)


def _positive(value: int, name: str) -> None:
    if value <= 0:
        raise ValueError(f"{name} must be positive, got {value}")
