"""Unit vectors in regions around pivots, and which of them can hold near rows.

A region's rows are those nearest to its pivot; its radius is the largest angle between them.
By the triangle inequality of angles, a row at angle a of a pivot is at least a - radius away
from every row of that region. Rows without a direction (zero, or not finite) are a region
of their own, the last one, which has no bound.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verbaloom.sources.tables import stage

# Pivots are collected: this many at most, chosen from a sample of a few rows for each.
MAX_REGIONS, SAMPLE = 1024, 4
PIVOT_BYTES = 32 << 20
# Angles and similarities this much closer count as equal, as they are rounded numbers.
ANGLE_SLACK, SIMILARITY_SLACK = 1e-6, 1e-9
# The side of a cell that both its blocks are.
BOTH = 2
ENTRY = "array<struct<cell: bigint, side: int, asks: boolean>>"


def runs(batches, key: str):
    """Arrow tables of the rows of one key each, from batches sorted by it."""
    import pyarrow as pa

    held, current = [], None
    for batch in batches:
        keys = batch.column(batch.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if a == b:
                continue
            if held and keys[a] != current:
                yield current, pa.Table.from_batches(held).combine_chunks()
                held = []
            current = keys[a]
            held.append(batch.slice(a, b - a))
    if held:
        yield current, pa.Table.from_batches(held).combine_chunks()


def farthest_first(rows, n: int):
    """At most n different rows, each the farthest from those before it."""
    chosen = [0]
    nearest = rows @ rows[0]
    while len(chosen) < min(n, len(rows)):
        at = int(nearest.argmin())
        if nearest[at] > 1 - 1e-12:
            break
        chosen.append(at)
        nearest = np.maximum(nearest, rows @ rows[at])
    return rows[chosen]


def _matrix(column):
    import pyarrow.compute as pc

    return pc.list_flatten(column).to_numpy().reshape(len(column), -1)


def _directed(units):
    """Whether each row has a direction."""
    with np.errstate(all="ignore"):
        length = (units * units).sum(axis=1)
    return np.isfinite(length) & (length > 0.5)


def _angles(units, pivots):
    return np.arccos(np.clip(units @ pivots.T, -1.0, 1.0))


def choose_pivots(units: DataFrame, n: int):
    """Pivots from the rows with the least hashes of their ids."""
    width = units.select(F.max(F.size("unit"))).first()[0] or 1
    n = max(1, min(n, PIVOT_BYTES // (8 * width * SAMPLE)))
    sample = units.orderBy(F.xxhash64("id"), "id").limit(SAMPLE * n).select("unit").toArrow()
    rows = _matrix(sample["unit"].combine_chunks()) if sample.num_rows else np.zeros((0, width))
    rows = rows[_directed(rows)]
    return farthest_first(rows, n) if len(rows) else np.zeros((0, rows.shape[1]))


class Layout:
    """Rows in blocks: id, word, unit, region, place (the number of the block in its region)."""

    def __init__(self, rows: DataFrame, pivots, sizes, block_rows: int, radius):
        self.rows, self.pivots, self.radius = rows, pivots, radius
        self.filled, self.counts = sizes > 0, np.maximum(1, -(-sizes // block_rows))
        n = F.element_at(F.lit(self.counts.tolist()), F.col("region") + 1)
        self.rows = rows.withColumn("place", F.pmod(F.xxhash64("id"), n).cast("bigint"))

    def own_cells(self) -> DataFrame:
        """The cells within regions; every row asks."""
        counts = self.counts.astype(np.int64)
        before = np.cumsum(counts * (counts + 1) // 2) - counts * (counts + 1) // 2
        place, n = F.col("place"), F.element_at(F.lit(counts.tolist()), F.col("region") + 1)
        first = F.element_at(F.lit(before.tolist()), F.col("region") + 1)

        def entry(other):
            low, high = F.least(place, other), F.greatest(place, other)
            side = F.when(place == other, F.lit(BOTH)).when(place < other, F.lit(0)).otherwise(F.lit(1))
            triangle = F.shiftright(high * (high + 1), 1) + low
            return F.struct((first + triangle).alias("cell"), side.alias("side"), F.lit(True).alias("asks"))

        entries = F.transform(F.sequence(F.lit(0).cast("bigint"), n - 1), entry)
        return _exploded(self.rows, entries)

    def n_own_cells(self) -> int:
        counts = self.counts.astype(np.int64)
        return int((counts * (counts + 1) // 2).sum())

    def asking(self, least: DataFrame) -> Asking:
        """The second round: ``least`` (id, least) is what a row's new neighbours must beat."""
        pivots, radius, filled = self.pivots, self.radius, self.filled
        rows = self.rows.join(least, "id", "left")
        kept = ["id", "word", "unit", "region", "place"]
        shape = T.StructType([rows.schema[c] for c in kept] + [T.StructField("asked", T.BinaryType())])

        def ask(batches):
            import pyarrow as pa

            for batch in batches:
                columns = {n: batch.column(batch.schema.get_field_index(n)) for n in batch.schema.names}
                units, own = _matrix(columns["unit"]), columns["region"].to_numpy()
                least = columns["least"].fill_null(-2.0).to_numpy()
                asked = asked_regions(units, own, least, pivots, radius) & filled
                packed = [row.tobytes() for row in np.packbits(asked, axis=1)]
                yield pa.RecordBatch.from_arrays(
                    [*(columns[n] for n in kept), pa.array(packed, pa.binary())], [*kept, "asked"]
                )

        asked = stage(rows.select(*kept, "least").mapInArrow(ask, shape), "asking-vectors")
        return Asking(asked, self.counts)


class Asking:
    """Rows with the regions they ask, and the cells that this makes."""

    def __init__(self, rows: DataFrame, counts):
        self.rows, self.counts = rows, counts.astype(np.int64)
        n = len(counts)
        asked = np.zeros((n, n), bool)
        for row in self._by_region():
            bits = np.frombuffer(row.asked, np.uint8)
            asked[row.region] = np.unpackbits(bits, count=n).astype(bool)
        self.asked = asked
        # A pair of regions r < s has cells for all pairs of their blocks, if either asks.
        met = np.triu(asked | asked.T, 1)
        sizes = np.where(met, self.counts[:, None] * self.counts[None, :], 0)
        self.first = (np.cumsum(sizes.ravel()) - sizes.ravel()).reshape(n, n)
        self.met, self.visited = met | met.T, int(sizes.sum())

    def _by_region(self):
        """A row per region: those that any of its rows asks."""

        def either(batches):
            import pyarrow as pa

            found = {}
            for batch in batches:
                for region, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    bits = np.frombuffer(raw, np.uint8)
                    found[region] = found[region] | bits if region in found else bits
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.keys(), pa.int32()), pa.array([b.tobytes() for b in found.values()], pa.binary())],
                ["region", "asked"],
            )

        def merge(key, table):
            import pyarrow as pa

            bits = [np.frombuffer(x, np.uint8) for x in table["asked"].to_pylist()]
            whole = np.bitwise_or.reduce(bits).tobytes()
            return pa.table({"region": pa.array([key[0].as_py()], pa.int32()), "asked": [whole]})

        shape = "region int, asked binary"
        partial = self.rows.select("region", "asked").mapInArrow(either, shape)
        return partial.groupBy("region").applyInArrow(merge, shape).collect()

    def n_cells(self) -> int:
        return self.visited

    def cells(self) -> DataFrame:
        """The cells between regions: rows that ask, and rows of regions that are asked."""
        counts, first, met, n = self.counts, self.first, self.met, len(self.counts)
        kept = ["id", "word", "unit"]
        shape = T.StructType([self.rows.schema[c] for c in kept])
        shape = shape.add("entries", T._parse_datatype_string(ENTRY))
        asked_by = self.asked.T.copy()

        def deal(batches):
            import pyarrow as pa

            kind = pa.list_(pa.struct([("cell", pa.int64()), ("side", pa.int32()), ("asks", pa.bool_())]))
            for batch in batches:
                columns = {c: batch.column(batch.schema.get_field_index(c)) for c in batch.schema.names}
                region, place = columns["region"].to_numpy(), columns["place"].to_numpy()
                raw = np.frombuffer(b"".join(columns["asked"].to_pylist()), np.uint8)
                asks = np.unpackbits(raw.reshape(len(region), -1), axis=1, count=n).astype(bool)
                # Regions a row goes to: those it asks, and those with rows that ask its own.
                goes = (asks | asked_by[region]) & met[region]
                row, other = np.nonzero(goes)
                times = counts[other]
                row_of, other_of = np.repeat(row, times), np.repeat(other, times)
                block = np.arange(len(row_of)) - np.repeat(np.cumsum(times) - times, times)
                own = region[row_of]
                lower = own < other_of
                low, high = np.where(lower, own, other_of), np.where(lower, other_of, own)
                a = np.where(lower, place[row_of], block)
                b = np.where(lower, block, place[row_of])
                cell = first[low, high] + a * counts[high] + b
                entries = pa.StructArray.from_arrays(
                    [pa.array(cell), pa.array(np.where(lower, 0, 1).astype(np.int32)), pa.array(asks[row_of, other_of])],
                    ["cell", "side", "asks"],
                )
                ends = np.concatenate([[0], np.cumsum(np.bincount(row_of, minlength=len(region)))])
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), entries)
                yield pa.RecordBatch.from_arrays(
                    [*(columns[c] for c in kept), lists.cast(kind)], [*kept, "entries"]
                )

        return _exploded(self.rows.mapInArrow(deal, shape), F.col("entries"))


def _exploded(rows: DataFrame, entries) -> DataFrame:
    laid = rows.select("id", "word", "unit", F.explode(entries).alias("entry"))
    return laid.select("entry.cell", "entry.side", "entry.asks", "id", "word", "unit")


def asked_regions(units, own, least, pivots, radius):
    """For each row the regions, not its own, with rows that could be as similar as ``least``."""
    directed = _directed(units)
    asked = np.ones((len(units), len(pivots) + 1), bool)
    if len(pivots):
        angles = _angles(np.where(directed[:, None], units, 0.0), pivots)
        nearest = np.maximum(angles - radius[None, :] - ANGLE_SLACK, 0.0)
        asked[:, :-1] = np.cos(nearest) >= least[:, None] - SIMILARITY_SLACK
        asked[~directed] = True
    asked[np.arange(len(units)), own] = False
    return asked


def lay_out(units: DataFrame, n_regions: int, block_rows: int) -> Layout:
    """The rows of units (id, word, unit) in at most ``n_regions`` regions and one for rows
    without a direction, cut into blocks of about ``block_rows``.

    One region is no region: its rows are not compared with a pivot.
    """
    if n_regions == 1:
        sizes = np.array([units.count()])
        return Layout(units.withColumn("region", F.lit(0)), np.zeros((0, 0)), sizes, block_rows, np.zeros(0))
    pivots = choose_pivots(units, n_regions)
    shape = T.StructType(units.schema.fields + [T.StructField("region", T.IntegerType()), T.StructField("angle", T.DoubleType())])

    def nearest(batches):
        import pyarrow as pa

        for batch in batches:
            rows = _matrix(batch.column(batch.schema.get_field_index("unit")))
            region, angle = np.full(len(rows), len(pivots), np.int32), np.zeros(len(rows))
            directed = np.flatnonzero(_directed(rows)) if len(pivots) else np.zeros(0, int)
            if len(directed):
                products = rows[directed] @ pivots.T
                region[directed] = products.argmax(axis=1)
                angle[directed] = np.arccos(np.clip(products.max(axis=1), -1.0, 1.0))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(region), pa.array(angle)], [*batch.schema.names, "region", "angle"]
            )

    placed = stage(units.mapInArrow(nearest, shape), "placed-vectors")
    sizes, radius = np.zeros(len(pivots) + 1, np.int64), np.zeros(len(pivots))
    for row in placed.groupBy("region").agg(F.count("*").alias("n"), F.max("angle").alias("r")).collect():
        sizes[row.region] = row.n
        if row.region < len(pivots):
            radius[row.region] = row.r
    return Layout(placed.drop("angle"), pivots, sizes, block_rows, radius)
