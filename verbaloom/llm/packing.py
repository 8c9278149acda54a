"""Best-fit packing of tokenized documents into sequences (operator 13).

Hierarchical residual packing:

1. Each partition encodes its documents a slice at a time, cuts documents longer than a
   sequence, and puts the pieces of a slice, longest first, into the bin with the least
   room that fits. Its bins stay open for later slices; ids leave the task at once.
2. Bins that are nearly full are done. The others become items, as long as their fill.
3. A tree merges partitions, FAN at a time: their underfull bins are packed again by best
   fit, each as one item, until one node is left.

Only bins' fills, never pieces, go up the tree, and a node passes on at most HELD of them:
two bins that are both at most half full never leave a node, so a merge above it needs one
of its few emptier bins and one host. Bins that are not passed on are sequences as they are.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verbaloom.llm.chunk_ids import ChunkEncoder, with_end
from verbaloom.llm.common import ship_file, whole_slices, worker_state
from verbaloom.sources.tables import stage

LENGTH = 2048
# Bins with at most this share of their places left are done.
NEARLY = 1 / 64
# Partitions that a node of the tree merges, and the underfull bins it passes on at most.
FAN, HELD = 8, 4096
SLICE_BYTES = 8 << 20
MEMO = (300_000, 600_000)
# A bin's number is that of the task that opened it, then its own.
TASK_BITS = 33


class BestFit:
    """Bins of one size, found by the room they have left."""

    def __init__(self, size: int):
        self.size = size
        self.rooms = [[] for _ in range(size + 1)]
        # Bit r is set if some bin has r places left.
        self.some = 0
        self.opened = 0

    def place(self, length: int) -> tuple[int, int]:
        """Put an item into the bin with the least room that fits, or a new one: bin, offset."""
        fitting = self.some >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            number = self.rooms[room].pop()
            if not self.rooms[room]:
                self.some ^= 1 << room
        else:
            room, number = self.size, self.opened
            self.opened += 1
        left = room - length
        if left:
            self.rooms[left].append(number)
            self.some |= 1 << left
        return number, self.size - room

    def place_all(self, lengths):
        """``place`` of many items, longest first; of equal ones the first goes first."""
        numbers, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        for i in np.argsort(-lengths, kind="stable").tolist():
            numbers[i], offsets[i] = self.place(int(lengths[i]))
        return numbers, offsets


def cut_pieces(sizes, length: int):
    """Owner, number, start and length of each piece of documents of the given sizes."""
    counts = -(-sizes // length)
    owner = np.repeat(np.arange(len(sizes)), counts)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    start = number * length
    return owner, number, start, np.minimum(length, sizes[owner] - start)


def packed_pieces(
    docs: DataFrame,
    vocabulary: str,
    end_id: int,
    key: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
) -> DataFrame:
    """key, piece, start, length, ids, sequence_id, offset: a row per piece of a document.

    ``ids`` are the library's ids of the whole text without added special tokens, then
    ``end_id``, as little-endian unsigned 32-bit integers. Documents longer than ``length``
    are cut into pieces of that length, the last one shorter; no other is cut. The pieces of a
    sequence fill it without gaps from offset 0, and no sequence is longer than ``length``.

    A null or empty text is the end id alone. Keys may be of any type, null or repeated: each
    row is a document of its own. Ties go to the row read first, so another layout of the
    table may give other sequences. An empty table gives no rows. Other columns are not read.
    """
    if length < 1:
        raise ValueError("length must be positive")
    placed = stage(_local(docs, vocabulary, end_id, key, text, length), "packed-locally")
    moves = _merged(placed.select("bin", "length"), length)
    found = placed.join(moves, placed["bin"] == moves["item"], "left")
    return found.select(
        F.col("key").alias(key),
        "piece",
        "start",
        "length",
        "ids",
        F.coalesce("root", "bin").alias("sequence_id"),
        (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset"),
    )


def _local(docs, vocabulary, end_id, key, text, length) -> DataFrame:
    spark = docs.sparkSession
    shipped = ship_file(spark, vocabulary)
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    shape = T.StructType(
        [
            T.StructField("key", rows.schema["key"].dataType),
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids", T.BinaryType()),
            T.StructField("bin", T.LongType()),
            T.StructField("offset", T.LongType()),
        ]
    )

    def pack(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(shape)
        encoder = worker_state(
            ("packing", shipped.value), lambda: ChunkEncoder(shipped.value, "<u4", MEMO)
        )
        bins, base = BestFit(length), TaskContext.get().partitionId() << TASK_BITS
        for part in whole_slices(batches, "text", SLICE_BYTES):
            ids, sizes = encoder.encode(part.column(1))
            ids, ends = with_end(ids, sizes, end_id)
            owner, number, start, lengths = cut_pieces(sizes + 1, length)
            first = (ends - sizes - 1)[owner] + start
            numbers, offsets = bins.place_all(lengths)
            limits = np.append(first, len(ids)).astype(np.int32) * 4
            # Pieces lie end to end, so the ids are the value buffer as they are.
            raw = pa.Array.from_buffers(
                pa.binary(), len(owner), [None, pa.py_buffer(limits), pa.py_buffer(ids)]
            )
            columns = [
                part.column(0).take(pa.array(owner)),
                pa.array(number),
                pa.array(start),
                pa.array(lengths),
                raw,
                pa.array(numbers + base),
                pa.array(offsets),
            ]
            yield pa.RecordBatch.from_arrays(
                [c.cast(f.type) for c, f in zip(columns, schema)], schema=schema
            )

    return rows.mapInArrow(pack, shape)


def _merged(pieces: DataFrame, length: int) -> DataFrame:
    """item, root, shift: for bins that were merged, their sequence and place in it."""
    fills = pieces.groupBy("bin").agg(F.sum("length").alias("fill"))
    open_bins = fills.where(F.col("fill") < length * (1 - NEARLY)).withColumnRenamed("bin", "item")
    items = stage(open_bins, "underfull-bins")
    moves = items.select("item", F.col("item").alias("root"), F.lit(0).cast("bigint").alias("shift"))
    last = items.agg(F.max("item")).first()[0]
    nodes, level = (0 if last is None else (last >> TASK_BITS) + 1), 1
    while nodes > 1:
        step = stage(_merge_level(items, level, length), f"merged-{level}")
        up = step.select(
            F.col("item").alias("root"), F.col("root").alias("next"), F.col("shift").alias("more")
        )
        moves = moves.join(up, "root", "left").select(
            "item",
            F.coalesce("next", "root").alias("root"),
            (F.col("shift") + F.coalesce("more", F.lit(0))).alias("shift"),
        )
        moves = stage(moves, f"moves-{level}")
        items = step.where("passed").select(F.col("root").alias("item"), "fill")
        nodes, level = -(-nodes // FAN), level + 1
    return moves.where("root <> item")


def _merge_level(items: DataFrame, level: int, length: int) -> DataFrame:
    """item, root, shift, fill, passed: underfull bins after best fit within each node.

    ``passed`` is true on one row of each bin that the next level sees.
    """

    def merge(group, table):
        import pyarrow as pa

        order = np.argsort(table.column("item").to_numpy(), kind="stable")
        item, fill = table.column("item").to_numpy()[order], table.column("fill").to_numpy()[order]
        numbers, shifts = BestFit(length).place_all(fill)
        fills = np.bincount(numbers, weights=fill).astype(np.int64)
        # The item at offset 0 gives its number to the merged bin.
        roots = np.zeros(len(fills), np.int64)
        roots[numbers[shifts == 0]] = item[shifts == 0]
        lowest = np.argsort(fills, kind="stable")[:HELD]
        passed = np.zeros(len(fills), bool)
        passed[lowest] = fills[lowest] < length * (1 - NEARLY)
        return pa.table(
            {
                "item": item,
                "root": roots[numbers],
                "shift": shifts,
                "fill": fills[numbers],
                "passed": passed[numbers] & (shifts == 0),
            }
        )

    node = F.shiftright("item", TASK_BITS)
    dealt = items.withColumn("node", F.floor(node / FAN**level))
    shape = "item bigint, root bigint, shift bigint, fill bigint, passed boolean"
    return dealt.select("node", "item", "fill").groupBy("node").applyInArrow(merge, shape)


def sequences(pieces: DataFrame) -> DataFrame:
    """sequence_id, n_ids, ids, pieces: the packed sequences, from rows of ``packed_pieces``.

    ``ids`` are the ids of the pieces in order; ``pieces`` gives their offsets and lengths,
    for an attention mask. A group holds at most one sequence.
    """
    part = F.struct("offset", "length", "ids")
    held = pieces.groupBy("sequence_id").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    whole = F.aggregate("parts", F.lit(b""), lambda x, p: F.concat(x, p["ids"]))
    total = F.aggregate("parts", F.lit(0).cast("bigint"), lambda x, p: x + p["length"])
    return held.select(
        "sequence_id",
        total.alias("n_ids"),
        whole.alias("ids"),
        F.transform("parts", lambda p: F.struct(p["offset"], p["length"])).alias("pieces"),
    )
