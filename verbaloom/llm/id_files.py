"""Binary token-id shards with a minimal perfect hash index (operator 5).

A folder of id files holds

* ``ids-N.bin``: raw little-endian ids of the documents of shard N in key order, 2 or 4
  bytes each, then a footer: per document its first id (unsigned 64-bit, one more for the
  end), then the counts, the width and a magic number;
* ``index-B.mph``: for the keys whose hash falls in bucket B, a minimal perfect hash
  (levels of bit arrays; a key's slot is the number of set bits before its own) and per
  slot a fingerprint of the key, the shard, the row in it, the place of its ids and the
  number of documents of that key;
* ``catalog``, ``shards``, ``layout``: Parquet tables of rows, of shards (with the ids before each)
  and of the number of buckets.

A lookup hashes the key, tests one bit per level and reads one entry and one range.
"""

from __future__ import annotations

import struct

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from verbaloom.llm.chunk_ids import ChunkEncoder, with_end
from verbaloom.llm.common import ship_file, whole_slices, worker_state

MAGIC = b"vloomid1"
KEYS_PER_BUCKET = 1 << 16
# Bits per key and level of the hash, and levels before the rest is stored plainly.
SPREAD, LEVELS = 2, 24
ENTRY = np.dtype(
    [("print", "<u4"), ("shard", "<u4"), ("row", "<u8"), ("first", "<u8"), ("n_ids", "<u8"), ("copies", "<u8")]
)
FOOT = "<QQI8s"
FOOT_BYTES = struct.calcsize(FOOT)
NO_KEYS = np.zeros(0, np.int64)
# The library is the costly step here: larger slices and a larger memo (see common.Memo) than
# elsewhere, some 200 MB a worker.
SLICE, MEMO = 4 << 20, (300_000, 600_000)
CATALOG = "key bigint, shard int, row bigint, first bigint, n_ids bigint"


def _mix(keys, seed: int):
    """64-bit hashes of integer keys."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.int64).view(np.uint64) + np.uint64(
            (seed + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF
        )
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def fingerprint(keys):
    return (_mix(keys, 1000) >> np.uint64(32)).astype(np.uint32)


class PerfectHash:
    """A minimal perfect hash of distinct integer keys.

    At each level the keys left are hashed to bits; bits hit once are set and settle
    their key, the others go on. The slot of a key is the rank of its bit.
    """

    def __init__(self, levels: list, rest):
        self.levels, self.rest = levels, rest
        self.ranks, before = [], 0
        for bits in levels:
            self.ranks.append(before + np.cumsum(bits, dtype=np.int64) - bits)
            before += int(bits.sum())
        self.settled = before

    @classmethod
    def build(cls, keys) -> PerfectHash:
        levels, left = [], np.sort(keys)
        while len(left) and len(levels) < LEVELS:
            size = max(64, SPREAD * len(left))
            spot = (_mix(left, len(levels)) % np.uint64(size)).astype(np.int64)
            bits = np.bincount(spot, minlength=size) == 1
            levels.append(bits.astype(np.uint8))
            left = left[~bits[spot]]
        return cls(levels, left)

    def slots(self, keys):
        """A slot for every key; keys that were not built in may get any, or -1."""
        found = np.full(len(keys), -1, np.int64)
        todo = np.arange(len(keys))
        for level, (bits, ranks) in enumerate(zip(self.levels, self.ranks)):
            spot = (_mix(keys[todo], level) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[spot] == 1
            found[todo[hit]] = ranks[spot[hit]]
            todo = todo[~hit]
        at = np.searchsorted(self.rest, keys[todo])
        inside = at < len(self.rest)
        same = inside & (self.rest[np.where(inside, at, 0)] == keys[todo]) if len(self.rest) else inside
        found[todo[same]] = self.settled + at[same]
        return found

    def dump(self) -> bytes:
        parts = [struct.pack("<II", len(self.levels), len(self.rest))]
        for bits in self.levels:
            parts += [struct.pack("<Q", len(bits)), np.packbits(bits).tobytes()]
        return b"".join([*parts, self.rest.astype("<i8").tobytes()])

    @classmethod
    def load(cls, raw: bytes) -> tuple[PerfectHash, int]:
        """The hash and the number of bytes it took."""
        (n_levels, n_rest), at, levels = struct.unpack_from("<II", raw), 8, []
        for _ in range(n_levels):
            (size,) = struct.unpack_from("<Q", raw, at)
            width = (size + 7) // 8
            levels.append(np.unpackbits(np.frombuffer(raw, np.uint8, width, at + 8), count=size))
            at += 8 + width
        rest = np.frombuffer(raw, "<i8", n_rest, at)
        return cls(levels, rest), at + 8 * n_rest


def _files(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def _write(path: str, name: str, parts) -> None:
    """Write a file under a name of its own, then move it: a repeated task does no harm."""
    import uuid

    system, folder = _files(path)
    system.create_dir(folder, recursive=True)
    draft = f"{folder}/_{uuid.uuid4().hex}"
    with system.open_output_stream(draft) as out:
        for part in parts:
            out.write(part)
    system.move(draft, f"{folder}/{name}")


def write_ids(
    df: DataFrame,
    path: str,
    vocabulary: str,
    end_id: int,
    key: str = "doc_id",
    text: str = "text",
    shards: int | None = None,
) -> None:
    """Write the ids of every text, each followed by ``end_id``, as id files below ``path``.

    Documents lie in ascending key order, over range-partitioned shards (as many as
    shuffle partitions unless given); the text is shuffled once, before it is encoded.
    Keys must be integers. Documents of one key lie together, ordered by text, under one
    index entry. A null key comes first and has no entry, only its place in the catalog.
    A null text counts as empty. An empty table gives no shard and an empty index. Other
    columns are not read.
    """
    spark = df.sparkSession
    if dict(df.dtypes)[key] not in ("tinyint", "smallint", "int", "bigint"):
        raise TypeError(f"the key {key} must be an integer")
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    shipped = ship_file(spark, vocabulary)
    width = _width(shipped.value, end_id)
    placed = (
        df.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"))
        .repartitionByRange(shards, "key")
        .sortWithinPartitions("key", "text")
    )

    def write(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        number = TaskContext.get().partitionId()
        encoder = worker_state(
            ("id_files", shipped.value, width), lambda: ChunkEncoder(shipped.value, f"<u{width}", MEMO)
        )
        keys, firsts = [], [0]

        def parts():
            for part in whole_slices(batches, "text", SLICE):
                ids, ends = with_end(*encoder.encode(part.column(1)), end_id)
                keys.extend(part.column(0).to_pylist())
                firsts.extend((ends + firsts[-1]).tolist())
                yield ids.tobytes()
            yield np.array(firsts, "<u8").tobytes()
            yield struct.pack(FOOT, len(keys), firsts[-1], width, MAGIC)

        stream = parts()
        head = next(stream)
        if keys:
            _write(path, f"ids-{number}.bin", (p for s in ([head], stream) for p in s))
        n = len(keys)
        for a in range(0, n, 1 << 16):
            b = min(n, a + (1 << 16))
            at = np.array(firsts[a : b + 1], np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys[a:b], pa.int64()),
                    pa.array(np.full(b - a, number, np.int32)),
                    pa.array(np.arange(a, b)),
                    pa.array(at[:-1]),
                    pa.array(np.diff(at)),
                ],
                ["key", "shard", "row", "first", "n_ids"],
            )

    placed.mapInArrow(write, CATALOG).write.parquet(f"{path}/catalog")
    catalog = spark.read.schema(CATALOG).parquet(f"{path}/catalog")
    # One row per shard file: the only table that one task sums up.
    totals = catalog.groupBy("shard").agg(F.sum("n_ids").alias("n_ids"), F.count("*").alias("rows"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    totals.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0))).write.parquet(
        f"{path}/shards"
    )
    _write_index(spark, path)


def _width(content: bytes, end_id: int) -> int:
    from tokenizers import Tokenizer

    size = Tokenizer.from_buffer(content).get_vocab_size(with_added_tokens=True)
    return 2 if max(size - 1, end_id) < 1 << 16 else 4


def _write_index(spark: SparkSession, path: str) -> None:
    catalog = spark.read.schema(CATALOG).parquet(f"{path}/catalog").where("key is not null")
    buckets = max(1, -(-catalog.count() // KEYS_PER_BUCKET))
    spark.range(1).select(F.lit(buckets).alias("buckets")).write.parquet(f"{path}/layout")
    # The first document of each key; copies of a key are in one shard, next to each other.
    entry = F.struct("row", "shard", "first", "n_ids")
    keyed = (
        catalog.groupBy("key")
        .agg(F.min(entry).alias("e"), F.count("*").alias("copies"))
        .select(_bucket("key", buckets), "key", "e.*", "copies")
    )

    def build(group, table):
        import pyarrow as pa

        columns = {n: table.column(n).to_numpy() for n in table.column_names}
        hashed = PerfectHash.build(columns["key"])
        slots = hashed.slots(columns["key"])
        entries = np.zeros(len(slots), ENTRY)
        entries["print"][slots] = fingerprint(columns["key"])
        for name in ("shard", "row", "first", "n_ids", "copies"):
            entries[name][slots] = columns[name]
        number = group[0].as_py()
        raw = hashed.dump()
        _write(path, f"index-{number}.mph", [raw, entries.tobytes()])
        size = len(raw) + entries.nbytes
        return pa.table({"bucket": [number], "n_keys": [len(slots)], "n_bytes": [size]})

    keyed.groupBy("bucket").applyInArrow(build, "bucket bigint, n_keys bigint, n_bytes bigint").write.parquet(
        f"{path}/index"
    )


def _bucket(key: str, buckets: int):
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("bigint").alias("bucket")


def _read(path: str, name: str) -> bytes | None:
    """The whole of a small file, or None if there is none."""
    system, folder = _files(path)
    if not system.get_file_info(f"{folder}/{name}").is_file:
        return None
    with system.open_input_file(f"{folder}/{name}") as file:
        return file.read()


def look_up(spark: SparkSession, path: str, keys: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, shard, row, first, n_ids, copies for each key of a table that the index has.

    Keys go to the task of their bucket, which holds one index file of bounded size. A key
    that was not written is dropped by its fingerprint (one in 2**32 passes that test; the
    catalog settles such a case if it matters).
    """
    buckets = spark.read.parquet(f"{path}/layout").first()["buckets"]
    wanted = keys.select(F.col(key).cast("bigint").alias("key")).where("key is not null")
    wanted = wanted.select(_bucket("key", buckets), "key")

    def find(group, table):
        import pyarrow as pa

        # A bucket that no written key fell in has no file.
        raw = _read(path, f"index-{group[0].as_py()}.mph") or PerfectHash([], NO_KEYS).dump()
        hashed, at = PerfectHash.load(raw)
        entries = np.frombuffer(raw, ENTRY, offset=at)
        asked = table.column("key").to_numpy()
        slots = hashed.slots(asked)
        known = slots >= 0
        known[known] = entries["print"][slots[known]] == fingerprint(asked[known])
        found = entries[slots[known]]
        names = ("shard", "row", "first", "n_ids", "copies")
        return pa.table(
            {"key": asked[known]} | {n: pa.array(found[n].astype(np.int64)) for n in names}
        )

    shape = "key bigint, shard bigint, row bigint, first bigint, n_ids bigint, copies bigint"
    return wanted.groupBy("bucket").applyInArrow(find, shape)


def read_ids(spark: SparkSession, path: str, places: DataFrame) -> DataFrame:
    """key, start, n_ids, ids (little-endian unsigned 32-bit) from the shard files.

    ``places`` has the columns of ``look_up``. All documents of a key are returned.
    ``start`` is the number of ids before the document in all shards. Each shard file is
    opened by the tasks that have places in it, sorted by position.
    """
    laid = places.select("key", "shard", "row", "first", "copies")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    laid = laid.repartition(tasks, "shard").sortWithinPartitions("shard", "row")
    shape = "key bigint, shard bigint, first bigint, n_ids bigint, ids binary"

    def fetch(batches):
        import pyarrow as pa

        system, folder = _files(path)
        opened, file = None, None
        for batch in batches:
            out, held = {n: [] for n in ("key", "shard", "first", "n_ids", "ids")}, 0
            for key, shard, row, _, copies in zip(*(c.to_pylist() for c in batch.columns)):
                if shard != opened:
                    file = system.open_input_file(f"{folder}/ids-{shard}.bin")
                    size = file.size()
                    n, _, width, magic = struct.unpack(FOOT, file.read_at(FOOT_BYTES, size - FOOT_BYTES))
                    if magic != MAGIC:
                        raise ValueError(f"ids-{shard}.bin is no id file")
                    table = size - FOOT_BYTES - 8 * (n + 1)
                    opened = shard
                firsts = np.frombuffer(file.read_at(8 * (copies + 1), table + 8 * row), "<u8")
                for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist()):
                    ids = np.frombuffer(file.read_at((b - a) * width, a * width), f"<u{width}")
                    for name, value in zip(out, (key, shard, a, b - a, ids.astype("<u4").tobytes())):
                        out[name].append(value)
                    held += len(ids)
                if held > 1 << 21:
                    yield pa.RecordBatch.from_pydict(out, schema=made)
                    out, held = {n: [] for n in out}, 0
            yield pa.RecordBatch.from_pydict(out, schema=made)

    import pyarrow as pa

    made = pa.schema(
        [("key", pa.int64()), ("shard", pa.int64()), ("first", pa.int64()), ("n_ids", pa.int64()), ("ids", pa.binary())]
    )
    bases = spark.read.parquet(f"{path}/shards").select("shard", "base")
    found = laid.mapInArrow(fetch, shape).join(bases, "shard")
    return found.select("key", (F.col("base") + F.col("first")).alias("start"), "n_ids", "ids")


def keyless(spark: SparkSession, path: str) -> DataFrame:
    """The places of documents with a null key, which no index entry names."""
    catalog = spark.read.schema(CATALOG).parquet(f"{path}/catalog").where("key is null")
    return catalog.withColumns(
        {"shard": F.col("shard").cast("bigint"), "copies": F.lit(1).cast("bigint")}
    )


def get(path: str, buckets: int, key: int) -> list:
    """The id arrays of one key, read directly: one index file, then one range."""
    import xxhash

    digest = xxhash.xxh64(struct.pack("<q", key), seed=42).intdigest()
    signed = digest - (1 << 64) if digest >> 63 else digest
    system, folder = _files(path)
    raw = _read(path, f"index-{signed % buckets}.mph")
    if raw is None:
        return []
    hashed, at = PerfectHash.load(raw)
    entries = np.frombuffer(raw, ENTRY, offset=at)
    asked = np.array([key], np.int64)
    slot = hashed.slots(asked)[0]
    if slot < 0 or entries["print"][slot] != fingerprint(asked)[0]:
        return []
    entry = entries[slot]
    with system.open_input_file(f"{folder}/ids-{entry['shard']}.bin") as file:
        size = file.size()
        n, _, width, _ = struct.unpack(FOOT, file.read_at(FOOT_BYTES, size - FOOT_BYTES))
        table = size - FOOT_BYTES - 8 * (n + 1)
        spans = file.read_at(8 * (int(entry["copies"]) + 1), table + 8 * int(entry["row"]))
        firsts = np.frombuffer(spans, "<u8").tolist()
        return [
            np.frombuffer(file.read_at((b - a) * width, a * width), f"<u{width}").astype(np.uint32)
            for a, b in zip(firsts[:-1], firsts[1:])
        ]
