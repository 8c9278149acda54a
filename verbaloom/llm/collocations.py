"""Phrase collocations by dynamic itemset counting (operator 12).

Phrases of all lengths are counted in one run of shard scans (Brin, Motwani, Ullman and Tsur,
SIGMOD 1997). The corpus is dealt into shards, which are scanned in a circle:

* words are counted from the first scan on;
* a longer phrase is counted from the scan after the one in which the last of its two
  subphrases (without its last word, without its first) reached the threshold;
* each phrase is counted for one full cycle from there, so in each shard once, and is
  dropped after that if it has not reached the threshold itself. The run ends when no
  phrase is left to count.

A scan knows which phrases have reached the threshold, and when, from two tables of a byte
per hash bucket, of fixed size whatever the corpus: a phrase counts as reached when its
buckets in both are. They and the 32-bit word codes of the scans may only add phrases, never
lose one. A last pass counts the phrases that are left by their words
as they are written, so that counts are exact.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from verbaloom.llm.common import whole_slices
from verbaloom.llm.word_arrays import mix
from verbaloom.sources.tables import drop_path, new_path, stage

LONGEST, LEAST, TOP = 5, 100, 2000
NO_LANG = "und"
# Shards of a cycle.
SHARDS = 4
# Tables of reached phrases, and buckets of each, a byte each; NEVER is no step of a run.
TABLES, BUCKET_BITS, NEVER = 2, 23, 255
BLOCK_BITS = 16
# Counted phrases that a task holds before it passes them on.
HELD = 1 << 18
PHRASES = 400_000
# Words that a task of the last pass reads at least, if all cores have two such tasks: each
# task gives a row for each phrase it meets, so more text a task is fewer rows.
TASK_WORDS = 1 << 24
SLICE_BYTES = 2 << 20
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
# 0 in a word, 1 between words, 2 between pieces.
_KIND = np.zeros(256, np.uint8)
_KIND[[32, 9]] = 1
_KIND[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = 2


def cut_words(texts: list[bytes]):
    """The words of some texts as an Arrow array, and the piece each lies in."""
    import pyarrow as pa

    flat = np.frombuffer(b"\n".join(texts).translate(_LOWER) + b"\n", np.uint8)
    kind = _KIND[flat]
    inside = kind == 0
    edge = np.diff(inside.astype(np.int8), prepend=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    offsets = np.concatenate([[0], np.cumsum(ends - starts)])
    buffers = [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(flat[inside])]
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), buffers)
    return words, np.cumsum(kind == 2)[starts]


def _by_lang(part):
    """The texts of each language in a batch of lang, text."""
    texts = {}
    for lang, text in zip(part.column(0).to_pylist(), part.column(1)):
        held = texts.setdefault(NO_LANG if lang is None else lang, [])
        if text.is_valid:
            held.append(text.as_buffer().to_pybytes())
    return texts


def _codes(words: list[bytes], lang: str):
    """A code of 32 bits for each word of a language, never 0."""
    seeded = hashlib.blake2b(lang.encode() + b"\0", digest_size=4)
    found = bytearray()
    for word in words:
        own = seeded.copy()
        own.update(word)
        found += own.digest()
    return np.maximum(np.frombuffer(bytes(found), "<u4"), 1)


def _stage_codes(docs: DataFrame, path: str) -> None:
    """Write lang, n_words, codes: word codes of slices, a 0 between pieces, by shard.

    A task deals its slices to the shards in turn.
    """

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        turn = TaskContext.get().partitionId()
        for part in whole_slices(batches, "text", SLICE_BYTES // SHARDS):
            turn += 1
            for lang, texts in _by_lang(part).items():
                words, piece = cut_words(texts)
                coded = words.dictionary_encode()
                known = _codes(coded.dictionary.to_pylist(), lang)
                apart = np.cumsum(np.diff(piece, prepend=piece[:1]) != 0)
                codes = np.zeros(len(piece) + (int(apart[-1]) if len(apart) else 0), "<u4")
                codes[np.arange(len(piece)) + apart] = known[coded.indices.to_numpy()]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([turn % SHARDS], pa.int32()),
                        pa.array([lang]),
                        pa.array([len(piece)], pa.int64()),
                        pa.array([codes.tobytes()], pa.binary()),
                    ],
                    ["shard", "lang", "n_words", "codes"],
                )

    shape = "shard int, lang string, n_words bigint, codes binary"
    docs.mapInArrow(run, shape).write.partitionBy("shard").parquet(path)


def _read_codes(spark: SparkSession, path: str) -> DataFrame:
    shape = "lang string, n_words bigint, codes binary, shard int"
    return spark.read.schema(shape).parquet(path)


def _bits(reached) -> int:
    return reached.shape[1].bit_length() - 1


def _when(keys, reached):
    """The step in which a phrase counted as reached, or NEVER."""
    bits = _bits(reached)
    when = np.zeros(len(keys), np.uint8)
    for number, table in enumerate(reached):
        bucket = (keys >> np.uint64(64 - bits * (number + 1))) & np.uint64((1 << bits) - 1)
        when = np.maximum(when, table[bucket.astype(np.int64)])
    return when


def _longer(keys, codes):
    """Keys of phrases, from those of their first words and the code of the last word."""
    return mix((keys ^ codes) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))


def scan(codes, reached, step: int):
    """Keys and first steps of the phrases that a sequence of codes has at this step.

    A phrase is there once for each occurrence. ``reached`` gives the step in which each
    bucket's first phrase reached the threshold.
    """
    codes = codes.astype(np.uint64)
    at = np.flatnonzero(codes)
    keys = mix(codes[at] + np.uint64(0x632BE59BD9B4E019))
    found, starts = [], []
    if step < SHARDS:
        found.append(keys)
        starts.append(np.zeros(len(keys), np.uint8))
    for length in range(2, LONGEST + 1):
        when = _when(keys, reached)
        # A phrase and the next one in the same piece, both of the length before.
        both = np.flatnonzero((np.diff(at) == 1) & (when[:-1] != NEVER) & (when[1:] != NEVER))
        last = at[both] + length - 1
        inside = last < len(codes)
        both, last = both[inside], last[inside]
        start = np.maximum(when[both], when[both + 1]) + 1
        keys, at = _longer(keys[both], codes[last]), at[both]
        active = (start <= step) & (step < start.astype(np.int64) + SHARDS)
        found.append(keys[active])
        starts.append(start[active].astype(np.uint8))
    return np.concatenate(found), np.concatenate(starts)


def _merge(keys, starts, counts):
    """Each key once, with its start and the sum of its counts."""
    order = np.argsort(keys, kind="stable")
    keys, starts, counts = keys[order], starts[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], starts[first], np.add.reduceat(counts, first)


def _scan_shard(codes: DataFrame, shipped, step: int) -> DataFrame:
    """key, start, n: the phrases counted in the shard of this step, partly summed."""
    shard = codes.where(F.col("shard") == step % SHARDS).select("codes")

    def run(batches):
        import pyarrow as pa

        held, size = [], 0

        def emit():
            keys, starts, counts = _merge(*(np.concatenate(x) for x in zip(*held)))
            return pa.RecordBatch.from_arrays(
                [pa.array(keys.view(np.int64)), pa.array(starts.astype(np.int32)), pa.array(counts)],
                ["key", "start", "n"],
            )

        for batch in batches:
            for raw in batch.column(0):
                codes = np.frombuffer(raw.as_buffer(), "<u4")
                keys, starts = scan(codes, shipped.value, step)
                if len(keys):
                    held.append(_merge(keys, starts, np.ones(len(keys), np.int64)))
                    size += len(held[-1][0])
                if size > HELD:
                    merged = _merge(*(np.concatenate(x) for x in zip(*held)))
                    held, size = [merged], len(merged[0])
                    if size > HELD // 2:
                        yield emit()
                        held, size = [], 0
        if held:
            yield emit()

    return shard.mapInArrow(run, "key bigint, start int, n bigint")


def _mark(counted: DataFrame, reached, step: int, least: int) -> int:
    """Note the buckets whose first phrase reached the threshold in this step; how many."""
    bits, blocks = _bits(reached), reached.shape[1] >> BLOCK_BITS
    entries = F.array(
        *(
            F.expr(f"shiftrightunsigned(key, {64 - bits * (k + 1)}) & {(1 << bits) - 1}") + (k << bits)
            for k in range(TABLES)
        )
    )
    rows = counted.where(F.col("n") >= least).select(F.explode(entries).alias("bucket"))
    rows = rows.select(F.shiftright("bucket", BLOCK_BITS).alias("block"), "bucket")

    def pack(group, table):
        import pyarrow as pa

        bits = np.zeros(1 << BLOCK_BITS, np.uint8)
        bits[table.column("bucket").to_numpy() % (1 << BLOCK_BITS)] = 1
        return pa.table({"block": [group[0].as_py()], "bits": [np.packbits(bits).tobytes()]})

    # At most a row per block comes back: a bit per bucket, whatever the corpus.
    new = 0
    packed = rows.distinct().groupBy("block").applyInArrow(pack, "block bigint, bits binary")
    for row in packed.collect():
        found = np.unpackbits(np.frombuffer(row.bits, np.uint8)).astype(bool)
        table, block = divmod(row.block, blocks)
        part = reached[table, block << BLOCK_BITS : (block + 1) << BLOCK_BITS]
        found &= part == NEVER
        part[found] = step
        new += int(found.sum())
    return new


def count_phrases(spark: SparkSession, path: str, least: int, bucket_bits: int = BUCKET_BITS):
    """The tables of reached phrases after all scans, and the number of scans."""
    reached = np.full((TABLES, 1 << max(bucket_bits, BLOCK_BITS)), NEVER, np.uint8)
    step, last_new, before = 0, 0, None
    while step < SHARDS or step <= last_new + SHARDS:
        shipped = spark.sparkContext.broadcast(reached)
        scanned = _scan_shard(_read_codes(spark, path), shipped, step)
        if before:
            # Phrases whose cycle is over have been marked, or are dropped here.
            still = spark.read.parquet(before).where(F.col("start") + SHARDS > step)
            scanned = scanned.unionByName(still)
        after = new_path(spark, f"phrases-{step}")
        scanned.groupBy("key").agg(F.min("start").alias("start"), F.sum("n").alias("n")).write.parquet(after)
        shipped.destroy()
        if before:
            drop_path(spark, before)
        before = after
        if _mark(spark.read.parquet(after), reached, step, least):
            last_new = step
        step += 1
    drop_path(spark, before)
    return reached, step


def _exact_counts(docs: DataFrame, reached, least: int) -> DataFrame:
    """lang, words, phrase, n of all phrases of ``least`` occurrences, by their words."""
    shipped = docs.sparkSession.sparkContext.broadcast(reached)

    def run(batches):
        import pyarrow as pa

        counted = {}

        def emit():
            for lang, found in counted.items():
                phrases = pa.array(found.keys(), pa.binary()).cast(pa.string())
                numbers = pa.array(found.values(), pa.int64())
                langs = pa.array([lang], pa.string()).take(pa.array(np.zeros(len(found), np.int64)))
                yield pa.RecordBatch.from_arrays([langs, phrases, numbers], ["lang", "phrase", "n"])

        for part in whole_slices(batches, "text", SLICE_BYTES):
            for lang, texts in _by_lang(part).items():
                found = counted.setdefault(lang, {})
                for phrase, n in _slice_phrases(texts, lang, shipped.value):
                    found[phrase] = found.get(phrase, 0) + n
            if sum(map(len, counted.values())) > PHRASES:
                yield from emit()
                counted.clear()
        yield from emit()

    rows = docs.mapInArrow(run, "lang string, phrase string, n bigint")
    summed = rows.groupBy("lang", "phrase").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    return summed.withColumn("words", F.size(F.split("phrase", " ")))


def _slice_phrases(texts: list[bytes], lang: str, reached):
    """phrase, n: the phrases of some texts that may have reached the threshold.

    Within a slice a phrase has a number of its own, not a hash: that of the pair of the
    phrase without its last word and of that word.
    """
    words, piece = cut_words(texts)
    if not len(words):
        return
    coded = words.dictionary_encode()
    word = coded.indices.to_numpy().astype(np.int64)
    names = coded.dictionary.to_pylist()
    codes = _codes(names, lang).astype(np.uint64)[word]
    at, number = np.arange(len(word)), word
    keys = mix(codes + np.uint64(0x632BE59BD9B4E019))
    for length in range(1, LONGEST + 1):
        kept = np.flatnonzero(_when(keys, reached) != NEVER)
        at, number, keys = at[kept], number[kept], keys[kept]
        if not len(at):
            return
        distinct, first, number, counts = np.unique(
            number, return_index=True, return_inverse=True, return_counts=True
        )
        for i, n in zip(at[first].tolist(), counts.tolist()):
            yield b" ".join(names[w] for w in word[i : i + length].tolist()), n
        # The next word, if it lies in the piece; the phrase that begins one on is there too.
        following = np.flatnonzero(np.diff(at) == 1)
        last = at[following] + length
        inside = last < len(word)
        following, last = following[inside], last[inside]
        same = piece[at[following]] == piece[last]
        following, last = following[same], last[same]
        at, keys = at[following], _longer(keys[following], codes[last])
        number = number[following] * len(names) + word[last]


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    least: int = LEAST,
    top: int = TOP,
    bucket_bits: int = BUCKET_BITS,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the phrases of 2 to 5 words that hold together best.

    Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends, and these into
    words at spaces and tabs. Phrases lie within a piece; overlapping occurrences all count.
    ``a`` is the phrase's number of occurrences, ``least`` at least, ``n`` that of all words of
    the language. A phrase is cut after each of its words but the last; ``l`` and ``r`` are the
    occurrences of both parts of the cut with the least score floor(1000 a n / (l r)), the
    first such. A phrase that a longer one contains as often as it occurs is left out. Each
    language's first ``top`` are ranked by score, occurrences and phrase (in byte order), so
    there are no ties.

    A null language counts as ``und``, a null text as empty. Repeated rows count each time. No
    row for an empty table or for languages without such phrases. Other columns, whatever
    their names, are not read. ``bucket_bits`` sets the size of the tables of reached phrases,
    2**bucket_bits bytes: in fuller ones more phrases are counted, the rows are the same.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))
    path = new_path(spark, "word-codes")
    _stage_codes(rows, path)
    totals = _read_codes(spark, path).groupBy("lang").agg(F.sum("n_words").alias("n"))
    reached, _ = count_phrases(spark, path, least, bucket_bits)
    n_words = totals.agg(F.sum("n")).first()[0] or 0
    tasks = max(2 * spark.sparkContext.defaultParallelism, n_words // TASK_WORDS)
    counted = stage(_exact_counts(rows.coalesce(tasks), reached, least), "phrases")
    return _ranked(counted, totals, top)


def _joined(words, first, size):
    return F.array_join(F.slice(words, first, size), " ")


def _ranked(counted: DataFrame, totals: DataFrame, top: int) -> DataFrame:
    phrases = counted.where("words >= 2").select(
        "lang", "phrase", "words", F.col("n").alias("a"), F.split("phrase", " ").alias("w")
    )
    # Every shorter phrase inside a phrase, with the most occurrences of one that has it.
    spans = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.col("words") - 1),
            lambda size: F.transform(
                F.sequence(F.lit(1), F.col("words") - size + 1), lambda i: _joined("w", i, size)
            ),
        )
    )
    inside = (
        phrases.where("words > 2")
        .select("lang", F.explode(F.array_distinct(spans)).alias("phrase"), "a")
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("longer"))
    )
    free = phrases.join(inside, ["lang", "phrase"], "left").where("longer IS NULL OR longer < a")
    cut = free.join(totals, "lang").select(
        "lang", "phrase", "a", "n", "w", "words", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")
    )
    cut = cut.select(
        "lang", "phrase", "a", "n", "k",
        _joined("w", F.lit(1), F.col("k")).alias("head"),
        _joined("w", F.col("k") + 1, F.col("words") - F.col("k")).alias("tail"),
    )
    known = counted.select("lang", "phrase", "n")
    heads = known.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l"))
    tails = known.select("lang", F.col("phrase").alias("tail"), F.col("n").alias("r"))
    whole = "decimal(20,0)"
    up = F.lit(1000).cast("decimal(4,0)") * F.col("a").cast("decimal(17,0)") * F.col("n").cast("decimal(17,0)")
    down = F.col("l").cast("decimal(18,0)") * F.col("r").cast(whole)
    scored = cut.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"])
    scored = scored.withColumn("score", F.call_function("div", up, down))
    lowest = scored.groupBy("lang", "phrase").agg(
        F.first("a").alias("a"), F.first("n").alias("n"), F.min(F.struct("score", "k", "l", "r")).alias("cut")
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    made = lowest.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    ranked = made.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
