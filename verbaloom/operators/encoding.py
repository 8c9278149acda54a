"""Words to byte-pair token ids and back, and the ordered token stream."""

from __future__ import annotations

import base64
from array import array

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verbaloom.functions import text as tx
from verbaloom.operators.ordinals import whole_div, with_offsets
from verbaloom.operators.words import numbered

# A vocabulary is broadcast, so its size is checked against this bound.
MAX_VOCABULARY = 1 << 19
# Tokens whose pairs, sorts and counts are one task's working set.
TASK_TOKENS = 1 << 20
# A batch's distinct words are encoded so many at a time; a worker remembers so many words, none of
# them longer than so many characters: some 70 MB.
SLICE_WORDS, MEMO_WORDS, MEMO_LENGTH = 1 << 16, 1 << 18, 32


class Vocabulary:
    """A rank file: one ``base64(token bytes) rank`` line per token, and the pattern that
    splits a word before its bytes are merged."""

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        self.spark = spark
        self.path = path
        self.pattern = pattern
        self._shipped = None

    def tokens(self) -> DataFrame:
        """token_id, word: what each id decodes to.

        Bytes that are not whole UTF-8 characters become U+FFFD, as in a decoder.
        """
        parts = F.split("value", " ")
        return self.spark.read.text(self.path).select(
            parts[1].cast("int").alias("token_id"),
            F.make_valid_utf8(F.unbase64(parts[0]).cast("string")).alias("word"),
        )

    def encode(self, words: Column) -> Column:
        """``array<string>`` to ``array<array<int>>``: the ids of each word on its own.

        No row is shuffled. An Arrow batch is first reduced to its distinct words, and
        each Python worker remembers the words it has met, so the encoder itself sees
        a word about once per worker.
        """
        shape = T.ArrayType(T.ArrayType(T.IntegerType(), False), False)
        return F.arrow_udf(_batch_encoder(self._broadcast(), flat=False), shape)(words)

    def encode_flat(self, words: Column) -> Column:
        """``array<string>`` to ``array<int>``: the ids of all words, one after another."""
        shape = T.ArrayType(T.IntegerType(), False)
        return F.arrow_udf(_batch_encoder(self._broadcast(), flat=True), shape)(words)

    def check_size(self) -> None:
        """Fail if the rank file is too large to broadcast."""
        self._load()

    def _load(self) -> list:
        lines = self.spark.read.text(self.path).limit(MAX_VOCABULARY + 1).collect()
        if len(lines) > MAX_VOCABULARY:
            raise ValueError(f"{self.path}: more than {MAX_VOCABULARY} tokens")
        return lines

    def _broadcast(self):
        if self._shipped is None:
            pairs = (line.value.split(" ") for line in self._load())
            ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
            state = {"pattern": self.pattern, "ranks": ranks}
            self._shipped = self.spark.sparkContext.broadcast(state)
        return self._shipped


def _batch_encoder(shipped, flat: bool):
    """The function run on executors; it needs only numpy, pyarrow and tiktoken there."""
    def encode(batch):
        import numpy as np
        import pyarrow as pa
        import tiktoken

        # One copy per Python worker; the codec and its memo live as long as the worker.
        state = shipped.value
        if "codec" not in state:
            state["codec"] = tiktoken.Encoding(
                "words",
                pat_str=state["pattern"],
                mergeable_ranks=state["ranks"],
                special_tokens={},
            )
            state["memo"] = {}
        codec, memo = state["codec"], state["memo"]

        # Only one slice's words and ids are Python objects at a time, however long the batch.
        words, parts = batch.flatten().dictionary_encode(), []
        for first in range(0, max(len(words.dictionary), 1), SLICE_WORDS):
            ids = []
            for word in words.dictionary.slice(first, SLICE_WORDS).to_pylist():
                found = memo.get(word)
                if found is None:
                    found = array("i", codec.encode_ordinary(word))
                    if len(memo) < MEMO_WORDS and len(word) <= MEMO_LENGTH:
                        memo[word] = found
                ids.append(found)
            ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
            flat_ids = np.frombuffer(b"".join(ids), dtype=np.int32)
            parts.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(flat_ids)))
        encoded = pa.concat_arrays(parts).take(words.indices)
        lengths = batch.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
        if flat:
            counts = encoded.value_lengths().to_numpy()
            ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)[ends]
            encoded = encoded.flatten()
        return pa.ListArray.from_arrays(pa.array(ends), encoded)

    return encode


def encode_texts(
    df: DataFrame, keys: list[str], vocabulary: Vocabulary, text: str = "text"
) -> DataFrame:
    """keys, words, word_ids: the white-space words of each text and their token ids.

    Stage this table before it is read more than once: it is the costly step.
    """
    split = df.select(*keys, tx.whitespace_words(F.col(text)).alias("words"))
    return split.withColumn("word_ids", vocabulary.encode(F.col("words")))


def encode_tokens(
    df: DataFrame, keys: list[str], vocabulary: Vocabulary, text: str = "text"
) -> DataFrame:
    """keys, tokens: the token ids of each text in order, for the token stream.

    Stage this table too before it is read more than once.
    """
    words = tx.whitespace_words(F.col(text))
    return df.select(*keys, vocabulary.encode_flat(words).alias("tokens"))


def encode_counts(counts: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """word, token_ids, n from word, n: ids depend on the word alone, so words are
    counted first and each is encoded once."""
    ids = vocabulary.encode(F.array("word"))[0]
    return counts.select("word", ids.alias("token_ids"), "n")


def encode_words(words: DataFrame, vocabulary: Vocabulary, word: str = "word") -> DataFrame:
    """Add token_ids to a table with one word per row, such as imported positioned words."""
    return words.withColumn("token_ids", vocabulary.encode(F.array(word))[0])


def tokenized_words(encoded: DataFrame, keys: list[str]) -> DataFrame:
    """keys, position, word, token_ids: the corpus in order, words numbered from 0."""
    count = F.col("n_words") if "n_words" in encoded.columns else F.size("words")
    placed = with_offsets(encoded, keys, {"_first": count})
    pairs = F.arrays_zip("words", "word_ids")
    return numbered(placed, [*keys, "_first"], pairs, "_i", "_pair").select(
        *keys,
        (F.col("_first") + F.col("_i")).alias("position"),
        F.col("_pair.words").alias("word"),
        F.col("_pair.word_ids").alias("token_ids"),
    )


def _n_tokens(texts: DataFrame):
    """A staged table brings the counts of its ids, so that ids are read once."""
    return F.col("n_tokens") if "n_tokens" in texts.columns else F.size("tokens")


def token_stream(texts: DataFrame, keys: list[str]) -> DataFrame:
    """token_pos, token_id from keys, tokens: all ids in order, numbered from 0."""
    placed = with_offsets(texts, keys, {"_first": _n_tokens(texts)})
    return numbered(placed, ["_first"], F.col("tokens"), "_i", "token_id").select(
        (F.col("_first") + F.col("_i")).alias("token_pos"), "token_id"
    )


def _partitions(texts: DataFrame) -> int:
    """How many tasks hold all tokens, so that no task grows with the corpus. Tables that do
    not bring counts have Spark's number."""
    known = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if "n_tokens" not in texts.columns:
        return known
    total = texts.agg(F.sum("n_tokens").alias("n")).first().n or 0
    return max(known, -(-total // TASK_TOKENS))


def token_shards(
    texts: DataFrame, keys: list[str], tokens_per_shard: int, first_shard: int = 1
) -> DataFrame:
    """shard_id (from ``first_shard``), tokens: the stream cut into shards of a fixed token count.

    A shard is one row: its length is bounded by ``tokens_per_shard``. Texts are cut
    into the pieces that fall in each shard while they are still arrays, so a text of
    any length spreads over many tasks and the shuffle carries arrays, not single ids.

    If the texts bring their counts (``n_tokens``), shards lie in as many partitions as
    ``TASK_TOKENS`` asks for: whatever is made of them there is bounded.
    """
    if tokens_per_shard <= 0:
        raise ValueError("tokens_per_shard must be positive")
    size = F.lit(tokens_per_shard).cast("bigint")
    placed = with_offsets(texts, keys, {"_first": _n_tokens(texts)})
    first, tokens = F.col("_first"), F.col("tokens")
    end = first + F.size(tokens)

    def piece(shard):
        start = F.greatest(shard * size, first)
        stop = F.least((shard + 1) * size, end)
        return F.struct(
            shard.alias("shard"),
            start.alias("start"),
            F.slice(
                tokens, (start - first + 1).cast("int"), (stop - start).cast("int")
            ).alias("ids"),
        )

    shards = F.sequence(whole_div(first, size), whole_div(end - 1, size))
    pieces = F.when(F.size(tokens) > 0, F.transform(shards, piece))
    # Non-null by type: a join of shards with others adds no null filter to one side only, which
    # would stop the shuffle's reuse.
    number = F.coalesce(F.col("_piece.shard") + first_shard, F.lit(0).cast("bigint"))
    cut = numbered(placed, [], pieces, "_i", "_piece").select(
        number.alias("shard_id"),
        F.struct("_piece.start", "_piece.ids").alias("_part"),
    )
    in_order = F.array_sort(F.collect_list("_part"))
    return cut.repartition(_partitions(texts), "shard_id").groupBy("shard_id").agg(
        F.flatten(F.transform(in_order, lambda part: part["ids"])).alias("tokens")
    )
