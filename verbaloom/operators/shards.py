"""Token shards: vocabulary, windows, training samples and next-token pairs.

Input is a shard table (``shard_id``, ``tokens``), one bounded array per shard. Clustered
by ``shard_id`` (as ``token_shards`` leaves it) nothing here needs another shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verbaloom.operators.words import numbered

# The default window settings.
WINDOW_SIZE = 8
STRIDE = 2
# Windows that are cut from one row.
RUN_WINDOWS = 512


def shard_vocabulary(shards: DataFrame) -> DataFrame:
    """shard_id, token_index, token_id: distinct tokens numbered by first appearance."""
    return numbered(
        shards, ["shard_id"], F.array_distinct("tokens"), "token_index", "token_id"
    )


def indexed_shards(shards: DataFrame) -> DataFrame:
    """shard_id, tokens, indices: each token with its index in the shard's vocabulary.

    Numbers a whole shard array at once in Arrow. Windows or a vocabulary join say the
    same, but sort or shuffle one row per token of the corpus.
    """
    number = F.arrow_udf(_first_seen_numbers(), T.ArrayType(T.IntegerType(), False))
    return shards.select("shard_id", "tokens", number("tokens").alias("indices"))


def _first_seen_numbers():
    """The function run on executors; it needs only numpy and pyarrow there."""

    def number(batch):
        import numpy as np
        import pyarrow as pa

        # Numbers take the place of the tokens of one flat array, so a batch is held twice.
        ends = np.cumsum([0, *batch.value_lengths().fill_null(0).to_pylist()], dtype=np.int32)
        found = np.empty(ends[-1], dtype=np.int32)
        flat = batch.flatten().to_numpy()
        for begin, end in zip(ends[:-1], ends[1:]):
            _, first, place = np.unique(flat[begin:end], return_index=True, return_inverse=True)
            rank = np.empty(len(first), dtype=np.int32)
            rank[np.argsort(first)] = np.arange(len(first), dtype=np.int32)
            found[begin:end] = rank[place]
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(found))

    return number


def indexed_tokens(shards: DataFrame) -> DataFrame:
    """shard_id, token_pos, token_id, token_index: one row per token."""
    pairs = F.arrays_zip("tokens", "indices")
    return numbered(indexed_shards(shards), ["shard_id"], pairs, "token_pos", "_pair").select(
        "shard_id",
        "token_pos",
        F.col("_pair.tokens").alias("token_id"),
        F.col("_pair.indices").alias("token_index"),
    )


def window_pairs(
    shards: DataFrame, window_size: int = WINDOW_SIZE, stride: int = STRIDE
) -> DataFrame:
    """shard_id, sample_idx, input, target: windows and the same windows one token on.

    Only full pairs: ``floor((n - 1 - window) / stride) + 1`` of them in a shard of n
    tokens, none if n <= window.
    """
    tokens = F.col("tokens")
    last = F.size(tokens) - 1 - window_size
    # Runs of so many windows first, so that a row to cut windows from is short.
    run = RUN_WINDOWS * stride
    runs = F.sequence(F.lit(0), F.greatest(last, F.lit(0)), F.lit(run))
    cut = F.when(
        last >= 0, F.transform(runs, lambda s: F.slice(tokens, s + 1, run - stride + window_size + 1))
    )
    cut = numbered(shards, ["shard_id"], cut, "_run", "_all")
    starts = F.sequence(F.lit(0), F.size("_all") - 1 - window_size, F.lit(stride))
    sample = F.col("_run") * RUN_WINDOWS + F.col("_i")
    return _windows(cut, ["shard_id"], ["_run"], starts, window_size, sample)


def _windows(
    df: DataFrame, keep: list[str], place: list[str], starts: Column, window_size: int, sample: Column
) -> DataFrame:
    """keep, sample_idx, input, target: the windows of ``_all`` at an array of starts.

    Starts are laid out, not windows made inside the array: that is a lambda, which Spark
    does not compile.
    """
    laid_out = df.select(*keep, *place, "_all", F.posexplode_outer(starts).alias("_i", "_start"))
    laid_out = laid_out.where(F.col("_start").isNotNull())
    return laid_out.select(
        *keep,
        sample.alias("sample_idx"),
        F.slice("_all", F.col("_start") + 1, window_size).alias("input"),
        F.slice("_all", F.col("_start") + 2, window_size).alias("target"),
    )


def piece_window_pairs(
    pieces: DataFrame,
    piece_size: int,
    window_size: int = WINDOW_SIZE,
    stride: int = STRIDE,
    sequence: str = "shard_id",
) -> DataFrame:
    """sequence, sample_idx, input, target: the window pairs of sequences longer than a row.

    ``pieces`` has a sequence's tokens as rows (sequence, piece from 0, tokens), each of
    ``piece_size`` but the last. Each piece gets the first ``window_size`` + 1 tokens of the
    next one beside its own, so windows cross borders, and makes those that begin in it:
    the pairs are those of ``window_pairs`` over the whole sequence, and no row holds more
    than a piece and its halo.

    The hint makes the narrow halos the hashed side: pieces are not sorted, and do not move if
    they lie by their number already, as ``token_shards`` leaves them.
    """
    if piece_size <= window_size:
        raise ValueError("a piece must be longer than a window")
    halo = pieces.select(
        sequence, (F.col("piece") - 1).alias("piece"), F.slice("tokens", 1, window_size + 1).alias("_halo")
    )
    joined = pieces.join(halo.hint("shuffle_hash"), [sequence, "piece"], "left")
    own = joined.withColumn(
        "_all", F.concat("tokens", F.coalesce("_halo", F.array().cast(pieces.schema["tokens"].dataType)))
    )
    begin = F.col("piece") * F.lit(piece_size).cast("bigint")
    # The first window start in the piece, and the last that it has all tokens for.
    first = F.pmod(-begin, F.lit(stride)).cast("int")
    last = F.least(F.size("tokens") - 1, F.size("_all") - 1 - window_size)
    starts = F.when(last >= first, F.sequence(first, F.greatest(last, first), F.lit(stride)))
    sample = F.call_function("div", begin + F.col("_start"), F.lit(stride).cast("bigint"))
    return _windows(own, [sequence], ["piece"], starts, window_size, sample)


def training_table(
    shards: DataFrame, window_size: int = WINDOW_SIZE, stride: int = STRIDE
) -> DataFrame:
    """shard_id, sample_idx, input, target over vocabulary indices, ready to write."""
    indexed = indexed_shards(shards).select("shard_id", F.col("indices").alias("tokens"))
    return window_pairs(indexed, window_size, stride)


def trainable_shards(shards: DataFrame, window_size: int = WINDOW_SIZE) -> DataFrame:
    """Shards with at least one window pair; the others are skipped."""
    return shards.where(F.size("tokens") > window_size)


def pair_weights(
    shards: DataFrame, window_size: int = WINDOW_SIZE, stride: int = STRIDE
) -> DataFrame:
    """shard_id, token_id, next_id, n, total for every token of a trainable shard.

    ``n`` is how often the window pairs hold ``token_id`` as input with ``next_id`` as
    its target. A position lies in as many windows as there are starts that cover it, so
    positions are weighted instead of laying the overlapping windows out. Tokens that no
    window covers keep a row with n = 0 (and a null ``next_id`` at the shard's end).
    ``total`` is the number of pairs in the shard.
    """
    usable = trainable_shards(shards, window_size)
    following = F.slice("tokens", F.lit(2), F.size("tokens"))
    zipped = F.arrays_zip(F.col("tokens").alias("a"), following.alias("b"))
    steps = numbered(
        usable.select("shard_id", F.size("tokens").alias("_n"), zipped.alias("_steps")),
        ["shard_id", "_n"],
        F.col("_steps"),
        "_p",
        "_step",
    )
    last_start = F.floor((F.col("_n") - 1 - window_size) / stride)
    return (
        steps.select(
            "shard_id",
            F.col("_step.a").alias("token_id"),
            F.col("_step.b").alias("next_id"),
            _covering_windows(F.col("_p"), last_start, window_size, stride).alias("_windows"),
            ((last_start + 1) * window_size).alias("_total"),
        )
        .groupBy("shard_id", "token_id", "next_id")
        .agg(F.sum("_windows").alias("n"), F.max("_total").alias("total"))
    )


def pair_counts(
    shards: DataFrame, window_size: int = WINDOW_SIZE, stride: int = STRIDE
) -> DataFrame:
    """shard_id, token_id, next_id, n: next-token pair counts over all window pairs."""
    return pair_weights(shards, window_size, stride).where("n > 0").drop("total")


def _covering_windows(position: Column, last: Column, window_size: int, stride: int) -> Column:
    """How many window starts ``0, stride, ..., last * stride`` cover a position."""
    newest = F.least(F.floor(position / stride), last)
    oldest = F.ceil(F.greatest(position - (window_size - 1), F.lit(0)) / stride)
    return F.greatest(newest - oldest + 1, F.lit(0))
