"""Token vectors: per shard, averaged over shards, and their words."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from verbaloom.functions import vectors as vx
from verbaloom.operators.encoding import Vocabulary
from verbaloom.operators.shards import STRIDE, WINDOW_SIZE, pair_weights

# Fixed value: the default vector length.
DIMENSIONS = 100


def _pair_values(shards: DataFrame, dimensions: int, window_size: int, stride: int) -> DataFrame:
    """shard_id, token_id, dim, x, is_first: the value each pair adds to a token's vector.

    The value of a (token, next token) pair is its positive pointwise mutual information
    within the shard, ``max(0, ln(n * total / (n_token * n_next)))``; it is added at
    ``next_id mod dimensions``, with a sign from the next higher digit of the id. Tokens
    without a pair keep a row that adds 0. ``is_first`` is 1 on one row per (shard,
    token). Clustered by shard_id (as ``token_shards`` leaves it) this needs no shuffle.
    """
    # Both windows over a token have the same order, so they share one sort.
    of_token = Window.partitionBy("shard_id", "token_id").orderBy("next_id")
    whole = of_token.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    of_next = Window.partitionBy("shard_id", "next_id")
    information = F.log(F.col("n") * F.col("total") / (F.col("_token") * F.col("_next")))
    sign = F.lit(1) - F.lit(2) * (F.floor(F.col("next_id") / dimensions) % 2)
    return (
        pair_weights(shards, window_size, stride)
        .withColumn("_next", F.sum("n").over(of_next))
        .withColumns(
            {
                "_token": F.sum("n").over(whole),
                "_place": F.row_number().over(of_token),
            }
        )
        .select(
            "shard_id",
            "token_id",
            F.coalesce(F.col("next_id") % dimensions, F.lit(0)).alias("dim"),
            F.when(F.col("n") > 0, F.greatest(information, F.lit(0.0)) * sign)
            .otherwise(F.lit(0.0))
            .alias("x"),
            (F.col("_place") == 1).cast("int").alias("is_first"),
        )
    )


def shard_embeddings(
    shards: DataFrame,
    dimensions: int = DIMENSIONS,
    window_size: int = WINDOW_SIZE,
    stride: int = STRIDE,
) -> DataFrame:
    """shard_id, token_id, embedding: one vector per distinct token per trainable shard."""
    sums = (
        _pair_values(shards, dimensions, window_size, stride)
        .groupBy("shard_id", "token_id", "dim")
        .agg(F.sum("x").alias("x"))
    )
    entries = F.array_sort(F.collect_list(F.struct("dim", "x")))
    grouped = sums.groupBy("shard_id", "token_id").agg(entries.alias("entries"))
    return grouped.select(
        "shard_id", "token_id", vx.dense(F.col("entries"), dimensions).alias("embedding")
    )


def average_shard_embeddings(
    shards: DataFrame,
    dimensions: int = DIMENSIONS,
    window_size: int = WINDOW_SIZE,
    stride: int = STRIDE,
) -> DataFrame:
    """token_id, embedding: each token's mean vector over the shards that hold it.

    Equal to ``mean_embeddings`` of ``shard_embeddings`` without making the vectors of a
    single shard: pair values are summed straight to (token, dimension). The sums are
    partial per task, so a token of every shard costs at most ``dimensions`` rows per
    task in the one shuffle.
    """
    sums = (
        _pair_values(shards, dimensions, window_size, stride)
        .groupBy("token_id", "dim")
        .agg(F.sum("x").alias("x"), F.sum("is_first").alias("shards"))
    )
    grouped = sums.groupBy("token_id").agg(
        F.array_sort(F.collect_list(F.struct("dim", "x"))).alias("entries"),
        F.sum("shards").alias("shards"),
    )
    mean = F.transform(vx.dense(F.col("entries"), dimensions), lambda x: x / F.col("shards"))
    return grouped.select("token_id", mean.alias("embedding"))


def mean_embeddings(
    df: DataFrame, keys: list[str], embedding: str = "embedding"
) -> DataFrame:
    """keys, embedding: elementwise mean of all vectors of a key.

    No rows in, no rows out. Vectors of unequal length under one key, and null elements,
    are errors; a null vector counts as one without elements, which adds nothing.
    """
    vector = F.col(embedding).cast("array<double>")
    some = df.where(F.size(vector) > 0).select(*keys, vector.alias("v"))
    uneven = F.raise_error(F.lit("vectors of unequal length, or null elements, under one key"))
    missing = F.exists("v", lambda x: x.isNull())
    whole = F.when(missing, uneven.cast("array<double>")).otherwise(F.col("v"))
    # Whole vectors are summed per task before the shuffle.
    grouped = some.groupBy(*keys).agg(
        Summarizer.sum(array_to_vector(whole)).alias("total"), F.count("*").alias("n")
    )
    mean = F.transform(vector_to_array("total"), lambda x: x / F.col("n"))
    return grouped.select(*keys, mean.alias("embedding"))


def with_words(vectors: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Add the decoded word of each token id. An id that the rank file lacks is an error.
    Spark broadcasts the rank file if it is small enough, and shuffles it otherwise."""
    found = vectors.join(vocabulary.tokens(), "token_id", "left")
    unknown = F.concat(F.lit("no such token: "), F.col("token_id").cast("string"))
    return found.withColumn("word", F.coalesce("word", F.raise_error(unknown).cast("string")))
