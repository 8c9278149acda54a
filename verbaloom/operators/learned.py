"""Token vectors learned from the pairs of all shards, by block power iteration."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verbaloom.operators.shards import STRIDE, WINDOW_SIZE, pair_weights
from verbaloom.sources.tables import stage

STEPS = 2
# A column that keeps less than this share of its length beside those before it is none.
INDEPENDENT = 1e-12
# The numbers behind a start vector's elements.
_PRIME, _A, _B, _C, _D = 2147483647, 7919, 104729, 12345, 1103515245


def learned_vectors(
    shards: DataFrame,
    dimensions: int,
    window_size: int = WINDOW_SIZE,
    stride: int = STRIDE,
    steps: int = STEPS,
) -> DataFrame:
    """token_id, embedding: every token of a trainable shard with its row of an orthonormal
    basis, of ``dimensions`` columns, of the space in which next tokens tell tokens apart best.

    The table of pair information M (positive pointwise mutual information of next-token pairs
    over all shards) is sparse and stays one: a step multiplies the block of vectors by M
    transposed and by M, as two joins with partial sums of whole vectors, then makes its columns
    orthonormal. For that only the products of the columns with each other come to the driver.
    After a few steps the columns span nearly the leading left singular vectors of M. Each step
    is written, so a lost executor repeats one step only.

    The start is a fixed function of token and column, so equal shards give equal vectors.
    Tokens without a pair, and columns beyond the rank of M, are zero. No rows in, no rows out.
    """
    if dimensions < 1 or steps < 1:
        raise ValueError("dimensions and steps must be positive")
    counted = stage(pair_weights(shards, window_size, stride), "pair-weights")
    pairs = stage(pair_information(counted), "pair-information")
    tokens = counted.select("token_id").distinct()
    block = tokens.select("token_id", _start(dimensions).alias("v"))
    for step in range(steps):
        there = _times(pairs, block, "token_id", "next_id", dimensions)
        back = stage(_times(pairs, there, "next_id", "token_id", dimensions), f"block-{step}")
        block = _combined(back, inverse_factor(column_products(back, dimensions)))
    zero = F.array_repeat(F.lit(0.0), dimensions)
    return tokens.join(block, "token_id", "left").select(
        "token_id", F.coalesce("v", zero).alias("embedding")
    )


def pair_information(counted: DataFrame) -> DataFrame:
    """token_id, next_id, w: the positive information of each pair, over all shards."""
    pairs = stage(
        counted.where("n > 0").groupBy("token_id", "next_id").agg(F.sum("n").alias("n")), "pair-sums"
    )
    of_token = pairs.groupBy("token_id").agg(F.sum("n").alias("of_token"))
    of_next = pairs.groupBy("next_id").agg(F.sum("n").alias("of_next"))
    total = pairs.agg(F.sum("n").cast("double")).first()[0]
    known = pairs.join(of_token, "token_id").join(of_next, "next_id")
    more = F.log(F.col("n") / F.col("of_token") * (F.lit(total) / F.col("of_next")))
    return known.select("token_id", "next_id", more.alias("w")).where("w > 0")


def _start(dimensions: int) -> Column:
    """Numbers between -1/2 and 1/2, by token and column."""
    token = F.col("token_id").cast("bigint") * _A

    def number(column: Column) -> Column:
        mixed = F.pmod(token + column * _B + _C, F.lit(_PRIME))
        for _ in range(2):
            mixed = F.pmod(mixed * mixed + _D, F.lit(_PRIME))
        return mixed / F.lit(float(_PRIME)) - 0.5

    return F.transform(F.sequence(F.lit(0).cast("bigint"), F.lit(dimensions - 1).cast("bigint")), number)


def _times(pairs: DataFrame, block: DataFrame, own: str, other: str, dimensions: int) -> DataFrame:
    """other (as a key), v: the sum of w times the block's vector over a key's pairs.

    A column per element, so that sums are partial in each task and a key is one row of it.
    """
    sums = [F.sum(F.col("w") * F.col("v")[i]).alias(f"v{i}") for i in range(dimensions)]
    summed = pairs.join(block, own).groupBy(other).agg(*sums)
    return summed.select(other, F.array(*(f"v{i}" for i in range(dimensions))).alias("v"))


def _matrix(column, dimensions: int):
    import pyarrow.compute as pc

    return pc.list_flatten(column).to_numpy().reshape(-1, dimensions)


def column_products(block: DataFrame, dimensions: int):
    """The dimensions x dimensions matrix of products of a block's columns, summed per task."""

    def products(batches):
        import pyarrow as pa

        total = np.zeros((dimensions, dimensions))
        for batch in batches:
            rows = _matrix(batch.column(0), dimensions)
            total += rows.T @ rows
        cells = pa.array(np.arange(dimensions * dimensions))
        yield pa.RecordBatch.from_arrays([cells, pa.array(total.ravel())], ["cell", "x"])

    partial = block.select("v").mapInArrow(products, "cell bigint, x double")
    found = np.zeros(dimensions * dimensions)
    for row in partial.groupBy("cell").agg(F.sum("x").alias("x")).collect():
        found[row.cell] = row.x
    return found.reshape(dimensions, dimensions)


def inverse_factor(products):
    """The upper triangular matrix that makes columns with these products orthonormal."""
    n = len(products)
    factor = np.zeros((n, n))
    for j in range(n):
        column = np.zeros(n)
        column[j] = 1.0
        # Twice, so that what rounding leaves of earlier columns goes too.
        for _ in range(2):
            column = column - factor @ (factor.T @ (products @ column))
        length = float(column @ products @ column)
        if length > INDEPENDENT * products[j, j]:
            factor[:, j] = column / np.sqrt(length)
    return factor


def _combined(block: DataFrame, factor) -> DataFrame:
    def combine(batches):
        import pyarrow as pa

        for batch in batches:
            rows = _matrix(batch.column(1), len(factor)) @ factor
            ends = np.arange(len(rows) + 1, dtype=np.int32) * len(factor)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(rows.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["token_id", "v"])

    kind = block.schema["token_id"].dataType.simpleString()
    return block.select("token_id", "v").mapInArrow(combine, f"token_id {kind}, v array<double>")
