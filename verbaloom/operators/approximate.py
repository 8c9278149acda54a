"""Approximate nearest words: sign sketches, several bands, several probes."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verbaloom.operators import similarity
from verbaloom.sources.tables import stage

# Sketches of a row, and buckets of each that a row looks into beside its own.
BANDS, PROBES = 10, 7
# Rows in a bucket on average, and rows of either kind in a cell.
BUCKET_ROWS, CELL_ROWS = 256, 4096
LONGEST_SKETCH = 24
SEED = 17


def approximate_neighbours(
    vectors: DataFrame,
    id_column: str,
    word: str,
    top_n: int = similarity.TOP_N,
    embedding: str = "embedding",
    bands: int = BANDS,
    probes: int = PROBES,
    bucket_rows: int = BUCKET_ROWS,
    cell_rows: int = CELL_ROWS,
    seed: int = SEED,
) -> DataFrame:
    """id, word, rank, neighbour_id, neighbour, similarity: nearly the ``top_n`` most similar
    rows of another word for every row, with exact similarities and the ranks of
    ``similarity.top_neighbours``, which is the exact way for every row.

    Each band sketches a row by the signs of its products with a few random vectors: near
    rows have equal signs, but for small products. A row answers in the bucket of its sketch
    and asks there and in the ``probes`` buckets that differ in the least products (of one
    sign or two). Sketches get as long as makes buckets of ``bucket_rows`` on average.

    A bucket is cut into cells of at most about ``cell_rows`` asking and as many answering
    rows, whatever its size, and only each row's best leave a cell. Of rows with one vector
    only the first few can be among another row's best: ``top_n`` of a word and twice that in
    all answer, so that a group of copies asks, but is not compared with itself.

    Ids must be unique, vectors equally long and without nulls, words not null, as for
    ``top_neighbours``. Rows without a direction are found by chance only.
    """
    if min(top_n, bands, bucket_rows, cell_rows) <= 0 or probes < 0:
        raise ValueError("top_n, bands, bucket_rows and cell_rows must be positive, probes 0 at least")
    units = similarity.staged_units(vectors, id_column, word, embedding)
    rows, width = units.select(F.count("*"), F.max(F.size("unit"))).first()
    bits = min(LONGEST_SKETCH, max(0, math.ceil(math.log2(max(rows, 1) / bucket_rows))))
    planes = width or 1, bands, bits, seed
    answers = stage(_sketched(_answering(units, top_n), planes, 0), "answering-sketches")
    asks = stage(_sketched(units, planes, probes), "asking-sketches")
    found = _cells(units, answers, asks, cell_rows).groupBy("bucket", "part", "chunk").applyInArrow(
        _cell_best(top_n), similarity.neighbour_schema(units)
    )
    # A pair may have met in several bands.
    once = found.groupBy("id", "neighbour_id").agg(
        F.first("word").alias("word"),
        F.first("neighbour").alias("neighbour"),
        F.first("similarity").alias("similarity"),
    )
    return similarity._best(once, top_n).select(
        F.col("id").alias(id_column), "word", "rank", "neighbour_id", "neighbour", "similarity"
    )


def _answering(units: DataFrame, top_n: int) -> DataFrame:
    """id, unit of the rows that can be among the best of some row: of one vector, the first
    ``top_n`` of each word, and of these the first ``2 * top_n``."""
    # Two hashes of 64 and 32 bits stand for the vector, which is long.
    keyed = units.withColumns({"h": F.xxhash64("unit"), "g": F.hash("unit")})
    of_word = Window.partitionBy("h", "g", "word").orderBy("id")
    of_vector = Window.partitionBy("h", "g").orderBy("word", "id")
    some = keyed.select("id", "word", "h", "g").withColumn("k", F.row_number().over(of_word))
    some = some.where(F.col("k") <= top_n).drop("k").withColumn("k", F.row_number().over(of_vector))
    return units.join(some.where(F.col("k") <= 2 * top_n).select("id"), "id", "left_semi")


def _sketched(units: DataFrame, planes: tuple, probes: int) -> DataFrame:
    """id, bucket: each row's own bucket of every band, and ``probes`` more of each."""
    shape = T.StructType([units.schema["id"], T.StructField("buckets", T.ArrayType(T.LongType()))])
    width, bands, bits, seed = planes

    def sketch(batches):
        import numpy as np
        import pyarrow as pa

        from verbaloom.operators.regions import _matrix

        normal = np.random.default_rng(seed).normal(size=(width, bands * bits))
        weights = 1 << np.arange(bits)
        flips = [(i,) for i in range(bits)] + [(i, j) for i in range(bits) for j in range(i)]
        masks = np.array([sum(1 << i for i in f) for f in flips], np.int64)
        chosen = np.zeros((len(flips), bits))
        for k, f in enumerate(flips):
            chosen[k, list(f)] = 1
        more = min(probes, len(flips))
        for batch in batches:
            for low in range(0, batch.num_rows, 1024):
                part = batch.slice(low, 1024)
                rows = _matrix(part.column(part.schema.get_field_index("unit")))
                products = (np.nan_to_num(rows) @ normal).reshape(len(rows), bands, bits)
                own = (products > 0) @ weights if bits else np.zeros((len(rows), bands), np.int64)
                own = own.astype(np.int64)[:, :, None]
                if more:
                    # The cost of a change of signs is the sum of the squares it gives up.
                    cost = (products**2) @ chosen.T
                    least = np.argpartition(cost, more - 1, axis=2)[:, :, :more]
                    own = np.concatenate([own, own ^ masks[least]], axis=2)
                band = np.arange(bands, dtype=np.int64)[None, :, None]
                found = ((band << LONGEST_SKETCH) | own).reshape(len(rows), -1)
                ends = np.arange(len(rows) + 1, dtype=np.int32) * found.shape[1]
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(found.ravel()))
                ids = part.column(part.schema.get_field_index("id"))
                yield pa.RecordBatch.from_arrays([ids, lists], ["id", "buckets"])

    made = units.select("id", "unit").mapInArrow(sketch, shape)
    return made.select("id", F.explode("buckets").alias("bucket"))


def _cells(units: DataFrame, answers: DataFrame, asks: DataFrame, cell_rows: int) -> DataFrame:
    """bucket, part, chunk, asks, id, word, unit: answering rows lie in one part of their
    bucket and are in all its chunks, asking rows in one chunk and in all parts."""
    there = answers.groupBy("bucket").agg(F.count("*").alias("n_answers"))
    here = asks.groupBy("bucket").agg(F.count("*").alias("n_asks"))
    sizes = there.join(here, "bucket").select(
        "bucket",
        F.ceil(F.col("n_answers") / cell_rows).cast("int").alias("parts"),
        F.ceil(F.col("n_asks") / cell_rows).cast("int").alias("chunks"),
    )
    sizes = stage(sizes, "bucket-sizes")

    def numbers(n):
        return F.sequence(F.lit(0), F.col(n) - 1)

    own_part = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    own_chunk = F.pmod(F.xxhash64("id", F.lit(1)), F.col("chunks")).cast("int")
    placed = (
        answers.join(sizes, "bucket")
        .select("bucket", own_part.alias("part"), F.explode(numbers("chunks")).alias("chunk"), F.lit(False).alias("asks"), "id")
        .unionByName(
            asks.join(sizes, "bucket").select(
                "bucket", F.explode(numbers("parts")).alias("part"), own_chunk.alias("chunk"), F.lit(True).alias("asks"), "id"
            )
        )
    )
    return placed.join(units, "id")


def _cell_best(top_n: int):
    def best(key, table):
        import pyarrow as pa

        asks = table["asks"].to_numpy()
        found = similarity.best_of_cell(table.drop_columns(["asks"]), asks, ~asks, top_n)
        return pa.Table.from_batches([found])

    return best
