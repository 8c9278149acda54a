"""Nearest words by cosine similarity."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verbaloom.functions import vectors as vx
from verbaloom.operators import regions
from verbaloom.sources.tables import stage

# Fixed value: the default number of neighbours.
TOP_N = 5

# Two blocks of this many bytes of vectors (and 64 bytes a row for word and id), and the
# products of one slice, are a task's working set.
BLOCK_BYTES, ROW_BYTES = 32 << 20, 64
SLICE_BYTES = 32 << 20
SMALLEST_BLOCK = 512
# Tasks of one round of cells.
MAX_TASKS = 100_000
# Ranking ignores differences below this many decimals, so that ties do not depend on
# the order in which a product was summed.
RANK_DECIMALS = 10


def last_per_word(df: DataFrame, word: str, order: str) -> DataFrame:
    """One row per word: the one with the highest ``order``; of equal ones, that with the
    greatest other columns, in their order."""
    others = [c for c in df.columns if c not in (word, order)]
    row = F.max(F.struct(order, *others)).alias("_row")
    return df.groupBy(word).agg(row).select(word, "_row.*").select(*df.columns)


def with_norms(vectors: DataFrame, embedding: str = "embedding") -> DataFrame:
    """Add ``norm``, once per row."""
    return vectors.withColumn("norm", vx.norm(F.col(embedding)))


def pair_cosines(pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Add ``dot`` and ``cosine`` to rows that hold two vectors."""
    measured = pairs.withColumns(
        {
            "dot": vx.dot(F.col(a), F.col(b)),
            "_norm_a": vx.norm(F.col(a)),
            "_norm_b": vx.norm(F.col(b)),
        }
    )
    cosine = vx.cosine(F.col("dot"), F.col("_norm_a"), F.col("_norm_b"))
    return measured.withColumn("cosine", cosine).drop("_norm_a", "_norm_b")


def top_neighbours(
    vectors: DataFrame,
    id_column: str,
    word: str,
    top_n: int = TOP_N,
    embedding: str = "embedding",
    block_rows: int | None = None,
) -> DataFrame:
    """id, word, rank, neighbour_id, neighbour, similarity: the ``top_n`` most similar
    rows of another word for every row.

    Exact, without a pair join. Rows lie in the region of their nearest pivot, and a region in
    even blocks by a hash of their unique id, so blocks are even whatever the words and however
    vectors cluster. Cells are pairs of blocks: matrix products in slices, from which only each
    row's best ``top_n`` leave the task. A first round visits the cells within regions and
    gives each row its ``top_n``-th best so far. In the second a row asks only those regions
    whose rows, by the angle to the pivot and the region's radius, could still beat that.

    ``id_column`` must be unique, all vectors equally long. Ranks order by similarity
    (to 10 decimals, NaN last), then word, then id.
    """
    if top_n <= 0:
        raise ValueError("top_n must be positive")
    units = staged_units(vectors, id_column, word, embedding)
    layout = regions.lay_out(units, *_block_plan(units, block_rows))
    near = _neighbours_of(layout.own_cells(), layout.n_own_cells(), units, top_n)
    if len(layout.counts) > 1:
        near = stage(near, "near-neighbours")
        asking = layout.asking(_last_of(near, top_n))
        far = _neighbours_of(asking.cells(), asking.n_cells(), units, top_n)
        near = near.unionByName(far)
    return _best(near, top_n).select(
        F.col("id").alias(id_column),
        "word",
        "rank",
        "neighbour_id",
        "neighbour",
        "similarity",
    )


def staged_units(vectors: DataFrame, id_column: str, word: str, embedding: str) -> DataFrame:
    """id, word, unit: the vectors at length 1 (or 0), checked and written once."""
    source = vectors.select(
        F.col(id_column).alias("id"),
        F.col(word).alias("word"),
        F.col(embedding).cast("array<double>").alias("v"),
    )
    # The norm is a column of its own: inside the lambda it would be taken per element.
    length = F.col("norm")
    unit = F.when(length != 0, F.transform("v", lambda x: x / length)).otherwise(F.col("v"))
    units = stage(with_norms(source, "v").select("id", "word", unit.alias("unit")), "unit-vectors")
    known = (
        F.col("word").isNotNull() & F.col("unit").isNotNull() & ~F.exists("unit", lambda x: x.isNull())
    )
    rows, shortest, longest, distinct, whole = units.select(
        F.count("*"),
        F.min(F.size("unit")),
        F.max(F.size("unit")),
        F.count_distinct("id"),
        F.count_if(known),
    ).first()
    if rows != whole:
        raise ValueError(f"{rows - whole} rows have a null word, vector or element")
    if rows != distinct:
        raise ValueError("ids are not unique")
    if shortest != longest:
        raise ValueError(f"vectors of unequal length: {shortest} to {longest}")
    return units


def _block_plan(units: DataFrame, block_rows: int | None) -> tuple[int, int]:
    """How many regions, and rows in a block: small enough for a task's memory, and blocks
    enough to use the cluster. Rows that fit one block are one region."""
    rows, longest = units.select(F.count("*"), F.max(F.size("unit"))).first()
    if block_rows is None:
        fitting = BLOCK_BYTES // (max(longest or 1, 1) * 8 + ROW_BYTES)
        cores = units.sparkSession.sparkContext.defaultParallelism
        useful = min(math.ceil(math.sqrt(2 * cores)), rows // SMALLEST_BLOCK)
        block_rows = max(1, min(fitting, math.ceil(rows / max(useful, 1))))
        needed = math.ceil(rows / max(fitting, 1))
    else:
        needed = math.ceil(rows / block_rows)
    return max(1, min(needed, regions.MAX_REGIONS)), block_rows


def neighbour_schema(units: DataFrame) -> T.StructType:
    id_type, word_type = units.schema["id"].dataType, units.schema["word"].dataType
    return T.StructType(
        [
            T.StructField("id", id_type),
            T.StructField("word", word_type),
            T.StructField("neighbour_id", id_type),
            T.StructField("neighbour", word_type),
            T.StructField("similarity", T.DoubleType()),
        ]
    )


def _neighbours_of(cells: DataFrame, n_cells: int, units: DataFrame, top_n: int) -> DataFrame:
    """Each row's best in each of its cells. Cells are dealt to tasks by their numbers, one
    after another, so that no task has two more than another."""
    tasks = max(1, min(n_cells, MAX_TASKS))
    dealt = cells.repartitionById(tasks, (F.col("cell") % tasks).cast("int"))
    sorted_cells = dealt.sortWithinPartitions("cell")
    return sorted_cells.mapInArrow(_cell_neighbours(top_n), neighbour_schema(units))


def _best(found: DataFrame, top_n: int) -> DataFrame:
    order = Window.partitionBy("id").orderBy(
        F.isnan("similarity"),
        F.desc(F.round("similarity", RANK_DECIMALS)),
        "neighbour",
        "neighbour_id",
    )
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top_n)


def _last_of(near: DataFrame, top_n: int) -> DataFrame:
    """id, least: the similarity of each row's last neighbour so far, if it has all."""
    return _best(near, top_n).where(F.col("rank") == top_n).select(
        "id", F.nanvl("similarity", F.lit(-2.0)).alias("least")
    )


def _cell_neighbours(top_n: int):
    """The function run over sorted cells; it needs this package, pyarrow and numpy."""

    def run(batches):
        import numpy as np

        for _, table in regions.runs(batches, "cell"):
            sides = table["side"].to_numpy()
            asks = table["asks"].to_numpy()
            if (sides == regions.BOTH).any():
                yield best_of_cell(table, asks, np.ones(len(asks), bool), top_n)
            else:
                for side in (0, 1):
                    yield best_of_cell(table, asks & (sides == side), sides == 1 - side, top_n)
    return run


def best_of_cell(table, asking, answering, top_n: int, decimals: int = RANK_DECIMALS):
    """For each asking row of a cell its best answering rows of another word, as an Arrow
    batch. A row is not compared with itself, as it has its own word."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    # Columns in (word, id) order: of equal similarities the first is the best rank.
    order = pc.sort_indices(table, [("word", "ascending"), ("id", "ascending")])
    table = table.take(order)
    order = order.to_numpy()
    mine, theirs = np.flatnonzero(asking[order]), np.flatnonzero(answering[order])
    words = table["word"].combine_chunks()
    codes = words.dictionary_encode().indices.to_numpy(zero_copy_only=False)
    ids = table["id"].combine_chunks()
    units = pc.list_flatten(table["unit"]).to_numpy().reshape(table.num_rows, -1)
    rows_out, columns_out, values_out = [], [], []
    # Products and ranks of a slice are doubles.
    slice_rows = max(1, SLICE_BYTES // (16 * max(len(theirs), 1)))
    others = units[theirs].T
    for start in range(0, len(mine) if len(theirs) else 0, slice_rows):
        some = mine[start : start + slice_rows]
        product = units[some] @ others
        rank = np.round(product, decimals)
        rank[np.isnan(rank)] = -2.0
        rank[codes[some][:, None] == codes[theirs][None, :]] = -np.inf
        line = np.arange(len(some))
        for _ in range(min(top_n, len(theirs))):
            at = rank.argmax(axis=1)
            kept = rank[line, at] > -np.inf
            if not kept.any():
                break
            rows_out.append(some[kept])
            columns_out.append(theirs[at[kept]])
            values_out.append(product[line[kept], at[kept]])
            rank[line, at] = -np.inf

    none = np.empty(0, dtype=np.int64)
    rows = pa.array(np.concatenate(rows_out or [none]))
    columns = pa.array(np.concatenate(columns_out or [none]))
    values = pa.array(np.concatenate(values_out or [none.astype(float)]))
    return pa.RecordBatch.from_arrays(
        [ids.take(rows), words.take(rows), ids.take(columns), words.take(columns), values],
        ["id", "word", "neighbour_id", "neighbour", "similarity"],
    )


def neighbour_rows(
    vectors: DataFrame,
    id_column: str,
    word: str,
    top_n: int = TOP_N,
    embedding: str = "embedding",
) -> DataFrame:
    """id, word, embedding, neighbours: one row per vector with its ranked neighbour list.

    A row without any other word keeps an empty list.
    """
    found = top_neighbours(vectors, id_column, word, top_n, embedding)
    entry = F.struct(
        "rank",
        F.col("neighbour").alias("word"),
        F.col("neighbour_id").alias("id"),
        "similarity",
    )
    lists = found.groupBy(id_column).agg(F.array_sort(F.collect_list(entry)).alias("neighbours"))
    empty = F.array().cast(lists.schema["neighbours"].dataType)
    return (
        vectors.select(id_column, word, embedding)
        .join(lists, id_column, "left")
        .withColumn("neighbours", F.coalesce("neighbours", empty))
    )
