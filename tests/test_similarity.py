import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from verbaloom.functions import vectors as vx
from verbaloom.operators import regions, similarity

SCHEMA = "id long, word string, embedding array<double>"


def brute_force(rows, top_n):
    def cosine(a, b):
        na, nb = math.sqrt(sum(x * x for x in a)), math.sqrt(sum(x * x for x in b))
        return sum(x * y for x, y in zip(a, b)) / (na * nb) if na and nb else 0.0

    found = {}
    for i, word, v in rows:
        others = [(-round(cosine(v, o), 10), w, j) for j, w, o in rows if w != word]
        found[i] = [(j, w) for _, w, j in sorted(others)[:top_n]]
    return found


def neighbours(df, top_n, block_rows=None):
    rows = similarity.top_neighbours(df, "id", "word", top_n, block_rows=block_rows)
    found = {}
    for r in rows.orderBy("id", "rank").collect():
        found.setdefault(r.id, []).append((r.neighbour_id, r.neighbour))
        assert r.rank == len(found[r.id])
        assert -1.000001 <= r.similarity <= 1.000001
    return found


def test_four_vectors(spark):
    rows = [
        (12345, "word1", [1.0, 0.0, 0.0]),
        (2, "word2", [0.0, 1.0, 0.0]),
        (3, "word3", [0.0, 0.0, 1.0]),
        (4, "word4", [1.0, 1.0, 0.0]),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    first = similarity.neighbour_rows(df, "id", "word", 2).where("word = 'word1'").first()
    assert [n.word for n in first.neighbours] == ["word4", "word2"]
    assert [n.similarity for n in first.neighbours] == pytest.approx([math.sqrt(0.5), 0.0])
    assert first.embedding == [1.0, 0.0, 0.0]


@pytest.mark.parametrize("block_rows", [None, 7, 40, 1])
def test_blocks_do_not_change_the_result(spark, block_rows):
    random.seed(11)
    n = 12 if block_rows == 1 else 90
    # A third of all rows share one word, a third are copies of one vector, one is zero.
    copy = [0.3, -0.4, 0.5]
    rows = []
    for i in range(n):
        word = "hot" if i % 3 == 0 else f"w{random.randrange(n)}"
        vector = copy if i % 3 == 1 else [random.uniform(-1, 1) for _ in range(3)]
        rows.append((i, word, [0.0] * 3 if i == 5 else vector))
    df = spark.createDataFrame(rows, SCHEMA)
    assert neighbours(df, 5, block_rows) == brute_force(rows, 5)


def test_more_neighbours_than_rows(spark):
    rows = [(1, "a", [1.0, 0.0]), (2, "b", [1.0, 1.0]), (3, "a", [0.0, 1.0])]
    df = spark.createDataFrame(rows, SCHEMA)
    assert neighbours(df, 10) == brute_force(rows, 10)


def test_lonely_word_keeps_an_empty_list(spark):
    df = spark.createDataFrame([(1, "a", [1.0]), (2, "a", [2.0])], SCHEMA)
    found = similarity.neighbour_rows(df, "id", "word").collect()
    assert [(r.id, r.neighbours) for r in sorted(found)] == [(1, []), (2, [])]
    assert similarity.top_neighbours(df.where("id > 9"), "id", "word").collect() == []


def test_nan_ranks_last(spark):
    rows = [(1, "a", [1.0, 0.0]), (2, "b", [math.nan, 1.0]), (3, "c", [-1.0, 0.0])]
    found = neighbours_words(spark.createDataFrame(rows, SCHEMA))
    assert found[1] == ["c", "b"]


def neighbours_words(df):
    found = {}
    rows = similarity.top_neighbours(df, "id", "word", 5).orderBy("id", "rank").collect()
    for r in rows:
        found.setdefault(r.id, []).append(r.neighbour)
    return found


def test_bad_input_is_refused(spark):
    twice = spark.createDataFrame([(1, "a", [1.0]), (1, "b", [1.0])], SCHEMA)
    with pytest.raises(ValueError, match="unique"):
        similarity.top_neighbours(twice, "id", "word")
    uneven = spark.createDataFrame([(1, "a", [1.0]), (2, "b", [1.0, 2.0])], SCHEMA)
    with pytest.raises(ValueError, match="unequal"):
        similarity.top_neighbours(uneven, "id", "word")


def test_zero_vector_has_similarity_zero(spark):
    pair = spark.createDataFrame([([0.0, 0.0], [1.0, 1.0])], "a array<double>, b array<double>")
    assert similarity.pair_cosines(pair).first().cosine == 0.0


def test_unequal_lengths(spark):
    pair = spark.createDataFrame([([1.0, 2.0, 3.0], [4.0, 5.0])], "a array<double>, b array<double>")
    assert pair.select(vx.dot(F.col("a"), F.col("b"), truncate=True).alias("x")).first().x == 14.0
    with pytest.raises(Exception, match="unequal length"):
        pair.select(vx.dot(F.col("a"), F.col("b"))).collect()


def test_last_vector_of_a_word(spark):
    rows = [("a", 1, 1.0), ("a", 3, 3.0), ("b", 2, 2.0)]
    df = spark.createDataFrame(rows, "word string, no int, x double")
    found = similarity.last_per_word(df, "word", "no").collect()
    assert {(r.word, r.no, r.x) for r in found} == {("a", 3, 3.0), ("b", 2, 2.0)}


def test_text_forms(spark):
    df = spark.createDataFrame([([0.5, -2.0],)], "v array<double>")
    entry = F.array(F.struct(F.lit("bow").alias("word"), F.lit(0.75).alias("similarity")))
    row = df.select(
        vx.format_vector(F.col("v")).alias("csv"), vx.format_neighbours(entry).alias("near")
    ).first()
    assert (row.csv, row.near) == ("0.5,-2.0", "bow:0.75")


@pytest.mark.parametrize("row", [(3, "c", None), (3, None, [1.0, 0.0]), (3, "c", [None, 1.0])])
def test_null_vectors_and_words_fail(spark, row):
    rows = [(1, "a", [1.0, 0.0]), row, (2, "b", [0.0, 1.0])]
    df = spark.createDataFrame(rows, "id long, word string, embedding array<double>")
    with pytest.raises(ValueError, match="1 rows have a null"):
        similarity.top_neighbours(df, "id", "word")


def test_small_slices_give_the_same_neighbours(spark, monkeypatch):
    rows = [(i, f"w{i % 7}", [float(i % 5), float(i % 3), 1.0]) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, word string, embedding array<double>")
    want = sorted(r[:5] for r in similarity.top_neighbours(df, "id", "word").collect())
    monkeypatch.setattr(similarity, "SLICE_BYTES", 1)
    assert sorted(r[:5] for r in similarity.top_neighbours(df, "id", "word").collect()) == want


def clustered(n, clusters, dimensions, spread, seed=5):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, dimensions))
    centres /= np.linalg.norm(centres, axis=1)[:, None]
    rows = centres[rng.integers(clusters, size=n)] + rng.normal(size=(n, dimensions)) * spread
    return [(i, f"w{i % 400}", row.tolist()) for i, row in enumerate(rows)]


def matrix_top(rows, top_n):
    vectors = np.array([v for _, _, v in rows])
    length = np.linalg.norm(vectors, axis=1)
    units = vectors / np.where(length > 0, length, 1)[:, None]
    words = np.array([w for _, w, _ in rows])
    ids = np.array([i for i, _, _ in rows])
    found = {}
    for at, (i, word, _) in enumerate(rows):
        rank = np.round(units @ units[at], 10)
        order = np.lexsort((ids, words, -rank))
        found[i] = [(int(ids[j]), str(words[j])) for j in order if words[j] != word][:top_n]
    return found


def test_clusters_visit_few_cells_and_a_hot_region_is_split(spark):
    rows = clustered(3000, 24, 16, 0.02)
    # A third of all rows are copies of one vector; some have no direction.
    rows += [(5000 + i, f"c{i}", rows[0][2]) for i in range(1500)]
    rows += [(9000, "zero", [0.0] * 16), (9001, "far", [-x for x in rows[1][2]])]
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    units = similarity.staged_units(df, "id", "word", "embedding")
    layout = regions.lay_out(units, 30, 100)
    assert layout.counts.max() >= 15
    near = similarity._neighbours_of(layout.own_cells(), layout.n_own_cells(), units, 5)
    asking = layout.asking(similarity._last_of(near, 5))
    blocks = int(layout.counts.sum())
    visited = layout.n_own_cells() + asking.n_cells()
    assert visited < blocks * (blocks + 1) // 2 / 2
    largest = asking.cells().groupBy("cell").count().agg(F.max("count")).first()[0]
    assert largest < 2 * 100 * 1.5
    assert neighbours(df, 5, block_rows=100) == matrix_top(rows, 5)


def test_no_bound_loses_a_neighbour():
    """Every region with a row that is as similar as asked is asked."""
    rng = np.random.default_rng(9)
    units = rng.normal(size=(400, 6))
    units /= np.linalg.norm(units, axis=1)[:, None]
    pivots = regions.farthest_first(units[:60], 12)
    products = units @ pivots.T
    region = products.argmax(axis=1)
    angle = np.arccos(np.clip(products.max(axis=1), -1, 1))
    radius = np.array([angle[region == r].max(initial=0) for r in range(len(pivots))])
    for least in (0.99, 0.9, 0.5, -2.0):
        asked = regions.asked_regions(units, region, np.full(400, least), pivots, radius)
        wanted = units @ units.T >= least
        for x in range(400):
            for r in set(region[wanted[x]].tolist()) - {region[x]}:
                assert asked[x, r]


def test_farthest_first_takes_no_copy():
    rows = np.array([[1.0, 0], [1, 0], [0, 1], [-1, 0], [0, 1]])
    assert regions.farthest_first(rows, 10).tolist() == [[1, 0], [-1, 0], [0, 1]]
