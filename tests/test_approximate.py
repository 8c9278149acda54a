"""Approximate neighbours against the exact ones."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from test_similarity import SCHEMA, clustered
from verbaloom.operators import approximate, similarity

SF = "/root/testdata/sf0.01"


def pairs(df):
    found = {}
    for r in df.collect():
        found.setdefault(r[0], {})[r.rank] = (r.neighbour_id, round(r.similarity, 9))
    return found


def recall(found, exact):
    """The share of exact neighbours that are found, or others as similar as the last."""
    hits = total = 0
    for i, ranked in exact.items():
        least = min(s for _, s in ranked.values())
        total += len(ranked)
        hits += sum(s >= least for _, s in found.get(i, {}).values())
    return hits / total


def test_recall_on_the_given_vectors(spark):
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet").withColumn("word", F.col("vec_id").cast("string"))
    exact = pairs(similarity.top_neighbours(vectors, "vec_id", "word"))
    # Short buckets, so that a row sees a part of the table only.
    found = pairs(approximate.approximate_neighbours(vectors, "vec_id", "word", bucket_rows=32))
    assert recall(found, exact) >= 0.95


def test_recall_and_ranks_on_clusters(spark):
    rows = clustered(4000, 50, 24, 0.08)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    exact = pairs(similarity.top_neighbours(df, "id", "word"))
    found = pairs(approximate.approximate_neighbours(df, "id", "word", bucket_rows=64))
    assert recall(found, exact) >= 0.95
    for ranked in found.values():
        assert sorted(ranked) == list(range(1, len(ranked) + 1))
        assert [s for _, s in sorted(ranked.values(), key=lambda x: -x[1])] == [ranked[k][1] for k in sorted(ranked)]


def test_a_hot_bucket_is_cut_and_copies_do_not_meet(spark):
    rows = clustered(1200, 6, 8, 0.3)
    rows += [(5000 + i, f"c{i % 300}", rows[0][2]) for i in range(1800)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    units = similarity.staged_units(df, "id", "word", "embedding")
    answers = approximate._sketched(approximate._answering(units, 5), (8, 3, 2, 1), 0)
    asks = approximate._sketched(units, (8, 3, 2, 1), 1)
    assert answers.count() <= 3 * (1200 + 10)
    cells = approximate._cells(units, answers, asks, 50).groupBy("bucket", "part", "chunk", "asks").count()
    assert cells.agg(F.max("count")).first()[0] < 50 * 1.8
    # With every bucket probed the result is the exact one, copies included.
    exact = pairs(similarity.top_neighbours(df, "id", "word"))
    found = pairs(approximate.approximate_neighbours(df, "id", "word", bands=1, probes=3, bucket_rows=750, cell_rows=97))
    assert found == exact


@pytest.mark.parametrize("n", [0, 1])
def test_few_rows(spark, n):
    df = spark.createDataFrame([(1, "a", [1.0, 0.0])][:n], SCHEMA)
    assert approximate.approximate_neighbours(df, "id", "word").collect() == []
    with pytest.raises(ValueError, match="positive"):
        approximate.approximate_neighbours(df, "id", "word", bands=0)


def test_sketches_do_not_depend_on_the_layout(spark):
    rows = clustered(300, 5, 8, 0.2)
    df = spark.createDataFrame(rows, SCHEMA)
    units = similarity.staged_units(df, "id", "word", "embedding")
    some = approximate._sketched(units, (8, 4, 6, 3), 5)
    other = approximate._sketched(units.repartition(9), (8, 4, 6, 3), 5)
    assert sorted(map(tuple, some.collect())) == sorted(map(tuple, other.collect()))
    assert np.unique([r.bucket for r in some.collect()]).max() < 4 << approximate.LONGEST_SKETCH
