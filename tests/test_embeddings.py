import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from verbaloom.functions import vectors as vx
from verbaloom.operators import embeddings, learned


@pytest.fixture(scope="module")
def shards(spark):
    random.seed(5)
    tokens = [[random.randrange(12) for _ in range(n)] for n in (60, 31, 9, 8, 3)]
    tokens[2][-1] = 99  # only ever a target: no pair starts from it
    rows = [(i + 1, t) for i, t in enumerate(tokens)]
    return rows, spark.createDataFrame(rows, "shard_id int, tokens array<int>")


def brute_force(rows, dims, window, stride):
    vectors = {}
    for shard, tokens in rows:
        n = Counter()
        for s in range(0, len(tokens) - window, stride):
            n.update(zip(tokens[s : s + window], tokens[s + 1 : s + window + 1]))
        if not n:
            continue
        first, second = Counter(), Counter()
        for (a, b), k in n.items():
            first[a] += k
            second[b] += k
        for token in set(tokens):
            vectors[shard, token] = [0.0] * dims
        for (a, b), k in n.items():
            value = max(0.0, math.log(k * sum(n.values()) / (first[a] * second[b])))
            vectors[shard, a][b % dims] += value * (1 - 2 * ((b // dims) % 2))
    return vectors


@pytest.mark.parametrize("dims,window,stride", [(5, 8, 2), (4, 3, 1), (100, 2, 5)])
def test_shard_vectors_and_their_mean(shards, dims, window, stride):
    rows, df = shards
    expected = brute_force(rows, dims, window, stride)
    single = embeddings.shard_embeddings(df, dims, window, stride)
    found = {(r.shard_id, r.token_id): r.embedding for r in single.collect()}
    assert found.keys() == expected.keys()
    for key, vector in expected.items():
        assert found[key] == pytest.approx(vector)

    by_token = defaultdict(list)
    for (_, token), vector in expected.items():
        by_token[token].append(vector)
    averaged = embeddings.average_shard_embeddings(df, dims, window, stride)
    mean = {r.token_id: r.embedding for r in averaged.collect()}
    general = embeddings.mean_embeddings(single, ["token_id"])
    also = {r.token_id: r.embedding for r in general.collect()}
    assert mean.keys() == also.keys() == by_token.keys()
    for token, vectors in by_token.items():
        average = [sum(x) / len(vectors) for x in zip(*vectors)]
        assert mean[token] == pytest.approx(average)
        assert also[token] == pytest.approx(average)


def test_mean_of_three_vectors(spark):
    df = spark.createDataFrame(
        [("token", "1.0, 2.0, 3.0"), ("token", "4.0, 5.0, 6.0"), ("token", "7.0, 8.0, 9.0")],
        "key string, csv string",
    ).withColumn("embedding", vx.parse_vector(F.col("csv"), strict=True))
    assert embeddings.mean_embeddings(df, ["key"]).first().embedding == [4.0, 5.0, 6.0]
    assert embeddings.mean_embeddings(df.where("key = 'x'"), ["key"]).collect() == []


def test_bad_vectors_are_errors(spark):
    bad = spark.createDataFrame([("token", "invalid,embedding")], "key string, csv string")
    parsed = bad.withColumn("embedding", vx.parse_vector(F.col("csv"), strict=True))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        embeddings.mean_embeddings(parsed, ["key"]).collect()
    rows = [("a", [1.0]), ("a", [1.0, 2.0])]
    uneven = spark.createDataFrame(rows, "key string, embedding array<double>")
    with pytest.raises(Exception, match="Dimensions mismatch"):
        embeddings.mean_embeddings(uneven, ["key"]).collect()


def test_one_vector_per_token(spark):
    tokens = list(range(100)) * 3
    df = spark.createDataFrame([(1, tokens)], "shard_id int, tokens array<int>")
    found = embeddings.shard_embeddings(df, 50).collect()
    assert len(found) == 100
    assert {len(r.embedding) for r in found} == {50}


def information_matrix(rows, window=8, stride=2):
    """The pair information over all trainable shards, and their tokens."""
    n, tokens = Counter(), set()
    for _, found in rows:
        for s in range(0, len(found) - window, stride):
            n.update(zip(found[s : s + window], found[s + 1 : s + window + 1]))
        if len(found) > window:
            tokens |= set(found)
    place = {t: i for i, t in enumerate(sorted(tokens))}
    table = np.zeros((len(place), len(place)))
    for (a, b), k in n.items():
        table[place[a], place[b]] = k
    of_token, of_next = table.sum(axis=1, keepdims=True), table.sum(axis=0, keepdims=True)
    with np.errstate(divide="ignore", invalid="ignore"):
        more = np.log(table * table.sum() / (of_token * of_next))
    return sorted(tokens), np.where(table > 0, np.maximum(more, 0), 0)


def test_learned_vectors_span_the_leading_space(shards):
    rows, df = shards
    tokens, table = information_matrix(rows)
    found = {r.token_id: r.embedding for r in learned.learned_vectors(df, dimensions=3, steps=40).collect()}
    assert sorted(found) == tokens
    basis = np.array([found[t] for t in tokens])
    assert np.allclose(basis.T @ basis, np.eye(3), atol=1e-9)
    # What the basis keeps of the table is nearly what the leading singular vectors keep.
    values = np.linalg.svd(table, compute_uv=False)
    assert ((basis.T @ table) ** 2).sum() >= 0.999 * (values[:3] ** 2).sum()


def test_learned_vectors_beyond_the_rank_and_of_nothing(shards):
    rows, df = shards
    tokens, table = information_matrix(rows)
    rank = np.linalg.matrix_rank(table)
    found = np.array([r.embedding for r in learned.learned_vectors(df, dimensions=16).collect()])
    assert found.shape == (len(tokens), 16) and np.isfinite(found).all()
    lengths = (found**2).sum(axis=0)
    assert np.allclose(lengths[:rank], 1) and not lengths[rank:].any()
    assert learned.learned_vectors(df.where("shard_id > 99"), dimensions=6).collect() == []
    with pytest.raises(ValueError, match="positive"):
        learned.learned_vectors(df, dimensions=0)


def test_vectors_are_summed_whole_before_the_shuffle(spark):
    rows = [(k, [float(i), float(k), -1.0]) for k in range(5) for i in range(100)] + [(1, None), (2, [])]
    df = spark.createDataFrame(rows, "k int, embedding array<double>").repartition(4)
    mean = embeddings.mean_embeddings(df, ["k"])
    plan = mean._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and plan.count("Exchange hashpartitioning") == 1
    assert {r.k: r.embedding for r in mean.collect()} == {k: pytest.approx([49.5, k, -1.0]) for k in range(5)}


def test_dense(spark):
    schema = "entries array<struct<dim:int,x:double>>"
    rows = [([(0, 1.0), (3, 2.0)],), ([(4, 5.0)],), ([],), ([(i, float(i)) for i in range(5)],)]
    found = spark.createDataFrame(rows, schema).select(vx.dense(F.col("entries"), 5).alias("v"))
    assert sorted(r.v for r in found.collect()) == sorted(
        [[1.0, 0, 0, 2.0, 0], [0, 0, 0, 0, 5.0], [0.0] * 5, [0.0, 1.0, 2.0, 3.0, 4.0]]
    )


def test_unknown_ids_and_null_elements_fail(spark, vocabulary):
    vectors = spark.createDataFrame([(64, 1), (10**7, 2)], "token_id int, n int")
    with pytest.raises(Exception, match="no such token: 10000000"):
        embeddings.with_words(vectors, vocabulary).collect()
    assert embeddings.with_words(vectors.where("n = 1"), vocabulary).count() == 1
    df = spark.createDataFrame([(1, [1.0, None]), (1, [3.0, 5.0])], "k int, embedding array<double>")
    with pytest.raises(Exception, match="null elements"):
        embeddings.mean_embeddings(df, ["k"]).collect()
