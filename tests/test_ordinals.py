import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from verbaloom.operators import ordinals, words

KEYS = st.integers(min_value=-(2**63), max_value=2**63 - 1)


@settings(
    max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.dictionaries(KEYS, st.integers(0, 9), min_size=1, max_size=60))
def test_offsets_of_any_keys(spark, weights):
    df = spark.createDataFrame(list(weights.items()), "k long, n long")
    found = dict(ordinals.running_offsets(df, ["k"], ["n"]).collect())
    total, expected = 0, {}
    for key in sorted(weights):
        expected[key] = total
        total += weights[key]
    assert found == expected


@pytest.mark.parametrize("partitions", [1, 7])
def test_offsets_of_composite_keys(spark, partitions):
    random.seed(partitions)
    keys = {(random.randrange(5) << 40, random.randrange(-50, 50)) for _ in range(200)}
    rows = [(a, b, random.randrange(4), 1) for a, b in keys]
    df = spark.createDataFrame(rows, "a long, b long, n long, m long").repartition(partitions)
    found = {
        (r.a, r.b): (r.n, r.m)
        for r in ordinals.running_offsets(df, ["a", "b"], ["n", "m"]).collect()
    }
    total, expected = 0, {}
    for i, (a, b, n, _) in enumerate(sorted(rows)):
        expected[(a, b)] = (total, i)
        total += n
    assert found == expected


def test_positions_and_line_shards(spark):
    df = spark.createDataFrame([(1, "a b\n\nc")], "doc_id long, text string")
    found = words.word_shards(df, ["doc_id"], 2).orderBy("position").collect()
    assert [(r.shard_id, r.position, r.word) for r in found] == [
        (0, 0, "a"),
        (0, 1, "b"),
        (1, 2, "c"),
    ]


def test_positions_run_through_empty_texts(spark):
    rows = [(5, "c d"), (1, "a"), (2, ""), (3, " \n "), (4, "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = words.positioned_words(df, ["doc_id"]).orderBy("position").collect()
    assert [(r.doc_id, r.position, r.word) for r in found] == [
        (1, 0, "a"),
        (4, 1, "b"),
        (5, 2, "c"),
        (5, 3, "d"),
    ]


def test_record_shards_start_at_one(spark):
    df = spark.createDataFrame([(1, "a. b. c"), (2, "d! e")], "doc_id long, text string")
    found = words.sentence_shards(df, ["doc_id"], 2).orderBy("ordinal").collect()
    assert [r.shard_id for r in found] == [1, 1, 2, 2, 3]
    raw = words.line_shards(df, ["doc_id"], 1).orderBy("ordinal").collect()
    assert [(r.shard_id, r.line) for r in raw] == [(1, "a. b. c"), (2, "d! e")]


def test_buckets(spark):
    df = spark.range(10).withColumnRenamed("id", "position")
    found = ordinals.position_buckets(df, 4).orderBy("position").collect()
    assert [r.bucket for r in found] == [0, 0, 0, 1, 1, 1, 2, 2, 2, 3]


def test_buckets_at_the_edges(spark):
    zero = spark.createDataFrame([(0,), (-5,)], "position long")
    assert {r.bucket for r in ordinals.position_buckets(zero, 3).collect()} == {0}
    assert ordinals.max_position(zero).first().max_position == 0
    empty = zero.where("position > 7")
    assert ordinals.max_position(empty).first().max_position == 0
    assert ordinals.position_buckets(empty, 3).collect() == []
    with pytest.raises(ValueError):
        ordinals.position_buckets(zero, 0)


def test_range_layout_keeps_order(spark):
    df = spark.range(1000).withColumnRenamed("id", "position").repartition(5)
    parts = ordinals.range_layout(df, 4).rdd.map(lambda r: r.position).glom().collect()
    assert [p for part in parts for p in part] == list(range(1000))


def test_null_texts_count_no_words(spark):
    """A null text as the last key of a digit group does not shift what follows."""
    rows = [(1, "a b"), (2**21 - 1, None), (2**21, "c"), (2**21 + 1, "d e")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = words.positioned_words(df, ["doc_id"]).orderBy("position").collect()
    assert [(r.position, r.word) for r in found] == list(enumerate("abcde"))
    cut = words.sentence_shards(df, ["doc_id"], 2).orderBy("ordinal").collect()
    assert [(r.shard_id, r.ordinal, r.sentence) for r in cut] == [
        (1, 0, "a b"),
        (1, 1, "c"),
        (2, 2, "d e"),
    ]
    totals = spark.createDataFrame([(1, 2), (2, None), (2**21, 3)], "k long, n long")
    assert dict(ordinals.running_offsets(totals, ["k"], ["n"]).collect()) == {1: 0, 2: 2, 2**21: 2}


def test_a_null_last_turn(spark):
    rows = [(0, 0, "a"), (0, 1, None), (1, 0, "b c"), (1, 1, "d")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, text string")
    found = words.positioned_words(df, ["conv_id", "turn"]).orderBy("position").collect()
    assert [(r.position, r.word) for r in found] == list(enumerate("abcd"))


def test_repeated_and_other_keys_fail(spark):
    df = spark.createDataFrame([(1, "a b c"), (1, "d e f"), (2, "g")], "doc_id long, text string")
    with pytest.raises(Exception, match="repeated order key"):
        words.positioned_words(df, ["doc_id"]).collect()
    for kind in ("double", "string", "decimal(20,0)"):
        with pytest.raises(TypeError):
            words.positioned_words(df.withColumn("doc_id", df.doc_id.cast(kind)), ["doc_id"])


def test_buckets_of_large_positions(spark):
    positions = [0, 2**60, 2**61, 2**62 - 1, 2**62]
    df = spark.createDataFrame([(p,) for p in positions], "position long")
    width = -(-(2**62) // 3)
    found = {r.position: r.bucket for r in ordinals.position_buckets(df, 3).collect()}
    assert found == {p: min(p // width, 2) for p in positions}


def test_last_position_moves_no_text(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None), (3, "c")], "doc_id long, text string")
    last = words.last_position(df)
    assert last.first().max_position == 2
    assert words.last_position(df.limit(0)).first().max_position == 0
    plan = last._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan
