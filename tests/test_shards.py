import random
from collections import Counter

import pytest

from verbaloom.operators import encoding, shards


def table(spark, *tokens):
    rows = [(i + 1, list(t)) for i, t in enumerate(tokens)]
    return spark.createDataFrame(rows, "shard_id int, tokens array<int>")


def windows(tokens, size, stride):
    starts = range(0, len(tokens) - size, stride)
    return [(tokens[s : s + size], tokens[s + 1 : s + size + 1]) for s in starts]


def pairs_of(df):
    rows = df.orderBy("shard_id", "sample_idx").collect()
    return [(r.shard_id, r.sample_idx, r.input, r.target) for r in rows]


def test_nine_ids(spark):
    found = pairs_of(shards.window_pairs(table(spark, range(1, 10)), 3, 1))
    assert len(found) == 6
    assert found[0] == (1, 0, [1, 2, 3], [2, 3, 4])
    assert found[-1] == (1, 5, [6, 7, 8], [7, 8, 9])


def test_too_few_ids_give_no_pair(spark):
    short = table(spark, [1, 2], [], [1, 2, 3])
    assert pairs_of(shards.window_pairs(short, 3, 1)) == []
    assert shards.trainable_shards(short, 3).count() == 0
    assert shards.pair_counts(short, 3, 1).count() == 0


@pytest.mark.parametrize("size,stride", [(3, 1), (8, 2), (2, 5), (4, 4), (1, 1)])
def test_windows_and_pair_counts_of_any_length(spark, size, stride):
    random.seed(size * 10 + stride)
    tokens = [[random.randrange(6) for _ in range(n)] for n in range(0, 24)]
    df = table(spark, *tokens)
    expected = [
        (i + 1, k, a, b)
        for i, t in enumerate(tokens)
        for k, (a, b) in enumerate(windows(t, size, stride))
    ]
    assert pairs_of(shards.window_pairs(df, size, stride)) == expected
    counted = Counter(
        (shard, x, y) for shard, _, a, b in expected for x, y in zip(a, b)
    )
    found = shards.pair_counts(df, size, stride).collect()
    assert {(r.shard_id, r.token_id, r.next_id): r.n for r in found} == counted


def test_vocabulary_by_first_appearance(spark):
    df = table(spark, [9, 4, 9, 7], [7, 9])
    found = shards.shard_vocabulary(df).collect()
    assert {(r.shard_id, r.token_id): r.token_index for r in found} == {
        (1, 9): 0,
        (1, 4): 1,
        (1, 7): 2,
        (2, 7): 0,
        (2, 9): 1,
    }
    indexed = shards.indexed_tokens(df).orderBy("shard_id", "token_pos").collect()
    assert [r.token_index for r in indexed] == [0, 1, 0, 2, 0, 1]


def test_training_table_holds_indices(spark):
    df = table(spark, [9, 4, 9, 7, 9])
    assert pairs_of(shards.training_table(df, 2, 2)) == [
        (1, 0, [0, 1], [1, 0]),
        (1, 1, [0, 2], [2, 0]),
    ]


@pytest.mark.parametrize("partitions", [1, 5])
def test_results_do_not_depend_on_partitions(spark, partitions):
    random.seed(1)
    df = table(spark, *[[random.randrange(9) for _ in range(40)] for _ in range(9)])
    one = shards.pair_counts(df.coalesce(1)).collect()
    assert sorted(one) == sorted(shards.pair_counts(df.repartition(partitions)).collect())


def test_shown_windows_write_each_id_once(spark):
    import spark_queries

    for query in (spark_queries.q_window_pairs, spark_queries.q_corpus_windows):
        found = query(spark, "/root/testdata/sf0.001")
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert "array_join(cast" not in plan
        # Starts are laid out; windows are no lambda's.
        laid_out = [x for x in plan.splitlines() if "Generate" in x and "_start#" in x]
        assert laid_out and not any("lambda" in x or "slice" in x for x in laid_out)


def test_pieces_of_a_corpus_move_once(spark, tmp_path):
    import spark_queries

    rng = random.Random(4)
    texts = [" ".join(rng.choice(["so", "weiter", "etwas"]) for _ in range(i * 3)) for i in range(80)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    found = spark_queries.q_corpus_windows(spark, str(tmp_path))
    rows = found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # Ids move to their pieces, for both sides of the join at once, and then only halos do.
    lines = plan.splitlines()
    assert ["ReusedExchange" in x for x in lines if "REPARTITION_BY_NUM" in x] == [False, True]
    join = next(i for i, x in enumerate(lines) if "Join [piece#" in x)
    assert "ShuffledHashJoin" in lines[join] and all("ObjectHashAggregate" in x for x in lines[join + 1 : join + 3])
    assert plan.count("Exchange hashpartitioning(piece#") == 1
    one = spark_queries.tokens(spark, str(tmp_path)).orderBy("doc_id").collect()
    ids = [str(i) for r in one for i in r.tokens]
    want = [(s // 2, " ".join(ids[s : s + 8]), " ".join(ids[s + 1 : s + 9])) for s in range(0, len(ids) - 8, 2)]
    assert len(ids) > 5000 and sorted(map(tuple, rows)) == want


@pytest.mark.parametrize("first", [0, 1, 7])
def test_shards_are_numbered_from_the_first(spark, first):
    texts = spark.createDataFrame([(1, [1, 2, 3]), (2, []), (3, [4, 5])], "doc_id bigint, tokens array<int>")
    found = encoding.token_shards(texts, ["doc_id"], 2, first_shard=first).collect()
    assert sorted(map(tuple, found)) == [(first, [1, 2]), (first + 1, [3, 4]), (first + 2, [5])]


def test_windows_of_shards_longer_than_a_run(spark):
    for stride, length in ((1, 520), (2, 1032), (2, 1033), (2, 1034), (3, 4000), (30, 40_000)):
        tokens = list(range(length))
        df = spark.createDataFrame([(1, tokens), (2, [1] * 8), (3, [])], "shard_id int, tokens array<int>")
        found = shards.window_pairs(df, 8, stride).orderBy("sample_idx").collect()
        starts = range(0, length - 8, stride)
        assert [(r.shard_id, r.sample_idx, r.input, r.target) for r in found] == [
            (1, i, tokens[s : s + 8], tokens[s + 1 : s + 9]) for i, s in enumerate(starts)
        ]
