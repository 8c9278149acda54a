import random

import pytest
from pyspark.sql import functions as F

from verbaloom.operators import embeddings, encoding, words
from verbaloom.plans import chains


@pytest.fixture(scope="module")
def corpus(spark):
    random.seed(3)
    parts = ["Hello", "world,", "naïve", "étés", "日本語", "x_y", "don't", "42%", "[12]", "🙂"]
    rows = [
        (i * 7 - 20, " ".join(random.choice(parts) for _ in range(random.randrange(12))))
        for i in range(30)
    ]
    rows.append((1000, " ".join(random.choice(parts) for _ in range(700))))
    return rows, spark.createDataFrame(rows, "doc_id long, text string")


def test_two_words(spark, vocabulary, codec):
    df = spark.createDataFrame([(1, "hello world")], "doc_id long, text string")
    found = chains.word_token_counts(df, vocabulary).collect()
    assert {(r.word, tuple(r.token_ids), r.n) for r in found} == {
        (w, tuple(codec.encode_ordinary(w)), 1) for w in ("hello", "world")
    }


def test_partial_counts_add_up(spark, vocabulary):
    rows = [(1, "hello"), (2, "hello hello"), (3, "hello")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert [(r.word, r.n) for r in chains.word_token_counts(df, vocabulary).collect()] == [
        ("hello", 4)
    ]


def test_words_in_order_with_ids(corpus, vocabulary, codec):
    rows, df = corpus
    encoded = encoding.encode_texts(df, ["doc_id"], vocabulary)
    found = encoding.tokenized_words(encoded, ["doc_id"]).orderBy("position").collect()
    expected = [w for _, text in sorted(rows) for w in text.split()]
    assert [(r.position, r.word, r.token_ids) for r in found] == [
        (i, w, codec.encode_ordinary(w)) for i, w in enumerate(expected)
    ]


def test_null_and_empty_texts_encode(spark, vocabulary):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "a")], "doc_id long, text string")
    encoded = encoding.encode_texts(df, ["doc_id"], vocabulary).orderBy("doc_id").collect()
    assert [len(r.word_ids or []) for r in encoded] == [0, 0, 1]
    flat = encoding.encode_tokens(df, ["doc_id"], vocabulary).orderBy("doc_id").collect()
    assert [len(r.tokens or []) for r in flat] == [0, 0, 1]


@pytest.mark.parametrize("size", [1, 7, 100, 100_000])
def test_shards_cut_the_stream(corpus, vocabulary, codec, size):
    rows, df = corpus
    encoded = encoding.encode_tokens(df, ["doc_id"], vocabulary)
    stream = [
        t for _, text in sorted(rows) for w in text.split() for t in codec.encode_ordinary(w)
    ]
    if size == 7:
        flat = encoding.token_stream(encoded, ["doc_id"]).orderBy("token_pos").collect()
        assert [(r.token_pos, r.token_id) for r in flat] == list(enumerate(stream))
    found = encoding.token_shards(encoded, ["doc_id"], size).collect()
    assert {r.shard_id: r.tokens for r in found} == {
        i // size + 1: stream[i : i + size] for i in range(0, len(stream), size)
    }


def test_bracket_word_keeps_its_own_ids(spark, vocabulary, codec):
    df = spark.createDataFrame([(5, "[12]")], "position long, word string")
    found = encoding.encode_words(df, vocabulary).first()
    assert found.token_ids == codec.encode_ordinary("[12]")


def test_decode(spark, vocabulary, codec):
    ids = sorted({t for w in ("étés", "日本語", "plain") for t in codec.encode_ordinary(w)})
    df = spark.createDataFrame([(i,) for i in ids], "token_id int")
    found = {r.token_id: r.word for r in embeddings.with_words(df, vocabulary).collect()}
    assert found == {i: codec.decode([i]) for i in ids}


def test_every_token_decodes_as_the_codec_does(vocabulary, codec):
    found = vocabulary.tokens().collect()
    assert len(found) == codec.n_vocab
    different = [r for r in found if r.word != codec.decode([r.token_id])]
    assert different == []


def test_oversized_vocabulary_is_refused(spark, tmp_path, monkeypatch):
    path = tmp_path / "ranks.txt"
    path.write_text("IQ== 0\nIg== 1\n")
    monkeypatch.setattr(encoding, "MAX_VOCABULARY", 1)
    small = encoding.Vocabulary(spark, f"file://{path}", r"\S+")
    with pytest.raises(ValueError, match="more than 1 tokens"):
        small.encode(F.array(F.lit("!")))
    # Only the encoder's own copy is bounded: a join takes a rank file of any length.
    ids = spark.createDataFrame([(1,)], "token_id int")
    assert [r.word for r in embeddings.with_words(ids, small).collect()] == ['"']


def test_positioned_words_agree_with_tokenized(corpus, vocabulary):
    _, df = corpus
    plain = words.positioned_words(df, ["doc_id"]).select("position", "word")
    encoded = encoding.encode_texts(df, ["doc_id"], vocabulary)
    tokenized = encoding.tokenized_words(encoded, ["doc_id"]).select("position", "word")
    assert plain.exceptAll(tokenized).count() == 0 == tokenized.exceptAll(plain).count()


def test_encoder_holds_one_slice_of_a_batch_as_objects(monkeypatch, codec):
    import tracemalloc
    from types import SimpleNamespace

    import pyarrow as pa

    monkeypatch.setattr(encoding, "SLICE_WORDS", 1 << 10, raising=False)
    monkeypatch.setattr(encoding, "MEMO_WORDS", 1 << 10, raising=False)
    texts = [[f"w{i * 7919 % 1000003}-{j}" for j in range(200)] for i in range(200)] + [[], None, ["a", ""]]
    batch = pa.array(texts, pa.list_(pa.string()))
    expected = [[codec.encode_ordinary(w) for w in text or []] for text in texts]
    for flat in (False, True):
        shipped = SimpleNamespace(value={"codec": codec, "memo": {}})
        tracemalloc.start()
        found = encoding._batch_encoder(shipped, flat)(batch)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert found.to_pylist() == ([sum(x, []) for x in expected] if flat else expected)
        # 40,000 lists of ids take some 10 MB.
        assert peak < 4 << 20


def test_partitions_of_shards_grow_with_the_tokens(spark, monkeypatch):
    rows = [(i, list(range(i % 50)), i % 50) for i in range(200)]
    texts = spark.createDataFrame(rows, "doc_id bigint, tokens array<int>, n_tokens bigint")
    plain = encoding.token_shards(texts.drop("n_tokens"), ["doc_id"], 64)
    monkeypatch.setattr(encoding, "TASK_TOKENS", 100, raising=False)
    cut = encoding.token_shards(texts, ["doc_id"], 64)
    assert cut.rdd.getNumPartitions() == 49
    assert sorted(map(tuple, cut.collect())) == sorted(map(tuple, plain.collect()))
