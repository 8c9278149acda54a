"""A corpus staged by key: texts stay where they are."""

import re

import pytest
from pyspark.sql import functions as F

from verbaloom.operators import encoding, words
from verbaloom.plans import chains
from verbaloom.sources import tables

SF = "/root/testdata/sf0.001"
KEYS = ["doc_id"]


def moved(df):
    """The columns that the plan's exchanges carry, and the plan."""
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = df._jdf.queryExecution().explainString(mode)
    found = set()
    for columns in re.findall(r"\) (?:Broadcast)?Exchange\s*\nInput \[\d+\]: \[(.*)\]", text):
        found.update(re.findall(r"([A-Za-z_]\w*)#", columns))
    return found, text


@pytest.fixture(scope="module")
def corpus(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(10**6, None), (10**6 + 1, ""), (10**6 + 2, "a b\n\nc. D")], "doc_id bigint, text string")
    docs = docs.select("doc_id", "text").unionByName(odd)
    return docs, words.staged_corpus(docs, KEYS)


OPERATORS = {
    "positioned_words": lambda df: words.positioned_words(df, KEYS),
    "sentence_shards": lambda df: words.sentence_shards(df, KEYS, 100),
    "line_shards": lambda df: words.line_shards(df, KEYS, 100),
    "word_shards": lambda df: words.word_shards(df, KEYS, 100),
    "last_position": words.last_position,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_texts_do_not_move(corpus, name):
    docs, staged = corpus
    made, plain = OPERATORS[name](staged), OPERATORS[name](docs)
    columns, plan = moved(made)
    assert name == "last_position" or "text" in moved(plain)[0]
    assert "text" not in columns and "line" not in columns
    # One scan reads texts, the others counts.
    assert sum("text:" in s for s in re.findall(r"ReadSchema: (.*)", plan)) <= 1
    assert sorted(map(tuple, made.collect())) == sorted(map(tuple, plain.collect()))


def test_ids_do_not_move(spark, corpus, vocabulary):
    docs, _ = corpus
    tokens = chains.corpus_tokens(docs, KEYS, vocabulary)
    stream = encoding.token_stream(tokens, KEYS)
    assert "tokens" not in moved(stream)[0]
    positions = [r.token_pos for r in stream.orderBy("token_pos").collect()]
    assert positions == list(range(len(positions)))
    encoded = chains.encoded_corpus(docs, KEYS, vocabulary)
    assert not moved(encoding.tokenized_words(encoded, KEYS))[0] & {"words", "word_ids"}


@pytest.mark.parametrize("stage, encode", [("encoded_corpus", "encode_texts"), ("corpus_tokens", "encode_tokens")])
def test_texts_are_encoded_where_they_have_moved_to(corpus, vocabulary, monkeypatch, stage, encode):
    docs, _ = corpus
    plain, made = getattr(encoding, encode), []
    monkeypatch.setattr(encoding, encode, lambda *a: made.append(plain(*a)) or made[-1])
    staged = getattr(chains, stage)(docs, KEYS, vocabulary)
    # The one exchange lies below the encoder: it carries texts, which are narrower than words and ids.
    assert len(made) == 1 and moved(made[0])[0] == {"doc_id", "text"}
    want = plain(docs, KEYS, vocabulary)
    found = staged.select(*want.columns)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))


def test_staged_rows_lie_in_order(spark):
    rows = [(i * 7 % 50, i, f"t{i}") for i in range(200)]
    df = spark.createDataFrame(rows, "a int, b bigint, text string").repartition(3)
    staged = tables.stage_keyed(df, "some-rows", ["a", "b"])
    assert sorted(map(tuple, staged.collect())) == sorted(rows)
    files = staged.groupBy(F.input_file_name().alias("f")).agg(F.collect_list(F.struct("a", "b")).alias("k"))
    seen = set()
    for r in files.collect():
        assert [tuple(k) for k in r.k] == sorted(tuple(k) for k in r.k)
        assert not seen & set(r.k)
        seen |= set(r.k)


def test_own_columns_named_counts(spark):
    df = spark.createDataFrame([(1, "a b", 5), (2, "c", 6)], "doc_id bigint, text string, counts int")
    assert [r.word for r in words.positioned_words(df, KEYS).orderBy("position").collect()] == ["a", "b", "c"]
