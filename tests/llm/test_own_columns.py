"""Columns of the user's that have the names of internal ones, or of results in other case."""

import pytest
from pyspark.sql import functions as F

from verbaloom.llm import decontamination, hilbert_shards, jaccard_join, pii, quality_rules
from verbaloom.llm import queries as llm
from verbaloom.llm import sentencepieces, token_counts
from verbaloom.llm.common import vocabulary_path

INTERNAL = [
    "_words", "_lines", "_grams", "_sorted", "_at", "_ROW", "_row", "_leaks_0", "_rank", "_redacted",
    "_own_row", "_own_kind", "_key", "_kind", "_x0", "_turn", "_axis0", "_group", "_n", "_salt", "row", "key",
    "kind", "place", "sketch", "node", "root", "own_key", "bin", "aside_0", "_dimension0",
]


def kept(columns):
    """Internal names, as they do not clash with each other in any case."""
    seen, found = {c.lower() for c in columns}, []
    for name in INTERNAL:
        if name.lower() not in seen:
            seen.add(name.lower())
            found.append(name)
    return found


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, f"some words of text number {i} mail a{i}@b.org " * (i % 7)) for i in range(40)]
    rows += [(None, None), (3, rows[3][1]), (99, rows[5][1])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    return df.select("*", *(F.concat(F.lit(f"{n}:"), "doc_id").alias(n) for n in kept(df.columns)))


def benchmark(spark):
    return spark.createDataFrame([(1, "an item that no document has in it")], "item_id bigint, text string")


OPERATORS = {
    "token_counts": lambda s, d: token_counts.token_counts(d, vocabulary_path(llm.BYTE_VOCABULARY), limit=10),
    "encode_texts": lambda s, d: sentencepieces.encode_texts(d, vocabulary_path(llm.PIECE_MODEL), decode=True),
    "with_leaks": lambda s, d: decontamination.with_leaks(d, benchmark(s)),
    "decontaminate": lambda s, d: decontamination.decontaminate(d, benchmark(s)),
    "with_pii": lambda s, d: pii.with_pii(d),
    "redact": lambda s, d: pii.redact(d),
    "one_of_each": lambda s, d: jaccard_join.one_of_each(d),
    "statistics": lambda s, d: quality_rules.with_statistics(d),
    "only_kept": lambda s, d: quality_rules.only_kept(
        quality_rules.with_verdict(quality_rules.with_statistics(d), [])
    ),
    "assign_shards": lambda s, d: hilbert_shards.assign_shards(d, ["_words", "doc_id"], 4),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_columns_come_back_unchanged(spark, docs, name):
    made = OPERATORS[name](spark, docs)
    own = kept(["doc_id", "text"])
    assert [c for c in made.columns if c in own] == own
    for r in made.select("doc_id", *(f"`{c}`" for c in own)).collect():
        assert all(v == (None if r[0] is None else f"{c}:{r[0]}") for c, v in zip(own, r[1:]))


@pytest.mark.parametrize(
    ("name", "results"),
    [("token_counts", ["N_TOKENS", "Over_Limit"]), ("with_pii", ["PII"]), ("encode_texts", ["Token_IDs"]),
     ("with_leaks", ["LEAKS"]), ("statistics", ["N_Words"]), ("assign_shards", ["CELL", "Shard", "SLOT"])],
)
def test_results_replace_names_in_other_case(spark, docs, name, results):
    clash = docs.select("doc_id", "text", "_words", *(F.lit("old").alias(c) for c in results))
    made = OPERATORS[name](spark, clash)
    for c in results:
        assert made.columns.count(c.lower()) == 1
        assert "old" not in {str(r[0]) for r in made.select(c).collect()}


def test_one_of_each_keeps_columns_of_any_type(spark, docs):
    odd = docs.select("doc_id", "text").selectExpr(
        "*", "parse_json('{\"a\": 1}') AS v", "map('k', doc_id) AS m", "cast(text AS binary) AS b"
    )
    made = jaccard_join.one_of_each(odd)
    assert made.dtypes == odd.dtypes
    rows = made.selectExpr("doc_id", "variant_get(v, '$.a', 'int') AS a", "m['k'] AS k").collect()
    assert rows and all(r.a == 1 and r.k == r.doc_id for r in rows)


def test_shards_of_one_hot_key_and_of_bytes(spark):
    """Rows of one key are spread over groups; a binary dimension is one like any other."""
    rows = [(None if i % 3 else 7, bytes([i % 50]), "same") for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id bigint, b binary, text string").repartition(4)
    found = hilbert_shards.assign_shards(df, ["b"], 8).collect()
    slots = sorted((r.shard, r.slot) for r in found)
    assert slots == [(s, k) for s in range(8) for k in range(500)]
    ordered = [r.b for r in sorted(found, key=lambda r: (r.shard, r.slot))]
    assert len(found) == 4000 and sum(a > b for a, b in zip(ordered, ordered[1:])) < 4000 * 0.3


def test_shards_are_several_files_of_short_runs(spark, tmp_path):
    rows = [(i, f"source-{i % 30:02}") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id bigint, source string")
    placed = hilbert_shards.assign_shards(df, ["source"], 4)
    hilbert_shards.write_shards(placed, str(tmp_path / "x"), 4)
    back = spark.read.parquet(str(tmp_path / "x"))
    assert back.count() == 3000
    files = back.groupBy(F.input_file_name()).agg(F.min("source").alias("a"), F.max("source").alias("b"))
    spans = [int(r.b[-2:]) - int(r.a[-2:]) for r in files.collect()]
    assert len(spans) >= 8 and max(spans) < 15
