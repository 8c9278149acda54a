"""Shard files written by the tasks, and records that are staged once."""

import os
import re

import pytest
from pyspark.sql import functions as F

from verbaloom.functions import text as tx
from verbaloom.operators import words
from verbaloom.sources import text_files

SF = "/root/testdata/sf0.001"
ODD = ["", None, "A.\r\n\r\nb!  C?d\n", " .\n. x", "it's  a_b.\tÉté, à\x0b!\x1fq", "\n \n", "a \n b\r", ". . . z"]


@pytest.fixture
def shards(spark):
    rows = [(i // 3, i, None if i == 7 else f"é {i}") for i in range(-4, 300)]
    return spark.createDataFrame(rows, "`a b` int, o long, v string").repartition(5)


def files(path):
    found = {}
    for folder, _, names in os.walk(path):
        for name in names:
            if name.startswith("part-"):
                with open(os.path.join(folder, name), encoding="utf-8") as file:
                    found.setdefault(os.path.basename(folder), []).append(file.read())
    return found


def test_local_shards_are_one_file_each_and_nothing_else(spark, shards, tmp_path):
    """Hadoop's local writer left a checksum file beside each, made by a process of its own."""
    text_files.write_shards(shards, str(tmp_path / "x"), "o", "v", "a b")
    found = files(tmp_path / "x")
    assert len(found) == 102 and all(len(f) == 1 for f in found.values())
    assert found["a b=00002"] == ["é 6\n\né 8\n"]
    names = [n for folder, _, some in os.walk(tmp_path / "x") if "a b=" in folder for n in some]
    assert len(names) == 102
    version = text_files.shard_folder(spark, str(tmp_path / "x"))
    assert all(n.startswith("a b=") for n in os.listdir(version))


def test_local_shards_are_those_of_other_file_systems(spark, shards, tmp_path, monkeypatch):
    text_files.write_shards(shards, str(tmp_path / "x"), "o", "v", "a b")
    text_files.write_shards(shards.where("o > 1000"), str(tmp_path / "none"), "o", "v", "a b")
    monkeypatch.setattr(text_files, "_local_folder", lambda spark, path: None)
    text_files.write_shards(shards, str(tmp_path / "y"), "o", "v", "a b")
    assert files(tmp_path / "x") == files(tmp_path / "y")
    assert spark.read.text(text_files.shard_folder(spark, str(tmp_path / "none"))).count() == 0


@pytest.mark.parametrize("name, cut", [("sentences", words.sentence_shards), ("kept_lines", words.line_shards)])
def test_staged_records_are_cut_once(spark, name, cut):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(10**6 + i, t) for i, t in enumerate(ODD)], "doc_id bigint, text string")
    docs = docs.unionByName(odd)
    staged = words.staged_corpus(docs, ["doc_id"], records=name)
    found = cut(staged, ["doc_id"], 100)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "regexp" not in plan and "split(" not in plan
    assert sorted(found.collect()) == sorted(cut(docs, ["doc_id"], 100).collect())


@pytest.mark.parametrize("unicode", [False, True])
def test_cleaned_sentences_by_their_definition(spark, unicode):
    def cleaned(text):
        if text is None:
            return None
        word = r"[^\w']+" if unicode else r"[^a-zA-Z0-9_']+"
        cut = re.split(r"(?<=[.!?])[ \t\n\x0b\f\r]+|[\r\n]+", text)
        return [s for s in (re.sub(word, " ", c).strip(" ").lower() for c in cut) if s]

    df = spark.createDataFrame([(t,) for t in ODD], "text string").repartition(1)
    found = df.select("text", tx.clean_sentence_array(F.col("text"), unicode).alias("s")).collect()
    assert [r.s for r in found] == [cleaned(r.text) for r in found]
    lines = df.select("text", words._kept_lines(F.col("text")).alias("s")).collect()
    for r in lines:
        cut = None if r.text is None else re.split(r"\r\n|\n|\r", r.text)
        edges = "".join(map(chr, range(33)))
        assert r.s == (None if cut is None else [s for s in (c.strip(edges) for c in cut) if s])
