import os
import random

import pytest
from pyspark.sql import functions as F

from verbaloom.operators import words
from verbaloom.sources import tables, text_files


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "deep" / "er").mkdir(parents=True)
    (tmp_path / "a.txt").write_bytes(b"one two\r\n\r\nthree")
    (tmp_path / "deep" / "b.txt").write_bytes(b"four\rfive\n")
    (tmp_path / "deep" / "er" / "part-r-00001").write_bytes(b"six [7]\n")
    return tmp_path


def test_lines_of_all_files_below(spark, folder):
    found = text_files.read_lines(spark, str(folder)).collect()
    assert sorted(r.line for r in found) == ["", "five", "four", "one two", "six [7]", "three"]
    flat = text_files.read_lines(spark, str(folder), recursive=False, glob="*.txt").collect()
    assert sorted(r.line for r in flat) == ["", "one two", "three"]
    parts = text_files.read_lines(spark, str(folder), glob="part-r-?????").collect()
    assert [r.line for r in parts] == ["six [7]"]


def test_numbered_lines_follow_path_order(spark, folder):
    found = text_files.read_numbered_lines(spark, str(folder)).orderBy("line_no").collect()
    assert [(r.line_no, r.line) for r in found] == [
        (0, "one two"),
        (1, ""),
        (2, "three"),
        (3, "four"),
        (4, "five"),
        (5, "six [7]"),
    ]


def test_numbered_lines_of_a_file_in_many_blocks(spark, tmp_path):
    lines = [f"{i} " + "x" * (i % 50) for i in range(5000)]
    (tmp_path / "big.txt").write_text("\n".join(lines))
    (tmp_path / "small.txt").write_text("last\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        found = text_files.read_numbered_lines(spark, str(tmp_path)).orderBy("line_no").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r.line for r in found] == lines + ["last"]
    assert [r.line_no for r in found] == list(range(5001))


def test_shards_of_numbered_lines_count_empty_lines(spark, folder):
    lines = text_files.read_numbered_lines(spark, str(folder))
    found = words.line_word_shards(lines, 2).orderBy("position").collect()
    assert [(r.shard_id, r.position, r.word) for r in found] == [
        (0, 0, "one"),
        (0, 1, "two"),
        (1, 2, "three"),
        (1, 3, "four"),
        (2, 4, "five"),
        (2, 5, "six"),
        (2, 6, "[7]"),
    ]


def test_whole_files(spark, folder):
    found = text_files.read_whole_files(spark, str(folder)).collect()
    assert {r.file_path.rsplit("/", 1)[1]: r.content for r in found} == {
        "a.txt": "one two\n\nthree\n",
        "b.txt": "four\nfive\n",
        "part-r-00001": "six [7]\n",
    }


def test_find_file(spark, folder):
    assert text_files.find_file(spark, str(folder), "b.txt").endswith("/deep/b.txt")
    assert text_files.find_file(spark, str(folder), "*.txt") is None
    assert text_files.find_file(spark, str(folder), "c.txt") is None
    assert text_files.find_file(spark, str(folder / "none"), "b.txt") is None
    assert text_files.find_file(spark, str(folder / "a.txt"), "a.txt") is None


def test_embedding_lines(spark, tmp_path):
    (tmp_path / "e.txt").write_text("a 64\t1,2\nb\t\nc\t1\t2\nd\tx,1\n\n e 7 \t 3, -4.5 \n")
    found = text_files.read_embeddings(spark, str(tmp_path)).collect()
    assert {(r.key, r.word, tuple(r.embedding)) for r in found} == {
        ("a 64", "a", (1.0, 2.0)),
        ("e 7", "e", (3.0, -4.5)),
    }
    rejected = text_files.read_rejected_embeddings(spark, str(tmp_path)).collect()
    assert {r.line for r in rejected} == {"b\t", "c\t1\t2", "d\tx,1"}


def test_write_and_overwrite_shards(spark, tmp_path):
    rows = [(1, 0, "a"), (1, 1, "b"), (2, 2, "c"), (3, 3, "d")]
    df = spark.createDataFrame(rows, "shard_id int, o long, v string")
    path = str(tmp_path / "shards")
    text_files.write_shards(df, path, "o", "v")
    text_files.write_shards(df.where("shard_id < 3"), path, "o", "v")
    found = text_files.read_shards(spark, path)
    assert {(r.shard_id, r.line) for r in found.collect()} == {(1, "a"), (1, "b"), (2, "c")}
    files = sorted(p for p in (tmp_path / "shards").glob("version-*/shard_id=*/part-*"))
    assert [f.parent.name for f in files] == ["shard_id=00001", "shard_id=00002"]
    assert files[0].read_text() == "a\nb\n"
    text_files.write_shards(df, path, "o")
    assert spark.read.parquet(text_files.shard_folder(spark, path)).count() == 4
    (tmp_path / "file").write_text("x")
    for write in (text_files.write_shards, text_files.write_shard_ranges):
        with pytest.raises(ValueError, match="not a directory"):
            write(df, str(tmp_path / "file"), "o")


def test_shard_ranges(spark, tmp_path):
    rows = [(i // 10 + 1, i, f"v{i}") for i in range(400)]
    df = spark.createDataFrame(rows, "shard_id int, o long, v string").repartition(7)
    path = str(tmp_path / "ranges")
    text_files.write_shard_ranges(df, path, "o")
    written = spark.read.parquet(path)
    assert sorted(map(tuple, written.collect())) == rows
    for file in written.inputFiles():
        found = [(r.shard_id, r.o) for r in spark.read.parquet(file).collect()]
        assert found == sorted(found)
    one = written.where("shard_id = 3")
    assert [r.o for r in one.orderBy("o").collect()] == list(range(20, 30))
    assert "EqualTo(shard_id,3)" in one._jdf.queryExecution().executedPlan().toString()


def test_write_lines(spark, tmp_path):
    df = spark.createDataFrame([("k", 1)], "k string, v int")
    text_files.write_lines(df, str(tmp_path / "x"), "v", key="k")
    assert spark.read.text(str(tmp_path / "x")).first().value == "k\t1"
    text_files.write_lines(df, str(tmp_path / "x"), "v")
    assert spark.read.text(str(tmp_path / "x")).first().value == "1"


def test_lines_in_compressed_files_of_bounded_length(spark, tmp_path):
    values = [f"{i}_wört\t[{i} {i + 1}]" for i in range(2500)]
    df = spark.createDataFrame([(v,) for v in values], "v string").repartition(2)
    plain, small = str(tmp_path / "plain"), str(tmp_path / "small")
    text_files.write_lines(df, plain, "v")
    text_files.write_lines(df, small, "v", compression="gzip", lines_per_file=500)
    files = [n for n in os.listdir(small) if n.startswith("part-")]
    assert all(n.endswith(".gz") for n in files) and len(files) >= 5
    per_file = text_files.read_lines(spark, small, glob="part-*").groupBy("file_path").count()
    assert max(r["count"] for r in per_file.collect()) <= 500
    for path in (plain, small):
        assert sorted(r.line for r in text_files.read_lines(spark, path, glob="part-*").collect()) == sorted(values)
    size = {path: sum(os.path.getsize(f"{path}/{n}") for n in os.listdir(path)) for path in (plain, small)}
    assert size[small] < size[plain] / 2


def test_parsed_tokenized_lines_leave_compressed_files_and_nothing_else(spark, tmp_path):
    import spark_queries

    rng = random.Random(3)
    texts = [" ".join(rng.choice(["so", "weiter", "été", "a_b", "[7]"]) for _ in range(i)) for i in range(300)]
    texts += ["", None, " x\n\ny\tz "]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    folder = tables.staging_folder(spark).removeprefix("file:")
    before = set(os.listdir(folder)) if os.path.exists(folder) else set()
    found = spark_queries.q_parse_tokenized(spark, str(tmp_path))
    rows = sorted(map(tuple, found.collect()))
    new = set(os.listdir(folder)) - before
    # The encoded table is gone; the lines are compressed.
    assert [n[:16] for n in new] == ["tokenized-lines-"]
    files = [n for n in os.listdir(f"{folder}/{new.pop()}") if n.startswith("part-")]
    assert files and all(n.endswith(".gz") for n in files)
    assert rows == sorted(map(tuple, spark_queries.q_tokenized_words(spark, str(tmp_path)).collect()))
    assert [r[1] for r in rows] == [w for t in texts for w in (t or "").split()]


def test_staged_tables_lie_in_the_shared_folder(spark):
    staged = tables.stage(spark.range(5).withColumn("x", F.array("id")), "try")
    assert staged.count() == 5
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert all(f.startswith(shared) for f in staged.inputFiles())


def test_staged_tables_can_be_dropped(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "shared_folder", lambda spark: f"file://{tmp_path}")
    assert tables.stage(spark.range(3), "try").count() == 3
    assert len(list(tmp_path.glob("verbaloom-*/try-*"))) == 1
    tables.drop_staged(spark)
    assert list(tmp_path.glob("verbaloom-*")) == []


def test_token_shards(spark, tmp_path):
    (tmp_path / "shard_00001.txt").write_text("5\n\n 7 \n5\n")
    (tmp_path / "shard_id=00002").mkdir()
    (tmp_path / "shard_id=00002" / "part-0").write_text("9\n")
    found = text_files.read_token_shards(spark, str(tmp_path)).collect()
    assert {r.shard_id: r.tokens for r in found} == {1: [5, 7, 5], 2: [9]}
    (tmp_path / "shard_00003.txt").write_text("x\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        text_files.read_token_shards(spark, str(tmp_path)).collect()


def test_shards_past_five_digits_keep_their_order(spark, tmp_path):
    rows = [(99_999, 0, "a"), (99_999, 1, "b"), (100_000, 2, "c"), (100_001, 3, "d")]
    df = spark.createDataFrame(rows, "shard_id int, o long, v string")
    path = str(tmp_path / "many")
    text_files.write_shards(df, path, "o", "v")
    found = text_files.read_numbered_lines(spark, path, glob="part-*").collect()
    assert sorted((r.line_no, r.line) for r in found) == list(enumerate("abcd"))
    plan = text_files.read_numbered_lines(spark, path)._jdf.queryExecution().executedPlan()
    assert "Window" not in plan.toString()


def test_overwriting_leaves_foreign_files(spark, tmp_path):
    df = spark.createDataFrame([(1, 0, "a")], "shard_id int, o long, v string")
    (tmp_path / "notes").mkdir()
    (tmp_path / "notes" / "keep.txt").write_text("mine")
    text_files.write_shards(df, str(tmp_path), "o", "v")
    text_files.write_shards(df, str(tmp_path), "o", "v")
    assert (tmp_path / "notes" / "keep.txt").read_text() == "mine"
    assert len(list(tmp_path.glob("version-*/shard_id=*/part-*"))) == 1


def test_files_are_found_by_whole_names(spark, tmp_path):
    (tmp_path / "o").mkdir()
    for name in ("hello", "help"):
        (tmp_path / "o" / name).write_text("x")
    for name in ("hello", "help"):
        found = text_files.find_file(spark, str(tmp_path / "o"), name)
        assert found is not None
        assert found.endswith(f"/o/{name}")


def test_token_shards_below_a_folder_with_a_number(spark, tmp_path):
    folder = tmp_path / "shard_7"
    (folder / "shard_id=00002").mkdir(parents=True)
    (folder / "shard_00001.txt").write_text("5\n6\n")
    (folder / "shard_id=00002" / "part-0").write_text("7\n")
    (folder / "shard_id=00002" / "part-1").write_text("8\n")
    found = text_files.read_token_shards(spark, str(folder)).collect()
    assert {r.shard_id: r.tokens for r in found} == {1: [5, 6], 2: [7, 8]}


def test_commas_at_the_end_of_a_vector(spark, tmp_path):
    (tmp_path / "e.txt").write_text("a\t1,2,\nb\t1,,2\n")
    found = text_files.read_embeddings(spark, str(tmp_path)).collect()
    assert [(r.key, r.embedding) for r in found] == [("a", [1.0, 2.0])]


def test_neighbour_lines(spark, tmp_path):
    from verbaloom.operators import similarity

    rows = [(1, "a", [1.0, 0.0]), (2, "b", [1.0, 1.0]), (3, "c", [0.0, 1.0])]
    df = spark.createDataFrame(rows, "id long, word string, embedding array<double>")
    found = similarity.neighbour_rows(df, "id", "word", 1)
    text_files.write_neighbours(found, str(tmp_path / "n"), "word")
    lines = {r.line for r in text_files.read_lines(spark, str(tmp_path / "n"), glob="part-*").collect()}
    assert {line.split("\t")[0] for line in lines} == {"a", "b", "c"}
    assert any(line.startswith("a\t1.0,0.0 b:0.70710678") for line in lines)
