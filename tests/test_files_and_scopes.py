"""Versions of shard folders, files of buckets, shards in pieces, windows across them, scopes."""

import os
import random

import pytest
from pyspark.sql import functions as F

from verbaloom.operators import ordinals, shards
from verbaloom.plans import chains
from verbaloom.sources import tables, text_files


def numbered(spark, n, shard_size):
    rows = [(i // shard_size + 1, i, f"line {i}") for i in range(n)]
    return spark.createDataFrame(rows, "shard_id bigint, ordinal bigint, line string")


def shown(spark, path):
    return sorted((r.shard_id, r.line) for r in text_files.read_shards(spark, path).collect())


# --- versions ------------------------------------------------------------------------


def test_a_failed_write_leaves_the_old_shards(spark, tmp_path):
    path = str(tmp_path / "shards")
    text_files.write_shards(numbered(spark, 30, 10), path, "ordinal", "line")
    before = shown(spark, path)
    assert [s for s, _ in before] == [1] * 10 + [2] * 10 + [3] * 10
    bad = numbered(spark, 40, 5).withColumn(
        "line", F.when(F.col("ordinal") == 33, F.raise_error(F.lit("lost")).cast("string")).otherwise("x")
    )
    with pytest.raises(Exception, match="lost"):
        text_files.write_shards(bad, path, "ordinal", "line")
    assert shown(spark, path) == before
    text_files.write_shards(numbered(spark, 4, 2), path, "ordinal", "line")
    assert shown(spark, path) == [(1, "line 0"), (1, "line 1"), (2, "line 2"), (2, "line 3")]
    # The one version that counts, its manifest and what was there before are all that is left.
    assert sum(name.startswith("version-") for name in os.listdir(path)) == 1


def test_other_files_of_the_folder_stay(spark, tmp_path):
    path = tmp_path / "shards"
    path.mkdir()
    (path / "notes.md").write_text("mine")
    for n in (6, 2):
        text_files.write_shards(numbered(spark, n, 2), str(path), "ordinal")
    assert (path / "notes.md").read_text() == "mine"
    found = spark.read.parquet(text_files.shard_folder(spark, str(path)))
    assert sorted(r.ordinal for r in found.collect()) == [0, 1]


def test_a_folder_without_a_manifest_is_read_as_it_is(spark, tmp_path):
    (tmp_path / "shard_id=00007").mkdir()
    (tmp_path / "shard_id=00007" / "part-0.txt").write_text("a\nb\n")
    assert shown(spark, str(tmp_path)) == [(7, "a"), (7, "b")]


# --- buckets -------------------------------------------------------------------------


def test_buckets_are_ordered_files_named_by_their_number(spark, tmp_path):
    path = str(tmp_path / "buckets")
    rows = [(p, 3 if p > 60 else p % 2) for p in range(100)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "position bigint, bucket int").repartition(5)
    text_files.write_buckets(df, path, 5, "position")
    names = sorted(n for n in os.listdir(path) if n.startswith("part-"))
    # Buckets 2 and 4 are empty; the first task leaves a file for the schema at most.
    assert [n[:10] for n in names] == ["part-00000", "part-00001", "part-00003"]
    for name in names:
        positions = [r.position for r in spark.read.parquet(f"{path}/{name}").collect()]
        assert positions == sorted(positions)
    found = text_files.read_buckets(spark, path).select("position", "bucket").collect()
    assert sorted(map(tuple, found)) == sorted(rows)
    for wrong in (5, -1, None):
        bad = spark.createDataFrame([(1, wrong)], "position bigint, bucket int")
        with pytest.raises(Exception, match="no such bucket"):
            text_files.write_buckets(bad, str(tmp_path / "bad"), 5, "position")


# --- shards of any length ------------------------------------------------------------


def test_one_long_file_is_read_by_many_tasks(spark, tmp_path):
    rng = random.Random(3)
    ids = [rng.randrange(50_000) for _ in range(60_000)]
    (tmp_path / "shard_00002.txt").write_text("".join(f"{i}\n" if k % 9 else f" {i} \n\n" for k, i in enumerate(ids)))
    for part in (1, 10, 9):
        folder = tmp_path / "shard_id=00005"
        folder.mkdir(exist_ok=True)
        (folder / f"part-{part}").write_text("\n".join(str(part * 1000 + k) for k in range(7)))
    (tmp_path / "shard_00009.txt").write_text("\n \n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        pieces = text_files.read_token_pieces(spark, str(tmp_path), piece_size=1000)
        found = {(r.shard_id, r.piece): r.tokens for r in pieces.collect()}
        file = str(tmp_path / "shard_00002.txt")
        blocks = spark.read.text(file).select("_metadata.file_block_start").distinct().count()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert blocks > 10
    assert sorted(found) == [(2, p) for p in range(60)] + [(5, 0)]
    assert [t for p in range(60) for t in found[2, p]] == ids
    assert found[5, 0] == [p * 1000 + k for p in (1, 9, 10) for k in range(7)]
    whole = {r.shard_id: r.tokens for r in text_files.read_token_shards(spark, str(tmp_path)).collect()}
    assert whole == {2: ids, 5: found[5, 0]}


def test_lines_that_are_no_ids_fail(spark, tmp_path):
    (tmp_path / "shard_00001.txt").write_text("1\nx\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        text_files.read_token_pieces(spark, str(tmp_path)).collect()
    (tmp_path / "shard_00001.txt").rename(tmp_path / "other.txt")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        text_files.read_token_pieces(spark, str(tmp_path)).collect()


def test_token_shards_are_written_and_read_without_a_row_for_each_id(spark, tmp_path):
    rng = random.Random(5)
    ids = {s: [rng.randrange(50_000) for _ in range(n)] for s, n in ((1, 25_000), (2, 3), (100_000, 1))}
    df = spark.createDataFrame(list(ids.items()), "shard_id int, tokens array<int>")
    path = str(tmp_path / "written")
    text_files.write_token_shards(df, path)
    lines = text_files.read_shards(spark, path).groupBy("shard_id").count().collect()
    assert {int(r.shard_id): r["count"] for r in lines} == {s: len(x) for s, x in ids.items()}
    folder = text_files.shard_folder(spark, path)
    found = text_files.read_token_shards(spark, folder, glob="part-*")
    assert {r.shard_id: r.tokens for r in found.collect()} == ids
    # The table staged by the scan has a row for each run of lines in an Arrow batch.
    staged = [t for t in found.inputFiles() if "token-lines" in t]
    assert staged and spark.read.parquet(*staged).count() < 20


# --- windows across pieces -----------------------------------------------------------


@pytest.mark.parametrize(("size", "window", "stride"), [(10, 8, 2), (10, 3, 1), (7, 3, 5), (9, 8, 30), (50, 8, 3)])
def test_windows_cross_pieces(spark, size, window, stride):
    rng = random.Random(size)
    rows, whole = [], []
    for sequence, n in enumerate((0, 1, window, window + 1, size, size + 1, 3 * size, 97)):
        ids = [rng.randrange(99) for _ in range(n)]
        whole.append((sequence, ids))
        rows += [(sequence, p, ids[p * size : (p + 1) * size]) for p in range(-(-n // size))]
    pieces = spark.createDataFrame(rows, "shard_id int, piece bigint, tokens array<int>").repartition(3)
    found = shards.piece_window_pairs(pieces, size, window, stride)
    want = shards.window_pairs(spark.createDataFrame(whole, "shard_id int, tokens array<int>"), window, stride)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))


def test_a_piece_is_longer_than_a_window(spark):
    pieces = spark.createDataFrame([(1, 0, [1])], "shard_id int, piece bigint, tokens array<int>")
    with pytest.raises(ValueError, match="longer"):
        shards.piece_window_pairs(pieces, 8, 8)


# --- scopes --------------------------------------------------------------------------


def test_a_scope_takes_its_tables_with_it(spark, tmp_path):
    folder = str(tmp_path / "job.steps")
    outside = tables.staging_folder(spark)
    with tables.scope(spark, folder) as job:
        kept = job.step("first", lambda: spark.range(5).toDF("x"))
        more = tables.stage(kept, "inside")
        assert more.count() == 5 and tables.staging_folder(spark).startswith(folder)
    assert not os.path.exists(folder) and tables.staging_folder(spark) == outside


def test_a_second_run_skips_finished_steps(spark, tmp_path):
    folder, made = str(tmp_path / "job.steps"), []

    def run(fail):
        with tables.scope(spark, folder) as job:
            first = job.step("first", lambda: made.append("first") or spark.range(5).toDF("x"))
            tables.stage(first, "loose")
            if fail:
                raise RuntimeError("lost")
            made.append("second")
            return job.step("second", lambda: first.where("x > 2")).count()

    with pytest.raises(RuntimeError, match="lost"):
        run(fail=True)
    assert sorted(os.listdir(folder)) == ["step-first"]
    assert run(fail=False) == 2
    assert made == ["first", "second"] and not os.path.exists(folder)


def test_a_chain_goes_on_after_a_failure(spark, tmp_path, vocabulary, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").limit(20)
    path, calls = str(tmp_path / "nearest"), []
    encode, nearest = chains.encoding.encode_tokens, chains.similarity.top_neighbours
    monkeypatch.setattr(chains.encoding, "encode_tokens", lambda *a: calls.append("tokens") or encode(*a))
    monkeypatch.setattr(chains.similarity, "top_neighbours", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        chains.write_nearest_words(docs, ["doc_id"], vocabulary, path)
    assert sorted(os.listdir(f"{path}.steps")) == ["step-tokens", "step-vectors"]
    monkeypatch.setattr(chains.similarity, "top_neighbours", nearest)
    chains.write_nearest_words(docs, ["doc_id"], vocabulary, path)
    assert calls == ["tokens"] and not os.path.exists(f"{path}.steps")
    want = chains.nearest_words(docs, ["doc_id"], vocabulary)
    key = lambda r: (r.token_id, r.rank, r.neighbour_id)
    assert sorted(map(key, spark.read.parquet(path).collect())) == sorted(map(key, want.collect()))
    chains.write_token_vectors(docs, ["doc_id"], vocabulary, str(tmp_path / "vectors"))
    assert spark.read.parquet(str(tmp_path / "vectors")).columns == ["token_id", "embedding", "word"]
    assert sorted(os.listdir(tmp_path)) == ["nearest", "vectors"]


def test_long_buckets_are_cut_into_files(spark, tmp_path):
    for last in (0, 3, 10, 99, 100):
        rows = [(p, f"w{p}") for p in range(last + 1)]
        df = spark.createDataFrame(rows, "position bigint, word string").repartition(3)
        plain = ordinals.position_buckets(df, 4)
        cut = ordinals.position_buckets(df, 4, parts=3)
        path = str(tmp_path / f"buckets-{last}")
        text_files.write_buckets(cut, path, 4, "position", parts=3)
        found = text_files.read_buckets(spark, path, 3).select("position", "word", "bucket").collect()
        assert sorted(map(tuple, found)) == sorted(map(tuple, plain.collect()))
        held = []
        for name in sorted(n for n in os.listdir(path) if n.startswith("part-")):
            held.append([r.position for r in spark.read.parquet(f"{path}/{name}").collect()])
        # In the order of names the files hold all rows in order, and none holds a whole bucket.
        assert sum(held, []) == list(range(last + 1))
        assert last < 99 or max(map(len, held)) <= 10
