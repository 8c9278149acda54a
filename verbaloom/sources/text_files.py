"""Plain text in and out: lines, whole files, shard files, embedding lines."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from verbaloom.functions import vectors as vx
from verbaloom.functions.text import CONTROLS, LINE_BREAK, trim_controls
from verbaloom.sources.tables import drop_path, stage

# The file that names the version of a folder's shards that counts.
MANIFEST = "_manifest"
# Ids in a piece of an imported shard.
PIECE_SIZE = 30_000
# The last shard number of a path: that of the file, or of the folder it lies in.
SHARD_NUMBER = r"^.*shard_(?:id=)?([0-9]+)(?:\.[^/]*)?(?:/[^/=]*)?$"


def _text(spark: SparkSession, path, recursive: bool, glob: str | None, whole: bool = False):
    return spark.read.text(
        path, wholetext=whole, recursiveFileLookup=recursive, pathGlobFilter=glob
    )


def read_lines(
    spark: SparkSession, path, recursive: bool = True, glob: str | None = None
) -> DataFrame:
    """file_path, line. ``glob`` picks files by name, such as ``part-*`` for the output
    files of a job."""
    return _text(spark, path, recursive, glob).select(
        F.col("_metadata.file_path").alias("file_path"), F.col("value").alias("line")
    )


def read_numbered_lines(
    spark: SparkSession, path, recursive: bool = True, glob: str | None = None
) -> DataFrame:
    """file_path, line_no, line: lines numbered from 0 through all files in path order.

    Spark numbers rows inside a file block as it reads them; the lines of the blocks
    before it are added, so no line is sorted to be numbered. How files are cut into
    blocks may change from one scan to the next, so lines and their place are staged by
    a single scan and both uses read that table.
    """
    placed = stage(
        _text(spark, path, recursive, glob).select(
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_seq"),
            F.col("value").alias("line"),
        ),
        "lines",
    )
    blocks = stage(
        placed.groupBy("file_path", "_block").agg(
            F.min("_seq").alias("_start"), F.count("*").alias("_n")
        ),
        "blocks",
    )
    # Files in the order of their paths, numbers in a path as numbers: shard 100000 follows
    # 99999. Blocks are summed inside their file, files inside a range of paths, and only
    # the ranges, one per shuffle partition, in one task.
    files = blocks.groupBy("file_path").agg(F.sum("_n").alias("_n"))
    files = files.withColumn("_key", natural_order(F.col("file_path")))
    ranged = files.repartitionByRange("_key", "file_path")
    ranged = stage(ranged.withColumn("_range", F.spark_partition_id()), "file-ranges")
    ranges = ranged.groupBy("_range").agg(F.sum("_n").alias("_n"))
    ranges = _before(ranges, [], ["_range"], "_in_all").drop("_n")
    starts = _before(ranged, ["_range"], ["_key", "file_path"], "_in_range").join(ranges, "_range")
    starts = starts.select("file_path", (F.col("_in_all") + F.col("_in_range")).alias("_file"))
    shifts = _before(blocks, ["file_path"], ["_block"], "_in_file").join(starts, "file_path")
    shift = F.col("_file") + F.col("_in_file") - F.col("_start")
    shifts = stage(shifts.select("file_path", "_block", shift.alias("_shift")), "shifts")
    return placed.join(shifts, ["file_path", "_block"]).select(
        "file_path", (F.col("_seq") + F.col("_shift")).alias("line_no"), "line"
    )


def natural_order(path: Column) -> Column:
    """A sort key in which runs of digits order as numbers: each is preceded by its length."""
    plain = F.regexp_replace(path, "(?<![0-9])0+(?=[0-9])", "")
    parts = F.regexp_extract_all(plain, F.lit("[0-9]+|[^0-9]+"), F.lit(0))
    number = F.lit("^[0-9]")
    keyed = F.transform(
        parts,
        lambda p: F.when(
            F.regexp_like(p, number), F.concat(F.lpad(F.length(p).cast("string"), 5, "0"), p)
        ).otherwise(p),
    )
    return F.array_join(keyed, "")


def _before(df: DataFrame, groups: list[str], order: list[str], name: str) -> DataFrame:
    """Add the sum of ``_n`` over the earlier rows of each group."""
    window = Window.partitionBy(*groups).orderBy(*order)
    total = F.sum("_n").over(window.rowsBetween(Window.unboundedPreceding, -1))
    return df.withColumn(name, F.coalesce(total, F.lit(0)))


def read_whole_files(
    spark: SparkSession, path, recursive: bool = True, glob: str | None = None
) -> DataFrame:
    """file_path, content: one row per file. Every line break becomes a newline and the
    last line ends with one.

    For small foreign files only: a row holds a file. The operators here group shards by
    ``shard_id`` instead.
    """
    content = F.regexp_replace("value", LINE_BREAK, "\n")
    closed = F.when(
        (content == "") | content.endswith("\n"), content
    ).otherwise(F.concat(content, F.lit("\n")))
    return _text(spark, path, recursive, glob, whole=True).select(
        F.col("_metadata.file_path").alias("file_path"), closed.alias("content")
    )


def find_file(spark: SparkSession, folder: str, name: str) -> str | None:
    """Path of the file called ``name`` anywhere below ``folder``, the first by path; None
    if there is none or ``folder`` is no directory. Reads the listing, not the files."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(target) or not system.getFileStatus(target).isDirectory():
        return None
    exact = re.sub(r"([*?\[\]{}\\])", r"\\\1", name)
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", exact)
        .load(folder)
    )
    return listing.agg(F.min("path")).first()[0]


def write_lines(
    df: DataFrame,
    path: str,
    value: str,
    key: str | None = None,
    compression: str | None = None,
    lines_per_file: int | None = None,
) -> None:
    """One text line per row: ``key<TAB>value``, or the value alone without a key.

    ``compression`` is Spark's name of a text codec, such as ``gzip``, which is told to be fast;
    readers know it by the files' names. One task reads a compressed file, so ``lines_per_file``
    bounds its length.
    """
    columns = [F.col(c).cast("string") for c in ([key] if key else []) + [value]]
    writer = df.select(F.concat_ws("\t", *columns).alias("value")).write.mode("overwrite")
    if compression:
        writer = writer.option("compression", compression).option("zlib.compress.level", "BEST_SPEED")
    if lines_per_file:
        writer = writer.option("maxRecordsPerFile", lines_per_file)
    writer.text(path)


def write_shards(
    df: DataFrame, path: str, order: str, value: str | None = None, shard: str = "shard_id"
) -> None:
    """Write each shard's rows in order, as ``path/version-*/shard_id=<number>/``, replacing
    the shards of an earlier write as a whole.

    The folder's manifest names the version that counts; it is moved into place when all
    shards are written, and only then are earlier versions deleted. Until then, and if the
    job fails, readers that go by the manifest (``read_shards``, ``shard_folder``) see the
    earlier shards. Of two writers at once the last to finish counts. Nothing else in the
    folder is touched.

    Parquet of all columns, or text lines of one column if ``value`` is named. A shard is
    bounded by its record count, so one task can write it; tasks hold many shards. In a local
    or mounted folder tasks write text files themselves: Hadoop's local file system starts a
    process for each folder, file and checksum that it makes, three a shard.
    Fails if ``path`` is a file. For millions of shards use ``write_shard_ranges``.
    """
    spark = df.sparkSession
    _need_folder(spark, path)
    # Five digits for readers that go by path order; ours order numbers of any length.
    # A format is read again for every row, so it is left to numbers that no length tells.
    plain = F.col(shard).cast("string")
    digits = F.lpad(plain, F.greatest(F.length(plain), F.lit(5)), F.lit("0"))
    named = F.when(F.col(shard) >= 0, digits).otherwise(F.format_string("%05d", shard))
    padded = df.withColumn(shard, named)
    laid_out = padded.repartition(shard).sortWithinPartitions(shard, order)
    version = f"version-{uuid.uuid4().hex}"
    if value is None:
        laid_out.write.partitionBy(shard).parquet(f"{path}/{version}")
    else:
        lines = laid_out.select(shard, F.col(value).cast("string").alias("value"))
        local = _local_folder(spark, path)
        if local is None:
            lines.write.partitionBy(shard).text(f"{path}/{version}")
        else:
            _write_local(lines, path, version, local)
    _publish(spark, path, version)


def write_shard_ranges(df: DataFrame, path: str, order: str, shard: str = "shard_id") -> None:
    """Write shards as Parquet files that each hold a run of consecutive shards, in order.

    No folder per shard, so their number does not matter. Readers that filter on the
    shard skip the other files and row groups by their statistics.
    """
    _need_folder(df.sparkSession, path)
    laid_out = df.repartitionByRange(shard, order).sortWithinPartitions(shard, order)
    laid_out.write.mode("overwrite").parquet(path)


def _need_folder(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if system.exists(target) and not system.getFileStatus(target).isDirectory():
        raise ValueError(f"not a directory: {path}")


def _local_folder(spark: SparkSession, path: str) -> str | None:
    """The path as the machine's own file system has it; None for any other file system."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = system.makeQualified(target).toUri()
    return found.getPath() if found.getScheme() == "file" else None


def _write_local(lines: DataFrame, path: str, version: str, local: str) -> None:
    """Write sorted rows of shard, value as ``shard_id=<number>/part-<number>.txt`` in a local
    folder. Files come from a folder of drafts by a move, so that a task that is run again
    replaces whole files."""
    spark, drafts = lines.sparkSession, f"{path}/{version}/_drafts"
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(drafts)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(hadoop_path)
    try:
        written = lines.mapInArrow(_file_writer(f"{local}/{version}", lines.columns[0]), "shard string")
        written.write.format("noop").mode("overwrite").save()
    except BaseException:
        drop_path(spark, f"{path}/{version}")
        raise
    drop_path(spark, drafts)


def _file_writer(folder: str, shard: str):
    """The function run on executors: it writes a file for each run of rows of one shard."""
    # As Spark names the folder of a partition.
    name = re.sub(r"[\x01-\x1f\x7f\"#%'*/:=?\\{\[\]^]", lambda c: f"%{ord(c[0]):02X}", shard)

    def write(batches):
        import os
        import uuid

        import pyarrow as pa
        import pyarrow.compute as pc

        number, out, draft = None, None, f"{folder}/_drafts/{uuid.uuid4().hex}"

        def finish():
            out.close()
            own = f"{folder}/{name}={number}"
            os.makedirs(own, exist_ok=True)
            os.replace(draft, f"{own}/part-{number}.txt")

        for batch in batches:
            numbers, values = batch.column(0), pc.fill_null(batch.column(1), "")
            if not len(numbers):
                continue
            other = pc.indices_nonzero(pc.not_equal(numbers[1:], numbers[:-1]))
            cuts = [0, *(i + 1 for i in other.to_pylist()), len(numbers)]
            runs = pc.binary_join(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), values), "\n")
            for start, lines in zip(cuts, runs):
                if numbers[start].as_py() != number:
                    if out:
                        finish()
                    number, out = numbers[start].as_py(), open(draft, "wb")
                out.write(lines.as_buffer())
                out.write(b"\n")
        if out:
            finish()
        yield from ()

    return write


def _publish(spark: SparkSession, path: str, version: str) -> None:
    """Make a version the one that counts, in one move, then delete the others."""
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    folder = hadoop.Path(path)
    system = folder.getFileSystem(conf)
    draft = hadoop.Path(folder, f"_manifest-{uuid.uuid4().hex}")
    out = system.create(draft, True)
    out.write(version.encode())
    out.close()
    options = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
    options[0] = getattr(hadoop, "Options$Rename").OVERWRITE
    files = hadoop.FileContext.getFileContext(system.getUri(), conf)
    files.rename(system.makeQualified(draft), system.makeQualified(hadoop.Path(folder, MANIFEST)), options)
    for found in system.listStatus(folder):
        name = found.getPath().getName()
        if found.isDirectory() and name.startswith("version-") and name != version:
            system.delete(found.getPath(), True)


def shard_folder(spark: SparkSession, path: str) -> str:
    """Where the shards of the version that counts lie; ``path`` itself without a manifest."""
    manifest = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path, MANIFEST)
    system = manifest.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(manifest):
        return path
    file = system.open(manifest)
    name = bytes(file.readAllBytes()).decode()
    file.close()
    return f"{path}/{name}"


def write_token_shards(
    df: DataFrame, path: str, tokens: str = "tokens", shard: str = "shard_id"
) -> None:
    """Write a table with one row per shard as text shards of one id per line, as
    ``write_shards`` does: a shard's lines are one value, so no row is made for each id.

    A shard without ids is a folder without ids.
    """
    lines = F.array_join(F.col(tokens).cast("array<string>"), "\n")
    write_shards(df.select(shard, lines.alias("value")), path, shard, "value", shard)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """shard_id, line of text shards; a filter on shard_id reads those shards only."""
    found = spark.read.text(shard_folder(spark, path))
    return found.select("shard_id", F.col("value").alias("line"))


def write_buckets(
    df: DataFrame, path: str, buckets: int, order: str, bucket: str = "bucket", parts: int = 1
) -> None:
    """Write one file per bucket, its rows in order, named by the bucket: ``part-00003-...``.

    Rows go to the task with their bucket's number, so a bucket is one task and file, as
    a reducer's output is. A bucket without rows has no file. A number that is null or not
    below ``buckets`` fails. An earlier table at ``path`` is replaced.

    A bucket too long for one task is written as ``parts`` files, told by the column ``part``
    of ``ordinals.position_buckets``: file ``bucket * parts + part``. In the order of their
    names they hold the bucket's rows in order.
    """
    number = F.col(bucket).cast("int")
    wrong = F.raise_error(F.concat(F.lit("no such bucket: "), F.coalesce(number.cast("string"), F.lit("null"))))
    known = F.when((number >= 0) & (number < buckets), number).otherwise(wrong.cast("int"))
    if parts == 1:
        laid_out = df.withColumn(bucket, known).repartitionById(buckets, F.col(bucket))
    else:
        file = known * parts + F.col("part")
        laid_out = df.withColumn(bucket, file).drop("part").repartitionById(buckets * parts, F.col(bucket))
    laid_out.sortWithinPartitions(order).drop(bucket).write.mode("overwrite").parquet(path)


def read_buckets(spark: SparkSession, path: str, parts: int = 1) -> DataFrame:
    """The rows of ``write_buckets`` with ``bucket``, by the names of their files."""
    number = F.regexp_extract(F.col("_metadata.file_name"), r"^part-([0-9]+)-", 1).cast("int")
    bucket = F.call_function("div", number, F.lit(parts)).cast("int")
    return spark.read.parquet(path).select("*", bucket.alias("bucket"))


def read_token_pieces(
    spark: SparkSession, path, piece_size: int = PIECE_SIZE, glob: str | None = None
) -> DataFrame:
    """shard_id, piece (from 0), tokens from text shards with one token id per line.

    The number is that of a file ``shard_00001.txt`` or a folder ``shard_id=00001`` at the
    path's end; other numbers above do not count. Several files of one shard are read
    in path order as one. Empty lines are skipped; a line that is no number, or a file
    without a shard number, is an error. A shard without ids has no piece.

    Files are read in blocks, each by its own task, and a shard of any length is cut into
    pieces of ``piece_size`` ids (the last one shorter): no row or task holds a whole file.
    """
    if piece_size <= 0:
        raise ValueError("piece_size must be positive")
    # Lines of a block follow each other in one task, which packs them: nothing after this
    # scan has a row for each id.
    value = F.col("value")
    # Most lines begin with a visible character, and need no trim to be told from empty ones.
    lines = _text(spark, path, True, glob).where((value >= "!") | (F.btrim(value, F.lit(CONTROLS)) != ""))
    lines = lines.select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("_block"),
        value.cast("int").alias("token_id"),
    )
    packed = "file_path string, _block bigint, _no bigint, ids array<int>"
    placed = stage(lines.mapInArrow(_id_packer(), packed), "token-lines")
    counted = placed.select("file_path", "_block", "_no", F.size("ids").cast("bigint").alias("_n"))
    blocks = counted.groupBy("file_path", "_block").agg(F.sum("_n").alias("_n"))
    number = F.regexp_extract("file_path", SHARD_NUMBER, 1).cast("bigint")
    blocks = blocks.withColumns({"shard_id": number, "_key": natural_order(F.col("file_path"))})
    starts = _before(blocks, ["shard_id"], ["_key", "file_path", "_block"], "_first").drop("_n", "_key")
    shifts = _before(counted, ["file_path", "_block"], ["_no"], "_in_block").join(
        starts, ["file_path", "_block"]
    )
    shifts = shifts.select(
        "shard_id", "file_path", "_block", "_no", (F.col("_first") + F.col("_in_block")).alias("_start")
    )
    laid_out = placed.join(stage(shifts, "pack-shifts"), ["file_path", "_block", "_no"])
    start, size = F.col("_start"), F.lit(piece_size).cast("bigint")
    end = start + F.size("ids")

    def part(piece):
        begin = F.greatest(piece * size, start)
        stop = F.least((piece + 1) * size, end)
        own = F.slice("ids", (begin - start + 1).cast("int"), (stop - begin).cast("int"))
        return F.struct(piece.alias("piece"), begin.alias("at"), own.alias("ids"))

    pieces = F.sequence(F.call_function("div", start, size), F.call_function("div", end - 1, size))
    cut = laid_out.select("shard_id", F.explode_outer(F.transform(pieces, part)).alias("_part"))
    found = cut.select(
        "shard_id", F.col("_part.piece").alias("piece"), F.struct("_part.at", "_part.ids").alias("_ids")
    )
    return found.groupBy("shard_id", "piece").agg(
        F.flatten(F.array_sort(F.collect_list("_ids"))["ids"]).alias("tokens")
    )


def _id_packer():
    """The function run on executors; it needs only pyarrow there. It gives the ids of lines
    as arrays, one for each run of lines of a file block in a batch, with its number in the task."""

    def pack(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        number = 0
        for batch in batches:
            files, blocks, ids = (batch.column(c) for c in ("file_path", "_block", "token_id"))
            if not len(ids):
                continue
            other = pc.or_(pc.not_equal(files[1:], files[:-1]), pc.not_equal(blocks[1:], blocks[:-1]))
            cuts = [0, *(i + 1 for i in pc.indices_nonzero(other).to_pylist()), len(ids)]
            first = pa.array(cuts[:-1])
            numbers = pa.array(range(number, number + len(first)), pa.int64())
            number += len(first)
            packed = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), ids)
            yield pa.RecordBatch.from_arrays(
                [files.take(first), blocks.take(first), numbers, packed],
                ["file_path", "_block", "_no", "ids"],
            )

    return pack


def read_token_shards(spark: SparkSession, path, glob: str | None = None) -> DataFrame:
    """shard_id, tokens: the same with a row for each shard, for shards of bounded length.

    ``read_token_pieces`` is the form for shards of any length.
    """
    pieces = F.array_sort(F.collect_list(F.struct("piece", "tokens")))
    found = read_token_pieces(spark, path, glob=glob).groupBy("shard_id").agg(pieces.alias("_p"))
    return found.select("shard_id", F.flatten(F.col("_p.tokens")).alias("tokens"))


def parse_embedding_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    """key, word, embedding, valid from ``key<TAB>x,x,x`` lines.

    ``word`` is the key up to its first space. A line is valid if it has exactly two tab
    parts and the second is a non-empty list of numbers.
    """
    trimmed = trim_controls(F.col(line))
    # Trailing empty parts do not count.
    parts = F.split(F.regexp_replace(trimmed, r"\t+\z", ""), "\t")
    key = trim_controls(F.get(parts, F.lit(0)))
    parsed = lines.select(
        F.col(line).alias("line"),
        key.alias("key"),
        F.get(F.split(key, " "), F.lit(0)).alias("word"),
        F.when(F.size(parts) == 2, vx.parse_vector(F.get(parts, F.lit(1)))).alias("embedding"),
    )
    return parsed.withColumn("valid", vx.is_vector(F.col("embedding")))


def read_embeddings(spark: SparkSession, path, glob: str | None = None) -> DataFrame:
    """key, word, embedding of the valid embedding lines."""
    found = parse_embedding_lines(read_lines(spark, path, glob=glob))
    return found.where("valid").select("key", "word", "embedding")


def write_neighbours(rows: DataFrame, path: str, word: str, embedding: str = "embedding") -> None:
    """``word<TAB>x,x,x w:s w:s`` lines of ``similarity.neighbour_rows``."""
    vector = vx.format_vector(F.col(embedding))
    value = F.concat_ws(" ", vector, F.nullif(vx.format_neighbours(F.col("neighbours")), F.lit("")))
    write_lines(rows.select(F.col(word).alias("_key"), value.alias("_value")), path, "_value", "_key")


def read_rejected_embeddings(spark: SparkSession, path, glob: str | None = None) -> DataFrame:
    """line: the non-empty lines ``read_embeddings`` leaves out."""
    found = parse_embedding_lines(read_lines(spark, path, glob=glob))
    return found.where(~F.col("valid") & (trim_controls(F.col("line")) != "")).select("line")
