"""The registered queries: every operator over the whole of the given tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verbaloom.functions import text as tx
from verbaloom.functions import vectors as vx
from verbaloom.operators import (
    approximate,
    embeddings,
    encoding,
    learned,
    ordinals,
    shards,
    similarity,
    words,
)
from verbaloom.operators.encoding import Vocabulary
from verbaloom.plans import chains
from verbaloom.sources import text_files
from verbaloom.sources.tables import new_path, read_table, scope, stage

try:
    import public_tokenizers

    FOLDER = os.path.dirname(public_tokenizers.__file__)
except ImportError:
    FOLDER = "/opt/tokenizers"

# The vocabulary of the registered queries and its split pattern.
RANK_FILE = f"{FOLDER}/byte_bpe_50k.tiktoken"
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

DOC = ["doc_id"]
RECORDS_PER_SHARD = 1000
LINES_PER_SHARD = 1000
ROWS_PER_FILE = 2_000_000
LINES_PER_FILE = 4_000_000
SETTINGS = chains.Settings()
LEARNED = 4


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, f"{sf}/documents.parquet", ["doc_id", "text"], deal=DOC)


def corpus(spark: SparkSession, sf: str, *counts: str, records: str | None = None) -> DataFrame:
    """The documents staged by key, with the named counts, or cut into the named records."""
    docs = read_table(spark, f"{sf}/documents.parquet", ["doc_id", "text"])
    return words.staged_corpus(docs, DOC, counts=counts, records=records)


def conversations(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["conv_id", "turn", "text"]
    return read_table(spark, f"{sf}/conversations.parquet", columns, deal=["conv_id", "turn"])


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["vec_id", "label", "embedding"]
    df = read_table(spark, f"{sf}/embeddings.parquet", columns, deal=["vec_id"])
    return df.withColumn("embedding", F.col("embedding").cast("array<double>"))


def vocabulary(spark: SparkSession) -> Vocabulary:
    return Vocabulary(spark, f"file://{RANK_FILE}", PATTERN)


def encoded(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, f"{sf}/documents.parquet", ["doc_id", "text"])
    return chains.encoded_corpus(docs, DOC, vocabulary(spark))


def tokens(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, f"{sf}/documents.parquet", ["doc_id", "text"])
    return chains.corpus_tokens(docs, DOC, vocabulary(spark))


def token_shards(spark: SparkSession, sf: str) -> DataFrame:
    return encoding.token_shards(tokens(spark, sf), DOC, SETTINGS.tokens_per_shard)


def six(column) -> F.Column:
    """Six decimals, without a negative zero."""
    return F.round(column, 6) + F.lit(0.0)


def millionths(vector) -> F.Column:
    """A vector as text: its elements in whole millionths."""
    scaled = F.transform(vector, lambda x: F.round(x * 1e6).cast("bigint"))
    return F.array_join(scaled.cast("array<string>"), ",")


def ids(column) -> F.Column:
    return F.array_join(F.col(column).cast("array<string>"), " ")


# --- lines, sentences, words ---------------------------------------------------------


def q_lines(spark, sf):
    return words.lines(documents(spark, sf), DOC)


def q_trim_lines(spark, sf):
    return words.trimmed_lines(documents(spark, sf), DOC)


def q_sentences(spark, sf):
    return words.sentences(documents(spark, sf), DOC)


def q_clean_sentences(spark, sf):
    return words.clean_sentences(documents(spark, sf), DOC)


def q_split_words(spark, sf):
    return words.split_words(documents(spark, sf), DOC)


def q_extract_words(spark, sf):
    return words.extract_words(documents(spark, sf), DOC)


def q_word_counts(spark, sf):
    return words.word_counts(documents(spark, sf))


def q_parse_positioned(spark, sf):
    """Every word in five positioned forms, of which the last three are malformed."""
    found = words.split_words(documents(spark, sf), DOC)
    no, word, cut = F.col("word_no").cast("string"), F.col("word"), F.lit("_")
    forms = F.array(
        F.concat(no, cut, word),
        F.concat(no, cut, word, cut, word),
        F.concat(cut, word),
        F.concat(no, cut),
        F.concat(F.lit("x"), no, cut, word),
    )
    laid_out = words.numbered(found, DOC, forms, "form", "value")
    return words.parsed(laid_out, ["doc_id", "form"], tx.positioned_word(F.col("value")))


# --- ordinals and shards -------------------------------------------------------------


def q_positioned_words(spark, sf):
    return words.positioned_words(corpus(spark, sf, "words"), DOC)


def q_conversation_positions(spark, sf):
    return words.positioned_words(conversations(spark, sf), ["conv_id", "turn"])


def q_sentence_shards(spark, sf):
    return words.sentence_shards(corpus(spark, sf, records="sentences"), DOC, RECORDS_PER_SHARD)


def q_line_shards(spark, sf):
    return words.line_shards(corpus(spark, sf, records="kept_lines"), DOC, RECORDS_PER_SHARD)


def q_word_shards(spark, sf):
    return words.word_shards(corpus(spark, sf, "lines", "words"), DOC, LINES_PER_SHARD)


def q_position_buckets(spark, sf):
    docs = corpus(spark, sf, "words")
    last = words.last_position(docs).scalar()
    placed = words.positioned_words(docs, DOC)
    return ordinals.position_buckets(placed, 4, largest=last).select("position", "bucket")


def q_bucket_files(spark, sf):
    """Positioned words written as files of buckets: what each bucket begins and ends with."""
    path = new_path(spark, "position-buckets")
    docs = corpus(spark, sf, "words")
    placed = words.positioned_words(docs, DOC)
    last = words.last_position(docs).first()[0]
    parts = last // (4 * ROWS_PER_FILE) + 1
    buckets = ordinals.position_buckets(placed, 4, largest=F.lit(last).cast("bigint"), parts=parts)
    text_files.write_buckets(buckets, path, 4, "position", parts=parts)
    return text_files.read_buckets(spark, path, parts).groupBy("bucket").agg(
        F.count("*").alias("n"),
        F.min("position").alias("first_position"),
        F.max("position").alias("last_position"),
        F.min_by("word", "position").alias("first_word"),
        F.max_by("word", "position").alias("last_word"),
    )


def q_shard_ranges(spark, sf):
    """Cleaned sentences in files of shard ranges, read back shard by shard."""
    path = new_path(spark, "shard-ranges")
    cut = words.sentence_shards(corpus(spark, sf, records="sentences"), DOC, RECORDS_PER_SHARD)
    text_files.write_shard_ranges(cut, path, "ordinal")
    return spark.read.parquet(path).select("shard_id", "ordinal", "sentence")


def q_max_position(spark, sf):
    return words.last_position(documents(spark, sf))


# --- tokens --------------------------------------------------------------------------


def q_word_token_counts(spark, sf):
    counts = chains.word_token_counts(documents(spark, sf), vocabulary(spark))
    return counts.select("word", ids("token_ids").alias("token_ids"), "n")


def q_tokenized_words(spark, sf):
    return encoding.tokenized_words(encoded(spark, sf), DOC).select(
        "position", "word", ids("token_ids").alias("token_ids")
    )


def q_format_tokenized(spark, sf):
    placed = encoding.tokenized_words(encoded(spark, sf), DOC)
    line = tx.format_tokenized(F.col("position"), F.col("word"), F.col("token_ids"))
    return placed.select(line.alias("line"))


def q_token_stream(spark, sf):
    return encoding.token_stream(tokens(spark, sf), DOC)


def q_token_shards(spark, sf):
    found = token_shards(spark, sf)
    return found.select("shard_id", F.posexplode("tokens").alias("token_pos", "token_id"))


def q_decode_tokens(spark, sf):
    """The distinct tokens of the corpus, decoded, with their counts."""
    counted = encoding.token_stream(tokens(spark, sf), DOC).groupBy("token_id").agg(
        F.count("*").alias("n")
    )
    return embeddings.with_words(counted, vocabulary(spark)).select("token_id", "word", "n")


# --- token shards --------------------------------------------------------------------


def q_shard_vocab(spark, sf):
    return shards.shard_vocabulary(token_shards(spark, sf))


def q_indexed_tokens(spark, sf):
    return shards.indexed_tokens(token_shards(spark, sf))


def _shown_pairs(pairs):
    return pairs.select(
        "shard_id", "sample_idx", ids("input").alias("input"), ids("target").alias("target")
    )


def _written_tokens(df):
    """Ids as text before windows repeat them: each is written once, not in every window."""
    return df.withColumn("tokens", F.col("tokens").cast("array<string>"))


def q_window_pairs(spark, sf):
    cut = _written_tokens(token_shards(spark, sf))
    return _shown_pairs(shards.window_pairs(cut, SETTINGS.window_size, SETTINGS.stride))


def q_corpus_windows(spark, sf):
    """The window pairs of the whole corpus as one sequence, in pieces of 1,000 tokens."""
    pieces = encoding.token_shards(tokens(spark, sf), DOC, 1000, first_shard=0).select(
        F.lit(1).alias("shard_id"), F.col("shard_id").alias("piece"), "tokens"
    )
    return _shown_pairs(
        shards.piece_window_pairs(_written_tokens(pieces), 1000, SETTINGS.window_size, SETTINGS.stride)
    ).drop("shard_id")


def q_training_table(spark, sf):
    return _shown_pairs(
        shards.training_table(token_shards(spark, sf), SETTINGS.window_size, SETTINGS.stride)
    )


def q_trainable_shards(spark, sf):
    """Shards of nine tokens, so that a window of eight fits all but a short last one."""
    cut = encoding.token_shards(tokens(spark, sf), DOC, 9)
    return shards.trainable_shards(cut, SETTINGS.window_size).select(
        "shard_id", F.size("tokens").alias("n_tokens")
    )


def q_pair_counts(spark, sf):
    return shards.pair_counts(token_shards(spark, sf), SETTINGS.window_size, SETTINGS.stride)


# --- vectors -------------------------------------------------------------------------


def q_shard_embeddings(spark, sf):
    return embeddings.shard_embeddings(token_shards(spark, sf)).select(
        "shard_id", "token_id", millionths("embedding").alias("embedding")
    )


def q_token_embeddings(spark, sf):
    found = chains.token_vectors(tokens(spark, sf), DOC, vocabulary(spark), SETTINGS)
    return found.select("token_id", "word", millionths("embedding").alias("embedding"))


def q_learned_vectors(spark, sf):
    """Vectors of four elements after two steps of the power iteration."""
    found = learned.learned_vectors(token_shards(spark, sf), dimensions=LEARNED)
    return found.select("token_id", millionths("embedding").alias("embedding"))


def q_word2vec_vectors(spark, sf):
    """Every token of a trainable shard has a learned vector of the asked length, all finite."""
    found = learned.learned_vectors(token_shards(spark, sf), dimensions=16)
    finite = ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return found.select("token_id", F.size("embedding").alias("length"), finite.alias("is_finite"))


def q_mean_embeddings(spark, sf):
    mean = embeddings.mean_embeddings(vectors(spark, sf), ["label"])
    return mean.select("label", millionths("embedding").alias("embedding"))


# --- similarity ----------------------------------------------------------------------


def q_vector_norms(spark, sf):
    return similarity.with_norms(vectors(spark, sf)).select("vec_id", six("norm").alias("norm"))


def q_dot_products(spark, sf):
    """Each vector with the one that follows it."""
    found = vectors(spark, sf)
    following = found.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("b"))
    pairs = found.select("vec_id", F.col("embedding").alias("a")).join(following, "vec_id")
    return pairs.select("vec_id", six(vx.dot(F.col("a"), F.col("b"))).alias("dot"))


def q_cosine_pairs(spark, sf):
    """Each vector with the mean vector of its label."""
    found = vectors(spark, sf)
    mean = stage(embeddings.mean_embeddings(found, ["label"]), "means")
    mean = mean.withColumnRenamed("embedding", "b")
    pairs = found.withColumnRenamed("embedding", "a").join(mean, "label")
    return similarity.pair_cosines(pairs).select(
        "vec_id", "label", six("dot").alias("dot"), six("cosine").alias("cosine")
    )


def q_cosine_topn(spark, sf):
    found = vectors(spark, sf).withColumn("word", F.col("vec_id").cast("string"))
    top = similarity.top_neighbours(found, "vec_id", "word", SETTINGS.top_n)
    return top.select("vec_id", "rank", "neighbour_id", six("similarity").alias("similarity"))


def q_approximate_topn(spark, sf):
    """Nearly the rows of ``cosine_topn``, which is exact: see its recall in the tests."""
    found = vectors(spark, sf).withColumn("word", F.col("vec_id").cast("string"))
    top = approximate.approximate_neighbours(found, "vec_id", "word", SETTINGS.top_n)
    return top.select("vec_id", "rank", "neighbour_id", six("similarity").alias("similarity"))


def q_neighbours(spark, sf):
    """Neighbour lists over words that many vectors share: the labels."""
    found = vectors(spark, sf).withColumn("word", F.col("label").cast("string"))
    rows = similarity.neighbour_rows(found, "vec_id", "word", SETTINGS.top_n)
    return rows.select(
        "vec_id", "word", F.array_join(F.col("neighbours.id").cast("array<string>"), " ").alias("ids")
    )


def q_dedupe_last(spark, sf):
    return similarity.last_per_word(vectors(spark, sf), "label", "vec_id").select(
        "label", "vec_id", millionths("embedding").alias("embedding")
    )


def q_nearest_words(spark, sf):
    top = chains.nearest_words(documents(spark, sf), DOC, vocabulary(spark), SETTINGS)
    return top.withColumn("similarity", six("similarity"))


def q_written_nearest_words(spark, sf):
    """The same, written in steps that a failed run leaves to the next, and read back."""
    path = new_path(spark, "written-nearest-words")
    chains.write_nearest_words(documents(spark, sf), DOC, vocabulary(spark), path, SETTINGS)
    return spark.read.parquet(path).withColumn("similarity", six("similarity"))


# --- text files ----------------------------------------------------------------------


def q_text_shards(spark, sf):
    """Positioned words written as text shards, read back and parsed."""
    placed = words.word_shards(corpus(spark, sf, "lines", "words"), DOC, LINES_PER_SHARD)
    line = tx.format_positioned(F.col("position"), F.col("word"))
    path = new_path(spark, "word-shards")
    text_files.write_shards(placed.withColumn("value", line), path, "position", "value")
    return words.positioned_lines(text_files.read_shards(spark, path), ["shard_id"])


def _sentence_files(spark, sf) -> str:
    cut = words.sentence_shards(corpus(spark, sf, records="sentences"), DOC, RECORDS_PER_SHARD)
    path = new_path(spark, "sentence-shards")
    text_files.write_shards(cut, path, "ordinal", "sentence")
    return path


def _sentence_folder(spark, sf) -> str:
    return text_files.shard_folder(spark, _sentence_files(spark, sf))


def q_whole_files(spark, sf):
    """Sentence shards read one file per row."""
    files = text_files.read_whole_files(spark, _sentence_folder(spark, sf), glob="part-*")
    shard = F.regexp_extract("file_path", "shard_id=([0-9]+)", 1).cast("bigint")
    return files.select(
        shard.alias("shard_id"), F.length("content").alias("n_chars"), F.md5("content").alias("md5")
    )


def q_numbered_lines(spark, sf):
    """Sentence shards read as one numbered text."""
    return text_files.read_numbered_lines(spark, _sentence_folder(spark, sf), glob="part-*").select(
        "line_no", "line"
    )


def q_line_word_shards(spark, sf):
    """Words of numbered text lines, in shards of lines."""
    lines = text_files.read_numbered_lines(spark, _sentence_folder(spark, sf), glob="part-*")
    return words.line_word_shards(lines, 500)


def q_find_file(spark, sf):
    """The first data file below each shard folder is found by its exact name."""
    path = _sentence_folder(spark, sf)
    listed = text_files.read_lines(spark, path).agg(F.min("file_path")).first()[0]
    found = text_files.find_file(spark, path, listed.rsplit("/", 1)[1])
    return text_files.read_lines(spark, found).agg(F.count("*").alias("n_lines"))


def _embedding_files(spark, sf) -> str:
    """``id label<TAB>vector`` lines; those of labels 0 to 3 are malformed in four ways."""
    csv = vx.format_vector(F.col("embedding"))
    body = (
        F.when(F.col("label") == 0, F.lit(""))
        .when(F.col("label") == 1, F.concat(F.lit("\t"), csv, F.lit("\t"), csv))
        .when(F.col("label") == 2, F.concat(F.lit("\tx,"), csv))
        .when(F.col("label") == 3, F.lit("\t"))
        .otherwise(F.concat(F.lit("\t"), csv))
    )
    key = F.concat_ws(" ", F.concat(F.lit("v"), "vec_id"), "label")
    path = new_path(spark, "embedding-lines")
    text_files.write_lines(
        vectors(spark, sf).select(F.concat(key, body).alias("value")), path, "value"
    )
    return path


def q_import_embeddings(spark, sf):
    found = text_files.read_embeddings(spark, _embedding_files(spark, sf), glob="part-*")
    return found.select("key", "word", millionths("embedding").alias("embedding"))


def q_rejected_embeddings(spark, sf):
    found = text_files.read_rejected_embeddings(spark, _embedding_files(spark, sf), glob="part-*")
    return found.select(F.split("line", "\t")[0].alias("key"))


def q_imported_token_shards(spark, sf):
    """Token shards written as text, one id per line, and read back in pieces of 1,000 ids."""
    path = new_path(spark, "token-shards")
    text_files.write_token_shards(token_shards(spark, sf), path)
    folder = text_files.shard_folder(spark, path)
    found = text_files.read_token_pieces(spark, folder, piece_size=1000, glob="part-*")
    laid = found.select("shard_id", "piece", F.posexplode("tokens").alias("i", "token_id"))
    position = (F.col("piece") * 1000 + F.col("i")).cast("int")
    return laid.select("shard_id", position.alias("token_pos"), "token_id")


def _vector_files(spark, sf) -> str:
    """``v<id> <label><TAB>vector`` lines of all vectors."""
    key = F.concat_ws(" ", F.concat(F.lit("v"), "vec_id"), "label")
    lines = vectors(spark, sf).select(
        key.alias("key"), vx.format_vector(F.col("embedding")).alias("value")
    )
    path = new_path(spark, "vector-lines")
    text_files.write_lines(lines, path, "value", "key")
    return path


def q_imported_neighbours(spark, sf):
    """Nearest words of embedding lines."""
    found = text_files.read_embeddings(spark, _vector_files(spark, sf), glob="part-*")
    top = similarity.top_neighbours(found, "key", "word", SETTINGS.top_n)
    return top.select("key", "rank", "neighbour", six("similarity").alias("similarity"))


def q_imported_neighbours_by_word(spark, sf):
    """The same where words repeat: the last vector of each label stands for it."""
    found = text_files.read_embeddings(spark, _vector_files(spark, sf), glob="part-*")
    label = F.split("key", " ")[1]
    number = F.substring("word", 2, 20).cast("bigint")
    named = found.select(label.alias("word"), number.alias("vec_id"), "embedding")
    last = similarity.last_per_word(named, "word", "vec_id")
    top = similarity.top_neighbours(last, "vec_id", "word", SETTINGS.top_n)
    return top.select("word", "rank", "neighbour", six("similarity").alias("similarity"))


def q_neighbour_lines(spark, sf):
    """Neighbour lists written as text lines, read back and cut."""
    found = vectors(spark, sf).withColumn("word", F.concat(F.lit("v"), "vec_id"))
    rows = similarity.neighbour_rows(found, "vec_id", "word", SETTINGS.top_n)
    path = new_path(spark, "neighbour-lines")
    text_files.write_neighbours(rows, path, "word")
    lines = text_files.read_lines(spark, path, glob="part-*")
    parts = F.split(F.split("line", "\t")[1], " ")
    named = F.transform(F.slice(parts, 2, SETTINGS.top_n), lambda p: F.split(p, ":")[0])
    return lines.select(
        F.split("line", "\t")[0].alias("word"),
        millionths(vx.parse_vector(parts[0])).alias("embedding"),
        F.array_join(named, " ").alias("neighbours"),
    )


def q_parse_tokenized(spark, sf):
    """Tokenized text written, read back and parsed.

    The lines are several times as long as the texts, so their files are compressed, and the
    encoded table goes as soon as they are written.
    """
    path = new_path(spark, "tokenized-lines")
    with scope(spark, new_path(spark, "tokenized-steps")):
        lines = q_format_tokenized(spark, sf)
        text_files.write_lines(lines, path, "line", compression="gzip", lines_per_file=LINES_PER_FILE)
    read = text_files.read_lines(spark, path, glob="part-*")
    return words.tokenized_lines(read, []).select("position", "word", ids("token_ids").alias("token_ids"))


def q_overwritten_shards(spark, sf):
    """Shards of all sentences, replaced by those of all lines."""
    path = _sentence_files(spark, sf)
    cut = words.line_shards(corpus(spark, sf, records="kept_lines"), DOC, RECORDS_PER_SHARD)
    text_files.write_shards(cut, path, "ordinal", "line")
    return text_files.read_shards(spark, path)


def queries():
    return {
        name.removeprefix("q_"): _plain(function)
        for name, function in globals().items()
        if name.startswith("q_")
    }


def _plain(function):
    """Whole numbers as bigint, whatever their width inside."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = function(spark, sf_dir)
        return df.select(
            *(
                F.col(name).cast("bigint").alias(name) if kind in ("int", "smallint") else name
                for name, kind in df.dtypes
            )
        )

    return run
