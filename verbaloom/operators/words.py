"""Lines, sentences and words of a keyed text table.

``keys`` are the integer columns that identify a row and fix the corpus order, such as
``["doc_id"]`` or ``["conv_id", "turn"]``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verbaloom.functions import text as tx
from verbaloom.operators.ordinals import line_shard, record_shard, with_offsets
from verbaloom.sources.tables import stage_keyed


def numbered(
    df: DataFrame, keep: list[str], records: Column, number: str, name: str
) -> DataFrame:
    """One row per element of an array made from text, with its 0-based number.

    For a plain explode Spark adds "array is not empty" filters next to the scan, which
    make the array several times over. The outer form with a null check does not.
    """
    laid_out = df.select(*keep, F.posexplode_outer(records).alias(number, name))
    return laid_out.where(F.col(number).isNotNull())


def parsed(df: DataFrame, keep: list[str], form: Column) -> DataFrame:
    """keep, and the fields of a parsed form; rows with a malformed one, which is null, go.

    Spark moves a filter on the form below it and then parses a row once for the filter and
    again for every field. What a generator lays out is made once.
    """
    name = "_form"
    made = df.select(*keep, form.alias(name))
    fields = made.schema[name].dataType.names
    laid_out = made.select(*keep, F.explode(F.array(name)).alias(name))
    return laid_out.where(F.col(name).isNotNull()).select(*keep, *(f"{name}.{f}" for f in fields))


def tokenized_lines(df: DataFrame, keep: list[str], line: str = "line") -> DataFrame:
    """keep, position, word, token_ids of ``pos_word<TAB>[id id]`` lines, without the malformed:
    what ``text.tokenized_word`` gives.

    One expression makes a part again wherever it is named. Here every part is a column
    that is made once and then read.
    """
    line_of, tail = F.col("_line"), F.col("_tail")
    steps = df.select(*keep, F.btrim(F.col(line), F.lit(tx.CONTROLS)).alias("_line"))
    steps = steps.select(*keep, "_line", F.substring_index(line_of, "\t", -1).alias("_tail"))
    before = F.left(line_of, F.length(line_of) - F.length(tail) - 1)
    steps = steps.select(*keep, "_tail", before.alias("_head"))
    steps = positioned_lines(steps, [*keep, "_tail"], "_head")
    steps = steps.select(*keep, "_tail", "position", "word", tx.listed_ids(tail).alias("token_ids"))
    good = F.col("position").isNotNull() & tx.whole_ids(tail, F.col("token_ids"))
    form = F.when(good, F.struct("position", "word", "token_ids"))
    return parsed(steps, keep, form)


def positioned_lines(df: DataFrame, keep: list[str], line: str = "line") -> DataFrame:
    """keep, position, word of ``pos_word`` lines, both null where the line is malformed: what
    ``text.positioned_word`` gives, with every part made once."""
    head, number = F.col("_head"), F.col("_number")
    steps = df.select(*keep, F.btrim(F.col(line), F.lit(tx.CONTROLS)).alias("_head"))
    steps = steps.select(*keep, "_head", F.substring_index(head, "_", 1).alias("_number"))
    steps = steps.select(*keep, "_number", F.substr(head, F.length(number) + 2).alias("_word"))
    good = F.regexp_like(number, F.lit(tx.WHOLE_NUMBER)) & (F.col("_word") != "")
    steps = steps.select(*keep, "_word", F.when(good, number.try_cast("bigint")).alias("position"))
    word = F.when(F.col("position").isNotNull(), F.col("_word"))
    return steps.select(*keep, "position", word.alias("word"))


# What a staged corpus can bring with it: the number of records that a text is cut into.
COUNTS = ("words", "lines", "sentences", "kept_lines")


def staged_corpus(
    df: DataFrame,
    keys: list[str],
    text: str = "text",
    counts: tuple = COUNTS,
    unicode: bool = False,
    records: str | None = None,
) -> DataFrame:
    """keys, text, counts: a corpus in buckets of its keys, with the numbers of its words,
    lines, cleaned sentences and non-empty lines, as far as they are named.

    ``records``, ``sentences`` or ``kept_lines``, stages these records, already cut, with their
    number, in place of the text: what ``sentence_shards`` or ``line_shards`` lays out.

    Texts move once, here. The numbering operators below find a text's records counted
    and its row in place: they read texts once and shuffle counts only. Without it they
    read texts twice and move them each time.
    """
    body = F.col(text)
    cut = {"sentences": tx.clean_sentence_array(body, unicode), "kept_lines": _kept_lines(body)}
    number = {
        "words": tx.whitespace_word_count(body),
        "lines": F.size(tx.line_array(body)),
        **{name: F.size(made) for name, made in cut.items()},
    }
    placed = df.select(*keys, body.alias(text))
    # Counted where the texts have moved to: a small file would be counted by one task.
    placed = placed.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
    if records:
        placed = placed.select(*keys, F.struct(cut[records].alias(records)).alias("records"))
        size = F.size(F.col("records")[records]).cast("bigint")
        counted = placed.withColumn("counts", F.struct(size.alias(records)))
    else:
        counted = F.struct(*(number[c].cast("bigint").alias(c) for c in counts)).alias("counts")
        counted = placed.select(*keys, text, counted)
    return stage_keyed(counted, "corpus", keys)


def _count(df: DataFrame, name: str, count: Column) -> Column:
    """A staged corpus' own count, or the given one."""
    return _staged(df, "counts", name, count)


def _staged(df: DataFrame, column: str, name: str, made: Column) -> Column:
    kind = df.schema[column].dataType if column in df.columns else None
    return F.col(column)[name] if isinstance(kind, T.StructType) and name in kind.names else made


def lines(df: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """keys, line_no, line."""
    return numbered(df, keys, tx.line_array(F.col(text)), "line_no", "line")


def trimmed_lines(df: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """Non-empty lines, stripped of control characters and spaces at both ends."""
    return (
        lines(df, keys, text)
        .withColumn("line", tx.trim_controls(F.col("line")))
        .where("line <> ''")
    )


def sentences(df: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """keys, line_no, sentence_no (within the line), sentence."""
    cut = tx.sentence_array(F.col("line"))
    return numbered(lines(df, keys, text), [*keys, "line_no"], cut, "sentence_no", "sentence")


def clean_sentences(
    df: DataFrame, keys: list[str], text: str = "text", unicode: bool = False
) -> DataFrame:
    """keys, sentence_no (within the text), sentence."""
    found = tx.clean_sentence_array(F.col(text), unicode)
    return numbered(df, keys, found, "sentence_no", "sentence")


def split_words(df: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """keys, word_no (within the text), word: white-space words as written."""
    return numbered(df, keys, tx.whitespace_words(F.col(text)), "word_no", "word")


def extract_words(df: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """keys, word_no (within the text), word: ASCII letter-digit-apostrophe runs."""
    return numbered(df, keys, tx.latin_words(F.col(text)), "word_no", "word")


def word_counts(df: DataFrame, text: str = "text", lower: bool = False) -> DataFrame:
    """word, n over the whole corpus; counted per task before the one shuffle by word.

    ``lower`` gives the counts over cleaned sentences: cleaning removes what cannot be
    part of such a word and lower-cases the rest, so the sentences need not be built.
    """
    found = numbered(df, [], tx.latin_words(F.col(text)), "word_no", "word")
    if lower:
        found = found.withColumn("word", F.lower("word"))
    return found.groupBy("word").agg(F.count("*").alias("n"))


def positioned_words(df: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """keys, position, word: words numbered from 0 through the whole corpus.

    Offsets are found and joined per text, while it is still one row; words are only
    then laid out, so no shuffle carries one row per word.
    """
    count = _count(df, "words", tx.whitespace_word_count(F.col(text)))
    placed = with_offsets(df, keys, {"_first": count})
    words = tx.whitespace_words(F.col(text))
    return numbered(placed, [*keys, "_first"], words, "_i", "word").select(
        *keys, (F.col("_first") + F.col("_i")).alias("position"), "word"
    )


def last_position(df: DataFrame, text: str = "text") -> DataFrame:
    """max_position: the position of the corpus' last word, 0 if it has none.

    Positions run without gaps, so this is the number of words less one: one pass of
    partial sums, no shuffle of texts.
    """
    count = _count(df, "words", tx.whitespace_word_count(F.col(text)))
    total = F.coalesce(F.sum(count), F.lit(0)).cast("bigint")
    return df.agg(F.greatest(total - 1, F.lit(0)).alias("max_position"))


def word_shards(
    df: DataFrame, keys: list[str], lines_per_shard: int, text: str = "text"
) -> DataFrame:
    """shard_id, position, word: positioned words cut into shards of input lines."""
    body = F.col(text)
    weights = {
        "_first_line": _count(df, "lines", F.size(tx.line_array(body))),
        "_first_word": _count(df, "words", tx.whitespace_word_count(body)),
    }
    placed = with_offsets(df, keys, weights)
    # (line, word) pairs of the text, in order, so that one posexplode numbers the words.
    pairs = F.flatten(
        F.transform(
            tx.line_array(body),
            lambda line, i: F.transform(
                tx.whitespace_words(line), lambda w: F.struct(i.alias("line"), w.alias("word"))
            ),
        )
    )
    return numbered(placed, ["_first_line", "_first_word"], pairs, "_i", "_pair").select(
        line_shard(F.col("_first_line") + F.col("_pair.line"), lines_per_shard).alias("shard_id"),
        (F.col("_first_word") + F.col("_i")).alias("position"),
        F.col("_pair.word").alias("word"),
    )


def line_word_shards(lines: DataFrame, lines_per_shard: int, line: str = "line") -> DataFrame:
    """shard_id, position, word of a table of numbered lines (``line_no``, ``line``)."""
    return positioned_words(lines, ["line_no"], line).select(
        line_shard(F.col("line_no"), lines_per_shard).alias("shard_id"), "position", "word"
    )


def sentence_shards(
    df: DataFrame,
    keys: list[str],
    records_per_shard: int,
    text: str = "text",
    unicode: bool = False,
) -> DataFrame:
    """shard_id, ordinal, sentence: cleaned sentences in shards of equal record count."""
    records = _staged(df, "records", "sentences", tx.clean_sentence_array(F.col(text), unicode))
    count = _count(df, "sentences", F.size(records))
    return _record_shards(df, keys, records, count, "sentence", records_per_shard)


def line_shards(
    df: DataFrame, keys: list[str], records_per_shard: int, text: str = "text"
) -> DataFrame:
    """shard_id, ordinal, line: the raw-line mode, without sentence work."""
    records = _staged(df, "records", "kept_lines", _kept_lines(F.col(text)))
    count = _count(df, "kept_lines", F.size(records))
    return _record_shards(df, keys, records, count, "line", records_per_shard)


def _kept_lines(text: Column) -> Column:
    # Empty lines go, so a break of two characters may count twice: plain cuts, no pattern.
    cut = F.split(F.replace(text, F.lit("\r"), F.lit("\n")), "\n")
    trimmed = F.transform(cut, lambda line: F.btrim(line, F.lit(tx.CONTROLS)))
    return F.array_remove(trimmed, "")


def _record_shards(df, keys, records, count, name, records_per_shard) -> DataFrame:
    placed = with_offsets(df, keys, {"_first": count})
    ordinal = F.col("_first") + F.col("_i")
    return numbered(placed, ["_first"], records, "_i", name).select(
        record_shard(ordinal, records_per_shard).alias("shard_id"),
        ordinal.alias("ordinal"),
        name,
    )
