"""Text expressions: lines, sentences, words and the delimited text forms.

All of them stay inside generated JVM code: no Python, and no SQL lambda on the hot
paths (``array_remove`` and ``regexp_extract_all`` replace filter lambdas).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# These patterns decide what a line, sentence or word is.
LINE_BREAK = r"\r\n|\n|\r"
SENTENCE_BREAK = r"(?<=[.!?])\s+"
NOT_WORD_RUN = r"[^\w']+"
NOT_WORD_RUN_UNICODE = r"[^\p{L}\p{M}\p{N}_']+"
LATIN_WORD = r"[a-zA-Z0-9']+"
CONTROL_OR_SPACE_EDGES = r"^[\x00-\x20]+|[\x00-\x20]+\z"
WHOLE_NUMBER = r"^[+-]?[0-9]+\z"
# Every character up to U+0020.
CONTROLS = "".join(map(chr, range(0x21)))


def line_array(text: Column) -> Column:
    """Lines of a text. A final line break ends the last line, it does not open another."""
    body = F.regexp_replace(text, rf"({LINE_BREAK})\z", "")
    return F.when(text == "", F.array().cast("array<string>")).otherwise(
        F.split(body, LINE_BREAK)
    )


def sentence_array(line: Column) -> Column:
    """Sentences of one line, uncleaned: cut at white space after ``.``, ``!`` or ``?``."""
    return F.array_remove(F.split(line, SENTENCE_BREAK), "")


def clean_sentence(sentence: Column, unicode: bool = False) -> Column:
    """Lower-case words separated by single spaces; apostrophes and underscores stay.

    Replacing every other character by a space and then collapsing white space is the
    same as replacing each whole run of such characters, so one pass does both. The
    default keeps ASCII letters only; ``unicode`` keeps those of every script.
    """
    run = NOT_WORD_RUN_UNICODE if unicode else NOT_WORD_RUN
    return F.lower(F.trim(F.regexp_replace(sentence, run, " ")))


def clean_sentence_array(text: Column, unicode: bool = False) -> Column:
    """Cleaned, non-empty sentences of a whole text, line by line, in order.

    A sentence break inside a line and a line break both end a sentence and cleaning
    drops surrounding white space, so both can become a newline that survives the
    cleaning pass. That saves a nested loop over lines and sentences.
    """
    inner = (NOT_WORD_RUN_UNICODE if unicode else NOT_WORD_RUN).replace("[^", r"[^\n", 1)[:-1]
    # The mark before the white space goes with it, as cleaning would drop it: no look-behind.
    marked = F.regexp_replace(text, r"[.!?]\s+|[\r\n]+", "\n")
    # Every run but a single space, which would be replaced by itself between most words.
    run = f"{inner.replace('[^', '[^ ', 1)}{inner}*| {inner}+"
    cleaned = F.lower(F.trim(F.regexp_replace(marked, run, " ")))
    # Cut at one plain character, which takes no pattern.
    narrow = F.replace(F.replace(cleaned, F.lit(" \n"), F.lit("\n")), F.lit("\n "), F.lit("\n"))
    return F.array_remove(F.split(narrow, "\n"), "")


def whitespace_words(text: Column) -> Column:
    """White-space separated words, case and punctuation kept."""
    return F.array_remove(F.split(text, r"\s+"), "")


def whitespace_word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"\S+"))


def latin_words(text: Column) -> Column:
    """Runs of ASCII letters, digits and apostrophes, case kept."""
    return F.regexp_extract_all(text, F.lit(LATIN_WORD), F.lit(0))


def trim_controls(value: Column) -> Column:
    """Strip every character up to U+0020 from both ends (``F.trim`` strips spaces only)."""
    return F.regexp_replace(value, CONTROL_OR_SPACE_EDGES, "")


def positioned_word(value: Column) -> Column:
    """``pos_word`` text to ``struct<position, word>``, cut at the first underscore.

    Null where the text is malformed: no underscore, an empty side, or a position that
    is not a 64-bit integer. The number is matched before it is cast because a cast
    alone would accept surrounding spaces.
    """
    # Cut by position, not by pattern: a pattern over the whole word is many times slower.
    line = F.btrim(value, F.lit(CONTROLS))
    head = F.substring_index(line, "_", 1)
    word = F.substr(line, F.length(head) + 2)
    good = F.regexp_like(head, F.lit(WHOLE_NUMBER)) & (word != "")
    position = F.when(good, head.try_cast("bigint"))
    return F.when(
        position.isNotNull(), F.struct(position.alias("position"), word.alias("word"))
    )


def format_positioned(position: Column, word: Column) -> Column:
    return F.concat_ws("_", position.cast("string"), word)


def format_ids(token_ids: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(token_ids.cast("array<string>"), " "), F.lit("]"))


def format_tokenized(position: Column, word: Column, token_ids: Column) -> Column:
    return F.concat_ws("\t", format_positioned(position, word), format_ids(token_ids))


def tokenized_word(value: Column) -> Column:
    """``pos_word<TAB>[id id]`` text to ``struct<position, word, token_ids>``.

    The ids are taken after the last tab, so a word may look like a list of ids. Null
    where the text is malformed: no tab, no brackets, an id that is no number, or a
    position and word as in ``positioned_word``. ``words.tokenized_lines`` reads a whole
    table of them and makes each part once.
    """
    line = F.btrim(value, F.lit(CONTROLS))
    tail = F.substring_index(line, "\t", -1)
    head = positioned_word(F.left(line, F.length(line) - F.length(tail) - 1))
    ids = listed_ids(tail)
    good = head.isNotNull() & whole_ids(tail, ids)
    return F.when(
        good, F.struct(head["position"].alias("position"), head["word"].alias("word"), ids.alias("token_ids"))
    )


def listed_ids(tail: Column) -> Column:
    """The ids of ``[id id]`` text; null where one is none, or beyond 32 bits."""
    listed = F.btrim(tail, F.lit("[]"))
    return F.when(listed == "", F.array().cast("array<int>")).otherwise(
        F.split(listed, " ").try_cast("array<int>")
    )


def whole_ids(tail: Column, ids: Column) -> Column:
    """True if a text is a list in brackets of which every id was read, else false or null."""
    # Digits make no -1, and where an array with nulls does not hold a value it is unknown if it does.
    return F.regexp_like(tail, F.lit(r"^\[[0-9 ]*\]\z")) & ~F.array_contains(ids, -1)
