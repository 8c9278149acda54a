import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from verbaloom.functions import text as tx
from verbaloom.operators import words


def values(spark, expression, *inputs):
    rows = [(i, value) for i, value in enumerate(inputs)]
    df = spark.createDataFrame(rows, "i int, v string")
    found = df.select("i", expression(F.col("v")).alias("x")).orderBy("i").collect()
    return [row.x for row in found]


def test_lines(spark):
    found = values(spark, tx.line_array, "a\nb\r\nc\rd", "a\n\n", "", "\n", "a")
    assert found == [["a", "b", "c", "d"], ["a", ""], [], [""], ["a"]]


def test_sentences_and_cleaning(spark):
    text = "Hi, Bob!  It's 3.5% up. ok"
    assert values(spark, tx.sentence_array, text) == [["Hi, Bob!", "It's 3.5% up.", "ok"]]
    assert values(spark, tx.clean_sentence_array, text) == [["hi bob", "it's 3 5 up", "ok"]]
    assert values(spark, tx.clean_sentence, "Été à Paris.", " a_B -- c'd ") == [
        "t paris",
        "a_b c'd",
    ]
    unicode = values(spark, lambda c: tx.clean_sentence(c, unicode=True), "Été à Paris.")
    assert unicode == ["été à paris"]


@settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.text(alphabet="aB9é'_.!? \t\n\r,-", max_size=40), min_size=1, max_size=30))
def test_whole_text_cleaning_equals_line_by_line(spark, texts):
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    whole = words.clean_sentences(df, ["doc_id"]).collect()
    single = words.sentences(df, ["doc_id"]).select(
        "doc_id", "line_no", "sentence_no", tx.clean_sentence(F.col("sentence")).alias("s")
    )
    expected = [
        (r.doc_id, r.s)
        for r in single.where("s <> ''").orderBy("doc_id", "line_no", "sentence_no").collect()
    ]
    assert [(r.doc_id, r.sentence) for r in sorted(whole)] == expected


def test_words(spark):
    assert values(spark, tx.whitespace_words, " Don't  stop,\tnow\n", "") == [
        ["Don't", "stop,", "now"],
        [],
    ]
    assert values(spark, tx.whitespace_word_count, " Don't  stop,\tnow\n", "") == [3, 0]
    assert values(spark, tx.latin_words, "Don't x_y café 42") == [
        ["Don't", "x", "y", "caf", "42"]
    ]


def test_trim_controls(spark):
    assert values(spark, tx.trim_controls, "\t\x01 a b \x1f\n", " \n") == ["a b", ""]


def test_positioned_words_are_cut_at_the_first_underscore(spark):
    lines = ["5_x_y", "_x", "7_", "q_x", "8_z", " 9_w \n", "99999999999999999999_x", "-3_n", "1 _x"]
    found = values(spark, tx.positioned_word, *lines)
    assert [tuple(p) if p else None for p in found] == [
        (5, "x_y"),
        None,
        None,
        None,
        (8, "z"),
        (9, "w"),
        None,
        (-3, "n"),
        None,
    ]


def test_formats(spark):
    row = spark.range(1).select(
        tx.format_tokenized(F.lit(5), F.lit("[12]"), F.array(F.lit(7), F.lit(8))).alias("x")
    )
    assert row.first().x == "5_[12]\t[7 8]"


def test_word_counts(spark):
    df = spark.createDataFrame([(1, "Hello hello. HELLO x"), (2, "x")], "doc_id long, text string")
    assert dict(words.word_counts(df).collect()) == {"Hello": 1, "hello": 1, "HELLO": 1, "x": 2}
    assert dict(words.word_counts(df, lower=True).collect()) == {"hello": 3, "x": 2}


def test_trimmed_lines(spark):
    df = spark.createDataFrame([(1, " 12 \n\n\t\n7")], "doc_id long, text string")
    assert [r.line for r in words.trimmed_lines(df, ["doc_id"]).orderBy("line_no").collect()] == [
        "12",
        "7",
    ]


def test_null_keys_are_an_error(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b")], "doc_id long, text string")
    with pytest.raises(Exception, match="null order key"):
        words.positioned_words(df, ["doc_id"]).collect()


def test_tokenized_words(spark):
    lines = ["5_[12]\t[7 8]", "6_a_b\t[]", "7_x\t[1 q]", "8_x [1]", "_x\t[1]", "9_a\tb\t[3]", None]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    found = df.select(tx.tokenized_word(F.col("line")).alias("p")).where("p is not null").select("p.*")
    assert sorted((r.position, r.word, r.token_ids) for r in found.collect()) == [
        (5, "[12]", [7, 8]),
        (6, "a_b", []),
        (9, "a\tb", [3]),
    ]


def test_malformed_forms_go_and_a_form_is_parsed_once(spark):
    forms = ["1_a_b", "+7_x", " 2_c \x01", "_a", "3_", "x4_d", "1 _a", "99999999999999999999_a", "5", None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(forms)], "i int, v string")
    found = words.parsed(df, ["i"], tx.positioned_word(F.col("v")))
    assert sorted(map(tuple, found.collect())) == [(0, 1, "a_b"), (1, 7, "x"), (2, 2, "c")]
    # A filter over the parse would parse again, and a pattern over the word is slow.
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if "Filter" in line]
    assert filters and not any("_" in line and "RLIKE" in line for line in filters)
    assert "regexp_extract" not in plan and "regexp_replace" not in plan


def test_tokenized_word_with_a_very_long_list_of_ids(spark):
    ids = list(range(40_000))
    line = f"3_ab\t[{' '.join(map(str, ids))}]"
    found = values(spark, tx.tokenized_word, line, line + "\t[]", line[:-1], "3_ab\t[1  2]", "3_ab\t[+1]")
    assert found[0] == (3, "ab", ids)
    # Ids are those after the last tab.
    assert found[1] == (3, line[2:], [])
    assert found[2:] == [None, None, None]


def test_tokenized_lines_are_the_parsed_forms_and_make_each_part_once(spark):
    lines = ["5_[12]\t[7 8]", "6_a_b\t[]", "7_x\t[1 q]", "8_x [1]", "_x\t[1]", "9_a\tb\t[3]", None]
    lines += [" \x01-3_c \t[007] ", "4_\t[1]", "x_y\t[1]", "2_z\t[9999999999]", "2_z\t[1  2]", "\t[1]", ""]
    lines += ["99999999999999999999_a\t[1]", "+1_ \u00e9\t[1 2]", "1_w\t[1]]", "1_w\t[ ]"]
    df = spark.createDataFrame(list(enumerate(lines)), "i int, line string")
    found = words.tokenized_lines(df, ["i"])
    forms = df.select("i", tx.tokenized_word(F.col("line")).alias("p")).where("p is not null").select("i", "p.*")
    rows = sorted(map(tuple, found.collect()))
    assert rows == sorted(map(tuple, forms.collect()))
    assert [r[0] for r in rows] == [0, 1, 5, 7, 15]
    # No lambda, and the trim of a line, its cut and the ids are in the plan once.
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan
    assert plan.count("split(") == 1 and plan.count("substring_index(") == 2


def test_positioned_lines_are_the_positioned_words_and_make_each_part_once(spark):
    lines = ["1_a_b", "+7_x", " 2_c \x01", "_a", "3_", "x4_d", "1 _a", "99999999999999999999_a", "5", "", None]
    df = spark.createDataFrame(list(enumerate(lines)), "i int, line string")
    found = words.positioned_lines(df, ["i"])
    expected = {0: (1, "a_b"), 1: (7, "x"), 2: (2, "c")}
    rows = {r.i: (r.position, r.word) for r in found.collect()}
    assert rows == {i: expected.get(i, (None, None)) for i in range(len(lines))}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("trim(") == 1 and plan.count("substring_index(") == 1 and plan.count("RLIKE") == 1
