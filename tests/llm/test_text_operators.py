"""Token counts, sentence pieces, id files, leaks and personal data against brute force."""

import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from verbaloom.llm import decontamination, id_files, pii, sentencepieces, token_counts
from verbaloom.llm import queries as llm
from verbaloom.llm.common import Memo, vocabulary_path
from verbaloom.sources.tables import new_path

SF = "/root/testdata/sf0.001"
JSON, MODEL = vocabulary_path("byte_bpe_50k.json"), vocabulary_path("piece_bpe_32k.model")
SCHEMA = "doc_id bigint, text string, n_tokens string, kind string"
LETTERS = [
    "a", "b", " ", "  ", "\n", " \n", "\t", "'s", "é", "É", "<|endoftext|>", "12", "½", " ",
    " ", "\x1c", "\x85", "中文", "🙂", "hello", " world", "aaa", "..", "\r\n", "▁", "<s>", "\x00",
]


def odd_texts(n=300, seed=3):
    rng = random.Random(seed)
    made = ["".join(rng.choices(LETTERS, k=rng.randint(0, 25))) for _ in range(n)]
    return [*made, "", None, None, "a" * 4000, "ab" * 2500, " " * 700, "hello" * 400]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, columns with clashing names."""
    rows = [(i // 2, t, "x", None) for i, t in enumerate(odd_texts())]
    return spark.createDataFrame([*rows, *rows[:40], (None, "no key", None, None)], SCHEMA)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(JSON)


@pytest.fixture(scope="module")
def pieces():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def documents(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def test_token_counts_are_the_librarys(spark, odd, library):
    found = token_counts.token_counts(odd, JSON, limit=20)
    assert found.columns == ["doc_id", "text", "kind", "n_tokens", "n_bytes", "over_limit"]
    rows = found.collect()
    assert len(rows) == odd.count()
    for r in rows:
        n = len(library.encode(r.text or "", add_special_tokens=False).ids)
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (n, len((r.text or "").encode()), n > 20)
    assert token_counts.token_counts(empty(spark), JSON).count() == 0


def test_op1_over_the_whole_table(spark, library):
    texts = documents(spark)
    rows = llm.q_op1_token_counts(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.n_tokens == len(library.encode(texts[r.doc_id], add_special_tokens=False).ids)


def test_memo_forgets_without_changing_values():
    memo = Memo(lambda keys: [k * 2 for k in keys], once=5, entries=8)
    rng = random.Random(1)
    for _ in range(200):
        wanted = {rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(4)}
        known = memo.fill(wanted)
        assert all(known[w] == w * 2 for w in wanted)
        assert len(known) <= 12


def test_sentence_pieces_are_the_librarys(spark, odd, pieces):
    rows = sentencepieces.encode_texts(odd, MODEL, decode=True).collect()
    assert len(rows) == odd.count()
    for r in rows:
        ids = pieces.encode(r.text or "")
        assert r.token_ids == ids
        assert r.decoded == pieces.decode(ids)
    assert sentencepieces.encode_texts(empty(spark), MODEL).count() == 0


def test_decoding_any_ids(spark, pieces):
    rng = random.Random(4)
    rows = [([rng.randrange(420) for _ in range(rng.randint(0, 12))], "x") for _ in range(400)]
    df = spark.createDataFrame([*rows, (None, "x")], "token_ids array<int>, decoded string")
    for r in sentencepieces.decode_ids(df, MODEL).collect():
        assert r.decoded == pieces.decode(r.token_ids or [])
    with pytest.raises(Exception, match="does not have"):
        sentencepieces.decode_ids(
            spark.createDataFrame([([40_000],)], "token_ids array<int>"), MODEL
        ).collect()


def test_op3_over_the_whole_table(spark, pieces):
    texts = documents(spark)
    rows = llm.q_op3_sentencepiece(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = pieces.encode(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(pieces.decode(ids).encode()).hexdigest()


def check_ids(rows, keyed, library):
    """rows: key, start, n_ids or n_tokens, crc; keyed: (key, text) in any order."""
    keyed = sorted(keyed, key=lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, x[1] or ""))
    start, want = 0, []
    for key, text in keyed:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        want.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    order = lambda x: (x[0] is not None, x[0] or 0, x[1])
    assert sorted(rows, key=order) == sorted(want, key=order)


def test_id_files_round_trip(spark, odd, library):
    path = new_path(spark, "test-ids")
    id_files.write_ids(odd, path, JSON, end_id=2, shards=5)
    keys = odd.select("doc_id").distinct().unionByName(spark.range(10**6, 10**6 + 50).toDF("doc_id"))
    places = id_files.look_up(spark, path, keys).unionByName(
        id_files.keyless(spark, path), allowMissingColumns=True
    )
    found = id_files.read_ids(spark, path, places).withColumn("crc", F.crc32("ids"))
    rows = [(r.key, r.start, r.n_ids, r.crc) for r in found.collect()]
    check_ids(rows, [(r.doc_id, r.text) for r in odd.collect()], library)
    buckets = spark.read.parquet(f"{path}/layout").first()["buckets"]
    for r in odd.where("doc_id is not null").limit(5).collect():
        arrays = [a.tolist() for a in id_files.get(path, buckets, r.doc_id)]
        ids = [*library.encode(r.text or "", add_special_tokens=False).ids, 2]
        assert ids in arrays
    assert id_files.get(path, buckets, 10**9) == []


def test_id_files_of_an_empty_table_and_of_other_keys(spark):
    path = new_path(spark, "test-no-ids")
    id_files.write_ids(empty(spark), path, JSON, end_id=2, shards=3)
    places = id_files.look_up(spark, path, spark.range(5).toDF("doc_id"))
    assert id_files.read_ids(spark, path, places).count() == 0
    with pytest.raises(TypeError):
        id_files.write_ids(odd_keys(spark), new_path(spark, "x"), JSON, end_id=2)


def odd_keys(spark):
    return spark.createDataFrame([("a", "text")], "doc_id string, text string")


def test_op5_over_the_whole_table(spark, library):
    rows = [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in llm.q_op5_token_id_files(spark, SF).collect()]
    check_ids(rows, documents(spark).items(), library)


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_perfect_hash_is_minimal(n):
    keys = np.random.default_rng(n).choice(1 << 40, n, replace=False).astype(np.int64) - (1 << 39)
    hashed = id_files.PerfectHash.build(keys)
    again, size = id_files.PerfectHash.load(hashed.dump())
    assert size == len(hashed.dump())
    for h in (hashed, again):
        assert sorted(h.slots(keys).tolist()) == list(range(n))


def words_of(text):
    return re.findall(r"[a-z0-9\u0080-\U0010ffff]+", (text or "").lower())


def brute_tiling(item, text, width):
    """Greedy string tiling straight from its definition."""
    in_item, in_text, total, tiles = set(), set(), 0, 0
    while True:
        best = (0, 0, 0)
        for a in range(len(item)):
            for b in range(len(text)):
                k = 0
                while (
                    a + k < len(item) and b + k < len(text) and item[a + k] == text[b + k]
                    and a + k not in in_item and b + k not in in_text
                ):
                    k += 1
                if k > best[0]:
                    best = (k, a, b)
        k, a, b = best
        if k < width:
            return total, tiles
        in_item |= set(range(a, a + k))
        in_text |= set(range(b, b + k))
        total, tiles = total + k, tiles + 1


def test_leaks_are_greedy_string_tilings(spark):
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(9)]
    items = [" ".join(rng.choices(vocabulary, k=rng.randint(3, 24))) for _ in range(12)]
    texts = []
    for _ in range(30):
        parts = rng.choice(items).split()
        cut = rng.randint(0, len(parts))
        moved = parts[cut:] + rng.choices(vocabulary, k=3) + parts[:cut]
        texts.append(" ".join(rng.choices(vocabulary, k=5) + moved).upper() + "!")
    texts += ["", None, "short", items[0], items[0], "x. " * 5000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    docs = docs.withColumn("leaks", F.lit("clash"))
    bench = spark.createDataFrame(
        [*enumerate(items), (50, None), (51, ""), (0, items[0])], "item_id bigint, text string"
    )
    want = []
    for d, text in enumerate(texts):
        for i, item in [*enumerate(items), (0, items[0])]:
            words = words_of(item)
            matched, tiles = brute_tiling(words, words_of(text), 5)
            if len(words) >= 5 and 2 * matched >= len(words):
                want.append((d, i, matched, tiles))
    for blocks in (1 << 20, 200):
        found = decontamination.leaking_pairs(docs, bench, block_bytes=blocks)
        assert sorted((r.doc_id, r.item_id, r.matched, r.tiles) for r in found.collect()) == sorted(want)
    kept = decontamination.decontaminate(docs, bench)
    assert kept.columns == ["doc_id", "text", "leaks"]
    assert {r.doc_id for r in kept.collect()} == set(range(len(texts))) - {w[0] for w in want}
    nothing = spark.createDataFrame([], "item_id bigint, text string")
    assert decontamination.leaking_pairs(docs, nothing).count() == 0
    assert decontamination.leaking_pairs(docs.limit(0), bench).count() == 0


def test_op4_finds_every_planted_item(spark):
    texts = documents(spark)
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    found = {(r.doc_id, r.item_id) for r in llm.q_op4_decontamination(spark, SF).collect()}
    assert {(d, i) for d, t in texts.items() for i, x in items.items() if x in t} <= found
    for d, i in found:
        item = words_of(items[i])
        assert 2 * brute_tiling(item, words_of(texts[d]), 5)[0] >= len(item)


def base_spans(text):
    """The four patterns as they are written, without the linear forms."""
    digits = lambda s: re.sub("[^0-9]", "", s)
    found = [
        ("email", *m.span())
        for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)
    ]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        if 13 <= len(digits(m[0])) <= 19 and pii.luhn(digits(m[0])):
            found.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(digits(m[0])) <= 15:
            found.append(("phone", *m.span()))
    return found


def test_base_spans_are_the_patterns():
    rng = random.Random(5)
    for letters in ("a@.-1 2+()9%_é\n4", "0123456789 -.+"):
        for _ in range(20_000):
            text = "".join(rng.choices(letters, k=rng.randint(0, 45)))
            assert [s[:3] for s in pii.find_spans(text) if s[3]] == base_spans(text), text


@pytest.mark.parametrize(
    ("text", "kind", "source"),
    [
        ("mail bob.smith [at] example [dot] com now", "email", "bob.smith [at] example [dot] com"),
        ("write bob at example dot com", "email", "write bob at example dot com"[6:]),
        ("joe(at)mail(dot)example(dot)org", "email", "joe(at)mail(dot)example(dot)org"),
        ("ｂｏｂ＠ｅｘａｍｐｌｅ．ｃｏｍ!", "email", "ｂｏｂ＠ｅｘａｍｐｌｅ．ｃｏｍ"),
        ("x jаne​.doe@exаmple.com", "email", "jаne​.doe@exаmple.com"),
        ("one nine two dot one six eight dot one dot one", "ip", None),
        ("plus four four two zero seven nine four six zero nine five eight", "phone", None),
        ("plus quatre quatre deux zéro sept neuf quatre six zéro neuf cinq huit", "phone", None),
        ("４１１１ １１１１ １１１１ １１１１", "card", None),
    ],
)
def test_disguised_identifiers(text, kind, source):
    spans = pii.find_spans(text)
    assert [s[0] for s in spans] == [kind]
    assert not spans[0][3]
    assert text[spans[0][1] : spans[0][2]] == (source or text)


def test_a_tape_maps_every_character_back():
    rng = random.Random(6)
    for _ in range(300):
        text = "".join(rng.choices("abcdef", k=rng.randint(1, 30)))
        tape, where = pii.Tape(text), [(i, i + 1) for i in range(len(text))]
        for _ in range(3):
            edits, at = [], 0
            while at < len(tape.text):
                end = min(len(tape.text), at + rng.randint(1, 4))
                if rng.random() < 0.4:
                    edits.append((at, end, "xyz"[: rng.randint(0, 3)]))
                at = end
            kept, last = [], 0
            for a, b, new in edits:
                kept += where[last:a] + [(where[a][0], where[b - 1][1])] * len(new)
                last = b
            where = kept + where[last:]
            tape.rewrite(edits)
            assert len(tape.text) == len(where)
            for i, span in enumerate(where):
                assert tape.source(i, i + 1) == span


@pytest.mark.parametrize(
    "text",
    ["look at it. dot com", "eins zwei drei", "we met at noon", "one two three four five", "Été à Paris, où."],
)
def test_plain_prose_has_no_identifiers(text):
    assert pii.find_spans(text) == []


@pytest.mark.parametrize(
    "text",
    [
        "bob at example\ndot com",
        "bob\n@\nexample.com",
        "bob\tat\texample\tdot\tcom",
        "bob[\tat\t]example.com",
        "bob\u00a0at\u00a0example\u00a0punKt\u00a0com",
        "one,dot,two,dot,three,dot,four",
        "one-point-two point one-point-\u017fix",
        "one dot \u017fix dot F\u0131VE dot e\u0130ns",
    ],
)
def test_disguises_with_any_white_space(text):
    (span,) = pii.find_spans(text)
    assert text[span[1] : span[2]] == text
    assert pii.redacted(f"to {text}, now") == f"to <{span[0].upper()}>, now"


def test_hints_leave_out_no_transducer_that_finds_something():
    rng, found = random.Random(8), 0
    words = "bob x.y host com at AT ät @ dot Dot point . [ ( ) ] one Two drei \u017fix plus oh é о".split()
    gaps = ["", " ", " ", " ", "\t", "\n", "\u00a0", "  ", ",", "-", " \n"]
    for _ in range(40_000):
        text = "".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randint(3, 12)))
        spans = pii.disguised(text, hints=False)
        assert pii.disguised(text) == spans, text
        found += bool(spans)
    assert found > 100


@pytest.mark.parametrize(
    "text",
    [
        "a.b.c.d.e.f at host dot com",
        "a dot b dot c dot d dot e dot f at host dot com",
        "a.b dot c_d.e dot f.g dot h @ host dot co dot uk",
        " dot ".join("abcdefghij" * 9) + " at host dot com",
    ],
)
def test_spoken_names_of_any_number_of_parts(text):
    for before in ("", "to ", "bob at home dot net, "):
        spans = pii.find_spans(before + text)
        assert ("email", len(before), len(before + text), False) in spans
    assert pii.redacted(f"to {text}, now") == "to <EMAIL>, now"


def test_spoken_addresses_are_the_pattern_without_a_cap():
    dots, ats = "|".join(pii.DOT_WORDS), "|".join(pii.AT_WORDS)
    spoken = re.compile(
        rf"(?<![\w.%+-])[A-Za-z0-9_%+-]+(?:(?:\s(?:{dots})\s|\.)[A-Za-z0-9_%+-]+)*"
        rf"(?:\s(?:{ats})\s|\s?@\s?)[A-Za-z0-9-]+(?:\s(?:{dots})\s[A-Za-z0-9-]+)+(?!\w)"
        r"|(?<![\w.%+-])[A-Za-z0-9._%+-]+\s@\s[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
        re.IGNORECASE,
    )
    # Where "at" itself is a part between dot words, a text can be read in two ways.
    two_ways = re.compile(rf"\s(?:{dots})\s(?:{ats})\s(?:{dots})\s", re.IGNORECASE)
    rng, found = random.Random(11), 0
    parts = ["a", "b_", "c-", "é", "\u017f", "x.y", ".", "@", " @ ", " @", "\n", " "]
    parts += [" dot ", " dot ", " Point\t", ".", " at ", " AT ", "at", "dot", "%", "a", "a"]
    for _ in range(60_000):
        text = "".join(rng.choices(parts, k=rng.randint(3, 22)))
        if not two_ways.search(text):
            want = [m.span() for m in spoken.finditer(text)]
            assert list(pii._spoken_runs(text)) == want, text
            found += len(want)
    assert found > 1000


def test_spoken_addresses_take_linear_time():
    for part in ("a dot ", "a.", "é@b dot at dot ", "at dot dot ", "x @ y.", " at"):
        start = time.perf_counter()
        pii.find_spans(part * 40_000 + "b at host dot com")
        assert time.perf_counter() - start < 20


def test_pii_columns_and_redaction(spark):
    rows = [(1, "to a@b.co, b@c.de"), (2, None), (3, ""), (1, "to a@b.co, b@c.de"), (4, "9" * 30_000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("pii", F.lit(1))
    found = sorted((r.doc_id, len(r.pii)) for r in pii.with_pii(df).collect())
    assert found == [(1, 2), (1, 2), (2, 0), (3, 0), (4, 0)]
    clean = pii.redact(df)
    assert clean.columns == df.columns
    assert sorted((r.doc_id, r.text) for r in clean.where("doc_id < 4").collect() if r.text) == [
        (1, "to <EMAIL>, <EMAIL>"),
        (1, "to <EMAIL>, <EMAIL>"),
    ]
    assert clean.where("doc_id = 2").first().text is None
    assert pii.with_pii(df.limit(0)).count() == 0


def test_op6_over_the_whole_table(spark):
    texts = documents(spark)
    rows = llm.q_op6_personal_data(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = base_spans(texts[r.doc_id])
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [
            sum(b[0] == k for b in base) for k in pii.KINDS
        ]
        assert set(filter(None, listed.split(","))) <= set(r.spans.split(","))
