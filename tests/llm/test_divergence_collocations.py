"""Source divergence and phrase collocations against brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from verbaloom.llm import collocations, divergence

UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


# --- source divergence ---------------------------------------------------------------


def brute_divergence(rows, least, ranks):
    counts, inside, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(UPPER))
        counts[lang, source].update(terms)
        inside[lang].update(set(terms))
        groups[lang].add(source)
    found = []
    for lang, sources in groups.items():
        kept = {t for t, n in inside[lang].items() if n >= least}
        whole = Counter()
        for s in sources:
            whole.update({t: n for t, n in counts[lang, s].items() if t in kept})

        def priced(c):
            down = sum(c[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 1000000000 * (c[t] + 5) // down for t in kept}

        p, q = {s: priced(counts[lang, s]) for s in sources}, priced(whole)
        for s in sources:
            pair = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources if o != s]
            term = [(p[s][t] - q[t], t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, listed, limit in (("pair", pair, None), ("term", term, ranks)):
                listed.sort(key=lambda x: (-x[0], x[1].encode()))
                found += [(lang, s, part, item, v, k) for k, (v, item) in enumerate(listed[:limit], 1)]
    return sorted(found)


def divergence_rows():
    rng = random.Random(8)
    words = ["the", "The", "été", "Éa", "x", "a1b", "naïve", "日本", "q\x00r", "[z]"] + [f"w{chr(97 + i)}" for i in range(26)]
    rows = []
    for i in range(260):
        bias = rng.choice(words)
        text = " ".join(rng.choice([*words, bias, bias]) for _ in range(rng.randint(0, 40)))
        rows.append((text, rng.choice(["en", "fr", None, ""]), rng.choice(["s1", "s2", "é", None, "", "S"])))
    rows += [(None, "en", "s1"), ("", "de", "only"), (None, "it", "a"), ("rare", "it", "b")]
    return rows + rows[:20] + [("the " * 30000, "en", "s2")] * 2


@pytest.mark.parametrize("blocks", [(256, 32), (3, 2)])
def test_divergence(spark, monkeypatch, blocks):
    monkeypatch.setattr(divergence, "TERMS", blocks[0])
    monkeypatch.setattr(divergence, "GROUPS", blocks[1])
    rows = divergence_rows()
    docs = spark.createDataFrame(rows, "text string, lang string, source string").repartition(5)
    docs = docs.withColumns({c: F.lit("clash") for c in ("term", "n", "docs", "rank", "value", "own")})
    found = divergence.divergence(docs, least_documents=12, term_ranks=7)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, found.collect())) == brute_divergence(rows, 12, 7)


def test_divergence_without_rows(spark):
    empty = spark.createDataFrame([], "text string, lang string, source string")
    assert divergence.divergence(empty).count() == 0


def test_joint_table_counts_every_pair_of_levels():
    a, b = np.array([0, 0, 3, 1, 3]), np.array([2, 2, 0, 2, 0])
    (levels_a, hot_a), (levels_b, hot_b) = divergence.one_hot(a), divergence.one_hot(b)
    table = divergence.joint_table(hot_a, hot_b)
    want = Counter(zip(a.tolist(), b.tolist()))
    for x, row in zip(levels_a.tolist(), table.tolist()):
        assert row == [want[x, y] for y in levels_b.tolist()]


def test_prices_are_exact(spark):
    rng = random.Random(1)
    for total, terms in ((0, 1), (7, 3), (10**9, 10**6), (9 * 10**14, 10**8), (1 << 54, 5)):
        counts = [0, 1, total, *(rng.randint(0, total) for _ in range(20))]
        want = [1 + 10**9 * (c + 5) // (total + 5 * terms) for c in counts]
        assert divergence.prices(np.array(counts), total, terms).tolist() == want
        table = spark.createDataFrame([(c,) for c in counts], "c bigint")
        made = table.select(divergence.price(F.col("c"), F.lit(total), F.lit(terms)))
        assert [r[0] for r in made.collect()] == want


# --- collocations --------------------------------------------------------------------


def brute_collocations(rows, least, top):
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n-\r]", (text or "").translate(UPPER)):
            words = re.findall(r"[^ \t]+", piece)
            totals[lang] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    counts[lang][tuple(words[i : i + k])] += 1
    found = []
    for lang, counted in counts.items():
        frequent = {p: a for p, a in counted.items() if len(p) > 1 and a >= least}
        dropped = {
            p[i : i + k]
            for p, a in frequent.items()
            for k in range(2, len(p))
            for i in range(len(p) - k + 1)
            if a >= frequent[p[i : i + k]]
        }
        made = []
        for p, a in frequent.items():
            if p not in dropped:
                score, k = min(
                    (1000 * a * totals[lang] // (counted[p[:k]] * counted[p[k:]]), k) for k in range(1, len(p))
                )
                made.append((score, a, " ".join(p), counted[p[:k]], counted[p[k:]]))
        made.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        for rank, (score, a, phrase, left, right) in enumerate(made[:top], 1):
            found.append((lang, rank, phrase, a, left, right, totals[lang], score))
    return sorted(found)


def collocation_rows():
    rng = random.Random(3)
    stock = ["of the", "in the long run", "a b c d e f g", "New York", "é\xa0x", "tick tock tick tock"]
    words = [*"abcdefgh", "the", "\x00", "ÉÀ"]
    rows = []
    for _ in range(300):
        parts = [rng.choice(stock) if rng.random() < 0.4 else rng.choice(words) for _ in range(rng.randint(0, 25))]
        text = "".join(p + rng.choice([" ", "  ", "\t", ". ", "\n", ",", " "]) for p in parts)
        rows.append((text, rng.choice(["en", "fr", "und", None])))
    rows += [(None, "en"), ("", None), ("x", "de"), ("a a a a a a a a " * 3000, "en")]
    return rows + rows[:30]


@pytest.mark.parametrize(("parts", "bits"), [(1, 23), (7, 23), (3, 16)])
def test_collocations(spark, parts, bits):
    """Few buckets only add phrases to count: the rows are the same."""
    rows = collocation_rows()
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(parts)
    docs = docs.withColumns({c: F.lit("clash") for c in ("n", "phrase", "shard", "codes", "a", "rank")})
    found = collocations.collocations(docs, least=12, top=25, bucket_bits=bits)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, found.collect())) == brute_collocations(rows, 12, 25)


def test_collocations_without_rows(spark):
    for rows in ([], [(None, None)], [("one two", "en")]):
        docs = spark.createDataFrame(rows, "text string, lang string")
        assert collocations.collocations(docs).count() == 0


def test_each_phrase_is_counted_for_one_cycle():
    """Every shard is scanned once for a phrase, from the step after its subphrases' own."""
    codes = np.array([5, 6, 7, 0, 5, 6, 0, 6, 7], "<u4")
    never = np.full((collocations.TABLES, 1 << 16), collocations.NEVER, np.uint8)
    words, starts = collocations.scan(codes, never, 0)
    assert len(words) == 7 and not starts.any()
    five, six, seven = words[0], words[1], words[2]
    reached = never.copy()
    for key, step in ((five, 0), (six, 2), (seven, 1)):
        for k in range(collocations.TABLES):
            reached[k, (int(key) >> (64 - 16 * (k + 1))) % (1 << 16)] = step
    pair = {int(collocations._longer(np.array([a], np.uint64), np.array([b], np.uint64))[0]) for a, b in ((five, 6), (six, 7))}
    for step in range(12):
        keys, starts = collocations.scan(codes, reached, step)
        pairs = [int(k) for k, s in zip(keys, starts) if s]
        # 5 6 and 6 7 occur twice each; both begin after step 2.
        assert (Counter(pairs) == dict.fromkeys(pair, 2)) == (3 <= step < 3 + collocations.SHARDS)
        assert bool(len(pairs)) == (3 <= step < 3 + collocations.SHARDS)


def test_collocations_count_in_few_tasks(spark, monkeypatch):
    """Each task of the last pass gives a row for each phrase: small tasks are merged."""
    tasks, counts = [], collocations._exact_counts
    monkeypatch.setattr(
        collocations,
        "_exact_counts",
        lambda docs, *rest: tasks.append(docs.rdd.getNumPartitions()) or counts(docs, *rest),
    )
    rows = [(i, "en", "a b c. d") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(64)
    found = collocations.collocations(docs, bucket_bits=16)
    assert [(r.phrase, r.a) for r in found.collect()] == [("a b c", 200)]
    assert tasks[0] <= 2 * spark.sparkContext.defaultParallelism
