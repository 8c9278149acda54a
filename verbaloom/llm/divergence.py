"""How differently the sources of a language use its terms (operator 11).

A term has a count level in each group (language and source): its number of occurrences
there, 0 included. A group's price of a term depends on the level alone, so the sum of price
differences of two groups over all terms needs only their joint table: for each two levels,
how many terms have the one here and the other there.

One-hot level products give these tables. Terms are rows, (group, level) pairs are indicator
columns, and the product of the transposed indicators with the indicators holds every joint
table of a language. It is taken in blocks: of terms, which are dealt by the magnitude of
their counts, so that rare terms share few levels; and of groups. A cell is one block of
terms and two of groups; its tables are exact, as they count fewer terms than a single
precision number holds, and are priced where they are made. Only a number per pair of
groups leaves a cell.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verbaloom.sources.tables import stage

# A kept term is in this many documents of its language at least.
LEAST_DOCUMENTS = 30
# Prices are in units of a billionth, with this added to every count.
UNIT, ADDED = 1_000_000_000, 5
TERM_RANKS = 50
# Terms and groups of a block (on average: both are dealt by a hash).
TERMS, GROUPS = 256, 32
# Distinct terms that a task counts before it passes them on.
HELD = 250_000
# Everything but letters of ASCII and bytes of other characters separates terms; A-Z are
# lower-cased.
_SEPARATE = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
COUNTS = "lang string, source string, term string, n bigint, docs bigint"


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """lang, source, term, n, docs: occurrences of each term in a group, and its documents.

    A group without any term has one row with a null term. Counts are taken per task before
    the one shuffle, so a term or group of any frequency is a row per task.
    """
    rows = docs.select(
        *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text")))
    )

    def count(batches):
        import pyarrow as pa

        seen, found, inside = set(), {}, {}

        def emit():
            columns = [[], [], [], [], []]
            for group, counted in found.items():
                columns[0] += [group[0]] * len(counted)
                columns[1] += [group[1]] * len(counted)
                columns[2] += counted.keys()
                columns[3] += counted.values()
                columns[4] += map(inside[group].__getitem__, counted)
            terms = pa.array(columns[2], pa.binary()).cast(pa.string())
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()), terms]
                + [pa.array(c, pa.int64()) for c in columns[3:]],
                ["lang", "source", "term", "n", "docs"],
            )

        for batch in batches:
            for group, text in zip(
                zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()), batch.column(2)
            ):
                seen.add(group)
                if group not in found:
                    found[group], inside[group] = Counter(), Counter()
                terms = text.as_buffer().to_pybytes().translate(_SEPARATE).split()
                found[group].update(terms)
                inside[group].update(set(terms))
            if sum(map(len, found.values())) > HELD:
                yield emit()
                found, inside = {}, {}
        yield emit()
        if seen:
            langs, sources = zip(*seen)
            none = pa.nulls(len(langs), pa.string()), *[pa.array([0] * len(langs), pa.int64())] * 2
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(sources, pa.string()), *none],
                ["lang", "source", "term", "n", "docs"],
            )

    partial = rows.mapInArrow(count, COUNTS)
    return partial.groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs")
    )


def price(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(UNIT * (count + ADDED) / (total + ADDED * terms)), exactly."""
    whole = "decimal(20,0)"
    up = F.lit(UNIT).cast("decimal(10,0)") * (count + ADDED).cast(whole)
    down = (total + F.lit(ADDED) * terms).cast(whole)
    return F.lit(1) + F.call_function("div", up, down)


def prices(levels, total: int, terms: int):
    """``price`` of an array of counts: long division, a thousand at a time."""
    down = int(total) + ADDED * int(terms)
    if down >= 1 << 53:
        return np.array([1 + UNIT * (int(c) + ADDED) // down for c in levels], np.int64)
    found, rest = np.divmod(levels.astype(np.int64) + ADDED, down)
    for _ in range(3):
        more, rest = np.divmod(rest * 1000, down)
        found = found * 1000 + more
    return found + 1


def divergence(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    least_documents: int = LEAST_DOCUMENTS,
    term_ranks: int = TERM_RANKS,
) -> DataFrame:
    """lang, source, part, item, value, rank: what tells a source from others of its language.

    Terms are runs of ASCII letters (A-Z lower-cased) and characters beyond ASCII; a language
    keeps those in at least ``least_documents`` of its documents. A group's price of a kept
    term is that of ``price``, with its own total over kept terms.

    Part ``pair``: for every other source of the language, the sum of price differences over
    all kept terms, 0 if there are none. Part ``term``: the kept terms that occur in the group
    and are dearer there than in the language, by that difference, ``term_ranks`` of them.
    Ranks begin at 1; equal values go by the item in byte order, so there are no ties.

    A null text, language or source counts as ''. Repeated rows count each time. A source that
    is alone in its language has no pair. An empty table gives no rows; other columns, whatever
    their names, are not read. Exact as long as a language has fewer than 9e15 occurrences.
    """
    counted = stage(term_counts(docs, text, lang, source), "term-counts")
    kept = (
        counted.where("term IS NOT NULL")
        .groupBy("lang", "term")
        .agg(F.sum("n").alias("all_n"), F.sum("docs").alias("docs"))
        .where(F.col("docs") >= least_documents)
    )
    # Terms of one magnitude share blocks: there each group has few levels.
    kept = stage(kept.withColumn("size", F.floor(F.log2("all_n")).cast("int")), "kept-terms")
    used = counted.where("term IS NOT NULL").select("lang", "source", "term", "n")
    used = stage(used.join(kept.select("lang", "term", "all_n", "size"), ["lang", "term"]), "term-levels")
    langs = kept.groupBy("lang").agg(F.sum("all_n").alias("lang_total"), F.count("*").alias("terms"))
    zero = F.lit(0).cast("bigint")
    groups = (
        counted.where("term IS NULL")
        .select("lang", "source")
        .join(used.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .select(
            "lang",
            "source",
            F.coalesce("total", zero).alias("total"),
            F.coalesce("lang_total", zero).alias("lang_total"),
            F.coalesce("terms", zero).alias("terms"),
        )
    )
    groups = stage(groups, "groups")
    items = _pairs(groups, kept, used).unionByName(_dear_terms(groups, used))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = items.withColumn("rank", F.row_number().over(order))
    pairs = ranked.where("part = 'pair'")
    return pairs.unionByName(ranked.where((F.col("part") == "term") & (F.col("rank") <= term_ranks)))


def _dear_terms(groups: DataFrame, used: DataFrame) -> DataFrame:
    own = used.join(groups, ["lang", "source"])
    more = price(F.col("n"), F.col("total"), F.col("terms")) - price(
        F.col("all_n"), F.col("lang_total"), F.col("terms")
    )
    return own.select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), more.alias("value")
    ).where("value > 0")


def _pairs(groups: DataFrame, kept: DataFrame, used: DataFrame) -> DataFrame:
    """lang, source, part, item, value of every ordered pair of a language's sources."""
    value = level_products(groups, kept, used).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    # Every pair is here, also of languages without kept terms: the groups' own cells.
    return value.select("lang", "source", F.lit("pair").alias("part"), "item", "value")


def level_products(groups: DataFrame, kept: DataFrame, used: DataFrame) -> DataFrame:
    """lang, source, item, value: per cell and pair of groups, the priced joint table."""
    by_lang = groups.groupBy("lang").agg(F.ceil(F.count("*") / GROUPS).cast("int").alias("parts"))
    placed = groups.join(by_lang, "lang").withColumn(
        "own", F.pmod(F.xxhash64("source"), F.col("parts")).cast("int")
    )
    sizes = kept.groupBy("lang", "size").agg(F.ceil(F.count("*") / TERMS).cast("int").alias("blocks"))
    term_block = F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int").alias("block")
    blocks = (
        kept.join(sizes, ["lang", "size"])
        .select("lang", "size", term_block)
        .groupBy("lang", "size", "block")
        .agg(F.count("*").alias("rows"))
    )
    # A language without kept terms has one empty block, so that its pairs come out as 0.
    empty = groups.where("terms = 0").select(
        "lang", F.lit(-1).alias("size"), F.lit(0).alias("block"), F.lit(0).cast("bigint").alias("rows")
    )
    blocks = blocks.unionByName(empty.distinct())
    # What a cell knows of each of its groups, then the levels of the terms in it.
    facts = placed.join(blocks, "lang").select(
        "lang", "size", "block", "own", "parts", "source", F.lit(None).cast("string").alias("term"),
        F.col("total").alias("n"), "terms", "rows",
    )
    levels = (
        used.join(sizes, ["lang", "size"])
        .join(placed.select("lang", "source", "own", "parts"), ["lang", "source"])
        .select(
            "lang", "size", term_block, "own", "parts", "source", "term",
            "n", F.lit(0).cast("bigint").alias("terms"), F.lit(0).cast("bigint").alias("rows"),
        )
    )
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda other: F.struct(F.least("own", other).alias("i"), F.greatest("own", other).alias("j")),
    )
    cells = facts.unionByName(levels).withColumn("cell", F.explode(pairs))
    cells = cells.select("*", "cell.i", "cell.j").drop("cell", "parts")
    made = "lang string, source string, item string, value bigint"
    # Dealt by all of a cell's keys: a join above may have left the rows dealt by some of them.
    keys = ["lang", "size", "block", "i", "j"]
    return cells.repartition(*keys).groupBy(*keys).applyInArrow(_priced_cell, made)


def one_hot(levels):
    """The distinct levels of a row of term levels, and an indicator column for each."""
    known, place = np.unique(levels, return_inverse=True)
    hot = np.zeros((len(levels), len(known)), np.float32)
    hot[np.arange(len(levels)), place] = 1
    return known, hot


def joint_table(hot_a, hot_b):
    """How many terms have each level of a and each of b."""
    return hot_a.T @ hot_b


def _priced_cell(key, table):
    import pyarrow as pa
    import pyarrow.compute as pc

    lang, i, j = key[0].as_py(), key[3].as_py(), key[4].as_py()
    is_fact = pc.is_null(table["term"])
    facts, entries = table.filter(is_fact), table.filter(pc.invert(is_fact))
    sources = facts["source"].to_pylist()
    numbers = {s: k for k, s in enumerate(sources)}
    coded = entries["term"].combine_chunks().dictionary_encode()
    levels = np.zeros((len(sources), len(coded.dictionary)), np.int64)
    rows = np.array([numbers[s] for s in entries["source"].to_pylist()], np.int64)
    levels[rows, coded.indices.to_numpy()] = entries["n"].to_numpy()
    # The block's terms that no group of this cell has are at level 0 in all of them.
    absent = int(facts["rows"][0].as_py()) - levels.shape[1]
    totals, terms = facts["n"].to_pylist(), facts["terms"].to_pylist()
    own = facts["own"].to_numpy()
    left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
    known, hot, priced = {}, {}, {}
    for g in range(len(sources)):
        known[g], hot[g] = one_hot(levels[g])
        priced[g] = prices(known[g], totals[g], terms[g]) if terms[g] else np.zeros(0, np.int64)
    base = [int(prices(np.zeros(1, np.int64), t, v)[0]) if v else 0 for t, v in zip(totals, terms)]
    out = [], [], []
    if len(right):
        columns = np.concatenate([hot[h] for h in right], axis=1)
        cost = np.concatenate([priced[h] for h in right])
        starts = np.cumsum([0] + [len(known[h]) for h in right])
    for g in left.tolist() if len(right) else []:
        joint = joint_table(hot[g], columns)
        sums = (joint.astype(np.int64) * np.abs(priced[g][:, None] - cost[None, :])).sum(axis=0)
        before = np.concatenate([[0], np.cumsum(sums)])
        for k, h in enumerate(right.tolist()):
            if g == h or (i == j and g > h):
                continue
            value = int(before[starts[k + 1]] - before[starts[k]]) + absent * abs(base[g] - base[h])
            out[0].extend((sources[g], sources[h]))
            out[1].extend((sources[h], sources[g]))
            out[2].extend((value, value))
    return pa.table(
        {
            "lang": pa.array([lang] * len(out[0]), pa.string()),
            "source": pa.array(out[0], pa.string()),
            "item": pa.array(out[1], pa.string()),
            "value": pa.array(out[2], pa.int64()),
        }
    )
