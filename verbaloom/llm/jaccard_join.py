"""N-gram Jaccard self-join with Bayesian candidate pruning (operator 7).

1. Each text becomes a class of texts with the same words. A class has MinHash values of
   its word shingles.
2. Classes that agree in four consecutive values somewhere are candidates; candidates
   fall into components, in whose cells pairs are compared (Satuluri and Parthasarathy,
   VLDB 2012): after every few values the pair goes if the posterior probability that its
   similarity reaches the threshold is below the tolerance.
3. The classes with surviving pairs form smaller components. Their texts are fetched, and
   surviving pairs are verified exactly, by counting common shingles.

Cells hold a bounded number of classes and bytes. A pair never leaves its cell: cells return
counts per class and a spanning forest of their links. Pruning only has to know which classes
hang together, so there a cell compares its first few classes with all others, and then only
pairs that are not yet connected. Verification counts the common shingles of all pairs of a
cell at once.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verbaloom.llm import word_arrays
from verbaloom.llm.common import with_text_columns
from verbaloom.llm.components import components, forest_labels
from verbaloom.sources.tables import stage

WORDS, THRESHOLD = 5, 0.8
# MinHash values, 16 bits each, in bands. A pair at similarity 0.8 agrees in no band with
# probability (1 - 0.8**4)**32 = 5e-8; more similar pairs are safer still.
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
# Values compared between two looks at the posterior, and the least posterior kept.
STEP, TOLERANCE = 16, 1e-9
# Classes in a block, and bytes, as far as one class has no more; a cell compares a block with
# itself or with another.
CELL, CELL_BYTES = 512, 6 << 20
# Classes of small components that share a cell.
PACK = 256
MISSING_KEY = -(1 << 63)
# Classes that a cell compares with all others before it looks at pairs.
PIVOTS = 8
# Components of at most this many classes have all their pairs compared.
FEW = 24
# Pairs compared at once.
PAIRS = 1 << 16
# A shingle of more classes of a cell than this is a column of a matrix product; the pairs of
# classes of another are counted one by one. Columns of one product.
DENSE, COLUMNS = 16, 1024
SKETCH_BYTES = 2 * HASHES


def least_matches(threshold: float, tolerance: float = TOLERANCE) -> dict[int, int]:
    """For each number n of compared values, the fewest equal ones with which a pair stays.

    With a uniform prior the posterior of similarity s given m of n equal is
    Beta(m + 1, n - m + 1), whose mass above t is P(Binomial(n + 1, t) <= m).
    """
    found = {}
    for n in range(STEP, HASHES + 1, STEP):
        mass, m = 0.0, -1
        while mass < tolerance:
            m += 1
            mass += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        found[n] = m
    return found


def _seeds():
    i = np.arange(1, HASHES + 1, dtype=np.uint64)
    return word_arrays.mix(i * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def _signatures(texts: list[str]):
    """Number of words and MinHash values of each text."""
    hashed, ends = word_arrays.words(texts)
    counts = np.diff(ends, prepend=0)
    found, owner, _ = word_arrays.shingles(hashed, ends, WORDS)
    values = np.zeros((len(texts), HASHES), "<u2")
    starts = np.flatnonzero(np.concatenate([[True], np.diff(owner) != 0])) if len(owner) else []
    for k, seed in enumerate(_seeds() if len(owner) else ()):
        # Multiply-shift by an odd number: the top bits order the shingles anew.
        least = np.minimum.reduceat((found * seed) >> np.uint64(16), starts)
        values[owner[starts], k] = (word_arrays.mix(least) & np.uint64(0xFFFF)).astype("<u2")
    return counts, values


def text_kind(text: Column) -> Column:
    """128 bits that tell a text's words, in order, from those of any other text."""
    joined = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), "[\\t-\\r ]+", " "))
    return F.unhex(F.substring(F.sha2(joined, 256), 1, 32))


def with_signatures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words and sketch, the MinHash values."""
    fields = T.StructType(
        [T.StructField("n_words", T.LongType()), T.StructField("sketch", T.BinaryType())]
    )

    def make(texts):
        counts, values = _signatures(texts)
        return [counts.tolist(), [row.tobytes() for row in values]]

    return with_text_columns(docs, text, fields, make)


def _band_keys(sketches: DataFrame) -> DataFrame:
    """band, node: a row per band of each class."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            nodes = batch.column(0).to_numpy()
            rows = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<u8").reshape(-1, BANDS)
            salt = word_arrays.mix(np.arange(1, BANDS + 1, dtype=np.uint64))
            keys = word_arrays.mix(rows + salt).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel()), pa.array(np.repeat(nodes, BANDS))], ["band", "node"]
            )

    return sketches.select("node", "sketch").mapInArrow(run, "band bigint, node bigint")


def _candidate_edges(sketches: DataFrame) -> DataFrame:
    """Every class with the least class of each of its bands."""
    rows = _band_keys(sketches)
    least = rows.groupBy("band").agg(F.min("node").alias("u"), F.max("node").alias("last"))
    shared = least.where("u <> last").select("band", "u")
    return rows.join(shared, "band").where("node <> u").select("u", F.col("node").alias("v"))


def _cells(members: DataFrame) -> DataFrame:
    """``members`` (with root and bytes) with cell columns c, i, j; a row for each cell of a class.

    Small components share cells, about PACK classes and at most CELL_BYTES on average to
    each. A larger one is dealt into blocks by a hash, of about CELL classes and CELL_BYTES;
    each pair of blocks is a cell, so a class has as many rows as its component has blocks.
    """
    sizes = members.groupBy("root").agg(F.count("*").alias("_n"), F.sum("bytes").alias("_bytes"))
    sizes = stage(sizes, "component-sizes")
    small = F.greatest(F.ceil(F.col("_n") / CELL), F.ceil(F.col("_bytes") / CELL_BYTES)) <= 1
    rows, held = sizes.where(small).agg(
        F.coalesce(F.sum("_n"), F.lit(0)), F.coalesce(F.sum("_bytes"), F.lit(0))
    ).first()
    packs = max(1, rows // PACK, held // CELL_BYTES)
    known = members.join(sizes, "root")
    blocks = F.greatest(F.ceil(F.col("_n") / CELL), F.ceil(F.col("_bytes") / CELL_BYTES)).cast("int")
    pack = F.array(
        F.struct(
            F.pmod(F.xxhash64("root"), F.lit(packs)).cast("bigint").alias("c"),
            F.lit(-1).alias("i"),
            F.lit(-1).alias("j"),
        )
    )
    block = F.pmod(F.xxhash64("node"), blocks).cast("int")
    large = F.transform(
        F.sequence(F.lit(0), F.col("_blocks") - 1),
        lambda b: F.struct(
            F.col("root").alias("c"),
            F.least(b, F.col("_block")).alias("i"),
            F.greatest(b, F.col("_block")).alias("j"),
        ),
    )
    known = known.withColumns({"_blocks": blocks, "_block": block})
    cells = F.when(F.col("_blocks") <= 1, pack).otherwise(large)
    return known.withColumn("_cell", F.explode(cells)).select(
        *members.columns, "_block", "_cell.c", "_cell.i", "_cell.j"
    )


def _table_rows(table):
    """Sorted by component and class."""
    order = np.lexsort((table.column("node").to_numpy(), table.column("root").to_numpy()))
    return table.take(order)


def _sides(group, table):
    """Pairs of row runs of a sorted cell whose rows are to be compared, as index arrays.

    A packed cell has one pair for each component, of its rows with themselves.
    """
    i, j = group[1].as_py(), group[2].as_py()
    if i >= 0 and i != j:
        blocks = table.column("_block").to_numpy()
        yield np.flatnonzero(blocks == i), np.flatnonzero(blocks == j)
        return
    roots = table.column("root").to_numpy()
    cuts = np.flatnonzero(np.diff(roots)) + 1
    for rows in np.split(np.arange(len(roots)), cuts):
        if len(rows) > 1:
            yield rows, rows


def _survivors(steps, a, b, needed: dict[int, int]):
    """The pairs that no look at the posterior drops.

    ``steps`` has the rows' values in runs of STEP.
    """
    found = []
    for low in range(0, len(a), PAIRS):
        x, y = a[low : low + PAIRS], b[low : low + PAIRS]
        equal = np.zeros(len(x), np.int16)
        for k, values in enumerate(steps):
            equal += (values[x] == values[y]).sum(axis=1, dtype=np.int16)
            stay = equal >= needed[(k + 1) * STEP]
            x, y, equal = x[stay], y[stay], equal[stay]
        found.append((x, y))
    if not found:
        return a, b
    return tuple(np.concatenate(x) for x in zip(*found))


def _steps(table):
    raw = b"".join(table.column("sketch").to_pylist())
    values = np.frombuffer(raw, "<u2").reshape(-1, HASHES)
    return [np.ascontiguousarray(values[:, n : n + STEP]) for n in range(0, HASHES, STEP)]


def _connected(steps, label, a, b, needed) -> None:
    """Join in ``label`` the rows a and b that surviving pairs connect.

    Every pair of a row of a and one of b is compared, or is connected already.
    """
    rows = np.union1d(a, b)

    def join(x, y):
        # Labels are rows, so the forest is over all rows of the cell.
        found = forest_labels(len(label), label[x], label[y])
        label[:] = found[label]

    for pivot in rows[:PIVOTS].tolist():
        others = rows[label[rows] != label[pivot]]
        join(*_survivors(steps, np.full(len(others), pivot), others, needed))
    for low in range(0, len(a), CELL):
        part = a[low : low + CELL]
        x, y = np.nonzero(label[part][:, None] != label[b][None, :])
        x, y = part[x], b[y]
        if len(a) == len(b) and a[0] == b[0]:
            x, y = x[x < y], y[x < y]
        join(*_survivors(steps, x, y, needed))


def _prune(members: DataFrame, threshold: float) -> DataFrame:
    """Edges u, v that hold the surviving pairs' components together."""
    needed = least_matches(threshold)

    def compare(group, table):
        import pyarrow as pa

        table = _table_rows(table)
        nodes, steps = table.column("node").to_numpy(), _steps(table)
        label, held = np.arange(len(nodes)), []
        for a, b in _sides(group, table):
            if 0 < len(a) <= FEW and len(b) and a[0] == b[0]:
                x, y = np.triu_indices(len(a), 1)
                held.append((a[x], a[y]))
            elif len(a) and len(b):
                _connected(steps, label, a, b, needed)
        if held:
            x, y = _survivors(steps, *(np.concatenate(z) for z in zip(*held)), needed)
            label = forest_labels(len(label), label[x], label[y])[label]
        linked = np.flatnonzero(label != np.arange(len(nodes)))
        return pa.table({"u": nodes[label[linked]], "v": nodes[linked]})

    return _cells(members).groupBy("c", "i", "j").applyInArrow(compare, "u bigint, v bigint")


def _common(sets: list, a, b):
    """Sizes of the intersections of each set of rows a with each of rows b."""
    same = a is b or (len(a) == len(b) and a[0] == b[0])
    rows = a if same else np.concatenate([a, b])
    n, width = len(a), len(b)
    flat = np.concatenate([sets[r] for r in rows.tolist()])
    owner = np.repeat(np.arange(len(rows)), [len(sets[r]) for r in rows.tolist()])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    first = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]])) if len(flat) else np.zeros(0, int)
    counts = np.diff(np.append(first, len(flat)))
    column = np.repeat(np.arange(len(first)), counts)
    found = np.zeros((n, width))
    rare = np.repeat((counts > 1) & (counts <= DENSE), counts)
    some, some_columns = owner[rare], column[rare]
    for step in range(1, min(DENSE, int(counts.max()) if len(counts) else 0)):
        near = some_columns[step:] == some_columns[:-step]
        x, y = some[:-step][near], some[step:][near]
        if same:
            np.add.at(found, (x, y), 1)
            np.add.at(found, (y, x), 1)
        else:
            # Owners are in order, so a row of b is never before one of a.
            both = (x < n) & (y >= n)
            np.add.at(found, (x[both], y[both] - n), 1)
    many = np.repeat(counts > DENSE, counts)
    number = np.cumsum(counts > DENSE) - 1
    own, place = owner[many], number[column[many]]
    for low in range(0, int(place[-1]) + 1 if len(place) else 0, COLUMNS):
        s, e = np.searchsorted(place, [low, low + COLUMNS])
        held = np.zeros((len(rows), COLUMNS), np.float32)
        held[own[s:e], place[s:e] - low] = 1
        left, right = (held, held) if same else (held[:n], held[n:])
        found += left @ right.T
    return found


def _linked(sets: list, a, b, threshold: float):
    """Whether each row of a and each of b are links, exactly."""
    common = _common(sets, a, b)
    size_a = np.array([len(sets[r]) for r in a.tolist()])[:, None]
    size_b = np.array([len(sets[r]) for r in b.tolist()])[None, :]
    links = common >= threshold * (size_a + size_b - common) - 1e-9
    if a[0] == b[0]:
        np.fill_diagonal(links, False)
    return links


def _verify(members: DataFrame, threshold: float) -> DataFrame:
    """node, u, n_texts, n_docs per class and cell: its exact links there, in classes and in
    documents, and the least class it is linked with."""
    shape = "node bigint, u bigint, n_texts bigint, n_docs bigint"

    def check(group, table):
        import pyarrow as pa

        table = _table_rows(table)
        nodes, copies = table.column("node").to_numpy(), table.column("copies").to_numpy()
        sets = [np.frombuffer(x, "<u8") for x in table.column("shingles").to_pylist()]
        n_texts, n_docs = np.zeros(len(nodes), np.int64), np.zeros(len(nodes), np.int64)
        label = np.arange(len(nodes))
        for a, b in _sides(group, table):
            if not len(a) or not len(b):
                continue
            links = _linked(sets, a, b, threshold)
            n_texts[a] += links.sum(axis=1)
            n_docs[a] += links @ copies[b]
            if a[0] != b[0]:
                n_texts[b] += links.sum(axis=0)
                n_docs[b] += links.T @ copies[a]
            x, y = np.nonzero(links)
            found = forest_labels(len(label), label[a[x]], label[b[y]])
            label = found[label]
        some = np.flatnonzero(n_texts)
        return pa.table(
            {
                "node": nodes[some],
                "u": nodes[label[some]],
                "n_texts": n_texts[some],
                "n_docs": n_docs[some],
            }
        )

    return _cells(members).groupBy("c", "i", "j").applyInArrow(check, shape)


def _shingle_sets(docs: DataFrame) -> DataFrame:
    """``docs`` with shingles: sorted distinct hashes of their texts', 8 bytes each."""

    def make(texts):
        hashed, ends = word_arrays.words(texts)
        found, owner, _ = word_arrays.shingles(hashed, ends, WORDS)
        cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
        return [[np.unique(found[a:b]).tobytes() for a, b in zip(cuts[:-1], cuts[1:])]]

    fields = T.StructType([T.StructField("shingles", T.BinaryType())])
    return with_text_columns(docs, "text", fields, make)


def similar_documents(
    docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """A row per document: key, class_id, n_links, n_text_links.

    Two documents are linked if the Jaccard similarity of their sets of five-word shingles
    (words are cut at white space, as they are written) reaches the threshold. ``n_links``
    is the number of other documents linked with this one, ``n_text_links`` of texts with
    other words; ``class_id`` is the least key of all documents that links connect with
    it. A text of fewer words is one shingle. Texts without words, null ones too, are
    equal to each other. Repeated rows and keys are documents of their own; a null key
    stays null, and a class of such rows only has a null class_id. An empty table gives no
    rows; other columns are not read. Keys must be integers.

    Copies are one class from the start, whose size is aggregated before any shuffle. Pairs
    of different texts are compared in cells of bounded size and are never rows; no pair
    is left out but by the posterior's tolerance and by chance of the bands (see BANDS).
    Texts are told apart by 128 bits of a cryptographic hash, their words and shingles by 64.
    """
    rows = docs.select(
        F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"), text_kind(F.col(text)).alias("kind")
    )
    signed = stage(with_signatures(rows, "text").drop("text"), "signatures")
    found = stage(classes(signed, rows, threshold), "classes")
    joined = signed.select("key", "kind").join(found, "kind")
    return joined.select(
        F.col("key").alias(key),
        "class_id",
        (F.col("copies") - 1 + F.col("n_docs")).alias("n_links"),
        F.col("n_texts").alias("n_text_links"),
    )


def classes(signed: DataFrame, rows: DataFrame, threshold: float) -> DataFrame:
    """kind, root, class_id, copies, n_texts, n_docs of every class of texts with the same words."""
    kinds = signed.groupBy("kind").agg(
        F.min("key").alias("key"),
        F.count("*").alias("copies"),
        F.max("n_words").alias("n_words"),
        F.first("sketch").alias("sketch"),
    )
    # A number for each class, which is fixed as it is written.
    kinds = stage(kinds.withColumn("node", F.monotonically_increasing_id()), "text-classes")
    zero = F.lit(0).cast("bigint")
    alone = kinds.select(
        "kind",
        F.col("node").alias("root"),
        F.col("key").alias("class_id"),
        "copies",
        zero.alias("n_texts"),
        zero.alias("n_docs"),
    )
    worded = kinds.where("n_words > 0")
    found = components(_candidate_edges(worded))
    if found.isEmpty():
        return alone
    members = worded.join(found, "node").select(
        "root", "node", "sketch", F.lit(SKETCH_BYTES).alias("bytes")
    )
    # Written first: Python functions one after another in a stage take a worker each, and all
    # workers of an executor would stay and be used in turn by later jobs, with what they remember.
    found = components(stage(_prune(members, threshold), "pruned"))
    if found.isEmpty():
        return alone
    found = stage(found, "survivors")
    at = F.coalesce("key", F.lit(MISSING_KEY)).alias("at")
    wanted = kinds.join(found, "node").select("root", "node", "kind", "copies", "n_words", at)
    # A key may have several texts, and a text several rows of one key: one is taken by its hash.
    texts = rows.select(F.coalesce("key", F.lit(MISSING_KEY)).alias("at"), "kind", "text")
    texts = texts.join(wanted, ["at", "kind"]).dropDuplicates(["node"])
    fetched = _shingle_sets(texts).select(
        "root", "node", "copies", "shingles", (F.col("n_words") * 8).alias("bytes")
    )
    verified = stage(_verify(fetched, threshold), "verified")
    linked = components(verified.select("u", F.col("node").alias("v")))
    sums = verified.groupBy("node").agg(F.sum("n_texts").alias("n_texts"), F.sum("n_docs").alias("n_docs"))
    rooted = kinds.join(linked, "node", "left").select(
        "node", "kind", "key", "copies", F.coalesce("root", "node").alias("root")
    )
    # Written, so that a join with a large component's classes can be split.
    least = stage(rooted.groupBy("root").agg(F.min("key").alias("class_id")), "least-keys")
    return (
        rooted.join(least, "root")
        .join(sums, "node", "left")
        .select(
            "kind",
            "root",
            "class_id",
            "copies",
            F.coalesce("n_texts", zero).alias("n_texts"),
            F.coalesce("n_docs", zero).alias("n_docs"),
        )
    )


def one_of_each(
    docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """The documents, with their own columns, that have the least key of their class.

    Rows without a key stay only if their class has no other. Of repeated rows of the
    chosen key and words one stays: the one with the least hash of its columns, as far as
    they can be hashed. Columns may have any names and types. See ``similar_documents`` for
    what a class is.
    """
    held = docs.select(
        F.col(key).cast("bigint").alias("key"),
        F.col(text).alias("text"),
        text_kind(F.col(text)).alias("kind"),
        F.struct("*").alias("row"),
    )
    rows = held.select("key", "text", "kind")
    signed = stage(with_signatures(rows, "text").drop("text"), "signatures")
    found = stage(classes(signed, rows, threshold), "classes")
    least = F.min(F.struct(F.col("key").isNull().alias("none"), "key", "kind"))
    keys = signed.select("key", "kind").join(found.select("kind", "root"), "kind")
    chosen = keys.groupBy("root").agg(least.alias("x")).select(
        F.col("x.key").alias("own_key"), F.col("x.kind").alias("own_kind")
    )
    own = held.select("key", "kind", "row")
    same = F.col("key").eqNullSafe(F.col("own_key")) & (F.col("kind") == F.col("own_kind"))
    kept = own.join(chosen, same, "left_semi")
    hashed = [
        F.col("row").getField(f.name)
        for f in docs.schema.fields
        if not any(k in f.dataType.simpleString() for k in ("map<", "variant"))
    ]
    first = Window.partitionBy("key", "kind").orderBy(F.xxhash64(*hashed))
    kept = kept.withColumn("place", F.row_number().over(first)).where("place = 1")
    return kept.select("row.*")
