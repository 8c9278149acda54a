"""Benchmark decontamination by greedy string tiling (operator 4)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verbaloom.llm import word_arrays
from verbaloom.llm.common import Aside, quoted, with_text_columns, without, worker_state

# Words of the shortest tile, and the share of an item's words that must be tiled.
TILE_WORDS, COVERAGE = 5, 0.5
# Bytes of benchmark text that one broadcast holds; a larger benchmark goes in blocks.
BLOCK_BYTES = 16 << 20
LEAKS = "array<struct<item_id: bigint, coverage: double, matched: int, tiles: int>>"


class Block:
    """Some benchmark items: their seeds in order, with item and place."""

    def __init__(self, items: list[tuple[int, str]], width: int):
        import numpy as np

        self.ids = [i for i, _ in items]
        hashed, ends = word_arrays.words([t.lower() for _, t in items], word_arrays.PUNCTUATION)
        self.sizes = np.diff(ends, prepend=0)
        self.words, self.starts = hashed, ends - self.sizes
        seeds, owner, first = word_arrays.shingles(hashed, ends, width)
        long = self.sizes[owner] >= width
        place = first - self.starts[owner]
        order = np.argsort(seeds[long], kind="stable")
        self.seeds, self.owner, self.place = (x[long][order] for x in (seeds, owner, place))
        # A first test of one bit per hash spares most searches.
        self.mask = np.uint64((1 << 22) - 1)
        self.bits = np.zeros(1 << 22, bool)
        self.bits[(self.seeds & self.mask).astype(np.int64)] = True

    def join(self, seeds):
        """Pairs of equal seeds: indexes into the given ones and into the block's."""
        import numpy as np

        near = np.flatnonzero(self.bits[(seeds & self.mask).astype(np.int64)])
        low = np.searchsorted(self.seeds, seeds[near], side="left")
        counts = np.searchsorted(self.seeds, seeds[near], side="right") - low
        total = np.cumsum(counts)
        inner = np.arange(total[-1] if len(total) else 0) - np.repeat(total - counts, counts)
        return np.repeat(near, counts), np.repeat(low, counts) + inner


def tile(matches: list[tuple[int, int, int]], width: int) -> tuple[int, int]:
    """Greedy string tiling of maximal matches (length, place in item, place in text).

    The longest match whose words are not yet marked, on either side, becomes a tile and
    is marked; what other matches still have unmarked stays in play if it is ``width``
    words or longer. Ties go to the first place in the item, then in the text. Returns
    the marked words and the number of tiles.
    """
    import heapq

    heap = [(-length, a, b) for length, a, b in matches]
    heapq.heapify(heap)
    in_item, in_text, marked, tiles = set(), set(), 0, 0
    while heap:
        length, a, b = heapq.heappop(heap)
        free = [a + i not in in_item and b + i not in in_text for i in range(-length)]
        if all(free):
            in_item.update(range(a, a - length))
            in_text.update(range(b, b - length))
            marked, tiles = marked - length, tiles + 1
            continue
        begun = None
        for i, is_free in enumerate([*free, False]):
            if is_free and begun is None:
                begun = i
            elif not is_free and begun is not None:
                if i - begun >= width:
                    heapq.heappush(heap, (begun - i, a + begun, b + begun))
                begun = None
    return marked, tiles


def _leaks(texts: list[str], blocks: list[Block], width: int, coverage: float) -> list[list[dict]]:
    """The leaked items of each text: its seeds are made once for all blocks."""
    hashed, ends = word_arrays.words([t.lower() for t in texts], word_arrays.PUNCTUATION)
    seeds = word_arrays.shingles(hashed, ends, width)
    found: list[list[dict]] = [[] for _ in texts]
    for block in blocks:
        _block_leaks(found, hashed, seeds, block, width, coverage)
    for leaks in found:
        leaks.sort(key=lambda x: (x["item_id"] is None, x["item_id"] or 0))
    return found


def _block_leaks(found: list, hashed, shingles, block: Block, width: int, coverage: float) -> None:
    import numpy as np

    seeds, text_of, first = shingles
    mine, theirs = block.join(seeds)
    if not len(mine):
        return
    text, at = text_of[mine], first[mine]
    item, place = block.owner[theirs], block.place[theirs]
    # Equal hashes of seeds are only a hint: their words must be equal.
    there = block.starts[item] + place
    same = np.ones(len(at), bool)
    for i in range(width):
        same &= hashed[at + i] == block.words[there + i]
    text, at, item, place = (x[same] for x in (text, at, item, place))
    if not len(at):
        return
    # Seeds one after another on a diagonal are one maximal match.
    order = np.lexsort((place, at - place, item, text))
    text, at, item, place = (x[order] for x in (text, at, item, place))
    breaks = np.ones(len(at), bool)
    breaks[1:] = (
        (np.diff(text) != 0)
        | (np.diff(item) != 0)
        | (np.diff(at - place) != 0)
        | (np.diff(place) != 1)
    )
    begin = np.flatnonzero(breaks)
    length = np.diff(np.append(begin, len(at))) + width - 1
    pairs = np.flatnonzero(
        np.concatenate([[True], (np.diff(text[begin]) != 0) | (np.diff(item[begin]) != 0)])
    )
    for a, b in zip(pairs, [*pairs[1:], len(begin)]):
        spans = begin[a:b]
        i, n = int(item[spans[0]]), int(block.sizes[item[spans[0]]])
        # Matches together too short for the threshold need no tiling.
        if length[a:b].sum() < coverage * n:
            continue
        matches = zip(length[a:b].tolist(), place[spans].tolist(), at[spans].tolist())
        marked, tiles = tile(list(matches), width)
        if marked >= coverage * n:
            found[int(text[spans[0]])].append(
                {"item_id": block.ids[i], "coverage": marked / n, "matched": marked, "tiles": tiles}
            )


def with_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    width: int = TILE_WORDS,
    coverage: float = COVERAGE,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` with ``leaks``: the benchmark items (item_id, text) whose words are covered
    to ``coverage`` at least by tiles of ``width`` words or more in the text, in item order,
    with the covered share, the words matched and the number of tiles.

    Words are compared in lower case, without punctuation. Tiles may lie in any order, so
    a reordered passage is found too. A null text is empty and has no leaks; neither has
    an item that is null or shorter than ``width`` words. Repeated items are reported each,
    repeated documents too. An earlier column ``leaks`` is replaced.

    Documents do not move, and their words are hashed once. The benchmark is sent to them in
    blocks of about ``block_bytes`` (one item at least), all of which a worker holds, and a
    document's matches are tiled where they are found: no task gathers the documents that
    share a passage.
    """
    spark = docs.sparkSession
    items = benchmark.where("text is not null").select("item_id", "text")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = -(-total // block_bytes)
    fields = T.StructType([T.StructField("leaks", T._parse_datatype_string(LEAKS))])
    if not n_blocks:
        kept = docs.select(*quoted(without(docs, ["leaks"])))
        return kept.withColumn("leaks", F.array().cast(LEAKS))
    shipped = []
    for number in range(n_blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == number)
        shipped.append(spark.sparkContext.broadcast([tuple(r) for r in part.collect()]))
    token = uuid.uuid4().hex

    def make(texts):
        blocks = worker_state(("benchmark", token), lambda: [Block(s.value, width) for s in shipped])
        return [_leaks(texts, blocks, width, coverage)]

    return with_text_columns(docs, text, fields, make)


def leaking_pairs(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", **settings) -> DataFrame:
    """A row per document and leaked item: key, item_id, coverage, matched, tiles."""
    found = with_leaks(docs.select(key, "text"), benchmark, **settings)
    return found.select(key, F.explode("leaks").alias("leak")).select(key, "leak.*")


def decontaminate(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """The documents, with their own columns, in which no item leaks. See ``with_leaks`` for
    null and empty texts; repeated rows stay or go together."""
    beside = Aside(docs, ["leaks"])
    settings["text"] = beside.name(settings.get("text", "text"))
    found = with_leaks(beside.df, benchmark, **settings)
    return beside.back(found.where(F.size("leaks") == 0).drop("leaks"))
