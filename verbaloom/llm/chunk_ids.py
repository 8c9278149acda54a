"""Library ids of many texts at once: each distinct chunk of a slice is encoded once."""

from __future__ import annotations

import json
import os

import numpy as np

from verbaloom.llm.common import Memo

# Signs that end many words. After a letter or digit they always begin a new pre-token. Lower
# case may turn a letter into a letter and a mark, so only letters that stay one are named.
TAIL = ".,;:!?"
# How a byte-level vocabulary writes a space, and how many chunks make one text.
SPACE, TOGETHER = "\u0120", 512
ENDED = "(?s)^(?P<core>.*[0-9A-Za-z\u00df-\u00f6\u00f8-\u00ff])(?P<tail>[.,;:!?]+)$"


def flat_strings(lists):
    """The strings of an Arrow list array and where each list's strings end, from 0 on."""
    offsets = lists.offsets.to_numpy()
    return lists.flatten(), offsets[1:] - offsets[0]


def gather(pool, ends, codes):
    """The runs of ``pool`` that ``codes`` name, end to end, and the length of each.

    Run c of the pool ends at ``ends[c]``, where run c + 1 begins.
    """
    lengths = np.diff(ends, prepend=0)
    taken = lengths[codes]
    after = np.cumsum(taken)
    total = int(after[-1]) if len(after) else 0
    shift = (ends - lengths)[codes] - (after - taken)
    return pool[np.repeat(shift, taken) + np.arange(total)], taken


class Ragged:
    """Id runs of numbered strings; a string may be marked as having none of its own."""

    def __init__(self, pool, ends, missing):
        self.pool, self.ends, self.missing = pool, ends, missing

    @classmethod
    def of(cls, runs: list, dtype) -> Ragged:
        missing = np.zeros(len(runs), bool)
        if None in runs:
            missing = np.fromiter((r is None for r in runs), bool, len(runs))
            runs = [r or b"" for r in runs]
        sizes = np.fromiter(map(len, runs), np.int64, len(runs))
        return cls(np.frombuffer(b"".join(runs), dtype), np.cumsum(sizes) // np.dtype(dtype).itemsize, missing)

    def chosen(self, codes) -> Ragged:
        ids, sizes = gather(self.pool, self.ends, codes)
        return Ragged(ids, np.cumsum(sizes), self.missing[codes])

    def before(self, other: Ragged) -> Ragged:
        """Each run with that of the same number in ``other`` after it."""
        n = len(self.ends)
        both = self.after(other).chosen(np.arange(2 * n).reshape(2, n).T.ravel())
        return Ragged(both.pool, both.ends[1::2], self.missing | other.missing)

    def after(self, other: Ragged) -> Ragged:
        """The runs of both, those of ``other`` numbered after these."""
        last = self.ends[-1] if len(self.ends) else 0
        return Ragged(
            np.concatenate([self.pool, other.pool]),
            np.concatenate([self.ends, other.ends + last]),
            np.concatenate([self.missing, other.missing]),
        )

    def sizes(self):
        return np.diff(self.ends, prepend=0)


class ChunkEncoder:
    """Ids of whole texts by the tokenizers library, from the ids of their chunks.

    Two kinds of vocabulary are cut into chunks; the texts of any other go in whole.

    ``words``: the pre-tokenizer removes white space, so a text's ids are those of its runs
    between ASCII white space, whatever is in them.
    ``spaces``: a byte-level pattern without a normalizer, which always cuts at a single space
    between two other characters. A chunk is a word with the space before it; texts with a
    chunk that has other white space at its ends go in whole.

    Signs at a chunk's end are encoded apart. Chunks are remembered (see ``Memo``). New chunks
    of the kind ``spaces`` go to the library as one text: its ids of a chunk begin with the
    only token there that begins with a space. Strings of added tokens inside texts are read
    as the library does by default.
    """

    def __init__(self, content: bytes, dtype: str, memo: tuple = ()):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_buffer(content)
        self.dtype = np.dtype(dtype)
        self.kind = self._kind(json.loads(content))
        self.first = Memo(lambda words: self._chunks(words, ""))
        before = " " if self.kind == "spaces" else ""
        self.rest = Memo(lambda words: self._chunks(words, before), *memo)
        self.tails = Memo(self._whole)
        # Which ids begin with a space. With that sign in the vocabulary every chunk has such an id.
        vocab, model = self.library.get_vocab(), json.loads(content)["model"]
        self.opens = np.zeros(max(vocab.values(), default=-1) + 1, bool)
        self.opens[[i for token, i in vocab.items() if token.startswith(SPACE)]] = True
        self.joins = self.kind == "spaces" and model["type"] == "BPE" and SPACE in model["vocab"]

    @staticmethod
    def _kind(spec: dict) -> str:
        for token in spec["added_tokens"]:
            odd = any(token[k] for k in ("single_word", "lstrip", "rstrip", "normalized"))
            if odd or any(c in TAIL or c.isspace() for c in token["content"]):
                return "whole"
        pre, normal = spec["pre_tokenizer"] or {}, spec["normalizer"] or {}
        if pre.get("type") == "ByteLevel" and not normal:
            return "spaces" if pre["use_regex"] and not pre["add_prefix_space"] else "whole"
        split = pre.get("pretokenizers", [pre])[0]
        kept = split.get("pattern", {}).get("Regex", "")
        changes = {n["type"] for n in normal.get("normalizers", [normal] if normal else [])}
        # What is kept is runs of letters, digits, signs that are no white space, and suffixes.
        removes = split.get("type") == "Split" and split["behavior"] == "Removed" and split["invert"]
        if removes and "[^\\s\\p{L}\\p{N}]+" in kept and changes <= {"NFC", "Replace", "Lowercase"}:
            return "words"
        return "whole"

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.dtype).tobytes() for e in found]

    def _chunks(self, words: list[str], before: str) -> list:
        """The ids of ``before + word``; None for a word that is no chunk of its own."""
        if self.kind == "words":
            return self._whole(words)
        clean = [w for w in words if w and w.strip() == w]
        made = self._in_one(clean) if before and self.joins else self._whole([before + w for w in clean])
        if len(clean) == len(words):
            return made
        known = dict(zip(clean, made))
        return [known.get(w) for w in words]

    def _in_one(self, words: list[str]) -> list[bytes]:
        """The ids of each word with a space before it, from texts of many such words."""
        made = []
        for low in range(0, len(words), TOGETHER):
            part = words[low : low + TOGETHER]
            listed = self.library.encode_batch_fast([" " + " ".join(part)], add_special_tokens=False)[0].ids
            ids = np.array(listed, np.int64)
            starts = np.flatnonzero(self.opens[ids])
            # More of them: a text holds the string of an added token that begins with that sign.
            if len(starts) != len(part):
                made += self._whole([" " + w for w in part])
                continue
            raw, size = ids.astype(self.dtype).tobytes(), self.dtype.itemsize
            cuts = [*(starts * size).tolist(), len(raw)]
            made += [raw[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
        return made

    def _runs(self, words, memo) -> Ragged:
        """The ids of each of an Arrow array of chunks."""
        import pyarrow.compute as pc

        cut = pc.extract_regex(words, ENDED)
        cores = pc.coalesce(pc.struct_field(cut, "core"), words)
        tails = pc.fill_null(pc.struct_field(cut, "tail"), "")
        return self._known(cores, memo).before(self._known(tails, self.tails))

    def _known(self, words, memo) -> Ragged:
        coded = words.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        known = memo.fill(set(distinct))
        return Ragged.of([known[w] for w in distinct], self.dtype).chosen(_codes(coded))

    def encode(self, texts):
        """The ids of an Arrow array of texts, end to end, and the number of each text's ids.
        A null text has none."""
        import pyarrow as pa
        import pyarrow.compute as pc

        texts = pc.fill_null(texts, "").cast(pa.large_string())
        if self.kind == "whole" or not len(texts):
            runs = Ragged.of(self._whole(texts.to_pylist()), self.dtype)
            return runs.pool, runs.sizes()
        if self.kind == "spaces":
            return self._by_spaces(texts)
        values, ends = flat_strings(pc.ascii_split_whitespace(texts))
        coded = values.dictionary_encode()
        found = self._runs(coded.dictionary, self.rest).chosen(_codes(coded))
        return found.pool, _sums(found.sizes(), ends)

    def _by_spaces(self, texts):
        import pyarrow.compute as pc

        values, ends = flat_strings(pc.split_pattern(texts, " "))
        sizes = np.diff(ends, prepend=0)
        coded = values.dictionary_encode()
        codes = _codes(coded)
        # Every text's first word has no space before it: it gets a run of its own.
        at = ends - sizes
        runs = self._runs(coded.dictionary, self.rest)
        opening = self._runs(coded.dictionary.take(coded.indices.take(at)), self.first)
        codes[at] = len(runs.ends) + np.arange(len(at))
        runs = runs.after(opening)
        # A text with an odd chunk is one run, in the place of its first word. (Of a text
        # without any character that chunk is empty, and the library gives no ids for it.)
        odd = np.zeros(len(ends), bool)
        odd[np.searchsorted(ends, np.flatnonzero(runs.missing[codes]), side="right")] = True
        whole = np.flatnonzero(odd)
        if len(whole):
            codes = codes[~np.repeat(odd, sizes) | (np.arange(len(codes)) == np.repeat(at, sizes))]
            sizes = np.where(odd, 1, sizes)
            ends = np.cumsum(sizes)
            codes[(ends - sizes)[whole]] = len(runs.ends) + np.arange(len(whole))
            runs = runs.after(Ragged.of(self._whole(texts.take(whole).to_pylist()), self.dtype))
        found = runs.chosen(codes)
        return found.pool, _sums(found.sizes(), ends)


def _codes(coded):
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _sums(values, ends):
    """The sum of each run of values."""
    sums = np.concatenate([[0], np.cumsum(values)])[ends]
    return np.diff(sums, prepend=0)


def with_end(ids, sizes, end_id: int):
    """The ids with ``end_id`` after those of each text, and where each text then ends."""
    ends = np.cumsum(sizes + 1)
    out = np.full(int(ends[-1]) if len(ends) else 0, end_id, ids.dtype)
    inside = np.ones(len(out), bool)
    inside[ends - 1] = False
    out[inside] = ids
    return out, ends
