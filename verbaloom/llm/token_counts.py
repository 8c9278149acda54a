"""Token counts of whole texts by rank-synchronous merging (operator 1)."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verbaloom.llm.common import Memo, ship_file, with_text_columns, worker_state
from verbaloom.llm.ragged_merge import PairTable, merge_all

# The split before merging, with white space as the Unicode property.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
UNSAFE = -1


def byte_letters() -> dict[int, str]:
    """How a byte-level vocabulary file writes each byte: printable Latin-1 characters as
    they are, the other bytes as the characters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class ByteMerges:
    """A byte-level BPE vocabulary (a tokenizers ``.json`` file) as arrays.

    A text is cut at its added tokens, then at single spaces between two other characters,
    where the split pattern always cuts, then by the pattern. What has been counted is
    remembered by piece; unknown pre-tokens are merged together as ragged byte arrays.
    """

    def __init__(self, content: bytes):
        import numpy as np
        import regex

        spec = json.loads(content)
        model = spec["model"]
        pre = spec["pre_tokenizer"]
        if spec["normalizer"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"]:
            raise ValueError("only plain byte-level vocabularies can be counted")
        ids = model["vocab"]
        letters = byte_letters()
        self.byte_ids = np.array([ids[letters[b]] for b in range(256)], np.int32)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.table = PairTable(
            np.array([ids[a] for a, _ in pairs]),
            np.array([ids[b] for _, b in pairs]),
            np.arange(len(pairs)),
            np.array([ids[a + b] for a, b in pairs]),
        )
        added = [t["content"] for t in spec["added_tokens"]]
        self.added = regex.compile("|".join(map(regex.escape, added))) if added else None
        self.hints = added
        self.find = regex.compile(PATTERN).findall
        self.cut = regex.compile(r"(?<=\P{White_Space}) (?=\P{White_Space})").split
        self.tokens = Memo(self.count_pretokens)
        self.first = Memo(lambda words: self.count_chunks(words, ""))
        self.rest = Memo(lambda words: self.count_chunks(words, " "))

    def count_pretokens(self, pretokens: list[str]):
        """The surviving symbols of each pre-token."""
        import numpy as np

        raw = [p.encode("utf-8", "surrogatepass") for p in pretokens]
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        symbols = self.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
        return merge_all(symbols, lengths, self.table, every=True)[1].tolist()

    def count_chunks(self, words: list[str], before: str) -> list[int]:
        """Tokens of ``before + word``. A word that is empty or has white space at an end
        is no safe cut when it follows a space: ``UNSAFE``."""
        found = [self.find(before + w) for w in words]
        known = self.tokens.fill({p for f in found for p in f})
        counts = [sum(known[p] for p in f) for f in found]
        for i, w in enumerate(words):
            if not w or w[0].isspace() or w[-1].isspace():
                counts[i] = UNSAFE
        return counts

    def count(self, texts: list[str]) -> list[int]:
        totals, parts, owners = [0] * len(texts), [], []
        for i, text in enumerate(texts):
            cut = [text]
            if self.added and any(hint in text for hint in self.hints):
                cut = self.added.split(text)
                totals[i] = len(cut) - 1
            for part in cut:
                if part:
                    parts.append(part.split(" "))
                    owners.append(i)
        first = self.first.fill({words[0] for words in parts})
        rest = self.rest.fill(set().union(*(words[1:] for words in parts)))
        odd = []
        for i, words in zip(owners, parts):
            counts = [first[words[0]], *map(rest.__getitem__, words[1:])]
            if min(counts) == UNSAFE:
                odd.append((i, self.cut(" ".join(words))))
            else:
                totals[i] += sum(counts)
        for i, chunks in odd:
            found = [p for k, c in enumerate(chunks) for p in self.find(" " * (k > 0) + c)]
            known = self.tokens.fill(set(found))
            totals[i] += sum(known[p] for p in found)
        return totals


def token_counts(
    df: DataFrame, vocabulary: str, text: str = "text", limit: int = 1024
) -> DataFrame:
    """``df`` with n_bytes (UTF-8), n_tokens and over_limit (more tokens than ``limit``).

    ``vocabulary`` is the path of a byte-level BPE ``.json`` file. No begin or end tokens;
    an added token inside a text counts as one token, as in the library. A null text
    counts as empty: 0 bytes, 0 tokens. Repeated rows are counted each; an empty table
    gives none. Earlier columns of these three names are replaced. A text of any length is
    counted whole. No row is shuffled: workers hold one slice of texts and a memo of
    bounded size.
    """
    shipped = ship_file(df.sparkSession, vocabulary)
    fields = T.StructType([T.StructField("n_tokens", T.LongType())])

    def make(texts):
        key = ("token_counts", shipped.value)
        return [worker_state(key, lambda: ByteMerges(shipped.value)).count(texts)]

    counted = with_text_columns(df, text, fields, make)
    size = F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("bigint")
    return counted.withColumns({"n_bytes": size, "over_limit": F.col("n_tokens") > limit})
