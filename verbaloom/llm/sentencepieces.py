"""SentencePiece encoding and decoding for merge-type vocabularies (operator 3)."""

from __future__ import annotations

import heapq
import re

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from verbaloom.llm.common import Memo, ship_file, with_text_columns, worker_state
from verbaloom.llm.ragged_merge import PairTable, merge_all

SPACE = "▁"
# Longer chunks get a heap of their own; shorter ones share arrays.
LONG = 96


class PieceMerges:
    """A merge-type SentencePiece model.

    The agenda holds every adjacent pair of symbols whose joined text is a piece, ordered
    by score and then from the left. The best pair is merged, and only pairs that touch
    the new symbol are entered anew. The agendas of a batch's chunks are popped together,
    as ragged arrays; a long chunk has a heap. Characters without a piece become bytes.

    No piece has a space mark after another character (this is checked), so text is cut
    before each run of spaces, and chunks are remembered by their text.
    """

    def __init__(self, content: bytes, check: bool = True):
        import numpy as np
        import sentencepiece

        self.library = lib = sentencepiece.SentencePieceProcessor(model_proto=content)
        self.check = check
        self.size = size = lib.get_piece_size()
        pieces = [lib.id_to_piece(i) for i in range(size)]
        self.bytes_of, plain = [], {}
        for i, piece in enumerate(pieces):
            if lib.is_byte(i):
                self.bytes_of.append(bytes([int(piece[3:5], 16)]))
            elif lib.is_control(i):
                self.bytes_of.append(b"")
            elif lib.is_unknown(i):
                self.bytes_of.append(" ⁇ ".encode())
            else:
                self.bytes_of.append(piece.replace(SPACE, " ").encode())
                if not lib.is_unused(i):
                    plain[piece] = i
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in plain):
            raise ValueError("a piece spans a word boundary: this model cannot be cut into chunks")
        self.controls = {i for i in range(size) if lib.is_control(i)}
        self.spaced = {i for i in range(size) if pieces[i].startswith(SPACE)}
        self.byte_ids = [lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        # Characters without a piece have symbols from ``size`` on, unknown ones ``size``.
        symbols = dict(plain)
        for char in sorted({c for p in plain for c in p} - plain.keys()):
            symbols[char] = size + 1 + len(symbols)
        self.symbol_of = np.full(0x110000, size, np.int32)
        self.width = np.ones(size + 2 + len(symbols), np.int64)
        for text, symbol in symbols.items():
            self.width[symbol] = len(text)
            if len(text) == 1:
                self.symbol_of[ord(text)] = symbol
        order = {s: r for r, s in enumerate(sorted({-lib.get_score(i) for i in plain.values()}))}
        pairs = [
            (symbols[p[:k]], symbols[p[k:]], order[-lib.get_score(i)], i)
            for p, i in plain.items()
            for k in range(1, len(p))
            if p[:k] in symbols and p[k:] in symbols
        ]
        self.listed = np.array(pairs, np.int64)
        self.table = PairTable(*self.listed.T)
        self.pairs = None
        self.memo = Memo(self.encode_chunks)

    def agenda(self, symbols: list[int]) -> list[int]:
        """One long chunk: a heap of (rank, position), stale entries skipped."""
        if self.pairs is None:
            self.pairs = {(a, b): (rank, i) for a, b, rank, i in self.listed.tolist()}
        after = [*range(1, len(symbols)), -1]
        before = [*range(-1, len(symbols) - 1)]
        symbols, heap = list(symbols), []

        def enter(i: int) -> None:
            if i >= 0 and after[i] >= 0:
                found = self.pairs.get((symbols[i], symbols[after[i]]))
                if found:
                    heapq.heappush(heap, (found[0], i, symbols[i], symbols[after[i]], found[1]))

        for i in range(len(symbols)):
            enter(i)
        while heap:
            _, i, left, right, merged = heapq.heappop(heap)
            j = after[i] if symbols[i] == left else -1
            if j < 0 or symbols[j] != right:
                continue
            symbols[i], symbols[j], after[i] = merged, -1, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            after[j] = -1
            enter(before[i])
            enter(i)
        return [s for s in symbols if s >= 0]

    def encode_chunks(self, chunks: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each chunk; a chunk is given without its first
        space mark, and with spaces for the others."""
        import numpy as np

        marked = [" " + c for c in chunks]
        codes = np.frombuffer("".join(marked).replace(" ", SPACE).encode("utf-32-le"), np.uint32)
        lengths = np.fromiter(map(len, marked), np.int64, len(marked))
        symbols = self.symbol_of[codes]
        short = lengths <= LONG
        ends = np.cumsum(lengths)
        inside = np.repeat(short, lengths)
        merged, counts = merge_all(symbols[inside], lengths[short], self.table, every=False)
        encoded = self.as_bytes(merged, counts, [m for m, s in zip(marked, short) if s])
        for i in np.flatnonzero(~short).tolist():
            one = np.array(
                self.agenda(symbols[ends[i] - lengths[i] : ends[i]].tolist()), np.int32
            )
            encoded.insert(i, self.as_bytes(one, np.array([len(one)]), [marked[i]])[0])
        if self.check:
            self.compare(chunks, marked, encoded)
        return encoded

    def as_bytes(self, symbols, counts, marked: list[str]) -> list[bytes]:
        """Each chunk's ids; symbols without a piece are replaced by their bytes."""
        import numpy as np

        raw, cuts = symbols.tobytes(), np.concatenate([[0], np.cumsum(counts)])
        bounds = (4 * cuts).tolist()
        encoded = [raw[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
        bare = np.flatnonzero(symbols >= self.size)
        for i in np.unique(np.searchsorted(cuts, bare, side="right") - 1).tolist():
            encoded[i] = self.with_bytes(symbols[cuts[i] : cuts[i + 1]], marked[i])
        return encoded

    def with_bytes(self, symbols, marked: str) -> bytes:
        import numpy as np

        ids, at = [], 0
        for symbol in symbols.tolist():
            width = int(self.width[symbol])
            if symbol < self.size:
                ids.append(symbol)
            else:
                ids.extend(self.byte_ids[b] for b in marked[at : at + width].encode())
            at += width
        return np.array(ids, np.int32).tobytes()

    def compare(self, chunks: list[str], marked: list[str], encoded: list[bytes]) -> None:
        """Fail unless the library gives the same ids, and the same texts back."""
        import numpy as np

        flat = np.frombuffer(b"".join(encoded), np.int32).tolist()
        ends = np.cumsum([0] + [len(e) // 4 for e in encoded]).tolist()
        ours = [flat[a:b] for a, b in zip(ends[:-1], ends[1:])]
        theirs = self.library.encode(chunks, num_threads=1)
        if ours != theirs:
            for chunk, a, b in zip(chunks, ours, theirs):
                # The library gives an empty text no space mark.
                if a != b and not (chunk == "" and a == [self.library.piece_to_id(SPACE)]):
                    raise ValueError(f"the library encodes {chunk!r} as {b}, not {a}")
        if self.library.decode(ours) != chunks:
            raise ValueError("the library decodes a chunk differently")
        if b"".join(map(self.bytes_of.__getitem__, flat)) != "".join(marked).encode():
            raise ValueError("the ids do not give the text back")

    def encode(self, texts: list[str]) -> list[bytes]:
        cut = []
        for text in texts:
            text = text.replace(SPACE, " ")
            if not text:
                cut.append([])
            elif "  " in text or text[0] == " " or text[-1] == " ":
                cut.append([c[1:] for c in re.findall(" +[^ ]*", " " + text)])
            else:
                cut.append(text.split(" "))
        known = self.memo.fill(set().union(*cut))
        return [b"".join(map(known.__getitem__, chunks)) for chunks in cut]

    def decode(self, ids: list[int]) -> str:
        """The text of any ids: pieces and bytes one after another, without the space that
        encoding puts in front. A byte that is not part of a character is U+FFFD."""
        text = ""
        for run in [ids] if self.controls.isdisjoint(ids) else self.runs(ids):
            raw = b"".join(map(self.bytes_of.__getitem__, run))
            try:
                found = raw.decode()
            except UnicodeDecodeError:
                found = _byte_wise(raw)
            text += found[1:] if not text and run and run[0] in self.spaced else found
        return text

    def runs(self, ids: list[int]):
        """The ids between control ids, which have no text."""
        run = []
        for i in ids:
            if i in self.controls:
                yield run
                run = []
            else:
                run.append(i)
        yield run


def _byte_wise(raw: bytes) -> str:
    out, at = [], 0
    while at < len(raw):
        for width in (1, 2, 3, 4):
            try:
                out.append(raw[at : at + width].decode())
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            width = 1
        at += width
    return "".join(out)


def encode_texts(
    df: DataFrame, model: str, text: str = "text", decode: bool = False, check: bool = True
) -> DataFrame:
    """``df`` with token_ids (array of int) and, if ``decode``, decoded (string).

    ``model`` is the path of a merge-type SentencePiece model with byte fallback. The ids
    are the library's, without begin and end; each chunk that a worker meets for the
    first time is also encoded and decoded by the library, and a difference is an error
    (``check``). ``decoded`` is made from the ids alone. A null or empty text has no ids
    and decodes to an empty text. Repeated rows are encoded each; an empty table gives
    none; earlier columns of these names are replaced. Whole texts of any length, no
    shuffle; workers hold one slice of texts and a bounded memo.
    """
    shipped = ship_file(df.sparkSession, model)
    fields = [T.StructField("token_ids", T.ArrayType(T.IntegerType(), False))]
    fields += [T.StructField("decoded", T.StringType())] * decode

    def make(texts):
        import numpy as np
        import pyarrow as pa

        key = ("sentencepieces", shipped.value, check)
        merges = worker_state(key, lambda: PieceMerges(shipped.value, check))
        encoded = merges.encode(texts)
        ends = np.cumsum([0] + [len(e) // 4 for e in encoded]).astype(np.int32)
        values = np.frombuffer(b"".join(encoded), np.int32)
        made = [pa.ListArray.from_arrays(pa.array(ends), pa.array(values))]
        if decode:
            flat = values.tolist()
            made.append([merges.decode(flat[a:b]) for a, b in zip(ends[:-1], ends[1:])])
        return made

    return with_text_columns(df, text, T.StructType(fields), make)


def decode_ids(df: DataFrame, model: str, ids: str = "token_ids") -> DataFrame:
    """``df`` with decoded: the text of an id array as the library's decode gives it; null
    and empty arrays give an empty text. An id outside the model is an error."""
    shipped = ship_file(df.sparkSession, model)
    kept = [c for c in df.columns if c != "decoded"]
    source = df.select(*kept)
    shape = T.StructType([*source.schema.fields, T.StructField("decoded", T.StringType())])

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(shape)
        for batch in batches:
            key = ("sentencepieces", shipped.value, True)
            merges = worker_state(key, lambda: PieceMerges(shipped.value, True))
            rows = batch.column(batch.schema.get_field_index(ids)).to_pylist()
            if any(i is None or not 0 <= i < merges.size for row in rows for i in row or []):
                raise ValueError("an id that the model does not have")
            texts = pa.array([merges.decode(row or []) for row in rows], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], schema=schema)

    return source.mapInArrow(run, shape)
