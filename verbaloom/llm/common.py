"""What the training-data operators share: input tables, worker state, Arrow columns."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A model or vocabulary file of at most this size is broadcast; a longer one is an error.
MAX_FILE_BYTES = 64 << 20
# Texts are worked on in slices of about this many bytes, or one text if that is longer.
SLICE_BYTES = 1 << 20
# Strings a worker remembers that it met once, and in all: some 60 MB.
ONCE_ENTRIES, MEMO_ENTRIES = 80_000, 240_000

# The object that this worker process keeps between tasks, under its key.
_state: dict = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary_path(name: str) -> str:
    """Where the installed public vocabularies keep a file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def ship_file(spark: SparkSession, path: str):
    """The bytes of a small file as a broadcast, so that executors need no such path."""
    if "://" in path:
        row = spark.read.format("binaryFile").load(path).select("length", "content")
        size, content = row.where(F.col("length") <= MAX_FILE_BYTES).first() or (None, None)
    else:
        size, content = os.path.getsize(path), None
    if size is None or size > MAX_FILE_BYTES:
        raise ValueError(f"{path} is missing or longer than {MAX_FILE_BYTES} bytes")
    if content is None:
        with open(path, "rb") as file:
            content = file.read()
    return spark.sparkContext.broadcast(bytes(content))


def worker_state(key, make):
    """``make()`` once per worker process and key. A worker keeps the object of one key: that
    of another operator, or of other settings, takes its place."""
    if key not in _state:
        _state.clear()
        _state[key] = make()
    return _state[key]


def slices(batch, text: str, size: int = SLICE_BYTES):
    """Cut an Arrow batch into runs of rows whose texts together have about ``size`` bytes."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    column = batch.column(batch.schema.get_field_index(text))
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False))
    first = 0
    while first < len(ends):
        before = ends[first - 1] if first else 0
        last = max(int(np.searchsorted(ends, before + size, side="right")), first + 1)
        yield batch.slice(first, last - first)
        first = last
    if not len(ends):
        yield pa.RecordBatch.from_arrays(batch.columns, schema=batch.schema)


def whole_slices(batches, text: str, size: int):
    """Arrow batches joined and cut into runs of rows with about ``size`` bytes of text."""
    import pyarrow as pa
    import pyarrow.compute as pc

    held, bytes_held = [], 0
    for batch in batches:
        for part in slices(batch, text, size):
            column = part.column(part.schema.get_field_index(text))
            held.append(part)
            bytes_held += pc.sum(pc.binary_length(column)).as_py() or 0
            if bytes_held >= size:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, bytes_held = [], 0
    held = [part for part in held if part.num_rows]
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def folding(df: DataFrame):
    """How names of columns are compared: as they are, or in lower case, as the session does."""
    sensitive = df.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    return (lambda name: name) if sensitive else str.lower


def without(df: DataFrame, names) -> list[str]:
    """The columns of ``df`` but for those that Spark takes for one of ``names``."""
    fold = folding(df)
    taken = {fold(n) for n in names}
    return [c for c in df.columns if fold(c) not in taken]


def quoted(names) -> list[str]:
    """Names as Spark reads them whole, dots included."""
    return ["`" + n.replace("`", "``") + "`" for n in names]


class Aside:
    """A table whose columns do not clash with names that an operator uses for itself.

    ``df`` has the given table's columns, those that clash under other names; ``name`` tells
    how a column is called there, and ``back`` gives a result the old names again.
    """

    def __init__(self, df: DataFrame, internal):
        fold = folding(df)
        taken = {fold(n) for n in internal}
        clash = [c for c in df.columns if fold(c) in taken]
        self.renamed = {c: f"aside_{i}_{uuid.uuid4().hex}" for i, c in enumerate(clash)}
        self.df = df.toDF(*map(self.name, df.columns)) if clash else df

    def name(self, column: str) -> str:
        return self.renamed.get(column, column)

    def back(self, df: DataFrame) -> DataFrame:
        old = {new: c for c, new in self.renamed.items()}
        return df.toDF(*(old.get(c, c) for c in df.columns)) if old else df


def with_text_columns(df: DataFrame, text: str, fields: T.StructType, make) -> DataFrame:
    """``df`` with columns that ``make(list of str)`` derives from a text column.

    ``make`` returns one list or Arrow array per field. A null text is given to it as an
    empty one. A field that has the name of an earlier column, as Spark compares names,
    replaces it. Rows do not move: there is no shuffle.
    """
    kept = without(df, fields.names)
    source = df.select(*quoted(kept), *([F.col(text)] if text not in kept else []))
    shape = T.StructType([source.schema[c] for c in kept] + list(fields.fields))

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(shape)
        for batch in batches:
            for part in slices(batch, text):
                column = part.column(part.schema.get_field_index(text))
                made = make([x or "" for x in column.to_pylist()])
                arrays = [part.column(part.schema.get_field_index(c)) for c in kept]
                for array, field in zip(made, list(schema)[len(kept) :]):
                    arrays.append(
                        array if isinstance(array, pa.Array) else pa.array(array, field.type)
                    )
                yield pa.RecordBatch.from_arrays(
                    [a.cast(f.type) for a, f in zip(arrays, schema)], schema=schema
                )

    return source.mapInArrow(run, shape)


class Memo:
    """Values by string, computed for many strings at once. Strings that were wanted once
    are forgotten first, so that a long tail does not push out the frequent ones.

    Only speed depends on what is remembered.
    """

    def __init__(self, compute, once: int = ONCE_ENTRIES, entries: int = MEMO_ENTRIES):
        self.compute, self.most_once, self.entries = compute, once, entries
        self.known, self.once = {}, set()

    def fill(self, wanted: set) -> dict:
        """Know at least ``wanted``."""
        missing = wanted - self.known.keys()
        self.once -= wanted
        if len(self.once) + len(missing) > self.most_once:
            for key in self.once:
                del self.known[key]
            self.once = set()
        if len(self.known) + len(missing) > self.entries:
            self.known, self.once = {k: self.known[k] for k in wanted - missing}, set()
        if missing:
            listed = list(missing)
            self.known.update(zip(listed, self.compute(listed)))
            self.once |= missing
        return self.known
