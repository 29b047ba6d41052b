"""Shared pieces of the operators: Arrow text buffers, scratch tables and keyed exchange of packed rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from firmament.session import new_folder

SLICE_BYTES = 1 << 19  # text bytes that one vectorised step works on; arrays of up to 50 times as much
SLICE_ROWS = 4096
PART_ROWS = 512  # rows whose new columns are made at a time


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    """Partitions of an exchange, as the session sets them."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def keep(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends, executors may be lost."""
    folder = new_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def id_crc32(doc_id: str = "doc_id") -> Column:
    """CRC-32 of the id as text."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary"))


def fresh(name: str, taken: list[str]) -> str:
    """The name, or the name with underscores where the table has such a column already."""
    lower = {t.lower() for t in taken}
    while name.lower() in lower:
        name += "_"
    return name


def unpack(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string or binary column and the n + 1 offsets of its rows; null counts as empty."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if pa.types.is_string(array.type) or pa.types.is_large_string(array.type):
        array = array.cast(pa.large_string())
        if array.null_count:
            array = pc.fill_null(array, "")
    else:
        array = array.cast(pa.large_binary())
        if array.null_count:
            array = pc.fill_null(array, b"")
    if len(array) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offset_buffer, data_buffer = array.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64)[array.offset : array.offset + len(array) + 1]
    data = np.frombuffer(data_buffer, np.uint8) if data_buffer is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, size: int = SLICE_BYTES, rows: int = SLICE_ROWS) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts hold about ``size`` bytes; a longer text is a range of its own."""
    start, n = 0, len(offsets) - 1
    while start < n:
        end = int(np.searchsorted(offsets, offsets[start] + size, side="right")) - 1
        end = min(max(end, start + 1), start + rows, n)
        yield start, end
        start = end


def text_slices(array: pa.Array, size: int = SLICE_BYTES, rows: int = SLICE_ROWS):
    """(first row, end row, bytes, offsets) of every slice of a text column."""
    data, offsets = unpack(array)
    for start, end in slices(offsets, size, rows):
        yield start, end, data[offsets[start] : offsets[end]], offsets[start : end + 1] - offsets[start]


def binary_rows(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A binary column out of bytes and offsets."""
    return pa.Array.from_buffers(
        pa.large_binary(), len(offsets) - 1,
        [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(data))],
    ).cast(pa.binary())


def append(df: DataFrame, text: str, fields: list[tuple[str, T.DataType]],
           start: Callable[[], Callable[[pa.Array], list[pa.Array]]]) -> tuple[DataFrame, list[str]]:
    """Add columns computed from the texts, row by row and without a shuffle.

    ``start`` runs once per task and returns the function from a text column to the new
    columns.  Returns the frame and the names given, which differ from those asked for
    where the frame has such columns already.
    """
    names: list[str] = []
    for name, _ in fields:
        names.append(fresh(name, df.columns + names))
    schema = T.StructType(df.schema.fields + [T.StructField(n, f[1]) for n, f in zip(names, fields, strict=True)])
    place = [c.lower() for c in df.columns].index(text.lower())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            for first in range(0, batch.num_rows, PART_ROWS):
                part = batch.slice(first, PART_ROWS)
                yield pa.RecordBatch.from_arrays([*part.columns, *work(part.column(place))], names=[*part.schema.names, *names])

    return df.mapInArrow(run, schema), names


def packed_schema(dtype: np.dtype) -> str:
    """Columns of packed rows: a bucket and, for every field, the values of all its records."""
    return ", ".join(["bucket int", *(f"{name} binary" for name in dtype.names)])


def packed(entries: np.ndarray, bucket: np.ndarray, buckets: int) -> pa.RecordBatch:
    """One row per bucket with the records of a structured array that belong to it."""
    order = np.argsort(bucket, kind="stable")
    sizes = np.bincount(bucket.astype(np.int64), minlength=buckets)
    used = np.flatnonzero(sizes)
    bounds = np.concatenate([[0], np.cumsum(sizes[used])])
    columns = [pa.array(used.astype(np.int32))]
    for name in entries.dtype.names:
        field = np.ascontiguousarray(entries[name][order])
        columns.append(binary_rows(field.view(np.uint8).reshape(-1), bounds * field.dtype.itemsize))
    return pa.RecordBatch.from_arrays(columns, names=["bucket", *entries.dtype.names])


def exchange(df: DataFrame, count: int) -> DataFrame:
    """Bring packed rows of one bucket into one partition."""
    return df.repartition(count, "bucket")


def records(batches, dtype: np.dtype) -> np.ndarray:
    """All records of the packed rows of some batches or tables."""
    parts = []
    for batch in batches:
        part = None
        for name in dtype.names:
            data, _ = unpack(batch.column(batch.schema.get_field_index(name)))
            field = np.frombuffer(data.tobytes(), dtype[name])
            if part is None:
                part = np.empty(len(field), dtype)
            part[name] = field
        parts.append(part)
    return np.concatenate(parts) if parts else np.empty(0, dtype)


def mix(value: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit words (a finaliser with full avalanche)."""
    with np.errstate(over="ignore"):
        value = value.astype(np.uint64, copy=True)
        value ^= value >> np.uint64(30)
        value *= np.uint64(0xBF58476D1CE4E5B9)
        value ^= value >> np.uint64(27)
        value *= np.uint64(0x94D049BB133111EB)
        value ^= value >> np.uint64(31)
    return value


WEIGHTS = mix(np.arange(1, 4097, dtype=np.uint64)) | np.uint64(1)  # odd factors by place in a word
SYMBOLS = mix(np.arange(4097, 4353, dtype=np.uint64))  # a random word for every byte value
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document of every run of non-blank bytes; runs end where documents end."""
    solid = ~BLANK[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    edges = offsets[1:-1]
    edges = edges[edges < len(data)]
    first[edges] = solid[edges]
    last = solid.copy()
    last[:-1] &= ~solid[1:] | first[1:]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every run of bytes; runs are disjoint and in order."""
    if not len(starts):
        return np.empty(0, np.uint64)
    lengths = ends - starts
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    place = np.arange(total) - np.repeat(before, lengths)
    chosen = data[place + np.repeat(starts, lengths)]
    with np.errstate(over="ignore"):
        value = SYMBOLS[chosen] * WEIGHTS[place & 4095]
        value += (place >> 12).astype(np.uint64) * SYMBOLS[chosen] if int(lengths.max()) > 4096 else np.uint64(0)
        return mix(np.add.reduceat(value, before) + lengths.astype(np.uint64))
