"""Words of whole texts as numpy arrays, straight from Arrow's buffers.

A word is a run of bytes other than ASCII white space (the six code points 9
to 13 and 32), so words and their hashes are found on the UTF-8 bytes of a
batch without a Python object per word or per text. Texts are taken in pieces
of about ``PIECE`` bytes (a longer text is a piece of its own), which bounds
the arrays of a task whatever its batch holds.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PIECE = 1 << 20
#: A word, as a Java and DuckDB pattern.
WORD = r"[^\x20\x09-\x0D]+"

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_MULTIPLIER = 0xD1342543DE82EF95  # odd, so that it has an inverse modulo 2**64


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def byte_values(stream: int = 0) -> np.ndarray:
    """A pseudo-random 64-bit value for each byte; streams are independent."""
    return mix((np.arange(1, 257, dtype=np.uint64) + np.uint64(1000 * stream)) * _GOLDEN)


class _Powers:
    """Powers of the multiplier and of its inverse, made once per worker."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            base = np.full(size, _MULTIPLIER, np.uint64)
            base[0] = 1
            self.up = np.multiply.accumulate(base)
            base[1:] = pow(_MULTIPLIER, -1, 1 << 64)
            self.down = np.multiply.accumulate(base)
        return self.up[:n], self.down[:n]


_powers = _Powers()


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A polynomial hash of values[start:end] for each span, in constant time
    per span by prefix sums; equal sequences hash alike wherever they lie."""
    up, down = _powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * _GOLDEN)


def sums_between(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of values between neighbouring bounds; empty ranges are 0."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


class Piece:
    """Some neighbouring texts of a batch: rows ``lo`` to ``hi``.

    data: their bytes; bounds: where each text starts, and the end of the last;
    starts, ends: the words; word_bounds: the first word of each text."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, lo: int, hi: int) -> None:
        self.data, self.bounds, self.lo, self.hi = data, bounds, lo, hi
        self.space = IS_SPACE[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[bounds] = True
        before = np.ones(len(data) + 1, bool)
        before[1:] = self.space
        after = np.ones(len(data) + 1, bool)
        after[:-1] = self.space
        self.starts = np.flatnonzero(~self.space & (before | edge)[:-1])
        self.ends = np.flatnonzero(~self.space & (after | edge)[1:]) + 1
        self.word_bounds = np.searchsorted(self.starts, bounds)
        self.n_words = np.diff(self.word_bounds)

    def word_docs(self) -> np.ndarray:
        """The text (from 0 within the piece) of each word."""
        return np.repeat(np.arange(len(self.n_words)), self.n_words)

    def word_hashes(self, table: np.ndarray | None = None) -> np.ndarray:
        values = (byte_values() if table is None else table)[self.data]
        return span_hashes(values, self.starts, self.ends)

    def window_hashes(self, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all windows of ``size`` words that lie in one text, and
        the index of their first words."""
        last = np.repeat(self.word_bounds[1:], self.n_words) - size
        first = np.flatnonzero(np.arange(len(hashes)) <= last)
        return span_hashes(hashes, first, first + size), first


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary column; null is empty."""
    column = column.fill_null(b"" if pa.types.is_binary(column.type) else "")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def spans_of(offsets: np.ndarray, limit: int = PIECE) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, hi
        lo = hi


def pieces(column: pa.Array, limit: int = PIECE) -> Iterator[Piece]:
    data, offsets = flat(column)
    for lo, hi in spans_of(offsets, limit):
        begin = offsets[lo]
        yield Piece(data[begin : offsets[hi]], offsets[lo : hi + 1] - begin, lo, hi)


def lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """A list column: the values, dealt out by the rows' counts."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def free(name: str, rows: DataFrame) -> str:
    """The name, or one like it that no column of the rows has."""
    taken = {column.lower() for column in rows.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def shielded(rows: DataFrame, names: Iterable[str], work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What ``work`` makes of the rows, whose columns of these names are renamed
    before and get their names back after; ``work`` keeps the columns."""
    named = {name.lower() for name in names}
    away = {column: free(f"_own_{column}", rows) for column in rows.columns if column.lower() in named}
    made = work(rows.withColumnsRenamed(away))
    return made.select(*(F.col(f"`{away.get(column, column)}`").alias(column) for column in rows.columns))


_libc: list = []


def give_back() -> None:
    """Returns freed memory to the system at a task's end: workers stay, and
    what each of them keeps adds up over the stages of a job."""
    pa.default_memory_pool().release_unused()
    if not _libc:
        try:
            _libc.append(ctypes.CDLL("libc.so.6").malloc_trim)
        except (OSError, AttributeError):  # another C library
            _libc.append(lambda _: 0)
    _libc[0](0)


def word_count(text):
    """Words of a text column as a built-in expression; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


#: Keys of a prefilter are hashed to so many bits: 2**18 rows of 64.
FILTER_BITS = 24


def maybe(rows: DataFrame, key: str, wanted: DataFrame, name: str) -> DataFrame:
    """Rows with a boolean ``name``: may they have a partner in a join on
    ``key``, a column of both sides? A cheap question before a join that would
    shuffle whole texts. The answers are in a bitmap of hashed keys; its size is
    fixed, so it is broadcast. With very many wanted keys it says yes to all
    rows, and the join decides as ever. A null key has no partner."""

    def hashed(column):
        return F.pmod(F.xxhash64(column), F.lit(1 << FILTER_BITS))

    hash_, word, bits = (free(own, rows) for own in ("_hash", "_word", "_bits"))
    bit = (F.col(hash_) % 64).cast("int")
    bitmap = (
        wanted.filter(F.col(key).isNotNull())
        .select(hashed(F.col(key)).alias("_hash"))
        .groupBy(F.floor(F.col("_hash") / 64).alias(word))
        .agg(F.expr("bit_or(shiftleft(1L, cast(_hash % 64 AS INT)))").alias(bits))
    )
    marked = rows.withColumn(hash_, hashed(F.col(key))).withColumn(word, F.floor(F.col(hash_) / 64))
    met = F.coalesce(F.getbit(bits, bit) == 1, F.lit(False)) & F.col(key).isNotNull()
    return marked.join(F.broadcast(bitmap), word, "left").select(*rows.columns, met.alias(name))


def likely(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """The rows that may have a partner (see ``maybe``)."""
    name = free("_likely", rows)
    return maybe(rows, key, wanted, name).filter(F.col(name)).drop(name)


def add_columns(
    rows: DataFrame, fields: str, compute: Callable[[pa.RecordBatch], dict[str, object]]
) -> DataFrame:
    """Rows with columns that ``compute`` makes from each Arrow batch. A column
    of the input that has the name of a new one is replaced."""
    added = T._parse_datatype_string(fields)
    names = [f.name for f in added]
    kept = [f for f in rows.schema if f.name not in names]
    schema = T.StructType([*kept, *added])
    inner = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                made = compute(batch)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(n) for n in inner), *(pa.array(made[n]) for n in names)],
                    names=[*inner, *names],
                )
                del batch, made
        give_back()

    return rows.mapInArrow(run, schema)
