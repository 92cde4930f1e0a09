"""Helpers shared by the training-data operators: tables, row keys, byte-level words, and their hashes."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fleetstate.operators.scan import checkpointed

#: Bytes of text handled at once inside a task. A longer text is handled alone, whole.
CHUNK_BYTES = 1 << 21
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}
U64 = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def settle(df: DataFrame) -> DataFrame:
    """Write an intermediate result to the shared folder and go on from there: it is computed once and its lineage ends.

    The folder is the session's spark.checkpoint.dir; where none is set (a test, a local run) the warehouse serves. On a
    cluster a folder of the local file system is refused.
    """
    return checkpointed(df)


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text falls into `fold`. A null id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def first_by_hash(rows: DataFrame, by: str, sizes: dict, most: int) -> DataFrame:
    """At most `most` rows for each value of `by`, those of least hash of doc_id, with their number `nth` from 1.

    `sizes` has the number of rows of each value. Only rows whose hash is under the bound that about one and a half times
    `most` rows keep are sorted, so that a window sees a bounded number of rows however many there are.
    """
    share = F.lit(1.0)
    for value, n in sizes.items():
        share = F.when(F.col(by) == value, kept_share(n, most)).otherwise(share)
    return first_under(rows, by, share, most)


def kept_share(n: int, most: int) -> float:
    """The share of hashes that about one and a half times `most` of n rows keep."""
    return min(1.0, 1.5 * most / max(n, 1) + 1000 / max(n, 1))


def first_under(rows: DataFrame, by: str, share: Column, most: int) -> DataFrame:
    """As `first_by_hash`, with the share of hashes to sort as a column, for values too many to be listed in one."""
    place = F.xxhash64(F.lit(by), "doc_id")
    under = F.pmod(place, F.lit(1 << 30)) < share * float(1 << 30)
    order = Window.partitionBy(by).orderBy(F.pmod(place, F.lit(1 << 30)), "doc_id")
    return rows.filter(under).withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= most)


def schema_with(rows: DataFrame, without: tuple[str, ...], more: str) -> StructType:
    """The fields of `rows` but some, and those of a DDL string."""
    return StructType([f for f in rows.schema if f.name not in without] + StructType.fromDDL(more).fields)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit values (a bijection)."""
    x = x ^ (x >> U64(31))
    x = x * U64(0x7FB5D329728EA185)
    x = x ^ (x >> U64(27))
    x = x * U64(0x81DADEF4BC2DD44D)
    return x ^ (x >> U64(33))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, n of each at least."""
    have = _POWERS.get(0)
    if have is None or len(have[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        made = []
        for base in (_BASE, _INVERSE):
            x = np.full(size, base, dtype=U64)
            x[0] = 1
            made.append(np.multiply.accumulate(x))
        _POWERS[0] = have = (made[0], made[1])
    return have


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span data[start:end]; spans are in order of start and do not nest."""
    return prefix_hashes(data, starts, ends, (None,))[0]


def prefix_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, sizes: tuple[int | None, ...]) -> list[np.ndarray]:
    """As `span_hashes`, of the first `size` bytes of each span (None: of all), for each of `sizes`."""
    out = [np.empty(len(starts), dtype=U64) for _ in sizes]
    lo = 0
    while lo < len(starts):
        base = int(starts[lo])
        hi = max(lo + 1, int(np.searchsorted(ends, base + CHUNK_BYTES, side="right")))
        segment = data[base : int(ends[hi - 1])]
        power, inverse = _powers(len(segment) + 1)
        sums = np.zeros(len(segment) + 1, dtype=U64)
        np.cumsum((segment.astype(U64) + U64(1)) * power[: len(segment)], out=sums[1:])
        a, b = starts[lo:hi] - base, ends[lo:hi] - base
        for hashes, size in zip(out, sizes):
            stop = b if size is None else np.minimum(b, a + size)
            hashes[lo:hi] = mix((sums[stop] - sums[a]) * inverse[a])
        lo = hi
    return out


def byte_table(is_word) -> np.ndarray:
    """256 booleans: which bytes belong to words."""
    return np.array([bool(is_word(b)) for b in range(256)])


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Words between ASCII white space.
SPACED = byte_table(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
#: Words of ASCII digits, ASCII lower-case letters and everything beyond ASCII.
ALNUM = byte_table(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)


def released(batches: Iterator[pa.RecordBatch], work: Callable, **more) -> Iterator[pa.RecordBatch]:
    """What `work` yields; then the memory that it has freed goes back to the machine. Workers outlive their tasks, and would keep
    it beside the next stage."""
    yield from work(batches, **more)
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


class Chunk:
    """Some whole texts of a batch as one run of bytes. `rows` are their places in the batch."""

    def __init__(self, rows: slice, data: np.ndarray, bounds: np.ndarray):
        self.rows, self.data, self.bounds = rows, data, bounds

    def words(self, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of all words, and for each text the number of words before it (one more at the end)."""
        inside = table[self.data]
        before = np.empty_like(inside)
        before[1:] = inside[:-1]
        edges = self.bounds[:-1]
        before[edges[edges < len(inside)]] = False
        starts = np.flatnonzero(inside & ~before)
        after = np.empty_like(inside)
        after[:-1] = inside[1:]
        if len(after):
            after[self.bounds[1:][self.bounds[1:] > 0] - 1] = False
        ends = np.flatnonzero(inside & ~after) + 1
        return starts, ends, np.searchsorted(starts, self.bounds)


def chunks(texts: pa.Array, lower: bool = True, most: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """The texts of a batch in chunks of about `most` bytes, whole texts each; null counts as empty."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    body = texts.buffers()[2]
    data = np.frombuffer(body, dtype=np.uint8) if body is not None else np.empty(0, dtype=np.uint8)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, side="right")) - 1)
        part = data[offsets[lo] : offsets[hi]]
        yield Chunk(slice(lo, hi), LOWER[part] if lower else part, offsets[lo : hi + 1] - offsets[lo])
        lo = hi
