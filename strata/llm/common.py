"""Vectorised text primitives and Spark helpers shared by this subpackage.

Texts are handled as UTF-8 bytes inside Arrow batches: every separator the
operators use is an ASCII byte, so byte masks find the same words as a
regular expression over code points. A null text counts as an empty one.

Word and shingle identities are 64-bit fingerprints. Two different words of a
corpus share one with a probability of about v**2 / 2**65 for v distinct
words, which is 1e-6 for five million.
"""
from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Callable, Iterator
from contextvars import ContextVar
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import scratch_path, session_conf

#: Bytes of text worked on at once inside a task (a longer text is taken alone).
SLICE_BYTES = 4 << 20
#: Bytes of rows in one Arrow batch: executor and worker each hold whole batches, outside the heap.
BATCH_BYTES = 8 << 20

SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
#: Everything but ASCII letters, digits and bytes of non-ASCII characters.
NON_ALNUM = np.ones(256, bool)
NON_ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
_LONG_WORD = 64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _M2
        x = (x ^ (x >> np.uint64(27))) * _M3
        return x ^ (x >> np.uint64(31))


def salted(x: np.ndarray, salt: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(x + np.uint64((salt * 0x9E3779B97F4A7C15) & (2**64 - 1)))


@dataclass
class Texts:
    """The texts of some rows as one byte buffer."""

    buf: np.ndarray  # uint8
    offsets: np.ndarray  # int64, rows + 1

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def lower(self) -> Texts:
        return Texts(LOWER[self.buf], self.offsets)

    def raw(self, i: int) -> bytes:
        return self.buf[self.offsets[i] : self.offsets[i + 1]].tobytes()


def texts_of(column: pa.Array) -> Texts:
    """The buffer behind a string column; nulls become empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return Texts(buf[offsets[0] : offsets[-1]], offsets - offsets[0])


def give_back_memory() -> None:
    """Workers live on after a task; what Arrow's pool and the C heap keep of a
    batch that is done would add up over the stages of a job."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def slices(batch: pa.RecordBatch, text_col: str = "text", limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Cut a batch by bytes of text, whole rows only."""
    whole = texts_of(batch.column(text_col))
    at = 0
    while at < batch.num_rows:
        end = int(np.searchsorted(whole.offsets, whole.offsets[at] + limit, "right")) - 1
        end = min(max(end, at + 1), batch.num_rows)
        lo, hi = whole.offsets[at], whole.offsets[end]
        yield batch.slice(at, end - at), Texts(whole.buf[lo:hi], whole.offsets[at : end + 1] - lo)
        at = end
    del whole
    give_back_memory()


@dataclass
class Words:
    starts: np.ndarray  # byte offsets in the buffer
    ends: np.ndarray
    counts: np.ndarray  # words of each row
    first: np.ndarray  # index of each row's first word, rows + 1

    @property
    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)


def words_of(texts: Texts, separators: np.ndarray = SPACES) -> Words:
    """Maximal runs of bytes that are no separators, within each row."""
    inside = np.concatenate([~separators[texts.buf], [False]])
    before = np.concatenate([[False], inside[:-1]])
    before[texts.offsets] = False
    after = np.concatenate([inside[1:], [False]])
    ends_at = texts.offsets[1:][np.diff(texts.offsets) > 0] - 1
    after[ends_at] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    first = np.searchsorted(starts, texts.offsets)
    return Words(starts, ends, np.diff(first), first)


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit fingerprint of each span's bytes, the same on every machine."""
    padded = np.concatenate([buf, np.zeros(8, np.uint8)])
    eights = np.ndarray((len(padded) - 7,), np.uint64, padded, 0, (1,))
    lens = ends - starts
    out = lens.astype(np.uint64) * _M1
    live, at, left = np.arange(len(starts)), starts, lens
    if len(lens) and lens.max() > _LONG_WORD:
        for i in np.flatnonzero(lens > _LONG_WORD):
            out[i] = int.from_bytes(hashlib.blake2b(buf[starts[i] : ends[i]].tobytes(), digest_size=8).digest(), "little")
        live = np.flatnonzero(lens <= _LONG_WORD)
        at, left = starts[live], lens[live]
    with np.errstate(over="ignore"):
        while len(live):
            piece = eights[at]
            short = np.minimum(left, 8).astype(np.uint64)
            piece = piece & (~np.uint64(0) >> (np.uint64(64) - np.uint64(8) * short))
            h = (out[live] ^ piece) * _M1
            out[live] = h ^ (h >> np.uint64(29))
            more = left > 8
            live, at, left = live[more], at[more] + 8, left[more] - 8
    return mix(out)


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """A fingerprint of every ``width`` consecutive hashes (row borders ignored)."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        out = hashes[:n] * _M1
        for k in range(1, width):
            out = (out ^ (out >> np.uint64(32))) * _M2 + hashes[k : k + n] * _M1
    return mix(out)


def shingles_of(texts: Texts, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(rows, hashes) of every word shingle of lower-cased texts, with repeats,
    in text order. A row of fewer words has its whole sequence as one shingle;
    a row without words has none."""
    words = words_of(texts)
    hashes = span_hashes(texts.buf, words.starts, words.ends)
    rows = words.rows
    whole = window_hashes(hashes, width)
    fits = rows[: len(whole)] == rows[width - 1 :] if len(whole) else np.zeros(0, bool)
    out_rows, out = rows[: len(whole)][fits], whole[fits]
    few = np.flatnonzero((words.counts > 0) & (words.counts < width))
    if len(few):
        short = np.zeros(len(few), np.uint64)
        for i, r in enumerate(few):
            h = hashes[words.first[r] : words.first[r + 1]]
            short[i] = salted(window_hashes(h, len(h)), len(h))[0]
        out_rows, out = np.concatenate([out_rows, few]), np.concatenate([out, short])
        order = np.argsort(out_rows, kind="stable")
        out_rows, out = out_rows[order], out[order]
    return out_rows, out


def distinct_per_row(rows: np.ndarray, hashes: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Each row's distinct hashes in ascending order, and their offsets."""
    order = np.lexsort((hashes, rows))
    rows, hashes = rows[order], hashes[order]
    keep = np.ones(len(rows), bool)
    keep[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    rows, hashes = rows[keep], hashes[keep]
    return hashes, np.searchsorted(rows, np.arange(n_rows + 1))


def text_rows(docs: DataFrame, *columns: str) -> DataFrame:
    """doc_id, text and the named columns only: extra columns never matter."""
    return docs.select("doc_id", "text", *columns)


def map_slices(fn: Callable[[pa.RecordBatch, Texts], pa.RecordBatch | None]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Apply ``fn`` to byte-bounded slices of the batches of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch):
                out = fn(part, texts)
                if out is not None and out.num_rows:
                    yield out

    return run


_MADE: ContextVar[list[str] | None] = ContextVar("made", default=None)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared scratch folder and read back: cuts the lineage with
    files that survive lost executors. Once they are written the shuffles on
    the way are of no use, and Spark removes their files."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with session_conf(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):
        df.write.parquet(path)
    if (made := _MADE.get()) is not None:
        made.append(path)
    return spark.read.schema(df.schema).parquet(path)


def delete_folder(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def staged_alone(spark: SparkSession, build: Callable[[], DataFrame], name: str) -> tuple[DataFrame, str]:
    """``staged`` for what ``build`` returns, and its folder. Folders that were
    staged on the way there are deleted once the result is written: it reads
    none of them."""
    made: list[str] = []
    token = _MADE.set(made)
    try:
        out = staged(build(), name)
    finally:
        _MADE.reset(token)
    for path in made[:-1]:
        delete_folder(spark, path)
    if (outer := _MADE.get()) is not None:
        outer.append(made[-1])
    return out, made[-1]


def unused_name(df: DataFrame, name: str) -> str:
    """``name``, or one like it that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def small_batches(spark: SparkSession) -> None:
    """From now on workers get rows in Arrow batches of at most ``BATCH_BYTES``
    (by Spark's default 64 MB), or a row alone; a size that was set is kept."""
    if spark.conf.get(key := "spark.sql.execution.arrow.maxBytesPerBatch", None) is None:
        spark.conf.set(key, str(BATCH_BYTES))


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def bounded_sample(df: DataFrame, k: int, total: int, key: str = "doc_id") -> DataFrame:
    """The ``k`` rows with the smallest hash of ``key``, whatever the layout.

    A hash threshold first thins a large table to about ``4 k`` rows, so the
    final ordering never sees more than that.
    """
    h = F.xxhash64(F.col(key).cast("string"))
    grain = 1 << 30
    if total > 4 * k:
        df = df.where(F.pmod(h, F.lit(grain)) < F.lit(max(1, (4 * k * grain) // total)))
    return df.orderBy(h, F.col(key)).limit(k)


def crc_mod(key: str, n: int) -> F.Column:
    """crc32 of the key as text, modulo ``n`` (a null key counts as '')."""
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), F.lit(n))
