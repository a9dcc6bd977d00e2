"""Token-ID output: bit- or byte-plane shuffled, zstandard-compressed chunks.

The ids of all documents, in ascending doc_id order, are dealt to shards (one
range of doc_id each) and there cut into chunks of ``CHUNK`` ids. A chunk is
transposed: all ids' lowest bytes (or bits) first, then the next ones. Each
plane is compressed by itself; a plane of one repeated value takes a few bytes.

A data set is two folders of Parquet files, so that any store that Spark reads
will do and Spark's own commit decides which attempt counts:

* ``kind=c``, chunks: shard, nth (chunk), n (ids), sizes (bytes of each plane), crc32 of
  the ids, payload (the planes end to end). shard, nth and sizes are the index:
  a reader finds the chunks of an id range without opening a payload.
* ``kind=d``, documents: shard, nth (order in the shard), doc_id, local (ids before it in the shard), n.

Reading brings a shard's chunks and documents together in order and checks each chunk's crc32.

Defined results: a null or empty text is one end id; rows of equal doc_id each
have their own, in the order of their texts; rows without a doc_id come first;
an empty table writes empty folders and reads back no rows.
"""
from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.llm.common import load, slices, text_rows
from strata.llm.tokens import TEXT_BYTES, Encoder, tokenizer_path, with_end
from strata.session import scratch_path

CHUNK = 1 << 16
END = 0
LEVEL = 3

_FILE = "kind string, shard int, nth long, n long, doc_id long, local long, sizes array<int>, crc32 long, payload binary"


def shuffle_planes(ids: np.ndarray, bits: bool = False) -> list[bytes]:
    """The planes of 32-bit ids: four byte planes, or 32 bit planes, lowest first."""
    parts = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if not bits:
        return [parts[:, k].tobytes() for k in range(4)]
    return [np.packbits(row).tobytes() for row in np.unpackbits(parts, axis=1, bitorder="little").T]


def join_planes(planes: list[bytes], n: int) -> np.ndarray:
    """The inverse of ``shuffle_planes``."""
    if len(planes) == 4:
        parts = np.column_stack([np.frombuffer(p, np.uint8) for p in planes])
    else:
        rows = np.array([np.unpackbits(np.frombuffer(p, np.uint8))[:n] for p in planes], np.uint8).reshape(32, n)
        parts = np.packbits(rows.T, axis=1, bitorder="little")
    return np.ascontiguousarray(parts).view("<u4").ravel()


def encode_chunk(ids: np.ndarray, bits: bool = False, level: int = LEVEL) -> tuple[list[int], int, bytes]:
    """(compressed size of each plane, crc32 of the ids, payload)."""
    packer = zstandard.ZstdCompressor(level=level)
    planes = [packer.compress(p) for p in shuffle_planes(ids, bits)]
    return [len(p) for p in planes], zlib.crc32(np.ascontiguousarray(ids, "<u4")), b"".join(planes)


def decode_chunk(sizes: list[int], crc: int, payload: bytes, n: int) -> np.ndarray:
    """The ids of a chunk; a damaged one raises."""
    edges = np.concatenate([[0], np.cumsum(sizes)])
    reader = zstandard.ZstdDecompressor()
    ids = join_planes([reader.decompress(payload[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)], n)
    if zlib.crc32(ids) != crc or len(ids) != n:
        raise ValueError("chunk does not match its crc32")
    return ids


def _write_shard(path: str, end: int, chunk: int, bits: bool):
    def rows(**cols):
        n = len(next(iter(cols.values())))
        types = {"kind": pa.string(), "shard": pa.int32(), "nth": pa.int64(), "n": pa.int64(), "doc_id": pa.int64(), "local": pa.int64(), "sizes": pa.list_(pa.int32()), "crc32": pa.int64(), "payload": pa.binary()}
        return pa.record_batch({k: cols[k] if isinstance(cols.get(k), pa.Array) else pa.array(cols[k], t) if k in cols else pa.nulls(n, t) for k, t in types.items()})

    def run(batches):
        shard, encoder = TaskContext.get().partitionId(), Encoder(path)
        waiting, local, nth, chunks = np.zeros(0, np.uint32), 0, 0, 0
        for batch in batches:
            for part, texts in slices(batch, limit=TEXT_BYTES):
                ids, offsets = with_end(*encoder.encode(texts), end)
                n = len(texts)
                yield rows(kind=["d"] * n, shard=[shard] * n, nth=np.arange(nth, nth + n), n=np.diff(offsets), doc_id=part.column("doc_id"), local=local + offsets[:-1])
                nth, local = nth + n, local + int(offsets[-1])
                waiting = np.concatenate([waiting, ids])
                while len(waiting) >= chunk:
                    sizes, crc, payload = encode_chunk(waiting[:chunk], bits)
                    yield rows(kind=["c"], shard=[shard], nth=[chunks], n=[chunk], sizes=[sizes], crc32=[crc], payload=[payload])
                    waiting, chunks = waiting[chunk:], chunks + 1
        if len(waiting):
            sizes, crc, payload = encode_chunk(waiting, bits)
            yield rows(kind=["c"], shard=[shard], nth=[chunks], n=[len(waiting)], sizes=[sizes], crc32=[crc], payload=[payload])

    return run


def write_ids(docs: DataFrame, folder: str, path: str | None = None, end: int = END, chunk: int = CHUNK, bits: bool = False) -> None:
    """Write the ids of all documents in ascending doc_id order."""
    ordered = text_rows(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    rows = ordered.mapInArrow(_write_shard(path or tokenizer_path(), end, chunk, bits), _FILE)
    rows.write.partitionBy("kind").parquet(folder)


def _read_shard(chunk: int):
    """A shard's rows come sorted: each chunk, then the documents that end in it."""

    def run(batches):
        shard, waiting, begin = None, np.zeros(0, np.uint32), 0  # ids from ``begin`` on
        for b in batches:
            out = []
            for r in b.to_pylist():
                if r["shard"] != shard:
                    shard, waiting, begin = r["shard"], np.zeros(0, np.uint32), 0
                if r["kind"] == "c":
                    waiting = np.concatenate([waiting, decode_chunk(r["sizes"], r["crc32"], r["payload"], r["n"])])
                else:
                    a = r["local"] - begin
                    out.append((r["shard"], r["doc_id"], r["local"], r["n"], zlib.crc32(waiting[a : a + r["n"]])))
                    waiting, begin = waiting[a + r["n"] :], r["local"] + r["n"]
            if out:
                yield pa.record_batch(dict(zip(("shard", "doc_id", "local", "n", "crc"), map(list, zip(*out, strict=True)), strict=True)), pa.schema([("shard", pa.int32()), ("doc_id", pa.int64()), ("local", pa.int64()), ("n", pa.int64()), ("crc", pa.int64())]))

    return run


def read_ids(spark: SparkSession, folder: str, chunk: int = CHUNK) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    found = spark.read.schema(_FILE).parquet(folder)
    totals = found.where("kind = 'c'").groupBy("shard").agg(F.sum("n").alias("total"))  # a row for each shard
    before = F.sum("total").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    totals = totals.select("shard", F.coalesce(before, F.lit(0)).alias("base"))
    # a document is read after the chunk that holds its last id
    due = F.when(F.col("kind") == "c", F.col("nth")).otherwise(F.floor((F.col("local") + F.col("n") - 1) / chunk))
    kind = F.when(F.col("kind") == "c", 0).otherwise(1)
    rows = found.repartition("shard").sortWithinPartitions("shard", due, kind, "nth")
    read = rows.mapInArrow(_read_shard(chunk), "shard int, doc_id long, local long, n long, crc long")
    return read.join(totals, "shard").select("doc_id", (F.col("base") + F.col("local")).alias("start"), F.col("n").alias("n_tokens"), F.col("crc").alias("ids_crc32"))


def op7_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "op7-ids")
    write_ids(load(spark, sf_dir, "documents"), folder)
    return read_ids(spark, folder)
