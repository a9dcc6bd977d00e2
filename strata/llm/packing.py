"""Packing: concatenate and cut, by two-pass prefix sums.

First pass: every task tokenises its documents and writes their ids with the
running total inside the task. Second pass: the totals of the tasks (one row
each) are summed up to global offsets, and each document's range of the one
long stream is cut at the multiples of the sequence length. A document that
crosses such a border has one boundary record on each side of it. Only the
last sequence is not full.

Defined results: a null or empty text is one end id; repeated rows are packed
each; an empty table gives no pieces. The order of the stream is that of the
written files, so it is fixed once the first pass is done. The last sequence
is padded to the full length by whoever reads the pieces, unless what it holds
is a power of two long.
"""
from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.llm.common import give_back_memory, load, slices, small_batches, staged, text_rows
from strata.llm.tokens import TEXT_BYTES, Encoder, ids_column, tokenizer_path, with_end

SEQUENCE = 2048
END = 1

_TOKENS = "part int, local long, doc_id long, n long, ids binary"
_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _tokenise(path: str, end: int):
    def run(batches):
        part, local, encoder = TaskContext.get().partitionId(), 0, Encoder(path)
        for batch in batches:
            for rows, texts in slices(batch, limit=TEXT_BYTES):
                ids, offsets = with_end(*encoder.encode(texts), end)
                n = np.diff(offsets)
                yield pa.record_batch(
                    {"part": np.full(len(n), part, np.int32), "local": local + offsets[:-1], "doc_id": rows.column("doc_id"), "n": n, "ids": ids_column(ids, offsets)}
                )
                local += int(offsets[-1])
        del encoder
        give_back_memory()

    return run


def token_stream(docs: DataFrame, path: str | None = None, end: int = END) -> DataFrame:
    """(doc_id, n, ids, at): each document's ids and its place in the stream of
    all ids. The stream is written once; places come from the tasks' totals."""
    tokens = staged(text_rows(docs).mapInArrow(_tokenise(path or tokenizer_path(), end), _TOKENS), "tokens")
    return placed(tokens)


def placed(tokens: DataFrame) -> DataFrame:
    """Add ``at``: the ids of all earlier parts plus those before in the part."""
    totals = tokens.groupBy("part").agg(F.sum("n").alias("total"))  # a row for each task of the first pass
    before = F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    totals = totals.select("part", F.coalesce(before, F.lit(0)).alias("base"))
    # one row of 12 bytes for each task of the first pass
    return tokens.join(F.broadcast(totals), "part").withColumn("at", F.col("base") + F.col("local"))


def _cut(length: int):
    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            at, n = b.column("at").to_numpy(), b.column("n").to_numpy()
            pieces = (at + n - 1) // length - at // length + 1
            row = np.repeat(np.arange(len(at)), pieces)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            sequence = at[row] // length + nth
            begin = np.maximum(sequence * length, at[row])
            stop = np.minimum((sequence + 1) * length, at[row] + n[row])
            start = begin - at[row]
            ids = [memoryview(v.as_buffer()) for v in b.column("ids")]
            crc = [zlib.crc32(ids[r][4 * s : 4 * (s + k)]) for r, s, k in zip(row.tolist(), start.tolist(), (stop - begin).tolist(), strict=True)]
            yield pa.record_batch(
                {
                    "doc_id": b.column("doc_id").take(pa.array(row)), "start": start, "length": stop - begin, "ids_crc32": pa.array(crc, pa.int64()),
                    "doc_tokens": n[row], "sequence_id": sequence, "offset": begin - sequence * length,
                }
            )

    return run


def pack(docs: DataFrame, path: str | None = None, length: int = SEQUENCE, end: int = END) -> DataFrame:
    """One row for each piece of a document in a sequence of ``length`` ids."""
    small_batches(docs.sparkSession)
    return token_stream(docs, path, end).select("doc_id", "n", "at", "ids").mapInArrow(_cut(length), _PIECES)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(load(spark, sf_dir, "documents"))
