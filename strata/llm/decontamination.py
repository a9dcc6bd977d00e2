"""Benchmark decontamination: size-partitioned MinHash containment search.

A short test item inside a long document has a tiny Jaccard similarity with
the whole document, so documents are first brought to comparable sizes: items
fall into size classes, and for each class a document is covered by windows of
twice the class's largest size, overlapping by half. A passage of an item lies
whole in one window, where a containment of ``threshold`` means a Jaccard
similarity of at least about a sixth, whatever the document's length.

Windows and items get a one-permutation MinHash signature (``SEEDS`` times
``BINS`` bins of word 5-shingles). One equal bin makes a pair a candidate. Items
of fewer than ``EXACT_BELOW`` shingles are found by looking up every one of
them, so none is missed; of the others an item at the threshold is missed with
a probability under one in a thousand, and a verbatim copy far more rarely.
Candidates are verified by the exact share of the item's distinct shingles that
the whole document holds.

Items are taken in blocks of ``BLOCK_BYTES`` of shingles, so what a task holds
of them has a fixed bound; each block runs against all documents.

Defined results: a null, empty or blank document contains nothing and such an
item is contained nowhere; an item of fewer than five words has its whole
sequence as one shingle and matches only a document of those same words;
repeated items and documents each give their own rows; empty tables give an
empty result. Letters A-Z are lower-cased.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from strata.llm.common import Texts, distinct_per_row, load, salted, shingles_of, slices, text_rows, texts_of

WIDTH = 5
BINS, SEEDS = 32, 3
#: Largest sizes of the item classes: 32, 128, 512, ... shingles.
CLASS_BASE, CLASS_STEP = 32, 4
#: Items of fewer shingles are looked up by each of them: MinHash is too sparse there.
EXACT_BELOW = 16
BLOCK_BYTES = 16 << 20
#: Bytes of text worked on at once: windows' signatures are some 20 times as large.
SLICE_BYTES = 1 << 20
_NONE = np.uint64(2**64 - 1)


def size_class(n: np.ndarray) -> np.ndarray:
    """0 for up to 32 shingles, 1 for up to 128, and so on."""
    n = np.maximum(np.asarray(n, np.float64), 1)
    return np.maximum(0, np.ceil(np.log(n / CLASS_BASE) / np.log(CLASS_STEP))).astype(np.int64)


def _bin_minima(groups: np.ndarray, hashes: np.ndarray, n_groups: int) -> np.ndarray:
    """(groups, SEEDS * BINS): the least hash of each bin, ``_NONE`` if empty."""
    out = np.full(n_groups * SEEDS * BINS, _NONE)
    for seed in range(SEEDS):
        h = salted(hashes, seed + 1)
        cell = (groups * SEEDS + seed) * BINS + (h >> np.uint64(59)).astype(np.int64)
        np.minimum.at(out, cell, h)
    return out.reshape(n_groups, SEEDS * BINS)


def _pack_items(block: list[dict]) -> dict:
    """The signatures and exact shingles of a block of items, by size class."""
    ids = [r["item_id"] for r in block]
    texts = texts_of(pa.array([r["text"] for r in block], pa.string())).lower()
    rows, hashes = shingles_of(texts, WIDTH)
    sets, offsets = distinct_per_row(rows, hashes, len(texts))
    sizes = np.diff(offsets)
    classes = {}
    for c in np.unique(size_class(sizes[sizes >= EXACT_BELOW])):
        members = np.flatnonzero((sizes >= EXACT_BELOW) & (size_class(sizes) == c))
        picked = np.isin(np.repeat(np.arange(len(sizes)), sizes), members)
        owner = np.searchsorted(members, np.repeat(np.arange(len(sizes)), sizes)[picked])
        minima = _bin_minima(owner, sets[picked], len(members))
        item, column = np.nonzero(minima != _NONE)
        keys = salted(minima[item, column], 50) + column.astype(np.uint64)
        order = np.argsort(keys, kind="stable")
        classes[int(c)] = (keys[order], members[item[order]])
    few = np.flatnonzero((sizes > 0) & (sizes < EXACT_BELOW))
    few_owner = np.repeat(np.arange(len(sizes)), sizes)
    picked = np.isin(few_owner, few)
    order = np.argsort(sets[picked], kind="stable")
    return {"ids": ids, "sets": sets, "offsets": offsets, "classes": classes, "few": (sets[picked][order], few_owner[picked][order])}


def _few_candidates(rows: np.ndarray, hashes: np.ndarray, keys: np.ndarray, owners: np.ndarray) -> np.ndarray:
    """(row, item) pairs that share a shingle, for items of few shingles."""
    low, high = np.searchsorted(keys, hashes, "left"), np.searchsorted(keys, hashes, "right")
    hit = np.flatnonzero(high > low)
    n = high[hit] - low[hit]
    items = owners[np.repeat(low[hit], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
    return np.unique(np.column_stack([np.repeat(rows[hit], n), items]), axis=0)


def _candidates(rows: np.ndarray, hashes: np.ndarray, n_rows: int, c: int, keys: np.ndarray, owners: np.ndarray) -> np.ndarray:
    """Candidate (row, item) pairs of one size class."""
    step = CLASS_BASE * CLASS_STEP**c
    first = np.searchsorted(rows, np.arange(n_rows + 1))
    piece_of = (np.arange(len(rows)) - first[rows]) // step
    pieces = np.bincount(rows, minlength=n_rows)
    pieces = -(-pieces // step)
    base = np.concatenate([[0], np.cumsum(pieces)])
    minima = _bin_minima(base[rows] + piece_of, hashes, int(base[-1]))
    row_of = np.repeat(np.arange(n_rows), pieces)
    # a window is a piece with the next one of the same row
    windows = minima.copy()
    if len(minima) > 1:
        joined = row_of[1:] == row_of[:-1]
        windows[:-1][joined] = np.minimum(minima[:-1][joined], minima[1:][joined])
    sig = salted(windows, 50) + np.arange(SEEDS * BINS, dtype=np.uint64)[None, :]
    low, high = np.searchsorted(keys, sig.ravel(), "left"), np.searchsorted(keys, sig.ravel(), "right")
    hit = np.flatnonzero((high > low) & (windows.ravel() != _NONE))
    n = high[hit] - low[hit]
    items = owners[np.repeat(low[hit], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
    found = np.repeat(row_of[hit // (SEEDS * BINS)], n)
    return np.unique(np.column_stack([found, items]), axis=0)


def _held(block: dict, texts: Texts, threshold: float) -> list[tuple[int, int, float]]:
    """(row, item, share of the item) of every item that a text holds."""
    rows, hashes = shingles_of(texts.lower(), WIDTH)
    if not len(rows):
        return []
    pairs = [_few_candidates(rows, hashes, *block["few"]), *(_candidates(rows, hashes, len(texts), c, *index) for c, index in block["classes"].items())]
    pairs = np.concatenate(pairs)
    first = np.searchsorted(rows, np.arange(len(texts) + 1))
    out = []
    for row in np.unique(pairs[:, 0]):
        own = np.unique(hashes[first[row] : first[row + 1]])
        for item in pairs[pairs[:, 0] == row, 1]:
            wanted = block["sets"][block["offsets"][item] : block["offsets"][item + 1]]
            share = np.isin(wanted, own, assume_unique=True).sum() / len(wanted)
            if share >= threshold:
                out.append((row, item, share))
    return out


def _search(shared, threshold: float):
    def run(batches):
        block = shared.value
        for batch in batches:
            for part, texts in slices(batch, limit=SLICE_BYTES):
                if out := _held(block, texts, threshold):
                    at, item, share = zip(*out, strict=True)
                    yield pa.record_batch(
                        {
                            "doc_id": part.column("doc_id").take(pa.array(at, pa.int64())),
                            "item_id": pa.array([block["ids"][i] for i in item], pa.int64()),
                            "containment": pa.array(share, pa.float64()),
                        }
                    )

    return run


def _clean(shared, threshold: float):
    """The rows, with all their columns, whose text holds no item of a block."""

    def run(batches):
        for batch in batches:
            for part, texts in slices(batch, limit=SLICE_BYTES):
                stays = np.ones(part.num_rows, bool)
                stays[[row for row, _, _ in _held(shared.value, texts, threshold)]] = False
                yield part.filter(pa.array(stays))

    return run


def _blocks(items: DataFrame):
    """The items in blocks of bounded size, streamed through the driver."""
    block, size = [], 0
    for r in items.select("item_id", "text").toLocalIterator():
        if r["text"] is None or not r["text"].strip():
            continue
        block.append(r.asDict())
        size += 8 * len(r["text"])
        if size >= BLOCK_BYTES:
            yield block
            block, size = [], 0
    if block:
        yield block


def contained_items(docs: DataFrame, items: DataFrame, threshold: float = 0.75) -> DataFrame:
    """(doc_id, item_id, containment) of every item that a document holds."""
    spark, schema = docs.sparkSession, "doc_id long, item_id long, containment double"
    out = spark.createDataFrame([], schema)
    for block in _blocks(items):
        shared = spark.sparkContext.broadcast(_pack_items(block))  # BLOCK_BYTES and its signatures
        out = out.union(text_rows(docs).mapInArrow(_search(shared, threshold), schema))
    return out


def decontaminate(docs: DataFrame, items: DataFrame, threshold: float = 0.75) -> DataFrame:
    """The documents (all columns) that hold no item. Each row is judged by its
    own text, where it is: nothing is joined by doc_id, which may be missing or
    shared."""
    for block in _blocks(items):
        shared = docs.sparkSession.sparkContext.broadcast(_pack_items(block))
        docs = docs.mapInArrow(_clean(shared, threshold), docs.schema)
    return docs


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained_items(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


#: Exact containment of every item in every document. The search must find the same rows.
ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS doc, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), i AS (
  SELECT row_number() OVER () AS item, item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM benchmark
), item_sets AS (
  SELECT item, item_id, list_distinct(CASE WHEN len(words) BETWEEN 1 AND 4 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 3), lambda k: array_to_string(words[k:k + 4], ' ')) END) AS shingles
  FROM i
), item_shingles AS (
  SELECT item, item_id, len(shingles) AS n, unnest(shingles) AS shingle FROM item_sets
), doc_shingles AS (
  SELECT DISTINCT doc, doc_id, unnest(CASE WHEN len(words) BETWEEN 1 AND 4 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 3), lambda k: array_to_string(words[k:k + 4], ' ')) END) AS shingle
  FROM d
)
SELECT doc_id, item_id, count(*) / any_value(n) AS containment
FROM doc_shingles JOIN item_shingles USING (shingle)
GROUP BY doc, doc_id, item, item_id
HAVING 100 * count(*) >= 75 * any_value(n)
"""
