"""Hard-negative mining: inner-product search with coordinate pruning.

Rows are dealt by label and length into partitions and packed there into
length buckets. A bucket keeps its unit vectors' values of each coordinate in
sorted lists. An anchor looks for rows of at least some score, and from that
follows how much of the bucket it needs to see:

* none of it, if the score exceeds the product of the two lengths;
* else a feasible range of values in each of the anchor's focus coordinates
  (its largest ones): a unit vector at most arccos(t) away from the anchor's
  has its angle to an axis within arccos(t) of the anchor's own. The rows in
  all ranges, found by the sorted lists, are the candidates;
* or all of it, where even the narrowest range holds most of the bucket and
  sets cannot be smaller than reading the bucket through.

Candidates are verified by their exact integer score. The best scores found so
far raise what an anchor asks of the buckets after, from one wave of partitions
to the next as well. Positives are the best rows of an anchor's own label;
negatives the best rows of other labels in a band below a positive's score.

Spread: every block of anchors meets every partition of rows in a task of its
own, so a label or an id that holds a third of the rows is many partitions and
blocks, and no task holds more than ``rows_per_task`` rows and about
``anchors_per_block`` anchors. Nothing is collected but counts and one row for
each partition and label.

Defined results: a row without label or vector, or with a null or non-finite
component, takes no part. A row without an id does and comes last in ties.
Rows are told apart by themselves, not by their ids: a repeated row is another
row, and a repeated anchor has its result as often. Vectors of different size
count as filled up with zeros. An empty table, or one without anchors,
positives or rows in a band, gives an empty result. Columns beside the named
ones do not matter. Scores have to fit a long.
"""
from __future__ import annotations

from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.llm.common import load, staged

BUCKET_ROWS = 2048
#: Anchors that meet a bucket at once.
STRIPE = 1024
#: Coordinates that an anchor looks at, and the share of a bucket from which the narrowest range is no help.
FOCUS = 6
DENSE = 0.25
#: Stands for a missing id inside: comes last in ties.
NO_ID = 2**63 - 1
LEAST, MOST = np.int64(-(2**63) + 1), np.int64(2**63 - 1)

_INDEX = "part int, label long, dims int, wide boolean, length double, ids binary, uids binary, anchors binary, rows binary"
_ANCHOR = "uid long, id long, label long, wide boolean, vector binary"


def _pack(vectors: np.ndarray) -> tuple[bytes, bool]:
    wide = bool(len(vectors)) and bool(np.abs(vectors).max(initial=0) >= 2**15)
    return vectors.astype("<i8" if wide else "<i2").tobytes(), wide


def _unpack(data: bytes, wide: bool) -> np.ndarray:
    return np.frombuffer(data, "<i8" if wide else "<i2").astype(np.int64)


def _buckets(batches):
    """Packs rows that come sorted by label and falling length."""
    part, at = TaskContext.get().partitionId(), 0
    schema = pa.schema([("part", pa.int32()), ("label", pa.int64()), ("dims", pa.int32()), ("wide", pa.bool_()), ("length", pa.float64()), *((c, pa.binary()) for c in ("ids", "uids", "anchors", "rows"))])
    for batch in batches:
        label = batch.column("label").to_numpy()
        ids, anchors = batch.column("id").to_numpy(), batch.column("is_anchor").to_numpy(zero_copy_only=False)
        square = batch.column("square").to_numpy()
        edges = np.flatnonzero(np.diff(label)) + 1
        cuts = np.unique(np.concatenate([[0, len(label)], edges, *(np.arange(a, b, BUCKET_ROWS) for a, b in zip([0, *edges], [*edges, len(label)], strict=True))]).astype(np.int64))
        out = []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            lists = batch.column("vector").slice(a, b - a)
            sizes = np.diff(lists.offsets.to_numpy())
            dims = int(sizes.max(initial=0))
            rows = np.zeros((b - a, dims), np.int64)
            rows[np.arange(dims) < sizes[:, None]] = lists.flatten().to_numpy()
            uids = (np.int64(part) << 33) + at + np.arange(a, b)
            data, wide = _pack(rows)
            out.append((part, int(label[a]), dims, wide, float(np.sqrt(square[a:b].max())), ids[a:b].astype("<i8").tobytes(), uids.astype("<i8").tobytes(), anchors[a:b].astype(np.uint8).tobytes(), data))
        at += batch.num_rows
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)


def _anchors(batches):
    schema = pa.schema([("uid", pa.int64()), ("id", pa.int64()), ("label", pa.int64()), ("wide", pa.bool_()), ("vector", pa.binary())])
    for batch in batches:
        for row in batch.to_pylist():
            pick = np.flatnonzero(np.frombuffer(row["anchors"], np.uint8))
            if not len(pick):
                continue
            step = row["dims"] * (8 if row["wide"] else 2)
            ids, uids = np.frombuffer(row["ids"], "<i8")[pick], np.frombuffer(row["uids"], "<i8")[pick]
            vectors = [row["rows"][i * step : (i + 1) * step] for i in pick]
            yield pa.RecordBatch.from_arrays([pa.array(uids), pa.array(ids), pa.array(np.full(len(pick), row["label"])), pa.array([row["wide"]] * len(pick)), pa.array(vectors, pa.binary())], schema=schema)


class Bucket:
    """Rows of one label and like lengths, with a sorted list for each coordinate."""

    def __init__(self, label: int, length: float, ids: np.ndarray, uids: np.ndarray, rows: np.ndarray):
        self.label, self.length, self.ids, self.uids, self.rows = label, length, ids, uids, rows
        self.most = int(np.abs(rows).max(initial=0))
        self._lists = None

    def lists(self) -> tuple[np.ndarray, np.ndarray]:
        """For each coordinate the unit vectors' values in order, and each row's place among them."""
        if self._lists is None:
            rows = self.rows.astype(np.float64)
            unit = rows / np.maximum(np.sqrt((rows**2).sum(1)), 1e-300)[:, None]
            order = np.argsort(unit, axis=0, kind="stable")
            place = np.empty_like(order)
            np.put_along_axis(place, order, np.arange(len(rows))[:, None], 0)
            self._lists = np.take_along_axis(unit, order, 0), place, order
        return self._lists

    def scores(self, anchors: np.ndarray, rows: np.ndarray | None = None) -> np.ndarray:
        """Exact inner products: floats hold every partial sum that stays below
        their precision, integers the others."""
        other = self.rows if rows is None else self.rows[rows]
        most = self.most * int(np.abs(anchors).max(initial=0)) * max(anchors.shape[1], 1)
        if most < 2**53:
            kind = np.float32 if most < 2**24 else np.float64
            return (anchors.astype(kind) @ other.astype(kind).T).astype(np.int64)
        if most >= 2**63:
            raise OverflowError("scores do not fit a long")
        return anchors @ other.T


def feasible_ranges(focus: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values that a unit vector can have in a coordinate where the anchor's
    unit vector has ``focus``, if their product is at least ``bound``."""
    angle, apart = np.arccos(np.clip(focus, -1, 1)), np.arccos(np.clip(bound, -1, 1))
    return np.cos(np.minimum(angle + apart, np.pi)) - 1e-9, np.cos(np.maximum(angle - apart, 0)) + 1e-9


def candidates(bucket: Bucket, anchors: np.ndarray, lengths: np.ndarray, least: np.ndarray):
    """What of a bucket each anchor needs to see for scores of ``least`` or
    more: yields (anchor numbers, row numbers or None for the whole bucket)."""
    with np.errstate(divide="ignore", invalid="ignore"):
        bound = np.where(lengths * bucket.length > 0, least / (lengths * bucket.length), np.where(least > 0, 2.0, -1.0)) - 1e-9
    alive = np.flatnonzero(bound <= 1)
    narrow = alive[bound[alive] > 0]
    whole = [alive[bound[alive] <= 0]]
    if len(narrow):
        values, place, order = bucket.lists()
        unit = anchors[narrow] / lengths[narrow, None]
        focus = np.argsort(-np.abs(unit), axis=1)[:, :FOCUS]
        low, high = feasible_ranges(np.take_along_axis(unit, focus, 1), bound[narrow, None])
        first, last = np.empty(focus.shape, np.int64), np.empty(focus.shape, np.int64)
        for f in np.unique(focus):
            at = focus == f
            first[at] = np.searchsorted(values[:, f], low[at], "left")
            last[at] = np.searchsorted(values[:, f], high[at], "right")
        width = last - first
        best = width.argmin(1)
        dense = width.min(1) > DENSE * len(bucket.ids)
        whole.append(narrow[dense])
        for i in np.flatnonzero(~dense):
            f = focus[i, best[i]]
            rows = order[first[i, best[i]] : last[i, best[i]], f]
            at = place[rows[:, None], focus[i]]
            rows = rows[((at >= first[i]) & (at < last[i])).all(1)]
            if len(rows):
                yield narrow[i : i + 1], rows
    seen = np.concatenate(whole)
    for i in range(0, len(seen), STRIPE):
        yield seen[i : i + STRIPE], None


def _best(group: np.ndarray, score: np.ndarray, ids: np.ndarray, uids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best of each group: higher scores, then smaller ids."""
    order = np.lexsort((uids, ids, -score, group))
    g = group[order]
    start = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]])) if len(g) else np.zeros(0, np.int64)
    nth = np.arange(len(g)) - np.repeat(start, np.diff(np.append(start, len(g))))
    return order[nth < k]


def search(buckets: list[Bucket], uids: np.ndarray, labels: np.ndarray, anchors: np.ndarray, low: np.ndarray, high: np.ndarray, k: int, same: bool):
    """The ``k`` best rows for each anchor and band: of the anchor's label
    (``same``; never the anchor's own row) or of the others, with a score in
    [low, high], both (anchors, bands). Returns (anchor, band, score, id, uid)
    arrays."""
    bands = low.shape[1]
    low = low.copy()
    lengths = np.sqrt((anchors.astype(np.float64) ** 2).sum(1))
    none = np.zeros(0, np.int64)
    group, score, ids, row_uids = none, none, none, none
    for b in sorted(buckets, key=lambda b: -b.length):
        fits = np.flatnonzero((labels == b.label) == same)
        if not len(fits):
            continue
        wide = max(anchors.shape[1], b.rows.shape[1])
        if b.rows.shape[1] != wide:
            b = Bucket(b.label, b.length, b.ids, b.uids, np.pad(b.rows, ((0, 0), (0, wide - b.rows.shape[1]))))
        vectors = anchors if anchors.shape[1] == wide else np.pad(anchors, ((0, 0), (0, wide - anchors.shape[1])))
        found = [(group, score, ids, row_uids)]
        least, most = low.min(1), high.max(1)
        for who, rows in candidates(b, vectors[fits], lengths[fits], least[fits]):
            who = fits[who]
            s = b.scores(vectors[who], rows)
            i, j = np.nonzero((s >= least[who, None]) & (s <= most[who, None]))
            a, s = who[i], s[i, j]
            j = j if rows is None else rows[j]
            if same:
                own = uids[a] == b.uids[j]
                a, s, j = a[~own], s[~own], j[~own]
            for band in range(bands):
                fit = (s >= low[a, band]) & (s <= high[a, band])
                found.append((a[fit] * bands + band, s[fit], b.ids[j[fit]], b.uids[j[fit]]))
        group, score, ids, row_uids = (np.concatenate(x) for x in zip(*found, strict=True))
        keep = _best(group, score, ids, row_uids, k)
        group, score, ids, row_uids = group[keep], score[keep], ids[keep], row_uids[keep]
        full, counts = np.unique(group, return_counts=True)
        if len(full):  # groups that are full ask for their last score from now on
            last = score[np.cumsum(counts) - 1]
            at = full[counts == k]
            low.reshape(-1)[at] = np.maximum(low.reshape(-1)[at], last[counts == k])
    return group // bands, group % bands, score, ids, row_uids


def _meet(bands: int, k: int, same: bool):
    """A task's work: one partition of rows and one block of anchors."""

    def run(rows: pa.Table, wanted: pa.Table) -> pa.Table:
        buckets = []
        for r in rows.to_pylist():
            data = _unpack(r["rows"], r["wide"])
            ids = np.frombuffer(r["ids"], "<i8")
            buckets.append(Bucket(r["label"], r["length"], ids, np.frombuffer(r["uids"], "<i8"), data.reshape(len(ids), r["dims"])))
        vectors = [_unpack(v, w) for v, w in zip(wanted.column("a_vector").to_pylist(), wanted.column("a_wide").to_pylist(), strict=True)]
        anchors = np.zeros((len(vectors), max((len(v) for v in vectors), default=0)), np.int64)
        for i, v in enumerate(vectors):
            anchors[i, : len(v)] = v
        uids, labels = wanted.column("a_uid").to_numpy(), wanted.column("a_label").to_numpy()
        if same:
            low, high = np.full((len(vectors), 1), LEAST), np.full((len(vectors), 1), MOST)
        else:
            low, high = np.full((len(vectors), bands), MOST), np.full((len(vectors), bands), LEAST)
            for i, of in enumerate(wanted.column("a_bands").to_pylist()):
                for j, x in enumerate(of):
                    low[i, j], high[i, j] = x["low"], x["high"]
        a, band, score, ids, found = search(buckets, uids, labels, anchors, low, high, k, same)
        return pa.table({"anchor": uids[a], "band": band.astype(np.int32), "score": score, "id": ids, "uid": found})

    return run


_FOUND = "anchor long, band int, score long, id long, uid long"


def _searched(index: DataFrame, wanted: DataFrame, blocks: int, bands: int, k: int, same: bool) -> DataFrame:
    """``wanted`` has a row for each anchor and partition that it is to meet."""
    each = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    rows = index.select("*", each).groupBy("part", "block")
    asking = wanted.toDF(*(f"a_{c}" for c in wanted.columns)).groupBy("a_part", "a_block")
    return rows.cogroup(asking).applyInArrow(_meet(bands, k, same), _FOUND)


def _first(found: DataFrame, k: int, by: list[str]) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), "id", "uid")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine_hard_negatives(
    vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, band: tuple[int, int] = (30, 90),
    rows_per_task: int = 32768, anchors_per_block: int = 8192,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and
    negative_score for each anchor, each of its first ``positives`` rows of the
    same label, and the first ``negatives`` rows of other labels whose score is
    ``band`` percent of the positive's, both ends included.

    ``vectors`` has id, label and vector (array of whole numbers).
    """
    spark = vectors.sparkSession
    rows = vectors.where("label is not null and vector is not null and not exists(vector, x -> x is null)").select(
        F.coalesce(F.col("id").cast("long"), F.lit(NO_ID)).alias("id"), F.col("label").cast("long").alias("label"),
        F.col("vector").cast("array<long>").alias("vector"), F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"),
        F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")).alias("square"),
    )
    total, n_anchors = rows.agg(F.count(F.lit(1)), F.count_if("is_anchor")).first()
    blocks = max(1, ceil(n_anchors / anchors_per_block))
    dealt = rows.repartitionByRange(max(1, ceil(total / rows_per_task)), "label", F.desc("square"), "id")
    dealt = dealt.sortWithinPartitions("label", F.desc("square"), "id")
    index = staged(dealt.mapInArrow(_buckets, _INDEX), "op11-index")
    block = F.pmod(F.xxhash64("uid"), F.lit(blocks)).cast("int").alias("block")
    anchors = staged(index.select("label", "dims", "wide", "ids", "uids", "anchors", "rows").mapInArrow(_anchors, _ANCHOR).select("*", block), "op11-anchors")
    parts = index.select("part", "label").distinct()

    # positives: each anchor meets the partitions that hold its label
    wanted = anchors.join(parts, "label")
    found = _searched(index, wanted, blocks, 1, positives, True)
    best = _first(found, positives, ["anchor"]).select("anchor", (F.col("rank") - 1).alias("band"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    # 100 * score has to lie between the two percentages of the positive's score
    share = [F.col("positive_score").cast("decimal(20,0)") * F.lit(b) / F.lit(100) for b in band]
    best = staged(best.withColumns({"low": F.ceil(share[0]).cast("long"), "high": F.floor(share[1]).cast("long")}), "op11-positives")

    # negatives: a first wave of partitions tells what to ask of the others
    last_part = index.agg(F.coalesce(F.max("part"), F.lit(0))).first()[0]
    step = max(1, round(sqrt(last_part + 1)))
    in_first = F.pmod("part", F.lit(step)) == 0
    known = None
    for in_wave in [F.lit(True)] if last_part < 8 else [in_first, ~in_first]:
        asked = best.select("anchor", "band", "low", "high")
        if known is not None:
            last = known.where(F.col("rank") == negatives).select("anchor", "band", F.col("score").alias("least"))
            asked = asked.join(last, ["anchor", "band"], "left").withColumn("low", F.greatest("low", "least")).drop("least")
        bands = asked.groupBy(F.col("anchor").alias("uid")).agg(F.sort_array(F.collect_list(F.struct("band", "low", "high"))).alias("bands"))  # at most ``positives`` each
        wanted = anchors.join(bands, "uid").withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(last_part)))).where(in_wave)
        found = _searched(index.where(in_wave), wanted, blocks, positives, negatives, False)
        found = found if known is None else found.unionByName(known.drop("rank"))
        known = staged(_first(found, negatives, ["anchor", "band"]), "op11-negatives")
    names = anchors.select(F.col("uid").alias("anchor"), F.col("id").alias("anchor_id"))
    real = lambda c: F.when(F.col(c) != NO_ID, F.col(c)).alias(c)
    joined = known.withColumnRenamed("id", "negative_id").join(best, ["anchor", "band"]).join(names, "anchor")
    return joined.select(real("anchor_id"), real("positive_id"), "rank", real("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def scaled_vectors(embeddings: DataFrame) -> DataFrame:
    """id, label and vector of the rows that take part: components become
    floor(256 * x), and every seventh id has the label after its own."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    finite = F.forall("embedding", lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))
    rows = embeddings.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)
    return rows.select(F.col("vec_id").alias("id"), label.alias("label"), F.transform("embedding", lambda x: F.floor(F.lit(256.0) * x.cast("double"))).alias("vector"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = scaled_vectors(load(spark, sf_dir, "embeddings"))
    return mine_hard_negatives(vectors, F.col("id") % 100 == 0)


ORACLE_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS uid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.uid AS anchor, a.vec_id AS anchor_id, b.uid AS other, b.vec_id AS other_id, a.label = b.label AS same,
    list_dot_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.uid <> b.uid WHERE a.vec_id % 100 = 0
), p AS (
  SELECT anchor, anchor_id, other, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other_id, other) <= 5
)
SELECT p.anchor_id, p.positive_id,
  row_number() OVER (PARTITION BY p.anchor, p.other ORDER BY s.score DESC, s.other_id, s.other)::INTEGER AS rank,
  s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor = p.anchor AND NOT s.same
WHERE 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor, p.other ORDER BY s.score DESC, s.other_id, s.other) <= 10
"""
