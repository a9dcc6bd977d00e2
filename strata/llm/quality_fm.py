"""Quality classifier: a factorisation machine over whole texts.

Inputs are the hashed words of a text (damped counts, unit length), statistics
of its structure, and metadata (the table's n_chars beside the counted one).
Every input has a weight and a short vector; two inputs of a text interact by
the product of their vectors. The sum over all pairs is taken in linear time
by the identity  sum over pairs = (square of the sum - sum of the squares) / 2
in each dimension of the vectors. Trained in numpy by Adagrad on logistic loss.

The model is fitted on a bounded sample of labelled documents (``sample_rows``,
chosen by a hash of doc_id; at most that many feature rows reach the driver).
Scoring reads every whole text once, in the scan, without a shuffle.

Defined results: a null or empty text has no words and is scored by its
statistics; repeated rows each get their own, equal result; a row without
doc_id is scored, but never learned from. Labels other than 0 and 1, or
without doc_id, are ignored; of several labels of a document the smallest
counts; of rows that share a doc_id one is learned from. Without labels of
both kinds all scores are the share of label 1 ((ones + 1) / (labels + 2)). A
missing n_chars counts as the counted one. An empty table gives an empty result.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import LOWER, SPACES, Texts, bounded_sample, crc_mod, load, map_slices, span_hashes, words_of

#: Word features; a power of two.
BUCKETS = 1 << 15
STATISTICS = 12


def _mask(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_UPPER, _LOWERS = _mask(bytes(range(0x41, 0x5B))), _mask(bytes(range(0x61, 0x7B)))
_DIGITS, _ENDS, _LINES = _mask(b"0123456789"), _mask(b".!?"), _mask(b"\n")
_WIDE = _mask(bytes(range(0x80, 0x100)))


def _counts(mask: np.ndarray, texts: Texts) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    return (total[texts.offsets[1:]] - total[texts.offsets[:-1]]).astype(np.float64)


def text_features(texts: Texts, n_chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(rows, buckets, values) of the words, in order of rows, and the
    (rows, STATISTICS) matrix of the other inputs. ``n_chars`` may hold NaN."""
    n = len(texts)
    low = LOWER[texts.buf]
    words = words_of(texts)
    bucket = (span_hashes(low, words.starts, words.ends) & np.uint64(BUCKETS - 1)).astype(np.int64)
    pairs, times = np.unique(words.rows * BUCKETS + bucket, return_counts=True)
    rows, buckets = pairs // BUCKETS, pairs % BUCKETS
    values = np.log1p(times)
    values /= np.sqrt(np.bincount(rows, values**2, n))[rows]

    buf, count = texts.buf, words.counts.astype(np.float64)
    chars = _counts((buf & 0xC0) != 0x80, texts)
    some, any_word = np.maximum(chars, 1), np.maximum(count, 1)
    upper, lower = _counts(_UPPER[buf], texts), _counts(_LOWERS[buf], texts)
    digits, wide = _counts(_DIGITS[buf], texts), _counts(_WIDE[buf], texts)
    space, lines = _counts(SPACES[buf], texts), _counts(_LINES[buf], texts)
    ends = _counts(_ENDS[buf], texts)
    size = np.diff(texts.offsets).astype(np.float64)
    other = np.maximum(size - upper - lower - digits - wide - space - ends, 0)  # remaining symbols
    given = np.where(np.isnan(n_chars), chars, n_chars)
    statistics = np.column_stack(
        [
            np.log1p(count), (chars - space) / any_word, np.bincount(rows, minlength=n) / any_word, upper / some, digits / some, other / any_word, ends / any_word,
            lines / any_word, space / some, wide / np.maximum(size, 1), np.log1p(np.maximum(given, 0)), (given - chars) / np.maximum(np.maximum(given, chars), 1),
        ]
    )
    return rows, buckets, values, statistics


class FactorisationMachine:
    """Inputs come as (rows, columns, values), rows in rising order."""

    def __init__(self, inputs: int, factors: int = 8, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.bias = np.zeros(1)
        self.weights = np.zeros(inputs)
        self.vectors = rng.normal(0, 0.05, (inputs, factors))

    def raw(self, rows: np.ndarray, columns: np.ndarray, values: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Log odds, and each row's summed vectors."""
        out = self.bias[0] + np.bincount(rows, self.weights[columns] * values, n)
        sums = np.empty((n, self.vectors.shape[1]))
        for f in range(sums.shape[1]):
            part = self.vectors[columns, f] * values
            sums[:, f] = np.bincount(rows, part, n)
            out += 0.5 * (sums[:, f] ** 2 - np.bincount(rows, part**2, n))
        return out, sums

    def gradients(self, rows: np.ndarray, columns: np.ndarray, values: np.ndarray, target: np.ndarray, decay: float = 0.0) -> tuple[float, tuple[np.ndarray, ...], np.ndarray]:
        """Mean logistic loss with decay on the inputs seen, its gradients for
        the bias and for the seen inputs' weights and vectors, and the inputs."""
        n = len(target)
        odds, sums = self.raw(rows, columns, values, n)
        loss = float(np.mean(np.logaddexp(0, odds) - target * odds))
        error = ((1 / (1 + np.exp(-np.clip(odds, -40, 40)))) - target) / n
        seen, at = np.unique(columns, return_inverse=True)
        scale = error[rows] * values
        weights = np.bincount(at, scale, len(seen)) + decay * self.weights[seen]
        vectors = np.empty((len(seen), sums.shape[1]))
        for f in range(sums.shape[1]):
            own = self.vectors[columns, f]
            vectors[:, f] = np.bincount(at, scale * (sums[rows, f] - own * values), len(seen))
        vectors += decay * self.vectors[seen]
        loss += 0.5 * decay * float((self.weights[seen] ** 2).sum() + (self.vectors[seen] ** 2).sum())
        return loss, (np.array([error.sum()]), weights, vectors), seen

    def fit(self, texts: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray, epochs: int = 8, batch: int = 64, rate: float = 0.1, decay: float = 1e-5, seed: int = 13) -> FactorisationMachine:
        """Adagrad over shuffled batches of (columns, values) rows."""
        rng = np.random.default_rng(seed)
        past = [np.full(x.shape, 1e-6) for x in (self.bias, self.weights, self.vectors)]
        for _ in range(epochs):
            order = rng.permutation(len(texts))
            for i in range(0, len(order), batch):
                pick = order[i : i + batch]
                rows = np.repeat(np.arange(len(pick)), [len(texts[p][0]) for p in pick])
                columns, values = (np.concatenate([texts[p][k] for p in pick]) for k in (0, 1))
                _, grads, seen = self.gradients(rows, columns, values, target[pick], decay)
                for x, g, old, at in zip((self.bias, self.weights, self.vectors), grads, past, (slice(None), seen, seen), strict=True):
                    old[at] += g**2
                    x[at] -= rate * g / np.sqrt(old[at])
        return self


def _given(part: pa.RecordBatch) -> np.ndarray:
    return pc.fill_null(part.column("n_chars").cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False)


_ROWS = "doc_id long, label int, tie long, buckets array<int>, values array<double>, statistics array<double>"


def _learn_from(part: pa.RecordBatch, texts: Texts) -> pa.RecordBatch:
    rows, buckets, values, statistics = text_features(texts, _given(part))
    offsets = np.searchsorted(rows, np.arange(len(texts) + 1)).astype(np.int32)
    tie = span_hashes(texts.buf, texts.offsets[:-1], texts.offsets[1:]).view(np.int64)
    return pa.RecordBatch.from_arrays(
        [
            part.column("doc_id"), part.column("label"), pa.array(tie), pa.ListArray.from_arrays(offsets, pa.array(buckets.astype(np.int32))), pa.ListArray.from_arrays(offsets, pa.array(values)),
            pa.ListArray.from_arrays(np.arange(0, statistics.size + 1, STATISTICS, dtype=np.int32), pa.array(statistics.ravel())),
        ],
        ["doc_id", "label", "tie", "buckets", "values", "statistics"],
    )


def _scaled(statistics: np.ndarray, mean: np.ndarray, spread: np.ndarray) -> np.ndarray:
    return np.clip((statistics - mean) / spread, -4, 4) / 4


def _score(shared):
    def run(part: pa.RecordBatch, texts: Texts) -> pa.RecordBatch:
        machine, mean, spread = shared.value
        rows, buckets, values, statistics = text_features(texts, _given(part))
        n = len(texts)
        all_rows = np.concatenate([rows, np.repeat(np.arange(n), STATISTICS)])
        columns = np.concatenate([buckets, np.tile(BUCKETS + np.arange(STATISTICS), n)])
        odds, _ = machine.raw(all_rows, columns, np.concatenate([values, _scaled(statistics, mean, spread).ravel()]), n)
        score = 1 / (1 + np.exp(-np.clip(odds, -40, 40)))
        return pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(score)], ["doc_id", "held_out", "score"])

    return map_slices(run)


def fit_quality_model(docs: DataFrame, labels: DataFrame, sample_rows: int = 6000, factors: int = 8, epochs: int = 8):
    """(machine, means, spreads), or the share of label 1 if the labels are not of both kinds."""
    known = labels.where("doc_id is not null and quality in (0, 1)").where(crc_mod("doc_id", 3) != 1)
    known = known.groupBy("doc_id").agg(F.min("quality").cast("int").alias("label"))
    chosen = bounded_sample(known, sample_rows, known.count())  # at most sample_rows ids
    rows = docs.join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text", "n_chars").mapInArrow(map_slices(_learn_from), _ROWS)
    one = rows.groupBy("doc_id").agg(F.min(F.struct("tie", "label", "buckets", "values", "statistics")).alias("r")).select("doc_id", "r.*")
    table = one.toArrow().sort_by("doc_id")
    target = table.column("label").to_numpy().astype(np.float64)
    if len(np.unique(target)) < 2:
        return float((target.sum() + 1) / (len(target) + 2))
    statistics = np.array(table.column("statistics").to_pylist())
    mean, spread = statistics.mean(0), np.maximum(statistics.std(0), 1e-6)
    scaled = _scaled(statistics, mean, spread)
    own = BUCKETS + np.arange(STATISTICS)
    texts = [(np.concatenate([np.array(b, np.int64), own]), np.concatenate([np.array(v, np.float64), s])) for b, v, s in zip(table.column("buckets").to_pylist(), table.column("values").to_pylist(), scaled, strict=True)]
    return FactorisationMachine(BUCKETS + STATISTICS, factors).fit(texts, target, epochs), mean, spread


def score_quality(docs: DataFrame, labels: DataFrame, **training) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    given = F.col("n_chars").cast("double") if "n_chars" in docs.columns else F.lit(None).cast("double")
    rows = docs.select("doc_id", "text", given.alias("n_chars"), (crc_mod("doc_id", 3) == 1).alias("held_out"))
    model = fit_quality_model(rows, labels, **training)
    if isinstance(model, float):
        scored = rows.select("doc_id", "held_out", F.lit(model).alias("score"))
    else:
        shared = docs.sparkSession.sparkContext.broadcast(model)  # (BUCKETS + STATISTICS) * (factors + 1) numbers
        scored = rows.mapInArrow(_score(shared), "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op13_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))
