"""Quality rules: isolation forests over rule statistics.

Every text is reduced to a few rule statistics, and these to rates. A forest of
random splits is grown for each group of rates on a bounded sample; a document
that few splits set apart has short paths and a score near 1. A rate of its own
group is not diluted by the others, so a document that is odd in one of them
only scores high there; ``score`` is the highest. The score from which a forest
refuses is calibrated on labelled rows that no forest before refuses, and all
forests together lose at most ``max_false`` of the good rows. The statistics, the scores and the
calibration histogram cover all documents; only the growing of the trees uses
a sample (``sample_rows``, a documented bound).

Defined results: a null or empty text has no words and fails the base rule;
repeated rows each get their own result; an empty table gives an empty result;
without labels of both kinds the forests refuse nothing.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import SPACES, Texts, bounded_sample, load, map_slices, mix, span_hashes, staged, text_rows, window_hashes, words_of

STATS = "doc_id long, n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long, n_letters long, n_chars long"

#: The groups of rates, by their columns in ``features``: each has a forest.
GROUPS = ((0, 1), (2,), (3,), (4,), (5,))

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_LETTERS = np.zeros(256, bool)
_LETTERS[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC3, 0xF5)]] = True  # first bytes of letters


def _per_row(mask: np.ndarray, texts: Texts) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    return total[texts.offsets[1:]] - total[texts.offsets[:-1]]


def _repeat_words(rows: np.ndarray, hashes: np.ndarray, n_rows: int, width: int = 5) -> np.ndarray:
    """Words covered by windows that the same row holds twice or more."""
    windows = window_hashes(hashes, width)
    if not len(windows):
        return np.zeros(n_rows, np.int64)
    at = np.flatnonzero(rows[: len(windows)] == rows[width - 1 :])
    keys = mix(windows[at] ^ mix(rows[at].astype(np.uint64)))
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    change = np.zeros(len(rows) + 1, np.int64)
    np.add.at(change, at[twice], 1)
    np.add.at(change, at[twice] + width, -1)
    return np.bincount(rows[np.cumsum(change[:-1]) > 0], minlength=n_rows)


def _lines(text: bytes) -> tuple[int, int]:
    """Lines with words, and those among them that stand before already."""
    lines = [x for x in text.split(b"\n") if x.strip()]  # bytes.strip: the same six spaces that separate words
    return len(lines), len(lines) - len(set(lines))


def _stats(part: pa.RecordBatch, texts: Texts) -> pa.RecordBatch:
    words = words_of(texts)
    rows, n = words.rows, len(texts)
    hashes = span_hashes(texts.buf, words.starts, words.ends)
    chars = (texts.buf & 0xC0) != 0x80  # first bytes of code points
    lines = np.array([_lines(texts.raw(i)) for i in range(n)], np.int64).reshape(n, 2)
    return pa.record_batch(
        {
            "doc_id": part.column("doc_id"),
            "n_words": words.counts,
            "word_chars": _per_row(chars & ~SPACES[texts.buf], texts),
            "n_symbols": _per_row(_SYMBOLS[texts.buf], texts),
            "n_lines": lines[:, 0].copy(),
            "n_dup_lines": lines[:, 1].copy(),
            "n_repeat_words": _repeat_words(rows, hashes, n),
            "n_letters": _per_row(_LETTERS[texts.buf], texts),
            "n_chars": _per_row(chars, texts),
        }
    )


def rule_statistics(docs: DataFrame) -> DataFrame:
    """One row of rule statistics for each document."""
    return text_rows(docs).mapInArrow(map_slices(_stats), STATS)


def features(cols: dict[str, np.ndarray]) -> np.ndarray:
    """The forests' inputs: symbols a word, letters as a share of all code
    points, word length, shares of duplicated lines and of repeated words, and
    the logarithm of the number of words."""
    c = {k: np.asarray(v, np.float64) for k, v in cols.items()}
    words = np.maximum(c["n_words"], 1)
    return np.column_stack(
        [
            c["n_symbols"] / words, c["n_letters"] / np.maximum(c["n_chars"], 1), c["word_chars"] / words,
            c["n_dup_lines"] / np.maximum(c["n_lines"], 1), c["n_repeat_words"] / words, np.log(words),
        ]
    )


def _average_path(n: np.ndarray | float) -> np.ndarray:
    """Mean path length of an unsuccessful search among ``n`` points."""
    n = np.maximum(np.asarray(n, np.float64), 1)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649) - 2 * (n - 1) / n, np.where(n == 2, 1.0, 0.0))


class IsolationForest:
    """Random trees kept as complete binary heaps of depth ``log2(psi)``."""

    def __init__(self, trees: int = 100, psi: int = 32, seed: int = 7):
        self.trees, self.psi, self.seed = trees, psi, seed
        self.depth = int(np.ceil(np.log2(psi)))

    def fit(self, x: np.ndarray) -> IsolationForest:
        rng = np.random.default_rng(self.seed)
        nodes = 2 ** (self.depth + 1) - 1
        self.dim = np.full((self.trees, nodes), -1, np.int8)
        self.cut = np.zeros((self.trees, nodes))
        self.size = np.zeros((self.trees, nodes))
        self.expected = float(_average_path(min(self.psi, len(x)))) or 1.0
        for t in range(self.trees):
            todo = [(0, 0, x[rng.choice(len(x), min(self.psi, len(x)), replace=False)])]
            while todo:
                node, depth, rows = todo.pop()
                self.size[t, node] = len(rows)
                spread = np.flatnonzero(rows.max(0) > rows.min(0)) if len(rows) > 1 else ()
                if depth == self.depth or not len(spread):
                    continue
                d = int(rng.choice(spread))
                cut = rng.uniform(rows[:, d].min(), rows[:, d].max())
                left = rows[:, d] <= cut
                self.dim[t, node], self.cut[t, node] = d, cut
                todo += [(2 * node + 1, depth + 1, rows[left]), (2 * node + 2, depth + 1, rows[~left])]
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        """2 ** (-mean path / expected path): about 0.5 or less for usual rows."""
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for t in range(self.trees):
            node, depth = np.zeros(len(x), np.int64), np.zeros(len(x))
            for _ in range(self.depth):
                d = self.dim[t, node]
                inner = d >= 0
                right = x[rows, np.maximum(d, 0)] > self.cut[t, node]
                node = np.where(inner, 2 * node + 1 + right, node)
                depth += inner
            total += depth + _average_path(self.size[t, node])
        return np.exp2(-total / self.trees / self.expected)


def calibrate(histogram: list[tuple[int, int, int]], bins: int, max_false: float) -> float:
    """The score from which rows are refused: it parts the labelled rows best
    (largest share of bad rows found less share of good rows lost), among the
    cuts that lose at most ``max_false`` of the good rows."""
    good, bad = np.zeros(bins + 1), np.zeros(bins + 1)
    for b, label, n in histogram:
        (good if label else bad)[b] += n
    if not good.sum() or not bad.sum():
        return 2.0
    lost = np.cumsum(good[::-1])[::-1] / good.sum()
    found = np.cumsum(bad[::-1])[::-1] / bad.sum()
    gain = np.where(lost <= max_false, found - lost, -1.0)
    best = int(np.argmax(gain))
    return best / bins if gain[best] > 0 else 2.0


def judge_quality(docs: DataFrame, labels: DataFrame, sample_rows: int = 8192, trees: int = 100, psi: int = 32, bins: int = 2000, max_false: float = 0.003, seed: int = 7) -> DataFrame:
    """Statistics, base verdict, forest score and verdict of every document.

    ``labels`` has doc_id and quality (1 good, 0 bad); rows with nulls are
    ignored. ``sample_rows`` bounds what the trees are grown on.
    """
    stats = staged(rule_statistics(docs), "op5-stats")
    total = stats.count()
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    stats = stats.withColumn("base_failed", base)
    sample = bounded_sample(stats.where(~F.col("base_failed")), sample_rows, total).toPandas()
    if len(sample) < 2:
        return stats.withColumns({"score": F.lit(0.0), "kept": ~F.col("base_failed")})
    x = features({c: sample[c].to_numpy() for c in sample.columns if c not in ("doc_id", "base_failed")})
    grown = [vars(IsolationForest(trees, psi, seed).fit(x[:, g])) for g in GROUPS]
    shared = stats.sparkSession.sparkContext.broadcast(grown)  # for each group, arrays of trees * 2 * psi nodes

    def score(batches):
        forests = [IsolationForest() for _ in GROUPS]
        for f, v in zip(forests, shared.value, strict=True):
            f.__dict__.update(v)
        for b in batches:
            if b.num_rows:
                x = features({c: b.column(c).to_numpy(zero_copy_only=False) for c in b.schema.names if c not in ("doc_id", "base_failed")})
                scores = np.column_stack([f.score(x[:, g]) for f, g in zip(forests, GROUPS, strict=True)])
                each = pa.ListArray.from_arrays(np.arange(0, scores.size + 1, len(GROUPS), dtype=np.int32), scores.ravel())
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(scores.max(1)), each], [*b.schema.names, "score", "scores"])

    scored = staged(stats.mapInArrow(score, STATS + ", base_failed boolean, score double, scores array<double>"), "op5-scores")
    known = labels.select("doc_id", F.col("quality").alias("_label")).where("doc_id is not null and quality in (0, 1)")
    seen = staged(scored.where(~F.col("base_failed")).join(known, "doc_id").select("scores", "_label"), "op5-labelled")
    good = seen.where("_label = 1").count()
    refused, left = F.lit(False), max_false * good
    for k in range(len(GROUPS)):
        own = F.col("scores")[k]
        histogram = seen.where(~refused).groupBy(F.floor(own * bins).cast("int").alias("b"), "_label").count().collect()  # at most 2 * bins rows
        rest = sum(n for _, label, n in histogram if label)
        cut = calibrate([tuple(r) for r in histogram], bins, left / max(rest, 1))
        left -= sum(n for b, label, n in histogram if label and b >= cut * bins - 0.5)
        refused = refused | (own >= cut)
    return scored.withColumn("kept", ~F.col("base_failed") & ~refused).drop("scores")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = judge_quality(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")
