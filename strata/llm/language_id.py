"""Language identification: a bidirectional gated recurrent network over bytes.

The network reads a word byte by byte in both directions and gives every byte
position a probability for each language; a document's probabilities are the
pooled log probabilities of all its positions. It is written in numpy and
trained by backpropagation through time on a bounded sample of labelled
documents (``docs_per_lang`` and ``words_per_doc``); prediction reads whole
texts. Words longer than ``WINDOW`` bytes are read in windows. Equal words get
equal positions, so each distinct word of a slice is read once and counted.

Defined results: ``und`` with score 0 for a null text or one without a letter,
and for every text if no labelled row was seen; with one learned language all
texts with letters are of it; repeated rows each get their own result.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from strata.llm.common import LOWER, crc_mod, load, slices, span_hashes, texts_of, words_of

WINDOW = 24
#: Words read at once.
GROUP = 4096
#: Bytes of text worked on at once: larger slices repeat more words.
SLICE_BYTES = 2 << 20
UND = "und"
#: Sampled ids are broadcast up to this number (300 for each of 600 languages).
BROADCAST_ROWS = 180_000
#: Groups of tasks in which the documents to learn from are first ranked.
TASK_GROUPS = 64


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


class ByteBiGru:
    """Weights are plain arrays in ``w``; step functions work on (batch, units)."""

    def __init__(self, classes: int, units: int = 12, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.units, self.classes = units, classes
        normal = lambda *shape, by: rng.normal(0, by, shape).astype(np.float32)
        self.w = {"out": normal(2 * units, classes, by=0.3), "out_b": np.zeros(classes, np.float32)}
        for d in "fb":  # forward, backward
            self.w[f"x{d}"] = normal(256, 3 * units, by=0.3)  # input weights of a byte: update, reset, candidate
            self.w[f"h{d}"] = normal(units, 3 * units, by=units**-0.5)
            self.w[f"c{d}"] = np.zeros(3 * units, np.float32)

    def _run(self, d: str, bytes_: np.ndarray, live: np.ndarray, keep: bool):
        """States after each step of one direction; (steps, batch, units)."""
        steps, u = bytes_.shape[0], self.units
        wx, wh, c = self.w[f"x{d}"], self.w[f"h{d}"], self.w[f"c{d}"]
        table = wx + c
        h = np.zeros((bytes_.shape[1], u), np.float32)
        out = np.empty((steps, *h.shape), np.float32)
        saved = []
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            x = table[bytes_[t]]
            zr = _sigmoid(x[:, : 2 * u] + h @ wh[:, : 2 * u])
            z, r = zr[:, :u], zr[:, u:]
            g = np.tanh(x[:, 2 * u :] + (r * h) @ wh[:, 2 * u :])
            new = h + live[t][:, None] * z * (g - h)
            if keep:
                saved.append((t, h, z, r, g))
            out[t] = h = new
        return out, saved

    def log_probs(self, bytes_: np.ndarray, live: np.ndarray, keep: bool = False):
        """Log probability of each class at each position, (steps, batch, classes)."""
        forward, sf = self._run("f", bytes_, live, keep)
        backward, sb = self._run("b", bytes_, live, keep)
        states = np.concatenate([forward, backward], -1)
        probs = _softmax(states @ self.w["out"] + self.w["out_b"])
        return probs, states, sf, sb

    def gradients(self, bytes_: np.ndarray, live: np.ndarray, target: np.ndarray):
        """Loss over all live positions and its gradients, through time."""
        probs, states, sf, sb = self.log_probs(bytes_, live, keep=True)
        u, total = self.units, max(live.sum(), 1)
        err = probs.copy()
        err[:, np.arange(len(target)), target] -= 1
        err *= live[:, :, None] / total
        picked = probs[:, np.arange(len(target)), target]
        loss = -(np.log(np.maximum(picked, 1e-9)) * live).sum() / total
        grads = {"out": np.einsum("tbs,tbc->sc", states, err), "out_b": err.sum((0, 1))}
        back = err @ self.w["out"].T
        for d, saved, at in (("f", sf, slice(0, u)), ("b", sb, slice(u, 2 * u))):
            wh = self.w[f"h{d}"]
            gx, gh = np.zeros_like(self.w[f"x{d}"]), np.zeros_like(wh)
            dh = np.zeros_like(saved[0][1])
            for t, h, z, r, g in reversed(saved):
                dh = dh + back[t][:, at]
                on = live[t][:, None]
                dz, dg = dh * on * (g - h) * z * (1 - z), dh * on * z * (1 - g * g)
                d_rh = dg @ wh[:, 2 * u :].T
                dr = d_rh * h * r * (1 - r)
                da = np.concatenate([dz, dr, dg], 1)
                np.add.at(gx, bytes_[t], da)
                gh[:, : 2 * u] += h.T @ da[:, : 2 * u]
                gh[:, 2 * u :] += (r * h).T @ dg
                dh = dh * (1 - on * z) + da[:, : 2 * u] @ wh[:, : 2 * u].T + d_rh * r
            grads[f"x{d}"], grads[f"h{d}"], grads[f"c{d}"] = gx, gh, gx.sum(0)
        return loss, grads

    def fit(self, bytes_: np.ndarray, live: np.ndarray, target: np.ndarray, epochs: int = 3, batch: int = 256, rate: float = 0.01, seed: int = 5) -> ByteBiGru:
        """Adam over shuffled batches of words."""
        rng, step = np.random.default_rng(seed), 0
        first, second = ({k: np.zeros_like(v) for k, v in self.w.items()} for _ in range(2))
        for _ in range(epochs):
            order = rng.permutation(len(target))
            for i in range(0, len(order), batch):
                pick, step = order[i : i + batch], step + 1
                steps = int(live[:, pick].sum(0).max())
                _, grads = self.gradients(bytes_[:steps, pick], live[:steps, pick], target[pick])
                for k, g in grads.items():
                    first[k] += 0.1 * (g - first[k])
                    second[k] += 0.001 * (g * g - second[k])
                    self.w[k] -= (rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
        return self

    def word_scores(self, bytes_: np.ndarray, live: np.ndarray) -> np.ndarray:
        """Each word's log probabilities summed over its positions."""
        probs = self.log_probs(bytes_, live)[0]
        return (np.log(np.maximum(probs, 1e-6)) * live[:, :, None]).sum(0)


def _windows(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, start, length) of windows of at most WINDOW bytes."""
    n = -(-(ends - starts) // WINDOW)
    owner = np.repeat(np.arange(len(starts)), n)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    at = starts[owner] + nth * WINDOW
    return owner, at, np.minimum(ends[owner] - at, WINDOW)


def _matrix(buf: np.ndarray, at: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    steps = int(lens.max()) if len(lens) else 0
    padded = np.concatenate([buf, np.zeros(WINDOW, np.uint8)])
    live = (np.arange(steps)[:, None] < lens[None, :]).astype(np.float32)
    return padded[at[None, :] + np.arange(steps)[:, None]], live


def train(samples: list[tuple[str, str]], langs: list[str], units: int = 12, words_per_doc: int = 40, epochs: int = 4, seed: int = 3) -> dict:
    """Train on (text, lang) rows; returns plain arrays."""
    rng = np.random.default_rng(seed)
    texts = texts_of(pa.array([t for t, _ in samples], pa.string()))
    buf = LOWER[texts.buf]
    words = words_of(texts)
    picked, target = [], []
    for i, (_, lang) in enumerate(samples):
        own = np.arange(words.first[i], words.first[i + 1])
        own = rng.permutation(own)[:words_per_doc]
        picked.append(own)
        target += [langs.index(lang)] * len(own)
    picked, target = np.concatenate(picked).astype(np.int64), np.array(target)
    owner, at, lens = _windows(buf, words.starts[picked], words.ends[picked])
    net = ByteBiGru(len(langs), units, seed)
    if len(langs) > 1 and len(owner):
        net.fit(*_matrix(buf, at, lens), target[owner], epochs=epochs)
    return net.w


def _predict(shared, langs: list[str], units: int, drop: tuple[str, ...] = ("text",), names: tuple[str, str] = ("lang_pred", "score")):
    """Adds the language and its probability to a batch's columns but for ``drop``."""

    def run(batches):
        net = ByteBiGru(len(langs), units)
        net.w = shared.value
        for batch in batches:
            for part, texts in slices(batch, limit=SLICE_BYTES):
                buf = LOWER[texts.buf]
                words = words_of(texts)
                _, where, inverse = np.unique(span_hashes(buf, words.starts, words.ends), return_index=True, return_inverse=True)
                owner, at, lens = _windows(buf, words.starts[where], words.ends[where])
                order = np.argsort(lens, kind="stable")  # windows of like length go together
                scores = np.zeros((len(owner), len(langs)), np.float64)
                for i in range(0, len(order), GROUP):
                    pick = order[i : i + GROUP]
                    scores[pick] = net.word_scores(*_matrix(buf, at[pick], lens[pick]))
                by_word = np.column_stack([np.bincount(owner, scores[:, k], len(where)) for k in range(len(langs))])
                rows = words.rows
                pooled = np.column_stack([np.bincount(rows, by_word[inverse, k], len(texts)) for k in range(len(langs))])
                probs = _softmax(pooled)
                best = probs.argmax(1)
                kept = [c for c in part.schema.names if c not in drop]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), pa.array([langs[k] for k in best], pa.string()), pa.array(probs.max(1))], [*kept, *names])

    return run


def fit_language_model(docs: DataFrame, docs_per_lang: int = 300, units: int = 12, words_per_doc: int = 40, epochs: int = 4) -> tuple[dict, list[str]]:
    """Train on documents outside the held-out fifth. The sample holds the
    ``docs_per_lang`` documents of each language with the smallest id hash."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (crc_mod("doc_id", 5) != 0))
    # the smallest of some tasks first, so no task meets those of every task
    ids = known.select("doc_id", "lang", (F.spark_partition_id() % TASK_GROUPS).alias("tasks"))
    for group in (["lang", "tasks"], ["lang"]):
        nth = F.row_number().over(Window.partitionBy(*group).orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id"))
        ids = ids.withColumn("nth", nth).where(F.col("nth") <= docs_per_lang).drop("nth")
    chosen = ids.collect()  # docs_per_lang for each language
    langs = sorted({r["lang"] for r in chosen})
    if not langs:
        return {}, []
    wanted = docs.sparkSession.createDataFrame([(r["doc_id"], r["lang"]) for r in chosen], "doc_id long, lang string").distinct()
    if len(chosen) <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)  # then the texts are read in the scan and not shuffled
    # of rows that share id and language one text is learned from
    rows = known.select("doc_id", "lang", "text").join(wanted, ["doc_id", "lang"]).groupBy("doc_id", "lang").agg(F.min("text").alias("text")).collect()
    samples = sorted((r["doc_id"], r["text"], r["lang"]) for r in rows)
    return train([(t, lang) for _, t, lang in samples], langs, units, words_per_doc, epochs), langs


def identify_languages(docs: DataFrame, units: int = 12, **training) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document."""
    weights, langs = fit_language_model(docs.select("doc_id", "text", "lang"), units=units, **training)
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    rows = docs.select("doc_id", "text", (crc_mod("doc_id", 5) == 0).alias("held_out"), letters.alias("letters"))
    if not langs:
        return rows.select("doc_id", "held_out", F.lit(UND).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # a few thousand numbers
    found = rows.mapInArrow(_predict(shared, langs, units), "doc_id long, held_out boolean, letters boolean, lang_pred string, score double")
    return found.select("doc_id", "held_out", F.when(F.col("letters"), F.col("lang_pred")).otherwise(UND).alias("lang_pred"), F.when(F.col("letters"), F.col("score")).otherwise(0.0).alias("score"))


def with_language(docs: DataFrame, names: tuple[str, str], units: int = 12, **training) -> DataFrame:
    """All rows and columns, and the predicted language and its probability
    under the given names, found where the row is: nothing is joined by id."""
    weights, langs = fit_language_model(docs.select("doc_id", "text", "lang"), units=units, **training)
    if not langs:
        return docs.withColumns({names[0]: F.lit(UND), names[1]: F.lit(0.0)})
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    schema = T.StructType([*docs.schema.fields, T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())])
    found = docs.mapInArrow(_predict(shared, langs, units, (), names), schema)
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return found.withColumns({names[0]: F.when(letters, F.col(names[0])).otherwise(UND), names[1]: F.when(letters, F.col(names[1])).otherwise(0.0)})


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(load(spark, sf_dir, "documents"))
