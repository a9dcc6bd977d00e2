"""The factorisation machine: its identity, its gradients, held-out accuracy, awkward rows."""
import zlib

import numpy as np
import pyarrow as pa
import pytest

from strata.llm import quality_fm as fm
from strata.llm.common import texts_of

SF = "/root/testdata/sf0.01"


def machine(inputs=9, factors=3):
    m = fm.FactorisationMachine(inputs, factors, seed=2)
    rng = np.random.default_rng(4)
    m.bias[:], m.weights[:], m.vectors[:] = 0.3, rng.normal(size=inputs), rng.normal(size=(inputs, factors))
    return m


ROWS, COLUMNS, VALUES = np.array([0, 0, 0, 2, 2, 3]), np.array([1, 4, 8, 0, 4, 4]), np.array([0.5, -1.0, 2.0, 1.5, 0.25, 3.0])


def test_linear_time_sum_equals_the_sum_over_pairs():
    m = machine()
    odds, _ = m.raw(ROWS, COLUMNS, VALUES, 4)
    for r in range(4):
        c, x = COLUMNS[ROWS == r], VALUES[ROWS == r]
        pairs = sum(m.vectors[c[i]] @ m.vectors[c[j]] * x[i] * x[j] for i in range(len(c)) for j in range(i))
        assert odds[r] == pytest.approx(0.3 + m.weights[c] @ x + pairs)


def test_gradients_against_finite_differences():
    m, target = machine(), np.array([1.0, 0.0, 0.0, 1.0])
    _, (bias, weights, vectors), seen = m.gradients(ROWS, COLUMNS, VALUES, target, 0.01)
    loss = lambda: m.gradients(ROWS, COLUMNS, VALUES, target, 0.01)[0]
    spots = [(m.bias, (0,), bias[0])] + [(m.weights, (c,), weights[i]) for i, c in enumerate(seen)]
    spots += [(m.vectors, (c, f), vectors[i, f]) for i, c in enumerate(seen) for f in range(3)]
    for array, at, want in spots:
        old = array[at]
        array[at] = old + 1e-5
        up = loss()
        array[at] = old - 1e-5
        down = loss()
        array[at] = old
        assert (up - down) / 2e-5 == pytest.approx(want, abs=1e-6)


def test_learns_what_no_single_input_tells():
    rng = np.random.default_rng(8)
    signs = rng.choice([-1.0, 1.0], (1500, 2))
    target = (signs[:, 0] * signs[:, 1] > 0).astype(float)
    rows = [(np.array([0, 1]), s) for s in signs]
    m = fm.FactorisationMachine(2, 4).fit(rows[:1000], target[:1000], epochs=10)
    odds, _ = m.raw(np.repeat(np.arange(500), 2), np.tile([0, 1], 500), signs[1000:].ravel(), 500)
    assert ((odds > 0) == (target[1000:] > 0)).mean() > 0.98


def test_features_by_hand():
    texts = texts_of(pa.array(["Ab ab. C1\n", None, "é! é?"]))
    rows, buckets, values, stats = fm.text_features(texts, np.array([np.nan, 7.0, 5.0]))
    assert list(np.bincount(rows, minlength=3)) == [3, 0, 2]
    assert np.bincount(rows, values**2, 3) == pytest.approx([1, 0, 1])
    assert ((buckets >= 0) & (buckets < fm.BUCKETS)).all()
    assert stats[0] == pytest.approx([np.log(4), 7 / 3, 1, 2 / 10, 1 / 10, 0, 1 / 3, 1 / 3, 3 / 10, 0, np.log(11), 0])
    assert stats[1] == pytest.approx([0, 0, 0, 0, 0, 0, 0, 0, 0, 0, np.log(8), 1])
    assert stats[2][9] == pytest.approx(4 / 7) and stats[2][11] == 0


def test_query_predicts_held_out_labels(spark):
    out = fm.op13_quality_classifier(spark, SF)
    assert out.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    got = {r["doc_id"]: r for r in out.collect()}
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for i, r in got.items())
    labels = [r for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if got[r["doc_id"]]["held_out"]]
    right = [r["quality"] == got[r["doc_id"]]["predicted"] for r in labels]
    bad = [got[r["doc_id"]]["predicted"] == 0 for r in labels if r["quality"] == 0]
    assert np.mean(right) > 0.95 and np.mean(bad) > 0.85


def test_awkward_rows(spark):
    schema = "doc_id long, text string, lang string, label string, score string, values int, held_out string, n_chars int"
    good, bad = "plain words in a row that say something.", "### $$$ *** ### x"
    rows = [(i, (good if i % 2 else bad) + f" {i % 5}", "en", "l", "s", 1, "h", None) for i in range(60)]
    rows += [(None, good, None, None, None, None, None, 3), (70, None, "en", "l", "s", 1, "h", -4), (71, "", "en", "l", "s", 1, "h", 0), (72, "w " * 200_000, "en", "l", "s", 1, "h", 10), rows[3], rows[3]]
    docs = spark.createDataFrame(rows, schema).repartition(2)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)] + [(None, 1, 0), (3, None, 0), (5, 7, 0), (1, 1, 1), (999, 0, 0)], "doc_id long, quality int, toxic int")
    got = fm.score_quality(docs, labels).collect()
    assert len(got) == len(rows)
    assert all(r["predicted"] == r["doc_id"] % 2 for r in got if r["doc_id"] is not None and r["doc_id"] < 60)
    assert len({r["score"] for r in got if r["doc_id"] == 3}) == 1
    again = fm.score_quality(docs.repartition(5), labels).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))
    # neither learned from nor read: other labels, lang, and held-out documents' labels
    flipped = labels.selectExpr("doc_id", "case when crc32(cast(cast(doc_id as string) as binary)) % 3 = 1 then 1 - quality else quality end as quality", "toxic")
    assert sorted(map(repr, fm.score_quality(docs.selectExpr("doc_id", "text", "n_chars", "'xx' as lang"), flipped).collect())) == sorted(map(repr, got))
    only = fm.score_quality(docs, labels.where("quality = 1")).collect()
    assert len({r["score"] for r in only}) == 1 and only[0]["score"] > 0.9
    assert {r["score"] for r in fm.score_quality(docs, labels.where("false")).collect()} == {0.5}
    assert fm.score_quality(docs.where("false"), labels).collect() == []
