"""op1's documents are read as often whatever the filter's size, and its
segments stay bounded whatever documents ask for."""
import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from strata.llm import ngram_lm

SCHEMA = "doc_id long, text string"


def held(i):
    return zlib.crc32(str(i).encode()) % 10 == 0


def by_hand(data):
    """Scores by interpolated absolute discounting over quantised counts."""
    rough = lambda n: float(ngram_lm.expected(ngram_lm.level(np.array([n])))[0]) if n else 0.0
    tokens = {i: [*t.split(), 0] for i, t in data}
    train = [t for i, t in tokens.items() if not held(i)]
    seen, pairs = Counter(itertools.chain(*train)), Counter(p for t in train for p in itertools.pairwise([None, *t]))
    uses, followers = Counter(), Counter()
    for (h, _), n in pairs.items():
        uses[h] += n
        followers[h] += 1
    floor = sum(seen.values()) + 0.1 * (len(seen) + 1)

    def p(h, w):
        base = (seen[w] + 0.1) / floor
        if not uses[h]:
            return base
        total = max(rough(uses[h]), rough(followers[h]))
        rest = min(max(ngram_lm.DISCOUNT * rough(followers[h]) / total, 1e-3), 1)
        return min(max(rough(pairs[h, w]) - ngram_lm.DISCOUNT, 0) / total + rest * base, 1)

    return {i: sum(math.log10(p(h, w)) for h, w in itertools.pairwise([None, *t])) for i, t in tokens.items()}


def rows():
    """A word for a third of the training text, and another that only the
    documents kept out of training repeat."""
    rng = random.Random(47)
    common = {False: "the", True: "zebra"}
    return [(i, " ".join(common[held(i)] if k % 3 == 0 else f"v{int(rng.paretovariate(0.6)) % 700}" for k in range(120))) for i in range(150)]


def scored(df):
    return {r["doc_id"]: r["score"] for r in df.collect()}


def test_documents_meet_the_filter_once(spark):
    docs = spark.createDataFrame(rows(), SCHEMA)
    in_blocks = ngram_lm.score_documents(docs, block_bytes=200)
    assert in_blocks._jdf.queryExecution().optimizedPlan().toString().count("FlatMapGroupsInArrow") == 1
    assert scored(in_blocks) == scored(ngram_lm.score_documents(docs))


@pytest.mark.parametrize("hot_tokens", [20, ngram_lm.HOT_TOKENS])
def test_scores_over_many_segments(spark, monkeypatch, hot_tokens):
    monkeypatch.setattr(ngram_lm, "SEGMENT_TOKENS", 64)  # some 280 segments, several chunks
    monkeypatch.setattr(ngram_lm, "CHUNK_BYTES", 8 << 10)
    data = rows()
    want = by_hand(data)
    got = scored(ngram_lm.score_documents(spark.createDataFrame(data, SCHEMA).repartition(3), hot_tokens=hot_tokens))
    # an error of the filter raises a level here and there
    assert got.keys() == want.keys()
    assert np.median([abs(got[i] / want[i] - 1) for i in want]) < 0.005 and all(got[i] == pytest.approx(want[i], rel=0.05) for i in want)


def test_pairs_of_a_word_frequent_out_of_training_are_dealt_out():
    rng = np.random.default_rng(5)
    word = np.uint64(4242)
    begin = np.full(80_000, word, np.uint64)
    pairs = ngram_lm._pair(begin, rng.integers(1, 2**63, len(begin)).astype(np.uint64))
    hot = ngram_lm.Frequent(np.array([word]), np.array([0]), 1000, asked=np.array([80_000]))
    assert np.bincount(hot.segments(begin, pairs, 64)).max() < 80_000 / 10


def test_no_training_token(spark):
    """Rows without an id are kept out: every score is that of the empty model."""
    docs = spark.createDataFrame([(None, "a b a c " * 30), (None, ""), (None, None), (None, "a b a c " * 30)], SCHEMA)
    for hot_tokens in (20, ngram_lm.HOT_TOKENS):
        got = ngram_lm.score_documents(docs, hot_tokens=hot_tokens).collect()
        assert sorted(r["n_tokens"] for r in got) == [1, 1, 121, 121]
        assert all((r["held_out"], r["train_tokens"], r["n_known"]) == (True, 0, 0) and r["score"] == pytest.approx(0) and r["base_score"] == pytest.approx(0) for r in got)
