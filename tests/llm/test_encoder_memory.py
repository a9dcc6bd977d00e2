"""What a worker takes to tokenise many texts, and what it is sent at once."""
import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from strata.llm import bit_planes, packing, tokens
from strata.session import session_conf

KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def _batch(n: int = 1_600) -> pa.RecordBatch:
    r = np.random.default_rng(7)
    words = np.array([f"{a}{b}" for a in ("un", "for", "Data", "x") for b in r.integers(0, 1 << 40, 40_000)])
    texts = [" ".join(words[r.integers(0, len(words), 170)]) for _ in range(n)]
    return pa.record_batch({"doc_id": np.arange(n), "text": pa.array([*texts[:-2], None, texts[0]])})


@pytest.fixture
def one_task(monkeypatch):
    for module in (packing, bit_planes):
        monkeypatch.setattr(module, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))


@pytest.mark.parametrize("run", [lambda p: packing._tokenise(p, 1), lambda p: bit_planes._write_shard(p, 0, 65_536, False)], ids=["op6", "op7"])
def test_a_worker_takes_little_memory_to_tokenise_a_batch(one_task, run):
    batch = _batch()
    assert batch.nbytes > 3 << 20
    tracemalloc.start()
    try:
        rows = sum(b.num_rows for b in run(tokens.tokenizer_path())([batch]))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows >= batch.num_rows
    # 24 MB; 63 MB with all 4 MB of text at once
    assert peak < 40 << 20


def test_ids_are_those_of_whole_texts_whatever_the_slices(one_task):
    from tokenizers import Tokenizer

    batch = _batch(700)
    assert batch.nbytes > tokens.TEXT_BYTES
    out = pa.Table.from_batches(packing._tokenise(tokens.tokenizer_path(), 1)([batch]))
    whole = Tokenizer.from_file(tokens.tokenizer_path())
    want = [np.array([*whole.encode(t or "", add_special_tokens=False).ids, 1], "<u4").tobytes() for t in batch.column("text").to_pylist()]
    assert out["ids"].to_pylist() == want and out["doc_id"].to_pylist() == batch.column("doc_id").to_pylist()
    assert out["local"].to_pylist() == np.cumsum([0, *(len(x) // 4 for x in want)])[:-1].tolist()


def test_the_tokenizer_gets_few_strings_at_once():
    encoder, seen = tokens.Encoder(tokens.tokenizer_path()), []
    real = encoder._tokenizer
    encoder._tokenizer = SimpleNamespace(encode_batch_fast=lambda some, **how: seen.append(sum(map(len, some))) or real.encode_batch_fast(some, **how))
    texts = next(packing.slices(_batch(700)))[1]
    encoder.encode(texts)
    assert len(seen) > 1 and max(seen) < len(texts.buf) / 2


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_every_stage_sends_small_batches(spark, tmp_path, name):
    docs = spark.range(1_500).select(F.col("id").alias("doc_id"), F.repeat(F.concat(F.lit("text "), "id", F.lit(" ")), 1_500).alias("text"), F.lit("en").alias("lang")).coalesce(1)
    spark.createDataFrame([(1, "some words that no document here has")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    with session_conf(spark, {KEY: str(64 << 20)}):  # put back as it was afterwards
        spark.conf.unset(KEY)
        dict(corpus_pipeline.STAGES)[name](spark, docs.limit(3), str(tmp_path))
        sizes = docs.mapInArrow(lambda batches: (pa.record_batch({"size": [b.nbytes]}) for b in batches), "size long").collect()
        assert len(sizes) > 1 and max(r["size"] for r in sizes) < 9 << 20


def test_a_size_that_was_set_is_kept(spark):
    with session_conf(spark, {KEY: "1234567"}):
        packing.pack(spark.createDataFrame([(1, "a b")], "doc_id long, text string"))
        assert spark.conf.get(KEY) in ("1234567", "1234567b")


@pytest.mark.parametrize("n", [0, 1, 5_000])
def test_distinct_keys_with_their_first_places(n):
    keys = np.random.default_rng(2).integers(0, 900, n).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for got, want in zip(tokens._distinct(keys), np.unique(keys, return_index=True, return_inverse=True), strict=True):
        assert got.tolist() == want.tolist()
