"""What a worker takes to describe and cut the sets of many texts at once."""
import tracemalloc

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard

from strata.llm import jaccard_join as j


def _batch(n: int = 4_000) -> pa.RecordBatch:
    r = np.random.default_rng(5)
    words = np.array([f"word{i}" for i in range(5_000)])
    texts = [" ".join(words[r.integers(0, 5_000, 140)]) for _ in range(n)]
    return pa.record_batch({"doc_id": np.arange(n), "text": pa.array([*texts[:-2], None, texts[0]])})


def test_a_worker_takes_little_memory_for_the_sets_of_a_batch():
    batch = _batch()
    tracemalloc.start()
    try:
        rows = sum(b.num_rows for b in j._describe([batch]))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows == batch.num_rows + j.RANGES
    # the sketch takes 16 MB of it; the sets of all 4.7 MB at once, and a sketch for each slice, took 71 MB
    assert peak < 50 << 20


def test_the_sketch_counts_every_shingle_of_every_set():
    batch = _batch(1_500)
    out = pa.Table.from_batches(j._describe([batch]))
    packed = out.filter(pc.is_valid(out["part"])).sort_by("part")["counts"].to_pylist()
    counts = np.concatenate([np.frombuffer(zstandard.ZstdDecompressor().decompress(x), np.uint32) for x in packed])
    _, hashes, offsets, fps = j._sets(j.slices(batch, limit=1 << 30).__next__()[1])
    assert (counts == np.bincount(j._counter(hashes), minlength=j.SKETCH)).all()
    of_rows = out.filter(pc.is_null(out["part"]))
    assert of_rows["fp"].to_pylist() == fps.tolist() and of_rows["n"].to_pylist() == np.diff(offsets).tolist()
