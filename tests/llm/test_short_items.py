"""Items of few shingles are all found, wherever they stand in a long document."""
import random

from strata.llm import decontamination


def test_verbatim_items_of_five_and_six_words(spark):
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(3000)]
    items, docs = [], []
    for n in range(400):
        size = 5 if n < 200 else 6
        item = " ".join(f"item{n}x{k}" for k in range(size))
        text = rng.choices(vocabulary, k=1500)
        at = rng.randrange(1500)
        items.append((n, item))
        docs.append((n, " ".join([*text[:at], item, *text[at:]])))
    found = decontamination.contained_items(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(4), spark.createDataFrame(items, "item_id long, text string")
    ).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in found) == [(n, n) for n in range(400)]
    assert all(r["containment"] == 1.0 for r in found)
