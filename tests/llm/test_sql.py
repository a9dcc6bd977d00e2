"""The SQL of op3 and op10 gives what the operators give, on awkward rows too."""
import random

import duckdb
import pytest

from strata.llm import decontamination, jaccard_join
from strata.llm.decontamination import contained_items
from strata.llm.jaccard_join import jaccard_components


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(7)
    word = lambda: "w%d" % rng.randrange(4000)
    items = [" ".join(word() for _ in range(n)) for n in (5, 6, 9, 30, 90, 200)]
    texts = [None, "", " \n\t", "one", "one", "ONE two", "one two three four five", "One  two\tthree FOUR five", "é É x y z"]
    for item in items:
        filler = " ".join(word() for _ in range(300))
        texts += [f"{filler} {item} {filler[:200]}", f"{filler} {item.upper()}", item]
    base = [word() for _ in range(120)]
    for changes in (0, 1, 2, 3, 4, 6, 20):  # a chain of near copies, some only linked through others
        copy = list(base)
        for place in rng.sample(range(120), changes):
            copy[place] = word()
        texts += [" ".join(copy), " ".join(copy)]
        base = copy if changes in (2, 4) else base
    docs = spark.createDataFrame([(i * 3 % 1009, t) for i, t in enumerate(texts)], "doc_id long, text string")
    bench = spark.createDataFrame([(i, t) for i, t in enumerate([*items, items[0], None, "", "one", "absent words all of them"])], "item_id long, text string")
    return docs, bench


def _sql(text, **frames):
    con = duckdb.connect()
    for name, df in frames.items():
        con.register(name, df.toPandas())
    return sorted(con.execute(text).fetchall())


def test_containment_sql(tables):
    docs, bench = tables
    found = sorted(tuple(r) for r in contained_items(docs, bench).collect())
    assert found == _sql(decontamination.ORACLE_SQL, documents=docs, benchmark=bench)
    assert {item for _, item, _ in found} == {0, 1, 2, 3, 4, 5, 6, 9}


def test_jaccard_sql(tables):
    docs, _ = tables
    found = sorted(tuple(r) for r in jaccard_components(docs).select("doc_id", "n_shingles", "component_id").collect())
    assert found == _sql(jaccard_join.ORACLE_SQL, documents=docs)
    assert len({c for _, _, c in found}) < len(found) - 8
