"""The source audit against its SQL on awkward documents, and its levels."""
import random

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from strata.llm import source_audit as sa
from strata.llm.common import texts_of

COLUMNS = ["lang", "source", "part", "item", "value", "rank"]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    words = ["The", "then", "there", "thereby", "Straße", "straßen", "a", "é", "ünïcödé", "语言文字处理系统", "语言文字处理", "x" * 300, "x" * 299 + "y", "NUL\0split", "e1e", "It's", "[brackets]", "z_z"]
    out = []
    for i in range(160):
        text = rng.choice([" ", "\n", "-", "7"]).join(rng.choices(words, k=rng.randint(1, 30)))
        out.append((i, text, rng.choice(["en", "en", "en", "de", "", None]), rng.choice(["s1", "s1", "s1", "s2", "S2", "ö", None, "zz"])))
    out += [(200, None, "en", "s9"), (201, "", "en", "empty"), (202, "12 34 !", "fr", "s1"), (203, None, "fr", None), (204, "alone", "xx", "only"), out[0], out[0]]
    return out + [(i, f"rare{chr(97 + i % 26)}{chr(97 + i % 7)} " * 3, "en", "s1") for i in range(300, 340)]


def frame(spark, rows):
    extra = [(*r, "n", 1, 2.0) for r in rows]
    return spark.createDataFrame(extra, "doc_id long, text string, lang string, source string, part string, n_docs int, value double").repartition(3)


def by_sql(rows, min_docs, top):
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(rows, columns=["doc_id", "text", "lang", "source"]))
    sql = sa.ORACLE_SQL.replace(">= 30", f">= {min_docs}").replace("rank <= 50", f"rank <= {top}")
    return sorted(con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({sql})").fetchall())


@pytest.mark.parametrize(("min_docs", "top", "block", "bits"), [(3, 50, 256, 1 << 26), (12, 4, 2, 1 << 16), (1000, 50, 3, 1 << 16)])
def test_against_sql(spark, rows, monkeypatch, min_docs, top, block, bits):
    monkeypatch.setattr(sa, "TERMS_IN_BLOCK", 5)
    got = sa.audit_sources(frame(spark, rows), min_docs, top, block, bits)
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect())) == by_sql(rows, min_docs, top)


def test_kept_terms_by_hand(spark, rows):
    docs = frame(spark, [r for r in rows if r[2] == "en"]).fillna("")
    import re

    held = {}
    for _, text, lang, _ in (r for r in rows if r[2] == "en"):
        low = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for t in set(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)):
            held[t] = held.get(t, 0) + 1
    for least in (1, 4, 30):
        got = {r["term"].decode() for r in sa.kept_terms(docs, least).collect()}
        assert got == {t for t, n in held.items() if n >= least}


def test_a_level_extends_only_what_the_filter_has():
    part = pa.record_batch({"lang": ["a", "a", "b"], "source": ["s", "t", "s"], "text": ["abcdef abcdxy abc", "abcdef abcdef", "abcdef"]})
    texts = texts_of(part.column("text"))
    run = sa._level(0, 4, None)
    first = next(iter(run([part])))
    rows = {(r["lang"], r["source"], r["term"], r["complete"]): (r["n_docs"], r["n_uses"], r["place"]) for r in first.to_pylist()}
    assert {k: v[:2] for k, v in rows.items()} == {("a", None, b"abcd", False): (2, 4), ("a", "s", b"abc", True): (1, 1), ("b", None, b"abcd", False): (1, 1)}

    class Bits:
        value = np.zeros(1024, np.uint64)

    place = rows[("a", None, b"abcd", False)][2] % 65536
    Bits.value[place // 64] |= np.uint64(1) << np.uint64(place % 64)
    second = [r for b in sa._level(4, 8, Bits)([part]) for r in b.to_pylist()]
    assert sorted((r["lang"], r["source"], r["term"], r["n_docs"], r["n_uses"]) for r in second) == [("a", "s", b"abcdef", 1, 1), ("a", "s", b"abcdxy", 1, 1), ("a", "t", b"abcdef", 1, 2)]
    assert len(texts) == 3


def test_empty_table(spark):
    assert sa.audit_sources(frame(spark, [(1, "a", "b", "c")]).where("false")).collect() == []


def test_query_equals_its_sql(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    want = con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({sa.ORACLE_SQL})").fetchall()
    got = sa.op12_source_audit(spark, sf)
    assert [t for _, t in got.dtypes] == ["string"] * 4 + ["bigint", "int"]
    assert sorted(map(tuple, got.collect())) == sorted(want)
