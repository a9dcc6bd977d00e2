"""The pipeline's stages against brute force on the smallest tables."""
from __future__ import annotations

import itertools
import re

import pytest

import corpus_pipeline
from tests.llm.test_operators import reachable, shingles, words

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Each stage's rows, written and read again as the check does."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, fn in corpus_pipeline.STAGES:
        fn(spark, out[-1], SF).write.parquet(f"{folder}/{name}")
        out.append(spark.read.parquet(f"{folder}/{name}"))
    return out


def test_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "decontamination", "personal_data", "packing"]
    assert all(s.columns == stages[0].columns for s in stages[:-1])


def test_stages_keep_what_they_should(spark, stages):
    text = [{r["doc_id"]: r["text"] for r in s.collect()} for s in stages[:-1]]
    assert {i for i, t in text[0].items() if re.search(r"[^\W\d_]", t or "")} == set(text[1])
    sets = {i: shingles(t) for i, t in text[1].items()}
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    root = reachable(sets, links)
    assert set(text[2]) == {i for i in sets if root[i] == i}
    items = [shingles(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    held = {i for i in text[2] if any(q and len(q & sets[i]) >= 0.75 * len(q) for q in items)}
    assert set(text[3]) == set(text[2]) - held
    assert set(text[4]) == set(text[3])
    for i, t in text[4].items():
        assert not re.search(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)
        if not re.search(r"[0-9@=:]", text[3][i]):
            assert t == text[3][i] and words(t)
    assert {r["doc_id"] for r in stages[5].select("doc_id").distinct().collect()} == set(text[4])
    assert all(r["n_chars"] == len(r["text"]) for r in stages[4].collect())


def test_run_gives_the_rows_of_the_stages(spark, stages):
    key = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    whole = corpus_pipeline.run(spark, SF)
    assert whole.count() > 0 and set(key) <= set(whole.columns)
    assert whole.agg({"length": "sum"}).first()[0] == stages[5].agg({"length": "sum"}).first()[0]


def test_rows_that_share_an_id(spark):
    """They are near copies only if their texts are."""
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(80)) for x in "abcd")
    data = [(1, a), (1, b), (1, a), (2, a + " more"), (3, b), (4, c), (5, c + " more"), (5, d), (6, d), (7, ""), (None, "none " + d[3:] + " none")]
    docs = spark.createDataFrame([(i, t, len(t)) for i, t in data], "doc_id long, text string, n_chars long").repartition(3)
    got = corpus_pipeline.near_duplicates(spark, docs, SF)
    assert got.columns == docs.columns
    assert sorted((r["doc_id"], r["text"]) for r in got.collect()) == [(1, a), (1, b), (4, c), (5, d), (7, "")]


AWKWARD = "doc_id long, text string, lang string, source string, n_chars int, removed string, _set long, shingle_set int, score string, found_lang string, kept_id long, letters int, held_out string, lang_pred string"


def awkward(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", len(t or ""), "r", 1, 2, "x", "y", 3, 4, "h", "l") for i, t, lang in rows], AWKWARD)


def test_stages_on_awkward_rows(spark, tmp_path):
    say = lambda c, n=40: " ".join(f"{c}{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(n))
    passage = "a passage of the benchmark that is long enough to be found by its shingles in any document at all"
    spark.createDataFrame([(1, passage), (2, "five small words stand here"), (3, None), (4, " ")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [
        (1, say("x"), "en"), (1, "123 456", "en"), (1, say("q") + " " + passage, "en"), (None, say("n"), "en"), (None, None, None), (3, "", "de"), (4, " \n", None),
        (5, say("x") + " more", "en"), (6, "before five small words stand here after " + say("s"), "en"), (7, say("z", 9000), "de"), (8, "12", "de"), (None, passage, "en"), (9, say("u"), None), (9, say("u"), None),
        (None, say("w"), "de"), (10, say("w") + " on", "de"), (None, say("v"), "de"),
    ]
    docs = awkward(spark, rows).repartition(3)
    pick = lambda df: sorted((r["doc_id"] or 0, r["text"] or "") for r in df.collect())

    kept = corpus_pipeline.language_id(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns and kept.schema == docs.schema
    assert pick(kept) == sorted((i or 0, t) for i, t, _ in rows if re.search("[a-z]", t or ""))  # by row: the other rows of id 1 and without id stay

    single = corpus_pipeline.near_duplicates(spark, docs, str(tmp_path))
    assert single.columns == docs.columns
    gone = [(5, rows[7][1]), (9, say("u")), (0, say("w"))]  # near copy of 1, repeated row, near copy of 10 that has no id
    want = sorted((i or 0, t or "") for i, t, _ in rows)
    for x in gone:
        want.remove(x)
    assert pick(single) == want

    clean = corpus_pipeline.decontamination(spark, docs, str(tmp_path))
    assert clean.columns == docs.columns
    assert pick(clean) == sorted((i or 0, t or "") for i, t, _ in rows if passage not in (t or "") and "five small words stand here" not in (t or ""))

    private = corpus_pipeline.personal_data(spark, docs, str(tmp_path))
    assert private.columns == docs.columns and pick(private) == sorted((i or 0, t or "") for i, t, _ in rows)
    pieces = corpus_pipeline.packing(spark, docs, str(tmp_path)).collect()
    assert len({(r["sequence_id"], r["offset"]) for r in pieces}) == len(pieces) >= len(rows)


def test_stages_on_an_empty_table(spark):
    docs = awkward(spark, [(1, "x", "en")]).where("false")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.collect() == [], name
        if name != "packing":
            assert out.columns == docs.columns


def test_scratch_of_a_stage_is_deleted_and_its_result_is_not(spark):
    from strata.llm.common import staged, staged_alone
    from strata.session import path_exists

    paths = []

    def build():
        one = staged(spark.range(5), "one")
        paths.extend({f.rsplit("/", 1)[0] for f in one.inputFiles()})
        two, path = staged_alone(spark, lambda: staged(one, "inner").where("id > 1"), "two")
        paths.append(path)
        return two.where("id > 2")

    out, path = staged_alone(spark, build, "out")
    assert sorted(r["id"] for r in out.collect()) == [3, 4]
    assert path_exists(spark, path) and not any(path_exists(spark, p) for p in paths)
