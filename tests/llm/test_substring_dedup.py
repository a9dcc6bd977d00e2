"""Repeated lines, rows that share a doc_id, clashing names, and the query itself, against brute force."""
from __future__ import annotations

import random
import re

from strata.llm import substring_dedup

ENDS = re.compile(r"[^\x20\x09-\x0D]+")


def expected(rows, min_words, min_line_words):
    """Stretches by the definition, for texts that are distinct within a doc_id."""
    spans = [[(m.start(), m.end(), m.group().lower()) for m in ENDS.finditer(t or "")] for _, t in rows]
    lines = []
    for (_, text), words in zip(rows, spans, strict=True):
        groups: dict = {}
        for k, (start, _, _) in enumerate(words):
            groups.setdefault((text or "").count("\n", 0, start), []).append(k)
        lines.append([(g[0], g[-1] + 1) for g in groups.values() if len(g) >= min_line_words])
    windows = [[(k, k + min_words) for k in range(len(w) - min_words + 1)] for w in spans]
    out = []
    order = lambda i: (rows[i][0], substring_dedup_hash[rows[i][1]])
    firsts = [{}, {}]
    ranked = sorted((i for i in range(len(rows)) if rows[i][0] is not None and rows[i][1] is not None), key=order)
    for i in ranked:
        gone = set()
        for seen, units, reach in zip(firsts, (lines[i], windows[i]), (1, min_words), strict=True):
            for a, b in units:
                f, at = seen.setdefault(tuple(x[2] for x in spans[i][a:b]), (i, a))
                if f != i or a >= at + reach:
                    gone |= set(range(a, b))
        stretches = []
        for k in sorted(gone):
            if stretches and stretches[-1][1] == k:
                stretches[-1][1] = k + 1
            else:
                stretches.append([k, k + 1])
        out += [(rows[i][0], spans[i][a][0], spans[i][b - 1][1], b - a) for a, b in stretches]
    return sorted(out)


substring_dedup_hash: dict = {}


def learn_hashes(spark, rows):
    df = spark.createDataFrame([(t,) for t in {t for _, t in rows if t is not None}], "text string")
    substring_dedup_hash.update({r["text"]: r["h"] for r in df.selectExpr("text", "xxhash64(text) h").collect()})


def test_repeated_lines_and_shared_ids(spark):
    rng = random.Random(31)
    say = lambda n: " ".join(f"{rng.choice('xyz')}{rng.randrange(10**7)}" for _ in range(n))
    notice = "cookies help us to show you more of this site"  # 10 words, a line of its own
    passage, p2 = say(34), say(52)
    rows = [(i, f"{say(rng.randrange(3, 50))}\n{notice if i % 2 else notice.upper()}  \n{say(9)}") for i in range(50)]
    rows += [
        (100, passage), (101, f"x y z {passage} end"), (101, say(60)), (101, f"{say(8)}\n{passage}"), (102, p2), (102, "é " + p2), (103, "a b c d\n" * 5), (104, "a b c d e\n" * 3), (105, "w " * 90),
        (106, "one\n" * 40), (107, None), (108, ""), (None, passage), (109, say(300) + "\n" + notice + "\n" + say(300) + " " + p2),
    ]
    learn_hashes(spark, rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for parts in (1, 5):
        got = sorted(tuple(r) for r in substring_dedup.repeated_stretches(docs.repartition(parts)).select("doc_id", "start", "stop", "words").collect())
        assert got == expected(rows, substring_dedup.MIN_WORDS, substring_dedup.MIN_LINE_WORDS)
    # rows of one id: only the text that holds the passage is cut
    left = sorted(len((r["text"] or "").split()) for r in substring_dedup.dedup_passages(docs).where("doc_id = 101").collect())
    assert left == [4, 8, 60]
    assert sum(notice in (r["text"] or "").lower() for r in substring_dedup.dedup_passages(docs).collect()) == 1


def test_names_and_repeated_rows(spark):
    text = " ".join(f"t{i}" for i in range(40))
    rows = [(1, text, "a", 7), (1, text, "b", 8), (2, text, "c", 9), (2, text, "d", 9), (3, None, "e", 1)]
    out = substring_dedup.dedup_passages(spark.createDataFrame(rows, "doc_id long, text string, removed string, text_hash long"))
    assert out.columns == ["doc_id", "text", "removed", "text_hash", "removed_"]
    assert sorted((r["removed"], r["text"], r["text_hash"]) for r in out.collect() if r["text"] is not None) == [("a", text, 7), ("b", text, 8), ("c", "", 9), ("d", "", 9)]


def test_the_query_on_a_table(spark, tmp_path):
    rng = random.Random(8)
    vocabulary = [f"v{i}" for i in range(300)]
    line = lambda: " ".join(rng.choices(vocabulary, k=rng.randrange(1, 60)))
    shared = [line() for _ in range(12)]
    rows = [(i, rng.choice([" ", "\n"]).join(rng.choice([rng.choice(shared), line()]) for _ in range(rng.randrange(9)))) for i in range(160)]
    learn_hashes(spark, rows)
    spark.createDataFrame(rows, "doc_id long, text string").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((r["doc_id"], x["start"], x["stop"]) for r in substring_dedup.op8_substring_dedup(spark, str(tmp_path)).collect() for x in r["removed"])
    want = [x[:3] for x in expected(rows, substring_dedup.MIN_WORDS, substring_dedup.MIN_LINE_WORDS)]
    assert got == want and len(want) > 50
