"""Substring dedup by hashing of lines, and of word windows across them.

A line is normalised (A-Z lower-cased, white space runs as one) and hashed;
digests are grouped over all documents, the earliest occurrence by (doc_id,
text, place) keeps its text, and every later line of at least
``min_line_words`` words goes; shorter ones are too common to mean anything.

A passage that begins or ends inside a line is found by its words: every
window of ``min_words`` words that stands at an earlier place already is
removed, so a passage goes from its first to its last common word. To compare
windows only where something repeats, each is known by its anchor, the
smallest hash among the runs of about half as many words in it. Equal windows
have equal anchors, so windows whose anchor stands in one place only are passed
over and none that repeats is lost. A text that equals an earlier one goes
whole and has no windows of its own. Within a document a window that overlaps
its own earliest occurrence stays. Overlapping and adjoining stretches are
merged and reported with their offsets (code points) in the original text.

Occurrences are compared in two rounds (lines, whole texts and anchors; then
windows). A round is one shuffle by digest of narrow rows, sorted there and
read through in batches with one row carried over, so the occurrences of a
digest need not fit in memory. A task settles what repeats within a slice of
its texts by itself and ships a digest once for each slice: a digest that a
third of all units share is not a third of the shuffled rows.

Defined results: a null or empty text has no units; rows are told apart by
doc_id and text, so rows that share a doc_id are judged each by its own text,
while rows equal in both are each other's earliest occurrence and get the same
verdict; rows without a doc_id are never removed from, nor compared with; an
empty table gives an empty result; other columns are passed through, whatever
their names (see ``dedup_passages`` on a column named ``removed``).
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.llm.common import Texts, Words, delete_folder, load, mix, salted, slices, span_hashes, staged, staged_alone, text_rows, unused_name, window_hashes, words_of

MIN_WORDS = 30
MIN_LINE_WORDS = 5

ANCHOR, LINE, WHOLE, WINDOW = range(4)
#: An occurrence: its digest, its row (doc_id and hash of the text), its first
#: word. ``known``: settled within the slice, passed through. ``words`` and the
#: offsets are given from the second round on.
_PLACES = "digest long, doc_id long, text_hash long, word int, kind int, known boolean"
_SPANS = _PLACES + ", words int, start int, stop int"
_KEY = ("digest", "doc_id", "text_hash", "word")


def _code_points(texts: Texts) -> np.ndarray:
    """Code points before each byte of the buffer."""
    return np.concatenate([[0], np.cumsum((texts.buf & 0xC0) != 0x80)])


def _sequence_digests(hashes: np.ndarray, first: np.ndarray, size: np.ndarray, salt: int) -> np.ndarray:
    """A fingerprint of each of the sequences of words that adjoin from ``first`` on."""
    place = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    index = np.repeat(first, size) + place
    with np.errstate(over="ignore"):
        terms = mix(hashes[index] + salted(place.astype(np.uint64), 9))
        total = np.concatenate([[np.uint64(0)], np.cumsum(terms, dtype=np.uint64)])
        ends = np.cumsum(size)
        return salted(total[ends] - total[ends - size] + size.astype(np.uint64), salt)


def lines_of(texts: Texts, words: Words, min_line_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(first words, numbers of words) of the lines of ``min_line_words`` words
    or more; first words count all words of the slice."""
    n = len(words.starts)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    line = np.concatenate([[0], np.cumsum(texts.buf == 10)])[words.starts]
    rows = words.rows
    new = np.ones(n, bool)
    new[1:] = (rows[1:] != rows[:-1]) | (line[1:] != line[:-1])
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, n))
    long = size >= min_line_words
    return first[long], size[long]


def _run_words(min_words: int) -> int:
    """Words of the runs that anchors are chosen from: two cover a window."""
    return (min_words + 2) // 2


def windows_of(words: Words, hashes: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first words, places of their anchors, hashes of the words' runs) of
    every window of ``min_words`` words; places count all words of the slice."""
    width = _run_words(min_words)
    runs = salted(window_hashes(hashes, width), 17)
    n = len(hashes) - min_words + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), runs
    # the leftmost smallest run of each window
    best, least = np.arange(n), runs[:n].copy()
    for k in range(1, min_words - width + 1):
        less = runs[k : k + n] < least
        least[less] = runs[k : k + n][less]
        best[less] = np.flatnonzero(less) + k
    rows = words.rows
    inside = np.flatnonzero(rows[:n] == rows[min_words - 1 :])
    return inside, best[inside], runs


def _compare(digest, doc_id, text_hash, word, reach: np.ndarray | int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For rows in the order of ``_KEY``: the index of the first of each one's
    digest, whether it is the very same occurrence, and whether it is a later
    one: in another row, or at least ``reach`` words on in the same."""
    n = len(digest)
    new = np.ones(n, bool)
    new[1:] = digest[1:] != digest[:-1]
    first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    one_row = (doc_id == doc_id[first]) & (text_hash == text_hash[first])
    same = one_row & (word == word[first])
    return first, same, ~same & (~one_row | (word >= word[first] + reach))


def _reach(kind: np.ndarray, min_words: int) -> np.ndarray:
    return np.where(kind == WINDOW, min_words, 1)


def _spread(doc_id: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Where rows go that are settled already: anywhere, evenly."""
    with np.errstate(over="ignore"):
        return salted(mix(doc_id.view(np.uint64)) + word.astype(np.uint64), 5).view(np.int64)


def _row_ids(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return tuple(part.column(c).to_numpy().astype(np.int64) for c in ("doc_id", "text_hash"))


def _batch(cols: dict[str, np.ndarray], schema: str) -> pa.RecordBatch:
    types = {"long": np.int64, "int": np.int32, "boolean": bool}
    fields = [f.split() for f in schema.split(", ")]
    return pa.record_batch({name: np.ascontiguousarray(cols[name], dtype=types[kind]) for name, kind in fields})


def _emit(min_words: int, min_line_words: int):
    """Lines, whole texts and anchors, each digest once for a slice, and what
    repeats within the slice: later lines and texts, all places of an anchor."""

    def run(batches):
        for batch in batches:
            for part, texts in slices(batch):
                texts = texts.lower()
                words = words_of(texts)
                hashes = span_hashes(texts.buf, words.starts, words.ends)
                line, line_words = lines_of(texts, words, min_line_words)
                whole = words.first[:-1][words.counts >= min_words]
                _, anchors, runs = windows_of(words, hashes, min_words)
                anchors = np.unique(anchors)
                digests = [runs[anchors], _sequence_digests(hashes, line, line_words, 21), _sequence_digests(hashes, whole, words.counts[words.counts >= min_words], 22)]
                at = np.concatenate([anchors, line, whole])
                row = words.rows[at]
                doc_id, text_hash = (ids[row] for ids in _row_ids(part))
                cols = {"digest": np.concatenate(digests).view(np.int64), "doc_id": doc_id, "text_hash": text_hash, "word": at - words.first[row], "kind": np.repeat([ANCHOR, LINE, WHOLE], [len(x) for x in digests])}
                order = np.lexsort([cols[k] for k in reversed(_KEY)])
                cols = {k: v[order] for k, v in cols.items()}
                first, same, later = _compare(*(cols[k] for k in _KEY), 1)
                is_first = first == np.arange(len(first))
                again = later.copy()
                ones = first[later & (cols["kind"] == ANCHOR)]
                again[ones] = True  # an anchor's first place holds windows as well
                take = np.concatenate([np.flatnonzero(is_first), np.flatnonzero(again)])
                out = {k: v[take] for k, v in cols.items()}
                out["known"] = np.arange(len(take)) >= is_first.sum()
                out["digest"] = np.where(out["known"], _spread(out["doc_id"], out["word"]), out["digest"])
                yield _batch(out, _PLACES)

    return run


def _settle(min_words: int):
    """Rows of a partition in the order of ``_KEY``: those that are settled, and
    those that repeat an earlier one (of anchors, the first place too)."""

    def run(batches):
        carried = None
        for batch in batches:
            known = batch.filter(batch.column("known"))
            if known.num_rows:
                yield known
            rows = pa.Table.from_batches([b for b in (carried, batch.filter(pc.invert(batch.column("known")))) if b is not None]).combine_chunks()
            if not rows.num_rows:
                continue
            cols = {k: rows.column(k).to_numpy() for k in (*_KEY, "kind")}
            first, _, later = _compare(*(cols[k] for k in _KEY), _reach(cols["kind"], min_words))
            out = later.copy()
            out[first[later & (cols["kind"] == ANCHOR)]] = True
            yield from rows.filter(pa.array(out)).to_batches()
            carried = rows.slice(first[-1], 1).to_batches()[0]

    return run


def _settled(rows: DataFrame, schema: str, min_words: int) -> DataFrame:
    return rows.repartition("digest").sortWithinPartitions(*_KEY).mapInArrow(_settle(min_words), schema)


def _merged(row: np.ndarray, word: np.ndarray, end: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches of words [word, end) of each row, overlapping and adjoining ones joined."""
    order = np.lexsort((word, row))
    row, word, end = row[order], word[order], end[order]
    reach = np.maximum.accumulate(row * span + end) if len(row) else end
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (row[1:] * span + word[1:] > reach[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(row)) - 1 if len(row) else first
    return row[first], word[first], (reach[last] - row[first] * span) if len(row) else end


def _emit_windows(min_words: int, min_line_words: int):
    """The windows of each text whose anchor is among ``anchors``, each digest
    once for a slice; and the stretches that are settled: repeated lines, whole
    texts, windows that repeat within the slice."""

    def run(batches):
        for batch in batches:
            for part, texts in slices(batch):
                texts = texts.lower()
                words = words_of(texts)
                if not len(words.starts):
                    continue
                hashes = span_hashes(texts.buf, words.starts, words.ends)
                marked = {}
                for name in ("anchors", "lines"):
                    lists = part.column(name)
                    owner = np.repeat(np.arange(len(part)), lists.value_lengths().to_numpy())
                    marked[name] = np.zeros(len(hashes) + 1, bool)
                    marked[name][words.first[owner] + lists.flatten().to_numpy()] = True
                whole = part.column("whole").to_numpy(zero_copy_only=False)
                line, line_words = lines_of(texts, words, min_line_words)
                hit = marked["lines"][line]
                gone = np.flatnonzero(whole)
                settled = [(words.rows[line[hit]], line[hit], line[hit] + line_words[hit]), (gone, words.first[gone], words.first[gone + 1])]

                first, anchors, runs = windows_of(words, hashes, min_words)
                rows = words.rows
                first = first[marked["anchors"][anchors] & ~whole[rows[first]]]
                last = first + min_words - 1
                with np.errstate(over="ignore"):
                    digest = mix(runs[first] + salted(runs[last + 1 - _run_words(min_words)], 18)).view(np.int64)
                doc_id, text_hash = _row_ids(part)
                row = rows[first]
                cols = {"digest": digest, "doc_id": doc_id[row], "text_hash": text_hash[row], "word": first - words.first[row]}
                order = np.lexsort([cols[k] for k in reversed(_KEY)])
                first = first[order]
                chief, same, later = _compare(*(cols[k][order] for k in _KEY), min_words)
                settled.append((rows[first[later]], first[later], first[later] + min_words))
                # not settled: a digest's first, and what overlaps it
                open_ = ~later & (~same | (chief == np.arange(len(chief))))
                ship, digests = first[open_], digest[order][open_]

                r, w, e = (np.concatenate(x) for x in zip(*settled, strict=True))
                r, w, e = _merged(r, w, e, len(hashes) + 1)
                row, at, end = np.concatenate([rows[ship], r]), np.concatenate([ship, w]), np.concatenate([ship + min_words, e])
                known = np.arange(len(at)) >= len(ship)
                chars = _code_points(texts)
                origin = chars[texts.offsets[row]]
                word = at - words.first[row]
                out = {
                    "digest": np.concatenate([digests, _spread(doc_id[r], w)]), "doc_id": doc_id[row], "text_hash": text_hash[row], "word": word, "kind": np.full(len(at), WINDOW),
                    "known": known, "words": end - at, "start": chars[words.starts[at]] - origin, "stop": chars[words.ends[end - 1]] - origin,
                }
                yield _batch(out, _SPANS)

    return run


def repeated_stretches(docs: DataFrame, min_words: int = MIN_WORDS, min_line_words: int = MIN_LINE_WORDS) -> DataFrame:
    """(doc_id, text_hash, start, stop, words) of every stretch that an earlier
    document, or an earlier place of the same one, has already; ``text_hash`` is
    ``xxhash64`` of the text and tells apart rows that share a doc_id."""
    spark = docs.sparkSession
    texts = text_rows(docs).where("doc_id is not null and text is not null").withColumn("text_hash", F.xxhash64("text"))
    marks, marks_path = staged_alone(spark, lambda: _settled(texts.mapInArrow(_emit(min_words, min_line_words), _PLACES), _PLACES, min_words).select("doc_id", "text_hash", "word", "kind"), "op8-marks")

    words = {k: F.collect_set(F.when(F.col("kind") == kind, F.col("word"))) for k, kind in (("anchors", ANCHOR), ("lines", LINE))}
    places = marks.groupBy("doc_id", "text_hash").agg(*(v.alias(k) for k, v in words.items()), F.max(F.col("kind") == WHOLE).alias("whole"))
    windows, windows_path = staged_alone(spark, lambda: texts.join(places, ["doc_id", "text_hash"]).mapInArrow(_emit_windows(min_words, min_line_words), _SPANS), "op8-windows")
    delete_folder(spark, marks_path)
    parts = staged(_settled(windows, _SPANS, min_words).select("doc_id", "text_hash", "word", "words", "start", "stop"), "op8-later")
    delete_folder(spark, windows_path)

    # a stretch begins where no earlier one reaches
    row = ("doc_id", "text_hash")
    before = Window.partitionBy(*row).orderBy("word", "words")
    end = F.col("word") + F.col("words")
    reach = F.max(end).over(before.rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.withColumn("new", F.coalesce(F.col("word") > reach, F.lit(True)).cast("int")).withColumn("stretch", F.sum("new").over(before.rowsBetween(Window.unboundedPreceding, 0)))
    return parts.groupBy(*row, "stretch").agg(F.min("start").alias("start"), F.max("stop").alias("stop"), (F.max(end) - F.min("word")).cast("long").alias("words")).drop("stretch")


def dedup_passages(docs: DataFrame, min_words: int = MIN_WORDS, min_line_words: int = MIN_LINE_WORDS) -> DataFrame:
    """All rows and columns with repeated stretches cut out of ``text``, and
    ``removed``: their [start, stop) offsets in the original text. If the table
    has a column of that name it stays, and the new one is called ``removed_``."""
    removed, text_hash = unused_name(docs, "removed"), unused_name(docs, "text_hash")
    found = repeated_stretches(docs, min_words, min_line_words).groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias(removed))
    found = staged(found, "op8-found").withColumnsRenamed({"text_hash": text_hash})
    joined = docs.withColumn(text_hash, F.xxhash64("text")).join(found, ["doc_id", text_hash], "left").withColumn(removed, F.coalesce(removed, F.expr("cast(array() as array<struct<start:int,stop:int>>)")))
    cut = F.expr(f"""concat(
        array_join(transform({removed}, (r, i) -> substring(text, if(i = 0, 0, {removed}[i - 1].stop) + 1, r.start - if(i = 0, 0, {removed}[i - 1].stop))), ''),
        substring(text, if(size({removed}) = 0, 0, element_at({removed}, -1).stop) + 1))""")
    return joined.withColumn("text", F.when(F.size(removed) > 0, cut).otherwise(F.col("text"))).select(*docs.columns, removed)


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document with something to remove: what and where."""
    found = repeated_stretches(load(spark, sf_dir, "documents"))
    return found.groupBy("doc_id", "text_hash").agg(F.count("*").alias("n_removed"), F.sum("words").alias("words_removed"), F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("removed")).drop("text_hash")
