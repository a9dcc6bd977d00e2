"""Source divergence audit: which terms set a source apart, and how far sources lie apart.

A language keeps the terms that enough of its documents hold. They are found
by iceberg prefix refinement: a level counts, for every language, the distinct
documents that hold each byte prefix; a prefix below the threshold cannot be
the start of a kept term, so the next level extends the others only, until
none is left to extend. A term is counted whole, by source, at the level that
reaches its end. Levels double the length of prefixes, so a term of n bytes
takes about log2(n) passes over the texts.

Prefixes that survive go to the next pass as bits of a filter of bounded size
(``max_bits``). A prefix that passes by chance costs work and changes nothing,
as a term's own count decides. Tasks add up slices of texts before anything is
shuffled, so a frequent term is a row for each task and source at most.

Sources are compared in blocks of terms and of sources; terms that neither of
two blocks of sources holds are added by their number. No task holds more than
``source_block`` sources twice and a block of terms.

All arithmetic is on whole numbers. Documents are rows: a repeated row is
another document. Null text, lang or source count as ''; a source without
terms, or a language that keeps none, still has its pairs (value 0 if no term
is kept); an empty table gives an empty result. Other columns do not matter.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.llm.common import Texts, load, map_slices, mix, span_hashes, staged, words_of

FIRST_LEVEL = 4
TERMS_IN_BLOCK = 4096

#: Bytes that end a term: everything but ASCII letters and bytes of non-ASCII characters.
BETWEEN = np.ones(256, bool)
BETWEEN[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False

_COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.binary()), ("complete", pa.bool_()), ("place", pa.int64()), ("n_docs", pa.int64()), ("n_uses", pa.int64())])
_COUNTS_DDL = "lang string, source string, term binary, complete boolean, place long, n_docs long, n_uses long"


def _names(column: pa.Array) -> tuple[np.ndarray, list[str], np.ndarray]:
    """Each row's name by number, the names, and a fingerprint of each name."""
    coded = pc.fill_null(column, "").dictionary_encode()
    names = coded.dictionary.to_pylist()
    prints = [int.from_bytes(hashlib.blake2b(n.encode(), digest_size=8).digest(), "little") for n in names]
    return coded.indices.to_numpy(), names, np.array(prints, np.uint64)


def _spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    lens = ends - starts
    offsets = np.concatenate([[0], np.cumsum(lens)]).astype(np.int32)
    at = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], lens)
    return pa.Array.from_buffers(pa.binary(), len(lens), [None, pa.py_buffer(offsets), pa.py_buffer(buf[at].tobytes())])


def _level(low: int, high: int, bits):
    """Counts of a slice: terms of more than ``low`` and up to ``high`` bytes,
    and prefixes of ``high`` bytes of longer ones, if the filter has their
    prefix of ``low`` bytes."""

    def count(part: pa.RecordBatch, texts: Texts) -> pa.RecordBatch | None:
        texts = texts.lower()
        langs, lang_names, lang_prints = _names(part.column("lang"))
        sources, source_names, source_prints = _names(part.column("source"))
        words = words_of(texts, BETWEEN)
        starts, ends, rows = words.starts, words.ends, words.rows
        if low:
            field = bits.value
            on = np.flatnonzero(ends - starts > low)
            place = mix(span_hashes(texts.buf, starts[on], starts[on] + low) ^ lang_prints[langs[rows[on]]]) & np.uint64(len(field) * 64 - 1)
            on = on[(field[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) > 0]
            starts, ends, rows = starts[on], ends[on], rows[on]
        if not len(starts):
            return None
        complete = ends - starts <= high
        ends = np.minimum(ends, starts + high)
        place = mix(span_hashes(texts.buf, starts, ends) ^ lang_prints[langs[rows]])
        # a prefix is counted for the language, a term for each source
        key = mix(place + np.where(complete, source_prints[sources[rows]] | np.uint64(1), np.uint64(0)))
        order = np.argsort(key, kind="stable")  # rows stay in order within a key
        key, row = key[order], rows[order]
        new = np.concatenate([[True], key[1:] != key[:-1]])
        first = np.flatnonzero(new)
        fresh = new | np.concatenate([[True], row[1:] != row[:-1]])
        pick = order[first]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(lang_names, pa.string()).take(pa.array(langs[rows[pick]])),
                pc.if_else(pa.array(complete[pick]), pa.array(source_names, pa.string()).take(pa.array(sources[rows[pick]])), pa.scalar(None, pa.string())),
                _spans(texts.buf, starts[pick], ends[pick]), pa.array(complete[pick]), pa.array(place[pick].view(np.int64)),
                pa.array(np.add.reduceat(fresh.astype(np.int64), first)), pa.array(np.diff(np.append(first, len(key))).astype(np.int64)),
            ],
            schema=_COUNTS,
        )

    return map_slices(count)


def _filter(prefixes: DataFrame, n: int, max_bits: int) -> np.ndarray:
    """A bit for each surviving prefix, as 64-bit words: 16 bits for each of ``n``
    prefixes, at most ``max_bits`` in all."""
    size = 1 << 16
    while size < min(16 * n, max_bits):
        size *= 2
    at = F.col("place").bitwiseAND(F.lit(size - 1))
    one = F.expr("shiftleft(1L, cast(place & 63L as int))")
    words = prefixes.groupBy(F.shiftright(at, 6).alias("word")).agg(F.bit_or(one).alias("bits")).toPandas()  # at most max_bits / 64 rows
    field = np.zeros(size // 64, np.uint64)
    field[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).view(np.uint64)
    return field


def kept_terms(docs: DataFrame, min_docs: int = 30, max_bits: int = 1 << 26) -> DataFrame:
    """lang, source, term and n_uses of the terms that at least ``min_docs``
    documents of the language hold."""
    rows = docs.select("lang", "source", "text")
    spark = docs.sparkSession
    low, high, bits, done = 0, FIRST_LEVEL, None, None
    while True:
        counts = rows.mapInArrow(_level(low, high, bits), _COUNTS_DDL)
        counts = counts.groupBy("lang", "source", "term", "complete").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_uses").alias("n_uses"), F.min("place").alias("place"))
        in_lang = F.sum("n_docs").over(Window.partitionBy("lang", "term", "complete"))  # a row for each source
        level = staged(counts.withColumn("n_docs", in_lang).where(F.col("n_docs") >= min_docs), f"op12-level{high}")
        terms = level.where("complete").select("lang", "source", "term", "n_uses")
        done = terms if done is None else done.unionByName(terms)
        prefixes = level.where("not complete")
        n = prefixes.count()
        if not n:
            return done
        bits = spark.sparkContext.broadcast(_filter(prefixes, n, max_bits))
        low, high = high, 2 * high


def _share(uses: str, total: str, kept: str) -> Column:
    """1 + floor(10^9 * (uses + 5) / (total + 5 * kept)), in whole numbers."""
    return F.expr(f"1 + (cast(1000000000 as decimal(38,0)) * ({uses} + 5)) div (cast({total} as decimal(38,0)) + 5 * {kept})")


def _distances(source_block: int):
    """Sums of differences between the sources of two blocks over a block of terms."""

    def run(table: pa.Table) -> pa.Table:
        lang, i, j = (table.column(c)[0].as_py() for c in ("lang", "block_a", "block_b"))
        number, term = table.column("number").to_numpy(), table.column("term")
        given = pc.is_null(term).to_numpy(zero_copy_only=False)  # a row for each source, with what a term that it lacks has
        numbers, first = np.unique(number[given], return_index=True)
        none = table.column("none").to_numpy()[given][first]
        coded = term.filter(pa.array(~given)).combine_chunks().dictionary_encode()
        shares = np.repeat(none[:, None], len(coded.dictionary), 1)
        shares[np.searchsorted(numbers, number[~given]), coded.indices.to_numpy()] = table.column("share").to_numpy()[~given]
        left, right = np.flatnonzero(numbers // source_block == i), np.flatnonzero(numbers // source_block == j)
        apart = np.stack([np.abs(shares[right] - shares[a]).sum(1) for a in left]) if len(left) and len(right) else np.zeros((len(left), len(right)), np.int64)
        a, b = (x.ravel() for x in np.meshgrid(numbers[left], numbers[right], indexing="ij"))
        apart = apart.ravel()
        other = a != b
        a, b, apart = a[other], b[other], apart[other]
        if i != j:
            a, b, apart = np.concatenate([a, b]), np.concatenate([b, a]), np.concatenate([apart, apart])
        return pa.table({"lang": pa.array([lang] * len(a), pa.string()), "number": a, "other": b, "apart": apart, "seen": np.full(len(a), len(coded.dictionary), np.int64)})

    return run


def audit_sources(docs: DataFrame, min_docs: int = 30, top_terms: int = 50, source_block: int = 256, max_bits: int = 1 << 26) -> DataFrame:
    """lang, source, part, item, value and rank: the distance of each source to
    every other one of its language (part ``pair``), and the ``top_terms``
    terms that it uses more than its language does (part ``term``)."""
    docs = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")))
    uses = kept_terms(docs, min_docs, max_bits)
    uses = staged(uses.withColumn("in_lang", F.sum("n_uses").over(Window.partitionBy("lang", "term"))), "op12-uses")
    per_lang = uses.select("lang", "term", "in_lang").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("in_lang").alias("lang_total"))
    per_source = uses.groupBy("lang", "source").agg(F.sum("n_uses").alias("total"))
    groups = docs.select("lang", "source").distinct().join(per_source, ["lang", "source"], "left").join(per_lang, "lang", "left")
    groups = groups.fillna(0, ["total", "kept", "lang_total"])
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = groups.withColumn("none", F.when(F.col("kept") > 0, _share("0L", "total", "kept")).otherwise(F.lit(0).cast("long")))
    groups = staged(groups.withColumns({"number": number, "sources": F.count(F.lit(1)).over(Window.partitionBy("lang"))}), "op12-groups")

    shares = uses.join(groups, ["lang", "source"]).withColumns({"share": _share("n_uses", "total", "kept"), "lang_share": _share("in_lang", "lang_total", "kept")})
    rank = lambda: F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item"))
    terms = shares.where("share > lang_share").select("lang", "source", F.lit("term").alias("part"), F.col("term").cast("string").alias("item"), (F.col("share") - F.col("lang_share")).alias("value"))
    terms = terms.withColumn("rank", rank()).where(F.col("rank") <= top_terms)

    term_blocks = F.greatest(F.lit(1), F.ceil(F.col("kept") / TERMS_IN_BLOCK)).cast("int")
    own = F.floor(F.col("number") / source_block).cast("int")
    held = shares.select("lang", "number", "sources", F.col("term").cast("string").alias("term"), "share", "none", F.pmod(F.xxhash64("term"), term_blocks).cast("int").alias("terms"))
    given = groups.select("lang", "number", "sources", F.lit(None).cast("string").alias("term"), F.lit(None).cast("long").alias("share"), "none", F.explode(F.sequence(F.lit(0), term_blocks - 1)).alias("terms"))
    last = F.floor((F.col("sources") - 1) / source_block).cast("int")
    rows = held.unionByName(given).withColumn("with", F.explode(F.sequence(F.lit(0), last)))
    rows = rows.withColumns({"block_a": F.least(own, F.col("with")), "block_b": F.greatest(own, F.col("with"))}).drop("with", "sources")
    parts = rows.groupBy("lang", "terms", "block_a", "block_b").applyInArrow(_distances(source_block), "lang string, number int, other int, apart long, seen long")
    apart = parts.groupBy("lang", "number", "other").agg(F.sum("apart").alias("apart"), F.sum("seen").alias("seen"))
    a = groups.select("lang", "number", "source", "kept", F.col("none").alias("none_a"))
    b = groups.select("lang", F.col("number").alias("other"), F.col("source").alias("item"), F.col("none").alias("none_b"))
    value = F.col("apart") + (F.col("kept") - F.col("seen")) * F.abs(F.col("none_a") - F.col("none_b"))
    pairs = apart.join(a, ["lang", "number"]).join(b, ["lang", "other"]).select("lang", "source", F.lit("pair").alias("part"), "item", value.alias("value"))
    return pairs.withColumn("rank", rank()).unionByName(terms)


def op12_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_sources(load(spark, sf_dir, "documents"))


ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), w AS (
  SELECT doc, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), k AS (
  SELECT lang, term, count(*) AS in_lang FROM w GROUP BY ALL HAVING count(DISTINCT doc) >= 30
), l AS (
  SELECT lang, count(*) AS kept, sum(in_lang)::BIGINT AS lang_total FROM k GROUP BY lang
), u AS (
  SELECT lang, source, term, count(*) AS uses FROM w JOIN k USING (lang, term) GROUP BY ALL
), t AS (
  SELECT lang, source, sum(uses)::BIGINT AS total FROM u GROUP BY ALL
), g AS (
  SELECT * FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN t USING (lang, source) LEFT JOIN l USING (lang)
), p AS (
  SELECT g.lang, g.source, k.term, coalesce(u.uses, 0) AS uses,
    1 + (1000000000 * (coalesce(u.uses, 0) + 5)) // (coalesce(g.total, 0) + 5 * g.kept) AS share,
    1 + (1000000000 * (k.in_lang + 5)) // (g.lang_total + 5 * g.kept) AS lang_share
  FROM g JOIN k USING (lang) LEFT JOIN u USING (lang, source, term)
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (
    SELECT x.lang, x.source, y.source AS other, sum(abs(x.share - y.share)) AS value
    FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL
  ) s ON s.lang = a.lang AND s.source = a.source AND s.other = b.source
), terms AS (
  SELECT lang, source, 'term' AS part, term AS item, (share - lang_share)::BIGINT AS value FROM p
  WHERE uses > 0 AND share > lang_share
)
SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
QUALIFY part = 'pair' OR rank <= 50
"""
