"""N-gram Jaccard join: a blocked sparse product of documents by shingles.

Two documents link when their sets of distinct word shingles have a Jaccard
similarity of at least 3/4. The product of the document-by-shingle incidence
matrix with its transpose holds every overlap; only the entries that can reach
the bound are formed:

* Equal sets are one row of the matrix (class), found by a set fingerprint.
* Columns are ordered by rising frequency. A row keeps its first
  ``n // 4 + 1`` columns: two rows that link share one of them, as each holds
  three quarters of the other. Frequencies come from a sketch of fixed size,
  summed over all documents; any order gives the same links.
* Stars first: a row is paired with the few rows that come first in most of
  its columns, which joins large groups of near copies at a linear cost.
* Then the product: pairs of rows of a column in different components, column
  by column in blocks of at most ``BLOCK`` by ``BLOCK`` rows, with the overlap
  counts accumulated over columns. An entry is formed only if the columns from
  its place on could hold an overlap of ``3/7 (n_a + n_b)``; a pair stays only
  if its count plus the columns after the last one counted could, and if all
  columns that both rows kept plus the rest of the sets could.
* What stays is verified on the full sets.

No pair within a component is formed twice over, no group is collected into
one task and nothing but a sketch and a Bloom filter of fixed sizes goes
through the driver.

Defined results: a null, empty or blank text has an empty set and links with
nothing; a text of fewer than five words has its whole sequence as one
shingle; repeated rows are copies of each other; an empty table gives an empty
result. Letters A-Z are lower-cased.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from strata.llm.common import distinct_per_row, load, mix, salted, shingles_of, slices, staged, text_rows
from strata.llm.components import components

WIDTH = 5
BLOCK = 256
#: Counters of the column-frequency sketch, and bits of the Bloom filter of classes to verify.
SKETCH, RANGES, BLOOM_WORDS, BLOOM_PROBES = 1 << 22, 64, 1 << 20, 4
#: Bytes of text whose sets are made at once: the arrays for them are what a worker takes most memory for.
SET_BYTES = 1 << 20
#: Centres that a row is compared with in the first round.
CENTRES = 3

_SETS = "doc_id long, n long, fp long, part int, counts binary"


def _sets(texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(rows, hashes, offsets, fingerprints) of the distinct shingles of each row."""
    rows, hashes = shingles_of(texts.lower(), WIDTH)
    hashes, offsets = distinct_per_row(rows, hashes, len(texts))
    n = np.diff(offsets)
    total = np.concatenate([[np.uint64(0)], np.cumsum(salted(hashes, 1), dtype=np.uint64)])
    with np.errstate(over="ignore"):
        fps = mix(total[offsets[1:]] - total[offsets[:-1]] + mix(n.astype(np.uint64)))
    return np.repeat(np.arange(len(n)), n), hashes, offsets, fps.view(np.int64)


def _counter(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(42)).astype(np.int64)


def _describe(batches):
    """A row for each document, then the task's sketch in ``RANGES`` packed rows."""
    counts = np.zeros(SKETCH, np.uint32)
    for batch in batches:
        for part, texts in slices(batch, limit=SET_BYTES):
            _, hashes, offsets, fps = _sets(texts)
            np.add.at(counts, _counter(hashes), np.uint32(1))
            yield pa.record_batch({"doc_id": part.column("doc_id"), "n": np.diff(offsets), "fp": fps, "part": pa.nulls(len(texts), pa.int32()), "counts": pa.nulls(len(texts), pa.binary())})
    packer, nothing = zstandard.ZstdCompressor(level=1), pa.nulls(RANGES, pa.int64())
    packed = pa.array([packer.compress(x.tobytes()) for x in counts.reshape(RANGES, -1)], pa.binary())
    yield pa.record_batch({"doc_id": nothing, "n": nothing, "fp": nothing, "part": np.arange(RANGES, dtype=np.int32), "counts": packed})


def _add_sketches(batches):
    """Sum the packed rows of each range: one range in memory per key."""
    sums: dict[int, np.ndarray] = {}
    reader = zstandard.ZstdDecompressor()
    for b in batches:
        for part, packed in zip(b.column("part").to_pylist(), b.column("counts"), strict=True):
            counts = np.frombuffer(reader.decompress(packed.as_buffer()), np.uint32)
            sums[part] = sums[part] + counts if part in sums else counts.astype(np.int64)
    if sums:
        yield pa.record_batch({"part": pa.array(list(sums), pa.int32()), "counts": pa.array([x.tobytes() for x in sums.values()], pa.binary())})


def _frequent(described: DataFrame) -> np.ndarray:
    """The sketch over all documents, 0 for counters that chance explains:
    ``SKETCH`` counters of 4 bytes, whatever the input."""
    rows = described.where("part is not null").select("part", "counts").repartition(RANGES, "part").mapInArrow(_add_sketches, "part int, counts binary").collect()
    counts = np.zeros((RANGES, SKETCH // RANGES))
    for r in rows:
        counts[r["part"]] = np.frombuffer(r["counts"], np.int64)
    usual = np.median(counts)
    counts[counts <= usual + 4 * np.sqrt(usual) + 2] = 0
    return np.minimum(counts, 2**32 - 1).astype(np.uint32).ravel()


def _postings(frequent):
    def run(batches):
        weight = frequent.value
        for batch in batches:
            for _, texts in slices(batch, limit=SET_BYTES):
                rows, hashes, offsets, fps = _sets(texts)
                first = np.zeros(len(texts), bool)  # copies within the slice give their postings once
                first[np.unique(fps, return_index=True)[1]] = True
                order = np.lexsort((hashes, weight[_counter(hashes)], rows))
                n = np.diff(offsets)
                rank = np.arange(len(rows)) - np.repeat(offsets[:-1], n)
                chosen = (rank < np.repeat(n // 4 + 1, n)) & np.repeat(first, n)
                keep = order[chosen]
                yield pa.record_batch({"h": hashes[keep].view(np.int64), "fp": fps[rows[keep]], "n": n[rows[keep]].astype(np.int32), "pos": rank[chosen].astype(np.int32)})

    return run


def _bits(h: np.ndarray):
    for k in range(BLOOM_PROBES):
        x = salted(h.view(np.uint64), 100 + k)
        yield (x & np.uint64(BLOOM_WORDS - 1)).astype(np.int64), np.uint64(1) << (x >> np.uint64(58))


def _bloom(classes: DataFrame) -> np.ndarray:
    """A Bloom filter of the classes: 8 MB whatever their number, so it only
    thins what is read; the join that follows is exact."""

    def insert(batches):
        words = np.zeros(BLOOM_WORDS, np.uint64)
        for b in batches:
            for at, bit in _bits(b.column(0).to_numpy()):
                np.bitwise_or.at(words, at, bit)
        used = np.flatnonzero(words)
        yield pa.record_batch({"at": used.astype(np.int32), "bits": words[used].view(np.int64)})

    merged = classes.mapInArrow(insert, "at int, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    words = np.zeros(BLOOM_WORDS, np.uint64)
    words[merged["at"].to_numpy()] = merged["bits"].to_numpy().view(np.uint64)
    return words


def _contents(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(fp, hashes) once for each class: the sorted set as bytes."""
    wanted = docs.sparkSession.sparkContext.broadcast(_bloom(classes))

    def run(batches):
        for batch in batches:
            for _, texts in slices(batch, limit=SET_BYTES):
                _, hashes, offsets, fps = _sets(texts)
                hit = np.zeros(len(fps), bool)
                hit[np.unique(fps, return_index=True)[1]] = True
                hit &= np.diff(offsets) > 0
                for at, bit in _bits(fps):
                    hit &= (wanted.value[at] & bit) != 0
                at = np.flatnonzero(hit)
                yield pa.record_batch({"fp": fps[at], "hashes": pa.array([hashes[offsets[i] : offsets[i + 1]].tobytes() for i in at], pa.binary())})

    found = docs.mapInArrow(run, "fp long, hashes binary")
    return found.groupBy("fp").agg(F.first("hashes").alias("hashes"))


def _overlap(batches):
    for b in batches:
        keep = []
        for x, y in zip(b.column("x"), b.column("y"), strict=True):
            x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(100 * both >= 75 * (len(x) + len(y) - both))
        yield pa.RecordBatch.from_arrays([b.column("u"), b.column("v")], ["u", "v"]).filter(pa.array(keep, pa.bool_()))


def _verified(docs: DataFrame, pairs: DataFrame, name: str) -> DataFrame:
    """The pairs ``(u, v)`` of classes whose full sets link."""
    pairs = staged(pairs, f"{name}-pairs")
    classes = pairs.select(F.col("u").alias("fp")).union(pairs.select("v")).distinct()
    contents = staged(_contents(docs, classes), f"{name}-sets")
    x, y = (contents.select(F.col("fp").alias(k), F.col("hashes").alias(h)) for k, h in (("u", "x"), ("v", "y")))
    return pairs.join(x, "u").join(y, "v").select("u", "v", "x", "y").mapInArrow(_overlap, "u long, v long")


def _product(rows: DataFrame) -> DataFrame:
    """Pairs of rows in different components that a column shares, with the
    number of shared columns and the last places of one: the product in blocks,
    accumulated over columns. The first column that two rows share leaves no
    more overlap than either row has columns from there on, so entries further
    back than the bound allows are not formed."""
    column = Window.partitionBy("h")
    blocks = F.ceil(F.count("*").over(column) / BLOCK).cast("int")
    rows = rows.withColumn("blocks", blocks).withColumn("at", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    left = rows.select("h", F.col("fp").alias("u"), F.col("n").alias("n_u"), F.col("pos").alias("p_u"), F.col("root").alias("r_u"), F.col("at").alias("i"), F.explode(F.expr("sequence(0, blocks - 1)")).alias("j"))
    right = rows.select("h", F.col("fp").alias("v"), F.col("n").alias("n_v"), F.col("pos").alias("p_v"), F.col("root").alias("r_v"), F.col("at").alias("j"), F.explode(F.expr("sequence(0, blocks - 1)")).alias("i"))
    reach = "7L * least(n_u - p_u, n_v - p_v) >= 3L * (n_u + n_v)"
    met = left.join(right, ["h", "i", "j"]).where(f"u < v and r_u <> r_v and {reach}")
    return met.groupBy("u", "v", "n_u", "n_v").agg(F.count("*").alias("shared"), F.max("p_u").alias("p_u"), F.max("p_v").alias("p_v"))


def _likely(pairs: DataFrame, postings: DataFrame) -> DataFrame:
    """The pairs whose shared columns, and all that the rest of the sets could
    add, reach the bound. A row has at most ``n // 4 + 1`` columns here."""
    # all columns shared up to the last one counted are counted
    pairs = pairs.where("7L * (shared + least(n_u - p_u, n_v - p_v) - 1) >= 3L * (n_u + n_v)").select("u", "v", "n_u", "n_v")
    kept = postings.groupBy("fp").agg(F.collect_list("h").alias("columns"))
    x, y = (kept.select(F.col("fp").alias(k), F.col("columns").alias(c)) for k, c in (("u", "x"), ("v", "y")))
    rest = "n_{0} - floor(n_{0} / 4) - 1"
    bound = f"7L * (size(array_intersect(x, y)) + greatest({rest.format('u')}, {rest.format('v')})) >= 3L * (n_u + n_v)"
    return pairs.join(x, "u").join(y, "v").where(bound).select("u", "v")


def _classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n, fp) of every row, and (fp, least, root) of every set of
    shingles: its smallest doc_id and the component it is in."""
    docs = text_rows(docs)
    sc = docs.sparkSession.sparkContext
    described = staged(docs.mapInArrow(_describe, _SETS), "op10-sets")
    sets = described.where("part is null").select("doc_id", "n", "fp")
    frequent = sc.broadcast(_frequent(described))

    column = Window.partitionBy("h")
    postings = docs.mapInArrow(_postings(frequent), "h long, fp long, n int, pos int")
    postings = postings.withColumns({"low": F.min("fp").over(column), "high": F.max("fp").over(column)}).where("low <> high")
    # copies in different slices gave the same posting
    postings = staged(postings.groupBy("h", "fp").agg(F.first("n").alias("n"), F.first("pos").alias("pos")), "op10-columns")

    # a row whose columns are shared most is the likeliest source of near copies
    ranked = postings.withColumn("w", F.count("*").over(Window.partitionBy("fp")))
    stars = ranked.withColumn("centre", F.max(F.struct("w", "fp")).over(column)["fp"]).where("centre <> fp")
    stars = stars.groupBy("fp", "centre").agg(F.count("*").alias("shared"), F.first("n").alias("n")).where("40 * shared >= n")
    nth = F.row_number().over(Window.partitionBy("fp").orderBy(F.desc("shared"), "centre"))
    stars = stars.withColumn("nth", nth).where(F.col("nth") <= CENTRES).select(F.least("centre", "fp").alias("u"), F.greatest("centre", "fp").alias("v")).distinct()
    roots = components(_verified(docs, stars, "op10-stars"), "op10-roots")

    rows = postings.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    rows = rows.withColumns({"r0": F.min("root").over(column), "r1": F.max("root").over(column)}).where("r0 <> r1")
    more = _verified(docs, _likely(_product(rows.select("h", "fp", "n", "pos", "root")), postings), "op10-product")
    # the components so far stand for the links that made them
    roots = components(roots.select(F.col("node").alias("u"), F.col("root").alias("v")).union(more), "op10-roots")

    of_class = sets.where("n > 0").groupBy("fp").agg(F.min("doc_id").alias("least"))
    of_class = staged(of_class.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp")), "op10-classes")
    return sets, of_class


def jaccard_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest doc_id reachable)."""
    sets, of_class = _classes(docs)
    of_root = of_class.groupBy("root").agg(F.min("least").alias("component_id"))
    named = of_class.join(of_root, "root").select("fp", "component_id")
    linked = sets.where("n > 0").join(named, "fp").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return linked.union(sets.where("n = 0").select("doc_id", "n", "doc_id"))


def component_firsts(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) of the first row of each component by doc_id, then set; a
    row without words is a component of its own."""
    sets, of_class = _classes(docs)
    # a class without any doc_id stands for its component only if no other does
    firsts = of_class.groupBy("root").agg(F.min(F.struct(F.col("least").isNull().alias("none"), "least", "fp")).alias("x"))
    return firsts.select(F.col("x.least").alias("doc_id"), "x.fp").union(sets.where("n = 0").select("doc_id", "fp").distinct())


def with_set(docs: DataFrame, name: str) -> DataFrame:
    """All rows and columns, and the fingerprint of the row's set of shingles."""

    def run(batches):
        for batch in batches:
            for part, texts in slices(batch, limit=SET_BYTES):
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(_sets(texts)[3])], [*part.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())]))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(load(spark, sf_dir, "documents"))


#: All links by a plain join on shingles, one row for each set, and reachability over them.
ORACLE_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), s AS (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(words) BETWEEN 1 AND 4 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 3), lambda k: array_to_string(words[k:k + 4], ' ')) END)) AS shingles
  FROM w
), sets AS (
  SELECT doc_id, len(shingles) AS n, md5(array_to_string(shingles, chr(10))) AS class, shingles FROM s
), classes AS (
  SELECT class, min(doc_id) AS least, any_value(n) AS n, any_value(shingles) AS shingles FROM sets WHERE n > 0 GROUP BY class
), x AS (
  SELECT class, n, unnest(shingles) AS shingle FROM classes
), links AS (
  SELECT a.class AS u, b.class AS v FROM x a JOIN x b ON a.shingle = b.shingle AND a.class < b.class
  WHERE 100 * least(a.n, b.n) >= 75 * greatest(a.n, b.n)
  GROUP BY a.class, b.class HAVING 100 * count(*) >= 75 * (any_value(a.n) + any_value(b.n) - count(*))
), edges AS (
  SELECT u, v FROM links UNION ALL SELECT v, u FROM links
), reach AS (
  SELECT class AS node, least FROM classes
  UNION
  SELECT e.v, r.least FROM reach r JOIN edges e ON e.u = r.node
), roots AS (
  SELECT node AS class, min(least) AS component_id FROM reach GROUP BY node
)
SELECT doc_id, n AS n_shingles, coalesce(component_id, doc_id) AS component_id
FROM sets LEFT JOIN roots ON sets.class = roots.class AND n > 0
"""
