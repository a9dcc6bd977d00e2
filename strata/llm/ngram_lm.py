"""Language-model scoring from a log-frequency Bloom filter.

Counts of words and word pairs are gathered over all training documents. A
count is quantised to the level ``1 + floor(log(count) / log(BASE))``; the
filter holds the pair (n-gram, i) for every level i up to its own, so an
n-gram's level is read back by probing i = 1, 2, ... until a probe fails. An
error can only raise a level, and each further level is less likely.

The filter is never in one place: n-grams are dealt to segments by hash, the
number of segments follows the corpus and a segment's size its inserts. A chunk
of documents sends its distinct word pairs to the tasks of their segments once,
with their training counts; such a task fills its segment, reads the levels of
all pairs that were asked for, and returns them to their chunks. So documents
are read as often whatever the corpus, and no worker holds more than a segment.
A word pair and the word it begins with lie in the same segment, unless that word
is frequent: the pairs of a word with over ``HOT_TOKENS`` uses are dealt to
several segments by pair, so no task holds all followers of a common word. Its
number of distinct followers is then the sum over its segments; there are at
most tokens / ``HOT_TOKENS`` such words, and each worker has their sums.

Score: interpolated absolute discounting. After h, a word w has
(c(hw) - D) / c(h), if seen there, plus lambda(h) * p(w), p being the smoothed
word probability of the base score and lambda(h) the share that discounts
leave. Every training pair is in the filter, those seen once at level 1. The
counts c(hw) and c(h) and the number of distinct followers behind lambda(h)
come from the filter, p(w) from exact word counts.

Word counts reach the texts without a broadcast: each task lists the distinct
words of a chunk of documents, counts meet by word hash, and are returned to
the chunk.

Defined results: a null or empty text is one end token; repeated rows are
counted and scored each; an empty table gives an empty result; with no
training token at all every probability is that of the smoothed base.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import crc_mod, load, mix, salted, slices, span_hashes, staged, text_rows, words_of

FOLDS = 10
SMOOTH = 0.1
#: Quantisation base, discount, probes a level, bits an insert.
BASE, DISCOUNT, PROBES, BITS = 2.0, 0.6, 6, 10
#: Bytes of hashes that a task reads back from its segment at once.
BLOCK_BYTES = 64 << 20
SEGMENTS, SEGMENT_TOKENS = 64, 1 << 20
#: Uses of a word for each segment that its pairs are dealt to.
HOT_TOKENS = SEGMENT_TOKENS // 4
#: Bytes of text in a chunk.
CHUNK_BYTES = 4 << 20
#: The end token, and what stands before a text's first token.
END, START = np.uint64(0x656E6400), np.uint64(0x73746172)

_CHUNKS = "chunk long, doc_ids array<long>, held array<boolean>, sizes array<int>, words binary, at binary"
_WORDS = "bucket int, chunk long, words binary, counts binary, asked binary"
_REPLIES = "chunk long, bucket int, counts binary, tokens long, distinct long, hot binary, hot_uses binary, hot_asked binary"
_PAIRS = "bucket int, chunk long, first binary, runs binary, pairs binary, counts binary"
_LEVELS = "chunk long, bucket int, seen binary, about binary, hot binary, followers binary"
_SCORES = "chunk long, nth int, doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _bucket(h: np.ndarray, n: int) -> np.ndarray:
    return ((h >> np.uint64(40)) % np.uint64(n)).astype(np.int64)


def _by_bucket(owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in order of their bucket, and each bucket's edges."""
    members = np.argsort(owner, kind="stable")
    return members, np.searchsorted(owner[members], np.arange(n + 1))


def _pair(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(before * np.uint64(0x9E3779B97F4A7C15) + salted(word, 21))


@dataclass
class Frequent:
    """Words, in order, whose pairs are dealt to several segments."""

    words: np.ndarray
    uses: np.ndarray
    grain: int  # uses a segment
    followers: np.ndarray | None = None
    asked: np.ndarray | None = None  # uses outside the training documents

    def find(self, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(numbers, whether frequent) of pairs' first words."""
        if not len(self.words):
            return np.zeros(len(begin), np.int64), np.zeros(len(begin), bool)
        at = np.minimum(np.searchsorted(self.words, begin), len(self.words) - 1)
        return at, self.words[at] == begin

    def segments(self, begin: np.ndarray, pairs: np.ndarray, buckets: int) -> np.ndarray:
        """Each pair's segment: its first word's, or one of those of a frequent word."""
        at, hot = self.find(begin)
        key = begin.copy()
        uses = self.uses if self.asked is None else np.maximum(self.uses, self.asked)
        part = pairs[hot] % (-(-uses[at[hot]] // self.grain)).astype(np.uint64)
        with np.errstate(over="ignore"):
            key[hot] = mix(begin[hot] + part * np.uint64(0x9E3779B97F4A7C15))
        return _bucket(key, buckets)


def _tokens(texts) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets): the words of each lower-cased text, then its end."""
    texts = texts.lower()
    words = words_of(texts)
    hashes = span_hashes(texts.buf, words.starts, words.ends)
    return np.insert(hashes, words.first[1:], END), words.first + np.arange(len(words.first))


def _pack(at: np.ndarray) -> bytes:
    """Word numbers in byte planes: the high bytes cost next to nothing."""
    return zstandard.ZstdCompressor(level=1).compress(at.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def _unpack(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


def _chunks(batches):
    part, nth = TaskContext.get().partitionId(), 0
    for batch in batches:
        for rows, texts in slices(batch, limit=CHUNK_BYTES):
            hashes, offsets = _tokens(texts)
            words, at = np.unique(hashes, return_inverse=True)
            yield pa.record_batch(
                {
                    "chunk": pa.array([(part << 32) + nth], pa.int64()), "doc_ids": pa.array([rows.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                    "held": pa.array([rows.column("held_out").to_pylist()], pa.list_(pa.bool_())), "sizes": pa.array([np.diff(offsets).astype(np.int32)], pa.list_(pa.int32())),
                    "words": pa.array([words.tobytes()], pa.binary()), "at": pa.array([_pack(at)], pa.binary()),
                }
            )
            nth += 1


def _open(row) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(words, at, sizes, in_training) of a chunk row."""
    words, at = np.frombuffer(row["words"], np.uint64), _unpack(row["at"])
    sizes = np.array(row["sizes"], np.int64)
    return words, at, sizes, np.repeat(~np.array(row["held"], bool), sizes)


def _rows(batches):
    for b in batches:
        for i in range(b.num_rows):
            yield b.slice(i, 1).to_pylist()[0]


def _joined(column, kind, order=None) -> np.ndarray:
    """The arrays behind a column of binaries in one, in the order given."""
    cut = [np.frombuffer(v.as_buffer(), kind) for v in column]
    return np.concatenate([np.zeros(0, kind), *(cut if order is None else (cut[k] for k in order))])


@dataclass
class Pairs:
    """The distinct word pairs of a chunk, by segment and by first word in it."""

    begin: np.ndarray  # hash of the first word
    second: np.ndarray  # number of the second
    keys: np.ndarray
    edges: np.ndarray  # of segments, buckets + 1
    heads: np.ndarray  # where a run of one first word in one segment begins
    place: np.ndarray  # each token's pair


def _pairs_of(words: np.ndarray, at: np.ndarray, sizes: np.ndarray, buckets: int, hot: Frequent) -> Pairs:
    before = np.concatenate([[-1], at[:-1]])
    before[np.cumsum(sizes) - sizes] = -1
    pairs, inverse = np.unique((before + 1) * (len(words) + 1) + at, return_inverse=True)
    first, second = pairs // (len(words) + 1) - 1, pairs % (len(words) + 1)
    begin = np.where(first < 0, START, words[np.maximum(first, 0)])
    keys = _pair(begin, words[second])
    members, edges = _by_bucket(hot.segments(begin, keys, buckets), buckets)
    place = np.empty(len(members), np.int64)
    place[members] = np.arange(len(members))
    begin = begin[members]
    head = np.ones(len(members), bool)
    head[1:] = begin[1:] != begin[:-1]
    head[edges[:-1][np.diff(edges) > 0]] = True
    return Pairs(begin, second[members], keys[members], edges, np.flatnonzero(head), place[inverse])


def _word_lists(buckets: int):
    """The words of a chunk by bucket, with their uses in and out of training."""

    def run(batches):
        for row in _rows(batches):
            words, at, _, training = _open(row)
            counts, asked = (np.bincount(at[x], minlength=len(words)).astype(np.uint32) for x in (training, ~training))
            order, edges = _by_bucket(_bucket(words, buckets), buckets)
            used = np.flatnonzero(np.diff(edges))
            cut = [order[edges[k] : edges[k + 1]] for k in used]
            yield pa.record_batch(
                {
                    "bucket": used.astype(np.int32), "chunk": np.full(len(used), row["chunk"]), "words": pa.array([words[c].tobytes() for c in cut], pa.binary()),
                    "counts": pa.array([counts[c].tobytes() for c in cut], pa.binary()), "asked": pa.array([asked[c].tobytes() for c in cut], pa.binary()),
                }
            )

    return run


def _pair_lists(buckets: int, hot: Frequent):
    """All word pairs of a chunk, dealt to segments, with their training counts."""

    def run(batches):
        for row in _rows(batches):
            words, at, sizes, training = _open(row)
            pairs = _pairs_of(words, at, sizes, buckets, hot)
            counts = np.bincount(pairs.place[training], minlength=len(pairs.keys)).astype(np.uint32)
            runs = np.diff(pairs.heads, append=len(pairs.keys)).astype(np.uint32)
            used = np.flatnonzero(np.diff(pairs.edges))
            cut = [slice(pairs.edges[k], pairs.edges[k + 1]) for k in used]
            heads = np.searchsorted(pairs.heads, pairs.edges)
            cut_heads = [slice(heads[k], heads[k + 1]) for k in used]
            first = pairs.begin[pairs.heads]
            yield pa.record_batch(
                {
                    "bucket": used.astype(np.int32), "chunk": np.full(len(used), row["chunk"]),
                    "first": pa.array([first[c].tobytes() for c in cut_heads], pa.binary()), "runs": pa.array([runs[c].tobytes() for c in cut_heads], pa.binary()),
                    "pairs": pa.array([pairs.keys[c].tobytes() for c in cut], pa.binary()), "counts": pa.array([counts[c].tobytes() for c in cut], pa.binary()),
                }
            )

    return run


def _word_counts(hot_tokens: int):
    """One bucket: total each word's counts and answer every chunk."""

    def run(table: pa.Table) -> pa.Table:
        words = [np.frombuffer(w.as_buffer(), np.uint64) for w in table["words"]]
        unique, inverse = np.unique(np.concatenate(words), return_inverse=True)
        total, asked = (np.bincount(inverse, _joined(table[name], np.uint32), len(unique)).astype(np.int64) for name in ("counts", "asked"))
        ends = np.cumsum([len(w) for w in words])
        answers = np.split(total[inverse].astype(np.uint32), ends[:-1])
        n, known, hot = table.num_rows, int((total > 0).sum()), (total > hot_tokens) | (asked > hot_tokens)
        # the bucket's totals and frequent words ride on its first row
        head = lambda x, none, kind: pa.array([x] + [none] * (n - 1), kind)
        return pa.table(
            {
                "chunk": table["chunk"], "bucket": table["bucket"], "counts": pa.array([a.tobytes() for a in answers], pa.binary()), "tokens": head(int(total.sum()), 0, pa.int64()), "distinct": head(known, 0, pa.int64()),
                "hot": head(unique[hot].tobytes(), None, pa.binary()), "hot_uses": head(total[hot].tobytes(), None, pa.binary()), "hot_asked": head(asked[hot].tobytes(), None, pa.binary()),
            }
        )

    return run


def _frequent(replies: DataFrame, hot_tokens: int) -> Frequent:
    found = replies.where(F.length("hot") > 0).select("hot", "hot_uses", "hot_asked").collect()  # at most tokens / hot_tokens words
    words = np.frombuffer(b"".join(r["hot"] for r in found), np.uint64)
    words = np.where(words == END, START, words)  # a text's first pair begins with START, and none with its end
    uses, asked = (np.frombuffer(b"".join(r[name] for r in found), np.int64) for name in ("hot_uses", "hot_asked"))
    order = np.argsort(words)
    return Frequent(words[order], uses[order], hot_tokens, np.zeros(len(words), np.int64), asked[order])


def level(counts: np.ndarray) -> np.ndarray:
    return 1 + np.floor(np.log(np.maximum(counts, 1)) / np.log(BASE) + 1e-9).astype(np.int64)


def expected(levels: np.ndarray) -> np.ndarray:
    """The middle of the counts that share a level; 0 for level 0."""
    low = BASE ** (levels - 1)
    return np.where(levels > 0, (low + np.maximum(low, BASE * low - 1)) / 2, 0.0)


def _bit_places(keys: np.ndarray, i: int, n_bits: int):
    for k in range(PROBES):
        yield (salted(keys, 1000 + 16 * i + k) % np.uint64(n_bits)).astype(np.int64)


def build_filter(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The bits of a log-frequency Bloom filter, ``BITS`` for each insert."""
    levels = level(counts)
    n_bits = 8 * max(8, -(-int(levels.sum()) * BITS // 8))  # whole bytes: readers take the size from them
    bits = np.zeros(n_bits, bool)
    for i in range(1, int(levels.max()) + 1 if len(levels) else 1):
        for at in _bit_places(keys[levels >= i], i, n_bits):
            bits[at] = True
    return np.packbits(bits, bitorder="little")


def probe(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Each key's level: probes for 1, 2, ... until one fails."""
    n_bits = 8 * len(bits)
    out, live, i = np.zeros(len(keys), np.int64), np.arange(len(keys)), 0
    while len(live):
        i += 1
        hit = np.ones(len(live), bool)
        for at in _bit_places(keys[live], i, n_bits):
            hit &= (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
        live = live[hit]
        out[live] = i
        if i == 64:
            break
    return out


def _probed(bits: np.ndarray, keys: np.ndarray, block_bytes: int) -> np.ndarray:
    """``probe`` for a block of keys at a time: levels are 64 at most."""
    step = max(1, block_bytes // keys.itemsize)
    return np.concatenate([np.zeros(0, np.uint8), *(probe(bits, keys[k : k + step]).astype(np.uint8) for k in range(0, len(keys), step))])


def _segment(hot: Frequent, block_bytes: int):
    """One bucket: count its pairs, fill its segment of the filter with pairs,
    contexts and numbers of followers, and answer every chunk with the levels
    read back; followers of frequent words are told."""

    def run(table: pa.Table) -> pa.Table:
        runs, asked = _joined(table["runs"], np.uint32).astype(np.int64), _joined(table["pairs"], np.uint64)
        first, heads = _joined(table["first"], np.uint64), np.cumsum(runs) - runs
        pairs, where, inverse = np.unique(asked, return_index=True, return_inverse=True)
        n = np.bincount(inverse, _joined(table["counts"], np.uint32), len(pairs)).astype(np.int64)
        contexts, of_run = np.unique(first, return_inverse=True)
        owner = np.repeat(of_run, runs)[where]
        seen = n > 0  # the others are only asked for
        uses = np.bincount(owner, n, len(contexts)).astype(np.int64)
        mass = np.bincount(owner[seen], minlength=len(contexts))  # distinct followers
        at, told = hot.find(contexts)
        own = ~told & (uses > 0)
        keys = np.concatenate([pairs[seen], salted(contexts[own], 31), salted(contexts[own], 32)])
        bits = build_filter(keys, np.concatenate([n[seen], uses[own], mass[own]]))
        levels = _probed(bits, pairs, block_bytes)[inverse]
        about = np.stack([_probed(bits, salted(contexts, s), block_bytes) for s in (31, 32)], axis=1)[of_run]
        sizes, head_sizes = ([len(v.as_buffer()) // 8 for v in table[name]] for name in ("pairs", "first"))
        head = lambda x: pa.array([x.astype(np.int64).tobytes()] + [None] * (table.num_rows - 1), pa.binary())
        return pa.table(
            {
                "chunk": table["chunk"], "bucket": table["bucket"], "seen": pa.array([x.tobytes() for x in np.split(levels, np.cumsum(sizes)[:-1])], pa.binary()),
                "about": pa.array([x.tobytes() for x in np.split(about, np.cumsum(head_sizes)[:-1])], pa.binary()), "hot": head(at[told]), "followers": head(mass[told]),
            }
        )

    return run


def _score(buckets: int, tokens: int, distinct: int, hot: Frequent):
    """Base columns and the model's log probability of a chunk's documents."""
    floor = tokens + SMOOTH * (distinct + 1)

    def run(table: pa.Table) -> pa.Table:
        chunk = table.filter(pc.is_valid(table["doc_ids"])).to_pylist()[0]
        words, at, sizes, _ = _open(chunk)

        def answers(name: str, kind) -> np.ndarray:  # in the order they were asked for
            rows = table.filter(pc.is_valid(table[name]))
            return _joined(rows[name], kind, np.argsort(rows["bucket"].to_numpy()))

        counts = np.zeros(len(words), np.int64)
        counts[_by_bucket(_bucket(words, buckets), buckets)[0]] = answers("counts", np.uint32)
        n = len(sizes)
        row = np.repeat(np.arange(n), sizes)
        log_p = np.log10((counts + SMOOTH) / floor)
        known = np.bincount(row, counts[at] > 0, n).astype(np.int64)
        plain = np.bincount(row, log_p[at], n)
        # the model: distinct (context, word) pairs of the chunk
        pairs = _pairs_of(words, at, sizes, buckets, hot)
        seen, levels = expected(answers("seen", np.uint8).astype(np.int64)), answers("about", np.uint8).reshape(-1, 2).astype(np.int64)
        number, told = hot.find(pairs.begin[pairs.heads])
        for k, sums in enumerate((hot.uses, hot.followers)):
            told_sums = sums[number[told]]
            levels[told, k] = np.where(told_sums > 0, level(told_sums), 0)
        uses, mass = expected(levels[:, 0]), expected(levels[:, 1])
        total = np.maximum(uses, mass)
        # the discounted rest backs off
        rest = np.clip(DISCOUNT * mass / np.maximum(total, 1.0), 1e-3, 1.0)
        to = np.repeat(np.arange(len(pairs.heads)), np.diff(pairs.heads, append=len(pairs.keys)))
        direct = np.maximum(seen - DISCOUNT, 0.0)
        backoff = np.where(uses > 0, np.log10(rest), 0.0)[to] + log_p[pairs.second]
        p = np.minimum(np.where(seen > 0, direct, 0.0) / np.maximum(total, 1.0)[to], 1.0) + 10.0**backoff
        model = np.bincount(row, np.log10(np.minimum(p, 1.0))[pairs.place], n)
        return pa.table(
            {
                "chunk": np.full(n, chunk["chunk"]), "nth": np.arange(n, dtype=np.int32), "doc_id": pa.array(chunk["doc_ids"], pa.int64()), "held_out": pa.array(chunk["held"], pa.bool_()), "n_tokens": pa.array(sizes, pa.int64()),
                "n_known": pa.array(known, pa.int64()), "train_tokens": pa.array(np.full(n, tokens), pa.int64()), "base_score": pa.array(plain), "score": pa.array(model),
            }
        )

    return run


def score_documents(docs: DataFrame, folds: int = FOLDS, block_bytes: int = BLOCK_BYTES, hot_tokens: int = HOT_TOKENS) -> DataFrame:
    """Scores of all documents by a model of those outside fold 0."""
    spark = docs.sparkSession
    rows = text_rows(docs).withColumn("held_out", crc_mod("doc_id", folds) == 0)
    chunks = staged(rows.mapInArrow(_chunks, _CHUNKS), "op1-chunks")
    # segments follow the input, so each one's pairs fit a task
    size = chunks.agg(F.sum(F.expr("aggregate(sizes, 0L, (a, x) -> a + x)"))).first()[0]
    if not size:
        return spark.createDataFrame([], _SCORES).drop("chunk", "nth")
    buckets = max(SEGMENTS, int(size // SEGMENT_TOKENS))
    lists = chunks.mapInArrow(_word_lists(buckets), _WORDS)
    replies = staged(lists.groupBy("bucket").applyInArrow(_word_counts(hot_tokens), _REPLIES), "op1-words")
    tokens, distinct = replies.agg(F.sum("tokens"), F.sum("distinct")).first()
    hot = _frequent(replies, hot_tokens)
    pairs = chunks.mapInArrow(_pair_lists(buckets, hot), _PAIRS)
    levels = staged(pairs.groupBy("bucket").applyInArrow(_segment(hot, block_bytes), _LEVELS), "op1-filter")
    for r in levels.where(F.length("hot") > 0).select("hot", "followers").collect():  # at most two for each hot_tokens tokens
        np.add.at(hot.followers, np.frombuffer(r["hot"], np.int64), np.frombuffer(r["followers"], np.int64))
    together = chunks
    for answers in (replies.select("chunk", "bucket", "counts"), levels.select("chunk", "bucket", "seen", "about")):
        together = together.unionByName(answers, allowMissingColumns=True)
    return together.groupBy("chunk").applyInArrow(_score(buckets, int(tokens), int(distinct), hot), _SCORES).drop("chunk", "nth")


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(load(spark, sf_dir, "documents"))
