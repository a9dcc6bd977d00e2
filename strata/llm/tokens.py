"""Fast tokenisation of whole texts with a public tokenizer file.

A byte-level BPE splits a text before merging, and never inside a run of
``white space + other characters``. Texts are cut there, each distinct piece of
a task is encoded about once, and the ids are gathered back in text order. The
ids are those of encoding each whole text.

New pieces are encoded many at a time, end to end: as a piece starts with white
space and ends without, its neighbours change nothing, and the byte lengths of
the ids tell where it ends.
"""
from __future__ import annotations

import itertools
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from strata.llm.common import SPACES, Texts, span_hashes

#: Pieces kept from slice to slice in a task.
CACHE_PIECES = 1_000_000
#: Bytes of text encoded at once: the arrays of pieces and ids for them are some 40 times as large.
TEXT_BYTES = 1 << 20
#: Pieces encoded as one string.
RUN = 256
#: Strings encoded at once: the tokenizer describes every id of them in some 200 bytes.
STRINGS = 64


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _pieces(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the pieces: a cut lies before white space that
    follows a character which is no white space in Unicode either."""
    buf, n = texts.buf, len(texts.buf)
    space = SPACES[buf]
    cut = np.zeros(n + 1, bool)
    if n:
        before = np.concatenate([[True], space[:-1]])
        cut[:-1] = space & ~before
        at = np.flatnonzero(cut[:-1])
        cut[at[_odd_end(buf, at)]] = False
    cut[texts.offsets] = True
    edges = np.flatnonzero(cut)
    return edges[:-1], edges[1:]


def _odd_end(buf: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether the character before each end may be a Unicode space: those are
    C2 xx, or E1..E3 xx xx."""
    two, three = buf[np.maximum(ends - 2, 0)], buf[np.maximum(ends - 3, 0)]
    return (two == 0xC2) | ((three >= 0xE1) & (three <= 0xE3))


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """np.unique with first places and inverse, but only distinct keys are sorted."""
    coded = pa.array(keys).dictionary_encode()
    code, found = coded.indices.to_numpy(), coded.dictionary.to_numpy()
    first = np.empty(len(found), np.int64)
    first[code[::-1]] = np.arange(len(keys))[::-1]
    order = np.argsort(found)
    rank = np.empty(len(found), np.int64)
    rank[order] = np.arange(len(found))
    return found[order], first[order], rank[code]


class Encoder:
    """Encodes slices of texts; keeps pieces between slices."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        vocabulary = self._tokenizer.get_vocab(with_added_tokens=True)
        self._bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)  # a character of the byte alphabet is a byte
        self._bytes[list(vocabulary.values())] = list(map(len, vocabulary))
        self._forget()

    def _forget(self) -> None:
        self._keys = np.zeros(0, np.uint64)
        self._starts, self._lens, self._ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def _batch(self, strings: Iterator[str]) -> Iterator[np.ndarray]:
        """The ids of each string, made for few strings at once."""
        while some := list(itertools.islice(strings, STRINGS)):
            found = [np.array(e.ids, np.uint32) for e in self._tokenizer.encode_batch_fast(some, add_special_tokens=False)]
            yield from found

    def _encode(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(lengths, ids) of pieces."""
        raw, n = buf.tobytes(), len(starts)
        bare = ~SPACES[buf[starts]]  # the first piece of a text: a line feed, one id, goes before it
        alone = SPACES[buf[ends - 1]] | _odd_end(buf, ends) | (bare & np.isin(buf[starts], (0xC2, 0xE1, 0xE2, 0xE3)))
        together = np.flatnonzero(~alone)
        lens = np.zeros(n, np.int64)
        out: list[np.ndarray] = []
        runs = [together[i : i + RUN] for i in range(0, len(together), RUN)]

        def text(run: np.ndarray) -> str:
            return b"".join([(b"\n" if x else b"") + raw[a:b] for x, a, b in zip(bare[run].tolist(), starts[run].tolist(), ends[run].tolist(), strict=True)]).decode()

        for run, ids in zip(runs, self._batch(map(text, runs)), strict=True):
            ends_at = np.cumsum(ends[run] - starts[run] + bare[run])
            last = np.searchsorted(np.cumsum(self._bytes[ids]), ends_at) + 1
            count = np.diff(last, prepend=0)
            first = last - count
            keep = np.ones(len(ids), bool)
            keep[first[bare[run]]] = False
            lens[run] = count - bare[run]
            out.append(ids[keep])
        apart = np.flatnonzero(alone)
        found = list(self._batch(raw[starts[i] : ends[i]].decode() for i in apart.tolist()))
        lens[apart] = list(map(len, found))
        out += found
        order = np.concatenate([together, apart])
        at = np.empty(n, np.int64)
        at[order] = np.cumsum(lens[order]) - lens[order]
        return lens, _gather(np.concatenate(out) if out else np.zeros(0, np.uint32), at, lens)

    def encode(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets): the ids of each text are ids[offsets[i]:offsets[i + 1]]."""
        starts, ends = _pieces(texts)
        keys, where, inverse = _distinct(span_hashes(texts.buf, starts, ends))
        if len(self._keys) + len(keys) > CACHE_PIECES:
            self._forget()
        at = np.searchsorted(self._keys, keys)
        known = np.zeros(len(keys), bool)
        inside = at < len(self._keys)
        known[inside] = self._keys[at[inside]] == keys[inside]
        new = np.flatnonzero(~known)
        if len(new):
            lens, ids = self._encode(texts.buf, starts[where[new]], ends[where[new]])
            self._starts = np.insert(self._starts, at[new], len(self._ids) + np.cumsum(lens) - lens)
            self._keys, self._lens = np.insert(self._keys, at[new], keys[new]), np.insert(self._lens, at[new], lens)
            self._ids = np.concatenate([self._ids, ids])
            at = np.searchsorted(self._keys, keys)
        at = at[inverse]
        lens = self._lens[at]
        total = np.concatenate([[0], np.cumsum(lens)])
        return _gather(self._ids, self._starts[at], lens), total[np.searchsorted(starts, texts.offsets)]


def _gather(values: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """values[s:s + n] for every (s, n), end to end."""
    ends = np.cumsum(lens)
    out = np.arange(int(ends[-1]) if len(ends) else 0)
    return values[out + np.repeat(starts - (ends - lens), lens)]


def with_end(ids: np.ndarray, offsets: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The same texts, each followed by the id ``end``."""
    return np.insert(ids, offsets[1:], np.uint32(end)).astype(np.uint32), offsets + np.arange(len(offsets))


def ids_column(ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """One binary value of little-endian unsigned 32-bit ids for each text."""
    data = ids.astype("<u4")
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer((4 * offsets).astype(np.int64)), pa.py_buffer(data)]).cast(pa.binary())
