"""License scans over a positional rare-token index.

The index holds, for every word of the licence templates, the templates and
positions at which it stands. Of each template the highest-IDF words are looked
up wherever a text holds them; each posting votes for a template at a relative
position (text position less template position). So many words of a template
vote that a place with the share of words needed has enough votes whichever
words were changed, however long the text and whatever else it holds. Where
enough votes agree, the template is laid over the text there, the share of its
words that stand in place is the score, and its mandatory key phrases must
stand in that stretch.

The four base phrases are templates of their own, counted at every place: the
rarest word of a phrase is looked up and the others are checked around it.

IDF comes from the document frequencies of the licence words over all
documents; the vocabulary is that of the templates, so counts and index have a
fixed size.

Defined results: a null or empty text has no words, no labels and score 0;
repeated rows each get their own result; an empty table gives an empty one.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import NON_ALNUM, load, slices, span_hashes, text_rows, texts_of, words_of

# Base phrases and labels, then notices (label, mandatory key phrases, text).
BASE = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))
NOTICES = (
    ("apache-2.0", ("apache license", "version 2 0"), "licensed under the apache license version 2 0"),
    ("apache-2.0", ("apache license", "required by applicable law"), "you may not use this file except in compliance with the license you may obtain a copy of the license at unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("gpl-notice", ("free software", "gnu general public license"), "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version"),
    ("mit-notice", ("permission is hereby granted",), "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("bsd-notice", ("redistribution and use",), "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl-2.0", ("mozilla public license",), "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-notice", ("creative commons attribution",), "this work is licensed under a creative commons attribution 4 0 international license"),
)
#: Votes that make a candidate, share of words in place.
MIN_VOTES, MIN_SHARE = 3, 0.7

_FOUND = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


class Index:
    """Vocabulary, templates and, given the words' IDF, postings of each template's rarest words."""

    def __init__(self, idf: np.ndarray | None = None):
        texts = [p for p, _ in BASE] + [t for _, _, t in NOTICES]
        keys = [k for _, ks, _ in NOTICES for k in ks]
        vocabulary = sorted({w for t in texts + keys for w in t.split()})
        packed = texts_of(pa.array(vocabulary))
        hashes = span_hashes(packed.buf, packed.offsets[:-1], packed.offsets[1:])
        order = np.argsort(hashes)
        self.hashes, number = hashes[order], {vocabulary[i]: n for n, i in enumerate(order)}
        ids = lambda t: np.array([number[w] for w in t.split()])
        self.phrases = [ids(p) for p, _ in BASE]
        self.templates = [ids(t) for _, _, t in NOTICES]
        self.keys = [[ids(k) for k in ks] for _, ks, _ in NOTICES]
        if idf is None:
            return
        # at most misses(n) of a template's places fail, so MIN_VOTES more than that always leave enough
        misses = lambda n: max(m for m in range(n) if (n - m) / n >= MIN_SHARE)
        rare = [np.argsort(-idf[t], kind="stable")[: misses(len(t)) + MIN_VOTES] for t in self.templates]
        word = np.concatenate([t[r] for t, r in zip(self.templates, rare, strict=True)])
        template = np.repeat(np.arange(len(NOTICES)), [len(r) for r in rare])
        place = np.concatenate(rare)
        order = np.argsort(word, kind="stable")
        self.template, self.place = template[order], place[order]
        self.first = np.searchsorted(word[order], np.arange(len(vocabulary) + 1))

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """The vocabulary number of each word, -1 for other words."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, at, -1)


def _numbers(index: Index, texts):
    texts = texts.lower()
    words = words_of(texts, NON_ALNUM)
    return words, index.numbers(span_hashes(texts.buf, words.starts, words.ends))


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Documents that hold each vocabulary word, and all documents."""

    def count(batches):
        index, seen, rows = Index(), None, 0
        seen = np.zeros(len(index.hashes) + 1, np.int64)
        for batch in batches:
            for _, texts in slices(batch):
                words, numbers = _numbers(index, texts)
                at = np.flatnonzero(numbers >= 0)
                pairs = np.unique(words.rows[at] * len(index.hashes) + numbers[at])
                seen[:-1] += np.bincount(pairs % len(index.hashes), minlength=len(index.hashes))
                seen[-1] += len(texts)
        yield pa.record_batch({"word": np.arange(len(seen)), "n": seen})

    found = text_rows(docs).mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()  # a row for each word
    out = np.zeros(len(Index().hashes) + 1)
    for r in found:
        out[r["word"]] = r["n"]
    return out[:-1], int(out[-1])


def _stands(numbers: np.ndarray, phrase: np.ndarray, at: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Whether the phrase stands whole at each place, within [low, high)."""
    ok = (at >= low) & (at + len(phrase) <= high)
    for k, w in enumerate(phrase):
        ok[ok] = numbers[at[ok] + k] == w
    return ok


def _scan(df: np.ndarray, total: int):
    def run(batches):
        idf = np.log((total + 1) / (df + 1))
        index = Index(idf)
        for batch in batches:
            for part, texts in slices(batch):
                words, numbers = _numbers(index, texts)
                rows, first, n = words.rows, words.first, len(texts)
                n_base, low, high, score = np.zeros(n, np.int64), np.full(n, 2**62), np.full(n, -1), np.zeros(n)
                base, found = [set() for _ in range(n)], [set() for _ in range(n)]
                for (_, label), phrase in zip(BASE, index.phrases, strict=True):
                    rare = int(np.argmax(idf[phrase]))
                    at = np.flatnonzero(numbers == phrase[rare]) - rare
                    own = rows[at + rare]
                    ok = _stands(numbers, phrase, at, first[own], first[own + 1])
                    at, own = at[ok], own[ok]
                    n_base += np.bincount(own, minlength=n)
                    np.minimum.at(low, own, at - first[own])
                    np.maximum.at(high, own, at - first[own])
                    for r in np.unique(own).tolist():
                        base[r].add(label)
                        score[r] = 1.0
                # the postings of the rare words vote for (template, place of its first word)
                at = np.flatnonzero(numbers >= 0)
                size = index.first[numbers[at] + 1] - index.first[numbers[at]]
                post = np.repeat(index.first[numbers[at]], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                where = np.repeat(at, size) - index.place[post]
                votes, n_votes = np.unique(np.column_stack([np.repeat(rows[at], size), index.template[post], where]), axis=0, return_counts=True)
                for r, t, begin in votes[n_votes >= MIN_VOTES].tolist():
                    template = index.templates[t]
                    a, b = max(begin, int(first[r])), min(begin + len(template), int(first[r + 1]))
                    share = float((numbers[a:b] == template[a - begin : b - begin]).sum() / len(template))
                    if share < MIN_SHARE:
                        continue
                    a, b = max(int(first[r]), a - 4), min(int(first[r + 1]), b + 4)
                    places = np.arange(a, b)
                    if all(_stands(numbers, k, places, np.full(len(places), a), np.full(len(places), b)).any() for k in index.keys[t]):
                        found[r].add(NOTICES[t][0])
                        score[r] = max(score[r], share)
                hit = n_base > 0
                join = lambda sets: pa.array([",".join(sorted(s)) for s in sets], pa.string())
                yield pa.record_batch(
                    {
                        "doc_id": part.column("doc_id"), "n_words": words.counts, "n_base": n_base,
                        "first_word": pa.array(low, pa.int64(), mask=~hit), "last_word": pa.array(high, pa.int64(), mask=~hit),
                        "base_labels": join(base), "labels": join([x | y for x, y in zip(base, found, strict=True)]), "score": score,
                    }
                )

    return run


def scan_licenses(docs: DataFrame) -> DataFrame:
    """Base places, labels and score of every document."""
    df, total = document_frequencies(docs)
    return text_rows(docs).mapInArrow(_scan(df, total), _FOUND)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(load(spark, sf_dir, "documents"))
