"""Personal data by weak supervision.

Candidate spans come from patterns. Four labelers vote on each (yes, no or
abstain): the strict pattern, a gazetteer of what such data looks like, the
words before the span, and its shape. Expectation-maximisation over the vote
patterns of all documents estimates each labeler's reliability without any
labelled row, and its posteriors train the final span classifier, a logistic
regression on the votes. Votes are counted by pattern in Spark, so the driver
sees a few hundred counts at most, whatever the corpus.

Spans of the base rule always stay; the classifier decides on the others
(secrets in assignments, social security numbers, and base-like matches that
fail the base rule). Offsets are code points of the whole text, end exclusive.

Defined results: a null or empty text has no spans; repeated rows each have
their own; an empty table gives an empty result. All patterns are matched in
time linear in the text.
"""
from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import load, text_rows

KINDS = ("email", "ip", "card", "phone", "secret", "ssn")
BASE = KINDS[:4]

_RUN = re.compile(r"[A-Za-z0-9._%+@-]+")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_SECRET = re.compile(r"\b(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)\b[\"']?[ ]?[=:][ ]?[\"']?([^\s\"',;]+)", re.IGNORECASE)
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_DIGIT = re.compile(r"[0-9]")

# The gazetteer of the second labeler and the cue words of the third.
_TOP_DOMAINS = frozenset("com org net edu gov mil int info biz io co uk de fr es eu us ca".split())
_RESERVED_NETS = frozenset({"0", "10", "127", "169", "192", "224", "240", "255"})
_CUES = {
    "email": "mail e-mail email contact write to from reply",
    "ip": "ip address host server login from",
    "card": "card visa mastercard amex credit debit payment pan number",
    "phone": "phone tel telephone call mobile cell fax contact",
    "secret": "login user username account credentials",
    "ssn": "ssn social security",
}
_AGAINST = frozenset("version v release isbn issn order page chapter figure build section invoice".split())


def _luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int, bool]]:
    for run in _RUN.finditer(text) if "@" in text else ():
        begin, end = run.span()
        at = text.find("@", begin, end)
        while at >= 0:
            # every character since ``begin`` may stand before the sign, so the
            # leftmost start is the match's; if the domain fails, no start helps
            found = _DOMAIN.match(text, at + 1, end) if at > begin else None
            if found:
                yield begin, found.end(), True
            begin = found.end() if found else at + 1
            at = text.find("@", begin, end)


def _ips(text: str) -> Iterator[tuple[int, int, bool]]:
    for run in _DOTTED.finditer(text):
        parts, at = run.group().split("."), run.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            size = sum(map(len, four)) + 3
            yield at, at + size, all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in four)
            at += size + 1


def _cards(text: str) -> Iterator[tuple[int, int, bool]]:
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19:
            yield *m.span(), len(digits) >= 14 and _luhn(digits)


def _phones(text: str) -> Iterator[tuple[int, int, bool]]:
    for m in _PHONE.finditer(text) if "+" in text else ():
        yield *m.span(), 10 <= sum(c.isdigit() for c in m.group()) <= 15


def candidates(text: str) -> list[tuple[int, int, int, bool]]:
    """(start, kind, end, base) of every candidate, in order."""
    out = [(a, 0, b, ok) for a, b, ok in _emails(text)]
    if _DIGIT.search(text):
        for kind, find in ((1, _ips), (2, _cards), (3, _phones)):
            out += [(a, kind, b, ok) for a, b, ok in find(text)]
        out += [(*m.span()[:1], 5, m.end(), False) for m in _SSN.finditer(text)]
    if "=" in text or ":" in text:
        out += [(m.start(1), 4, m.end(1), False) for m in _SECRET.finditer(text)]
    return sorted(out)


def _entropy(s: str) -> float:
    n = np.unique(list(s), return_counts=True)[1] / len(s)
    return float(-(n * np.log2(n)).sum())


def votes(text: str, start: int, kind: int, end: int, base: bool) -> tuple[int, ...]:
    """One vote of each labeler: 1 personal data, 0 not, -1 abstains."""
    span, name = text[start:end], KINDS[kind]
    digits = sum(c.isdigit() for c in span)
    if name in BASE:
        strict = int(base)
    else:
        strict = 1 if name == "ssn" or (len(span) >= 8 and digits) else -1
    if name == "email":
        gazetteer = int(span.rsplit(".", 1)[-1].lower() in _TOP_DOMAINS)
    elif name == "ip":
        gazetteer = 0 if span.split(".")[0] in _RESERVED_NETS else -1
    elif name == "card":
        gazetteer = 1 if span[0] in "3456" else 0
    elif name == "ssn":
        gazetteer = 0 if span[:3] in ("000", "666") or span[0] == "9" or span[4:6] == "00" or span[7:] == "0000" else 1
    else:
        gazetteer = -1
    before = re.findall(r"[a-z-]+", text[max(0, start - 32) : start].lower())
    context = 0 if _AGAINST & set(before) else 1 if set(_CUES[name].split()) & set(before) else -1
    if name == "secret":
        shape = 1 if len(span) >= 8 and _entropy(span) >= 2.5 else 0
    elif name == "email":
        shape = -1
    else:
        shape = 0 if len(set(filter(str.isdigit, span))) <= 2 else 1 if name in ("card", "phone", "ssn") else -1
    return strict, gazetteer, context, shape


def _features(kind: int, vote: tuple[int, ...]) -> list[float]:
    return [float(kind == k) for k in range(len(KINDS))] + [float(v == x) for v in vote for x in (0, 1)]


def estimate(patterns: dict[tuple[int, tuple[int, ...]], int], rounds: int = 50, prior: float = 2.0) -> dict:
    """EM over (kind, votes) counts: each labeler's chance to say yes on
    personal data and on other text, and each pattern's posterior."""
    keys = sorted(patterns)
    count = np.array([patterns[k] for k in keys], float)
    vote = np.array([k[1] for k in keys])
    said = vote >= 0
    yes = np.where(said, vote, 0)
    # begin from the majority of the votes that were cast
    posterior = (yes.sum(1) + 0.5) / (said.sum(1) + 1.0)
    for _ in range(rounds):
        weight = count * posterior
        share = (weight.sum() + 1) / (count.sum() + 2)
        rates = []
        for w, lean in ((weight, 0.8), (count - weight, 0.2)):
            rates.append(((w[:, None] * yes).sum(0) + prior * lean) / ((w[:, None] * said).sum(0) + prior))
        logs = [np.where(said, np.log(np.where(yes, r, 1 - r)), 0).sum(1) for r in rates]
        posterior = 1 / (1 + np.exp(np.clip(logs[1] + np.log(1 - share) - logs[0] - np.log(share), -50, 50)))
    return {"keys": keys, "posterior": posterior, "sensitivity": rates[0], "false_alarm": rates[1], "count": count}


def train_classifier(em: dict, steps: int = 400, rate: float = 0.5, ridge: float = 1e-3) -> tuple[np.ndarray, float]:
    """Logistic regression on the votes, with EM's posteriors as soft labels."""
    x = np.array([_features(*k) for k in em["keys"]])
    weight = em["count"] / em["count"].sum()
    w, b = np.zeros(x.shape[1]), 0.0
    for _ in range(steps):
        err = weight * (1 / (1 + np.exp(-(x @ w + b))) - em["posterior"])
        w, b = w - rate * (x.T @ err + ridge * w), b - rate * err.sum()
    return w, b


def fit(docs: DataFrame) -> tuple[list[float], float]:
    """Count the vote patterns of all candidates, then train the classifier."""

    def count(batches):
        seen: dict[tuple, int] = {}
        for b in batches:
            for text in b.column("text").to_pylist():
                for c in candidates(text or ""):
                    key = (c[1], *votes(text, *c))
                    seen[key] = seen.get(key, 0) + 1
        keys = list(seen)
        yield pa.record_batch({"votes": pa.array(map(list, keys), pa.list_(pa.int32())), "n": pa.array([seen[k] for k in keys], pa.int64())})

    found = text_rows(docs).mapInArrow(count, "votes array<int>, n long").groupBy("votes").agg(F.sum("n").alias("n")).collect()
    patterns = {(r["votes"][0], tuple(r["votes"][1:])): r["n"] for r in found}  # at most 6 * 3**4 patterns
    if not patterns:
        return [0.0] * (len(KINDS) + 8), 0.0
    w, b = train_classifier(estimate(patterns))
    return w.tolist(), float(b)


def spans_of(text: str, model: tuple[list[float], float], threshold: float = 0.8) -> list[tuple[int, int, int, bool]]:
    """(start, kind, end, base) of the base spans and of those that the
    classifier adds, by start, then kind."""
    w, b = model
    out = []
    for c in candidates(text):
        if not c[3]:
            score = b + sum(x * y for x, y in zip(w, _features(c[1], votes(text, *c)), strict=True))
            if 1 / (1 + np.exp(-score)) < threshold:
                continue
        out.append(c)
    return out


_FOUND = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def find_personal_data(docs: DataFrame, model: tuple[list[float], float] | None = None, threshold: float = 0.8) -> DataFrame:
    """Base counts, a digest of the base spans, and all spans of each document."""
    model = model or fit(docs)

    def run(batches):
        write = lambda found: ",".join(f"{KINDS[k]}:{a}:{e}" for a, k, e, _ in found)
        for b in batches:
            rows = [spans_of(t or "", model, threshold) for t in b.column("text").to_pylist()]
            base = [[c for c in row if c[3]] for row in rows]
            counts = {f"n_{name}": pa.array([sum(c[1] == k for c in row) for row in base], pa.int64()) for k, name in enumerate(BASE)}
            digest = [hashlib.sha256(write(row).encode()).hexdigest() for row in base]
            yield pa.record_batch({"doc_id": b.column("doc_id"), **counts, "base_sha256": pa.array(digest, pa.string()), "spans": pa.array(list(map(write, rows)), pa.string())})

    return text_rows(docs).mapInArrow(run, _FOUND)


def redacted(text: str | None, model: tuple[list[float], float], threshold: float = 0.8) -> str | None:
    """The text with each span replaced by its kind; overlaps become one."""
    if not text:
        return text
    out, at = [], 0
    for a, k, e, _ in spans_of(text, model, threshold):
        if a >= at:
            out += [text[at:a], f"[{KINDS[k].upper()}]"]
        at = max(at, e)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, model: tuple[list[float], float] | None = None, threshold: float = 0.8) -> DataFrame:
    """All rows and columns, with personal data replaced in ``text``."""
    model = model or fit(docs)

    def run(batches):
        for b in batches:
            text = pa.array([redacted(t, model, threshold) for t in b.column("text").to_pylist()], b.schema.field("text").type)
            yield b.set_column(b.schema.get_field_index("text"), "text", text)

    return docs.mapInArrow(run, docs.schema)


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(load(spark, sf_dir, "documents"))
