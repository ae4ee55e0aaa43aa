"""Personal data by weak supervision (operator 3).

Base spans of four kinds come from fixed patterns. Besides, every text yields candidates of two
more kinds (long digit groups, and tokens like keys); labelers (formats, gazetteers, context)
vote on each base span and candidate. Expectation-maximisation over the counts of vote patterns
in the whole corpus estimates each labeler's reliability without labels; its posteriors train a
logistic span classifier, which decides the candidates that are added. Base spans always stay.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowguard.llm.common import small_batches, texts_of, with_columns

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret", "number")

LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
TOKEN = re.compile(r"[A-Za-z0-9_/+-]{16,}={0,2}")
NUMBER = re.compile(r"[0-9](?:[\x20./-]?[0-9]){6,}")

# Gazetteers: words that name a kind of datum, and common top-level domains.
CUES = {
    "email": {"mail", "email", "contact"},
    "ip": {"ip", "host", "server", "address"},
    "card": {"card", "visa", "mastercard", "credit"},
    "phone": {"phone", "tel", "call", "mobile", "fax"},
    "secret": {"token", "key", "secret", "password", "passwd", "apikey", "api", "auth", "bearer"},
    "number": {"account", "iban", "ssn", "passport", "id", "no", "number", "phone", "tel", "card"},
}
DOMAINS = {"com", "org", "net", "edu", "gov", "io", "de", "fr", "es", "uk", "eu", "info"}
FORMATS = [re.compile(p) for p in (
    r"[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64}", r"[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}", r"[A-Z0-9]{20}", r"[A-Za-z]{2,3}[_-][A-Za-z0-9]{20,}")]
NUMBER_FORMATS = re.compile(r"[0-9]{3}-[0-9]{2}-[0-9]{4}|[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}|[0-9]{4}([ -][0-9]{4}){3}")
WORD = re.compile(r"[a-z]+")
#: Weight of all spans together in the estimates: votes count by their shares, alike in a small and a large corpus.
MASS = 100_000
LABELERS = ("format", "cue", "assigned", "gazetteer", "varied", "delimited", "length")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else (d * 2 - 9 if d > 4 else d * 2)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``, found from each @."""
    end = 0
    p = text.find("@")
    while p >= 0:
        start = p
        while start > end and LOCAL.match(text[start - 1]):
            start -= 1
        if start < p and (m := DOMAIN.match(text, p + 1)):
            end = m.end()
            yield start, end
        p = text.find("@", max(p + 1, end))


def addresses(text: str) -> Iterator[tuple[int, int]]:
    """Matches of four dotted numbers of at most 255, found in maximal dotted runs."""
    for m in DOTTED.finditer(text):
        parts = m[0].split(".")
        at = m.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            size = sum(map(len, four)) + 3
            if all(len(x.lstrip("0")) <= 3 and int(x[-4:]) <= 255 for x in four):
                yield at, at + size
            at += size + 1


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's number, end) of the base spans, sorted."""
    out = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    if DIGIT.search(text):
        if "." in text:
            out += [(a, 1, b) for a, b in addresses(text)]
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 10 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                    out.append((m.start(), 3, m.end()))
    out.sort()
    return out


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans of the added kinds that no base span and no earlier candidate overlaps."""
    if not DIGIT.search(text):
        return []
    found = []
    for m in TOKEN.finditer(text):
        s = m[0]
        if DIGIT.search(s) and any(c.isalpha() for c in s):
            found.append((m.start(), 4, m.end()))
    found += [(m.start(), 5, m.end()) for m in NUMBER.finditer(text)]
    if not found:
        return []
    out, taken = [], sorted((a, b) for a, _, b in base)
    found.sort()
    k, end = 0, -1
    reach = 0  # furthest end of the base spans that start before the candidate ends
    for a, kind, b in found:
        while k < len(taken) and taken[k][0] < b:
            reach = max(reach, taken[k][1])
            k += 1
        if a >= max(end, reach):
            out.append((a, kind, b))
            end = b
    return out


def votes(text: str, start: int, kind: int, end: int) -> tuple[int, ...]:
    """What each labeler says of a span: 1 personal, -1 not, 0 abstains."""
    s = text[start:end]
    before = text[max(0, start - 24) : start]
    words = WORD.findall(before.lower())
    plain = [c for c in s if c.isalnum()]
    shape = kind < 4 or (any(p.fullmatch(s) for p in FORMATS) if kind == 4 else bool(NUMBER_FORMATS.fullmatch(s)))
    cue = any(w in CUES[KINDS[kind]] for w in words[-3:])
    assigned = before.rstrip("\"' ").endswith(("=", ":"))
    known = (s.rsplit(".", 1)[-1].lower() in DOMAINS) if kind == 0 else None
    kinds = len(set(plain))
    around = text[start - 1 : start] + text[end : end + 1]
    return (
        1 if shape else -1,
        1 if cue else 0,
        1 if assigned else 0,
        0 if known is None else 1 if known else -1,
        1 if kinds >= min(6, len(plain) * 0.4) else -1,
        -1 if any(c.isalnum() for c in around) else 0,
        -1 if kind == 5 and len(plain) > 19 or kind == 4 and len(plain) > 128 else 0,
    )


def features(kind: int, vote: tuple[int, ...]) -> np.ndarray:
    """Of the span classifier: the kind, and each vote for and against by kind of span (base or added)."""
    out = np.zeros(len(KINDS) + 4 * len(LABELERS))
    out[kind] = 1
    for k, v in enumerate(vote):
        if v:
            out[len(KINDS) + 4 * k + 2 * (kind >= 4) + (v < 0)] = 1
    return out


@dataclass
class SpanModel:
    """Posterior labels by pattern, the labelers' reliabilities and the classifier's weights."""

    reliability: dict[str, tuple[float, float]]  # P(vote for | personal), P(vote for | not)
    weights: np.ndarray

    def probability(self, kind: int, vote: tuple[int, ...]) -> float:
        return float(1 / (1 + np.exp(-features(kind, vote) @ self.weights)))


def estimate(patterns: list[tuple[int, tuple[int, ...], int]], rounds: int = 100) -> SpanModel:
    """EM over (kind, votes, count), then the classifier trained on its posteriors.

    Given the true label the votes are taken as independent. Reliabilities start from the view
    that votes for are mostly right; Dirichlet pseudo-counts keep them off 0 and 1. No patterns
    give a model that adds nothing.
    """
    if not patterns:
        weights = np.zeros(len(KINDS) + 4 * len(LABELERS))
        weights[: len(KINDS)] = -10.0
        return SpanModel({}, weights)
    kind = np.array([p[0] for p in patterns])
    vote = np.array([p[1] for p in patterns]) + 1  # 0 against, 1 abstains, 2 for
    n = np.array([p[2] for p in patterns], float)
    n = n / n.sum() * MASS
    start = (vote == 2).sum(1) - 1.5 * (vote == 0).sum(1) + 2.0 * (kind < 4)
    p = np.clip(1 / (1 + np.exp(-(start - 1.0))), 0.02, 0.98)
    said = np.zeros((2, len(LABELERS), 3))
    for _ in range(rounds):
        logs = []
        for side, w in enumerate((n * (1 - p), n * p)):
            for k in range(len(LABELERS)):
                said[side, k] = np.bincount(vote[:, k], w, 3) + 1.0
            said[side] /= said[side].sum(1, keepdims=True)
            logs.append(np.log((w.sum() + 1) / (n.sum() + 2)) + np.log(said[side][np.arange(len(LABELERS)), vote]).sum(1))
        new = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -50, 50)))
        new = np.where(kind < 4, np.maximum(new, 0.95), new)  # base spans are personal by definition
        if np.abs(new - p).max() < 1e-9:
            break
        p = new
    x = np.array([features(k, tuple(v - 1)) for k, v in zip(kind, vote)])
    w = np.zeros(x.shape[1])
    mass = np.sqrt(n)  # frequent patterns count more, but don't drown the rest
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hess = (x * (mass * q * (1 - q) + 1e-9)[:, None]).T @ x + 0.1 * np.eye(len(w))
        step = np.linalg.solve(hess, x.T @ (mass * (p - q)) - 0.1 * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return SpanModel({name: (float(said[1, k, 2]), float(said[0, k, 2])) for k, name in enumerate(LABELERS)}, w)


def learn(docs: DataFrame, text: str = "text") -> SpanModel:
    """The span model of all texts of ``docs``. Only counts of vote patterns (6 kinds, 3 votes of 7 labelers at most) are gathered."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple, int] = {}
        for batch in small_batches(batches, 0):
            for t in texts_of(batch.column(0)):
                base = base_spans(t)
                for a, kind, b in base + candidates(t, base):
                    key = (kind, *votes(t, a, kind, b))
                    seen[key] = seen.get(key, 0) + 1
        cols = list(zip(*[(k[0], ",".join(map(str, k[1:])), n) for k, n in seen.items()])) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.int64())], names=["kind", "votes", "n"])

    found = docs.select(F.col(text).alias("text")).mapInArrow(count, "kind int, votes string, n long").groupBy("kind", "votes").agg(F.sum("n").alias("n")).collect()
    return estimate(sorted((r["kind"], tuple(map(int, r["votes"].split(","))), r["n"]) for r in found))


def all_spans(text: str, model: SpanModel, cache: dict) -> tuple[list, list]:
    """(base spans, all spans), each (start, kind's number, end) by start, then kind."""
    base = base_spans(text)
    added = []
    for a, kind, b in candidates(text, base):
        key = (kind, votes(text, a, kind, b))
        if key not in cache:
            cache[key] = model.probability(*key) >= 0.5
        if cache[key]:
            added.append((a, kind, b))
    return base, sorted(base + added)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each span, or run of overlapping spans, replaced by the first one's kind in angle brackets."""
    out, at, end = [], 0, -1
    for a, kind, b in spans:
        if a >= end:
            out += [text[at:a] if at <= a else "", f"<{KINDS[kind].upper()}>"]
        end = max(end, b)
        at = end
    return "".join([*out, text[at:]])


def find(docs: DataFrame, model: SpanModel, text: str = "text", mask: str | None = None, prefix: str = "") -> DataFrame:
    """``docs`` with n_email, n_ip, n_card, n_phone, base_sha256 and spans.

    A null text counts as empty. ``mask`` adds a column of that name (it may be the text's own)
    with the text whose spans are masked; a null text stays null there. ``prefix`` goes before the
    other new names. Input columns of the new names are replaced.
    """
    new = {f"{prefix}n_{k}": "long" for k in BASE_KINDS} | {f"{prefix}base_sha256": "string", f"{prefix}spans": "string"} | ({mask: "string"} if mask else {})
    keep = [c for c in docs.columns if c not in new]
    frame = docs.select(*keep, F.col(text).alias("__text"))
    schema = with_columns(frame, keep, new)
    frame_width = len(frame.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict = {}
        for batch in small_batches(batches, frame_width - 1):
            cols: list[list] = [[] for _ in new]
            for t in batch.column(frame_width - 1).to_pylist():
                base, spans = all_spans(t or "", model, cache)
                for k in range(4):
                    cols[k].append(sum(s[1] == k for s in base))
                cols[4].append(hashlib.sha256(joined(base).encode()).hexdigest())
                cols[5].append(joined(spans))
                if mask:
                    cols[6].append(t if t is None else masked(t, spans))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *[pa.array(c, pa.int64() if k < 4 else pa.string()) for k, c in enumerate(cols)]],
                                             names=[*batch.schema.names[:-1], *new])

    return frame.mapInArrow(run, schema)
