"""Personal data by patterns and a skip-chain conditional random field.

Base: e-mail addresses, IP addresses, card numbers and phone numbers by their patterns (leftmost, non-overlapping in each
kind). The field then reads each document's mentions: digit groups of ``LEAST_DIGITS`` digits or more and addresses, also
written with "at" and "dot" in brackets. A mention's state is none or a kind. Its features are its shape and the words
around it; neighbouring mentions are tied, and so are mentions anywhere in the text that repeat one another or are
alike (equal digits, equal last eight digits, equal address or equal name before the @): the skip edges. Mentions that a base
span covers have that kind as evidence. Loopy message passing over the whole document gives the marginals, and a mention
without evidence becomes a span of its likeliest kind from ``SURE`` on. So a number once written with its + is found again
without it.

Weights are fitted to the pseudo-likelihood on at most ``SAMPLE_DOCS`` documents that have mentions, the first by a hash of
the id, with the base kinds as states; uncovered mentions that are alike a covered one count as unknown. Repeats of one key are tied in a row, so edges grow with the mentions.

n_email to n_phone count the base spans; n_added counts what the field adds. Defined results: NULL and empty texts have no
spans. Repeated rows each get a row.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, map_arrow

KINDS = ("email", "ip", "card", "phone")
SURE = 0.9
SAMPLE_DOCS, SAMPLE_MENTIONS = 1500, 64
LEAST_DIGITS = 7
ROUNDS, DAMPING = 12, 0.3
STEPS, RATE, PENALTY = 300, 0.1, 1e-3

LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match of these can only begin where a run of digits does, so the look-behind changes nothing but the time.
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
MENTION = re.compile(r"[+(]?(?<![0-9])[0-9](?:[().\x20-]{0,3}[0-9])+|[A-Za-z0-9._%+-]{1,64}(?:@|\x20?[(\[]at[)\]]\x20?)[A-Za-z0-9-]{1,64}(?:(?:\.|\x20?[(\[]dot[)\]]\x20?)[A-Za-z0-9-]{1,64}){1,8}")
ANY = re.compile(rb"[0-9@]|[(\[]at[)\]]")
WORD = re.compile(r"\w+")
WORD_BUCKETS = 32


def emails(text: str) -> list[tuple[int, int]]:
    out, last = [], 0
    at = text.find("@")
    while at >= 0:
        if m := DOMAIN.match(text, at):
            start = at
            while start > last and text[start - 1] in LOCAL:
                start -= 1
            if start < at:
                last = m.end()
                out.append((start, last))
        at = text.find("@", max(at + 1, last))
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind, then start."""
    out = [(0, a, b) for a, b in emails(text)]
    for m in IP.finditer(text):
        if all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in m[0].split(".")):
            out.append((1, *m.span()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    for m in PHONE.finditer(text):
        if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append((3, *m.span()))
    return out


class Mentions:
    """Mentions of one text: spans, features, evidence (-1: none) and edges."""

    def __init__(self, text: str, base: list[tuple[int, int, int]]):
        self.spans: list[tuple[int, int]] = []
        rows, keys = [], []
        for m in MENTION.finditer(text):
            s = m[0]
            digits = "".join(c for c in s if c.isdigit())
            address = "@" in s or "at)" in s or "at]" in s
            if not address and len(digits) < LEAST_DIGITS:
                continue
            self.spans.append(m.span())
            rows.append(self.shape(text, m.start(), m.end(), s, digits, address))
            if address:
                plain = re.sub(r"\x20?[(\[]dot[)\]]\x20?", ".", re.sub(r"\x20?[(\[]at[)\]]\x20?", "@", s)).lower()
                keys.append([("a", plain), ("n", plain.split("@")[0])])
            else:
                keys.append([("d", digits), *([("l", digits[-8:])] if len(digits) >= 8 else [])])
        n = len(rows)
        self.features = np.array(rows, np.float64).reshape(n, SHAPES + 2 * WORD_BUCKETS)
        self.evidence = np.full(n, -1)
        ordered = sorted(base, key=lambda b: b[1])
        k = 0
        for i, (a, b) in enumerate(self.spans):
            while k < len(ordered) and ordered[k][2] <= a and ordered[k][1] < a:
                k += 1
            for kind, x, y in ordered[k : k + 8]:
                if x < b and a < y:
                    self.evidence[i] = kind + 1
                    break
        chain = [(i, i + 1) for i in range(n - 1) if self.spans[i + 1][0] - self.spans[i][1] <= 40]
        last: dict[tuple[str, str], int] = {}
        skip = set()
        for i, mine in enumerate(keys):
            for key in mine:
                if key in last:
                    skip.add((last[key], i))
                last[key] = i
        self.chain, self.skip = np.array(chain, int).reshape(-1, 2), np.array(sorted(skip), int).reshape(-1, 2)

    def training_states(self) -> np.ndarray:
        """The base kinds, none where no span is; -1 (unknown) for an uncovered mention that is alike a covered one."""
        states = np.maximum(self.evidence, 0)
        for a, b in self.skip:
            for i, j in ((a, b), (b, a)):
                if self.evidence[i] < 0 <= self.evidence[j]:
                    states[i] = -1
        return states

    @staticmethod
    def shape(text: str, a: int, b: int, s: str, digits: str, address: bool) -> list[float]:
        n = len(digits)
        row = [1, address, "@" in s, s.startswith("+"), "(" in s, s.count(".") == 3 and not address, "." in s, "-" in s, " " in s, n < 8, 8 <= n <= 9, 10 <= n <= 11, 12 <= n <= 15, 16 <= n <= 19, n > 19, not address and 16 <= n <= 19 and luhn(digits)]
        around = [0.0] * (2 * WORD_BUCKETS)
        before, after = WORD.findall(text[max(0, a - 24) : a]), WORD.findall(text[b : b + 24])
        if before:
            around[sum(before[-1].lower().encode()) % WORD_BUCKETS] = 1
        if after:
            around[WORD_BUCKETS + sum(after[0].lower().encode()) % WORD_BUCKETS] = 1
        return [float(x) for x in row] + around


SHAPES = 16
STATES = len(KINDS) + 1


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


def marginals(node: np.ndarray, edges: np.ndarray, potential: np.ndarray) -> np.ndarray:
    """Loopy sum-product with damping in log space: node (n, S), edges (e, 2), potential (e, S, S) from first to second end."""
    e = len(edges)
    if not e:
        return np.exp(node - log_sum(node, 1)[:, None])
    source, target = np.concatenate([edges[:, 0], edges[:, 1]]), np.concatenate([edges[:, 1], edges[:, 0]])
    both = np.concatenate([potential, potential.transpose(0, 2, 1)])
    reverse = np.concatenate([np.arange(e, 2 * e), np.arange(e)])
    messages = np.zeros((2 * e, node.shape[1]))
    for _ in range(ROUNDS):
        belief = node.copy()
        np.add.at(belief, target, messages)
        new = log_sum((belief[source] - messages[reverse])[:, :, None] + both, 1)
        new -= log_sum(new, 1)[:, None]
        messages = DAMPING * messages + (1 - DAMPING) * new
    belief = node.copy()
    np.add.at(belief, target, messages)
    return np.exp(belief - log_sum(belief, 1)[:, None])


def train(found: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]) -> dict:
    """Pseudo-likelihood of (features, states, chain, skip) of documents: each known state given its features and its neighbours' states."""
    width = SHAPES + 2 * WORD_BUCKETS
    if not found:
        return {"node": np.zeros((width, STATES)), "chain": np.zeros((STATES, STATES)), "skip": 2 * np.eye(STATES)}
    x, y = np.concatenate([f for f, *_ in found]), np.concatenate([s for _, s, *_ in found])
    offset = np.cumsum([0, *(len(s) for _, s, *_ in found)])[:-1]
    near = [np.zeros((len(y), STATES)) for _ in range(2)]
    for total, which in zip(near, (2, 3)):
        for o, doc in zip(offset, found):
            for a, b in ((0, 1), (1, 0)):
                other = y[o + doc[which][:, b]]
                np.add.at(total, (o + doc[which][other >= 0, a], other[other >= 0]), 1)
    design = np.concatenate([x, *near], 1)[y >= 0]
    y = y[y >= 0]
    if not len(y):
        return train([])
    weights = np.zeros((design.shape[1], STATES))
    target = np.eye(STATES)[y]
    m, v = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, STEPS + 1):
        z = design @ weights
        p = np.exp(z - log_sum(z, 1)[:, None])
        g = design.T @ (p - target) / len(y) + PENALTY * weights
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g**2
        weights -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    tied = lambda w: (w + w.T) / 2
    # States of alike mentions only attract one another.
    skip = tied(weights[width + STATES :])
    return {"node": weights[:width], "chain": tied(weights[width : width + STATES]), "skip": np.maximum(np.diag(np.diag(skip) - skip.mean()), 0) + 3 * np.eye(STATES)}


def added_spans(text: str, base: list[tuple[int, int, int]], model: dict) -> list[tuple[int, int, int]]:
    """Spans of mentions without evidence that the field is sure of."""
    mentions = Mentions(text, base)
    hidden = np.flatnonzero(mentions.evidence < 0)
    if not hidden.size:
        return []
    node = mentions.features @ model["node"]
    for i in np.flatnonzero(mentions.evidence >= 0):
        node[i] = -50
        node[i, mentions.evidence[i]] = 0
    edges = np.concatenate([mentions.chain, mentions.skip])
    potential = np.concatenate([np.broadcast_to(model["chain"], (len(mentions.chain), STATES, STATES)), np.broadcast_to(model["skip"], (len(mentions.skip), STATES, STATES))])
    p = marginals(node, edges, potential)
    out = []
    for i in hidden.tolist():
        kind = int(p[i].argmax())
        if kind and p[i, kind] >= SURE:
            a, b = mentions.spans[i]
            out.append((kind - 1, a, b))
    return out


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> dict:
    """At most ``sample_docs`` documents reach the driver, as features of at most SAMPLE_MENTIONS mentions each."""
    ids = docs.where(F.col("text").rlike("[0-9@]")).select(F.col("doc_id").cast("long").alias("doc_id")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs).distinct()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(ids), "doc_id").limit(sample_docs)

    def run(batches):
        for batch, texts in chunks(batches):
            at, data = [], []
            for i, t in enumerate(texts):
                text = t.decode("utf-8")
                mentions = Mentions(text, base_spans(text))
                if 0 < len(mentions.spans) <= SAMPLE_MENTIONS:
                    at.append(i)
                    data.append([mentions.features.astype(np.float32).tobytes(), mentions.training_states().astype(np.int64).tobytes(), mentions.chain.astype(np.int64).tobytes(), mentions.skip.astype(np.int64).tobytes()])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(at, pa.int64())), pa.array(data, pa.list_(pa.binary()))], ["doc_id", "data"])

    got = sorted(map_arrow(rows, run, "doc_id long, data array<binary>").collect(), key=lambda r: (r.doc_id if r.doc_id is not None else -1, [bytes(x) for x in r.data]))
    unpack = lambda d: (np.frombuffer(d[0], np.float32).reshape(-1, SHAPES + 2 * WORD_BUCKETS).astype(float), np.frombuffer(d[1], np.int64), np.frombuffer(d[2], np.int64).reshape(-1, 2), np.frombuffer(d[3], np.int64).reshape(-1, 2))
    return train([unpack(r.data) for r in got])


def find(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added of every row."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches):
        joined = lambda spans: ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)
        for batch, texts in chunks(batches):
            out = []
            for t in texts:
                base: list[tuple[int, int, int]] = []
                more: list[tuple[int, int, int]] = []
                if ANY.search(t):
                    text = t.decode("utf-8")
                    base = base_spans(text)
                    more = added_spans(text, base, model.value)
                counts = [sum(k == kind for k, *_ in base) for kind in range(len(KINDS))]
                out.append((*counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(sorted({*base, *more})), len({*more} - {*base})))
            columns = [*zip(*out)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns[:4]), pa.array(columns[4], pa.string()), pa.array(columns[5], pa.string()), pa.array(columns[6], pa.int64())], ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"])

    return map_arrow(rows, run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")
