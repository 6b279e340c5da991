"""Scores of texts under a hashed maximum-entropy language model.

Tokens are words (A-Z folded) and one end per text. The ``SLOTS * HEAD`` most frequent tokens are dealt to ``HEAD`` classes of
``SLOTS``; all others belong to one of ``TAIL`` classes by a hash of their last two bytes. The probability of a token is
that of its class times that within the class:

* class: softmax over the classes, with weights for the previous token, the token before it (skip), both as a
  bigram, and a bias; features are hashed to ``ROWS`` rows;
* within a head class: softmax over its slots, with weights for the previous token and the skip token, hashed with the class;
* within a tail class: (count + 1) / (tokens + types + 1) of the class, so an unseen word has the share of one type.

Training visits every token of the training documents. Each task makes minibatch gradient steps on its own copy;
the copies are averaged row by row, weighted by how often a task met the row, first in salted groups and then over
the salts. Counts are kept as a table. The ``KNOWN`` most frequent tokens (a fixed bound) are broadcast; the occurrences of
all other tokens meet their counts in a join, so the vocabulary may grow without bound.

Defined results: NULL and empty texts are the end token alone. Rows with a NULL id belong to the training fold. Repeated rows
each get a row and count each time. Without training documents every token has base probability 1 and the model is uniform.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, fold, map_arrow, stage
from .words import Lookup, Words, mix

FOLDS, HELD_OUT = 7, 2
HEAD, SLOTS, TAIL = 10, 32, 6
CLASSES = HEAD + TAIL
ROW_BITS = 13
ROWS = 1 << ROW_BITS
KNOWN = 1 << 18
BATCH, RATE = 16384, 0.5
SALTS, BLOCK = 64, 1024
END, BEGIN = np.uint64(0x0123456789ABCDEF), np.uint64(0x0FEDCBA987654321)


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the tokens of all texts, the tail class of each, and the bounds of each text (an end closes it)."""
    w = Words(texts)
    tail = mix(w.buf[np.maximum(w.end - 2, 0)].astype(np.uint64) << np.uint64(8) | w.buf[w.end - 1].astype(np.uint64) | (w.end - w.start < 2).astype(np.uint64) << np.uint64(16))
    bounds = w.first + np.arange(len(w.first))
    hashes, kind = np.full(bounds[-1], END), np.zeros(bounds[-1], np.int64)
    at = np.arange(len(w)) + w.doc
    hashes[at] = w.hash
    kind[at] = (tail % np.uint64(TAIL)).astype(np.int64)
    return hashes, kind, bounds


def token_counts(docs: DataFrame) -> DataFrame:
    """token, kind (tail class), count; summed in each task before the shuffle."""

    def run(batches):
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        rows = 0

        def merged():
            h, k, n = (np.concatenate(x) for x in zip(*held))
            unique, first, back = np.unique(h, return_index=True, return_inverse=True)
            return unique, k[first], np.bincount(back, n).astype(np.int64)

        def batch_of(h, k, n):
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(k.astype(np.int32)), pa.array(n)], ["token", "kind", "count"])

        for _, texts in chunks(batches):
            h, kind, _ = tokens(texts)
            unique, first, n = np.unique(h, return_index=True, return_counts=True)
            held.append((unique, kind[first], n))
            rows += len(unique)
            if rows > 1_000_000:
                held = [merged()]
                rows = len(held[0][0])
                if rows > 500_000:
                    yield batch_of(*held.pop())
                    rows = 0
        if held:
            yield batch_of(*merged())

    return map_arrow(docs.select("text"), run, "token long, kind int, count long").groupBy("token").agg(F.min("kind").alias("kind"), F.sum("count").alias("count"))


class Model:
    """Weights and token tables; ``rows``: class-level weights, ``inner``: slot-level weights."""

    def __init__(self, known: np.ndarray, counts: np.ndarray, kinds: dict[int, tuple[int, int]], n: int, v: int):
        self.n, self.v = n, v
        known = known.view(np.uint64)
        top = known[: HEAD * SLOTS]
        self.places = len(top)
        self.slot = Lookup(top, np.arange(len(top)))
        self.count = Lookup(known, counts)
        head = np.zeros(HEAD * SLOTS)
        head[: len(top)] = counts[: HEAD * SLOTS]
        tail = np.array([kinds.get(k, (0, 0)) for k in range(TAIL)], float).reshape(TAIL, 2)
        self.tail_size = tail.sum(1) + 1
        by_class = np.concatenate([head.reshape(HEAD, SLOTS).sum(1), tail[:, 0]])
        self.open = np.concatenate([head.reshape(HEAD, SLOTS).sum(1) > 0, np.ones(TAIL, bool)])
        self.bias = np.where(self.open, np.log(by_class + 1), -1e9).astype(np.float32)
        self.slot_bias = np.where(np.arange(HEAD * SLOTS) < len(top), np.log(head + 1), -1e9).reshape(HEAD, SLOTS).astype(np.float32)
        self.rows = np.zeros((ROWS, CLASSES), np.float32)
        self.inner = np.zeros((ROWS, SLOTS), np.float32)

    def features(self, hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
        before, skip = np.empty_like(hashes), np.empty_like(hashes)
        before[1:], skip[2:] = hashes[:-1], hashes[:-2]
        starts = bounds[:-1]
        before[starts] = BEGIN
        skip[starts] = BEGIN
        second = starts + 1
        skip[second[second < len(skip)]] = BEGIN
        row = lambda x: (mix(x) >> np.uint64(64 - ROW_BITS)).astype(np.int32)
        return before, skip, row(before + np.uint64(1)), row(skip + np.uint64(2)), row(before * np.uint64(3) + mix(skip))

    def classes(self, hashes: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        place = self.slot(hashes)
        return place, np.where(place >= 0, place // SLOTS, HEAD + kind)

    @staticmethod
    def inner_rows(before: np.ndarray, skip: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        salt = mix(which.astype(np.uint64) + np.uint64(77))
        return tuple((mix(x ^ salt) >> np.uint64(64 - ROW_BITS)).astype(np.int32) for x in (before, skip + np.uint64(9)))


def softmax(x: np.ndarray) -> np.ndarray:
    x -= x.max(1, keepdims=True)
    np.exp(x, out=x)
    x /= x.sum(1, keepdims=True)
    return x


def step(weights: np.ndarray, met: np.ndarray, rows: list[np.ndarray], gradient: np.ndarray) -> None:
    """A gradient step on the given rows. Its length falls with the root of how often a row was met."""
    for r in rows:
        order = np.argsort(r, kind="stable")
        sorted_rows = r[order]
        first = np.flatnonzero(np.concatenate([[True], sorted_rows[1:] != sorted_rows[:-1]]))
        where, n = sorted_rows[first], np.diff(np.append(first, len(r)))
        met[where] += n
        total = np.add.reduceat(gradient[order], first, axis=0)
        weights[where] -= total * (RATE / len(rows) / (np.sqrt(n * met[where].astype(np.float64)) + 1)).astype(np.float32)[:, None]


def learn(model: Model, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    """One pass over a task's texts: the new weights and how often each row was met."""
    rows, inner = model.rows.copy(), model.inner.copy()
    met, inner_met = np.zeros(ROWS, np.int64), np.zeros(ROWS, np.int64)
    for _, texts in chunks(batches):
        hashes, kind, bounds = tokens(texts)
        place, cls = model.classes(hashes, kind)
        before, skip, *f = model.features(hashes, bounds)
        for a in range(0, len(hashes), BATCH):
            part = slice(a, a + BATCH)
            mine = [x[part] for x in f]
            p = softmax(model.bias + rows[mine[0]] + rows[mine[1]] + rows[mine[2]])
            p[np.arange(len(p)), cls[part]] -= 1
            step(rows, met, mine, p)
            at = a + np.flatnonzero(place[part] >= 0)
            if at.size:
                g = [*model.inner_rows(before[at], skip[at], cls[at])]
                p = softmax(model.slot_bias[cls[at]] + inner[g[0]] + inner[g[1]])
                p[np.arange(len(p)), place[at] % SLOTS] -= 1
                step(inner, inner_met, g, p)
    yield "rows", rows, met
    yield "inner", inner, inner_met


def fit(docs: DataFrame, model: Model) -> None:
    """Averages the tasks' weights into ``model``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        task = TaskContext.get()
        salt = task.partitionId() % SALTS
        for name, weights, met in learn(shared.value, batches):
            for block in range(0, ROWS, BLOCK):
                part = slice(block, block + BLOCK)
                data = np.concatenate([weights[part] * met[part, None], met[part, None]], 1).astype(np.float64)
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([block], pa.int32()), pa.array([salt], pa.int32()), pa.array([data.tobytes()], pa.binary())], ["name", "block", "salt", "data"])

    def added(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(x, np.float64) for x in pdf["data"])
        return pd.DataFrame({"name": pdf["name"][:1], "block": pdf["block"][:1], "salt": pdf["salt"][:1], "data": [total.tobytes()]})

    schema = "name string, block int, salt int, data binary"
    parts = map_arrow(docs.select("text"), run, schema).groupBy("name", "block", "salt").applyInPandas(added, schema)
    for r in parts.groupBy("name", "block").applyInPandas(added, schema).collect():  # the size of the model
        target = model.rows if r.name == "rows" else model.inner
        data = np.frombuffer(r.data, np.float64).reshape(BLOCK, -1)
        met = data[:, -1:]
        target[r.block : r.block + BLOCK] = np.where(met > 0, data[:, :-1] / np.maximum(met, 1), 0)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """For each row the sums over all tokens but the counts of the rarer ones, which are listed in ``rare``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        base = np.log10(m.n + m.v + 1) if m.n else 0.0
        tail_log = np.log10(m.tail_size)
        for batch, texts in chunks(batches):
            hashes, kind, bounds = tokens(texts)
            place, cls = m.classes(hashes, kind)
            before, skip, *f = m.features(hashes, bounds)
            value = np.empty(len(hashes))
            for a in range(0, len(hashes), BATCH):
                part = slice(a, a + BATCH)
                x = m.bias + m.rows[f[0][part]] + m.rows[f[1][part]] + m.rows[f[2][part]]
                x -= x.max(1, keepdims=True)
                value[part] = x[np.arange(len(x)), cls[part]] - np.log(np.exp(x).sum(1))
                at = a + np.flatnonzero(place[part] >= 0)
                if at.size:
                    g = m.inner_rows(before[at], skip[at], cls[at])
                    x = m.slot_bias[cls[at]] + m.inner[g[0]] + m.inner[g[1]]
                    x -= x.max(1, keepdims=True)
                    value[at] += x[np.arange(len(x)), place[at] % SLOTS] - np.log(np.exp(x).sum(1))
            value /= np.log(10)
            count = m.count(hashes)
            tail = place < 0
            value[tail] -= tail_log[kind[tail]]
            have = count >= 0
            logs = np.where(have, np.log10(np.maximum(count, 0) + 1.0), 0.0)
            total = lambda x: np.add.reduceat(x, bounds[:-1])
            score, base_score = total(value + np.where(tail, logs, 0)), total(logs - base)
            known, size = total(have.astype(np.int64)), np.diff(bounds)
            missing = np.flatnonzero(~have)
            first = np.searchsorted(missing, bounds)
            flat = pa.array(hashes[missing].view(np.int64))
            rare = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), flat)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(size.astype(np.int64)), pa.array(known), pa.array(base_score), pa.array(score), rare], ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "rare"])

    return map_arrow(docs, run, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, rare array<long>")


def score_texts(docs: DataFrame, purpose: str = "lm") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(fold(FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"), F.col("text").cast("string").alias("text"))
    training = rows.where("not held_out")
    counts = stage(token_counts(training), f"{purpose}-counts")
    n, v = counts.agg(F.coalesce(F.sum("count"), F.lit(0)), F.count("*")).first()
    known = counts.orderBy(F.desc("count"), "token").limit(KNOWN).select("token", "count").toArrow()  # a fixed number of rows
    tokens_, counts_ = (np.array(known.column(c).to_numpy(), np.int64) for c in ("token", "count"))
    heads = tokens_[: HEAD * SLOTS].tolist()
    kinds = {r.kind: (r.n, r.v) for r in counts.where(~F.col("token").isin(heads)).groupBy("kind").agg(F.sum("count").alias("n"), F.count("*").alias("v")).collect()}
    model = Model(tokens_, counts_, kinds, n, v)
    fit(training, model)
    parts = stage(scored(rows, model).withColumn("row", F.monotonically_increasing_id()), f"{purpose}-parts")
    logs = F.log10(F.col("count") + 1.0)
    rest = parts.select("row", F.explode("rare").alias("token")).join(counts.select("token", "count"), "token").groupBy("row").agg(F.sum(logs).alias("more"), F.count("*").alias("found"))
    more = F.coalesce("more", F.lit(0.0))
    return parts.join(rest, "row", "left").select("doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("found", F.lit(0))).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"), (F.col("base_score") + more).alias("base_score"), (F.col("score") + more).alias("score"))
