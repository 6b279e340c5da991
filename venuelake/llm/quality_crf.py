"""Document quality by a linear-chain conditional random field over lines.

Every line that has a word is a node with two states, good and bad. Its features are its own surface statistics and
those of the lines before and after it; neighbouring states are tied by transition weights. The labels of documents
serve as labels of all their lines. A document's score is the mean of the forward-backward marginals of its lines,
weighted by line length in code points.

The field is fitted on at most ``SAMPLE_DOCS`` labelled documents of at most ``SAMPLE_LINES`` lines, the first in order of
a hash of the id; scoring covers every line of every text.

Defined results: NULL and empty texts and texts without a word get the share of good labels among such training
documents, drawn towards the overall share by ``PRIOR_DOCS`` rows. Rows map one to one, repeated rows too. Without any
label of both kinds the score is the share of good labels (1 without labels). Labels given twice count once, as the lowest.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, fold, map_arrow
from .words import Words, code_points, mix, prefix_sums, range_hash, sums

SAMPLE_DOCS = 3000
SAMPLE_LINES = 64
PRIOR_DOCS = 10
THRESHOLD = 0.3
FOLDS, HELD_OUT = 5, 0
STEPS, RATE, PENALTY = 120, 0.08, 1e-3

_CLASS = np.zeros(256, np.int64)
_CLASS[[9, 10, 11, 12, 13, 32]] = 1
_CLASS[65:91] = 2
_CLASS[48:58] = 3
_CLASS[[*b"#$%&*|<>@^~_\\{}[]="]] = 4
_CLASS[[*b"!?"]] = 5
_CLASS[[*b".,;:'\"()-/"]] = 6
_CLASS[[*b"|"]] = 7
OWN = 17
FEATURES = 1 + 3 * OWN + 2
_RAW = mix(np.arange(7, 263, dtype=np.uint64))


def featurize(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A row of features for each line with a word, its length in code points, and first[d]:first[d+1], the lines of text d."""
    w = Words(texts)
    buf = w.buf
    breaks = np.flatnonzero(buf == 10)
    start, end = breaks[:-1] + 1, breaks[1:]
    bounds = np.searchsorted(w.start, np.append(start, len(buf)))
    words = np.diff(bounds)
    keep = np.flatnonzero(words > 0)
    start, end = start[keep], end[keep]
    doc = np.searchsorted(w.doc_start, start, "right") - 1
    line_first = np.searchsorted(doc, np.arange(w.n_docs + 1))
    n = len(keep)
    if not n:
        return np.zeros((0, FEATURES), np.float32), np.zeros(0), line_first
    words = words[keep]
    of_word = np.repeat(np.arange(n), words)  # lines without a word have none, so the words of the kept lines are all words
    word_bounds = np.concatenate([[0], np.cumsum(words)])
    points = code_points(buf)
    length = (points[end] - points[start]).astype(np.float64)
    size = (end - start).astype(np.float64)
    kinds = _CLASS[buf]
    share = []
    for kind in range(2, 8):
        total = np.concatenate([[0], np.cumsum(kinds == kind, dtype=np.int64)])
        share.append((total[end] - total[start]) / size)
    word_size = (w.end - w.start).astype(np.float64)
    same = np.zeros(len(w))
    same[1:] = (w.hash[1:] == w.hash[:-1]) & (of_word[1:] == of_word[:-1])
    new = _first_in_group(w.hash ^ mix(of_word.astype(np.uint64)))
    grams, at = w.grams(3)
    again = np.zeros(len(w))
    again[at] = ~_first_in_group(grams ^ mix(w.doc[at].astype(np.uint64)))
    lines = range_hash(w.prefix, start, end)
    seen = ~_first_in_group(lines ^ mix(doc.astype(np.uint64)))
    ends = kinds[np.maximum(w.end[word_bounds[1:] - 1] - 1, 0)]
    odd = (kinds[w.end - 1] == 4) | (kinds[w.end - 1] == 5)
    own = np.stack([
        np.log1p(length) / 5, np.log1p(words) / 4, np.minimum(sums(word_size, word_bounds) / words / 10, 3),
        *(np.sqrt(s) for s in share),
        np.sqrt(sums(same, word_bounds) / words), sums(new.astype(np.float64), word_bounds) / words, np.sqrt(sums(again, word_bounds) / words), seen.astype(np.float64),
        (ends == 6).astype(np.float64), np.sqrt(sums(odd.astype(np.float64), word_bounds) / words), sums((word_size <= 3).astype(np.float64), word_bounds) / words,
        (words <= 2).astype(np.float64),
    ], 1)
    before, after = np.zeros_like(own), np.zeros_like(own)
    inner = doc[1:] == doc[:-1]
    before[1:][inner] = own[:-1][inner]
    after[:-1][inner] = own[1:][inner]
    at_first, at_last = np.ones(n), np.ones(n)
    at_first[1:][inner] = 0
    at_last[:-1][inner] = 0
    out = np.concatenate([np.ones((n, 1)), own, before, after, at_first[:, None], at_last[:, None]], 1)
    return out.astype(np.float32), length, line_first


def _first_in_group(keys: np.ndarray) -> np.ndarray:
    out = np.zeros(len(keys), bool)
    out[np.unique(keys, return_index=True)[1]] = True
    return out


def marginals(emission: np.ndarray, first: np.ndarray, transition: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(good) of each line, and the expected transitions (2 x 2) of each sequence.

    emission: log-odds of good. Sequences run side by side, longest first, with messages normalised at each step.
    """
    lengths = np.diff(first)
    order = np.argsort(-lengths, kind="stable")
    begin, lengths = first[:-1][order], lengths[order]
    odds = np.exp(np.clip(emission, -30, 30))
    weights = np.exp(np.clip(transition, -30, 30))
    n = len(emission)
    forward, backward = np.zeros((n, 2)), np.ones((n, 2))
    longest = int(lengths[0]) if len(lengths) else 0
    active = np.searchsorted(-lengths, -np.arange(longest), "left")  # sequences longer than t
    a = None
    for t in range(longest):
        k = active[t]
        at = begin[:k] + t
        good = odds[at]
        message = np.ones((k, 2)) if t == 0 else a[:k] @ weights
        a = np.stack([message[:, 0], message[:, 1] * good], 1)
        a /= a.sum(1, keepdims=True)
        forward[at] = a
    for t in range(longest - 2, -1, -1):
        k = active[t + 1]
        at = begin[:k] + t
        after = backward[at + 1] * np.stack([np.ones(k), odds[at + 1]], 1)
        b = after @ weights.T
        backward[at] = b / b.sum(1, keepdims=True)
    joint = forward * backward
    p = joint[:, 1] / joint.sum(1)
    expected = np.zeros((len(first) - 1, 2, 2))
    inner = np.ones(max(n - 1, 0), bool)
    inner[first[1:-1][(first[1:-1] > 0) & (first[1:-1] < n)] - 1] = False
    at = np.flatnonzero(inner)
    if at.size:
        after = backward[at + 1] * np.stack([np.ones(len(at)), odds[at + 1]], 1)
        pair = forward[at][:, :, None] * weights[None] * after[:, None, :]
        pair /= pair.sum((1, 2), keepdims=True)
        np.add.at(expected, np.searchsorted(first, at, "right") - 1, pair)
    return p, expected


def train(features: np.ndarray, first: np.ndarray, good: np.ndarray) -> dict:
    """Maximum likelihood with a quadratic penalty, by full-batch gradient steps with moments (Adam). Sequences count alike."""
    lengths = np.diff(first)
    mean, spread = features.mean(0), features.std(0) + 1e-6
    mean[0], spread[0] = 0, 1
    x = np.clip((features - mean) / spread, -6, 6)
    of = np.repeat(np.arange(len(lengths)), lengths)
    y = good[of].astype(np.float64)
    per = 1 / np.sqrt(lengths)
    per /= (per * lengths).sum()
    weight = per[of]
    truth = np.zeros((len(lengths), 2, 2))
    truth[np.arange(len(lengths)), good.astype(int), good.astype(int)] = lengths - 1
    theta = np.zeros(x.shape[1] + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        w, transition = theta[:-4], theta[-4:].reshape(2, 2)
        p, expected = marginals(x @ w, first, transition)
        gradient = np.concatenate([x.T @ (weight * (p - y)), ((expected - truth) * per[:, None, None]).sum(0).ravel()]) + PENALTY * theta
        m = 0.9 * m + 0.1 * gradient
        v = 0.999 * v + 0.001 * gradient**2
        theta -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return {"mean": mean, "spread": spread, "weights": theta[:-4].astype(np.float32), "transition": theta[-4:].reshape(2, 2)}


def score(model: dict, texts: list[bytes]) -> np.ndarray:
    features, length, first = featurize(texts)
    out = np.full(len(texts), model["blank"])
    if len(features):
        x = np.clip((features - model["mean"]) / model["spread"], -6, 6).astype(np.float32)
        p, _ = marginals((x @ model["weights"]).astype(np.float64), first, model["transition"])
        total = sums(length, first)
        has = total > 0
        out[has] = sums(length * p, first)[has] / total[has]
    return np.clip(out, 0, 1)


def fit(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_lines: int = SAMPLE_LINES) -> dict:
    """The model as arrays. At most ``sample_docs`` texts reach the driver, as features of at most ``sample_lines`` lines each."""
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .where(F.col("quality").isin(0, 1) & (fold(FOLDS) != HELD_OUT))
        .groupBy("doc_id").agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs)
    )
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id").limit(2 * sample_docs)

    def run(batches):
        for batch, texts in chunks(batches):
            features, _, first = featurize(texts)
            n = np.diff(first)
            data = [features[a:b].tobytes() if b - a <= sample_lines else None for a, b in zip(first[:-1], first[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("quality"), pa.array(n, pa.int64()), pa.array(data, pa.binary())], ["doc_id", "quality", "lines", "data"])

    got = sorted(map_arrow(rows, run, "doc_id long, quality int, lines long, data binary").collect(), key=lambda r: (r.doc_id, r.lines, bytes(r.data or b"")))
    good = np.array([r.quality for r in got], float)
    share = float(good.mean()) if len(good) else 1.0
    blank = [r.quality for r in got if not r.lines]
    model = {"blank": (sum(blank) + PRIOR_DOCS * share) / (len(blank) + PRIOR_DOCS), "mean": np.zeros(FEATURES, np.float32), "spread": np.ones(FEATURES, np.float32), "weights": np.zeros(FEATURES, np.float32), "transition": np.zeros((2, 2))}
    used = [r for r in got if r.data]
    if len({r.quality for r in used}) < 2:
        model["weights"][0] = np.log(max(share, 1e-6) / max(1 - share, 1e-6))
        return model
    features = np.concatenate([np.frombuffer(r.data, np.float32).reshape(-1, FEATURES) for r in used])
    first = np.concatenate([[0], np.cumsum([r.lines for r in used])])
    return model | train(features, first, np.array([r.quality for r in used]))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, held_out, score, predicted of every row, with the further columns named in ``keep``."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(fold(FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"), F.col("text").cast("string").alias("text"), *(F.col(c).alias(f"kept_{i}") for i, c in enumerate(keep)))

    def run(batches):
        for batch, texts in chunks(batches):
            s = score(model.value, texts)
            columns = [batch.column("doc_id"), batch.column("held_out"), pa.array(s, pa.float64()), pa.array((s >= threshold).astype(np.int32), pa.int32())]
            yield pa.RecordBatch.from_arrays(columns + [batch.column(f"kept_{i}") for i in range(len(keep))], ["doc_id", "held_out", "score", "predicted", *(f"kept_{i}" for i in range(len(keep)))])

    kinds = dict(docs.dtypes)
    schema = "doc_id long, held_out boolean, score double, predicted int" + "".join(f", kept_{i} {kinds[c]}" for i, c in enumerate(keep))
    out = map_arrow(rows, run, schema)
    return out.select("doc_id", "held_out", "score", "predicted", *(F.col(f"kept_{i}").alias(c) for i, c in enumerate(keep)))
