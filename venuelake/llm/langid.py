"""Language by hierarchical discrimination: the family first, then the language within it.

A text's features are the square roots of its counts of hashed letter trigrams (bytes, folded, inside words with their
edges), scaled to length 1. One-versus-one linear support vector machines vote between the families, and within
the winning family between its languages. The machines are fitted on at most ``SAMPLE_DOCS`` labelled texts, spread
evenly over the languages, chosen by a hash of the id; whole texts are used for fitting and prediction.

Defined results: ``und`` with score 0 if the text is NULL or has no letter, or if nothing could be learned. A family with one
language has no inner vote. Repeated rows each get a row. Ties go to the first name in order.
"""

from __future__ import annotations

import re
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import chunks, fold, map_arrow
from .words import Words, mix

SAMPLE_DOCS = 3000
BITS = 12
FOLDS, HELD_OUT = 4, 2
STEPS, PENALTY = 120, 1e-4
LETTER = re.compile(r"[^\W\d_]")
# Language families by ISO 639-1 code. A code outside the table is a family of its own.
FAMILIES = {
    "germanic": "af da de en fo fy is lb nb nl nn no sv yi",
    "romance": "an ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sh sk sl sr uk",
    "baltic": "lt lv",
    "uralic": "et fi hu",
    "turkic": "az kk ky tk tr tt uz",
    "indo-aryan": "bn gu hi mr ne pa sd si ur",
    "iranian": "fa ku ps tg",
    "semitic": "am ar he mt",
    "celtic": "br cy ga gd",
    "dravidian": "kn ml ta te",
    "austronesian": "id jv mg ms su tl",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)
_BUCKET = (mix(np.arange(1 << 24, dtype=np.uint32).astype(np.uint64)) >> np.uint64(64 - BITS)).astype(np.int16)


def featurize(texts: list[bytes]) -> np.ndarray:
    w = Words(texts, hashes=False)
    b = _FOLD[w.buf]
    if len(b) < 3:
        return np.zeros((len(texts), 1 << BITS), np.float32)
    middle = np.flatnonzero(b[1:-1] != 32) + 1
    code = b[middle - 1].astype(np.int32) << 16 | b[middle].astype(np.int32) << 8 | b[middle + 1]
    doc = np.searchsorted(w.doc_start, middle, "right") - 1
    out = np.empty((len(texts), 1 << BITS), np.float32)
    bounds = np.searchsorted(doc, np.arange(len(texts) + 1))
    bucket = _BUCKET[code]
    for d, (lo, hi) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
        out[d] = np.sqrt(np.bincount(bucket[lo:hi], minlength=1 << BITS))
    norm = np.sqrt((out * out).sum(1, keepdims=True))
    return out / np.maximum(norm, 1e-9)


def separate(x: np.ndarray, sign: np.ndarray) -> tuple[np.ndarray, float]:
    """A linear support vector machine: squared hinge loss, both sides of equal weight, accelerated gradient steps."""
    share = np.where(sign > 0, 0.5 / max((sign > 0).sum(), 1), 0.5 / max((sign < 0).sum(), 1)).astype(np.float32)
    w, v, bias, vb = np.zeros(x.shape[1], np.float32), np.zeros(x.shape[1], np.float32), 0.0, 0.0
    rate = 0.25 / (1 + PENALTY)  # the loss has curvature of at most 4 on rows of length 1 with a bias
    for step in range(STEPS):
        slack = np.maximum(0, 1 - sign * (x @ v + vb)) * sign * share
        new, new_b = v + rate * (2 * (slack @ x) - PENALTY * v), vb + rate * 2 * float(slack.sum())
        k = step / (step + 3)
        v, vb = new + k * (new - w), new_b + k * (new_b - bias)
        w, bias = new, new_b
    return w, bias


def tournament(x: np.ndarray, names: np.ndarray) -> tuple[list[str], list[tuple[int, int]], np.ndarray, np.ndarray]:
    """A machine for each pair of names: the names, the pairs, weights (features x pairs) and biases."""
    order = sorted({*names.tolist()})
    pairs = [*combinations(range(len(order)), 2)]
    found = []
    for i, j in pairs:
        mine = (names == order[i]) | (names == order[j])
        found.append(separate(x[mine], np.where(names[mine] == order[i], 1, -1).astype(np.float32)))
    return order, pairs, np.stack([w for w, _ in found], 1) if found else np.zeros((x.shape[1], 0), np.float32), np.array([b for _, b in found])


def decide(x: np.ndarray, machines: tuple) -> tuple[np.ndarray, np.ndarray]:
    """The winner's index and its share of the (logistic) votes for each row."""
    order, pairs, weights, bias = machines
    votes = np.zeros((len(x), len(order)))
    p = 1 / (1 + np.exp(-4 * (x @ weights + bias)))
    for k, (i, j) in enumerate(pairs):
        votes[:, i] += p[:, k]
        votes[:, j] += 1 - p[:, k]
    if not pairs:
        return np.zeros(len(x), int), np.ones(len(x))
    best = votes.argmax(1)
    return best, np.clip(votes[np.arange(len(x)), best] / (len(order) - 1), 0, 1)


def predict(model: dict, texts: list[bytes]) -> tuple[list[str], np.ndarray]:
    lettered = np.array([bool(LETTER.search(t.decode("utf-8"))) for t in texts]) & bool(model)
    names, score = np.full(len(texts), "und", object), np.zeros(len(texts))
    at = np.flatnonzero(lettered)
    for first in range(0, len(at), 256):
        part = at[first : first + 256]
        x = featurize([texts[i] for i in part])
        family, sure = decide(x, model["families"])
        for f, name in enumerate(model["families"][0]):
            mine = np.flatnonzero(family == f)
            if mine.size:
                best, inner = decide(x[mine], model["within"][name])
                names[part[mine]] = np.array(model["within"][name][0], object)[best]
                score[part[mine]] = sure[mine] * inner
    return names.tolist(), score


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> dict:
    """At most about ``sample_docs`` texts are used, and their features reach the driver."""
    ids = docs.where(F.col("lang").isNotNull() & (fold(FOLDS) != HELD_OUT)).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"))
    langs = ids.agg(F.approx_count_distinct("lang", 0.01)).first()[0]
    each = -(-sample_docs // max(langs, 1))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    chosen = ids.withColumn("rank", rank).where(F.col("rank") <= each).groupBy("doc_id").agg(F.min("lang").alias("lang")).limit(2 * sample_docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text is not null").join(F.broadcast(chosen), "doc_id").limit(2 * sample_docs)

    def run(batches):
        for batch, texts in chunks(batches):
            at = [i for i, t in enumerate(texts) if LETTER.search(t.decode("utf-8"))]
            x = featurize([texts[i] for i in at]).astype(np.float16)
            where = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(where), batch.column("lang").take(where), pa.array([r.tobytes() for r in x], pa.binary())], ["doc_id", "lang", "data"])

    got = sorted(map_arrow(rows, run, "doc_id long, lang string, data binary").collect(), key=lambda r: (r.doc_id, r.lang, bytes(r.data)))
    if not got:
        return {}
    x = np.stack([np.frombuffer(r.data, np.float16) for r in got]).astype(np.float32)
    lang = np.array([r.lang for r in got], object)
    family = np.array([FAMILY_OF.get(n.lower().split("-")[0], n) for n in lang], object)
    return {"families": tournament(x, family), "within": {f: tournament(x[family == f], lang[family == f]) for f in sorted({*family.tolist()})}}


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(fold(FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"), F.col("text").cast("string").alias("text"))

    def run(batches):
        for batch, texts in chunks(batches):
            names, score = predict(model.value, texts)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(score)], ["doc_id", "held_out", "lang_pred", "score"])

    return map_arrow(rows, run, "doc_id long, held_out boolean, lang_pred string, score double")
