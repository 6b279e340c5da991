"""Importance resampling of documents towards a target distribution of hashed word runs.

Features of a text are its runs of 1 to ``max_words`` consecutive words, joined by one space; their bucket is the crc32 of their
bytes modulo ``buckets``, taken from a table of bytes by distance from the end (``position_crc``). All rows of the
corpus and of the target are counted per bucket. A bucket's gain is the floored log ratio of the smoothed shares in
thousandths, a document's weight the floored mean gain of its features, and its score the weight with Gumbel noise
from the id, so that the highest scores are a sample without replacement in proportion to the weights.

What reaches the driver is one count per bucket. Ranks need no global sort: scores are whole thousandths, so the
number of documents above each score value comes from a histogram, and only the drawn ones are numbered within their score.

Defined results: a NULL or empty text has no feature and weight 0. Rows that share a doc_id are ranked one by one, in
the order of doc_id, then fewer features, then lower weight. A row with a NULL doc_id has a weight but neither score nor rank, and does
not count among the documents drawn from. An empty target or corpus has only smoothing counts. Other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import chunks, map_arrow, stage
from .position_crc import crc_spans
from .words import sums

SCALE = 4294967296  # 2 ** 32

#: Bytes of a word after lower-casing: digits, letters and all of non-ASCII. Upper case goes to lower case.
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True


class Runs:
    """Word runs of many texts: ``buf`` with one space behind each word, start and end in it, and the text of each run."""

    def __init__(self, texts: list[bytes], max_words: int):
        raw = np.frombuffer(b"\n".join([b"", *texts, b""]), np.uint8)
        low = _FOLD[raw]
        inside = _WORD[low]
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        first, last = edges[0::2], edges[1::2]
        text_end = np.cumsum(np.fromiter((len(x) + 1 for x in texts), np.int64, len(texts)))
        self.n_words = np.bincount(np.searchsorted(text_end, first, "left"), minlength=len(texts)).astype(np.int64)
        size = last - first
        start = np.cumsum(size + 1) - size - 1
        self.buf = np.full(int((size + 1).sum()), 32, np.uint8)
        gap = np.ones(len(self.buf), bool)
        gap[start + size] = False
        self.buf[gap] = low[inside]
        doc = np.repeat(np.arange(len(texts)), self.n_words)
        starts, ends, docs = [], [], []
        for n in range(1, max_words + 1):
            if len(doc) < n:
                break
            at = np.flatnonzero(doc[n - 1 :] == doc[: len(doc) - n + 1])
            starts.append(start[at])
            ends.append(start[at + n - 1] + size[at + n - 1])
            docs.append(doc[at])
        self.start, self.end, self.doc = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (starts, ends, docs))

    def buckets(self, count: int) -> np.ndarray:
        return (crc_spans(self.buf, self.start, self.end) % np.uint32(count)).astype(np.int64)


def bucket_counts(rows: DataFrame, max_words: int, buckets: int) -> np.ndarray:
    """Features of all rows per bucket. Every task adds up its own before the exchange."""

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for _, texts in chunks(batches):
            total += np.bincount(Runs(texts, max_words).buckets(buckets), minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    counted = map_arrow(rows.select(F.col("text").cast("string").alias("text")), run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in counted.collect():  # at most one row per bucket
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Floored thousandths of the log of the smoothed target share over the smoothed corpus share."""
    n, total, aimed = len(corpus), int(corpus.sum()), int(target.sum())
    ratio = [(float(t) + 1.0) * (total + n) / ((float(s) + 1.0) * (aimed + n)) for s, t in zip(corpus.tolist(), target.tolist())]
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, max_words: int) -> DataFrame:
    """doc_id, n_words, n_features and weight of every row."""

    def run(batches):
        for batch, texts in chunks(batches):
            runs = Runs(texts, max_words)
            order = np.argsort(runs.doc, kind="stable")
            n = np.bincount(runs.doc, minlength=len(texts))
            total = sums(gain[runs.buckets(len(gain))[order]], np.concatenate([[0], np.cumsum(n)]))
            weight = np.floor_divide(total, np.maximum(n, 1))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(runs.n_words), pa.array(n.astype(np.int64)), pa.array(weight.astype(np.int64))], ["doc_id", "n_words", "n_features", "weight"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_arrow(rows, run, "doc_id long, n_words long, n_features long, weight long")


def resample(docs: DataFrame, target: DataFrame, max_words: int = 2, buckets: int = 10000, percent: int = 10, least_words: int = 20, seed: int = 2024, purpose: str = "resample") -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank (NULL if not drawn) of every row."""
    gain = gains(bucket_counts(docs, max_words, buckets), bucket_counts(target, max_words, buckets))
    digest = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")), 256), 1, 8)
    uniform = (F.conv(digest, 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(SCALE))
    noise = F.floor(F.lit(-1000) * F.log(-F.log(uniform))).cast("long")
    rows = stage(weigh(docs, gain, max_words).withColumn("score", F.col("weight") + noise), purpose)
    fit = F.col("doc_id").isNotNull() & (F.col("n_words") >= least_words)
    # Scores are whole numbers between the least and the greatest gain (1000 times the log of a count) plus 32-bit noise: under 100,000 values at any size.
    histogram = rows.where(fit).groupBy("score").agg(F.count("*").alias("n"))
    down = Window.orderBy(F.col("score").desc())
    above = histogram.select(
        F.col("score").alias("at"), (F.sum("n").over(down) - F.col("n")).alias("above"), F.floor(F.sum("n").over(Window.partitionBy()) * F.lit(percent) / 100).cast("long").alias("drawn")
    ).where("above < drawn")
    ranked = rows.join(F.broadcast(above), fit & (F.col("score") == F.col("at")), "left")
    place = F.col("above") + F.row_number().over(Window.partitionBy("score").orderBy("doc_id", "n_features", "weight"))
    chosen = ranked.where("above is not null").withColumn("rank", place).withColumn("rank", F.when(F.col("rank") <= F.col("drawn"), F.col("rank")))
    names = ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    return chosen.select(names).unionByName(ranked.where("above is null").withColumn("rank", F.lit(None).cast("long")).select(names))
