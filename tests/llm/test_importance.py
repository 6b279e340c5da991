"""Importance resampling against a plain computation."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

import __spark_entry__ as entry_points
from tests.compare import compare, connect
from venuelake.llm.importance import resample

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LONG = "x" * 70 + "ä" * 100 + " word " + "y" * 64


def runs(text, n):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return len(words), [" ".join(words[i : i + k]) for k in range(1, n + 1) for i in range(len(words) - k + 1)]


def plain(rows, target, n, buckets, percent, least):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(bucket(f) for _, t in rows for f in runs(t, n)[1])
    t = Counter(bucket(f) for x in target for f in runs(x, n)[1])
    ss, tt = sum(s.values()), sum(t.values())
    out = []
    for doc_id, text in rows:
        words, features = runs(text, n)
        g = [math.floor(1000 * math.log((t[b] + 1) * (ss + buckets) / ((s[b] + 1) * (tt + buckets)))) for b in map(bucket, features)]
        weight = sum(g) // len(g) if g else 0
        score = None
        if doc_id is not None:
            h = int(hashlib.sha256(f"2024:{doc_id}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, words, len(features), weight, score, None])
    fit = sorted((r for r in out if r[0] is not None and r[1] >= least), key=lambda r: (-r[4], r[0], r[2], r[3]))
    for i, r in enumerate(fit[: percent * len(fit) // 100]):
        r[5] = i + 1
    return sorted(map(tuple, out), key=str)


@pytest.mark.parametrize("n, least, percent", [(1, 20, 10), (3, 2, 50)])
def test_against_plain(spark, n, least, percent):
    rows = [(i, f"Word{i % 7} and the Rest of text, number {i} " * (i % 5 + 1) + "ÄÖ ß\x00z") for i in range(60)]
    rows += [(1, rows[1][1]), (2, rows[2][1] + " more"), (100, None), (101, ""), (102, " .,; "), (None, rows[3][1]), (None, None), (103, LONG)]
    target = ["the rest of word3 word3", None, "", "number 5"]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", *[f"'x' AS {c}" for c in ("score", "rank", "weight", "n", "bucket", "above", "drawn", "at", "n_features")])
    got = resample(docs.repartition(5), spark.createDataFrame([(t,) for t in target], "text string"), n, 1000, percent, least)
    assert sorted(map(tuple, got.collect()), key=str) == plain(rows, target, n, 1000, percent, least)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c " * 10)], "doc_id long, text string")
    assert resample(docs.limit(0), docs).collect() == []
    (r,) = resample(docs, docs.limit(0), 1, percent=100).collect()
    assert r.rank == 1 and r.n_features == 30


def test_query_matches_sql(spark):
    sf = "/root/testdata/sf0.001"
    assert compare(entry_points.queries()["op12_resampling"](spark, sf), connect(sf), entry_points.oracle_sql()["op12_resampling"]) is None
