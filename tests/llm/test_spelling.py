"""Spelling variants against a plain search of all pairs."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as entry_points
from tests.compare import compare, connect
from venuelake.llm import spelling
from venuelake.llm.spelling import left_out, variants


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(rows, least=5, occurrences=3, ratio=2, noise=97):
    count = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{doc_id}:{w}".encode())
            if doc_id is not None and noise and h % noise == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            count[w] += 1
    count = {w: n for w, n in count.items() if len(w) >= least and n >= occurrences}
    form, partners = {}, {}
    for w, n in count.items():
        mine = [v for v in count if near(w, v)]
        partners[w] = len(mine)
        best = min(mine, key=lambda v: (-count[v], v), default=None)
        form[w] = best if best and count[best] >= ratio * n else None
    out = []
    for w, n in count.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, partners[w], count[form[w]] if form[w] else None))
    return sorted(out)


def texts(seed, n=60):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcdeéÿ") for _ in range(rng.randint(4, 9))) for _ in range(60)] + ["aaaaa", "aaaaaa", "abababab", "z" * 80, "z" * 81, "y" * 40 + "z" * 41]
    rows = []
    for i in range(n):
        words = []
        for _ in range(80):
            w = base[min(int(rng.expovariate(0.06)), len(base) - 1)]
            if rng.random() < 0.4:
                k = rng.randrange(len(w))
                w = rng.choice([w[:k] + w[k + 1 :], w[:k] + rng.choice("abÉx") + w[k:], w[:k] + rng.choice("abx") + w[k + 1 :]])
            words.append(w.upper() if rng.random() < 0.05 else w)
        rows.append((i if i % 9 else 3, " ".join(words) + "×÷, Ā 'q"))
    rows.append((499, "chainaa " * 3 + "chainab " * 7 + "chainbb " * 20))
    return rows + [(None, rows[0][1]), (500, None), (501, ""), (502, " 1 - \n")]


@pytest.mark.parametrize("group", [50_000, 2])
def test_against_all_pairs(spark, group):
    rows = texts(1)
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", *[f"'x' AS {c}" for c in ("word", "n", "near", "sig", "form", "root", "choice", "first", "last")])
    got = sorted(map(tuple, variants(docs.repartition(4), noise=97, group=group).collect()))
    want = plain(rows)
    assert got == want
    assert sum(r[1] is not None for r in want) > 50 and any(r[2] != r[1] and r[1] for r in want)


def test_empty_and_untouched(spark):
    docs = spark.createDataFrame([(1, "hello hello hello help!")], "doc_id long, text string")
    assert variants(docs.limit(0)).collect() == []
    assert [tuple(r) for r in variants(docs).collect()] == [("hello", None, "hello", 3, 0, None)]


def test_left_out_keys_find_all_pairs(spark):
    words = sorted({w for _, t in texts(2, 8) for w in (t or "").split() if len(w) >= 5})
    got = {(r.word, r.near) for r in left_out(spark.createDataFrame([(w, 1) for w in words], "word string, n long")).collect()}
    assert got == {(a, b) for a in words for b in words if near(a, b)}


def test_signatures_miss_no_pair():
    """Any two words one edit apart share a signature, and a hash of one half."""
    rng = random.Random(7)
    for _ in range(400):
        a = "".join(rng.choice("abcdefgé") for _ in range(rng.randint(5, 14)))
        k = rng.randrange(len(a))
        b = rng.choice([a[:k] + a[k + 1 :], a[:k] + rng.choice("xyza") + a[k + 1 :]])
        if a == b:
            continue
        x, y = (np.array([[ord(c) for c in w]], np.uint32) for w in (a, b))
        keys = [set(spelling.signatures(m)[0][0].tolist()) for m in (x, y)]
        assert keys[0] & keys[1]
        n = min(len(a), len(b))
        assert any((p == q).all() for p, q in zip(spelling.halves(x, n), spelling.halves(y, n)))


def test_query_matches_sql(spark):
    sf = "/root/testdata/sf0.001"
    assert compare(entry_points.queries()["op13_spelling"](spark, sf), connect(sf), entry_points.oracle_sql()["op13_spelling"]) is None
