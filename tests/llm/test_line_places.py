"""Places of the runs in a key: chance pairs of long lines leave the lists, pairs within the bound stay, and long lists are cut."""

import random

import numpy as np
from pyspark.sql import functions as F

from venuelake.llm import line_dedup

LETTERS = "abcdefghijklmnopqrstuvwxyz "


def changed(rng, text, edits):
    out = list(text)
    for _ in range(edits):
        at = rng.randrange(len(out))
        out[at : at + 1] = rng.choice([[], [rng.choice(LETTERS)], [out[at], rng.choice(LETTERS)]])
    return " ".join("".join(out).split())


def prose(rng, words, least, most):
    return " ".join(rng.choice(words) for _ in range(rng.randint(least, most)))


def bounds(size, spot):
    part, byte = (size - line_dedup.GRAM + 1) / 256, lambda k: spot >> 8 * k & 255
    rows = range(line_dedup.ROWS)
    return [byte(r) * part for r in rows], [(byte(r) + byte(line_dedup.ROWS + r) + 1) * part for r in rows]


def test_spots_are_where_the_least_runs_stand():
    rng = random.Random(21)
    lines = [prose(rng, ["abc", "bcd", "ca", "dé"], 20, 90).encode() for _ in range(40)]
    size, _, keys, spots = line_dedup.placed_keys(lines, 0.9)
    assert keys.to_pylist() == line_dedup.line_keys(lines, 0.9)[2].to_pylist()
    for line, n, held in zip(lines, size.tolist(), spots.to_pylist()):
        if n <= line_dedup.EXACT:
            continue
        text, n = line.decode(), n - line_dedup.GRAM + 1
        runs = {}
        for i in range(n):
            runs.setdefault(text[i : i + line_dedup.GRAM], []).append(i * 256 // n)
        found = {(at[0], at[-1] - at[0]) for at in runs.values()}
        assert all((s >> 8 * r & 255, s >> 8 * (line_dedup.ROWS + r) & 255) in found for s in held for r in range(line_dedup.ROWS))


def test_pairs_within_the_bound_stay():
    rng = random.Random(22)
    words = ["".join(rng.choice(LETTERS[:-1]) for _ in range(rng.randint(2, 8))) for _ in range(300)]
    met = kept = 0
    for _ in range(400):
        x = prose(rng, words, 12, 150)
        y = changed(rng, x, rng.randint(1, len(x) // 10))
        if line_dedup.edit_within(x, y, line_dedup.allowed(max(len(x), len(y)), 0.9)):
            size, _, keys, spots = line_dedup.placed_keys([x.encode(), y.encode()], 0.9)
            a, b = (dict(zip(k, s)) for k, s in zip(keys.to_pylist(), spots.to_pylist()))
            for key in a.keys() & b.keys():
                low, high = bounds(size, np.array([a[key], b[key]]))
                met += 1
                kept += len(line_dedup.can_link(size, low, high, np.array([0]), np.array([1]), 0.9))
    assert met > 800 and kept >= 0.99 * met


def test_chance_pairs_make_no_lists(spark):
    rng = random.Random(23)
    words = ["".join(rng.choice(LETTERS[:-1]) for _ in range(rng.randint(2, 6))) for _ in range(40)]
    rows = [(i, prose(rng, words, 150, 160)) for i in range(150)]
    rows += [(1000 + i, changed(rng, t, 5)) for i, t in rows[:20]]
    lines = line_dedup.line_table(spark.createDataFrame(rows, "doc_id long, text string")).localCheckpoint()
    mark = {r.doc_id: r.mark for r in lines.select("doc_id", "mark").collect()}
    lists = lambda df: {frozenset(r.nodes) for r in line_dedup.key_lists(df, 0.9).groupBy("name").agg(F.collect_set("node").alias("nodes")).collect()}
    without, found = lists(lines.drop("spots")), lists(lines)
    assert sum(map(len, found)) < 0.2 * sum(map(len, without))
    assert all(any({mark[i], mark[1000 + i]} <= x for x in found) for i in range(20))


def test_long_lists_are_cut_and_lose_no_pair(monkeypatch):
    monkeypatch.setattr(line_dedup, "BLOCK", 16)
    rng = np.random.default_rng(24)
    size = rng.integers(60, 400, 600)
    first, more = rng.integers(0, 256, (3, 600)), rng.integers(0, 3, (3, 600)) ** 4
    spot = sum(np.minimum(f, 255 - m) << 8 * k | m << 8 * (3 + k) for k, (f, m) in enumerate(zip(first, more)))
    low, high = bounds(size, spot)
    x, y = np.triu_indices(600, 1)
    fine = line_dedup.can_link(size, low, high, x, y, 0.9)
    cells = line_dedup.halves(np.arange(600), size, low, high, 0.9)
    held = {(int(a), int(b)) for c in cells for a in c for b in c}
    assert len(fine) and max(map(len, cells)) <= 64 and all((int(x[i]), int(y[i])) in held for i in fine)
    # Lines of the same size and places stay one list.
    assert [len(c) for c in line_dedup.halves(np.arange(40), np.full(40, 90), [np.zeros(40)] * 3, [np.ones(40)] * 3, 0.9)] == [40]
