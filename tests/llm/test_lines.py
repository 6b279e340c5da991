"""Line removal: candidates against edit similarity alone, and short lines between documents."""

import random

from venuelake.llm import line_dedup

LETTERS = "abcdefghijklmnopqrstuvwxyz"


def texts(rng, words):
    return " ".join("".join(rng.choice(LETTERS) for _ in range(rng.randint(2, 9))) for _ in range(words))


def removed(spark, rows, **options):
    return {r.doc_id: r.n_removed for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), **options).collect()}


def test_one_changed_word_is_found_in_lines_of_any_length(spark):
    rng = random.Random(11)
    rows = []
    for i, n in enumerate([10, 12, 15, 20, 30, 60] * 5):
        x = texts(rng, n).split()
        y = list(x)
        at = rng.randrange(n)
        y[at] = y[at][:-1] + "é"
        rows += [(2 * i, " ".join(x)), (2 * i + 1, " ".join(y))]
    assert removed(spark, rows) == {d: d % 2 for d, _ in rows}


def test_keys_of_lines_up_to_exact_miss_no_pair(spark):
    rng = random.Random(12)
    for _ in range(3000):
        x = [rng.choice("ab é") for _ in range(rng.randint(5, line_dedup.EXACT))]
        y = list(x)
        for _ in range(rng.randint(0, 4)):
            at = rng.randrange(len(y))
            y[at : at + 1] = rng.choice([[], [rng.choice(LETTERS)], [y[at], rng.choice(LETTERS)]])
        x, y = ("".join(z) for z in (x, y))
        most = line_dedup.allowed(max(len(x), len(y)), 0.9)
        if x != y and max(len(x), len(y)) <= line_dedup.EXACT and line_dedup.edit_within(x, y, most):
            _, parity, keys = line_dedup.line_keys([x.encode(), y.encode()], 0.9)
            a, b = keys.to_pylist()
            assert {*a} & {*b}, (x, y)
            assert int(parity[0] ^ parity[1]).bit_count() <= 4 * most


def test_short_lines_are_compared_between_documents(spark):
    rows = [(1, "All rights reserved."), (2, "all rights reserved"), (3, "Yes."), (4, "Yes"), (5, "Subscribe to our letter"), (6, "Subscribe to our letters")]
    assert removed(spark, rows) == {1: 0, 2: 1, 3: 0, 4: 1, 5: 0, 6: 1}
    assert removed(spark, [*rows, (7, "Yes.\nYes.")], short=5) == {1: 0, 2: 0, 3: 0, 4: 0, 5: 0, 6: 0, 7: 1}
