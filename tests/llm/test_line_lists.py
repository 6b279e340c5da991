"""Lists of lines that share a key: what reaches the comparison, and many distance tables at once."""

import random

from pyspark.sql import functions as F

from venuelake.llm import line_dedup

LETTERS = "abcdefghijklmnopqrstuvwxyz"


def changed(rng, text, edits):
    out = list(text)
    for _ in range(edits):
        at = rng.randrange(len(out))
        out[at : at + 1] = rng.choice([[], [rng.choice(LETTERS)], [out[at], rng.choice(LETTERS)]])
    return "".join(out)


def distance(a, b):
    row = [*range(len(b) + 1)]
    for i, u in enumerate(a, 1):
        new = [i]
        for j, v in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (u != v)))
        row = new
    return row[-1]


def test_many_distances_at_once():
    rng = random.Random(6)
    pairs, most = [], []
    for _ in range(600):
        x = "".join(rng.choice("abc dé𐍈"[: rng.choice([6, 7, 7])]) for _ in range(rng.choice([1, 2, 9, 40, 130])))
        pairs.append((x, changed(rng, x, rng.randint(0, max(1, len(x) // 6))) or "x"))
        most.append(max(0, distance(*pairs[-1]) + rng.choice([-1, 0, 1])))
    want = [distance(x, y) <= m for (x, y), m in zip(pairs, most)]
    assert line_dedup.all_within(pairs, most) == want
    assert [line_dedup.edit_within(x, y, m) for (x, y), m in zip(pairs, most)] == want
    assert all(line_dedup.edits_at_most(x, y, m) >= distance(x, y) for (x, y), m in zip(pairs, most))


def test_lists_are_cut_where_sizes_forbid_a_link_and_come_once(spark):
    rows = [(1, 100, [7, 8, 9]), (2, 105, [7, 8, 9]), (3, 150, [7]), (4, 160, [7]), (5, 300, [7]), (1, 100, [7]), (6, 50, [5])]
    got = line_dedup.key_lists(spark.createDataFrame(rows, "mark long, size int, keys array<long>"), 0.9)
    lists = sorted(tuple(r) for r in got.groupBy("name").agg(F.min("head"), F.sort_array(F.collect_list("node")), F.max("members")).drop("name").collect())
    assert lists == [(1, [1, 2], 2), (3, [3, 4], 2)]


def test_a_text_comes_once_for_all_lists_of_a_head(spark):
    text = " ".join("".join(random.Random(7).choice(LETTERS) for _ in range(6)) for _ in range(20))
    docs = spark.createDataFrame([(i, f"{text} {i * 'x'}") for i in range(1, 5)], "doc_id long, text string")
    lines = line_dedup.line_table(docs)
    classes = lines.groupBy("mark").agg(F.min(F.struct("doc_id", "line")).alias("first"))
    lists = line_dedup.key_lists(lines, 0.9)
    got = line_dedup.list_texts(lists, classes, docs, "test").collect()
    assert len(got) == len({(r.head, r.node) for r in got}) and {r.node for r in got} == {r.mark for r in lines.collect()}
    assert sum(len(r.names) for r in got) == lists.count()


def test_pairs_that_cannot_end_within_the_bound_go_early():
    rng = random.Random(9)
    pairs, most = [], []
    for _ in range(300):
        x = "".join(rng.choice("abcd ") for _ in range(rng.choice([150, 220, 300])))
        far = rng.random() < 0.8
        pairs.append((x, changed(rng, x, rng.randint(40, 90) if far else rng.randint(1, 20))))
        most.append(max(1, distance(*pairs[-1]) + rng.choice([-1, 0, 1]) if not far or rng.random() < 0.2 else 20))
    want = [distance(x, y) <= m for (x, y), m in zip(pairs, most)]
    assert line_dedup.all_within(pairs, most) == want and 30 < sum(want) < 270
