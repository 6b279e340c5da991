"""Lines that meet in cells: links between groups against all pairs, and circles larger than a block."""

import random

from venuelake.llm import line_dedup
from venuelake.llm.components import meetings

LETTERS = "abcdefg "


def changed(rng, text, edits):
    out = list(text)
    for _ in range(edits):
        at = rng.randrange(len(out))
        out[at : at + 1] = rng.choice([[], [rng.choice(LETTERS)], [out[at], rng.choice(LETTERS)]])
    return "".join(out)


def groups(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        root[find(a)] = find(b)
    return {n: min(m for m in nodes if find(m) == find(n)) for n in nodes}


def test_cells_connect_what_all_pairs_connect():
    rng = random.Random(3)
    for n in (4, 7, 30):
        for length in (2, 12, 60, 200):
            bases = ["".join(rng.choice(LETTERS) for _ in range(length)) for _ in range(3)]
            rows = [{"node": i, "group": i, "block": rng.randrange(2), "normal": changed(rng, rng.choice(bases), rng.randint(0, max(1, length // 8))) or "x"} for i in range(n)]
            rows[0]["block"], rows[1]["block"] = 0, 1
            pairs = [(x["node"], y["node"]) for x in rows for y in rows if x["block"] < y["block"]]
            text = [r["normal"] for r in rows]
            most = [[line_dedup.allowed(max(len(x), len(y)), 0.9) for y in text] for x in text]
            want = [(i, j) for i, j in pairs if most[i][j] and line_dedup.edit_within(text[i], text[j], most[i][j])]
            got = line_dedup.cell_links(rows, 0.9)
            assert set(got) <= set(want)
            assert groups(range(n), got) == groups(range(n), want)


def test_every_pair_between_groups_has_a_cell(spark):
    rows = [(1, n, 0 if n < 40 else n) for n in range(70)] + [(2, n, n) for n in range(3)]
    cells = {}
    for r in meetings(spark.createDataFrame(rows, "head long, node long, group long"), 8).collect():
        cells.setdefault((r.head, r.x, r.y), []).append(r)
    met = set()
    for (head, x, y), held in cells.items():
        left, right = ([r for r in held if r.block == b] for b in (x, y))
        assert len(held) == len({r.node for r in held}) and {r.block for r in held} <= {x, y}
        met |= {(head, *sorted((a.node, b.node))) for a in left for b in right if a.node != b.node}
    assert met >= {(h, a, b) for h, a, g in rows for i, b, k in rows if h == i and a < b and g != k}


def test_a_circle_of_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "BLOCK", 4)
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7))
    frame = [word() for _ in range(20)]
    # Lines of one frame with four own words share keys, but only copies with one changed letter are similar enough.
    rows = []
    for i in range(30):
        line = frame[:12] + [word() for _ in range(4)]
        rows += [(2 * i, " ".join(line)), (2 * i + 1, " ".join(line)[:-1] + "é")]
    got = {r.doc_id: r.n_removed for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {d: d % 2 for d, _ in rows}
