"""Near-duplicate groups by bottom-k sketches from one hash function.

A document's set holds its distinct word shingles. The sketch is the ``SKETCH`` smallest shingle hashes. Documents with
equal sets form one class, and only classes are compared.

Candidates come from inverted lists of retained values. A list is kept for each run of consecutive retained values, not
for each single value: similar sets share long runs (the missing values cut the sorted union into few pieces), while
sets that share one common passage hardly share any, so a frequent passage makes no long list. For sets that fit the
sketch the run length is the one that the similarity guarantees; for larger ones it is the longest with a chance below
``MISS`` that two sets at the threshold share no run.

Within a list every member is compared with the first member: the pair passes the estimate from the sketch of the
union (``MARGIN`` below the threshold) and then the exact Jaccard of the full sets. Only lists whose members are then
still in different groups go on; the full sets of these groups are compared block by block in place. So a group
of copies costs as many pairs as it has members, and no pair within a group becomes a row.

Defined results: a text without words (or NULL) has an empty set and stands alone. Rows that share a doc_id are one
node of the graph; each row is returned. A NULL id is kept and never linked.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, map_arrow, stage
from .components import link_groups
from .words import Words, mix

SKETCH = 64
MARGIN = 0.25
MISS = 1e-6
BLOCK = 128
SLICE = 4096
WORDS, SIMILARITY = 5, 0.8


def shingle_sets(texts: list[bytes], n: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; texts of fewer than n words have one shingle of all their words."""
    words = Words(texts)
    grams, at = words.grams(n)
    bounds = np.searchsorted(at, words.first)
    out = [np.unique(grams[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
    count = np.diff(words.first)
    for size in range(1, n):
        few = np.flatnonzero(count == size)
        if few.size:
            h = np.zeros(len(few), np.uint64)
            for k in range(size):
                h = mix(h * np.uint64(3) + words.hash[words.first[few] + k])
            for d, x in zip(few.tolist(), h):
                out[d] = np.array([x], np.uint64)
    return out


def fingerprint(values: np.ndarray) -> tuple[int, int]:
    """Two independent 64-bit sums over the set."""
    a, b = mix(values), mix(values ^ np.uint64(0xA5A5A5A5A5A5A5A5))
    return int(a.sum(dtype=np.uint64).view(np.int64)), int(b.sum(dtype=np.uint64).view(np.int64))


def chance_of_no_run(trials: int, run: int, p: float) -> float:
    """Chance that ``trials`` draws of success ``p`` hold no ``run`` successes in a row."""
    state = [1.0] + [0.0] * (run - 1)
    for _ in range(trials):
        state = [sum(state) * (1 - p)] + [x * p for x in state[:-1]]
    return sum(state)


def run_lengths(percent: int) -> tuple[int, list[list[int]]]:
    """The run length for large sets, and for sets of each size up to SKETCH the lengths that some partner may need."""
    p = percent / 100
    long = max((r for r in range(1, 12) if chance_of_no_run(SKETCH, r, p) < MISS), default=1)

    def sure(union: int) -> int:
        missing = union * (100 - percent) // 100
        return min(long, max(1, math.ceil((union - missing) / (missing + 1))))

    small = [[]]
    for size in range(1, SKETCH + 1):
        small.append(sorted({sure(u) for u in range(size, min(int(size / p), SKETCH) + 1)} | ({long} if int(size / p) > SKETCH else set())))
    return long, small


def sketch_table(docs: DataFrame, n: int) -> DataFrame:
    def run(batches):
        for batch, texts in chunks(batches):
            sets = shingle_sets(texts, n)
            marks = [fingerprint(s) for s in sets]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array([a for a, _ in marks], pa.int64()), pa.array([b for _, b in marks], pa.int64()),
                pa.array([s[:SKETCH].tobytes() for s in sets], pa.binary()),
            ], ["doc_id", "n_shingles", "mark_a", "mark_b", "sketch"])

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), run, "doc_id long, n_shingles long, mark_a long, mark_b long, sketch binary")


def run_keys(classes: DataFrame, percent: int) -> DataFrame:
    """key, node: one row for each run of retained values of each class."""
    long, small = run_lengths(percent)

    def run(batches):
        for batch in batches:
            keys, rows = [], []
            n = batch.column("n").to_pylist()
            for i, raw in enumerate(batch.column("sketch").to_pylist()):
                values = np.frombuffer(raw, np.uint64)
                for size in small[len(values)] if n[i] <= SKETCH else [long]:
                    count = len(values) - size + 1
                    if count > 0:
                        h = np.full(count, size, np.uint64)
                        for k in range(size):
                            h = mix(h * np.uint64(3) + values[k : k + count])
                        keys.append(np.unique(h))
                        rows.append(np.full(len(keys[-1]), i))
            if keys:
                at = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), batch.column("rep").take(at)], ["key", "node"])

    return map_arrow(classes.select("rep", "n", "sketch"), run, "key long, node long")


def estimated(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs whose union sketch doesn't rule them out."""
    side = lambda x: classes.select(F.col("rep").alias(x), F.col("sketch").alias(f"sketch_{x}"))
    low = percent / 100 - MARGIN

    def run(batches):
        for batch in batches:
            fine = []
            for i, (x, y) in enumerate(zip(batch.column("sketch_a").to_pylist(), batch.column("sketch_b").to_pylist())):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = np.sort(np.concatenate([x, y]))
                # Beyond the last value of a full sketch the other one says nothing about the union.
                top = min([z[-1] for z in (x, y) if len(z) == SKETCH], default=both[-1])
                both = both[both <= top]
                shared = np.count_nonzero(both[1:] == both[:-1])
                if shared >= low * (len(both) - shared):
                    fine.append(i)
            yield batch.select(["a", "b"]).take(pa.array(fine, pa.int64()))

    return map_arrow(pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "sketch_a", "sketch_b"), run, "a long, b long")


def full_sets(nodes: DataFrame, docs: DataFrame, classes: DataFrame, n: int, purpose: str) -> DataFrame:
    """rep and members (its whole set) of the classes in ``nodes`` (rep)."""
    wanted = nodes.distinct().join(classes.select("rep", "mark_a", "mark_b"), "rep")
    rows = docs.select(F.col("doc_id").cast("long").alias("rep"), F.col("text").cast("string").alias("text")).join(wanted, "rep")

    def run(batches):
        for batch, texts in chunks(batches):
            found = shingle_sets(texts, n)
            mine = [i for i, (s, a, b) in enumerate(zip(found, batch.column("mark_a").to_pylist(), batch.column("mark_b").to_pylist())) if fingerprint(s) == (a, b)]
            yield pa.RecordBatch.from_arrays([batch.column("rep").take(pa.array(mine, pa.int64())), pa.array([found[i].tobytes() for i in mine], pa.binary())], ["rep", "members"])

    return stage(map_arrow(rows.select("rep", "mark_a", "mark_b", "text"), run, "rep long, members binary"), f"{purpose}-sets")


def verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame, n: int, percent: int, purpose: str) -> DataFrame:
    """The pairs whose full sets have intersection * 100 >= percent * union."""
    full = full_sets(pairs.select(F.col("a").alias("rep")).union(pairs.select(F.col("b").alias("rep"))), docs, classes, n, purpose)
    side = lambda x: full.select(F.col("rep").alias(x), F.col("members").alias(f"members_{x}"))

    def compare(batches):
        for batch in batches:
            fine = []
            for i, (x, y) in enumerate(zip(batch.column("members_a").to_pylist(), batch.column("members_b").to_pylist())):
                size = len(x) // 8 + len(y) // 8
                both = np.sort(np.concatenate([np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)]))
                shared = int(np.count_nonzero(both[1:] == both[:-1]))
                if 100 * shared >= percent * (size - shared):
                    fine.append(i)
            yield batch.select(["a", "b"]).take(pa.array(fine, pa.int64()))

    return map_arrow(pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "members_a", "members_b"), compare, "a long, b long")


def shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Intersection sizes of each set on the left with each on the right, by products of incidence matrices in slices of the values."""
    values, owner = np.concatenate(left + right), np.repeat(np.arange(len(left) + len(right)), [len(s) for s in left + right])
    _, back, count = np.unique(values, return_inverse=True, return_counts=True)
    common = count[back] > 1
    rank = np.cumsum(count > 1) - 1
    column, owner = rank[back[common]], owner[common]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    out = np.zeros((len(left), len(right)), np.float32)
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, SLICE):
        part = slice(*np.searchsorted(column, [first, first + SLICE]))
        held = np.zeros((len(left) + len(right), SLICE), np.float32)
        held[owner[part], column[part] - first] = 1
        out += held[: len(left)] @ held[len(left) :].T
    return out


def links_between(members: DataFrame, docs: DataFrame, classes: DataFrame, n: int, percent: int, purpose: str) -> DataFrame:
    """Links that join different groups of one circle, enough of them to connect all that are connected.

    A circle is cut into blocks of about ``BLOCK`` sets, those of its largest group and those of all others apart. Blocks of
    others meet one another and the blocks of the largest group, each meeting in a task of its own, where full sets are
    compared in place; no pair becomes a row.
    """
    full = full_sets(members.select(F.col("node").alias("rep")), docs, classes, n, purpose)
    by_group = members.groupBy("head", "group").count()
    shape = by_group.groupBy("head").agg(F.max_by("group", F.struct("count", "group")).alias("main"), F.max("count").alias("most"), F.sum("count").alias("total"))
    blocks = lambda c: F.greatest(F.lit(1), F.ceil(c / F.lit(BLOCK))).cast("int")
    shape = shape.select("head", "main", blocks(F.col("total") - F.col("most")).alias("others"), blocks(F.col("most")).alias("mains"))
    rows = members.select("head", "node", "group").join(shape, "head").withColumn("main", F.col("group") == F.col("main"))
    rows = rows.withColumn("block", F.when(F.col("main"), F.col("others") + F.pmod(F.xxhash64("node"), F.col("mains"))).otherwise(F.pmod(F.xxhash64("node"), F.col("others"))).cast("int"))
    meets = F.when(F.col("main"), F.sequence(F.lit(0), F.col("others") - 1)).otherwise(F.sequence(F.lit(0), F.col("others") + F.col("mains") - 1))
    cells = rows.withColumn("other", F.explode(meets)).select("head", "node", "group", "block", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"))
    cells = cells.join(full.withColumnRenamed("rep", "node"), "node")

    def compare(cell: pa.Table) -> pa.Table:
        node, group, block = (np.array(cell.column(c).to_pylist()) for c in ("node", "group", "block"))
        sets = [np.frombuffer(v, np.uint64) for v in cell.column("members").to_pylist()]
        size = np.array([len(s) for s in sets])
        left, right = np.flatnonzero(block == block.min()), np.flatnonzero(block == block.max())
        shared = shared_counts([sets[i] for i in left], [sets[i] for i in right])
        union = size[left][:, None] + size[right][None] - shared
        root = {g: g for g in group.tolist()}

        def find(g):
            while root[g] != g:
                root[g] = g = root[root[g]]
            return g

        found = []
        for i, j in zip(*np.nonzero((100 * shared >= percent * union) & (group[left][:, None] != group[right][None]))):
            a, b = find(int(group[left[i]])), find(int(group[right[j]]))
            if a != b:
                root[a] = b
                found.append((int(node[left[i]]), int(node[right[j]])))
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    return cells.groupBy("head", "x", "y").applyInArrow(compare, "a long, b long")


def near_groups(docs: DataFrame, words: int = WORDS, percent: int = round(100 * SIMILARITY), purpose: str = "near") -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of ``docs``."""
    sketches = stage(sketch_table(docs, words), f"{purpose}-sketches")
    marks = ["n_shingles", "mark_a", "mark_b"]
    named = sketches.where("n_shingles > 0 and doc_id is not null")
    first = named.groupBy(*marks).agg(F.min("doc_id").alias("rep"))
    # One row per class: the sketch comes from the row of the class's first document.
    classes = stage(
        named.join(first.withColumnRenamed("rep", "doc_id"), [*marks, "doc_id"]).select(F.col("doc_id").alias("rep"), F.col("n_shingles").alias("n"), "mark_a", "mark_b", "sketch").dropDuplicates(["rep", "n", "mark_a", "mark_b"]),
        f"{purpose}-classes",
    )
    near = lambda pairs: pairs.where(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent)
    links = lambda pairs, name: verified(stage(estimated(pairs, classes, percent), f"{name}-estimated"), docs, classes, words, percent, name)
    between = lambda members, name: links_between(members, docs, classes, words, percent, name)
    root = link_groups(run_keys(classes, percent), classes.select(F.col("rep").alias("node"), "n"), near, links, purpose, between)
    grouped = first.join(root.withColumnRenamed("node", "rep"), "rep", "left").select(*marks, F.coalesce("root", "rep").alias("component"))
    return (
        sketches.select("doc_id", *marks).join(grouped, marks, "left")
        .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )
