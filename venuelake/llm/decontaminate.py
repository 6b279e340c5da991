"""Documents that hold passages of a benchmark, found by edit distance.

Texts are normalised (lower case, ASCII punctuation as space) and read as words. An item of n words is
held by a document if some passage is within floor(n * (1 - ``SIMILARITY``)) word edits of it.

1. Where to look. n words with d edits keep a run of at least ceil((n - d) / (d + 1)) words untouched, so a passage
   within the bound shares a word run of that length (``SEED`` at most) with the item. Only windows at such places,
   as many words long as the item and aligned by the run, are considered; nothing within the bound is lost here.
2. CGK embedding. Each window is rewritten by ``WALKS`` random walks: in step j the current word is put out, and a random
   bit of (j, word) says whether to go on to the next one. Walks over similar texts fall into step again after an edit,
   so edit distance becomes Hamming distance.
3. Bit sampling. Each walk has ``SAMPLES`` keys of ``BITS`` positions, sampled where walks are still inside; a window meets
   the items of its length that share a key. Measured on the keys alone: windows at the bound 99% or more, unrelated windows 1% to 4% (see the tests).
4. Verification. The exact edit distance of the item to the best passage around the window.

The benchmark is read in blocks of a bounded size; each block is one pass over the documents, without a shuffle.

Defined results: NULL and empty texts hold nothing; items under ``LEAST`` words aren't searched for. Repeated rows and
repeated items each give their own rows. An empty benchmark finds nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, map_arrow
from .words import Lookup, Words, mix

SIMILARITY = 0.8
SEED = 4
LEAST = 5
WALKS, SAMPLES, BITS = 6, 12, 2
BLOCK_ITEMS, BLOCK_BYTES = 20_000, 16 << 20
_PAD = np.uint64(0x5851F42D4C957F2D)
_TABLE = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256))


def normalise(text: bytes) -> bytes:
    return (text.lower() if text.isascii() else text.decode("utf-8").lower().encode("utf-8")).translate(_TABLE)


def reach(size: int) -> int:
    """Steps of a walk over ``size`` words that are sampled. A walk ends near twice as many, so it is still inside in nearly all of these."""
    return max(1, 3 * size // 2)


def embed(words: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The walks' outputs for windows words[start:start+size]: (windows, WALKS, steps that the longest one needs)."""
    steps = reach(int(size.max()))
    salt = mix(np.arange(1, steps * WALKS + 1, dtype=np.uint64)).reshape(steps, WALKS)
    at = np.zeros((len(start), WALKS), np.int64)
    out = np.empty((len(start), WALKS, steps), np.uint64)
    last = len(words) - 1
    for j in range(steps):
        inside = at < size[:, None]
        word = np.where(inside, words[np.minimum(start[:, None] + at, last)], _PAD)
        out[:, :, j] = word
        at += (mix(word ^ salt[j]) >> np.uint64(63)).astype(np.int64)
    return out


def sampled(embedded: np.ndarray, size: int) -> np.ndarray:
    """The keys of windows of ``size`` words: (windows, WALKS * SAMPLES). A key with a place behind the end of its walk is 0 and matches nothing."""
    where = np.random.default_rng(size).integers(0, reach(size), (WALKS, SAMPLES, BITS))
    key = np.zeros((len(embedded), WALKS, SAMPLES), np.uint64)
    ended = np.zeros(key.shape, bool)
    for b in range(BITS):
        value = embedded[:, np.arange(WALKS)[:, None], where[:, :, b]]
        ended |= value == _PAD
        key = mix(key * np.uint64(3) + value)
    key = mix(key + np.arange(WALKS * SAMPLES, dtype=np.uint64).reshape(WALKS, SAMPLES))
    return np.where(ended, np.uint64(0), key).reshape(len(embedded), -1)


def best_passage(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Least edit distance of the item to any passage of ``text``, and where the first such passage ends."""
    column = np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, np.int64)
    for i, word in enumerate(item, 1):
        new = np.minimum(row + 1, np.concatenate([[i], row[:-1] + (text != word)]))
        row = np.minimum.accumulate(new - column) + column
    end = int(row.argmin())
    return int(row[end]), end


class Items:
    """One block of the benchmark, prepared for search."""

    def __init__(self, ids: list[int], texts: list[bytes], similarity: float):
        w = Words([normalise(t) for t in texts], fold=False)
        self.ids, self.words = ids, [w.hash[a:b] for a, b in zip(w.first[:-1], w.first[1:])]
        self.size = np.diff(w.first)
        self.allowed = np.floor(self.size * (1 - similarity) + 1e-9).astype(int)
        seeds = np.minimum(SEED, -(-(self.size - self.allowed) // (self.allowed + 1)))
        self.searched = self.size >= LEAST
        #: Seed length -> seed hash -> the items and offsets that have it.
        self.seeds: dict[int, tuple[Lookup, list[list[tuple[int, int]]]]] = {}
        for q in sorted({*seeds[self.searched].tolist()}):
            grams, at = w.grams(q)
            found: dict[int, list[tuple[int, int]]] = {}
            for h, k in zip(grams.tolist(), at.tolist()):
                i = int(w.doc[k])
                if self.searched[i] and seeds[i] == q:
                    found.setdefault(h, []).append((i, k - int(w.first[i])))
            self.seeds[q] = Lookup(np.array([*found], np.uint64), np.arange(len(found))), [*found.values()]
        self.keys: dict[int, dict[int, list[int]]] = {}
        for n in {*self.size[self.searched].tolist()}:
            mine = np.flatnonzero((self.size == n) & self.searched)
            table = self.keys.setdefault(n, {})
            for i, row in zip(mine.tolist(), sampled(embed(w.hash, w.first[:-1][mine], self.size[mine]), n).tolist()):
                for key in row:
                    if key:
                        table.setdefault(key, []).append(i)

    def candidates(self, w: Words) -> set[tuple[int, int, int]]:
        """(text, item, first word of the window) of the windows that share a key with an item."""
        windows: set[tuple[int, int, int]] = set()
        for q, (lookup, places) in self.seeds.items():
            grams, at = w.grams(q)
            value = lookup(grams)
            for k, v in zip(at[value >= 0].tolist(), value[value >= 0].tolist()):
                d = int(w.doc[k])
                lo, hi = int(w.first[d]), int(w.first[d + 1])
                for i, offset in places[v]:
                    n = int(self.size[i])
                    windows.add((d, max(lo, min(k - offset, hi - n)), min(n, hi - lo)) + (n,))
        if not windows:
            return set()
        rows = sorted(windows)
        d, start, size, n = np.array(rows).T
        found: set[tuple[int, int, int]] = set()
        for first in range(0, len(rows), 4096):
            part = slice(first, first + 4096)
            embedded = embed(w.hash, start[part], size[part])
            for length in {*n[part].tolist()}:
                mine = np.flatnonzero(n[part] == length)
                need = reach(length) - embedded.shape[2]
                shape = embedded[mine] if need <= 0 else np.concatenate([embedded[mine], np.full((len(mine), WALKS, need), _PAD)], 2)
                table = self.keys[length]
                for r, keys in zip(mine.tolist(), sampled(shape, length).tolist()):
                    for i in {i for key in keys if key for i in table.get(key, ())}:
                        found.add((int(d[first + r]), i, int(start[first + r])))
        return found

    def matches(self, texts: list[bytes]) -> list[tuple[int, int, int, int]]:
        """(text, item, distance, first word of the passage's window) of each item held, the nearest passage of each."""
        w = Words([normalise(t) for t in texts], fold=False)
        best: dict[tuple[int, int], tuple[int, int]] = {}
        for d, i, start in sorted(self.candidates(w)):
            n, allowed = int(self.size[i]), int(self.allowed[i])
            lo, hi = max(int(w.first[d]), start - 2 * allowed), min(int(w.first[d + 1]), start + n + 2 * allowed)
            distance, end = best_passage(self.words[i], w.hash[lo:hi])
            if distance <= allowed:
                place = distance, max(lo + end - n, int(w.first[d])) - int(w.first[d])
                best[d, i] = min(best.get((d, i), place), place)
        return [(d, i, *x) for (d, i), x in sorted(best.items())]


def item_blocks(benchmark: DataFrame, similarity: float) -> Iterator[Items]:
    """The benchmark in blocks of at most about BLOCK_ITEMS items and BLOCK_BYTES bytes."""
    rows = benchmark.where("text is not null").select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    count, size = rows.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    n = max(1, -(-2 * count // BLOCK_ITEMS), -(-2 * size // BLOCK_BYTES)) if count > BLOCK_ITEMS or size > BLOCK_BYTES else 1
    # One block after the other: only one is held and prepared on the driver at a time.
    blocks = (sorted((r.item_id if r.item_id is not None else -1, r.text) for r in rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).collect()) for k in range(n))
    for b in blocks:
        yield Items([i for i, _ in b], [t.encode() for _, t in b], similarity)


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, item_id, item_words, distance, start_word of each item that a row of ``docs`` holds."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = None
    for block in item_blocks(benchmark, similarity):
        items = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches, items=items):
            for batch, texts in chunks(batches):
                found = items.value.matches(texts)
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").take(pa.array([d for d, *_ in found], pa.int64())), pa.array([items.value.ids[i] for _, i, *_ in found], pa.int64()),
                    pa.array([int(items.value.size[i]) for _, i, *_ in found], pa.int32()), pa.array([x for *_, x, _ in found], pa.int32()), pa.array([s for *_, s in found], pa.int32()),
                ], ["doc_id", "item_id", "item_words", "distance", "start_word"])

        part = map_arrow(rows, run, "doc_id long, item_id long, item_words int, distance int, start_word int")
        out = part if out is None else out.union(part)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no item."""
    for block in item_blocks(benchmark, similarity):
        items = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches, items=items):
            for batch, texts in chunks(batches):
                held = {d for d, *_ in items.value.matches(texts)}
                yield batch.take(pa.array([d for d in range(batch.num_rows) if d not in held], pa.int64()))

        docs = map_arrow(docs, run, docs.schema)
    return docs
