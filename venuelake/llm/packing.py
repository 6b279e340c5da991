"""Packing of documents into windows of tokens by Karmarkar-Karp multiway differencing.

A document's tokens end with one closing id. Parts of a whole window are windows of their own; what is left of each document is
dealt to shards of about ``SHARD`` windows, by a hash of the row and not of its id, so copies of one id spread. In a
shard every piece starts as a partial partition of one sum. The two partial partitions of widest spread are merged again and
again, the largest sums of one on the smallest of the other, until one is left: its sums are the windows. If one is
over the capacity, the window count rises. If it would rise by over ``PADDING`` of the least count, pieces are cut to half the length
first: documents of medium length, of which no whole number fits a window, are thus cut, and others stay whole.

Token ids come from the tokenizers library, once for each distinct piece of text between cuts that no token spans. The
checksums of cut pieces are joined from those of blocks of ``BLOCK`` tokens, so ids are not shuffled unless asked for.

Defined results: a NULL or empty text has the closing id only. Rows with equal or NULL doc_id are documents of their own.
An empty table gives no rows. Which pieces share a window depends on how rows are dealt to tasks; every piece has its
place exactly once in any case. Other columns are ignored.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, map_arrow, stage
from .position_crc import joined
from .words import SPACE, Words, mix, prefix_sums, range_hash, sums, _RAW

#: Windows in a shard on average.
SHARD = 256
#: Share of windows above the least count from which pieces are cut instead.
PADDING = 0.005
#: Tokens of a block with a checksum of its own; pieces are cut at blocks.
BLOCK = 128
#: Shorter pieces are strung together before they are differenced.
CRUMB = 16
STORE_WORDS = 1_500_000

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_TAIL = np.zeros(256, bool)
_TAIL[[33, 34, 41, 44, 46, 58, 59, 63]] = True
_OPEN = 60  # "<": case counts in special tokens
_encoders: dict[str, Encoder] = {}


class Encoder:
    """Ids of texts. Text is cut at ASCII white space and between a letter and closing punctuation, where no token of a vocabulary
    that splits letters from punctuation and drops white space can stand; each distinct part is encoded once."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        self.forget()

    def forget(self) -> None:
        self.slot: dict[int, int] = {}
        self.ids = np.zeros(1 << 16, np.uint32)
        self.used = 0
        self.first = np.zeros(1 << 16, np.int64)
        self.size = np.zeros(1 << 16, np.int32)

    def _learn(self, hashes: list[int], parts: list[str]) -> None:
        for a in range(0, len(parts), 20_000):
            some = [x.ids for x in self.library.encode_batch_fast(parts[a : a + 20_000], add_special_tokens=False)]
            size = np.fromiter(map(len, some), np.int32, len(some))
            flat = np.fromiter((i for x in some for i in x), np.uint32, int(size.sum()))
            while self.used + len(flat) > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
            n = len(self.slot)
            while n + len(some) > len(self.size):
                self.first, self.size = np.concatenate([self.first, np.zeros_like(self.first)]), np.concatenate([self.size, np.zeros_like(self.size)])
            self.ids[self.used : self.used + len(flat)] = flat
            self.first[n : n + len(some)] = self.used + np.cumsum(size) - size
            self.size[n : n + len(some)] = size
            self.used += len(flat)
            self.slot.update(zip(hashes[a : a + 20_000], range(n, n + len(some))))

    def encode(self, texts: list[bytes], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each closed by ``end_id``, one after the other, and the number of each."""
        w = Words(texts, fold=True)
        buf = w.buf
        cut = np.flatnonzero(_LETTER[buf[:-1]] & _TAIL[buf[1:]]) + 1
        start, end = np.sort(np.concatenate([w.start, cut])), np.sort(np.concatenate([w.end, cut]))
        key = range_hash(w.prefix, start, end)
        special = np.flatnonzero(buf == _OPEN)
        if special.size:
            at = np.unique(np.searchsorted(start, special, "right") - 1)
            key[at] = mix(range_hash(prefix_sums(buf, _RAW), start[at], end[at]) + np.uint64(1))
        unique, one, back = np.unique(key, return_index=True, return_inverse=True)
        if len(self.slot) > STORE_WORDS:
            self.forget()
        keys = unique.tolist()
        slots = [self.slot.get(k, -1) for k in keys]
        new = [i for i, s in enumerate(slots) if s < 0]
        if new:
            a, b = start[one[new]].tolist(), end[one[new]].tolist()
            self._learn([keys[i] for i in new], [w.raw[x:y].decode("utf-8") for x, y in zip(a, b)])
            slots = [self.slot[k] for k in keys]
        slot = np.array(slots, np.int64)[back] if len(back) else np.zeros(0, np.int64)
        size = self.size[slot].astype(np.int64)
        bounds = np.searchsorted(start, np.append(w.doc_start, len(buf)))
        count = sums(size, bounds) + 1
        ends = np.cumsum(count)
        out = np.full(int(ends[-1]) if len(ends) else 0, end_id, np.uint32)
        body = np.ones(len(out), bool)
        body[ends - 1] = False
        place = np.cumsum(size) - size
        out[body] = self.ids[np.arange(int(size.sum())) + np.repeat(self.first[slot] - place, size)]
        return out, count


def encoder(path: str) -> Encoder:
    """One for each Python worker and file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def pieces(docs: DataFrame, path: str, window: int, end_id: int, keep_ids: bool) -> DataFrame:
    """doc_id, start, length, doc_tokens, crcs and spread of each document's parts of a whole window and of its rest.

    ``crcs`` has the checksum of a whole window, or of each block of a rest."""

    def run(batches):
        done = 0
        for batch, texts in chunks(batches):
            flat, count = encoder(path).encode(texts, end_id)
            raw = memoryview(flat.astype("<u4")).cast("B")
            base = np.cumsum(count) - count
            whole = count // window
            parts = whole + (count % window > 0)
            doc = np.repeat(np.arange(len(texts)), parts)
            start = (np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)) * window
            length = np.minimum(window, count[doc] - start)
            at = base[doc] + start
            crcs = []
            for a, n in zip(at.tolist(), length.tolist()):
                step = n if n == window else BLOCK
                crcs.append([zlib.crc32(raw[4 * x : 4 * min(x + step, a + n)]) for x in range(a, a + n, step)])
            first = np.array([c[0] for c in crcs], np.uint64)
            spread = mix(mix(doc.astype(np.uint64) + np.uint64(done)) ^ mix(start.astype(np.uint64) << np.uint64(20)) ^ first)
            done += len(texts)
            columns = [batch.column("doc_id").take(pa.array(doc)), pa.array(start), pa.array(length), pa.array(count[doc]), pa.array(crcs, pa.list_(pa.int64())), pa.array(spread.view(np.int64))]
            names = ["doc_id", "start", "length", "doc_tokens", "crcs", "spread"]
            if keep_ids:
                columns.append(pa.array([flat[a : a + n].astype(np.int32) for a, n in zip(at.tolist(), length.tolist())], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, start long, length long, doc_tokens long, crcs array<long>, spread long" + (", ids array<int>" if keep_ids else "")
    return map_arrow(rows, run, schema)


def difference(sizes: np.ndarray, ways: int) -> np.ndarray:
    """The window (0 to ways - 1) of each piece, by merging the two partial partitions of widest spread until one is left.

    A partial partition is its sums in falling order, without zeros and less the smallest if all windows have one; each sum has a node, whose
    children are the sums it was made of."""
    n = len(sizes)
    if n <= ways:
        return np.arange(n)
    sums_of: dict[int, np.ndarray] = {i: sizes[i : i + 1] for i in range(n)}
    nodes_of: dict[int, np.ndarray] = {i: np.array([i]) for i in range(n)}
    heap = [(-int(s), i) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    made, total, grown = [], n, n
    while len(heap) > 1:
        (_, a), (_, b) = heapq.heappop(heap), heapq.heappop(heap)
        x, y, p, q = sums_of.pop(a), sums_of.pop(b), nodes_of.pop(a), nodes_of.pop(b)
        shared = len(x) + len(y) - ways
        if shared <= 0:
            value, node = np.concatenate([x, y]), np.concatenate([p, q])
        else:
            # The smallest sums of the first lie on the largest of the second, in opposite order.
            y, q = y[::-1], q[::-1]
            alone = len(x) - shared
            fresh = np.arange(total, total + shared)
            made.append((fresh, p[alone:], q[len(q) - len(y) : shared]))
            total += shared
            value = np.concatenate([x[:alone], x[alone:] + y[:shared], y[shared:]])
            node = np.concatenate([p[:alone], fresh, q[shared:]])
        order = np.argsort(-value, kind="stable")
        value, node = value[order], node[order]
        if len(value) == ways:
            value = value - value[-1]
        grown += 1
        sums_of[grown], nodes_of[grown] = value, node
        heapq.heappush(heap, (-int(value[0] - (value[-1] if len(value) == ways else 0)), grown))
    at = np.zeros(total, np.int64)
    (last,) = nodes_of.values()
    at[last] = np.arange(len(last))
    for fresh, left, right in reversed(made):
        at[left] = at[fresh]
        at[right] = at[fresh]
    return at[:n]


def strung(sizes: np.ndarray) -> np.ndarray:
    """For each piece its bundle: crumbs are strung together to at least CRUMB tokens, other pieces stand alone."""
    small = np.flatnonzero(sizes < CRUMB)
    bundle = np.zeros(len(sizes), np.int64)
    large = np.flatnonzero(sizes >= CRUMB)
    bundle[large] = np.arange(len(large))
    if small.size:
        bundle[small] = len(large) + (np.cumsum(sizes[small]) - sizes[small]) // CRUMB
    return np.unique(bundle, return_inverse=True)[1]


def fill(sizes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of which piece each part is, its start in it, its length and its window, with no window over the capacity."""
    limit = window
    while True:
        # Equal parts of whole blocks, none over the limit.
        step = -(-np.maximum(sizes, 1) // -(-sizes // limit))
        step = np.where(sizes > limit, np.minimum(-(-step // BLOCK) * BLOCK, limit), np.maximum(sizes, 1))
        n = -(-sizes // step)
        of = np.repeat(np.arange(len(sizes)), n)
        start = (np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)) * step[of]
        length = np.minimum(step[of], sizes[of] - start)
        bundle = strung(length)
        total = np.bincount(bundle, weights=length).astype(np.int64)
        least = ways = max(1, -(-int(total.sum()) // window))
        while ways <= least + max(1, int(least * PADDING)) or limit // 2 < BLOCK:
            at = difference(total, ways)
            load = np.bincount(at, weights=total, minlength=ways)
            if load.max() <= window:
                return of, start, length, at[bundle]
            over = load.max() - total.sum() / ways
            ways = max(ways + 1, -(-int(total.sum()) // max(int(window - over), 1)) if over < window else ways + 1)
        limit //= 2


def pack(docs: DataFrame, path: str, window: int = 4096, end_id: int = 2, keep_ids: bool = False, purpose: str = "packing") -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, with ``keep_ids``, the ids of every piece.

    ``path`` is a vocabulary file that every executor has in the same place (part of an installed package). ``window`` is a
    multiple of BLOCK."""
    if window % BLOCK:
        raise ValueError(f"window must be a multiple of {BLOCK}")
    parts = stage(pieces(docs, path, window, end_id, keep_ids), purpose)
    tokens = parts.agg(F.sum("length")).first()[0] or 0
    shards = max(1, round(tokens / (SHARD * window)))

    def run(rows: pa.Table) -> pa.Table:
        shard = rows.column("shard")[0].as_py()
        rows = rows.combine_chunks()
        sizes = rows.column("length").to_numpy()
        whole, rest = np.flatnonzero(sizes == window), np.flatnonzero(sizes < window)
        of, start, length, at = fill(sizes[rest], window) if rest.size else (np.zeros(0, np.int64),) * 4
        used = int(at.max()) + 1 if at.size else 0
        source = np.concatenate([rest[of], whole])
        start = np.concatenate([start, np.zeros(len(whole), np.int64)])
        length = np.concatenate([length, np.full(len(whole), window)])
        at = np.concatenate([at, used + np.arange(len(whole))])
        lists = rows.column("crcs").chunk(0) if rows.num_rows else pa.array([], pa.list_(pa.int64()))
        bounds, values = lists.offsets.to_numpy(), lists.values.to_numpy().astype(np.uint32)
        block = bounds[source] + start // BLOCK
        crc, left = values[block], length - BLOCK
        left[length == window] = 0
        while (on := np.flatnonzero(left > 0)).size:
            block[on] += 1
            crc[on] = joined(crc[on], values[block[on]], 4 * np.minimum(left[on], BLOCK))
            left[on] -= BLOCK
        order = np.argsort(at, kind="stable")
        source, start, length, at, crc = (x[order] for x in (source, start, length, at, crc))
        run_of = np.cumsum(length) - length
        first = np.concatenate([[True], at[1:] != at[:-1]])
        offset = run_of - run_of[np.flatnonzero(first)][np.cumsum(first) - 1]
        taken = rows.take(pa.array(source))
        columns = {
            "doc_id": taken.column("doc_id"), "start": pa.array(taken.column("start").to_numpy() + start), "length": pa.array(length), "ids_crc32": pa.array(crc.astype(np.int64)),
            "doc_tokens": taken.column("doc_tokens"), "sequence_id": pa.array((shard << 32) + at), "offset": pa.array(offset),
        }
        if keep_ids:
            columns["ids"] = pa.array([x[a : a + n] for x, a, n in zip(taken.column("ids").to_pylist(), start.tolist(), length.tolist())], pa.list_(pa.int32()))
        return pa.table(columns)

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + (", ids array<int>" if keep_ids else "")
    return parts.withColumn("shard", F.pmod("spread", F.lit(shards))).drop("spread").groupBy("shard").applyInArrow(run, schema)
