"""Spelling variants of a corpus's words, found by PartEnum signatures of their letters.

A word's letters are a multiset, written as a binary vector with one place for each letter and occurrence number. One replaced
code point moves two places at most, one inserted or deleted code point exactly one. PartEnum deals the places to parts and
enumerates which parts are left out: words of equal length agree on some ``PARTS - 2`` of the parts, words whose
lengths differ by one on some ``FEW - 1``. Each choice of parts, with the length, is an exact signature; words that share one are
candidates and verified letter by letter. In a group only words whose first or last halves are equal are paired, since one
edit leaves one of them whole, so a group costs about its size. Groups over ``GROUP`` words go on, whole, to keys of the word with one code point left
out and its place: such a key has at most as many words as the alphabet has letters.

A word's form is its near word of largest count (ties: smallest in code-point order) if that is at least ``ratio`` times its own; the
root follows the forms to the last. Counts at least double on the way, so that ends within 63 steps, taken two, four, eight at a time.

Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF with A-Z lower-cased. With ``noise`` a run whose crc32 with its doc_id is
divisible by it loses one code point, which plants known variants.

Defined results: NULL and empty texts have no words. Repeated rows and rows with equal doc_id all count. Rows with a NULL doc_id count
unchanged, without planted variants. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, map_arrow, stage
from .position_crc import ahead, crc_spans
from .words import mix

#: Parts for words of equal length (two are left out) and for those whose lengths differ by one (one is left out).
PARTS, FEW = 5, 2
#: Words of a signature that are compared at once.
GROUP = 50_000
#: Rows that are compared at once, pairs that are looked at at once, and code points of a block of words.
ROWS, PAIRS, CELLS = 200_000, 1 << 18, 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ASCII = np.zeros(256, bool)
_ASCII[97:123] = True
_CHOICES = [(p, 0) for p in combinations(range(PARTS), PARTS - 2)] + [(p, 1) for p in combinations(range(FEW), FEW - 1)]


def text_words(texts: list[bytes], ids: list[int | None], least: int, noise: int) -> tuple[list[bytes], np.ndarray]:
    """The distinct words of the texts with at least ``least`` code points, and how often each occurs."""
    buf = _LOWER[np.frombuffer(b"\n".join([b"", *texts, b""]), np.uint8)]
    lead = (buf == 0xC3) & np.append((buf[1:] & 0xC0) == 0x80, False)
    inside = _ASCII[buf] | lead
    inside[1:] |= lead[:-1]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    start, end = edges[0::2], edges[1::2]
    points = np.concatenate([[0], np.cumsum(~lead, dtype=np.int32)])
    size = points[end] - points[start]
    long = size >= least
    start, end, size = start[long], end[long], size[long]
    doc = np.searchsorted(np.cumsum(np.fromiter((len(x) + 1 for x in texts), np.int64, len(texts))), start, "left")
    raw = buf.tobytes()
    hit = np.zeros(len(start), bool)
    if noise and len(start):
        crc = crc_spans(buf, start, end)
        # The id and a colon in front: their state counts as four bytes ahead of the word, beyond which words of over 64 bytes go alone.
        state = np.array([0 if i is None else zlib.crc32(f"{i}:".encode()) for i in ids], np.uint32)[doc]
        known = np.array([i is not None for i in ids])[doc]
        short = np.flatnonzero((end - start <= 64) & known)
        width = (end - start)[short]
        own = ahead(np.full(len(short), 0xFFFFFFFF, np.uint32), width)
        crc[short] ^= own ^ ahead(state[short] ^ np.uint32(0xFFFFFFFF), width)
        for i in np.flatnonzero((end - start > 64) & known).tolist():
            crc[i] = zlib.crc32(raw[start[i] : end[i]], int(state[i]))
        hit = (crc % np.uint32(noise) == 0) & known
    words: dict[bytes, int] = {}
    plain = np.flatnonzero(~hit)
    for a, b in zip(start[plain].tolist(), end[plain].tolist()):
        w = raw[a:b]
        words[w] = words.get(w, 0) + 1
    for i in np.flatnonzero(hit & (size > least)).tolist():
        w = raw[start[i] : end[i]].decode("utf-8")
        at = int(crc[i]) % len(w)
        w = (w[:at] + w[at + 1 :]).encode()
        words[w] = words.get(w, 0) + 1
    return [*words], np.fromiter(words.values(), np.int64, len(words))


def vocabulary(docs: DataFrame, least: int, occurrences: int, noise: int) -> DataFrame:
    """word and n of the words of at least ``least`` code points and ``occurrences`` occurrences; every batch counts its own first."""

    def run(batches):
        for batch, texts in chunks(batches):
            ids = batch.column("doc_id").to_pylist()
            words, n = text_words(texts, ids, least, noise)
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()).cast(pa.string()), pa.array(n)], ["word", "n"])

    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_arrow(rows, run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= occurrences)


def _blocks(words: list[str]):
    """Indices of words of one length and their code points as a matrix, at most CELLS of them at once (or one word)."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(size, kind="stable")
    at = 0
    while at < len(order):
        n = int(size[order[at]])
        stop = min(int(np.searchsorted(size[order], n, "right")), at + max(1, CELLS // max(n, 1)))
        mine = order[at:stop]
        flat = np.frombuffer("".join([words[i] for i in mine]).encode("utf-32-le"), np.uint32)
        yield mine, flat.reshape(len(mine), n)
        at = stop


def _hash_rows(cells: np.ndarray) -> np.ndarray:
    out = np.full(len(cells), cells.shape[1] + 1, np.uint64)
    for column in cells.T:
        out = mix(out * np.uint64(3) + column.astype(np.uint64))
    return out


def signatures(cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of words of one length: the signatures for equal lengths, then as the shorter and as the longer one of a pair (a row for each word), and their choice of parts."""
    n = cells.shape[1]
    letters = np.sort(cells, axis=1)
    new = np.ones(letters.shape, bool)
    new[:, 1:] = letters[:, 1:] != letters[:, :-1]
    place = np.arange(n)
    occurrence = place - np.maximum.accumulate(np.where(new, place, 0), axis=1)
    vector = mix(letters.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + occurrence.astype(np.uint64))
    kinds = []
    for parts in (PARTS, FEW):
        part = (letters.astype(np.int64) + 2 * occurrence) % parts
        kinds.append([np.where(part == p, vector, np.uint64(0)).sum(axis=1, dtype=np.uint64) for p in range(parts)])
    keys, numbers = [], []
    for number, (chosen, kind) in enumerate(_CHOICES):
        total = mix(sum((kinds[kind][p] * np.uint64(2 * i + 3) for i, p in enumerate(chosen)), np.zeros(len(cells), np.uint64)))
        for length in (n, n - 1) if kind else (n,):
            keys.append(mix(total ^ mix(np.full(1, length * 64 + number + 1, np.uint64))))
            numbers.append(number)
    return np.stack(keys, 1), np.array(numbers, np.int64)


def halves(cells: np.ndarray, shorter: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the first and of the last code points that one edit of a pair, whose shorter word has ``shorter``, cannot both touch."""
    first = shorter // 2
    return _hash_rows(cells[:, :first]), _hash_rows(cells[:, cells.shape[1] - (shorter - first) :])


def keyed(words: DataFrame) -> DataFrame:
    """sig, choice, word, n, first and last (hashes of its halves) for each signature of each word."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            words = batch.column("word").to_pylist()
            for mine, cells in _blocks(words):
                size = cells.shape[1]
                keys, numbers = signatures(cells)
                same, longer = halves(cells, size), halves(cells, size - 1)
                place = np.tile(mine, keys.shape[1])
                as_longer = np.zeros(keys.shape[1], bool)
                as_longer[[i for i in range(1, len(numbers)) if numbers[i] == numbers[i - 1]]] = True
                first = np.where(as_longer[:, None], longer[0], same[0]).ravel()
                last = np.where(as_longer[:, None], longer[1], same[1]).ravel()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.T.ravel().view(np.int64)), pa.array(np.repeat(numbers, len(mine)).astype(np.int8)), batch.column("word").take(pa.array(place)), batch.column("n").take(pa.array(place)), pa.array((first >> np.uint64(32)).astype(np.uint32).view(np.int32)), pa.array((last >> np.uint64(32)).astype(np.uint32).view(np.int32))],
                    ["sig", "choice", "word", "n", "first", "last"],
                )

    return map_arrow(words, run, "sig long, choice byte, word string, n long, first int, last int")


def one_edit(words: list[str], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs (indices) of words differ by exactly one inserted, deleted or replaced code point."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    short, long = np.where(size[a] <= size[b], a, b), np.where(size[a] <= size[b], b, a)
    out = np.zeros(len(a), bool)
    groups = np.unique(np.stack([size[short], size[long]], 1), axis=0) if len(a) else []
    for n, m in groups:
        if m - n > 1:
            continue
        mine = np.flatnonzero((size[short] == n) & (size[long] == m))
        step = max(1, CELLS // max(int(m), 1))
        for i in range(0, len(mine), step):
            at = mine[i : i + step]
            x = np.frombuffer("".join([words[k] for k in short[at]]).encode("utf-32-le"), np.uint32).reshape(len(at), n)
            y = np.frombuffer("".join([words[k] for k in long[at]]).encode("utf-32-le"), np.uint32).reshape(len(at), m)
            if n == m:
                out[at] = (x != y).sum(1) == 1
            else:
                front = np.logical_and.accumulate(x == y[:, :n], axis=1).sum(1)
                back = np.logical_and.accumulate((x == y[:, 1:])[:, ::-1], axis=1).sum(1)
                out[at] = front + back >= n
    return out


def runs_to_pairs(order: np.ndarray, new: np.ndarray):
    """Index pairs (earlier, later) within runs of ``order``, at most about PAIRS at once; new marks the start of each run."""
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(order)))
    end = np.repeat(first + count, count)
    partners = end - np.arange(len(order)) - 1
    total = np.cumsum(partners)
    at = 0
    while at < len(order):
        stop = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + PAIRS, "right")))
        n = partners[at:stop]
        x = np.repeat(np.arange(at, stop), n)
        y = x + 1 + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        yield order[x], order[y]
        at = stop


def near_pairs(sig: np.ndarray, choice: np.ndarray, first: np.ndarray, last: np.ndarray, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the near pairs that share a signature, each pair at the first choice of parts it agrees on only."""
    found = [], []
    for other, half in ((None, first), (first, last)):
        order = np.lexsort((half, sig))
        new = np.ones(len(order), bool)
        new[1:] = (sig[order][1:] != sig[order][:-1]) | (half[order][1:] != half[order][:-1])
        for a, b in runs_to_pairs(order, new):
            if other is not None:
                apart = other[a] != other[b]
                a, b = a[apart], b[apart]
            if not len(a):
                continue
            fine = one_edit(words, a, b)
            found[0].append(a[fine])
            found[1].append(b[fine])
    a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in found)
    if not len(a):
        return a, b
    used, back = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = back[: len(a)], back[len(a) :]
    keys = np.zeros((len(used), len(_CHOICES) + FEW), np.uint64)
    size = np.zeros(len(used), np.int64)
    for mine, cells in _blocks([words[i] for i in used]):
        keys[mine], numbers = signatures(cells)
        size[mine] = cells.shape[1]
    same = keys[left] == keys[right]
    # Of the two signatures of a choice for unequal lengths, the shorter word's first meets the longer word's second.
    for i in range(1, len(numbers)):
        if numbers[i] == numbers[i - 1]:
            up, down = size[left] < size[right], size[left] > size[right]
            met = (up & (keys[left, i - 1] == keys[right, i])) | (down & (keys[left, i] == keys[right, i - 1]))
            same[:, i - 1 : i + 1] = met[:, None]
    mine = numbers[np.argmax(same, axis=1)] == choice[a]
    return a[mine], b[mine]


def links(rows: DataFrame, group: int = GROUP) -> DataFrame:
    """Near pairs (word, n, near, near_n) both ways from sorted signature rows, and the words of groups over ``group`` (near is NULL)."""
    names = ["word", "n", "near", "near_n"]

    def compare(held: pa.Table):
        sig, choice = held.column("sig").to_numpy(), held.column("choice").to_numpy()
        words, n = held.column("word").to_pylist(), held.column("n").to_numpy()
        a, b = near_pairs(sig, choice, held.column("first").to_numpy(), held.column("last").to_numpy(), words)
        x, y = pa.array(np.concatenate([a, b])), pa.array(np.concatenate([b, a]))
        word = held.column("word").combine_chunks()
        return pa.RecordBatch.from_arrays([word.take(x), pa.array(n[x]), word.take(y), pa.array(n[y])], names)

    def spill(held: pa.Table):
        return pa.RecordBatch.from_arrays([held.column("word").combine_chunks(), held.column("n").combine_chunks(), pa.nulls(held.num_rows, pa.string()), pa.nulls(held.num_rows, pa.int64())], names)

    def run(batches):
        held, size, over = [], 0, None
        for batch in batches:
            while batch.num_rows:
                sig = batch.column("sig").to_numpy()
                if over is not None:  # the rest of a group that went over
                    stop = int(np.searchsorted(sig != over, True)) if sig[-1] != over else len(sig)
                    yield spill(pa.Table.from_batches([batch.slice(0, stop)]))
                    batch, over = batch.slice(stop), over if stop == len(sig) else None
                    continue
                held.append(batch)
                size += batch.num_rows
                batch = batch.slice(0, 0)
                if size < ROWS:
                    continue
                whole = pa.Table.from_batches(held)
                sig = whole.column("sig").to_numpy()
                cut = int(np.searchsorted(sig != sig[-1], False)) if sig[0] == sig[-1] else int(np.flatnonzero(sig != sig[-1])[-1]) + 1
                # Whole groups but for the last one, which may go on in the next batch.
                if cut:
                    yield compare_large(whole.slice(0, cut))
                rest = whole.slice(cut)
                if rest.num_rows > group:
                    over = int(sig[-1])
                    yield spill(rest)
                    held, size = [], 0
                else:
                    held, size = rest.to_batches(), rest.num_rows
        if held:
            yield compare_large(pa.Table.from_batches(held))

    def compare_large(whole: pa.Table):
        """Groups over ``group`` are passed on, the others compared."""
        sig = whole.column("sig").to_numpy()
        edges = np.flatnonzero(np.append(True, sig[1:] != sig[:-1]))
        count = np.diff(np.append(edges, len(sig)))
        if count.max() <= group:
            return compare(whole)
        large = np.repeat(count > group, count)
        some = compare(whole.filter(pa.array(~large)))
        return pa.Table.from_batches([some, spill(whole.filter(pa.array(large)))]).combine_chunks().to_batches()[0]

    return map_arrow(rows, run, "word string, n long, near string, near_n long")


def left_out(words: DataFrame) -> DataFrame:
    """Near pairs both ways of words by keys of the word with one code point left out: the place too for words of equal length."""

    def run(batches):
        for batch in batches:
            for mine, cells in _blocks(batch.column("word").to_pylist()) if batch.num_rows else ():
                place = pa.array(mine)
                word, n = batch.column("word").take(place), batch.column("n").take(place)
                size = cells.shape[1]
                for i in range(size + 1):
                    rest = _hash_rows(np.delete(cells, i, axis=1) if i < size else cells)
                    for tag in (i + 1, 0) if i < size else (0,):
                        yield pa.RecordBatch.from_arrays([pa.array(mix(rest ^ mix(np.full(1, tag + 1, np.uint64))).view(np.int64)), word, n], ["sig", "word", "n"])

    keys = map_arrow(words, run, "sig long, word string, n long").distinct()
    names = ["word", "n", "near", "near_n"]

    def compare(rows: pa.Table) -> pa.Table:
        words, n = rows.column("word").to_pylist(), rows.column("n").to_numpy()
        order = np.arange(len(words))
        new = np.zeros(len(words), bool)
        new[:1] = True
        got = [(a[fine], b[fine]) for a, b in runs_to_pairs(order, new) if (fine := one_edit(words, a, b)).any()]
        a, b = (np.concatenate([g[k] for g in got]) if got else np.zeros(0, np.int64) for k in (0, 1))
        x, y = pa.array(np.concatenate([a, b])), pa.array(np.concatenate([b, a]))
        word = rows.column("word").combine_chunks()
        return pa.table([word.take(x), pa.array(n[x]), word.take(y), pa.array(n[y])], names)

    return keys.groupBy("sig").applyInArrow(compare, "word string, n long, near string, near_n long").distinct()


def variants(docs: DataFrame, least: int = 5, occurrences: int = 3, ratio: int = 2, noise: int = 0, purpose: str = "spelling", group: int = GROUP) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word."""
    words = stage(vocabulary(docs, least, occurrences, noise), f"{purpose}-words")
    found = stage(links(keyed(words).repartition("sig").sortWithinPartitions("sig"), group), f"{purpose}-links")
    large = found.where("near is null").select("word", "n").distinct()
    pairs = found.where("near is not null")
    if not large.isEmpty():
        # A pair may also have been met in a smaller group.
        pairs = pairs.union(left_out(large)).distinct()
    best = pairs.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))).alias("best"))
    known = words.join(best, "word", "left")
    form = F.when(-F.col("best.less") >= F.lit(ratio) * F.col("n"), F.col("best.near"))
    known = stage(known.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), form.alias("form"), F.when(form.isNotNull(), -F.col("best.less")).alias("form_n")), f"{purpose}-forms")
    step = known.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        further = stage(step.join(step.select(F.col("word").alias("root"), F.col("root").alias("next")), "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), f"{purpose}-roots")
        if further.where("moved").isEmpty():
            break
        step = further.select("word", "root")
    return known.join(step, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
