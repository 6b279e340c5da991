"""Removal of repeated and nearly repeated lines over a whole corpus.

A line is normalised: lower case, digits as 0, ASCII punctuation as space, white space joined. Equal normalised lines are one
class, however short. Two classes are linked if the edit similarity (1 - edit distance / longer length, in characters of the
normalised lines) is at least ``SIMILARITY``. Of each connected group the occurrence with the smallest (doc_id, line number)
stays and all others go. Lines without a letter or digit always stay.

Candidates are lines that share a key and whose sizes allow a link. Lines of at most ``EXACT`` characters have keys that miss nothing: the shorter line of a
pair is cut into one piece more than the edits allowed, so a piece is whole in the longer one, near its place. Longer
lines have ``BANDS`` MinHash keys of ``ROWS`` minima over runs of ``GRAM`` characters; README has the measured recall. With such a key go the
places of its minima: lines that share it are a pair only if the edits allowed can have moved the runs from their places in one line to those in the other.

``short`` is for callers only: lines under so many words are then compared within their document.

Defined results: NULL and empty texts come back as they are, with no line removed. Documents with NULL doc_id are not
compared and stay whole. Rows that share a doc_id are one document: what goes from one row goes from all. One row is returned for each row.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator
from functools import lru_cache
from hashlib import blake2b
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BATCH_ROWS, CHUNK_BYTES, chunks, map_arrow, stage
from .components import components, meetings
from .words import _power, mix, range_hash

SHORT = 0  # no line is compared within its document only
LONG = 0  # lines of any number of words are compared by similarity
RADIUS = 64  # SimHashes do not bound what is linked
BLOCKS = (13, 13, 13, 13, 12)
SIMILARITY = 0.9
EXACT = 49
GRAM, ROWS, BANDS = 6, 3, 12
BLOCK = 512  # lines of a block that is compared in place
TABLE = 4096  # characters of lines whose distance tables are filled together
ANCHOR = 8  # characters of a run that is looked for in the other line
TRIGRAMS = 1024  # classes of hashed trigrams that are counted
PARTS = 12  # bits of a key that name its part of the key range
PACK = 1 << 18  # keys of a task that are packed at once
KEYED = 1 << 19  # bytes of text whose keys are made at once
PAIRS = 1 << 17  # pairs whose sizes and places are compared at once
CACHED = 1 << 16  # characters of lines whose runs are hashed at once

_NORMAL = np.arange(256, dtype=np.uint8)
_NORMAL[:48] = _NORMAL[58:65] = _NORMAL[91:97] = _NORMAL[123:128] = 32
_NORMAL[10] = 10
_NORMAL[48:58] = 48
_NORMAL[65:91] += 32
_TABLE = _NORMAL.tobytes()
_MINIMA = mix(np.arange(1, ROWS * BANDS + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)).astype(np.uint32) | np.uint32(1)
ANYWHERE = sum(255 << 8 * (ROWS + row) for row in range(ROWS))  # spots of a key that does not tell its place
_POINTS = mix(np.arange(1, 1 << 16, dtype=np.uint64))
_SPREAD = np.array([sum(1 << (8 * k) for k in range(8) if b >> k & 1) for b in range(256)], np.uint64)


def normalise(text: bytes) -> bytes:
    """Line breaks stay, so line numbers do."""
    return (text if text.isascii() else text.decode("utf-8").lower().encode("utf-8")).translate(_TABLE)


def simhashes(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For each range of word hashes the bits that more than half of them have."""
    count = np.diff(bounds)
    # Eight counters of one byte in a word, so at most 255 words are added at once.
    cuts = np.unique(np.concatenate([bounds[:-1], *(bounds[:-1][count > k] + k for k in range(255, int(count.max(initial=0)), 255))]))
    lanes = np.add.reduceat(_SPREAD[hashes.view(np.uint8).reshape(-1, 8)], cuts, axis=0).view(np.uint8).reshape(-1, 64)
    at = np.searchsorted(cuts, bounds[:-1])
    total = lanes if len(cuts) == len(count) else np.add.reduceat(lanes, at, axis=0, dtype=np.int64)
    return np.packbits(total.astype(np.int64) * 2 > count[:, None], axis=1, bitorder="little").view(np.uint64).ravel()


def allowed(size: int, similarity: float) -> int:
    """Edits allowed between a line of ``size`` characters and one that is not longer."""
    return int(size * (1 - similarity) + 1e-9)


@lru_cache(maxsize=None)
def pieces(size: int, similarity: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """start, end and tag of the pieces that a line of ``size`` characters has as the shorter and as the longer one of a pair.

    The shorter line has one piece for each (edits, its length, number). In the longer one piece ``i`` is looked for where at most
    ``i`` edits before it and ``edits - i`` after it can have moved it: one of the pieces must stand so.
    """
    found = set()

    def cuts(length, edits):
        small, wide = divmod(length, edits + 1)
        at = 0
        for i in range(edits + 1):
            n = small + (i > edits - wide)
            yield i, at, n, (edits * 4096 + length) * 4096 + i
            at += n

    longer = [m for m in range(size, EXACT + 1) if m - allowed(m, similarity) <= size]
    for edits in {allowed(m, similarity) for m in longer} - {0}:
        found |= {(at, at + n, tag) for _, at, n, tag in cuts(size, edits)}
    edits = allowed(size, similarity)
    for length in range(size - edits, size + 1) if edits else ():
        moved = size - length
        for i, at, n, tag in cuts(length, edits):
            first, last = max(at - i, at + moved - edits + i, 0), min(at + i, at + moved + edits - i, size - n)
            found |= {(x, x + n, tag) for x in range(first, last + 1)}
    start, end, tag = np.array(sorted(found), np.int64).reshape(-1, 3).T
    return start, end, tag


def point_hashes(points: np.ndarray) -> np.ndarray:
    """A hash of each code point; those of the basic plane are looked up."""
    if points.max(initial=0) < len(_POINTS):
        return _POINTS[points]
    return mix(points.astype(np.uint64) + np.uint64(1))


def least_runs(gram: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least value of the runs that begin in each range, by each of the ``ROWS * BANDS`` factors; its low byte is the place (in
    256 parts of the range) where the run stands first, in the second table the place from the end where it stands last.
    """
    first, last = (np.empty((len(_MINIMA), len(start)), np.uint32) for _ in range(2))
    cut = 0
    while cut < len(start):  # some lines at a time, so that the values stay in the cache
        stop = max(int(np.searchsorted(end, start[cut] + CACHED)), cut + 1)
        low, high = start[cut], end[stop - 1]
        count = (end - start)[cut:stop]
        bounds = np.stack([start[cut:stop], end[cut:stop]], 1).ravel() - low
        bounds = bounds[:-1]  # the last range ends with the values
        place = np.zeros(high - low, np.uint32)
        inside = np.repeat(start[cut:stop] - low - np.cumsum(count) + count, count) + np.arange(count.sum())
        place[inside] = (inside - np.repeat(start[cut:stop] - low, count)) * 256 // np.repeat(count, count)
        some, value = gram[low:high], np.empty(high - low, np.uint32)
        for k, factor in enumerate(_MINIMA):
            np.bitwise_and(np.multiply(some, factor, out=value), np.uint32(0xFFFFFF00), out=value)
            first[k, cut:stop] = np.minimum.reduceat(np.bitwise_or(value, place, out=value), bounds)[::2]
            last[k, cut:stop] = np.minimum.reduceat(np.bitwise_xor(value, np.uint32(255), out=value), bounds)[::2]
        cut = stop
    return first, last


def line_keys(lines: list[bytes], similarity: float, pairs: bool = True) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Characters of each normalised line, the parity of its hashed character pairs (0 without ``pairs``), and its keys. No line is empty."""
    return placed_keys(lines, similarity, pairs)[:3]


def placed_keys(lines: list[bytes], similarity: float, pairs: bool = True) -> tuple[np.ndarray, np.ndarray, pa.Array, pa.Array]:
    """``line_keys``, and the spots of each key: for each minimum a byte with the place (in 256 parts of the line) where its run stands
    first, then for each a byte with the parts from there to where it stands last. Keys of pieces have their place in them; their spots are anywhere."""
    points = np.frombuffer((b"\n".join(lines) + b"\n").decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    end = np.flatnonzero(points == 10)
    start = np.concatenate([[0], end[:-1] + 1])
    size = end - start
    prefix = np.zeros(len(points) + GRAM + 1, np.uint64)
    np.cumsum(point_hashes(points) * _power("up", len(points))[: len(points)], out=prefix[1 : len(points) + 1])
    prefix[len(points) + 1 :] = prefix[len(points)]
    grams = lambda n: mix((prefix[n : n + len(points)] - prefix[: len(points)]) * _power("down", len(points))[: len(points)] + np.uint64(n))
    parity = np.zeros(len(lines), np.uint64)
    if pairs:
        pair = np.uint64(1) << (grams(2) >> np.uint64(58))
        # Ranges are every other part; a line of one character has no pair.
        parity = np.where(size > 1, np.bitwise_xor.reduceat(pair, np.stack([start, end - (size > 1)], 1).ravel())[::2], parity)
    of, keys, spots = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for n in np.unique(size[size <= EXACT]).tolist():
        mine = np.flatnonzero(size == n)
        first, last, tag = pieces(n, similarity)
        if len(tag):
            keys.append(mix(range_hash(prefix, (start[mine, None] + first).ravel(), (start[mine, None] + last).ravel()) ^ np.tile(mix(tag.astype(np.uint64)), len(mine))))
            of.append(np.repeat(mine, len(tag)))
            spots.append(np.full(len(of[-1]), ANYWHERE))
    long = np.flatnonzero((size >= GRAM) & (size >= EXACT + 1 - allowed(EXACT + 1, similarity)))
    if long.size:
        gram = (grams(GRAM) >> np.uint64(32)).astype(np.uint32)
        first, last = least_runs(gram, start[long], end[long] - GRAM + 1)
        for band in range(BANDS):
            key, spot = np.full(len(long), band + 1, np.uint64), np.zeros(len(long), np.int64)
            for row in range(ROWS):
                x, y = first[band * ROWS + row], last[band * ROWS + row]
                key = mix((key << np.uint64(1)) + (x >> np.uint32(8)))
                begin = (x & np.uint32(255)).astype(np.int64)
                spot |= begin << 8 * row | 255 - begin - (y & np.uint32(255)) << 8 * (ROWS + row)
            keys.append(key)
            of.append(long)
            spots.append(spot)
    of, keys, spots = np.concatenate(of), np.concatenate(keys), np.concatenate(spots)
    offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(lines)))]).astype(np.int32))
    order = np.argsort(of, kind="stable")
    return size, parity, pa.ListArray.from_arrays(offsets, pa.array(keys[order].view(np.int64))), pa.ListArray.from_arrays(offsets, pa.array(spots[order]))


def line_rows(similarity: float, short: int, keyed: bool) -> tuple[dict[str, str], Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]]:
    """The columns of ``line_table`` and what makes its rows of documents."""
    columns = {"doc_id": "long", "line": "int", "mark": "long"} | ({"size": "int", "keys": "array<long>", "spots": "array<long>"} if keyed else {})

    def run(batches):
        for batch, texts in chunks(batches, limit=KEYED if keyed else CHUNK_BYTES):
            doc, number, place, met, lines = [], [], [], [], []
            # Repeats within the batch share the keys of one of them.
            known: dict[bytes, int] = {}
            ids = batch.column("doc_id").to_pylist()
            for d, text in zip(ids, texts):
                for i, line in enumerate(normalise(text).split(b"\n")):
                    words = line.split()
                    if words:
                        doc.append(d)
                        number.append(i)
                        few = len(words) < short
                        line = b" ".join(words)
                        place.append(known.setdefault(b"%d\n%s" % (d, line) if few else line, len(known)))
                        if len(known) > len(met):
                            met.append(not few)
                            lines.append(line)
            if not doc:
                continue
            place = np.array(place)
            marks = np.array([int.from_bytes(blake2b(x, digest_size=8).digest(), "little") for x in known], np.uint64).view(np.int64)
            out = [pa.array(doc, pa.int64()), pa.array(number, pa.int32()), pa.array(marks[place])]
            if keyed:
                size, _, keys, spots = placed_keys(lines, similarity, pairs=False)
                once = np.zeros(len(place), bool)
                once[np.unique(place, return_index=True)[1]] = True
                held = pa.array(place, mask=~(once & np.array(met)[place]))
                out += [pa.array(size[place].astype(np.int32)), keys.take(held), spots.take(held)]
            yield pa.RecordBatch.from_arrays(out, [*columns])

    return columns, run


def compared_rows(docs: DataFrame) -> DataFrame:
    return docs.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def line_table(docs: DataFrame, similarity: float = SIMILARITY, short: int = SHORT, keyed: bool = True) -> DataFrame:
    """doc_id, line, mark of each line with a word; with ``keyed`` also its size, and the keys and spots of each mark at least once.

    Lines under ``short`` words have marks of their own document and no keys.
    """
    columns, run = line_rows(similarity, short, keyed)
    return map_arrow(compared_rows(docs), run, ", ".join(f"{c} {kind}" for c, kind in columns.items()))


def block_keys(simhash: Column) -> Column:
    """The ten keys of a SimHash: each pair of blocks with its number. ``dedup_lines`` does not use them."""
    shifts = [sum(BLOCKS[:i]) for i in range(len(BLOCKS))]
    block = [F.shiftrightunsigned(simhash, s).bitwiseAND(F.lit((1 << b) - 1)) for s, b in zip(shifts, BLOCKS)]
    pairs = combinations(range(len(BLOCKS)), 2)
    return F.array(*(F.shiftleft(block[i], 32).bitwiseOR(F.shiftleft(F.lit(n).cast("long"), 58)).bitwiseOR(block[j]) for n, (i, j) in enumerate(pairs)))


def trimmed(x: str, y: str) -> tuple[str, str]:
    """Both without their equal ends."""
    short = min(len(x), len(y))
    start, step = 0, 64
    while step:
        while start + step <= short and x[start : start + step] == y[start : start + step]:
            start += step
        step >>= 1
    x, y, short = x[start:], y[start:], short - start
    end, step = 0, 64
    while step:
        while end + step <= short and x[len(x) - end - step : len(x) - end] == y[len(y) - end - step : len(y) - end]:
            end += step
        step >>= 1
    return x[: len(x) - end], y[: len(y) - end]


def edits_at_most(x: str, y: str, most: int) -> int:
    """An upper bound of the edit distance: runs of x that stand in y near their place cut both into parts, which are changed whole."""
    x, y = trimmed(x, y)
    whole = max(len(x), len(y))
    if min(len(x), len(y)) < 2 * ANCHOR:
        return whole
    for part in (2, 4, 1):
        at = len(x) * part // 6
        found = y.find(x[at : at + ANCHOR], max(0, at - most), at + most + ANCHOR)
        if found >= 0 and at + ANCHOR <= len(x):
            left = edits_at_most(x[:at], y[:found], most)
            return min(whole, left + edits_at_most(x[at + ANCHOR :], y[found + ANCHOR :], most))
    return whole


def edit_within(x: str, y: str, most: int) -> bool:
    """Whether the edit distance is at most ``most``: if a quick upper bound does not tell, a column of the distance table is kept as bits."""
    if abs(len(x) - len(y)) > most:
        return False
    x, y = trimmed(x, y)
    if not x or not y:
        return max(len(x), len(y)) <= most
    if edits_at_most(x, y, most) <= most:
        return True
    places: dict[str, int] = {}
    for i, c in enumerate(x):
        places[c] = places.get(c, 0) | 1 << i
    full, last = (1 << len(x)) - 1, 1 << len(x) - 1
    up, down, distance = full, 0, len(x)
    for left, c in zip(range(len(y) - 1, -1, -1), y):
        same = places.get(c, 0)
        straight = (((same & up) + up) ^ up) | same | down
        rise, fall = (down | ~(straight | up)) & full, up & straight
        distance += bool(rise & last) - bool(fall & last)
        if distance - left > most:
            return False
        rise, fall = (rise << 1 | 1) & full, fall << 1 & full
        up, down = (fall | ~(same | down | rise)) & full, rise & (same | down)
    return distance <= most


def all_within(pairs: list[tuple[str, str]], most: list[int]) -> list[bool]:
    """``edit_within`` for many pairs: their distance tables are filled together, by antidiagonals of the band that ``most`` allows."""
    parts = [trimmed(x, y) for x, y in pairs]
    size = [max(len(x), len(y)) for x, y in parts]
    out, left = [False] * len(pairs), []
    for i, (x, y) in enumerate(parts):
        if size[i] <= TABLE and x and y and max(max(x), max(y)) < "\ufff0":
            if abs(len(x) - len(y)) <= most[i]:
                left.append(i)
        else:
            out[i] = edit_within(x, y, most[i])
    left.sort(key=size.__getitem__)
    for first in range(0, len(left), 128):
        some = left[first : first + 128]
        band, long, wide = max(most[i] for i in some), size[some[-1]], len(some)
        table = [np.full((long + 2 * band + 4, wide), none, np.uint16) for none in (0xFFFE, 0xFFFF)]
        limit = np.array([most[i] for i in some], np.int16)
        goal = np.array([len(parts[i][0]) - len(parts[i][1]) for i in some], np.int16)
        ends: dict[int, list[int]] = {}
        for k, i in enumerate(some):
            for side, text in zip(table, parts[i]):
                side[band + 1 : band + 1 + len(text), k] = np.frombuffer(text.encode("utf-16-le"), np.uint16)
            ends.setdefault(len(parts[i][0]) + len(parts[i][1]), []).append(k)
        # The second text stands backwards, so that an antidiagonal is a slice of both.
        x, y = table[0], table[1][::-1].copy()
        # Diagonals -band, -band + 2 ... and those between with one more on each side. Cells outside the table stay large.
        outer, inner = np.full((band + 1, wide), 16000, np.int16), np.full((band + 2, wide), 16000, np.int16)
        (inner if band % 2 else outer)[(band + band % 2) // 2] = 0
        one, unlike, beside = np.uint16(1), np.empty((band + 1, wide), np.uint16), np.empty((band + 1, wide), np.int16)
        for s in range(1, max(ends) + 1):
            between = (s + band) % 2
            low, n = between - band, band + 1 - between
            new, near = (inner[1:-1], outer) if between else (outer, inner)
            i, j = (s + low) // 2 + band, len(y) - 1 - ((s - low) // 2 + band)
            np.minimum(np.bitwise_xor(x[i : i + n], y[j : j + n], out=unlike[:n]), one, out=unlike[:n])
            np.minimum(near[:-1], near[1:], out=beside[:n])
            beside[:n] += 1
            new += unlike[:n].view(np.int16)
            np.minimum(new, beside[:n], out=new)
            for k in ends.get(s, ()):
                out[some[k]] = bool(new[(goal[k] - low) // 2, k] <= limit[k])
            if s % 64 == 0:
                # A path has a cell on one of two antidiagonals that follow one another, and still has to come to its last diagonal.
                reach = np.full(wide, 16000, np.int16)
                for held, from_ in ((outer, -band), (inner[1:-1], 1 - band)):
                    ahead = np.abs((from_ + 2 * np.arange(len(held), dtype=np.int16))[:, None] - goal)
                    reach = np.minimum(reach, (held + ahead).min(axis=0, initial=16000))
                alive = np.flatnonzero((reach <= limit) & (np.array([len(parts[i][0]) + len(parts[i][1]) for i in some]) > s))
                if not len(alive):
                    break
                if len(alive) <= 0.7 * wide:
                    some, limit, goal, wide = [some[k] for k in alive.tolist()], limit[alive], goal[alive], len(alive)
                    x, y, outer, inner = (np.ascontiguousarray(t[:, alive]) for t in (x, y, outer, inner))
                    unlike, beside = np.empty((band + 1, wide), np.uint16), np.empty((band + 1, wide), np.int16)
                    ends = {}
                    for k, i in enumerate(some):
                        ends.setdefault(len(parts[i][0]) + len(parts[i][1]), []).append(k)
    return out


def list_texts(lists: DataFrame, classes: DataFrame, docs: DataFrame, purpose: str) -> DataFrame:
    """head, node, names (its lists of at most ``BLOCK`` nodes), normal (the normalised line): the lines are read from the classes' first places."""
    wanted = lists.groupBy("head", "node").agg(F.collect_list(F.when(F.col("members") <= BLOCK, F.col("name"))).alias("names")).join(classes.select(F.col("mark").alias("node"), "first"), "node")
    places = wanted.groupBy(F.col("first.doc_id").alias("doc_id")).agg(F.collect_list(F.struct(F.col("first.line").alias("line"), "head", "node", "names")).alias("places"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(places, "doc_id").select("text", "places")

    def run(batches):
        for batch, texts in chunks(batches):
            found = []
            for text, places in zip(texts, batch.column("places").to_pylist()):
                split = normalise(text).split(b"\n")
                found += [(p["head"], p["node"], p["names"], b" ".join(split[p["line"]].split()).decode("utf-8", "replace")) for p in places if p["line"] < len(split)]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*found), (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.string()))], ["head", "node", "names", "normal"])

    # A document of several rows gives a mark several texts, of which at least one has the line.
    return stage(map_arrow(rows, run, "head long, node long, names array<long>, normal string"), f"{purpose}-texts")


def similar(pairs: DataFrame, lines: DataFrame, similarity: float) -> DataFrame:
    """The pairs of marks whose normalised lines are similar enough."""
    both = pairs.join(lines.select(F.col("mark").alias("a"), F.col("normal").alias("x")), "a").join(lines.select(F.col("mark").alias("b"), F.col("normal").alias("y")), "b")

    def verify(batches):
        for batch in batches:
            x, y = (batch.column(c).to_pylist() for c in ("x", "y"))
            at = np.arange(len(x))
            left, right, edits = within_reach(x + y, at, at + len(x), similarity)
            left, right, edits = left.tolist(), right.tolist(), edits.tolist()
            fine = [i for i, good in zip(left, all_within([(x[i], y[j - len(x)]) for i, j in zip(left, right)], edits)) if good]
            yield batch.select(["a", "b"]).take(pa.array(fine, pa.int64()))

    return map_arrow(both.select("a", "b", "x", "y"), verify, "a long, b long").distinct()


def within_reach(texts: list[str], left: np.ndarray, right: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pairs (indexes of texts) that lengths and trigrams do not rule out, and the edits allowed to each.

    One edit takes at most three trigrams from a line and adds three, so counts in ``TRIGRAMS`` classes differ by at most that either way.
    """
    size = np.array([len(t) for t in texts], np.int64)
    edits = np.floor(np.maximum(size[left], size[right]) * (1 - similarity) + 1e-9).astype(np.int64)
    fine = np.flatnonzero((np.abs(size[left] - size[right]) <= edits) & (edits > 0))
    left, right, edits = left[fine], right[fine], edits[fine]
    if not len(fine):
        return left, right, edits
    held, back = np.unique(np.concatenate([left, right]), return_inverse=True)
    points = np.frombuffer("".join([texts[i] for i in held.tolist()]).encode("utf-32-le"), np.uint32)
    line = np.repeat(np.arange(len(held)), size[held])
    inside = np.flatnonzero(line[2:] == line[:-2])
    gram = (points[:-2] * np.uint32(0x9E3779B1) ^ points[1:-1] * np.uint32(0x85EBCA77) ^ points[2:] * np.uint32(0xC2B2AE3D))[inside] * np.uint32(0x27D4EB2F) >> np.uint32(22)
    count = np.minimum(np.bincount(line[inside] * TRIGRAMS + gram, minlength=len(held) * TRIGRAMS), 32767).astype(np.int16).reshape(-1, TRIGRAMS)
    x, y = back[: len(left)], back[len(left) :]
    reach = [np.zeros(0, bool)]
    for k in range(0, len(left), 2048):
        apart = count[x[k : k + 2048]] - count[y[k : k + 2048]]
        more = np.maximum(apart, 0).sum(axis=1, dtype=np.int64)
        reach.append(np.maximum(more, more - apart.sum(axis=1, dtype=np.int64)) <= 3 * edits[k : k + 2048])
    reach = np.concatenate(reach)
    return left[reach], right[reach], edits[reach]


def joined(nodes: list[int], labels: list, texts: list[str], left: np.ndarray, right: np.ndarray, similarity: float) -> list[tuple[int, int]]:
    """Links (nodes) between rows of different labels, enough of them to connect all labels that the pairs connect."""
    root = {g: g for g in labels}

    def find(g):
        while root[g] != g:
            root[g] = g = root[root[g]]
        return g

    found, open_pairs = [], []

    def test(some):
        some = [(i, j, e) for i, j, e in some if find(labels[i]) != find(labels[j])]
        for (i, j, _), fine in zip(some, all_within([(texts[i], texts[j]) for i, j, _ in some], [e for _, _, e in some])):
            if fine:
                join(i, j)

    def join(i, j):
        a, b = find(labels[i]), find(labels[j])
        if a != b:
            root[a] = b
            found.append((nodes[i], nodes[j]))

    left, right, edits = within_reach(texts, left, right, similarity)
    for i, j, e in zip(left.tolist(), right.tolist(), edits.tolist()):
        if find(labels[i]) != find(labels[j]):
            if edits_at_most(texts[i], texts[j], e) <= e:
                join(i, j)
            else:
                open_pairs.append((i, j, e))
    for k in range(0, len(open_pairs), 2048):
        test(open_pairs[k : k + 2048])
    return found


def cell_links(rows: list[dict], similarity: float) -> list[tuple[int, int]]:
    """Links between groups of one cell, enough of them to connect all groups that its pairs connect."""
    low, high = min(r["block"] for r in rows), max(r["block"] for r in rows)
    left, right = (np.array([i for i, r in enumerate(rows) if r["block"] == b]) for b in (low, high))
    return joined([r["node"] for r in rows], [r["group"] for r in rows], [r["normal"] for r in rows], np.repeat(left, len(right)), np.tile(right, len(left)), similarity)


def links_batch(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())], ["a", "b"])


def links_between(members: DataFrame, lines: DataFrame, similarity: float) -> DataFrame:
    """Links that join different groups of one circle. Cells of two blocks are compared in place; no pair becomes a row."""
    cells = meetings(members, BLOCK).join(lines.select(F.col("mark").alias("node"), "normal"), "node")
    cells = cells.select("head", "x", "y", "block", "node", "group", "normal")
    cells = spread(cells, "head", "x", "y").sortWithinPartitions("head", "x", "y")

    def run(batches):
        rows, cell = [], None
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                mine = row["head"], row["x"], row["y"]
                if mine != cell:
                    found += cell_links(rows, similarity) if rows else []
                    rows, cell = [], mine
                rows.append(row)
            yield links_batch(found)
        yield links_batch(cell_links(rows, similarity) if rows else [])

    return map_arrow(cells, run, "a long, b long")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Dealt by the keys to as many tasks as a shuffle has; these are not joined for their small size, as their rows cost more than their bytes."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def links_within(texts: DataFrame, similarity: float) -> DataFrame:
    """Links between the nodes of each list of at most ``BLOCK`` nodes (see ``list_texts``), compared in place; no pair becomes a row.

    The lists of a head are compared together, so a text comes once for all of them and a pair is tested once.
    """
    rows = spread(texts.where("size(names) > 0"), "head").sortWithinPartitions("head", "node")

    def compare(heads, nodes, names, texts):
        name = np.concatenate([np.array(x, np.int64) for x in names])
        row = np.repeat(np.arange(len(names)), [len(x) for x in names])
        order = np.lexsort((row, name))
        name, row = name[order], row[order]
        starts = np.concatenate([[0], np.flatnonzero(name[1:] != name[:-1]) + 1, [len(name)]])
        later = np.repeat(starts[1:], np.diff(starts)) - np.arange(len(name)) - 1
        left = np.repeat(np.arange(len(name)), later)
        right = left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(later) - later, later)
        pairs = np.unique(row[left] * len(names) + row[right])
        return links_batch(joined(nodes, [*zip(heads, nodes)], texts, pairs // len(names), pairs % len(names), similarity))

    def run(batches):
        held = [[], [], [], []]
        for batch in batches:
            for x, c in zip(held, ("head", "node", "names", "normal")):
                x += batch.column(c).to_pylist()
            # The last head may go on in the next batch.
            whole = bisect_left(held[0], held[0][-1]) if held[0] else 0
            if whole >= BATCH_ROWS:
                yield compare(*(x[:whole] for x in held))
                held = [x[whole:] for x in held]
        if held[0]:
            yield compare(*held)

    return map_arrow(rows, run, "a long, b long")


def can_link(size: np.ndarray, low: np.ndarray, high: np.ndarray, left: np.ndarray, right: np.ndarray, similarity: float) -> np.ndarray:
    """Whether the sizes, and the bounds of the places of the runs that both rows share, allow a link of the rows ``left`` and ``right``.

    An unchanged run with places p and q has at least |p - q| edits before it and those behind it that the sizes and p - q still ask for.
    """
    longer = size[left] - size[right]
    slack = np.floor(np.maximum(size[left], size[right]) * (1 - similarity) + 1e-9) - np.abs(longer)
    fine = np.flatnonzero(slack >= 0)
    left, right, longer, slack = left[fine], right[fine], longer[fine], slack[fine]
    before, behind = np.minimum(longer, 0), np.maximum(longer, 0)
    for row in range(ROWS):
        apart = np.maximum(low[row][left] - high[row][right] - behind, before - high[row][left] + low[row][right])
        kept = np.flatnonzero(2 * apart <= slack)
        fine, left, right, slack, before, behind = fine[kept], left[kept], right[kept], slack[kept], before[kept], behind[kept]
    return fine


def halves(rows: np.ndarray, size: np.ndarray, low: np.ndarray, high: np.ndarray, similarity: float) -> list[np.ndarray]:
    """The rows of a long list in lists of at most ``BLOCK`` rows, as far as sizes and places tell them apart; any two that can be linked have one in common."""
    if len(rows) <= BLOCK:
        return [rows]
    least = size[rows].min()
    reach = (1 - similarity) / similarity * least / max(least - GRAM, 1)  # of places, as parts of the line
    runs = np.maximum(size[rows] - GRAM + 1, 1)
    log = np.log(np.maximum(size[rows], 1))
    best = None
    for first, last, wide in [(log, log, -np.log(similarity)), *((low[row][rows] / runs, high[row][rows] / runs, reach) for row in range(ROWS))]:
        middle = np.median((first + last) / 2)
        two = rows[first <= middle + wide / 2 + 1e-6], rows[last >= middle - wide / 2 - 1e-6]
        if best is None or max(map(len, two)) < max(map(len, best)):
            best = two
    if max(map(len, best)) > 0.9 * len(rows):
        return [rows]
    return [x for half in best for x in halves(half, size, low, high, similarity)]


def related(starts: np.ndarray, rows: np.ndarray, size: np.ndarray, low: np.ndarray, high: np.ndarray, similarity: float) -> np.ndarray:
    """For each place of ``rows``, lists of at most ``BLOCK`` rows that begin at ``starts``, the first place of those that pairs that can be linked connect with it."""
    members = np.diff(np.append(starts, len(rows)))
    later = np.repeat(starts + members, members) - np.arange(len(rows)) - 1
    total = np.concatenate([[0], np.cumsum(later)])
    left, right, at = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
    while at < len(rows):
        end = max(int(np.searchsorted(total, total[at] + PAIRS, "right")) - 1, at + 1)
        x = np.repeat(np.arange(at, end), later[at:end])
        y = x + 1 + np.arange(len(x)) - (total[x] - total[at])
        fine = can_link(size, low, high, rows[x], rows[y], similarity)
        left.append(x[fine])
        right.append(y[fine])
        at = end
    left, right, label = np.concatenate(left), np.concatenate(right), np.arange(len(rows))
    while True:
        least, new = np.minimum(label[left], label[right]), label.copy()
        np.minimum.at(new, left, least)
        np.minimum.at(new, right, least)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def key_lists(lines: DataFrame, similarity: float, made: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]] | None = None) -> DataFrame:
    """name, head (the smallest node), node, members: the lists of nodes that share a key and that sizes and places (``can_link``) connect, each set of nodes once.

    The nodes of a key are put in the order of their sizes and cut where a size is too far from the next one: no pair across a cut
    is similar enough. What is left is cut into the nodes that pairs connect, long lists into shorter ones first.
    Most keys are met once, so rows travel packed, many keys of one part of the key range in a row, bytes that are mostly 0 apart.
    With ``made``, ``lines`` are the rows of which it makes lines with keys, so that keys are packed where they are made.
    """

    def pack(batches):
        keys, held = [], 0
        for batch in made(batches) if made else batches:
            batch = batch.filter(batch.column("keys").is_valid())
            lists = batch.column("keys")
            count = np.diff(lists.offsets.to_numpy())
            key = lists.flatten().to_numpy()
            spot = batch.column("spots").flatten().to_numpy() if "spots" in batch.schema.names else np.full(len(key), ANYWHERE)
            keys.append((key, np.repeat(batch.column("mark").to_numpy(), count), np.repeat(batch.column("size").to_numpy(), count), spot))
            held += len(key)
            if held >= PACK:
                yield packed(keys)
                keys, held = [], 0
        if held:
            yield packed(keys)

    def packed(keys):
        key, node, size, spot = (np.concatenate(x) for x in zip(*keys))
        part = (key.view(np.uint64) >> np.uint64(64 - PARTS)).astype(np.uint16)
        order = np.argsort(part, kind="stable")
        key, node, size, spot, part = key[order], node[order], size[order], spot[order], part[order]
        cuts = np.concatenate([[0], np.flatnonzero(part[1:] != part[:-1]) + 1, [len(part)]])
        columns = key.view(np.uint8).reshape(-1, 8)[:, :6], node, size.astype(np.int32).view(np.uint16)[::2], size.astype(np.int32).view(np.uint16)[1::2], *(spot.view(np.uint8)[k::8] for k in range(2 * ROWS))
        raw = [pa.array([b"".join(x[a:b].tobytes() for x in columns) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())], pa.binary())]
        return pa.RecordBatch.from_arrays([pa.array(part[cuts[:-1]].astype(np.int32)), *raw], ["part", "held"])

    def unpacked(raw):
        n = len(raw) // (18 + 2 * ROWS)
        at = np.cumsum([0, 6 * n, 8 * n, 2 * n, 2 * n] + [n] * (2 * ROWS)).tolist()
        key, spot = np.zeros((n, 8), np.uint8), np.zeros((n, 8), np.uint8)
        key[:, :6] = np.frombuffer(raw, np.uint8, 6 * n).reshape(-1, 6)
        for k in range(2 * ROWS):
            spot[:, k] = np.frombuffer(raw, np.uint8, n, at[4 + k])
        size = np.frombuffer(raw, np.uint16, n, at[2]) | np.frombuffer(raw, np.uint16, n, at[3]).astype(np.int64) << 16
        return key.view(np.int64).ravel(), np.frombuffer(raw, np.int64, n, at[1]), size, spot.view(np.int64).ravel()

    def gather(batches):
        held, part = [], None
        for batch in batches:
            for row in zip(batch.column("part").to_pylist(), batch.column("held").to_pylist()):
                if row[0] != part:
                    if held:
                        yield lists(held)
                    held, part = [], row[0]
                held.append(row[1])
        if held:
            yield lists(held)

    def lists(held):
        key, node, size, spot = (np.concatenate(x) for x in zip(*map(unpacked, held)))
        order = np.argsort(key)
        same = key[order[1:]] == key[order[:-1]]
        shared = order[np.concatenate([[False], same]) | np.concatenate([same, [False]])]
        key, node, size, spot = key[shared], node[shared], size[shared], spot[shared]
        order = np.lexsort((node, size, key))
        key, node, size, spot = key[order], node[order], size[order], spot[order]
        once = np.concatenate([[True], (key[1:] != key[:-1]) | (node[1:] != node[:-1])])[: len(key)]
        key, node, size, spot = key[once], node[once], size[once], spot[once]
        cut = (key[1:] != key[:-1]) | (size[1:] - size[:-1] > np.floor(size[1:] * (1 - similarity) + 1e-9))
        start = np.concatenate([[0], np.flatnonzero(cut) + 1]) if len(key) else np.zeros(0, np.int64)
        members = np.diff(np.append(start, len(key)))
        byte = lambda k: spot >> 8 * k & 255
        part = np.maximum(size - GRAM + 1, 1) / 256
        low = [byte(row) * part for row in range(ROWS)]
        high = [(byte(row) + byte(ROWS + row) + 1) * part for row in range(ROWS)]
        cells = [np.flatnonzero(np.repeat((members > 1) & (members <= BLOCK), members))]
        starts, whole = [*np.cumsum([0, *members[(members > 1) & (members <= BLOCK)]])[:-1]], []
        for k in np.flatnonzero(members > BLOCK).tolist():
            for x in halves(np.arange(start[k], start[k] + members[k]), size, low, high, similarity):
                if len(x) > BLOCK:
                    whole.append(x)
                elif len(x) > 1:
                    starts.append(sum(map(len, cells)))
                    cells.append(x)
        rows = np.concatenate(cells)
        label = related(np.array(starts, np.int64), rows, size, low, high, similarity)
        order = np.argsort(label, kind="stable")
        rows = np.concatenate([rows[order], *whole])
        label = np.concatenate([label[order], *(np.full(len(x), -1 - k) for k, x in enumerate(whole))])
        node = node[rows]
        start = np.concatenate([[0], np.flatnonzero(label[1:] != label[:-1]) + 1]) if len(label) else np.zeros(0, np.int64)
        members = np.diff(np.append(start, len(label)))
        # Lists of the same nodes have the same name.
        name = mix(np.add.reduceat(mix(node.view(np.uint64)), start) + members.astype(np.uint64)) if len(node) else np.zeros(0, np.uint64)
        many = np.repeat(members > 1, members)
        head = np.minimum.reduceat(node, start) if len(node) else node
        out = np.repeat(name.view(np.int64), members)[many], np.repeat(head, members)[many], node[many], np.repeat(members, members)[many]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in out], ["name", "head", "node", "members"])

    rows = map_arrow(lines, pack, "part int, held binary")
    return map_arrow(rows.repartition("part").sortWithinPartitions("part"), gather, "name long, head long, node long, members long").distinct()


def line_groups(classes: DataFrame, docs: DataFrame, similarity: float, purpose: str, short: int = SHORT) -> DataFrame:
    """node and root of all classes that are linked to another one.

    Lists of at most ``BLOCK`` nodes are compared whole. In a longer one every node is first tested against the smallest; only lists
    whose nodes are then still in different groups go on, to cells of two blocks. So a group of alike nodes costs its size, not
    its square, and no link that could join two groups stays untested.
    """
    lists = stage(key_lists(compared_rows(docs), similarity, line_rows(similarity, short, True)[1]), f"{purpose}-lists")
    texts = list_texts(lists, classes, docs, purpose)
    links = links_within(texts, similarity)
    large = lists.where(F.col("members") > BLOCK).select(F.col("name").alias("head"), F.col("head").alias("least"), "node")
    some = not large.isEmpty()
    if some:
        star = large.where("node <> least").select(F.col("least").alias("a"), F.col("node").alias("b")).distinct()
        texts = texts.join(large.select("node").distinct(), "node").select(F.col("node").alias("mark"), "normal").distinct()
        links = links.union(similar(star, texts, similarity))
    links = stage(links, f"{purpose}-links")
    if links.isEmpty() and not some:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    root = components(links, purpose)
    if not some:
        return root
    grouped = large.join(root.withColumnRenamed("node", "linked"), F.col("linked") == F.col("node"), "left").select("head", "node", F.coalesce("root", "node").alias("group"))
    mixed = grouped.groupBy("head").agg(F.min("group").alias("low"), F.max("group").alias("high")).where("low < high").select("head")
    rest = stage(grouped.join(mixed, "head"), f"{purpose}-mixed")
    further = stage(links_between(rest, texts, similarity), f"{purpose}-further")
    return root if further.isEmpty() else components(root.select(F.col("node").alias("a"), F.col("root").alias("b")).union(further), f"{purpose}-all")


def dedup_lines(docs: DataFrame, similarity: float = SIMILARITY, keep: tuple[str, ...] = (), purpose: str = "lines", short: int = SHORT) -> DataFrame:
    """doc_id, text without the repeated lines, n_lines, n_removed, and the columns named in ``keep``."""
    lines = stage(line_table(docs, similarity, short, keyed=False), f"{purpose}-table")
    classes = stage(lines.groupBy("mark").agg(F.count("*").alias("rows"), F.min(F.struct("doc_id", "line")).alias("first")), f"{purpose}-classes")
    root = line_groups(classes, docs, similarity, purpose, short)
    # A group's keeper is the least first occurrence of its classes, its root's own class included.
    tied = root.unionByName(root.select(F.col("root").alias("node"), "root").distinct())
    tied = classes.select("mark", "first").join(tied, F.col("mark") == F.col("node")).select("mark", "root", "first")
    tied = stage(tied.join(tied.groupBy("root").agg(F.min("first").alias("keeper")), "root").select("mark", "keeper"), f"{purpose}-tied")
    repeated = classes.where("rows > 1").join(tied, "mark", "left_anti").select("mark", F.col("first").alias("keeper")).union(tied)
    removed = lines.select("doc_id", "line", "mark").join(repeated, "mark").where("doc_id <> keeper.doc_id or line <> keeper.line").groupBy("doc_id").agg(F.collect_set("line").alias("gone"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *(F.col(c).alias(f"kept_{i}") for i, c in enumerate(keep))).join(removed, "doc_id", "left")

    def run(batches):
        for batch, texts in chunks(batches):
            null = batch.column("text").is_null().to_pylist()
            out, n, m = [], [], []
            for text, none, gone in zip(texts, null, batch.column("gone").to_pylist()):
                n.append(0 if none else text.count(b"\n") + 1)
                m.append(len(gone or ()))
                if gone:
                    drop = set(gone)
                    text = b"\n".join([x for i, x in enumerate(text.split(b"\n")) if i not in drop])
                out.append(None if none else text)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.binary()).cast(pa.string()), pa.array(n, pa.int64()), pa.array(m, pa.int64()), *(batch.column(f"kept_{i}") for i in range(len(keep)))], ["doc_id", "text", "n_lines", "n_removed", *(f"kept_{i}" for i in range(len(keep)))])

    kinds = dict(docs.dtypes)
    schema = "doc_id long, text string, n_lines long, n_removed long" + "".join(f", kept_{i} {kinds[c]}" for i, c in enumerate(keep))
    out = map_arrow(rows, run, schema)
    return out.select("doc_id", "text", "n_lines", "n_removed", *(F.col(f"kept_{i}").alias(c) for i, c in enumerate(keep)))
