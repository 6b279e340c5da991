"""BPE encoding and decoding by speculation and verification.

Greedy longest-match proposes the tokens of a word. A proposal is the true encoding when every token is its own encoding
and no two neighbours would have been merged across their border. That test looks only at the pair, so it runs on
arrays of pairs: a merge of symbol x on the right edge of the left token with symbol y on the left edge of the right one
happens exactly if its rank comes before the merges that swallow x and y inside their tokens. Words that fail go
through the merges in rank order.

Words (cut at ASCII white space, which no token spans) are encoded once per task and looked up after that. The store of
finished words is emptied when it holds ``STORE_WORDS``; results do not depend on it.

NULL and empty texts have no tokens. Rows, repeated ones too, map one to one; the text is taken whole.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, map_arrow
from .words import Lookup, Words, mix, prefix_sums, range_hash

STORE_WORDS = 500_000
STORE_BYTES = 160 << 20
#: Longer pieces go through the one-piece forms of the same steps.
LONG = 64
NEVER = np.int64(1) << 40
#: Stands for the word-end suffix after the bytes of a piece.
ENDED = 256
#: Below this code point NFC changes nothing and lower-casing is one character at a time.
PLAIN = "\u0300"
_models: dict[str, BpeModel] = {}


def _byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in shown}
    letters |= {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in letters)}
    return [letters[b] for b in range(256)]


LETTERS = _byte_letters()
BYTES = {c: b for b, c in enumerate(LETTERS)}


_VALUES = mix(np.arange(1000, 1257, dtype=np.uint64))


class BpeModel:
    """Vocabulary and merges of a byte-level tokenizers file whose words end in a suffix."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.library = Tokenizer.from_file(path)
        suffix = model["end_of_word_suffix"]
        vocab: dict[str, int] = model["vocab"]
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.special_split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        pattern = next(x["pattern"]["Regex"] for x in spec["pre_tokenizer"]["pretokenizers"] if x["type"] == "Split")
        self.pieces = regex.compile(pattern)
        n = max([*vocab.values(), *self.special.values()]) + 1
        self.text = np.full(n, None, object)
        self.codes: dict[tuple[int, ...], int] = {}
        for token, i in (vocab | self.special).items():
            self.text[i] = token
        for token, i in vocab.items():
            ended = token.endswith(suffix)
            body = token[: -len(suffix)] if ended else token
            self.codes[(*map(BYTES.get, body), *[ENDED] * ended)] = i
        self.longest = max(map(len, self.codes))
        self.single = np.array([self.codes[b,] for b in range(256)])
        self.final = np.array([self.codes[b, ENDED] for b in range(256)])
        self.left, self.right = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
        self.rank = np.full(n, -1, np.int64)
        self.merges: dict[tuple[int, int], int] = {}
        self.made = np.zeros(len(model["merges"]), np.int64)
        for rank, pair in enumerate(model["merges"]):
            a, b = (vocab[x] for x in (pair.split(" ") if isinstance(pair, str) else pair))
            self.made[rank] = whole = vocab[self.text[a] + self.text[b]]
            self.merges.setdefault((a, b), rank)
            if self.rank[whole] < 0:
                self.left[whole], self.right[whole], self.rank[whole] = a, b, rank
        pairs = np.array([(a << 20 | b, r) for (a, b), r in self.merges.items()], np.int64).reshape(-1, 2)
        self.pair_rank = Lookup(pairs[:, 0].astype(np.uint64), pairs[:, 1])
        strings = [*self.codes]
        flat, bounds = np.array([c for x in strings for c in x]), np.concatenate([[0], np.cumsum([len(x) for x in strings])])
        self.token = Lookup(range_hash(prefix_sums(flat, _VALUES), bounds[:-1], bounds[1:]), np.array([*self.codes.values()]))
        self.own = self.own_encodings(n)
        self.compatible: dict[int, bool] = {}
        self.slot: dict[int, int] = {}
        self.ids: list[bytes] = []
        self.shown: list[bytes] = []
        self.held = 0

    def forget(self, but: list[int]) -> None:
        """Empty the store but for these words."""
        kept = [(h, self.ids[s], self.shown[s]) for h in but if (s := self.slot.get(h)) is not None]
        self.slot = {h: i for i, (h, _, _) in enumerate(kept)}
        self.ids, self.shown = [i for _, i, _ in kept], [t for _, _, t in kept]
        self.held = sum(map(len, self.ids)) + sum(map(len, self.shown)) + 200 * len(kept)

    # -- proposals and their checks

    def propose(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Longest token first, from left to right, the last one with the suffix: a row of tokens for each piece (-1: none), and their number."""
        lengths = np.array([len(p) for p in pieces])
        ends = np.cumsum(lengths + 1)
        flat = np.full(ends[-1], ENDED, np.int64)
        flat[np.repeat(ends - lengths - 1, lengths) + within(lengths)] = np.frombuffer(b"".join(pieces), np.uint8)
        prefix = prefix_sums(flat, _VALUES)
        at, live, rows, count = ends - lengths - 1, np.arange(len(pieces)), [], np.zeros(len(pieces), np.int64)
        while live.size:
            token, size = np.full(len(live), -1, np.int64), np.zeros(len(live), np.int64)
            start, end = at[live], ends[live]
            rest = np.flatnonzero(end - start <= self.longest)
            token[rest] = self.token(range_hash(prefix, start[rest], end[rest]))
            size[token >= 0] = (end - start)[token >= 0]
            for length in range(min(self.longest, int((end - start).max()) - 2), 0, -1):
                open_ = np.flatnonzero((token < 0) & (end - start - 2 >= length))
                if open_.size:
                    token[open_] = self.token(range_hash(prefix, start[open_], start[open_] + length))
                    size[open_] = length
            row = np.full(len(pieces), -1, np.int64)
            row[live] = token
            rows.append(row)
            count[live] += 1
            at[live] += size
            live = live[at[live] < ends[live]]
        return np.stack(rows, 1), count

    def own_encodings(self, n: int) -> np.ndarray:
        """For each id whether its bytes encode to just that token."""
        out = np.zeros(n, bool)
        symbols_of = {i: [*x] if x[-1] != ENDED else [*x[:-2], x[-2] + ENDED] for x, i in self.codes.items() if x != (ENDED,)}
        base = np.concatenate([self.single, self.final])
        for size in sorted({len(x) for x in symbols_of.values()}):
            ids = np.array([i for i, x in symbols_of.items() if len(x) == size])
            symbols = base[np.array([x for x in symbols_of.values() if len(x) == size])]
            merged, count = self.merge(symbols, np.full(len(ids), size))
            out[ids] = (count == 1) & (merged[:, 0] == ids)
        return out

    def check(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """For each pair of neighbours: whether no merge crosses their border."""
        fine = np.ones(len(left), bool)
        x, x_until = left.copy(), np.full(len(left), NEVER)
        while (live := x >= 0).any():
            y, y_until = np.where(live, right, -1), np.full(len(left), NEVER)
            while (on := np.flatnonzero((y >= 0) & fine)).size:
                rank = self.pair_rank(x[on] << 20 | y[on])
                # The left token's merge at the same rank comes first, the right token's comes later.
                fine[on[(rank >= 0) & (rank < x_until[on]) & (rank <= y_until[on])]] = False
                y_until = np.where(y >= 0, self.rank[y], -1)
                y = np.where(y >= 0, self.left[y], -1)
            x_until = np.where(live, self.rank[x], -1)
            x = np.where(live, self.right[x], -1)
        return fine

    def merge(self, symbols: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exact encoding of many short words side by side: in each word the lowest rank first, the leftmost of equal ranks."""
        n, width = symbols.shape
        ids, at = symbols.astype(np.int64), np.arange(width)
        after = np.where(at + 1 < count[:, None], at + 1, -1)
        before = np.broadcast_to(at - 1, (n, width)).copy()
        rank = np.full((n, width), NEVER)
        r, c = np.nonzero(after >= 0)
        found = self.pair_rank(ids[r, c] << 20 | ids[r, c + 1])
        rank[r, c] = np.where(found >= 0, found, NEVER)
        gone = at >= count[:, None]
        live = np.arange(n)
        while live.size:
            p = rank[live].argmin(1)
            best = rank[live, p]
            live, p, best = live[best < NEVER], p[best < NEVER], best[best < NEVER]
            if not live.size:
                break
            j = after[live, p]
            ids[live, p] = self.made[best]
            gone[live, j] = True
            rank[live, j] = rank[live, p] = NEVER
            k = after[live, j]
            after[live, p] = k
            has = k >= 0
            before[live[has], k[has]] = p[has]
            for row, a in ((live[has], p[has]), (live[p > 0], before[live, p][p > 0])):
                has_left = a >= 0
                row, a = row[has_left], a[has_left]
                found = self.pair_rank(ids[row, a] << 20 | ids[row, after[row, a]]) if row.size else np.zeros(0, np.int64)
                ok = after[row, a] >= 0
                rank[row, a] = np.where((found >= 0) & ok, found, NEVER)
        order = np.argsort(gone, axis=1, kind="stable")
        return np.take_along_axis(ids, order, 1), width - gone.sum(1)

    def merge_long(self, piece: bytes) -> list[int]:
        """Exact encoding of one long piece, by a heap of the possible merges."""
        ids = [*self.single[[*piece[:-1]]].tolist(), int(self.final[piece[-1]])]
        n = len(ids)
        before, after, alive = list(range(-1, n - 1)), [*range(1, n), -1], [True] * n
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            if i >= 0 and (j := after[i]) >= 0 and (found := self.merges.get((ids[i], ids[j]))) is not None:
                heapq.heappush(heap, (found, i, ids[i], ids[j]))

        for i in range(n - 1):
            offer(i)
        while heap:
            best, i, a, b = heapq.heappop(heap)
            if not alive[i] or ids[i] != a or (j := after[i]) < 0 or ids[j] != b:
                continue
            ids[i] = int(self.made[best])
            alive[j] = False
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer(i)
            offer(before[i])
        return [t for t, on in zip(ids, alive) if on]

    def encode_pieces(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of each distinct piece."""
        short = [i for i, p in enumerate(pieces) if len(p) <= LONG]
        out: list[np.ndarray | None] = [None] * len(pieces)
        for i, p in enumerate(pieces):
            if len(p) > LONG:
                out[i] = np.array(self.encode_long(p), "<u4")
        if not short:
            return out
        mine = [pieces[i] for i in short]
        tokens, count = self.propose(mine)
        held = np.arange(tokens.shape[1]) < count[:, None]
        fine = (self.own[tokens] | ~held).all(1)
        r, c = np.nonzero(held[:, 1:])
        fine[r[~self.fits(tokens[r, c], tokens[r, c + 1])]] = False
        bad = np.flatnonzero(~fine)
        if bad.size:
            sizes = np.array([len(mine[i]) for i in bad])
            symbols = np.zeros((len(bad), sizes.max()), np.int64)
            symbols[np.repeat(np.arange(len(bad)), sizes), within(sizes)] = self.single[np.frombuffer(b"".join([mine[i] for i in bad]), np.uint8)]
            symbols[np.arange(len(bad)), sizes - 1] = self.final[np.array([mine[i][-1] for i in bad])]
            merged, n = self.merge(symbols, sizes)
            if merged.shape[1] > tokens.shape[1]:
                tokens = np.pad(tokens, ((0, 0), (0, merged.shape[1] - tokens.shape[1])), constant_values=-1)
            tokens[bad, : merged.shape[1]] = merged
            count[bad] = n
        tokens = tokens.astype("<u4")
        for i, row, n in zip(short, tokens, count.tolist()):
            out[i] = row[:n]
        return out

    def fits(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """check() with the answers of earlier pairs kept."""
        unique, back = np.unique(left << 20 | right, return_inverse=True)
        keys = unique.tolist()
        new = np.array([k for k in keys if k not in self.compatible], np.int64)
        if new.size:
            if len(self.compatible) > 500_000:
                self.compatible.clear()
                new = unique
            self.compatible.update(zip(new.tolist(), self.check(new >> 20, new & 0xFFFFF).tolist()))
        return np.fromiter((self.compatible[k] for k in keys), bool, len(keys))[back]

    def encode_long(self, piece: bytes) -> list[int]:
        tokens, count = self.propose([piece])
        tokens = tokens[0, : count[0]]
        if self.own[tokens].all() and self.fits(tokens[:-1], tokens[1:]).all():
            return tokens.tolist()
        return self.merge_long(piece)

    # -- words

    def split(self, word: str) -> list[bytes | int]:
        """Pieces of one white-space free word as bytes, and ids of special tokens in it."""
        out: list[bytes | int] = []
        for part in self.special_split.split(word) if self.special_split and "<|" in word else [word]:
            if part in self.special:
                out.append(self.special[part])
            elif part and max(part) < PLAIN:
                out += [p.encode() for p in self.pieces.findall(part.lower())]
            elif part:
                out += [bytes(map(BYTES.__getitem__, p)) for p, _ in self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(part))]
        return out

    def learn(self, hashes: list[int], words: list[bytes]) -> None:
        """Encode words not met before."""
        split = [self.split(w.decode("utf-8")) for w in words]
        pieces = [*dict.fromkeys(p for parts in split for p in parts)]
        known = {p: (np.array([p], "<u4").tobytes(), self.text[p]) for p in pieces if isinstance(p, int)}
        plain = [p for p in pieces if not isinstance(p, int)]
        known |= {p: (ids.tobytes(), " ".join(self.text[ids])) for p, ids in zip(plain, self.encode_pieces(plain))}
        for h, parts in zip(hashes, split):
            found = [known[p] for p in parts]
            self.slot[h] = len(self.ids)
            self.ids.append(ids := b"".join([i for i, _ in found]))
            self.shown.append(shown := " ".join([t for _, t in found]).encode("utf-8"))
            self.held += len(ids) + len(shown) + 200

    def encode(self, texts: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
        """Ids (little-endian 32-bit) and the decoded text of each."""
        words = Words(texts, fold=False)
        unique, at, back = np.unique(words.hash, return_index=True, return_inverse=True)
        keys = unique.tolist()
        if len(self.slot) > STORE_WORDS or self.held > STORE_BYTES:
            self.forget(keys)
        new = [i for i, h in enumerate(keys) if h not in self.slot]
        raw, starts, ends = words.raw, words.start[at].tolist(), words.end[at].tolist()
        if new:
            self.learn([keys[i] for i in new], [raw[starts[i] : ends[i]] for i in new])
        slots = np.fromiter((self.slot[h] for h in keys), np.int64, len(keys))[back].tolist()
        for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
            mine = slots[a:b]
            yield b"".join([self.ids[s] for s in mine]), b" ".join([x for s in mine if (x := self.shown[s])])


def within(lengths: np.ndarray) -> np.ndarray:
    """0..length-1 for each length, one after the other."""
    return np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def model(path: str) -> BpeModel:
    """One model per Python worker and file."""
    if path not in _models:
        _models[path] = BpeModel(path)
    return _models[path]


def encode_documents(docs: DataFrame, path: str, keep_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and, with ``keep_ids``, ids and decoded of every row.

    ``path`` is a vocabulary file that every executor has in the same place (part of an installed package).
    """

    def run(batches):
        bpe = model(path)
        for rows, texts in chunks(batches):
            done = [*bpe.encode(texts)]
            columns = [rows.column("doc_id"), pa.array([len(i) // 4 for i, _ in done], pa.int64()), pa.array([hashlib.sha256(i).hexdigest() for i, _ in done], pa.string()), pa.array([hashlib.sha256(d).hexdigest() for _, d in done], pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep_ids:
                columns += [pa.array([np.frombuffer(i, "<u4").astype(np.int64) for i, _ in done], pa.list_(pa.int64())), pa.array([d.decode("utf-8") for _, d in done], pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<long>, decoded string" if keep_ids else "")
    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), run, schema)
