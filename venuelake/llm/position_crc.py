"""crc32 of many byte spans at once from a table of bytes by their distance from the end.

A CRC is affine: the CRC of a span is the XOR of what each byte adds, which depends only on the byte and on how many bytes
follow it, and of a constant of the length (the CRC of so many zero bytes). Spans of up to ``WIDTH`` bytes are one
``bitwise_xor.reduceat`` over looked-up values; longer ones are folded block by block, where the state so far counts as
four bytes in front of the next block.
"""

from __future__ import annotations

import zlib

import numpy as np

#: Bytes of a block; the table has one row for each distance from the end.
WIDTH = 64
#: Bytes whose values are looked up at once.
FLAT = 1 << 17
_FULL = np.uint32(0xFFFFFFFF)


def _tables() -> tuple[np.ndarray, np.ndarray]:
    constant = np.array([zlib.crc32(bytes(n)) for n in range(WIDTH + 1)], np.uint32)
    last = np.array([zlib.crc32(bytes([b])) for b in range(256)], np.uint32) ^ constant[1]
    rows = [last]
    for _ in range(WIDTH - 1):  # one more zero byte behind
        rows.append((rows[-1] >> np.uint32(8)) ^ last[rows[-1] & np.uint32(255)])
    return np.stack(rows), constant


TABLE, CONSTANT = _tables()
_CELLS = TABLE.ravel()


def ahead(state: np.ndarray, size: np.ndarray | int) -> np.ndarray:
    """What a CRC state adds when ``size`` bytes (4 to WIDTH) follow: its bytes, lowest first, in front of them."""
    out = np.zeros(len(state), np.uint32)
    for k in range(4):
        out ^= TABLE[size - 1 - k, (state >> np.uint32(8 * k)) & np.uint32(255)]
    return out


def _linear(buf: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The XOR of what the bytes of each span add; sizes are 0 to WIDTH."""
    out = np.zeros(len(start), np.uint32)
    some = np.flatnonzero(size)
    start, size = start[some], size[some]
    ends = np.cumsum(size)
    cuts = np.searchsorted(ends, np.arange(FLAT, ends[-1] if len(ends) else 0, FLAT))
    for a, b in zip([0, *cuts], [*cuts, len(some)]):
        if a == b:
            continue
        n = size[a:b]
        first = np.cumsum(n) - n
        total = int(n.sum())
        place = np.arange(total, dtype=np.int64)
        behind = np.repeat(first + n - 1, n) - place
        at = place + np.repeat(start[a:b] - first, n)
        out[some[a:b]] = np.bitwise_xor.reduceat(_CELLS[behind * 256 + buf[at]], first)
    return out


def crc_spans(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The crc32 of ``buf[start:end]`` for each span as uint32, as zlib has it; spans may overlap or be empty."""
    start, size = np.asarray(start, np.int64), np.asarray(end, np.int64) - np.asarray(start, np.int64)
    out = np.zeros(len(start), np.uint32)
    short = np.flatnonzero(size <= WIDTH)
    out[short] = _linear(buf, start[short], size[short]) ^ CONSTANT[size[short]]
    live = np.flatnonzero(size > WIDTH)
    if live.size:
        live = live[np.argsort(-size[live], kind="stable")]
        at, head = start[live], size[live] % WIDTH
        blocks = size[live] // WIDTH
        state = _linear(buf, at, head) ^ CONSTANT[head] ^ _FULL
        at = at + head
        done = 0
        while len(live):
            state = ahead(state, WIDTH) ^ _linear(buf, at, np.full(len(at), WIDTH))
            at, done = at + WIDTH, done + 1
            going = int(np.searchsorted(-blocks, -done, "left"))
            out[live[going:]] = state[going:] ^ _FULL
            live, at, state, blocks = live[:going], at[:going], state[:going], blocks[:going]
    return out


def joined(left: np.ndarray, right: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRCs of left and right spans joined; ``size`` is the length of each right span, 0 or at least 4 bytes beyond whole blocks."""
    # The right CRC holds a start state of its own, which must not count twice: both states move over the right span.
    state = left ^ _FULL ^ _FULL
    size = np.asarray(size, np.int64)
    while (far := np.flatnonzero(size >= WIDTH)).size:
        state[far] = ahead(state[far], WIDTH)
        size = np.where(size >= WIDTH, size - WIDTH, size)
    rest = np.flatnonzero(size)
    state[rest] = ahead(state[rest], size[rest])
    return state ^ right
