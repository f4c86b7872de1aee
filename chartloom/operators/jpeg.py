"""Baseline JPEG of RGB tiles, vectorised over blocks, with Huffman tables made for each picture."""

from __future__ import annotations

import heapq
import struct

import numpy as np

#: The example quantisation tables of the JPEG standard, row by row (brightness, colour).
LUMA = (
    16, 11, 10, 16, 24, 40, 51, 61, 12, 12, 14, 19, 26, 58, 60, 55, 14, 13, 16, 24, 40, 57, 69, 56, 14, 17, 22, 29, 51, 87, 80, 62,
    18, 22, 37, 56, 68, 109, 103, 77, 24, 35, 55, 64, 81, 104, 113, 92, 49, 64, 78, 87, 103, 121, 120, 101, 72, 92, 95, 98, 112, 100, 103, 99,
)
CHROMA = (
    17, 18, 24, 47, 99, 99, 99, 99, 18, 21, 26, 66, 99, 99, 99, 99, 24, 26, 56, 99, 99, 99, 99, 99, 47, 66, 99, 99, 99, 99, 99, 99,
    *[99] * 32,
)

#: Places of a block in zigzag order: diagonals, every other one upwards.
ZIGZAG = np.array(sorted(range(64), key=lambda i: (i // 8 + i % 8, i // 8 if (i // 8 + i % 8) % 2 else i % 8)))
_K = np.arange(8)
_DCT = np.sqrt(np.where(_K == 0, 1, 2) / 8)[:, None] * np.cos((2 * _K[None, :] + 1) * _K[:, None] * np.pi / 16)


def _quant(table, quality: int) -> np.ndarray:
    scale = 5000 / quality if quality < 50 else 200 - 2 * quality
    return np.clip((np.array(table) * scale + 50) // 100, 1, 255).astype("i8")


def _coefficients(plane: np.ndarray, q: np.ndarray) -> np.ndarray:
    """(blocks, 64) in zigzag order."""
    h, w = plane.shape
    p = np.pad(plane, ((0, -h % 8), (0, -w % 8)), "edge") - 128.0
    b = p.reshape(p.shape[0] // 8, 8, -1, 8).transpose(0, 2, 1, 3).reshape(-1, 8, 8)
    c = _DCT @ b @ _DCT.T
    return np.rint(c.reshape(-1, 64) / q)[:, ZIGZAG].astype("i8")


def _symbols(c: np.ndarray) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """DC and AC entries of each block as one list a block: (symbol, bits, number of bits)."""
    size = np.zeros(c.shape, "i8")
    size[:] = np.ceil(np.log2(np.abs(c) + 1))
    bits = np.where(c < 0, c + (1 << size) - 1, c)
    ac = []
    for row, s, b in zip(c, size, bits, strict=True):
        out, last = [], 0
        for k in np.flatnonzero(row[1:]) + 1:
            run = k - last - 1
            out += [(0xF0, 0, 0)] * (run // 16)
            out.append(((run % 16) << 4 | int(s[k]), int(b[k]), int(s[k])))
            last = k
        if last < 63:
            out.append((0, 0, 0))
        ac.append(out)
    d = np.diff(c[:, 0], prepend=0)
    ds = np.ceil(np.log2(np.abs(d) + 1)).astype("i8")
    db = np.where(d < 0, d + (1 << ds) - 1, d)
    return [(int(s), int(b), int(s)) for s, b in zip(ds, db, strict=True)], ac


def _huffman(counts: dict[int, int]) -> tuple[list[int], list[int], dict[int, tuple[int, int]]]:
    """Codes of 16 bits at most, none of ones alone: numbers of codes by length, symbols in order, codes."""
    heap = [(n, i, (s,)) for i, (s, n) in enumerate(sorted(counts.items()))] + [(0, -1, (-1,))]  # -1 takes the code of ones
    heapq.heapify(heap)
    length = dict.fromkeys([*counts, -1], 0)
    i = len(heap)
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        for s in (*a[2], *b[2]):
            length[s] += 1
        heapq.heappush(heap, (a[0] + b[0], i := i + 1, (*a[2], *b[2])))
    number = [0] * (max(33, *length.values(), 0) + 1) if length else [0] * 34
    for n in length.values():
        number[n] += 1
    for n in range(len(number) - 1, 16, -1):  # too long ones move up in pairs, as the standard tells
        while number[n]:
            j = n - 2
            while not number[j]:
                j -= 1
            number[n] -= 2
            number[n - 1] += 1
            number[j + 1] += 2
            number[j] -= 1
    longest = max(n for n in range(17) if number[n])
    number[longest] -= 1  # the code of ones
    order = sorted(counts, key=lambda s: (length[s], s))
    codes, code, at = {}, 0, 0
    for n in range(1, 17):
        for _ in range(number[n]):
            codes[order[at]] = (code, n)
            code, at = code + 1, at + 1
        code <<= 1
    return number[1:17], order, codes


def _bits(words: list[tuple[int, int]]) -> bytes:
    """Values of so many bits each in a row, filled up with ones."""
    value, size = np.array(words, "i8").reshape(-1, 2).T
    ends = np.cumsum(size)
    below = np.repeat(ends, size) - np.arange(ends[-1] if len(ends) else 0) - 1  # bits of the same value that follow
    row = (np.repeat(value, size) >> below & 1).astype("u1")
    return np.packbits(np.concatenate([row, np.ones(-len(row) % 8, "u1")])).tobytes()


def encode_jpeg(rgba: bytes, width: int = 256, height: int = 256, quality: int = 85) -> bytes:
    """JPEG bytes of RGBA pixels; alpha is left out."""
    rgb = np.frombuffer(rgba, "u1").reshape(height, width, 4)[..., :3].astype("f8")
    r, g, b = rgb[..., 0], rgb[..., 1], rgb[..., 2]
    planes = (0.299 * r + 0.587 * g + 0.114 * b, 128 - 0.168736 * r - 0.331264 * g + 0.5 * b, 128 + 0.5 * r - 0.418688 * g - 0.081312 * b)
    tables = _quant(LUMA, quality), _quant(CHROMA, quality)
    parts = [_symbols(_coefficients(p, tables[min(i, 1)])) for i, p in enumerate(planes)]
    counts: list[dict[int, int]] = [{} for _ in range(4)]  # brightness DC and AC, colour DC and AC
    for i, (dc, ac) in enumerate(parts):
        for entries, table in ((dc, 2 * min(i, 1)), ([e for row in ac for e in row], 2 * min(i, 1) + 1)):
            for s, _, _ in entries:
                counts[table][s] = counts[table].get(s, 0) + 1
    made = [_huffman(c) for c in counts]
    words: list[tuple[int, int]] = []  # values and their numbers of bits
    for block in range(len(parts[0][0])):
        for i, (dc, ac) in enumerate(parts):
            for entries, table in (((dc[block],), 2 * min(i, 1)), (ac[block], 2 * min(i, 1) + 1)):
                for s, value, n in entries:
                    words.append(made[table][2][s])
                    if n:
                        words.append((value, n))
    body = _bits(words).replace(b"\xff", b"\xff\x00")
    segment = lambda mark, data: b"\xff" + bytes([mark]) + struct.pack(">H", len(data) + 2) + data
    out = b"\xff\xd8" + segment(0xE0, b"JFIF\0\1\1\0\0\1\0\1\0\0")
    for i, q in enumerate(tables):
        out += segment(0xDB, bytes([i]) + bytes(q[ZIGZAG].tolist()))
    out += segment(0xC0, struct.pack(">BHHB", 8, height, width, 3) + b"".join(bytes([i + 1, 0x11, min(i, 1)]) for i in range(3)))
    for i, (number, order, _) in enumerate(made):
        out += segment(0xC4, bytes([(i % 2) << 4 | i // 2]) + bytes(number) + bytes(order))
    return out + segment(0xDA, bytes([3, 1, 0x00, 2, 0x11, 3, 0x11, 0, 63, 0])) + body + b"\xff\xd9"
