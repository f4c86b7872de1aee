"""Media columns: copies of pictures, found by local descriptors.

1. Pictures (PGM, PPM or PNG bytes, see ``decode``) become grey; those of more
   than MOST_SIDE pixels a side are halved until they fit. Equal pixels are one
   node from here on.
2. Corners: local maxima of the Harris response at SCALES sizes of the picture,
   placed between pixels by a parabola; the strongest CORNERS of them make up the
   descriptor (a fixed size of it, like the number of scales).
3. Each corner gets an angle (from the centre of mass of the patch around it)
   and BITS binary tests, pairs of smoothed grey values compared at places turned
   by that angle. Copies that are brighter, darker, cropped, shifted, turned,
   resized, blurred or noisy keep most tests.
4. Hamming tables: each of TABLES tables has a fixed choice of KEY_BITS tests.
   Pictures with a corner of the same bits there are candidates. Two corners that
   differ in a share d of their tests meet in a table with probability
   (1 - d) ** KEY_BITS, and a copy has many corners to do so. Each key's pivot is
   paired with all others; keys of several classes afterwards are looked at again
   and in the end compared whole, in blocks (the steps of ``near_dup``), so no
   two pictures that share a key go uncompared if they are in different classes.
   Before pairs are compared, a first SKETCH tests of each corner tell whether enough
   corners can match at all.
5. Geometric consensus: corners of two pictures that match in BITS - FAR tests
   or more each propose a shift, turn and scale; a pair is a copy if AGREE matches
   or more fit one proposal.

Result of ``copies`` (a detection of near copies, so classes and no pairs): one
row for each picture with its class (least id in it).

Edge cases: a null or unreadable picture, or one without corners, has a class
of its own unless its pixels equal another's. A null id gets no class. Rows
that repeat an id with other pictures each have the class of their own picture.
An empty table gives no row. Other columns are left out. PNG of other depths,
interlaced PNG, JPEG, and pictures of more than MOST_PIXELS count as unreadable.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chartloom.llm import near_dup
from chartloom.llm.common import map_arrow, release, stage

SCALES = (1.0, 0.89, 0.79, 0.71)
CORNERS = 48
BITS, TABLES, KEY_BITS = 104, 5, 50
EDGE = 13
ANGLES = 72
FAR = 16
AGREE = 6
#: Tests of each corner that a first look at a pair uses, and how many may differ there.
SKETCH, SKETCH_FAR = 32, 3
MOST_SIDE, MOST_PIXELS = 1024, 1 << 26
_REACH = 9.5


def _tests(blur: float = 4.5, most: float = 0.75) -> np.ndarray:
    """Places of the test pairs, (BITS, 2, 2), within the patch: random pairs that tell different things.

    In a random picture whose values a distance d apart correlate by exp(-d^2 / 2 blur^2), the differences of two pairs
    have a known correlation; a pair joins the others if none is above ``most``.
    """
    rng, alike, out = np.random.default_rng(5), lambda p, q: np.exp(-((p - q) ** 2).sum(-1) / (2 * blur * blur)), np.zeros((0, 2, 2))
    spread = lambda p: np.sqrt(2 - 2 * alike(p[..., 0, :], p[..., 1, :]))
    while len(out) < BITS:
        pair = rng.uniform(-_REACH, _REACH, (2, 2))
        if np.hypot(*(pair[0] - pair[1])) < 4:
            continue
        (p, q), r, s = pair, out[:, 0], out[:, 1]
        both = (alike(p, r) - alike(p, s) - alike(q, r) + alike(q, s)) / (spread(pair) * spread(out)) if len(out) else np.zeros(1)
        if np.abs(both).max() < most:
            out = np.concatenate([out, pair[None]])
    return out


def _turned() -> np.ndarray:
    """The same for each angle: (ANGLES, BITS, 2, 2) as (dy, dx)."""
    out = []
    for k in range(ANGLES):
        a = 2 * np.pi * k / ANGLES
        out.append(_tests() @ np.array([[np.cos(a), np.sin(a)], [-np.sin(a), np.cos(a)]]).T)
    return np.array(out).astype("f4")


_TURNED = _turned()
#: Which tests make up the key of each table.
_CHOICE = np.array([np.random.default_rng(100 + t).permutation(BITS)[:KEY_BITS] for t in range(TABLES)])
_DISC = np.array([(y, x, np.exp(-(y * y + x * x) / (2 * (_REACH / 1.6) ** 2))) for y in range(-9, 10) for x in range(-9, 10) if x * x + y * y <= _REACH**2], "f4")


def pgm(grey: np.ndarray) -> bytes:
    """A grey picture as PGM bytes."""
    return b"P5 %d %d 255\n" % (grey.shape[1], grey.shape[0]) + np.ascontiguousarray(grey, "u1").tobytes()


def _png(data: bytes) -> np.ndarray:
    """Grey values of an 8-bit, non-interlaced PNG (grey, RGB, palette, with or without alpha)."""
    at, idat, palette = 8, [], None
    width, height, depth, kind, _, _, laced = struct.unpack(">IIBBBBB", data[16:29])
    if depth != 8 or laced:
        raise ValueError("this kind of PNG is not read")
    while at < len(data):
        size, name = struct.unpack(">I4s", data[at : at + 8])
        if name == b"IDAT":
            idat.append(data[at + 8 : at + 8 + size])
        elif name == b"PLTE":
            palette = np.frombuffer(data[at + 8 : at + 8 + size], "u1").reshape(-1, 3)
        at += 12 + size
    bands = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}[kind]
    raw = np.frombuffer(zlib.decompressobj().decompress(b"".join(idat), height * (1 + width * bands)), "u1").reshape(height, 1 + width * bands)
    out = np.zeros((height, width * bands), "u1")
    before = np.zeros(width * bands, "i4")
    for y in range(height):
        f, row = int(raw[y, 0]), raw[y, 1:].astype("i4")
        if f == 2:
            row = row + before
        elif f == 1:
            row = np.cumsum(row.reshape(width, bands), 0).ravel()
        elif f in (3, 4):
            for x in range(width * bands):
                a = row[x - bands] if x >= bands else 0
                b, c = int(before[x]), int(before[x - bands]) if x >= bands else 0
                if f == 3:
                    row[x] = (row[x] + (a + b) // 2) & 255
                else:
                    p = a + b - c
                    pa, pb, pc = abs(p - a), abs(p - b), abs(p - c)
                    row[x] = (row[x] + (a if pa <= pb and pa <= pc else b if pb <= pc else c)) & 255
        before = row & 255
        out[y] = before
    pixels = out.reshape(height, width, bands)
    if kind == 3:
        pixels = palette[pixels[:, :, 0]]
    return _grey(pixels[:, :, :3] if pixels.shape[2] >= 3 else pixels[:, :, :1])


def _grey(pixels: np.ndarray) -> np.ndarray:
    if pixels.shape[2] == 1:
        return pixels[:, :, 0]
    return np.rint(pixels @ np.array([0.299, 0.587, 0.114])).astype("u1")


def _few(width: int, height: int) -> bool:
    return 0 < width * height <= MOST_PIXELS


def _fitted(grey: np.ndarray) -> np.ndarray:
    """The picture halved until its sides fit."""
    while max(grey.shape) > MOST_SIDE:
        h, w = grey.shape[0] // 2 * 2, grey.shape[1] // 2 * 2
        grey = (grey[:h:2, :w:2].astype("u2") + grey[1:h:2, :w:2] + grey[:h:2, 1:w:2] + grey[1:h:2, 1:w:2] + 2 >> 2).astype("u1")
    return grey


def decode(data: bytes | None) -> np.ndarray | None:
    """Grey values of a picture; None if it cannot be read."""
    if not data:
        return None
    try:
        if data[:8] == b"\x89PNG\r\n\x1a\n":
            return _png(data) if _few(*struct.unpack(">II", data[16:24])) else None
        if m := re.match(rb"P([56])\s+(?:#[^\n]*\n\s*)*(\d+)\s+(\d+)\s+255\s", data):
            bands, width, height = 3 if m[1] == b"6" else 1, int(m[2]), int(m[3])
            if not _few(width, height):
                return None
            return _grey(np.frombuffer(data, "u1", width * height * bands, m.end()).reshape(height, width, bands))
    except (ValueError, KeyError, IndexError, TypeError, struct.error, zlib.error):
        pass
    return None


def _resize(x: np.ndarray, scale: float) -> np.ndarray:
    """Bilinear, with places that do not depend on the size: pixel i of the result is at i / scale."""
    if scale == 1:
        return x
    out = x
    for axis in (1, 2):
        n = int((x.shape[axis] - 1) * scale) + 1
        at = np.arange(n) / scale
        low = np.minimum(at.astype("i4"), x.shape[axis] - 2)
        w = (at - low).astype("f4")
        shape = [1, 1, 1]
        shape[axis] = n
        out = np.take(out, low, axis) * (1 - w.reshape(shape)) + np.take(out, low + 1, axis) * w.reshape(shape)
    return out


def _smooth(x: np.ndarray) -> np.ndarray:
    """1 4 6 4 1 in both directions; the border keeps its size by repetition."""
    for axis in (1, 2):
        pad = [(0, 0)] * 3
        pad[axis] = (2, 2)
        p = np.pad(x, pad, "edge")
        n = x.shape[axis]
        part = lambda k: p[:, k : k + n] if axis == 1 else p[:, :, k : k + n]  # noqa: B023, E731
        x = (part(0) + part(4)) * np.float32(1 / 16) + (part(1) + part(3)) * np.float32(4 / 16) + part(2) * np.float32(6 / 16)
    return x


def describe(grey: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For pictures of one size, (n, height, width): (places (k, 4): x, y, scale, angle; tests (k, BITS // 8) bytes) of each."""
    count = len(grey)
    found: list[list[tuple]] = []
    for level, scale in enumerate(SCALES):
        if min(grey.shape[1:]) * scale < 2 * EDGE + 3:
            continue
        x = _smooth(_resize(grey.astype("f4"), scale))
        dy, dx = np.zeros_like(x), np.zeros_like(x)
        dy[:, 1:-1], dx[:, :, 1:-1] = x[:, 2:] - x[:, :-2], x[:, :, 2:] - x[:, :, :-2]
        a, b, c = _smooth(dx * dx), _smooth(dy * dy), _smooth(dx * dy)
        r = a * b - c * c - np.float32(0.04) * (a + b) ** 2
        inner = r[:, EDGE:-EDGE, EDGE:-EDGE]
        high = np.full(inner.shape, True)
        h, w = r.shape[1:]
        for sy in (-1, 0, 1):
            for sx in (-1, 0, 1):
                if sy or sx:
                    high &= inner > r[:, EDGE + sy : h - EDGE + sy, EDGE + sx : w - EDGE + sx]
        high &= inner > 1.0
        n, y, xx = np.nonzero(high)
        if not len(n):
            continue
        strength = inner[n, y, xx]
        y, xx = y + EDGE, xx + EDGE
        # the top of a parabola through the maximum and its neighbours
        top = lambda low, high: np.clip((high - low) / (2 * np.maximum(2 * strength - low - high, 1e-6)), -0.5, 0.5)  # noqa: B023, E731
        fy, fx = top(r[n, y - 1, xx], r[n, y + 1, xx]), top(r[n, y, xx - 1], r[n, y, xx + 1])
        x = _smooth(_smooth(x))
        found.append((n, strength, level, y + fy, xx + fx, x))
    if not found:
        return [(np.zeros((0, 4), "f4"), np.zeros((0, BITS // 8), "u1"))] * count
    n = np.concatenate([f[0] for f in found])
    strength = np.concatenate([f[1] for f in found])
    source = np.concatenate([np.full(len(f[0]), i) for i, f in enumerate(found)])
    item = np.concatenate([np.arange(len(f[0])) for f in found])
    order = np.lexsort((item, source, -strength, n))
    rank = np.arange(len(n)) - np.searchsorted(n[order], n[order])
    keep = order[rank < CORNERS]
    places, bits, owner = [], [], []
    for i, (n_, _, level, y, xx, x) in enumerate(found):
        mine = item[keep[source[keep] == i]]
        if not len(mine):
            continue
        yy, x_ = y[mine], xx[mine]
        cy, cx = np.rint(yy).astype("i4"), np.rint(x_).astype("i4")
        around = x[n_[mine][:, None], cy[:, None] + _DISC[:, 0].astype("i4"), cx[:, None] + _DISC[:, 1].astype("i4")] * _DISC[:, 2]
        a = np.arctan2(around @ _DISC[:, 0], around @ _DISC[:, 1])
        turn = np.rint(a / (2 * np.pi) * ANGLES).astype("i4") % ANGLES
        at = _TURNED[turn]
        h, w = x.shape[1:]
        vy = np.clip(np.rint(yy[:, None, None] + at[..., 0]).astype("i4"), 0, h - 1)
        vx = np.clip(np.rint(x_[:, None, None] + at[..., 1]).astype("i4"), 0, w - 1)
        v = x[n_[mine][:, None, None], vy, vx]
        bits.append(np.packbits(v[:, :, 0] < v[:, :, 1], axis=1))
        places.append(np.stack([x_ / SCALES[level], yy / SCALES[level], np.full(len(mine), SCALES[level]), a], 1).astype("f4"))
        owner.append(n_[mine])
    places, bits, owner = np.concatenate(places), np.concatenate(bits), np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    cuts = np.searchsorted(owner[order], np.arange(count + 1))
    return [(places[order[a:b]], bits[order[a:b]]) for a, b in zip(cuts, cuts[1:], strict=False)]


_ONES = np.array([bin(i).count("1") for i in range(256)], "u1")


def consensus(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> int:
    """The most matches of corners that fit one shift, turn and scale."""
    (pa, ba), (pb, bb) = a, b
    if not len(pa) or not len(pb):
        return 0
    distance = _ONES[ba[:, None, :] ^ bb[None, :, :]].sum(2, dtype="i4")
    i, j = np.nonzero((distance <= FAR) & (distance == distance.min(1, keepdims=True)))
    if len(i) < AGREE:
        return 0
    p, q = pa[i], pb[j]
    ratio = p[:, 2] / q[:, 2]
    turn = q[:, 3] - p[:, 3]
    cos, sin = np.cos(turn) * ratio, np.sin(turn) * ratio
    # each match's own movement, tried on all matches
    tx = q[:, 0] - (cos * p[:, 0] - sin * p[:, 1])
    ty = q[:, 1] - (sin * p[:, 0] + cos * p[:, 1])
    x = cos[:, None] * p[None, :, 0] - sin[:, None] * p[None, :, 1] + tx[:, None]
    y = sin[:, None] * p[None, :, 0] + cos[:, None] * p[None, :, 1] + ty[:, None]
    bent = np.abs((turn[:, None] - turn[None, :] + np.pi) % (2 * np.pi) - np.pi)
    fit = (np.hypot(x - q[None, :, 0], y - q[None, :, 1]) <= 3) & (np.abs(np.log(ratio[:, None] / ratio[None, :])) < 0.4) & (bent < 0.4)
    best = 0
    for row in fit:  # a corner counts once on either side
        best = max(best, min(len({*i[row].tolist()}), len({*j[row].tolist()})))
    return best


def features(media: DataFrame, data: str = "data") -> DataFrame:
    """(media_id, digest, places, tests, sketch): digest of the pixels; null for a picture that cannot be read, or without an id.

    The last three may be null for a picture that came before in the same task.
    """

    def make():
        before: set[bytes] = set()

        def f(batch):
            ids = batch.column("media_id")
            n = batch.num_rows
            places, tests, sketch, digest = [None] * n, [None] * n, [None] * n, [None] * n
            sizes: dict[tuple, list[tuple[int, np.ndarray]]] = {}
            if len(before) > 1 << 16:
                before.clear()
            for i, (media_id, data_) in enumerate(zip(ids, batch.column(data), strict=True)):
                if not media_id.is_valid or (p := decode(data_.as_py())) is None:
                    continue
                digest[i] = hashlib.blake2b(repr(p.shape).encode() + p.tobytes(), digest_size=16).digest()
                if digest[i] not in before:
                    before.add(digest[i])
                    p = _fitted(p)
                    sizes.setdefault(p.shape, []).append((i, p))
            for shape, own in sizes.items():
                at_once = max(1, (1 << 20) // (shape[0] * shape[1]))
                for k in range(0, len(own), at_once):
                    part = own[k : k + at_once]
                    for (i, _), (place, bits) in zip(part, describe(np.stack([p for _, p in part])), strict=True):
                        places[i], tests[i], sketch[i] = _packed(place), bits.tobytes(), bits[:, : SKETCH // 8].tobytes()
            return {"media_id": ids, "digest": digest, "places": places, "tests": tests, "sketch": sketch}

        return f

    return map_arrow(media.select(F.col("media_id").cast("long"), data), "media_id long, digest binary, places binary, tests binary, sketch binary", make, rows=64)


def _packed(places: np.ndarray) -> bytes:
    """x and y in 16ths of a pixel, the number of the scale, and the angle in 256ths of a turn: six bytes a corner."""
    out = np.zeros(len(places), np.dtype([("x", "<u2"), ("y", "<u2"), ("s", "u1"), ("a", "u1")]))
    out["x"], out["y"] = np.rint(places[:, 0] * 16), np.rint(places[:, 1] * 16)
    out["s"] = np.abs(places[:, 2, None] - np.array(SCALES, "f4")).argmin(1)
    out["a"] = np.rint(places[:, 3] / (2 * np.pi) * 256).astype("i4") & 255
    return out.tobytes()


def _corners(places: bytes, tests: bytes) -> tuple[np.ndarray, np.ndarray]:
    p = np.frombuffer(places, np.dtype([("x", "<u2"), ("y", "<u2"), ("s", "u1"), ("a", "u1")]))
    place = np.stack([p["x"] / 16, p["y"] / 16, np.array(SCALES)[p["s"]], p["a"] * (2 * np.pi / 256)], 1)
    return place, np.frombuffer(tests, "u1").reshape(-1, BITS // 8)


def table_keys(nodes: DataFrame) -> DataFrame:
    """(band, key, node): one row for each table and distinct choice of a picture's tests."""

    def make():
        weight = (np.uint64(1) << np.arange(KEY_BITS, dtype="<u8")).astype("<u8")

        def f(batch):
            tests = [t or b"" for t in batch.column("tests").to_pylist()]
            count = np.array([len(t) // (BITS // 8) for t in tests])
            bits = np.unpackbits(np.frombuffer(b"".join(tests), "u1").reshape(-1, BITS // 8), axis=1)
            node = np.repeat(batch.column("node").to_numpy(), count)
            bands, keys, nodes_ = [], [], []
            for t in range(TABLES):
                own = np.unique(np.stack([node, (bits[:, _CHOICE[t]] * weight).sum(1, dtype="<u8").view("<i8")], 1), axis=0)
                bands.append(np.full(len(own), t))
                nodes_.append(own[:, 0])
                keys.append(own[:, 1])
            return {"band": np.concatenate(bands), "key": np.concatenate(keys), "node": np.concatenate(nodes_)}

        return f

    return map_arrow(nodes.select("node", "tests"), "band int, key long, node long", make)


def shared(members: DataFrame) -> DataFrame:
    """Members of keys that have several: one exchange of the rows, which are many and short."""
    return members.withColumn("__n", F.count("*").over(Window.partitionBy("band", "key"))).filter("__n > 1").drop("__n")


def possible(pairs: DataFrame, nodes: DataFrame, agree: int) -> DataFrame:
    """Pairs (a, b) of which ``agree`` corners on either side have one on the other that differs in few of SKETCH tests."""

    def make():
        def f(batch):
            keep = []
            for k, (a, b) in enumerate(zip(batch.column("sa").to_pylist(), batch.column("sb").to_pylist(), strict=True)):
                own, other = (np.frombuffer(v, "<u4") for v in (a, b))
                near = np.bitwise_count(own[:, None] ^ other) <= SKETCH_FAR
                if min(near.any(1).sum(), near.any(0).sum()) >= agree:
                    keep.append(k)
            return {c: batch.column(c).take(np.array(keep, "i8")) for c in ("a", "b")}

        return f

    one = lambda x: nodes.select(F.col("node").alias(x), F.col("sketch").alias(f"s{x}"))
    return map_arrow(pairs.join(one("a"), "a").join(one("b"), "b"), "a long, b long", make, rows=4096)


def confirmed(pairs: DataFrame, nodes: DataFrame, agree: int) -> DataFrame:
    """Pairs (a, b) with geometric consensus."""

    def make():
        def f(batch):
            cols = [batch.column(c).to_pylist() for c in ("a", "b", "pa", "ta", "pb", "tb")]
            keep = [(a, b) for a, b, pa, ta, pb, tb in zip(*cols, strict=True) if consensus(_corners(pa, ta), _corners(pb, tb)) >= agree]
            return {"a": [a for a, _ in keep], "b": [b for _, b in keep]}

        return f

    one = lambda x: nodes.select(F.col("node").alias(x), F.col("places").alias(f"p{x}"), F.col("tests").alias(f"t{x}"))
    return map_arrow(stage(possible(pairs, nodes, agree), "possible").join(one("a"), "a").join(one("b"), "b"), "a long, b long", make)


def consensus_blocks(left: DataFrame, nodes: DataFrame, agree: int, block: int = 128) -> DataFrame:
    """Links (a, b) between members of different classes of large keys: all that join classes."""

    def compare(one: dict, two: dict):
        own, other = ([_corners(p, t) for p, t in zip(x["places"], x["tests"], strict=True)] for x in (one, two))
        for i in range(len(own)):
            for j in range(len(other)):
                yield i, j, lambda a=own[i], b=other[j]: consensus(a, b) >= agree

    return near_dup.in_blocks(left, nodes.select("node", "places", "tests"), ["places", "tests"], compare, block=block)


def copies(media: DataFrame, data: str = "data", agree: int = AGREE) -> DataFrame:
    """(media_id, class_id) of (media_id, data) rows."""
    spark = media.sparkSession
    described = stage(features(media, data), "features")
    readable = described.filter(F.col("media_id").isNotNull() & F.col("digest").isNotNull())
    some = lambda c: F.first(c, ignorenulls=True).alias(c)
    nodes = stage(readable.groupBy("digest").agg(some("places"), some("tests"), some("sketch")).withColumn("node", F.monotonically_increasing_id()), "pictures")
    release(spark)
    members = stage(shared(table_keys(nodes)), "keys")
    release(spark)
    links = near_dup.Links(spark, lambda pairs: confirmed(pairs, nodes, agree))
    # a picture has hundreds of keys, so copies would meet hundreds of pivots if each key had its own order
    links.search(members, lambda left: consensus_blocks(left, nodes, agree), one_order=True)
    per_picture = nodes.select("digest", "node").join(links.classes, "node", "left").select("digest", F.coalesce("class", "node").alias("class"))
    rows = stage(readable.groupBy("media_id", "digest").agg(F.count("*").alias("n")).join(per_picture, "digest"), "rows")
    found = rows.join(rows.groupBy("class").agg(F.min("media_id").alias("class_id")), "class")
    found = found.select("media_id", "class_id", F.explode(F.sequence(F.lit(1), F.col("n").cast("int")))).select("media_id", "class_id")
    alone = described.filter(F.col("media_id").isNull() | F.col("digest").isNull())
    return found.unionByName(alone.select("media_id", F.col("media_id").alias("class_id")))


def picture(vector: np.ndarray, side: int = 24, cell: int = 4) -> np.ndarray:
    """A vector drawn as a picture: a square of cells, each a fixed random sum of its values, blended, with hard contrast."""
    grid = (np.random.default_rng(11).normal(0, 1, (side * side, len(vector))) @ vector).reshape(side, side)
    grid = np.pad(np.clip(grid / (2 * grid.std() or 1.0), -1, 1), 1, "edge")
    at = (np.arange(side * cell) + 0.5) / cell + 0.5
    low = at.astype("i4")
    w = at - low
    w = w * w * (3 - 2 * w)
    rows = grid[low] * (1 - w)[:, None] + grid[low + 1] * w[:, None]
    both = rows[:, low] * (1 - w) + rows[:, low + 1] * w
    return np.rint(127.5 + 100 * both).astype("u1")


def moved(grey: np.ndarray, degrees: float, scale: float) -> np.ndarray:
    """Turned about its centre and resized, bilinear; the largest part without empty corners."""
    h, w = grey.shape
    cos, sin = np.cos(np.deg2rad(degrees)), np.sin(np.deg2rad(degrees))
    fits = 1 / (abs(cos) + abs(sin) * max(h, w) / min(h, w))
    y, x = np.mgrid[0 : int(h * scale * fits), 0 : int(w * scale * fits)].astype("f8")
    y, x = y - y.max() / 2, x - x.max() / 2
    sy, sx = (cos * y + sin * x) / scale + (h - 1) / 2, (cos * x - sin * y) / scale + (w - 1) / 2
    y0, x0 = np.clip(sy.astype("i4"), 0, h - 2), np.clip(sx.astype("i4"), 0, w - 2)
    fy, fx, g = sy - y0, sx - x0, grey.astype("f8")
    out = (g[y0, x0] * (1 - fx) + g[y0, x0 + 1] * fx) * (1 - fy) + (g[y0 + 1, x0] * (1 - fx) + g[y0 + 1, x0 + 1] * fx) * fy
    return np.clip(np.rint(out), 0, 255).astype("u1")


#: Edits of the gallery's copies.
EDITS = ("crop and brighter", "crop and flatter", "crop and turned by a quarter", "resized to 0.9", "resized to 0.8", "turned by 10 degrees", "noise", "fewer shades")


def edited(grey: np.ndarray, kind: int) -> np.ndarray:
    """A copy as people make them."""
    h, w = grey.shape
    cropped = grey[h // 16 : h - h // 10, w // 12 : w - w // 16].astype("f8")
    match kind % len(EDITS):
        case 0:
            out = cropped + 18
        case 1:
            out = 0.85 * cropped + 10
        case 2:
            out = np.rot90(cropped)
        case 3:
            return moved(grey, 0, 0.9)
        case 4:
            return moved(grey, 0, 0.8)
        case 5:
            return moved(grey, 10, 1)
        case 6:
            out = grey + np.random.default_rng(kind).normal(0, 8, grey.shape)
        case _:
            out = grey // 12 * 12
    return np.clip(np.rint(out), 0, 255).astype("u1")


def gallery(embeddings: DataFrame) -> DataFrame:
    """(media_id, data): each vector drawn as a picture (id 2 * vec_id), and an edited copy of it (2 * vec_id + 1)."""

    def make():
        import pyarrow as pa

        def f(batch):
            ids, data = [], []
            for i, v in zip(batch.column("vec_id").to_pylist(), batch.column("embedding").to_pylist(), strict=True):
                grey = picture(np.array([0.0 if x is None or not np.isfinite(x) else x for x in v or [0.0]]))
                ids += [None, None] if i is None else [2 * i, 2 * i + 1]
                data += [pgm(grey), pgm(edited(grey, i or 0))]
            return {"media_id": pa.array(ids, pa.int64()), "data": data}

        return f

    return map_arrow(embeddings.select(F.col("vec_id").cast("long"), "embedding"), "media_id long, data binary", make, rows=256)


def query(spark, sf_dir: str) -> DataFrame:
    from chartloom.llm.common import table

    return copies(gallery(table(spark, sf_dir, "embeddings")))
