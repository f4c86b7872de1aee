"""Packing: pieces of documents into sequences of a fixed window, by non-negative least squares.

1. Each document is cut into whole windows and a rest; whole windows are
   sequences of their own. Cutting anywhere is allowed; rests stay whole.
2. The histogram of rest lengths (at most ``window`` numbers, whatever the
   size of the table) goes to the driver. Shallow combinations of lengths that
   fill a window are listed: all pairs a + b = window, and ``triples`` triples
   for each length, spread evenly over what fits it.
3. Non-negative least squares solves for how often each combination repeats,
   so that the lengths used match the histogram; repeats are rounded to the
   nearest number (never above what the histogram still holds).
4. What is left is packed greedily, most first: the longest length left opens
   a sequence, and the longest that fits fills it, again and again. A pattern
   repeats as often as its lengths allow, so the plan stays at a few thousand
   rows at most.
5. The plan is a table of (length, from-rank, sequence, offset) ranges.
   The pieces of one length get ranks by a salted count (salts, then an
   offset for each salt), so a length that a third of all rows share is no
   hot key, and each piece looks its place up by its rank.

A sequence is padded to the window unless its length is a power of two;
``padding`` tells the ids that need padding.

Edge cases: a null text counts as empty and gives one piece, its end id. Equal
rows are told apart by a number. Documents with a null doc_id are packed too.
An empty table gives no row. Other columns are left out.
"""

from __future__ import annotations

import bisect
import struct
import zlib

import public_tokenizers
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chartloom.llm.common import map_arrow, stage
from chartloom.llm.tokens import encoder

PIECE = "doc_id long, start long, length int, ids_crc32 long, doc_tokens long"


def pieces(docs: DataFrame, vocabulary: str, end_id: int, window: int, text: str = "text", with_ids: bool = False) -> DataFrame:
    """Rows (doc_id, start, length, ids_crc32, doc_tokens[, ids]), one for each piece."""

    def make():
        import numpy as np
        import pyarrow as pa

        enc, end = encoder(vocabulary), struct.pack("<H", end_id)

        def f(batch):
            out = {c: [] for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", *["ids"] * with_ids)}
            for doc, ids in zip(batch.column(0).to_pylist(), enc.encode([t or "" for t in batch.column(1).to_pylist()]), strict=True):
                wide = np.frombuffer(ids + end, "<u2").astype("<u4")
                for at in range(0, len(wide), window):
                    part = wide[at : at + window]
                    out["doc_id"].append(doc)
                    out["start"].append(at)
                    out["length"].append(len(part))
                    out["ids_crc32"].append(zlib.crc32(part))
                    out["doc_tokens"].append(len(wide))
                    if with_ids:
                        out["ids"].append(part.tobytes())
            out["doc_id"] = pa.array(out["doc_id"], pa.int64())
            return out

        return f

    return map_arrow(docs.select(F.col("doc_id").cast("long"), F.col(text).cast("string")), PIECE + ", ids binary" * with_ids, make)


def nnls(a_rows, a_cols, b, n_cols: int, steps: int = 4000, still: float = 1e-3):
    """x >= 0 that nearly minimises |Ax - b|, for a sparse A given by its ones (repeats add up).

    Multiplicative updates x *= (A'b) / (A'Ax): they keep x non-negative, cost
    a few passes over the ones, and need no matrix. They end when no number
    moves by more than ``still`` of itself or of one repeat.
    """
    import numpy as np

    atb = np.bincount(a_cols, b[a_rows], n_cols)
    x = np.where(atb > 0, atb / max(1.0, len(b)), 0.0)
    for _ in range(steps):
        ax = np.bincount(a_rows, x[a_cols], len(b))
        atax = np.bincount(a_cols, ax[a_rows], n_cols)
        new = x * (atb / np.maximum(atax, 1e-12))
        done = (np.abs(new - x) <= still * np.maximum(x, 1)).all()
        x = new
        if done:
            break
    return x


def combinations(lengths, window: int, triples: int = 32):
    """Tuples of two or three of the given lengths that fill the window."""
    have = set(lengths)
    out = [(a, window - a) for a in lengths if a <= window - a and window - a in have]
    ordered = sorted(have)
    for a in ordered:
        # thirds spread over all lengths between a's rest
        rest = window - a
        fit = [b for b in ordered if a <= b <= rest - b and rest - b in have]
        step = max(1, len(fit) // triples)
        out += [(a, b, rest - b) for b in fit[::step][:triples]]
    return sorted(set(out))


def make_plan(histogram: dict[int, int], window: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns and their repeats, which use up the histogram of lengths below the window."""
    import numpy as np

    left = {k: int(v) for k, v in histogram.items() if 0 < k < window and v > 0}
    plan: list[tuple[tuple[int, ...], int]] = []
    combos = combinations(sorted(left), window)
    if combos:
        rows = np.array([p for c in combos for p in c])
        cols = np.repeat(np.arange(len(combos)), [len(c) for c in combos])
        b = np.zeros(window + 1)
        for k, v in left.items():
            b[k] = v
        x = nnls(rows, cols, b, len(combos))
        for i in np.argsort(-x, kind="stable"):
            if x[i] < 0.5:
                break
            combo = combos[i]
            need = {k: combo.count(k) for k in combo}
            n = min([int(round(x[i])), *(left.get(k, 0) // m for k, m in need.items())])
            if n > 0:
                plan.append((combo, n))
                for k, m in need.items():
                    left[k] -= n * m
                    if not left[k]:
                        del left[k]
    order = sorted(left)
    while order:
        pattern, room, used = [], window, {}
        at = len(order) - 1
        while at >= 0:
            k = order[at]
            if used.get(k, 0) < left[k]:
                pattern.append(k)
                used[k] = used.get(k, 0) + 1
                room -= k
            at = min(at - (used[k] == left[k]), bisect.bisect_right(order, room) - 1)
        n = min(left[k] // m for k, m in used.items())
        plan.append((tuple(pattern), n))
        for k, m in used.items():
            left[k] -= n * m
        order = [k for k in order if left[k]]
    return plan


def slots(plan, window: int):
    """The plan as ranges: for each length, arrays of first ranks, first sequences and offsets.

    The pieces of rank r in a range [first, next) stand in sequence
    ``sequence + (r - first)`` at ``offset``. Also the number of sequences and
    of padding ids.
    """
    import numpy as np

    out: dict[int, list] = {}
    given: dict[int, int] = {}
    sequence = padding = 0
    for pattern, n in plan:
        offset = 0
        for k in pattern:
            first = given.get(k, 0)
            out.setdefault(k, []).append((first, sequence, offset))
            given[k] = first + n
            offset += k
        if offset & (offset - 1):
            padding += n * (window - offset)
        sequence += n
    return {k: tuple(np.array(x, "<i8") for x in zip(*v, strict=True)) for k, v in out.items()}, sequence, padding


def pack(
    docs: DataFrame,
    vocabulary: str = public_tokenizers.path("byte_bpe_50k.json"),
    end_id: int = 1,
    window: int = 2048,
    with_ids: bool = False,
    rows_per_salt: int = 50_000,
) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``."""
    spark = docs.sparkSession
    cut = stage(pieces(docs, vocabulary, end_id, window, with_ids=with_ids), "pieces")
    histogram = {r.length: r.n for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most window rows
    plan = make_plan(histogram, window)
    places, n_rest, padding = slots(plan, window)
    if window in histogram:  # whole windows come last, one for each
        import numpy as np

        places[window] = tuple(np.array([x], "<i8") for x in (0, n_rest, 0))
    shared = spark.sparkContext.broadcast(places)  # the plan: a few thousand ranges

    salts = max(1, -(-sum(histogram.values()) // rows_per_salt))
    meta = cut.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", *["ids"] * with_ids)
    salted = meta.withColumn("salt", F.pmod(F.xxhash64("doc_id", "start"), F.lit(salts)).cast("int"))
    counts = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    order = Window.partitionBy("length", "salt").orderBy("doc_id", "start", "ids_crc32")
    ranked = salted.withColumn("rank", F.row_number().over(order) - 1).join(bases, ["length", "salt"]).withColumn("rank", F.col("rank") + F.col("base"))
    columns = [f.split()[0] for f in PIECE.split(", ")] + ["ids"] * with_ids

    def make():
        import numpy as np

        def f(batch):
            lengths = batch.column("length").to_numpy()
            ranks = batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(ranks), "<i8"), np.zeros(len(ranks), "<i8")
            for k in np.unique(lengths):
                first, seq, off = shared.value[int(k)]
                at = np.flatnonzero(lengths == k)
                i = np.searchsorted(first, ranks[at], "right") - 1
                sequence[at] = seq[i] + ranks[at] - first[i]
                offset[at] = off[i]
            return {**{c: batch.column(c) for c in columns}, "sequence_id": sequence, "offset": offset}

        return f

    return map_arrow(ranked.select(*columns, "rank"), PIECE + ", ids binary" * with_ids + ", sequence_id long, offset long", make, rows=10_000)


def query(spark, sf_dir: str) -> DataFrame:
    from chartloom.llm.common import table

    packed = pack(table(spark, sf_dir, "documents"))
    return packed.select("doc_id", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "doc_tokens", "sequence_id", "offset")
