"""Near-duplicate documents: consistent weighted sampling over TF-IDF shingles, banded and verified.

1. Shingles are five words in a row (words: runs without white space, in small
   letters; a text of fewer words is one shingle). A shingle's hash has 32
   bits. Its weight is its count in the document times a smoothed inverse
   document frequency, 1 + GAIN * log((N + 1) / (df + 1)) / log(N + 2), between 1
   and 1 + GAIN, where df counts over all documents, by hashing into
   ``2 ** BUCKET_BITS`` counters (a table of fixed size; shingles that share a
   counter share its df, so far above a million distinct shingles rarity tells
   less and less). The same shingle has the same weight in every document. As
   weights differ by the factor 1 + GAIN at most, two texts of plain similarity
   s have a weighted one of s / (s + (1 + GAIN) (1 - s)) or more in every corpus:
   none above 0.82 falls below 0.8. An unbounded idf would part a large group of
   copies: what they share is frequent because of the group.
2. Improved consistent weighted sampling draws ``BANDS * ROWS`` samples of each
   document; two documents agree in one with the probability of their weighted
   Jaccard similarity. Rows of samples are hashed into bands. At similarity 0.8
   a pair shares a band with probability 0.998.
3. Equal texts are one node from here on. Documents that share a band key are
   candidates. Each key's first member by a hash that differs for each band (its
   pivot) is paired with all others, so a document meets up to BANDS different
   pivots, and a group of n copies costs n pairs for each band.
4. Pairs are verified by their exact weighted Jaccard similarity (0.8 or more).
   Pairs whose samples agree in less than ``least - 0.2`` of all are not: that is
   four and a half standard errors below, so of a million pairs at 0.8 some three
   are lost. Links become classes by rounds of large and small stars over one
   spanning forest for each task; later links are first contracted to the classes
   that they join.
5. Keys of three members or more that are then in several classes are looked at
   again: all pairs of different classes if they have SMALL members at most, else
   their members with a second pivot.
6. What is still mixed after that is compared whole: in each key of more than
   SMALL members, those outside its largest class with all others of other
   classes, in blocks (products of matrices). So each pair that shares a band is
   in one class or was compared. What is moved grows with the number of blocks.

What is counted for each key or class (its pivot, its size, its first row) is staged before the rows are joined with it:
Spark splits a large key of a join of two plain exchanges (or broadcasts the small side), but not of one that follows an
aggregation by the same key. So a key that a third of all rows share is no single task.

Result: one row for each input row with its text's digest, its class (the least
doc_id in it), and whether it is the one row of the class to keep.

Edge cases: a null text has no class but its own, and so has a null doc_id
(class null). Texts without a word are copies of each other only if equal.
Rows that repeat a doc_id with the same text are copies; with other texts each
row has the class of its own text, and each class keeps a row. An empty table
gives no row. Other columns are left out. Long texts are sampled in slices, whole.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chartloom.llm.common import bound_batches, kept, map_arrow, release, stage
from chartloom.llm.tokens import Words

SHINGLE = 5
BUCKET_BITS = 20
#: How far rarity raises a weight.
GAIN = 0.125
BANDS, ROWS = 16, 5
#: Keys of so many members have all their pairs listed; those of larger ones are compared in blocks.
SMALL = 6
#: Nodes, and bytes of their shingles, that are compared at once with as many others.
BLOCK, BLOCK_BYTES = 512, 4 << 20
_TABLE_BITS = 16


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Runs(Words):
    """Words of texts in UTF-8: runs without white space."""

    def __init__(self, texts: list[bytes]):
        self.raw = raw = np.frombuffer(b" ".join([b"", *texts, b" " * 24]), "u1")
        space = (raw == 0x20) | ((raw >= 9) & (raw <= 13))
        edge = np.flatnonzero(space[1:] != space[:-1]) + 1  # the first byte is a space, and so is the last
        self.start, self.length = edge[::2], edge[1::2] - edge[::2]
        sizes = np.fromiter(map(len, texts), "i8", len(texts))
        self.first = np.searchsorted(self.start, np.concatenate([[1], 1 + np.cumsum(sizes + 1)]))

    def hashes(self) -> np.ndarray:
        low, high = self.keys()
        h = _mix(low + np.uint64(0x9E3779B97F4A7C15)) ^ (high * np.uint64(0xD6E8FEB86659FD93)) ^ self.length.astype("<u8")
        for i in np.flatnonzero(self.length > 16).tolist():
            h[i] = int.from_bytes(hashlib.blake2b(self.word(i), digest_size=8).digest(), "little")
        return _mix(h)


def shingles(texts: list[str], size: int = SHINGLE) -> list[tuple[np.ndarray, np.ndarray]]:
    """(hashes ascending, counts) of each text's shingles."""
    words = Runs([t.lower().encode("utf-8", "surrogatepass") for t in texts])
    h = words.hashes()
    n = len(h)
    rolled = np.zeros(max(0, n - size + 1), "<u8")
    for k in range(size):
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + h[k : k + len(rolled)]
    rolled = (_mix(rolled) >> np.uint64(32)).astype("<u4")
    out = []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        if b - a >= size:
            own = np.sort(rolled[a : b - size + 1])
        elif b > a:
            one = b - a
            for x in h[a:b].tolist():
                one = (one * 0x9E3779B97F4A7C15 + x) & 0xFFFFFFFFFFFFFFFF
            own = (_mix(np.array([one], "<u8")) >> np.uint64(32)).astype("<u4")
        else:
            own = np.zeros(0, "<u4")
        if len(own) > 1:
            cut = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            out.append((own[cut], np.diff(cut, append=len(own))))
        else:
            out.append((own, np.ones(len(own), "i8")))
    return out


def smooth_idf(df: np.ndarray, n: int, gain: float = GAIN) -> np.ndarray:
    """Between 1 (in all of n documents) and about 1 + gain (in one)."""
    return (1 + gain * np.log((n + 1) / (np.minimum(df, n) + 1)) / np.log(n + 2)).astype("f4")


def frequency_weights(docs: DataFrame) -> tuple[np.ndarray, int]:
    """The smoothed idf of each counter, and the number of documents, over all documents."""
    pieces = 64
    width = (1 << BUCKET_BITS) // pieces

    def count(batches):
        import pyarrow as pa

        df, n = np.zeros(1 << BUCKET_BITS, "<u4"), 0
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                texts = [t for t in batch.column(0).slice(at, 128).to_pylist() if t is not None]
                n += len(texts)
                own = [h for h, _ in shingles(texts)]
                if own:
                    df += np.bincount(np.concatenate(own) >> np.uint32(32 - BUCKET_BITS), minlength=len(df)).astype("<u4")
        if n:
            import zlib

            parts = [zlib.compress(df[i * width : (i + 1) * width].tobytes(), 1) for i in range(pieces)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(-1, pieces), pa.int32()), pa.array([n.to_bytes(8, "little"), *parts], pa.binary())], names=["piece", "counts"]
            )

    def add(batches):
        import zlib

        import pyarrow as pa

        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for piece, counts in zip(batch.column("piece").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                own = np.frombuffer(counts, "<i8") if piece < 0 else np.frombuffer(zlib.decompress(counts), "<u4").astype("<i8")
                total[piece] = total[piece] + own if piece in total else own
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], names=["piece", "counts"])

    bound_batches(docs.sparkSession)
    schema = "piece int, counts binary"
    got = docs.select("text").mapInArrow(count, schema).repartition(16, "piece").mapInArrow(add, schema).collect()  # 65 rows, 8 MB
    df, n = np.zeros(1 << BUCKET_BITS, "i8"), 0
    for r in got:
        own = np.frombuffer(bytes(r.counts), "<i8")
        if r.piece < 0:
            n = int(own[0])
        else:
            df[r.piece * width : (r.piece + 1) * width] = own
    return smooth_idf(df, n), n


class Sampler:
    """Improved consistent weighted sampling: the random numbers of a (shingle, sample) come from a hash into fixed tables."""

    def __init__(self, idf: np.ndarray, samples: int = BANDS * ROWS):
        rng = np.random.default_rng(20)
        size = 1 << _TABLE_BITS
        self.idf = idf
        self.r = rng.gamma(2.0, 1.0, size).astype("f4")
        self.beta = rng.random(size).astype("f4")
        self.log_c = np.log(rng.gamma(2.0, 1.0, size)).astype("f4")
        self.odd = (rng.integers(0, 1 << 62, samples).astype("<u8") << np.uint64(1)) | np.uint64(1)
        self.band = rng.integers(0, 1 << 62, (BANDS, ROWS)).astype("<u8") | np.uint64(1)

    def weights(self, h: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return counts * self.idf[h >> np.uint32(32 - BUCKET_BITS)]

    def draw(self, h: np.ndarray, counts: np.ndarray, at_once: int = 1024) -> np.ndarray:
        """One 64-bit value for each sample."""
        k = len(self.odd)
        best, value = np.full(k, np.inf, "f4"), np.zeros(k, "<u8")
        wide = h.astype("<u8") * np.uint64(0x9E3779B97F4A7C15)
        log_w = np.log(self.weights(h, counts)).astype("f4")
        for at in range(0, len(h), at_once):
            part = wide[at : at + at_once]
            i = ((part[:, None] * self.odd) >> np.uint64(64 - _TABLE_BITS)).astype("i4")
            r, beta = self.r[i], self.beta[i]
            t = np.floor(log_w[at : at + at_once, None] / r + beta)
            a = self.log_c[i] - r * (t - beta + 1)
            top = a.argmin(0)
            low = a[top, np.arange(k)]
            better = low < best
            new = _mix(part[top] ^ (t[top, np.arange(k)].astype("i8").astype("<u8") * np.uint64(0xD6E8FEB86659FD93)))
            best, value = np.where(better, low, best), np.where(better, new, value)
        return value

    def bands(self, value: np.ndarray) -> np.ndarray:
        return _mix((value.reshape(BANDS, ROWS) * self.band).sum(1, dtype="<u8") + np.arange(BANDS, dtype="<u8")).view("<i8")

    def similarity(self, a, b) -> float:
        """Weighted Jaccard similarity of two (hashes, counts)."""
        wa, wb = self.weights(*a).astype("f8"), self.weights(*b).astype("f8")
        _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
        both = np.minimum(wa[i], wb[j]).sum()
        return float(both / max(1e-300, wa.sum() + wb.sum() - both))


def digest_of(text: str = "text"):
    """16 bytes that name a text; none for a null."""
    return F.coalesce(F.substring(F.unhex(F.sha2(F.col(text), 256)), 1, 16), F.lit(b""))


def signatures(docs: DataFrame, idf) -> DataFrame:
    """(doc_id, digest, bands, signature, hashes, counts): the last four are null for a text without words, and may be for one that came before in
    the same task; counts is empty if all are one."""

    def make():
        sampler = kept("sampler", idf.value, Sampler)
        before: set[bytes] = set()

        def f(batch):
            digests = batch.column("digest").to_pylist()
            if len(before) > 1 << 16:
                before.clear()
            new = [i for i, d in enumerate(digests) if not (d in before or before.add(d))]
            out = {c: [None] * len(digests) for c in ("bands", "signature", "hashes", "counts")}
            texts = batch.column("text")
            for i, (h, counts) in zip(new, shingles([texts[i].as_py() for i in new]), strict=True):
                if len(h):
                    value = sampler.draw(h, counts)
                    own = (sampler.bands(value).tolist(), value.astype("<u2").tobytes(), h.tobytes(), b"" if (counts == 1).all() else counts.astype("<u4").tobytes())
                    for c, v in zip(out, own, strict=True):
                        out[c][i] = v
            return {"doc_id": batch.column("doc_id"), "digest": digests} | out

        return f

    schema = "doc_id long, digest binary, bands array<long>, signature binary, hashes binary, counts binary"
    return map_arrow(docs.withColumn("digest", digest_of()), schema, make, rows=128)


def likely(pairs: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b) whose samples agree in ``least`` of all or more."""

    def make():
        def f(batch):
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(batch.num_rows, -1) for c in ("sa", "sb"))
            keep = np.flatnonzero((a == b).mean(1) >= least)
            return {"a": batch.column("a").take(keep), "b": batch.column("b").take(keep)}

        return f

    own = nodes.select("node", "signature")
    both = pairs.join(own.select(F.col("node").alias("a"), F.col("signature").alias("sa")), "a")
    both = both.join(own.select(F.col("node").alias("b"), F.col("signature").alias("sb")), "b")
    return map_arrow(both, "a long, b long", make, rows=4096)


def verified(pairs: DataFrame, sets: DataFrame, idf, least: float) -> DataFrame:
    """Pairs (a, b) whose weighted Jaccard similarity is ``least`` or more."""

    def unpack(h, c):
        h = np.frombuffer(h, "<u4")
        return h, np.frombuffer(c, "<u4") if c else np.ones(len(h), "<u4")

    def make():
        sampler = kept("sampler", idf.value, Sampler)

        def f(batch):
            a, b, ha, ca, hb, cb = (batch.column(c).to_pylist() for c in ("a", "b", "ha", "ca", "hb", "cb"))
            keep = [i for i in range(len(a)) if sampler.similarity(unpack(ha[i], ca[i]), unpack(hb[i], cb[i])) >= least]
            return {"a": [a[i] for i in keep], "b": [b[i] for i in keep]}

        return f

    one = lambda x: sets.select(F.col("node").alias(x), F.col("hashes").alias(f"h{x}"), F.col("counts").alias(f"c{x}"))
    return map_arrow(pairs.join(one("a"), "a").join(one("b"), "b"), "a long, b long", make, rows=256)


def forest(links: DataFrame, most: int = 1 << 20) -> DataFrame:
    """(u, v) of links (a, b): those of each task as stars around the least node, for some ``most`` nodes at a time."""

    def run(batches):
        import pyarrow as pa

        parent: dict[int, int] = {}

        def find(x):
            while (p := parent.setdefault(x, x)) != x:
                parent[x] = x = parent[p]
            return x

        def stars():
            ends = [(u, find(u)) for u in list(parent)]
            ends = [(u, v) for u, v in ends if u != v]
            parent.clear()
            return pa.RecordBatch.from_arrays([pa.array([e[i] for e in ends], pa.int64()) for i in (0, 1)], names=["u", "v"])

        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                a, b = find(a), find(b)
                if a != b:
                    parent[max(a, b)] = min(a, b)
            if len(parent) > most:
                yield stars()
        if parent:
            yield stars()

    return links.select("a", "b").mapInArrow(run, "u long, v long")


def _are_stars(edges: DataFrame) -> bool:
    """Whether each node has one centre, and no centre another."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("n"), F.col("v").alias("c")), F.struct(F.col("v").alias("n"), F.lit(None).cast("long").alias("c")))).alias("e"))
    seen = ends.groupBy("e.n").agg(F.min("e.c").alias("low"), F.max("e.c").alias("high"), F.count("e.c").alias("children"), F.count("*").alias("all"))
    return seen.filter("low != high OR (children > 0 AND children < all)").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, class): the least node of each component, for all its nodes but that one. Links are (a, b)."""
    edges = stage(forest(links), "edges")
    while not _are_stars(edges):
        # large star: each node's larger neighbours go to its least neighbour
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct()
        least = stage(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # small star: each node's smaller neighbours and itself go to its least neighbour
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
        edges = stage(forest(small.filter("a != b").distinct()), "edges")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("class")).distinct()


def _with_class(members: DataFrame, classes: DataFrame) -> DataFrame:
    return members.join(classes, "node", "left").withColumn("class", F.coalesce("class", "node"))


def met_pivots(members: DataFrame, seed: int = 1, one_order: bool = False) -> DataFrame:
    """(node, pivot): the pivot of each member's key. members: (band, key, node).

    The pivot is first in an order that differs for each band, or, with one_order, is the same for all: then the keys that
    a group of copies shares have few pivots, and the group few pairs.
    """
    spread = F.xxhash64("node", F.lit(seed)) if one_order else F.xxhash64("node", "band", F.lit(seed))
    pivot = members.groupBy("band", "key").agg(F.min_by("node", spread).alias("pivot"), F.count("*").alias("n")).filter("n > 1")
    return members.join(stage(pivot.select("band", "key", "pivot"), "pivots"), ["band", "key"]).filter("node != pivot").select("node", "pivot")


def as_pairs(met: DataFrame) -> DataFrame:
    return met.select(F.greatest("node", "pivot").alias("a"), F.least("node", "pivot").alias("b")).distinct()


def mixed(members: DataFrame, classes: DataFrame) -> DataFrame:
    """Members (band, key, node, class) of the keys of three members or more that span several classes; the pair of a key of two was tested."""
    labelled = _with_class(members, classes)
    several = labelled.groupBy("band", "key").agg(F.min("class").alias("x"), F.max("class").alias("y"), F.count("*").alias("n")).filter("x != y AND n > 2")
    return labelled.join(stage(several.select("band", "key"), "several"), ["band", "key"], "left_semi")


def second_pairs(left: DataFrame, small: int = SMALL) -> DataFrame:
    """Pairs of members of different classes: all of them for small keys, those with another pivot for others."""
    spread = F.xxhash64("node", "band", F.lit(2))
    own = F.struct("node", "class")
    keys = stage(left.groupBy("band", "key").agg(F.count("*").alias("n"), F.min_by(own, spread).alias("o")), "seconds")
    sized = left.join(keys, ["band", "key"])
    few = sized.filter(F.col("n") <= small).drop("o")
    every = few.groupBy("band", "key").agg(F.collect_list(own).alias("os"))  # small members at most
    # each pair once: from its greater node
    listed = few.join(every, ["band", "key"]).select("node", "class", F.explode(F.filter("os", lambda o: (o["node"] < F.col("node")) & (o["class"] != F.col("class")))).alias("o"))
    pairs = sized.filter((F.col("n") > small) & (F.col("class") != F.col("o.class"))).select("node", "class", "o").unionByName(listed)
    return pairs.select(F.greatest("node", "o.node").alias("a"), F.least("node", "o.node").alias("b")).distinct()


def in_blocks(left: DataFrame, payload: DataFrame, columns: list[str], compare, small: int = SMALL, block: int = BLOCK) -> DataFrame:
    """Links (a, b) between members of different classes of keys of more than ``small`` members: all that join classes.

    left: (band, key, node, class). payload: (node, *columns), binary. Those outside a key's largest class meet all its
    members, in blocks of about ``block`` nodes or BLOCK_BYTES: what is moved grows with the number of blocks, not of pairs.
    compare(rows, others) of two dicts of columns gives (i, j, test) of pairs that may be links; test() tells, and is asked
    only while links found in the same block have not joined both classes already.
    """

    def links(table):
        import pyarrow as pa

        side, node, label = (table.column(c).to_numpy() for c in ("side", "node", "class"))
        ia, ib = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        a, b = [], []
        if len(ia) and len(ib) and not (label == label[0]).all():
            own = {c: table.column(c).to_pylist() for c in columns}
            parent = {c: c for c in label.tolist()}

            def find(c):
                while parent[c] != c:
                    parent[c] = c = parent[parent[c]]
                return c

            part = lambda at: {c: [own[c][i] for i in at] for c in columns} | {"class": label[at]}
            for i, j, test in compare(part(ia), part(ib)):
                x, y = int(ia[i]), int(ib[j])
                p, q = find(int(label[x])), find(int(label[y]))
                if p != q and test():
                    parent[max(p, q)] = min(p, q)
                    a.append(max(node[x], node[y]))
                    b.append(min(node[x], node[y]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    size = sum(F.length(c) for c in columns)
    large = stage(left.groupBy("band", "key").agg(F.count("*").alias("n")).filter(F.col("n") > small).select("band", "key"), "large")
    whole = left.join(large, ["band", "key"], "left_semi")
    whole = stage(whole.join(payload.withColumn("size", size), "node"), "blocks")
    parts = lambda n, size: F.ceil(F.greatest(n / block, size / BLOCK_BYTES)).cast("int")
    of_class = whole.groupBy("band", "key", "class").agg(F.count("*").alias("n"), F.sum("size").alias("size"))
    keys = of_class.groupBy("band", "key").agg(F.sum("n").alias("n"), F.sum("size").alias("s"), F.max(F.struct("n", "class", "size")).alias("most"))
    keys = keys.select("band", "key", F.col("most.class").alias("most"), parts(F.col("n") - F.col("most.n"), F.col("s") - F.col("most.size")).alias("few"), parts(F.col("n"), F.col("s")).alias("all"))
    sized = whole.join(stage(keys, "parts"), ["band", "key"])
    spread = F.xxhash64("node", F.lit(3))
    kept_ = ["band", "key", "node", "class", *columns]
    one = sized.filter("class != most").select(*kept_, F.lit(0).alias("side"), F.pmod(spread, F.col("few")).alias("i"), F.explode(F.sequence(F.lit(0), F.col("all") - 1)).alias("j"))
    two = sized.select(*kept_, F.lit(1).alias("side"), F.pmod(spread, F.col("all")).alias("j"), F.explode(F.sequence(F.lit(0), F.col("few") - 1)).alias("i"))
    both = one.withColumn("i", F.col("i").cast("int")).unionByName(two.withColumn("j", F.col("j").cast("int")))
    return both.groupBy("band", "key", "i", "j").applyInArrow(links, "a long, b long").distinct()


def block_pairs(left: DataFrame, sets: DataFrame, idf, least: float, small: int = SMALL, block: int = BLOCK) -> DataFrame:
    """Links (a, b) of large keys that stayed mixed. A block's similarities are one product of matrices; those near ``least`` or above
    it are computed once more as ``verified`` does.
    """

    def compare(one: dict, two: dict):
        sampler = kept("sampler", idf.value, Sampler)
        sets_ = []
        for x in (one, two):
            hashes = [np.frombuffer(h, "<u4") for h in x["hashes"]]
            sets_.append([(h, np.frombuffer(c, "<u4") if c else np.ones(len(h), "<u4")) for h, c in zip(hashes, x["counts"], strict=True)])
        total = [np.array([sampler.weights(*x).sum(dtype="f8") for x in own]) for own in sets_]
        both = common_weight(*sets_, sampler.idf)
        alike = both >= (least - 1e-3) * (total[0][:, None] + total[1][None, :] - both)
        for i, j in zip(*np.nonzero(alike & (one["class"][:, None] != two["class"][None, :])), strict=True):
            yield i, j, lambda a=sets_[0][i], b=sets_[1][j]: sampler.similarity(a, b) >= least

    return in_blocks(left, sets.select("node", "hashes", "counts"), ["hashes", "counts"], compare, small, block)


def common_weight(rows: list, columns: list, idf: np.ndarray, at_once: int = 1024) -> np.ndarray:
    """The weight that each of some (hashes, counts) shares with each of others: the sum of the lesser of both weights."""
    out = np.zeros((len(rows), len(columns)), "f8")

    def units(sets):  # the k-th occurrence of a shingle is an element of its own
        h = np.concatenate([x for x, _ in sets])
        c = np.concatenate([x for _, x in sets]).astype("i8")
        own = np.repeat(np.arange(len(sets)), [len(x) for x, _ in sets])
        first = np.cumsum(c) - c
        k = np.arange(c.sum()) - np.repeat(first, c)
        return np.repeat(h, c).astype("<u8") << np.uint64(32) | k.astype("<u8"), np.repeat(own, c)

    (ea, oa), (eb, ob) = units(rows), units(columns)
    every = np.intersect1d(ea, eb)
    pa, pb = np.searchsorted(every, ea), np.searchsorted(every, eb)
    for e, p in ((ea, pa), (eb, pb)):
        p[(p == len(every)) | (every[np.minimum(p, len(every) - 1)] != e if len(every) else True)] = -1
    for at in range(0, len(every), at_once):
        part = every[at : at + at_once]
        x, y = np.zeros((len(rows), len(part)), "f4"), np.zeros((len(columns), len(part)), "f4")
        for m, o, p in ((x, oa, pa), (y, ob, pb)):
            here = (p >= at) & (p < at + len(part))
            m[o[here], p[here] - at] = 1
        out += (x * idf[(part >> np.uint64(64 - BUCKET_BITS)).astype("i8")]) @ y.T
    return out


def shared(members: DataFrame) -> DataFrame:
    """Members of keys that have several."""
    keys = members.groupBy("band", "key").agg(F.count("*").alias("n")).filter("n > 1").select("band", "key")
    return members.join(stage(keys, "keys"), ["band", "key"], "left_semi")


class Links:
    """Classes that follow from links that were verified so far."""

    def __init__(self, spark, verify):
        self.verify = verify
        self.classes = spark.createDataFrame([], "node long, class long")
        self.any = False

    def between(self, pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) of different classes, with these as (ca, cb)."""
        if not self.any:
            return pairs.select("a", "b", F.col("a").alias("ca"), F.col("b").alias("cb"))
        of = lambda x: self.classes.select(F.col("node").alias(x), F.col("class").alias(f"__{x}"))
        both = pairs.join(of("a"), "a", "left").join(of("b"), "b", "left")
        return both.select("a", "b", F.coalesce("__a", "a").alias("ca"), F.coalesce("__b", "b").alias("cb")).filter("ca != cb")

    def test(self, pairs: DataFrame) -> None:
        pairs = stage(self.between(pairs).select("a", "b"), "pairs")
        if not pairs.isEmpty():
            self.add(self.verify(pairs))

    def add(self, links: DataFrame) -> None:
        """Adds links (a, b): contracted to classes, so that only what they join is followed."""
        good = stage(self.between(links).select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct(), "links")
        if good.isEmpty():
            return
        found = components(good)
        if self.any:
            moved = self.classes.join(found.select(F.col("node").alias("class"), F.col("class").alias("to")), "class", "left")
            found = moved.select("node", F.coalesce("to", "class").alias("class")).unionByName(found)
        self.classes, self.any = stage(found, "classes"), True

    def search(self, members: DataFrame, blocks, one_order: bool = False) -> None:
        """Follows all candidates of keys (band, key, node). blocks(left): links of the keys that stay mixed.

        With one_order, each node first meets the pivot that it shares most keys with, and the others only if they are
        in another class then: for nodes of very many keys.
        """
        met = met_pivots(members, one_order=one_order)
        if one_order:
            met = stage(met.groupBy("node", "pivot").agg(F.count("*").alias("n")), "met")
            self.test(as_pairs(met.groupBy("node").agg(F.max_by("pivot", F.struct("n", "pivot")).alias("pivot"))))
        self.test(as_pairs(met))
        left = stage(mixed(members, self.classes), "mixed")
        if left.isEmpty():
            return
        self.test(second_pairs(left))
        self.add(blocks(mixed(left.select("band", "key", "node"), self.classes)))


def classes_of(docs: DataFrame, least: float = 0.8) -> DataFrame:
    """(doc_id, digest, class_id, is_first) of (doc_id, text) rows."""
    spark = docs.sparkSession
    release(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    idf, _ = frequency_weights(docs)
    idf_ = spark.sparkContext.broadcast(idf)  # 4 MB, whatever the corpus
    named = docs.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    signed = stage(signatures(named, idf_), "signatures")
    some = lambda c: F.first(c, ignorenulls=True).alias(c)
    # the numbers of the nodes hold as the table is written once
    texts = stage(signed.groupBy("digest").agg(some("bands"), some("signature")).withColumn("node", F.monotonically_increasing_id()), "texts")
    worded = texts.filter(F.col("bands").isNotNull())
    nodes = worded.select("node", "signature")
    members = stage(shared(worded.select("node", F.posexplode("bands").alias("band", "key"))), "members")
    # Shingles of the nodes that share a key. The join is of one kind at every size, so that what it moves grows with the input.
    wanted = texts.select("digest", "node").join(members.select("node").distinct(), "node", "left_semi").hint("merge")
    sets = signed.filter(F.col("hashes").isNotNull()).select("digest", "hashes", "counts").join(wanted, "digest")
    sets = stage(sets.groupBy("digest", "node").agg(some("hashes"), some("counts")).drop("digest"), "sets")
    links = Links(spark, lambda pairs: verified(stage(likely(pairs, nodes, least - 0.2), "likely"), sets, idf_, least))
    links.search(members, lambda left: block_pairs(left, sets, idf_, least))

    per_text = texts.join(links.classes, "node", "left").select("digest", F.coalesce("class", "node").alias("class"))
    rows = stage(signed.groupBy("doc_id", "digest").agg(F.count("*").alias("n")).join(per_text, "digest"), "rows")
    idf_.destroy()
    release(spark)
    head = stage(rows.groupBy("class").agg(F.min(F.struct("doc_id", "digest")).alias("head")), "heads")
    found = rows.join(head, "class").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    first = (F.col("doc_id") == F.col("head.doc_id")) & (F.col("digest") == F.col("head.digest")) & (F.col("copy") == 1)
    found = found.select("doc_id", "digest", F.col("head.doc_id").alias("class_id"), first.alias("is_first"))
    alone = docs.filter(F.col("doc_id").isNull() | F.col("text").isNull())
    return found.unionByName(alone.select("doc_id", digest_of().alias("digest"), F.col("doc_id").alias("class_id"), F.lit(True).alias("is_first")))


def first_rows(docs: DataFrame, least: float = 0.8) -> DataFrame:
    """The rows of docs that stay: one of each class, with all their columns; rows without a doc_id stay."""
    first = classes_of(docs, least).filter("is_first AND doc_id IS NOT NULL").select("doc_id", F.col("digest").alias("__digest")).distinct()
    key = ["doc_id", "__digest"]
    named = docs.filter(F.col("doc_id").isNotNull()).withColumn("__digest", digest_of()).join(first.hint("merge"), key, "left_semi")
    # Rows that repeat both are copies, and the least of the other columns stays. The join has brought them together, so texts move once.
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*[c for c in docs.columns if c not in ("doc_id", "text")], "__digest"))
    return named.withColumn("__r", rank).filter("__r = 1").drop("__r", "__digest").unionByName(docs.filter(F.col("doc_id").isNull()))


def query(spark, sf_dir: str) -> DataFrame:
    from chartloom.llm.common import table

    return classes_of(table(spark, sf_dir, "documents")).drop("digest")
