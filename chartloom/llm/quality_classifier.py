"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

A document's features are its words (small letters, hashed to ``2 ** bits``
numbers, weighted by log counts of unit length), statistics of its structure
(each cut into bins, one feature a bin) and metadata: its length as the table
gives it (``n_chars``), binned. The score is

    sigmoid(b + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j)

whose pair term is half of sum_f ((sum_i v_if x_i) ** 2 - sum_i (v_if x_i) ** 2),
so scoring is linear in the number of features. Words of the whole text count;
nothing shuffles, and each distinct word of a batch is hashed once.

Weights are learned by adaptive gradient steps on a bounded sample: the
``sample_docs`` labelled documents of least hash, all of their text.

Edge cases: a null text counts as empty; an empty text gets the score of its
structure and metadata alone. Null labels are left out; a document with several
labels counts with the least. Without any label the score is 0.5. Ties cannot
matter, as each row is scored alone. Other columns are left out.
"""

from __future__ import annotations

import re
import zlib
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.llm.common import held_out, kept, map_arrow
from chartloom.llm.tokens import CODE, WordTable

_WORD = re.compile(r"[^\W\d_]+|\d|[^\w\s]+|_+")
#: Structure statistics in order, each with the borders of its bins (fixed values); metadata last.
BINS = (
    ("log_words", (1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 12, 14)),
    ("chars_per_word", (2, 3, 4, 5, 6, 7, 8, 10, 14, 20)),
    ("upper_share", (0.001, 0.01, 0.03, 0.05, 0.1, 0.2, 0.4, 0.7)),
    ("digit_share", (0.001, 0.01, 0.05, 0.1, 0.2, 0.4)),
    ("mark_share", (0.005, 0.01, 0.02, 0.03, 0.05, 0.08, 0.12, 0.2, 0.4)),
    ("words_per_line", (1, 2, 4, 8, 16, 32, 64, 128, 256)),
    ("distinct_share", (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9)),
    ("repeated_line_share", (0.01, 0.1, 0.2, 0.3, 0.5, 0.8)),
    ("log_n_chars", (1, 2, 4, 6, 7, 8, 9, 10, 11, 12, 13, 14, 16)),
)
_STRIDE = 16


class Model(NamedTuple):
    bits: int
    bias: float
    w: np.ndarray
    v: np.ndarray


def n_features(bits: int) -> int:
    return (1 << bits) + _STRIDE * len(BINS)


def word_feature(word: bytes, bits: int) -> int:
    return zlib.crc32(word) & ((1 << bits) - 1)


def structure(text: str, n_words: int, n_distinct: int, n_chars: int | None, bits: int) -> list[int]:
    """One feature for each statistic: the bin that it falls into."""
    size = max(1, len(text))
    raw = text.encode("latin-1", "replace")
    kinds = np.bincount(_KIND[np.frombuffer(raw, "u1")], minlength=4)
    lines = [x for x in text.split("\n") if x.strip()]
    values = (
        np.log2(1 + n_words),
        kinds[:3].sum() / max(1, n_words) if n_words else 0,
        kinds[0] / size,
        kinds[1] / size,
        kinds[2] / size,
        n_words / max(1, len(lines)),
        n_distinct / max(1, n_words),
        1 - len(set(lines)) / len(lines) if lines else 0,
        -1 if n_chars is None else np.log2(1 + max(0, n_chars)),
    )
    base = 1 << bits
    return [base + _STRIDE * i + int(np.searchsorted(borders, v, "right")) for i, ((_, borders), v) in enumerate(zip(BINS, values, strict=True))]


def _kinds() -> np.ndarray:
    """0 capital, 1 digit, 2 mark, 3 other character, by Latin-1 byte."""
    out = np.full(256, 3, "u1")
    for i in range(256):
        c = chr(i)
        out[i] = 0 if c.isupper() else 1 if c.isdigit() else 2 if not c.isalnum() and not c.isspace() else 3
    return out


_KIND = _kinds()


class Features(WordTable):
    """Sparse features of documents; a word's hash is kept by its number in the table."""

    def __init__(self, bits: int, limit: int = 500_000):
        super().__init__(limit, True)
        self.bits = bits
        self.clear()

    def clear(self) -> None:
        super().clear()
        self.hashed = np.zeros(self.limit + 1, "i4")

    def _keep(self, words: list[str]) -> None:
        size = self.table.size
        self.hashed[size : size + len(words)] = [word_feature(w.encode(), self.bits) for w in words]

    def rows(self, texts: list[str], n_chars: list[int | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(features, values) of each document."""
        hashed: list[np.ndarray] = [np.zeros(0, "i4")] * len(texts)
        for group, apart in self.groups(texts):
            words = self.split([t for _, t in group])
            numbers = self.numbers(words)
            found = self.hashed[numbers]
            for i in np.flatnonzero(numbers < 0).tolist():
                found[i] = word_feature(words.word(i).decode(CODE).encode(), self.bits)
            for d, (i, _) in enumerate(group):
                hashed[i] = found[words.first[d] : words.first[d + 1]]
            for i in apart:
                hashed[i] = np.array([word_feature(w.encode(), self.bits) for w in _WORD.findall(texts[i].lower())], "i4")
        out = []
        for text, h, n in zip(texts, hashed, n_chars, strict=True):
            features, counts = np.unique(h, return_counts=True)
            values = np.log1p(counts)
            values /= max(1e-9, np.sqrt((values**2).sum()))
            own = structure(text, len(h), len(features), n, self.bits)
            out.append((np.concatenate([features, own]).astype("i4"), np.concatenate([values, np.full(len(own), len(own) ** -0.5)]).astype("f4")))
        return out


def margins(model: Model, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Scores before the sigmoid, by the sum-of-squares identity."""
    if not rows:
        return np.zeros(0)
    ends = np.cumsum([0, *(len(f) for f, _ in rows)])[:-1]
    f, x = np.concatenate([f for f, _ in rows]), np.concatenate([x for _, x in rows])
    vx = model.v[f] * x[:, None]
    sums, squares = np.add.reduceat(vx, ends, 0), np.add.reduceat(vx**2, ends, 0)
    return model.bias + np.add.reduceat(model.w[f] * x, ends) + 0.5 * (sums**2 - squares).sum(1)


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: list[int], bits: int, rank: int = 8, rounds: int = 8, rate: float = 0.2, decay: float = 1e-4) -> Model:
    """Logistic loss, one adaptive step for each document and round, in a fixed shuffled order."""
    rng = np.random.default_rng(7)
    n = n_features(bits)
    w, v = np.zeros(n), rng.normal(0, 0.02, (n, rank))
    gw, gv, gb = np.full(n, 1e-3), np.full((n, rank), 1e-3), 1e-3
    share = min(0.999, max(0.001, float(np.mean(labels)))) if labels else 0.5
    b = float(np.log(share / (1 - share)))
    for _ in range(rounds if labels else 0):
        for i in rng.permutation(len(rows)):
            f, x = rows[i][0], rows[i][1].astype("f8")
            vf = v[f]
            s = x @ vf
            z = b + w[f] @ x + 0.5 * ((s**2).sum() - ((vf * x[:, None]) ** 2).sum())
            g = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[i]
            dw = g * x + decay * w[f]
            dv = g * (x[:, None] * s - vf * (x**2)[:, None]) + decay * vf
            gb += g * g
            gw[f] += dw**2
            gv[f] += dv**2
            b -= rate * g / np.sqrt(gb)
            w[f] -= rate * dw / np.sqrt(gw[f])
            v[f] -= 0.5 * rate * dv / np.sqrt(gv[f])
    return Model(bits, b, w.astype("f4"), v.astype("f4"))


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", sample_docs: int = 6000, bits: int = 14) -> Model:
    """A model from (doc_id, text, n_chars) and (doc_id, label)."""
    known = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min(label).alias("label"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs)

    def make():
        table = Features(bits)

        def f(batch):
            rows = table.rows([t or "" for t in batch.column("text").to_pylist()], batch.column("n_chars").to_pylist())
            return {"label": batch.column("label"), "f": [f.tobytes() for f, _ in rows], "x": [x.tobytes() for _, x in rows]}

        return f

    # sample_docs rows at most: rows that repeat a doc_id are one, that of the least text
    own = docs.join(F.broadcast(sample), "doc_id").groupBy("doc_id", F.col("label").cast("int").alias("label")).agg(F.min(F.struct("text", "n_chars")).alias("d"))
    # for each, at most one number and weight for each hashed word
    got = map_arrow(own.select("label", "d.text", "d.n_chars"), "label int, f binary, x binary", make).collect()
    got.sort(key=lambda r: (r.label, bytes(r.f), bytes(r.x)))
    rows = [(np.frombuffer(bytes(r.f), "i4"), np.frombuffer(bytes(r.x), "f4")) for r in got]
    return fit(rows, [int(r.label > 0) for r in got], bits)


def predict(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """(*keep, score) of (text, n_chars) rows; keep is doc_id by default, and a column score in it is replaced."""
    keep = ["doc_id"] if keep is None else [c for c in keep if c != "score"]
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size
    rows = docs.select(*keep, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("__text"), F.col("n_chars").cast("long").alias("__n"))
    schema = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes if not c.startswith("__")) + ", score double"

    def make():
        table = kept("features", shared.value, lambda model: Features(model.bits))

        def f(batch):
            z = margins(shared.value, table.rows(batch.column("__text").to_pylist(), batch.column("__n").to_pylist()))
            return {**{c: batch.column(c) for c in keep}, "score": 1 / (1 + np.exp(-np.clip(z, -30, 30)))}

        return f

    return map_arrow(rows, schema, make)


def query(spark, sf_dir: str) -> DataFrame:
    from chartloom.llm.common import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    model = learn(docs, labels.filter(~held_out()))
    scored = predict(docs, model)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
