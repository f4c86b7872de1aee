"""Language identification by unigrams of pieces, summed over all segmentations.

The pieces are those of a fixed public vocabulary that a word in small letters
can hold. A language gives each piece a probability; a word's probability is the
sum over all ways to cut it into pieces of the product of theirs, which the
forward algorithm finds in one pass over the word. Words (runs of letters, in
small letters, with the vocabulary's mark at the start) are independent. The
language of a text is the one with the greatest sum of log-probabilities over
all words of the whole text; ``score`` is its share among the languages.

Probabilities are learned by expectation-maximisation (forward and backward)
on all words of a bounded sample of labelled documents: ``docs_per_language``
documents of each language, those of least hash. Prediction covers every text.

Each distinct word is scored once in a batch and kept in a table of bounded
size, so most words cost one look-up; nothing shuffles.

Edge cases: a null text, or one without a letter, is ``und`` with score 0; so
is every text if no label was learned. Words of more than ``WORD`` characters
are learned and scored in parts of that length, all of them. More than
MOST_LANGUAGES labels are an error. Characters outside the vocabulary have a
small fixed probability. Ties go to the language first in the alphabet. Other
columns of the input are left out, and columns named like the results replaced.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.llm.common import give_back, held_out, kept, least_hashed, map_arrow
from chartloom.llm.tokens import CODE, LETTER, WordTable, classes

PATH = public_tokenizers.path("piece_bpe_32k.model")
WORD = 40
MOST_LANGUAGES = 500
UNKNOWN = 1e-7
FLOOR = 0.02
_LETTERS = re.compile(r"[^\W\d_]+")


class Model(NamedTuple):
    languages: list[str]
    pieces: list[str]
    #: (1 + len(pieces), len(languages)); row 0 is for strings that are no piece
    chance: np.ndarray


def vocabulary(path: str = PATH) -> list[str]:
    """Pieces of the vocabulary that words can be cut into."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    every = (model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)))
    return sorted({p for p in every if not any(c.isdigit() or c.isupper() for c in p) and "▁" not in p[1:]})


_FACTORS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


class Forward:
    """Log-probabilities of words in each language."""

    def __init__(self, pieces: list[str]):
        from chartloom.llm.tokens import Table

        self.longest = max(map(len, pieces), default=1)
        # every prefix of a piece, and 1 + the piece that it is, or 0: what is no prefix needs no longer look
        place = {p: i + 1 for i, p in enumerate(pieces)}
        prefixes = sorted({p[:k] for p in pieces for k in range(1, len(p) + 1)}, key=lambda p: (len(p), p))
        self.piece = np.array([place.get(p, 0) for p in prefixes], "i4")
        self.table = Table(len(prefixes))
        at = 0
        while at < len(prefixes):
            size = len(prefixes[at])
            own = [p for p in prefixes[at:] if len(p) == size]
            grid, keys = self._grid(own, size), np.zeros((2, len(own)), "<u8")
            for k in range(size):
                keys = self._more(keys, grid[:, k])
            self.table.add(keys[0], keys[1])
            at += len(own)

    @staticmethod
    def _grid(words: list[str], width: int) -> np.ndarray:
        """Code points, zero after the end."""
        text = "".join(w.ljust(width, "\0") for w in words)
        return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").reshape(len(words), width).astype("<u8")

    @staticmethod
    def _more(keys: np.ndarray, letter: np.ndarray) -> np.ndarray:
        """Two hashes of 64 bits of strings, after one more character."""
        return np.stack([(k ^ (k >> np.uint64(29))) * f + letter + np.uint64(1) for k, f in zip(keys, _FACTORS, strict=True)])

    def lattice(self, words: list[str]):
        """Arrays (length, numbers): numbers[i, j, k] is 1 + the piece that ends after j + 1 characters and has k + 1, or 0."""
        length = np.fromiter(map(len, words), "i4", len(words))
        width = int(length.max(initial=1))
        grid = self._grid(words, width)
        numbers = np.zeros((len(words), width, min(self.longest, width)), "i4")
        for start in range(width):
            on = np.flatnonzero(length > start)
            keys = np.zeros((2, len(on)), "<u8")
            for k in range(min(self.longest, width - start)):
                keys = self._more(keys, grid[on, start + k])
                found = self.table.find(keys[0], keys[1])
                go = found >= 0
                on, keys, found = on[go], keys[:, go], found[go]
                numbers[on, start + k, k] = self.piece[found]
                more = length[on] > start + k + 1
                on, keys = on[more], keys[:, more]
                if not len(on):
                    break
        return length, numbers

    @staticmethod
    def sums(length, numbers, chance):
        """Forward sums alpha[i, j, language] over the first j characters. chance: a row for each number."""
        n, width, _ = numbers.shape
        alpha = np.zeros((n, width + 1, chance.shape[1]))
        alpha[:, 0] = 1
        for j in range(width):
            rows, ks = np.nonzero(numbers[:, j])
            if len(rows):
                part = alpha[rows, j - ks] * chance[numbers[rows, j, ks]]
                first = np.flatnonzero(np.diff(rows, prepend=-1))
                alpha[rows[first], j + 1] = np.add.reduceat(part, first, axis=0)
            alone = np.flatnonzero((length > j) & (numbers[:, j, 0] == 0))
            alpha[alone, j + 1] += alpha[alone, j] * UNKNOWN
        return alpha

    def score(self, words: list[str], chance: np.ndarray, at_once: int = 3_000) -> np.ndarray:
        """Log-probability of each word (small letters, without the mark) in each language."""
        out = np.zeros((len(words), chance.shape[1]))
        parts, owner = [], []
        for i, w in enumerate(words):
            own = in_parts(w)
            parts += own
            owner += [i] * len(own)
        order = sorted(range(len(parts)), key=lambda i: len(parts[i]))
        for at in range(0, len(order), at_once):
            now = order[at : at + at_once]
            length, numbers = self.lattice([parts[i] for i in now])
            alpha = self.sums(length, numbers, chance)
            np.add.at(out, [owner[i] for i in now], np.log(alpha[np.arange(len(now)), length]))
        return out


def in_parts(word: str) -> list[str]:
    """The word with its mark, in parts of WORD characters."""
    return [f"▁{word}"[at : at + WORD] for at in range(0, len(word) + 1, WORD)]


def fit(counts: dict[str, dict[str, int]], pieces: list[str], rounds: int = 4) -> Model:
    """Piece probabilities of each language from its word counts, by expectation-maximisation."""
    languages = sorted(counts)
    forward, size = Forward(pieces), len(pieces)
    chance = np.zeros((size + 1, len(languages)))
    for c, language in enumerate(languages):
        words = sorted({p for w in counts[language] for p in in_parts(w)}, key=lambda w: (len(w), w))
        n = np.zeros(len(words))
        place = {w: i for i, w in enumerate(words)}
        for w, k in counts[language].items():
            for p in in_parts(w):
                n[place[p]] += k
        lattices = [(at, *forward.lattice(words[at : at + 2000])) for at in range(0, len(words), 2000)]
        # the first probabilities follow how often a piece occurs as a string
        p = np.zeros(size + 1)
        for at, _, numbers in lattices:
            p += np.bincount(numbers.ravel(), np.repeat(n[at : at + len(numbers)], numbers[0].size), size + 1)
        for step in range(rounds + 1):
            p[0] = 0
            p = p / max(p.sum(), 1e-300)
            p[1:] = (1 - FLOOR) * p[1:] + FLOOR / max(1, size)
            if step == rounds:
                break
            seen = np.zeros(size + 1)
            for at, length, numbers in lattices:
                alpha = Forward.sums(length, numbers, p[:, None])[:, :, 0]
                rows, (_, width, most) = np.arange(len(length)), numbers.shape
                beta = np.zeros((len(length), width + 1))
                beta[rows, length] = 1
                for j in range(width - 1, -1, -1):  # from the last character: what ends after j + 1
                    for k in range(min(most, j + 1)):
                        use = p[numbers[:, j, k]]
                        if k == 0:
                            use = np.where(numbers[:, j, 0] > 0, use, UNKNOWN)
                        beta[:, j - k] += np.where(length > j, beta[:, j + 1] * use, 0)
                share = n[at : at + len(length)] / alpha[rows, length]
                for j in range(width):
                    for k in range(min(most, j + 1)):
                        weight = share * alpha[:, j - k] * p[numbers[:, j, k]] * beta[:, j + 1]
                        seen += np.bincount(numbers[:, j, k], np.where(length > j, weight, 0), size + 1)
            p = seen
        chance[:, c] = p
    return Model(languages, pieces, chance)


def learn(
    docs: DataFrame, docs_per_language: int = 500, path: str = PATH
) -> Model:
    """A model from (doc_id, text, lang) rows whose lang is not null."""
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    picked = least_hashed(known.select("doc_id", "lang"), "lang", "doc_id", docs_per_language).distinct()
    sample = known.join(F.broadcast(picked), ["doc_id", "lang"], "left_semi").select("lang", "text")  # docs_per_language ids for each language

    def make():
        from collections import Counter

        def f(batch):
            counts = Counter()
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                counts.update((lang, w) for w in _LETTERS.findall(text.lower()))
            return {"lang": [k for k, _ in counts], "word": [w for _, w in counts], "n": list(counts.values())}

        return f

    counts = map_arrow(sample, "lang string, word string, n long", make).groupBy("lang", "word").agg(F.sum("n").alias("n"))
    found: dict[str, dict[str, int]] = {}
    for r in counts.collect():  # the words of docs_per_language documents for each language
        found.setdefault(r.lang, {})[r.word] = r.n
    if len(found) > MOST_LANGUAGES:
        raise ValueError(f"{len(found)} languages; at most {MOST_LANGUAGES} are told apart")
    give_back()
    return fit(found, vocabulary(path))


class _Scores(WordTable):
    """Scores of words, kept by number."""

    def __init__(self, model: Model, limit: int = 500_000):
        super().__init__(limit, True)
        self.model, self.forward = model, Forward(model.pieces)
        self.clear()

    def clear(self) -> None:
        super().clear()
        self.scores = np.zeros((self.limit + 1, len(self.model.languages)), "f4")

    def _keep(self, words: list[str]) -> None:
        size = self.table.size
        at = [i for i, w in enumerate(words) if classes(w[0].encode(CODE)) == LETTER]
        if at:
            self.scores[[size + i for i in at]] = self.forward.score([words[i] for i in at], self.model.chance)

    def texts(self, texts: list[str | None]) -> list[np.ndarray | None]:
        """Sums of log-probabilities; None for a text without a letter."""
        out: list[np.ndarray | None] = [None] * len(texts)
        alone: list[int] = []
        for group, apart in self.groups([t or "" for t in texts]):
            words = self.split([t for _, t in group])
            numbers = self.numbers(words)
            letter = words.classes() == LETTER
            score = np.where((letter & (numbers >= 0))[:, None], self.scores[numbers], 0).astype("f8")
            sums = np.concatenate([np.zeros((1, score.shape[1])), np.cumsum(score, 0)])
            some = np.concatenate([[0], np.cumsum(letter)])
            total, any_ = sums[words.first[1:]] - sums[words.first[:-1]], some[words.first[1:]] - some[words.first[:-1]]
            odd = set((np.searchsorted(words.first, np.flatnonzero(letter & (numbers < 0)), "right") - 1).tolist())
            for d, (i, _) in enumerate(group):
                if d in odd or not any_[d] and any(map(str.isalpha, texts[i] or "")):
                    alone.append(i)
                elif any_[d]:
                    out[i] = total[d]
            alone += [i for i in apart if any(map(str.isalpha, texts[i]))]
        for i in alone:
            found = _LETTERS.findall(texts[i].lower()) or [c for c in texts[i].lower() if c.isalpha()]
            names = sorted(set(found))
            place = {w: k for k, w in enumerate(names)}
            out[i] = np.bincount([place[w] for w in found], minlength=len(names)) @ self.forward.score(names, self.model.chance)
        return out


def predict(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(*keep, lang_pred, score); keep is doc_id by default, and columns of those names in it are replaced."""
    keep = ["doc_id"] if keep is None else [c for c in keep if c not in ("lang_pred", "score")]
    shared = docs.sparkSession.sparkContext.broadcast(model)  # as large as the vocabulary times the languages
    rows = docs.select(*keep, F.col(text).cast("string").alias("__text"))
    schema = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes if c != "__text") + ", lang_pred string, score double"

    def make():
        table, languages = kept("language scores", shared.value, _Scores), shared.value.languages

        def f(batch):
            names, scores = [], []
            for sums in table.texts(batch.column("__text").to_pylist()) if languages else [None] * batch.num_rows:
                if sums is None:
                    names.append("und")
                    scores.append(0.0)
                    continue
                best = int(np.argmax(sums))
                names.append(languages[best])
                scores.append(float(1 / np.exp(sums - sums[best]).sum()))
            return {**{c: batch.column(c) for c in keep}, "lang_pred": names, "score": scores}

        return f

    return map_arrow(rows, schema, make)


def query(spark, sf_dir: str) -> DataFrame:
    from chartloom.llm.common import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = learn(docs.filter(~held_out()))
    return predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
