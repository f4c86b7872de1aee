"""Exact and fast use of the tokenizers library: each word is encoded once, then looked up.

Both public BPE files split a text into words before they merge, so the ids of
a text are those of its words, one after the other. For texts made of
characters for which the split is known to be the library's own, the split is
done here on whole batches of bytes, words not met before go to the library,
and ids come from a table. Any other text (other scripts, rare white space,
combining marks, added tokens) goes to the library whole. Both ways give the
library's ids.

A table holds ``LIMIT`` words and then starts anew, which bounds its memory
(some 60 bytes a word) and changes no result. Words are compared whole: those
of up to 16 bytes as two integers, longer ones as bytes.
"""

from __future__ import annotations

import os
import re

import numpy as np

from chartloom.llm.common import kept

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: One byte a character; texts are safe if they have no other characters than these.
CODE = "cp1252"
_LOW = "a-zß-öø-ÿšžœ"
_UP = "A-ZÀ-ÖØ-ÞŠŽŒŸ"
_OTHER = r"\t\n\r\x20-\x7e¡-©«¬®-±´¶-¸»¿×÷€‚„…†‡‰‹‘’“”•–—™›"
UNSAFE = re.compile(f"[^{_OTHER}{_LOW}{_UP}]")
LIMIT = 1_000_000
#: Longer words are encoded where they stand and not kept.
LONG = 64

SPACE, LETTER, DIGIT, MARK, END = range(5)


def _classes() -> np.ndarray:
    out = np.full(256, MARK, "u1")
    letter = re.compile(f"[{_LOW}{_UP}]")
    for i in range(256):
        c = bytes([i]).decode(CODE, "replace")
        if c in " \t\n\r":
            out[i] = SPACE
        elif "0" <= c <= "9":
            out[i] = DIGIT
        elif letter.match(c):
            out[i] = LETTER
    out[0] = END
    return out


class Words:
    """Words of a batch: word i is ``raw[start[i] : start[i] + length[i]]``; document d has words first[d] to first[d + 1]."""

    def __init__(self, texts: list[bytes], drops_space: bool):
        raw = self.raw = np.frombuffer(b"\0".join([b"", *texts, b"\0" * 24]), "u1")
        cls = _CLASS[raw]
        before = np.concatenate([[np.uint8(END)], cls[:-1]])
        new = cls != before
        if drops_space:  # runs of letters or of marks, single digits
            new |= cls == DIGIT
        else:  # runs; a space goes to what follows it, and the last white space before a word stands alone
            after = np.concatenate([cls[1:], [np.uint8(END)]])
            tail = (cls == SPACE) & (after != SPACE) & (after != END)
            new |= tail
            new[1:] &= ~(tail[:-1] & (raw[:-1] == 0x20))
        # 's 't 're 've 'm 'll 'd, where a word can start at the mark
        marks = np.flatnonzero((raw[:-3] == 0x27) & new[:-3])
        if len(marks):
            a, b = raw[marks + 1], raw[marks + 2]
            size = np.where(np.isin(a, _ONE), 1, 0)
            for x, y in (b"re", b"ve", b"ll"):
                size[(a == x) & (b == y)] = 2
            marks, size = marks[size > 0], size[size > 0]
            new[marks + 1] = False
            new[marks + 1 + size] = True
        bounds = np.flatnonzero(new)
        ends = np.concatenate([bounds[1:], [len(raw)]])
        at = cls[bounds]
        keep = at != END
        if drops_space:
            keep &= at != SPACE
        self.start, self.length = bounds[keep], (ends - bounds)[keep]
        sizes = np.fromiter(map(len, texts), "i8", len(texts))
        self.first = np.searchsorted(self.start, np.concatenate([[1], 1 + np.cumsum(sizes + 1)]))

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        """The first 16 bytes of each word, as two integers, with zeros after its end."""
        over = np.ndarray((len(self.raw) - 8,), "<u8", self.raw.data, 0, (1,))
        low, high = over[self.start], over[np.minimum(self.start + 8, len(over) - 1)]
        low &= _MASK[np.minimum(self.length, 8)]
        high &= _MASK[np.clip(self.length - 8, 0, 8)]
        return low, high

    def classes(self) -> np.ndarray:
        """The class of each word's first character."""
        return _CLASS[self.raw[self.start]]

    def word(self, i: int) -> bytes:
        a = self.start[i]
        return self.raw[a : a + self.length[i]].tobytes()


def classes(char: bytes) -> int:
    return int(_CLASS[char[0]])


_CLASS = _classes()
_ONE = np.frombuffer(b"stmd", "u1")
_MASK = np.array([(1 << (8 * n)) - 1 for n in range(9)], "<u8")


class Table:
    """Numbers of words of up to 16 bytes, in the order added: an open hash table over two integers."""

    def __init__(self, limit: int):
        self.bits = max(10, int(limit * 2 - 1).bit_length())
        self.slots = np.full(1 << self.bits, -1, "i4")
        self.low, self.high = np.zeros(limit + 1, "<u8"), np.zeros(limit + 1, "<u8")
        self.size = 0

    def _slot(self, low, high):
        h = (low * np.uint64(0x9E3779B97F4A7C15)) ^ (high * np.uint64(0xC2B2AE3D27D4EB4F))
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        return (h >> np.uint64(64 - self.bits)).astype("i8")

    def find(self, low, high) -> np.ndarray:
        """Numbers of words, -1 for those not there."""
        out = np.full(len(low), -1, "i4")
        todo, slot = np.arange(len(low)), self._slot(low, high)
        while len(todo):
            held = self.slots[slot]
            full = held >= 0
            same = full & (self.low[held] == low[todo]) & (self.high[held] == high[todo])
            out[todo[same]] = held[same]
            on = full & ~same
            todo, slot = todo[on], (slot[on] + 1) & ((1 << self.bits) - 1)
        return out

    def add(self, low, high) -> None:
        """Puts in distinct words that are not there; they get the next numbers."""
        n = len(low)
        numbers = np.arange(self.size, self.size + n, dtype="i4")
        self.low[numbers], self.high[numbers] = low, high
        self.size += n
        todo, slot = np.arange(n), self._slot(low, high)
        while len(todo):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = numbers[todo[free]]
            on = self.slots[slot] != numbers[todo]
            todo, slot = todo[on], (slot[on] + 1) & ((1 << self.bits) - 1)


class WordTable:
    """Numbers for words of batches of texts; what is known of a word is kept by its number (see _keep)."""

    #: What the table leaves to others when a text holds it.
    added: tuple[str, ...] = ()

    def __init__(self, limit: int, lowers: bool):
        self.limit, self.lowers = limit, lowers

    def clear(self) -> None:
        self.table = Table(self.limit)
        self.long: dict[bytes, int] = {}

    def _keep(self, words: list[str]) -> None:
        """Told of distinct new words, whose numbers are the table's next."""

    def safe_bytes(self, text: str) -> bytes | None:
        """A safe text with one byte a character (in small letters if the tokenizer does that); else None."""
        if UNSAFE.search(text) or "<|" in text and any(t in text for t in self.added):
            return None
        if self.lowers:
            text = text.lower()
        try:
            return text.encode("latin-1")
        except UnicodeEncodeError:
            return text.encode(CODE)

    def split(self, texts: list[bytes]) -> Words:
        return Words(texts, self.lowers)

    def numbers(self, words: Words, learn: bool = True) -> np.ndarray:
        """Each word's number in the table; with learn, none is left at -1 but words over LONG."""
        if learn and self.table.size + len(words.start) > self.limit:
            self.limit = max(self.limit, 2 * len(words.start))
            self.clear()
        low, high = words.keys()
        out = np.full(len(low), -1, "i4")
        short = words.length <= 16
        low, high = low[short], high[short]
        found = self.table.find(low, high)
        new = np.flatnonzero(found < 0)
        if learn and len(new):
            order = new[np.lexsort((high[new], low[new]))]
            a, b = low[order], high[order]
            step = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
            a, b = a[step], b[step]
            held = np.stack([a, b], 1).tobytes()
            base = self.table.size
            self._keep([held[i : i + 16].rstrip(b"\0").decode(CODE) for i in range(0, len(held), 16)])
            self.table.add(a, b)
            found[order] = base - 1 + np.cumsum(step)
        out[short] = found
        at = np.flatnonzero(~short & (words.length <= LONG))
        if len(at):
            fresh: dict[bytes, int] = {}
            for i in at.tolist():
                w = words.word(i)
                n = self.long.get(w, -1)
                if n < 0 and learn:
                    n = fresh.setdefault(w, self.table.size + len(fresh))
                out[i] = n
            if fresh:
                self._keep([w.decode(CODE) for w in fresh])
                self.long.update(fresh)
                self.table.size += len(fresh)
        return out

    def groups(self, texts: list[str], chars: int = 400_000):
        """Lists of (place, safe bytes) of about so many characters, and then the places of all other texts."""
        group: list[tuple[int, bytes]] = []
        size, apart = 0, []
        for i, text in enumerate(texts):
            safe = self.safe_bytes(text)
            if safe is None:
                apart.append(i)
                continue
            group.append((i, safe))
            size += len(safe)
            if size >= chars:
                yield group, ()
                group, size = [], 0
        yield group, apart


class Encoder(WordTable):
    """ids of texts as little-endian unsigned 16-bit integers (both vocabularies fit)."""

    def __init__(self, path: str, limit: int = LIMIT):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        super().__init__(limit, self.library.normalizer is not None)
        self.added = tuple(t.content for t in self.library.get_added_tokens_decoder().values())
        # Words in one text: split at white space, where a word's last piece ends in </w>; else at the id of a line end.
        self.separator = " " if self.lowers else "\n"
        size = self.library.get_vocab_size(with_added_tokens=True)
        last = (lambda t: t.endswith("</w>")) if self.lowers else (lambda t: t == "Ċ")
        self.is_end = np.array([last(self.library.id_to_token(i) or "") for i in range(size)])
        self.clear()

    def clear(self) -> None:
        super().clear()
        self.ids, self.used = np.zeros(self.limit * 3, "<u2"), 0
        self.at, self.count = np.zeros(self.limit + 1, "i4"), np.zeros(self.limit + 1, "i4")

    def library_ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u2").tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """ids of all words in a row, and each word's number of ids. Words go to the library many in a text."""
        ids_, counts = [], []
        for at in range(0, len(words), 256):
            group = words[at : at + 256]
            if not any(w.isspace() for w in group):
                ids = np.array(self.library.encode_batch_fast([self.separator.join(group)], add_special_tokens=False)[0].ids, "<u2")
                ends = np.flatnonzero(self.is_end[ids])
                n = np.diff(ends, prepend=-1) if self.lowers else np.diff(np.concatenate([[-1], ends, [len(ids)]])) - 1
                if len(n) == len(group):
                    ids_.append(ids if self.lowers else np.delete(ids, ends))
                    counts.append(n)
                    continue
            alone = self.library_ids(group)
            ids_.append(np.frombuffer(b"".join(alone), "<u2"))
            counts.append(np.array([len(x) // 2 for x in alone]))
        return (np.concatenate(ids_), np.concatenate(counts)) if ids_ else (np.zeros(0, "<u2"), np.zeros(0, "i8"))

    def _keep(self, words: list[str]) -> None:
        """Stores the ids of words; their numbers are the table's next."""
        ids, n = self.encode_words(words)
        if self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids[: self.used], np.zeros(len(self.ids) + len(ids), "<u2")])
        self.ids[self.used : self.used + len(ids)] = ids
        size = self.table.size
        self.at[size : size + len(n)] = self.used + np.cumsum(n) - n
        self.count[size : size + len(n)] = n
        self.used += len(ids)

    def preset(self, words: list[bytes]) -> tuple:
        """Fills the table with distinct words and gives what restore() needs elsewhere."""
        self.limit = max(self.limit, len(words) + 1)
        self.clear()
        short, long = [w for w in words if len(w) <= 16], [w for w in words if len(w) > 16]
        k = np.frombuffer(b"".join(w.ljust(16, b"\0") for w in short), "<u8").reshape(-1, 2)
        self._keep([w.decode(CODE) for w in short])
        self.table.add(np.ascontiguousarray(k[:, 0]), np.ascontiguousarray(k[:, 1]))
        self._keep([w.decode(CODE) for w in long])
        n, m = len(short), len(words)
        return self.table.low[:n].copy(), self.table.high[:n].copy(), long, self.ids[: self.used].copy(), self.at[:m].copy(), self.count[:m].copy()

    def restore(self, held: tuple) -> Encoder:
        low, high, long, self.ids, at, count = held
        self.limit = max(1024, len(at) + 1)
        self.table, self.at, self.count = Table(self.limit), np.zeros(self.limit + 1, "i4"), np.zeros(self.limit + 1, "i4")
        self.at[: len(at)], self.count[: len(at)] = at, count
        self.table.add(low, high)
        self.long = {w: len(low) + i for i, w in enumerate(long)}
        self.table.size = len(at)
        return self

    def gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """ids of words in a row (none for -1), and where each word's begin (with the end)."""
        n = np.where(numbers < 0, 0, self.count[numbers])
        begins = np.concatenate([[0], np.cumsum(n)])
        return self.ids[np.repeat(self.at[numbers] - begins[:-1], n) + np.arange(begins[-1])], begins

    def encode(self, texts: list[str], learn: bool = True) -> list[bytes]:
        """ids of each text; without learn, none for words of up to LONG characters that the table has not."""
        out: list[bytes] = [b""] * len(texts)
        for group, apart in self.groups(texts):
            for i in apart:
                out[i] = self.library_ids([texts[i]])[0]
            words = self.split([t for _, t in group])
            numbers = self.numbers(words, learn)
            ids, begins = self.gather(numbers)
            cuts = begins[words.first]
            long = self.in_place(words)
            for d, (i, _) in enumerate(group):
                parts, at = [], cuts[d]
                for j, own in long.get(d, ()):
                    parts += [ids[at : begins[j]].tobytes(), own]
                    at = begins[j]
                parts.append(ids[at : cuts[d + 1]].tobytes())
                out[i] = b"".join(parts)
        return out

    def in_place(self, words: Words) -> dict[int, list[tuple[int, bytes]]]:
        """Words over LONG with their ids, by document."""
        out: dict[int, list[tuple[int, bytes]]] = {}
        for i in np.flatnonzero(words.length > LONG).tolist():
            own = self.library_ids([words.word(i).decode(CODE)])[0]
            out.setdefault(int(np.searchsorted(words.first, i, "right")) - 1, []).append((i, own))
        return out


class Counts(Encoder):
    """Counts words and encodes none."""

    def __init__(self, path: str, limit: int = 250_000):
        super().__init__(path, limit)

    def clear(self) -> None:
        super().clear()
        self.names: list[str] = []
        self.n = np.zeros(self.limit + 1, "i8")

    def _keep(self, words: list[str]) -> None:
        self.names += words

    def read(self, texts: list[str]):
        """Counts the words of safe texts; yields (words, counts) whenever the table is full."""
        for group, _ in self.groups(texts):
            words = self.split([t for _, t in group])
            if self.table.size + len(words.start) > self.limit:
                yield self.take()
                self.limit = max(self.limit, 2 * len(words.start))
                self.clear()
            numbers = self.numbers(words)
            self.n += np.bincount(numbers[numbers >= 0], minlength=len(self.n))

    def take(self) -> tuple[list[str], np.ndarray]:
        names, n = self.names, self.n[: len(self.names)]
        self.clear()
        return names, n


def encoder(path: str) -> Encoder:
    """The encoder of a file that this Python worker keeps."""
    return kept("encoder", path, Encoder)
