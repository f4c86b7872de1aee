"""Secret scans: fixed patterns, and a token-efficiency test for random strings.

Prose costs few tokens for its length under a vocabulary learned from prose;
a random string costs many. A candidate word of ``min_len`` characters or more
is reported as kind ``random`` when it has fewer than ``max_ratio`` characters
for each token, unless it is a known digest (a whole hexadecimal digest of the
usual lengths, as of a commit or checksum) or a known identifier (UUID, number,
words and short numbers with separators between them). E-mail addresses and the
hosts and paths of URLs are left out whole; their user-info, queries and all
other text next to dots, colons and at signs are tested part by part. Patterns (assign, access, hex) always stay.

Edge cases: a null text has no span; so has an empty one. Texts are scanned
whole, however long. Repeated rows give repeated results. Other columns of the
input are kept as they are; ``spans`` is added (an input column of that name is
replaced).
"""

from __future__ import annotations

import base64
import functools
import re

import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartloom.llm.common import bound_batches

KINDS = ("assign", "access", "hex", "random")
#: Which of the base kinds needs which number of characters, and of which group.
BASE = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 8),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 32),
)
#: A cheap test that holds for every text with a hex match.
_HEX = re.compile(r"[0-9a-f]{32}")
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
#: Lengths of MD5, SHA-1, SHA-224, SHA-256, SHA-384 and SHA-512 in hexadecimal.
DIGEST_LENGTHS = (32, 40, 56, 64, 96, 128)
_DIGEST = re.compile(r"(?:[0-9a-f]+|[0-9A-F]+)\Z")
_UUID = re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}\Z")
#: Words and short numbers with separators between them. Possessive, and no two ways to read a word: time is linear.
_NAME = re.compile(r"[_/=-]*+(?:[A-Z]?[a-z]++(?:[A-Z][a-z]++)*+|[0-9]{1,4}+)(?:[_/=-]++(?:[A-Z]?[a-z]++(?:[A-Z][a-z]++)*+|[0-9]{1,4}+))*+[_/=-]*+\Z")
_PART = re.compile(r"[A-Za-z0-9]+")
_WORD = re.compile(r"[A-Z]?[a-z]+")
#: Group 1: host, port and path. Possessive, so that time is linear.
_URL = re.compile(r"""://(?:[^\s/?\#@"'<>]*+@)?+([A-Za-z0-9.-]++(?::[0-9]++)?+(?:/[^\s?\#"'<>]*+)?+)""")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

SPAN = T.ArrayType(
    T.StructType(
        [T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]
    )
)


@functools.lru_cache(maxsize=2)
def _vocabulary(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("scan", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _known(word: str, encode, max_ratio: float) -> bool:
    """Digests of the usual lengths, UUIDs, and names made of words and short numbers with separators between."""
    if len(word) in DIGEST_LENGTHS and _DIGEST.match(word):
        return True
    if _UUID.match(word) or word.strip("0123456789-_=/+") == "":
        return True
    if not _NAME.match(word):
        return False
    parts = _WORD.findall(word)
    long = [w for w in parts if len(w) > 3]  # shorter ones tell nothing
    return len(_PART.findall(word)) > 1 and sum(map(len, long)) >= max_ratio * sum(len(encode(w)) for w in long)


def _addresses(text: str) -> list[tuple[int, int]]:
    """Spans of e-mail addresses and of URLs' schemes, hosts and paths, in order. User-info, query and fragment are left out."""
    out = []
    if "://" in text:
        for m in _URL.finditer(text):
            out += [(m.start(), m.start() + 3), m.span(1)]
    if "@" in text:
        for m in _DOMAIN.finditer(text):
            a = m.start()
            while a > 0 and m.start() - a <= 64 and text[a - 1] in _LOCAL:
                a -= 1
            # a local part has 64 characters at most; with a path behind, it is the user of a host
            if 0 < m.start() - a <= 64 and text[m.end() : m.end() + 1] not in (":", "/"):
                out.append((a, m.end()))
    return sorted(out)


def find_spans(text: str | None, encode, max_ratio: float = 2.0) -> list[tuple[str, int, int]]:
    """All spans of one text as (kind, start, end), by start and then kind, in code points."""
    if not text:
        return []
    out = []
    for kind, pattern, group, least in BASE:
        if kind == "hex" and not _HEX.search(text) or kind == "access" and "AKIA" not in text:
            continue
        if kind == "assign" and ":" not in text and "=" not in text:
            continue
        for m in pattern.finditer(text):
            a, b = m.span(group)
            if b - a >= least:
                out.append((kind, m.start(), m.end()))
    base = [(a, b) for _, a, b in out]
    if not _CANDIDATE.search(text):
        return out if len(out) < 2 else sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
    # base spans as runs that do not overlap, in order; next_ is the first that ends behind a candidate's start
    runs: list[list[int]] = []
    for a, b in sorted(base):
        if runs and a < runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], b)
        else:
            runs.append([a, b])
    at = next_ = 0
    for x, y in [*_addresses(text), (len(text), len(text))]:
        for m in _CANDIDATE.finditer(text, at, max(at, x)):
            a, b = m.span()
            while next_ < len(runs) and runs[next_][1] <= a:
                next_ += 1
            if next_ < len(runs) and runs[next_][0] < b:
                continue
            word = m.group()
            if not _known(word, encode, max_ratio) and len(word) < max_ratio * len(encode(word)):
                out.append(("random", a, b))
        at = max(at, y)
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def scan(
    docs: DataFrame,
    text: str = "text",
    vocabulary: str = public_tokenizers.path("byte_bpe_50k.tiktoken"),
    max_ratio: float = 2.0,
) -> DataFrame:
    """docs with ``spans``: array of (kind, start, end)."""

    @F.udf(SPAN, useArrow=True)
    def spans(value):
        return find_spans(value, _vocabulary(vocabulary).encode_ordinary, max_ratio)

    bound_batches(docs.sparkSession)
    return docs.withColumn("spans", spans(F.col(text)))


def redact(docs: DataFrame, text: str = "text", mark: str = "[secret]", **options) -> DataFrame:
    """docs with every found span of the text replaced by the mark (overlaps count as one span)."""
    vocabulary = options.get("vocabulary", public_tokenizers.path("byte_bpe_50k.tiktoken"))
    max_ratio = options.get("max_ratio", 2.0)

    @F.udf("string", useArrow=True)
    def clean(value):
        spans = find_spans(value, _vocabulary(vocabulary).encode_ordinary, max_ratio)
        if not spans:
            return value
        out, at = [], 0
        for _, a, b in spans:
            if a >= at:
                out += [value[at:a], mark]
            at = max(at, b)
        return "".join([*out, value[at:]])

    bound_batches(docs.sparkSession)
    return docs.withColumn(text, clean(F.col(text)))


def joined(spans, kinds: tuple[str, ...] | None = None):
    """kind:start:end, comma-joined, of a column of spans."""
    if kinds:
        spans = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def query(spark, sf_dir: str) -> DataFrame:
    from chartloom.llm.common import table

    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = joined(F.col("spans"), KINDS[:3])
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(base, 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
