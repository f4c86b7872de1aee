"""Quality rules: a table of thresholds, compiled into one projection.

``measures`` gives a map of named Columns, all built-in expressions over the
words and lines of one text; ``compile_rules`` turns a table of (measure, low,
high) into one boolean Column. Nothing shuffles and nothing runs outside the
JVM. A word is a run of characters other than space and \\t to \\r; lines are
split at \\n.

Edge cases: a null text counts as a text without words, which fails the base
rule and every rule on length; so does an empty one. Ratios over an empty set
are 0. Texts are measured whole; sorting of word windows is n log n, and equal
windows are found by comparing neighbours, so one very long or very repetitive
text stays cheap. Other columns are kept, and one of the same name as a
measure is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SPACE = r"[\x20\x09-\x0D]+"
_TRIM = " \t\n\x0b\f\r"
_PUNCT = ".,;:!?()\"'"

#: The most frequent function words of the four languages.
STOP_WORDS = (
    "the of and to in a is that it was for on are as with his they be at this have from or one had by but not what all were "
    "de la le et les des en un une du que qui dans est pour au sur pas par il elle avec ce se ne "
    "der die und den von zu das mit sich auf für ist im dem nicht ein eine als auch es an werden aus er hat "
    "el los las y del por con una su para lo como más pero sus al este o si sobre entre"
).split()

#: (measure, least, most); None for no bound.
RULES = (
    ("n_words", 10, 200_000),
    ("mean_word_chars", 2.0, 14.0),
    ("symbol_word_ratio", None, 0.2),
    ("stop_word_ratio", 0.06, None),
    ("upper_word_ratio", None, 0.5),
    ("alpha_word_ratio", 0.5, None),
    ("dup_line_ratio", None, 0.5),
    ("bullet_line_ratio", None, 0.9),
    ("ellipsis_line_ratio", None, 0.3),
)


def _let(value: Column, body) -> Column:
    """body of a value that is computed once (a plain second use may be computed again for each element)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    """Words of a text; an empty array for null."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(_TRIM))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, _SPACE))


def repeated_words(words: Column, size: int = 5) -> Column:
    """How many words stand in a window of ``size`` words that occurs twice or more in the text.

    If all windows have distinct hashes, none repeats. Else (hash, place) pairs
    are sorted, and a window counts if a neighbour has its hash and its words.
    """
    same = lambda ws, a, b: F.slice(ws, a + 1, size) == F.slice(ws, b + 1, size)

    def starts(ws: Column, hashes: Column) -> Column:
        def twice(s: Column) -> Column:
            def equal(x: Column, k: Column) -> Column:
                y = F.get(s, k)
                return F.coalesce((y["h"] == x["h"]) & same(ws, x["i"], y["i"]), F.lit(False))

            kept = F.filter(s, lambda x, k: equal(x, k - 1) | equal(x, k + 1))
            return F.array_sort(F.transform(kept, lambda x: x["i"]))

        return _let(F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), twice)

    def covered(at: Column) -> Column:
        step = lambda acc, i: F.struct(
            (acc["n"] + F.least(F.lit(size), i + size - acc["end"])).alias("n"), (i + size).alias("end")
        )
        return F.aggregate(at, F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")), step, lambda acc: acc["n"])

    def of(ws: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(0), F.size(ws) - size), lambda i: F.xxhash64(*[F.get(ws, i + k) for k in range(size)]))
        return _let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(starts(ws, h))))

    return F.when(F.size(words) <= size, F.lit(0)).otherwise(_let(words, of)).cast("long")


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part.cast("double") / whole).otherwise(F.lit(0.0))


def with_words(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with ``__words`` and ``__lines`` (those with a word), on which the measures stand."""
    value = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(value, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return docs.withColumns({"__words": words_of(F.col(text)), "__lines": lines})


def measures(text: str = "text") -> dict[str, Column]:
    """Measures by name, for a frame that with_words() has made."""
    value, words, lines = F.coalesce(F.col(text), F.lit("")), F.col("__words"), F.col("__lines")
    n, n_lines = F.size(words).cast("long"), F.size(lines)
    joined = F.array_join(words, " ")
    count = lambda pattern: F.size(F.regexp_extract_all(joined, F.lit(pattern), F.lit(0)))
    word_chars = F.greatest(F.length(joined) - n + 1, F.lit(0)).cast("long")
    stop = F.size(F.filter(words, lambda w: F.lower(F.btrim(w, F.lit(_PUNCT))).isin(STOP_WORDS)))
    return {
        "n_words": n,
        "word_chars": F.when(n == 0, F.lit(0)).otherwise(word_chars).cast("long"),
        "n_symbols": F.regexp_count(value, F.lit(r"[#*$%&|<>]")).cast("long"),
        "n_dup_lines": (n_lines - F.size(F.array_distinct(lines))).cast("long"),
        "n_repeat_words": repeated_words(words),
        "mean_word_chars": _share(word_chars, n),
        "symbol_word_ratio": _share(count(r"(?<![^ ])[^ ]*[#*$%&|<>][^ ]*"), n),
        "stop_word_ratio": _share(stop, n),
        "upper_word_ratio": _share(count(r"(?<![^ ])\p{Lu}{2}[^\p{Ll} ]*(?= |$)"), n),
        "alpha_word_ratio": _share(n - count(r"(?<![^ ])[^\p{L} ]+(?= |$)"), n),
        "dup_line_ratio": _share(n_lines - F.size(F.array_distinct(lines)), n_lines),
        "bullet_line_ratio": _share(F.size(F.filter(lines, lambda x: x.rlike(r"^[ \t]*[-*•]"))), n_lines),
        "ellipsis_line_ratio": _share(F.size(F.filter(lines, lambda x: x.rlike(r"(\.\.\.|…)[ \t\r]*$"))), n_lines),
    }


def compile_rules(rules=RULES, prefix: str = "") -> Column:
    """One boolean Column that holds if every measure is within its bounds; columns are named prefix + measure."""
    keep = F.lit(True)
    for name, least, most in rules:
        if least is not None:
            keep = keep & (F.col(prefix + name) >= least)
        if most is not None:
            keep = keep & (F.col(prefix + name) <= most)
    return F.coalesce(keep, F.lit(False))


def base_failed(prefix: str = "") -> Column:
    return (F.col(prefix + "n_words") < 10) | (100 * F.col(prefix + "n_repeat_words") > 20 * F.col(prefix + "n_words"))


def kept_by(rules=RULES, prefix: str = "") -> Column:
    return ~base_failed(prefix) & compile_rules(rules, prefix)


def score(docs: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """docs with the measures, ``base_failed`` and ``kept``."""
    measured = with_words(docs, text).withColumns(measures(text)).drop("__words", "__lines")
    return measured.withColumns({"base_failed": base_failed(), "kept": kept_by(rules)})


def query(spark, sf_dir: str) -> DataFrame:
    from chartloom.llm.common import table

    scored = score(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return scored.select(*base, *[F.round(F.col(m), 9).alias(m) for m, _, _ in RULES if m != "n_words"])


def oracle() -> str:
    """The same result as SQL over unnested words, windows and lines."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    share = lambda part, whole: f"CASE WHEN {whole} > 0 THEN ({part})::DOUBLE / {whole} ELSE 0.0::DOUBLE END"
    words = lambda test: f"len(list_filter(ws, lambda x: {test}))"
    stop = ", ".join(map(quote, STOP_WORDS))
    bounds = " AND ".join(
        [f"{m} >= {least}" for m, least, _ in RULES if least is not None] + [f"{m} <= {most}" for m, _, most in RULES if most is not None]
    )
    rules = ", ".join(f"round({m}, 9) AS {m}" for m, _, _ in RULES if m != "n_words")
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
g AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] || ' ' || ws[i + 3] || ' ' || ws[i + 4] AS gram
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w)),
rep AS (SELECT doc_id, gram FROM g GROUP BY doc_id, gram HAVING count(*) > 1),
pos AS (SELECT DISTINCT doc_id, unnest(range(i, i + 5)) AS p FROM g JOIN rep USING (doc_id, gram)),
nr AS (SELECT doc_id, count(*) AS n_repeat FROM pos GROUP BY doc_id),
l AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS dups, count(*) FILTER (WHERE regexp_matches(line, '^[ \t]*[-*•]')) AS bullets,
    count(*) FILTER (WHERE regexp_matches(line, '(\.\.\.|…)[ \t\r]*$')) AS dots
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (SELECT w.doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars, len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
    coalesce(dups, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat, 0)::BIGINT AS n_repeat_words,
    {share("length(array_to_string(ws, ''))", "len(ws)")} AS mean_word_chars,
    {share(words("regexp_matches(x, '[#*$%&|<>]')"), "len(ws)")} AS symbol_word_ratio,
    {share(words(f"lower(trim(x, {quote(_PUNCT)})) IN ({stop})"), "len(ws)")} AS stop_word_ratio,
    {share(words(r"regexp_full_match(x, '\p{Lu}{2}[^\p{Ll}]*')"), "len(ws)")} AS upper_word_ratio,
    {share("len(ws) - " + words(r"regexp_full_match(x, '[^\p{L}]+')"), "len(ws)")} AS alpha_word_ratio,
    {share("coalesce(dups, 0)", "coalesce(n_lines, 0)")} AS dup_line_ratio,
    {share("coalesce(bullets, 0)", "coalesce(n_lines, 0)")} AS bullet_line_ratio,
    {share("coalesce(dots, 0)", "coalesce(n_lines, 0)")} AS ellipsis_line_ratio
  FROM w LEFT JOIN nr USING (doc_id) LEFT JOIN l USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND ({bounds}) AS kept, {rules} FROM m"""
