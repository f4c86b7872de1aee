"""JSON texts as Columns, through Spark's variant type.

Objects compare without regard to the order of their keys, of repeated keys a
parse error results, and comments can be taken out beforehand.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chartloom.functions.mercator import col

#: Texts nested deeper than this are refused by ``within_limits``.
MOST_DEPTH = 1000
#: A string, or a comment (line or block) outside one, or white space outside one.
_OUTSIDE = r'("(?:[^"\\]|\\.)*")|/\*[\s\S]*?\*/|//[^\n]*|\s+'


def minify(text) -> Column:
    """Without comments and without white space outside strings."""
    return F.regexp_replace(col(text), _OUTSIDE, "$1")


def parse(text) -> Column:
    """A variant; null for what is no JSON."""
    return F.try_parse_json(col(text))


def print_plain(variant) -> Column:
    return F.to_json(col(variant))


def get(text, path: str, kind: str = "string") -> Column:
    """The value at a path such as ``$.a[0]``, null if it is not there or of another kind."""
    return F.try_variant_get(parse(text), path, kind)


def has(text, path: str) -> Column:
    """Whether a path is there, be its value null or not."""
    return F.try_variant_get(parse(text), path, "variant").isNotNull()


def kind(text) -> Column:
    """``null``, ``boolean``, ``number``, ``string``, ``array``, ``object``; null for what is no JSON."""
    schema = F.schema_of_variant(parse(text))
    return (
        F.when(schema.isNull(), F.lit(None).cast("string"))
        .when(schema == "VOID", "null")
        .when(schema == "BOOLEAN", "boolean")
        .when(schema == "STRING", "string")
        .when(schema.startswith("ARRAY"), "array")
        .when(schema.startswith("OBJECT"), "object")
        .otherwise("number")
    )


def size(text) -> Column:
    """Items of an array or keys of an object; null for others."""
    value = col(text)
    return F.when(kind(text) == "array", F.json_array_length(value)).when(kind(text) == "object", F.size(F.json_object_keys(value)))


def equal(a, b) -> Column:
    """Whether two texts are the same value; null if either is no JSON."""
    return print_plain(parse(a)) == print_plain(parse(b))


def near_equal(a, b, epsilon: float = 2.220446049250313e-16) -> Column:
    """Whether two numbers differ by no more than ``epsilon`` of the larger; others are compared as they are."""
    x, y = (F.try_variant_get(parse(t), "$", "double") for t in (a, b))
    close = F.abs(x - y) <= F.greatest(F.abs(x), F.abs(y)) * epsilon
    return F.when((kind(a) == "number") & (kind(b) == "number"), close).otherwise(equal(a, b))


def depth(text) -> Column:
    """How deep arrays and objects are nested; 0 for a single value."""
    marks = F.regexp_replace(F.regexp_replace(col(text), r'"(?:[^"\\\\]|\\\\.)*"', ""), r"[^\[\]{}]", "")
    open_ = lambda c: F.when(c.isin("[", "{"), 1).otherwise(-1)
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))
    step = lambda a, c: F.struct((a["now"] + open_(c)).alias("now"), F.greatest(a["most"], a["now"] + open_(c)).alias("most"))
    return F.when(marks == "", 0).otherwise(F.aggregate(F.split(marks, ""), start, lambda a, c: F.when(c == "", a).otherwise(step(a, c)), lambda a: a["most"]))


def within_limits(text, most_depth: int = MOST_DEPTH) -> Column:
    """Whether a text is nested no deeper than allowed; null stays null."""
    return depth(text) <= most_depth


def create(kind_: str, value=None) -> Column:
    """A JSON text of a kind: null, true, false, boolean, number, string, raw, array (of texts) or object (of texts by key)."""
    if kind_ in ("null", "true", "false"):
        return F.lit(kind_)
    if kind_ == "array":
        return F.concat(F.lit("["), F.concat_ws(",", *[col(v) for v in value or []]), F.lit("]"))
    if kind_ == "object":
        parts = [F.concat(create("string", F.lit(k)), F.lit(":"), col(v)) for k, v in (value or {}).items()]
        return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))
    if kind_ == "string":
        quoted = F.to_json(F.array(col(value).cast("string")))
        return F.substr(quoted, F.lit(2), F.length(quoted) - 2)
    if kind_ == "number":
        number = col(value).cast("double")
        whole = (number == F.floor(number)) & (F.abs(number) < 1e15)
        return F.when(F.isnan(number) | (F.abs(number) == float("inf")), "null").when(whole, number.cast("bigint").cast("string")).otherwise(number.cast("string"))
    if kind_ in ("boolean", "raw"):
        return col(value).cast("string")
    raise ValueError(f"unknown kind of JSON {kind_!r}")


def with_key(text, key: str, value) -> Column:
    """An object of string, number or other values with one key set; value is a JSON text."""
    entries = F.from_json(col(text), "map<string,variant>")
    rest = F.map_filter(entries, lambda k, _: k != F.lit(key))
    return F.to_json(F.map_concat(rest, F.create_map(F.lit(key), F.parse_json(col(value)))))


def without_key(text, key: str) -> Column:
    return F.to_json(F.map_filter(F.from_json(col(text), "map<string,variant>"), lambda k, _: k != F.lit(key)))


def replaced_key(text, key: str, value, any_case: bool = False) -> Column:
    """An object whose key has another value; one without the key stays. any_case: letters of the key in either case."""
    entries, new = F.from_json(col(text), "map<string,variant>"), F.parse_json(col(value))
    same = lambda k: F.lower(k) == key.lower() if any_case else k == F.lit(key)
    return F.to_json(F.transform_values(entries, lambda k, v: F.when(same(k), new).otherwise(v)))


def replaced_item(text, at: int, value) -> Column:
    """An array with one item replaced; one too short stays."""
    new = F.parse_json(col(value))
    return F.to_json(F.transform(F.from_json(col(text), "array<variant>"), lambda v, i: F.when(i == at, new).otherwise(v)))


def with_item(text, value, at: int | None = None) -> Column:
    """An array with an item put in (at the end by default); value is a JSON text."""
    items, item = F.from_json(col(text), "array<variant>"), F.parse_json(col(value))
    return F.to_json(F.array_append(items, item) if at is None else F.array_insert(items, at + 1, item))


def without_item(text, at: int) -> Column:
    return F.to_json(F.filter(F.from_json(col(text), "array<variant>"), lambda _, i: i != at))
