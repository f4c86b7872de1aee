"""Source lists: links of web pages, dates in URLs, votes and repair, conditional fetches, job results."""

from __future__ import annotations

from html.parser import HTMLParser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartloom.functions.text import url_prefix, url_suffix

#: Ids of the chart sections of the two kinds of index pages.
VFR_SECTIONS = ("sectional", "terminalArea", "helicopter", "grandCanyon", "Planning", "caribbean")
IFR_SECTIONS = ("lowsHighsAreas", "planning", "caribbean", "gulf")
LINK = T.StructType([T.StructField("ordinal", T.IntegerType()), T.StructField("href", T.StringType()), T.StructField("text", T.StringType())])
_ANCHOR = r'<a href="([^"]*)">([^<]*)</a>'
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())


def anchors(html) -> Column:
    """Array of (ordinal, href, text) of plain anchors, by pattern: no Python, for well-formed pages."""
    value = F.col(html) if isinstance(html, str) else html
    found = F.arrays_zip(F.regexp_extract_all(value, F.lit(_ANCHOR), 1).alias("href"), F.regexp_extract_all(value, F.lit(_ANCHOR), 2).alias("text"))
    return F.transform(found, lambda a, i: F.struct(i.alias("ordinal"), a["href"].alias("href"), a["text"].alias("text")))


class _Table(HTMLParser):
    """Links in the second cell of each table row within the division of a given id."""

    def __init__(self, section: str, label: str):
        super().__init__(convert_charrefs=True)
        self.section, self.label = section, label.lower()
        self.inside = 0  # depth of elements since the division began
        self.rows: list[int] = []  # cells so far in each open row
        self.cells: list[bool] = []  # whether each open cell is its row's second
        self.href: str | None = None
        self.words: list[str] = []
        self.found: list[str] = []

    def handle_starttag(self, tag, attrs):
        known = dict(attrs)
        if self.inside or tag == "div" and known.get("id") == self.section:
            self.inside += tag == "div"
        if not self.inside or tag in _VOID:
            return
        if tag == "tr":
            self.rows.append(0)
        elif tag == "td" and self.rows:
            self.rows[-1] += 1
            self.cells.append(self.rows[-1] == 2)
        elif tag == "a" and self.cells and self.cells[-1] and self.href is None:
            self.href, self.words = known.get("href") or "", []

    def handle_data(self, data):
        if self.href is not None:
            self.words.append(data)

    def handle_endtag(self, tag):
        if not self.inside:
            return
        if tag == "a" and self.href is not None:
            if self.href and "".join(self.words).strip().lower() == self.label:
                self.found.append(self.href)
            self.href = None
        elif tag == "td" and self.cells:
            self.cells.pop()
        elif tag == "tr" and self.rows:
            self.rows.pop()
        elif tag == "div":
            self.inside -= 1


def section_links(html: str, section: str, label: str = "Geo-TIFF") -> list[str]:
    parser = _Table(section, label)
    parser.feed(html or "")
    return parser.found


def table_links(pages: DataFrame, sections: list[str], html: str = "html", label: str = "Geo-TIFF") -> DataFrame:
    """(all columns but html, section, ordinal, href): links of that label in second cells of each section's tables."""

    @F.udf(T.ArrayType(T.StructType([T.StructField("section", T.StringType()), T.StructField("ordinal", T.IntegerType()), T.StructField("href", T.StringType())])), useArrow=True)
    def links(page):
        return [(s, i, h) for s in sections for i, h in enumerate(section_links(page, s, label))]

    keep = [c for c in pages.columns if c != html]
    return pages.select(*keep, F.explode(links(F.col(html))).alias("__l")).select(*keep, "__l.section", "__l.ordinal", "__l.href")


def numbered(lists: list[DataFrame]) -> DataFrame:
    """(grp, ordinal, url) of several lists (ordinal, url): one after the other, each a group of its own."""
    out = None
    for k, one in enumerate(lists):
        part = one.select(F.lit(k).cast("string").alias("grp"), "ordinal", "url")
        out = part if out is None else out.unionByName(part)
    return out


def dated(urls: DataFrame) -> DataFrame:
    """``prefix`` and ``suffix`` around the date; null for an URL without a date before a slash."""
    return urls.withColumns({"prefix": url_prefix("url"), "suffix": url_suffix("url")})


def vote(urls: DataFrame) -> DataFrame:
    """(grp, prefix, votes): the most frequent prefix of each group; of several, the one seen first. Undated URLs have no vote."""
    counts = dated(urls).filter(F.col("prefix").isNotNull()).groupBy("grp", "prefix").agg(F.count("*").alias("votes"), F.min("ordinal").alias("first"))
    best = F.max_by(F.struct("prefix", "votes"), F.struct("votes", -F.col("first"))).alias("__b")
    return counts.groupBy("grp").agg(best).select("grp", "__b.prefix", "__b.votes")


def repair(urls: DataFrame) -> DataFrame:
    """``repaired``: each dated URL with its group's winning prefix. Undated ones stay; ``valid`` tells which."""
    won = vote(urls).select("grp", F.col("prefix").alias("__won"))
    both = dated(urls).join(won, "grp", "left")
    valid = F.col("prefix").isNotNull()
    return both.select("grp", "ordinal", "url", F.when(valid, F.concat("__won", "suffix")).otherwise(F.col("url")).alias("repaired"), valid.alias("valid"))


def fetch_plan(files: DataFrame) -> DataFrame:
    """``action``: get what is not here or is newer there, skip the rest."""
    get = F.col("local_mtime").isNull() | (F.col("remote_mtime") > F.col("local_mtime"))
    return files.withColumn("action", F.when(get, F.lit("get")).otherwise(F.lit("skip")))


def status_counts(jobs: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Completed and failed jobs; a status of 0 is success."""
    return jobs.groupBy(*(by or [])).agg(F.count_if(F.col("status") == 0).alias("completed"), F.count_if(F.col("status") != 0).alias("failed"))
