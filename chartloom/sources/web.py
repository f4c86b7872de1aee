"""Files and pages from the web, fetched only if they are newer there.

Pages are few and read by the driver; the files they link to are rows, fetched by
the executors into a folder that all share. Which files to get can also be
planned as a DataFrame (``ingest.fetch_plan``).
"""

from __future__ import annotations

import email.utils
import os
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.operators import ingest


def page(url: str, timeout: float = 60) -> str:
    with urllib.request.urlopen(url, timeout=timeout) as answer:
        return answer.read().decode("utf-8", "replace")


def download(url: str, folder: str, timeout: float = 300) -> str:
    """``got``, ``skipped`` (not newer there) or ``failed``. The file takes its place only when it is whole."""
    path = os.path.join(folder, url.rsplit("/", 1)[-1])
    ask = urllib.request.Request(url)
    if os.path.exists(path):
        ask.add_header("If-Modified-Since", email.utils.formatdate(os.path.getmtime(path), usegmt=True))
    part = path + ".part"
    try:
        os.makedirs(folder, exist_ok=True)
        with urllib.request.urlopen(ask, timeout=timeout) as answer, open(part, "wb") as f:
            while block := answer.read(1 << 20):
                f.write(block)
        os.replace(part, path)
        return "got"
    except urllib.error.HTTPError as e:
        return "skipped" if e.code == 304 else "failed"
    except OSError:
        return "failed"
    finally:
        if os.path.exists(part):
            os.remove(part)


def download_all(urls: Iterable[str], folder: str) -> dict[str, int]:
    """How many were got, skipped and failed."""
    counts = {"got": 0, "skipped": 0, "failed": 0}
    for url in urls:
        counts[download(url, folder)] += 1
    return counts


def fetch(urls: DataFrame, folder: str, at_once: int = 8) -> DataFrame:
    """(url, status) of rows (url): each is downloaded by an executor, some at once so that a site is not flooded."""

    def run(batches):
        for pdf in batches:
            yield pdf.assign(status=[download(url, folder) for url in pdf.url])

    return urls.select("url").distinct().repartition(at_once, "url").mapInPandas(run, "url string, status string")


def linked(spark: SparkSession, pages: list[tuple[str, list[str]]], label: str = "Geo-TIFF") -> DataFrame:
    """(page, section, ordinal, url): the files that index pages link to in their sections, with outvoted dates repaired.

    pages: URL of each page and the ids of its sections. Links of all sections and pages are one list, in order.
    """
    rows = [(i, url, page(url)) for i, (url, _) in enumerate(pages)]
    found = None
    for i, (_, sections) in enumerate(pages):
        one = spark.createDataFrame(rows[i : i + 1], "place int, page string, html string")
        links = ingest.table_links(one, sections, label=label)
        order = F.create_map(*[F.lit(x) for k, s in enumerate(sections) for x in (s, k)])
        links = links.withColumn("rank", F.col("place") * 1_000_000 + order[F.col("section")] * 10_000 + F.col("ordinal"))
        found = links if found is None else found.unionByName(links)
    if found is None:
        return spark.createDataFrame([], "page string, section string, ordinal int, url string")
    whole = F.udf(lambda base, href: urllib.parse.urljoin(base, href), "string")(F.col("page"), F.col("href"))
    listed = found.select("page", "section", "ordinal", F.lit("all").alias("grp"), "rank", whole.alias("url"))
    fixed = ingest.repair(listed.select("grp", F.col("rank").alias("ordinal"), "url")).select(F.col("ordinal").alias("rank"), "repaired")
    return listed.drop("url").join(fixed, "rank").select("page", "section", "ordinal", F.col("repaired").alias("url"))
