"""The pipeline's stages, one after the other and each on awkward rows."""


import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from chartloom.llm import near_dup

from .test_operators import ODD, prose

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def rows(texts):
    return [(i, t, "en", "s", None if t is None else len(t)) for i, t in texts]


@pytest.fixture(scope="module")
def docs(spark):
    secret = prose(50, 60) + ' password = "h7Gq2kLm9ZtR4wXc8VbN1sDf6" ' + prose(51, 40)
    clean = [(i, prose(200 + i, 120)) for i in range(30)]
    copies = [(300, clean[3][1]), (301, clean[3][1] + " one more word")]
    junk = [(400, " | ".join(clean[4][1].split())), (401, "too short"), (402, "12 34 !!"), (403, None), (404, "")]
    return spark.createDataFrame(rows(clean + copies + junk + [(500, secret)]), SCHEMA).cache()


def test_names_and_columns(spark, docs):
    assert [n for n, _ in pipeline.STAGES] == ["language", "quality", "near_duplicates", "secrets", "packing"]
    for _, stage in pipeline.STAGES[:-1]:
        assert stage(spark, docs, "").columns == pipeline.COLUMNS


def test_what_each_stage_does(spark, docs):
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    clean = set(range(30)) | {500}
    language = pipeline.language(spark, docs, "")
    assert clean | {300, 301, 401} <= ids(language) and not ids(language) & {402, 403, 404}
    quality = pipeline.quality(spark, language, "")
    assert ids(quality) == clean | {300, 301}
    unique = pipeline.near_duplicates(spark, quality, "")
    assert ids(unique) == clean
    safe = pipeline.secrets(spark, unique, "")
    by = {r.doc_id: r for r in safe.collect()}
    assert set(by) == clean and "[secret]" in by[500].text and "h7Gq2k" not in by[500].text and by[500].n_chars == len(by[500].text)
    before = {r.doc_id: r for r in unique.collect()}
    assert all(by[i] == before[i] for i in range(30))
    packed = pipeline.pack(spark, safe, "").collect()
    assert {r.doc_id for r in packed} == clean


def test_run_writes_and_reads_each_stage(spark, docs, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    out = pipeline.run(spark, str(tmp_path))
    assert {r.doc_id for r in out.collect()} == set(range(30)) | {500}


def test_odd_rows_and_empty_tables(spark):
    odd = spark.createDataFrame([(i, t, None if k % 2 else "en", None, None) for k, (i, t) in enumerate(ODD)], SCHEMA)
    more = odd.withColumns({"score": F.lit(1), "kept": F.lit("x"), "spans": F.lit(2), "class_id": F.lit(3)})
    for table in (odd, odd.limit(0), more):
        for name, stage in pipeline.STAGES:
            n = stage(spark, table, "").count()
            assert n == 0 if table.isEmpty() else n >= 1, name


def test_repeated_ids_keep_one_row_of_each_text(spark):
    table = spark.createDataFrame(rows([(1, "b b"), (1, "a a"), (2, "c c"), (1, "a a")]), SCHEMA)
    assert sorted((r.doc_id, r.text) for r in near_dup.first_rows(table).collect()) == [(1, "a a"), (1, "b b"), (2, "c c")]
