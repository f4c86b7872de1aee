"""Every registered query on the smallest tables: its columns, and its results against plain versions that share no code with it."""

import hashlib
import math
import os
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from chartloom.llm import queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def texts():
    t = pq.read_table(f"{SF}/documents.parquet")
    return dict(zip(t.column("doc_id").to_pylist(), t.column("text").to_pylist(), strict=True))


def run(spark, name):
    df = queries.QUERIES[name](spark, SF)
    return df, {r.doc_id: r for r in df.collect()}


def out_of_sample(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, name):
    import duckdb

    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    rel, df = c.sql(queries.ORACLES[name]), queries.QUERIES[name](spark, SF)
    order = sorted(df.columns)
    value = lambda v: f"{v:.9g}" if isinstance(v, float) else str(v)
    assert sorted(rel.columns) == order
    assert sorted([tuple(value(r[c]) for c in order) for r in df.collect()]) == sorted([tuple(value(r[rel.columns.index(c)]) for c in order) for r in rel.fetchall()])


def test_token_files(spark, texts):
    df, got = run(spark, "op3_token_files")
    assert dict(df.dtypes) == {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"}
    tok, at = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 0
    for i in sorted(texts):
        ids = np.array([*tok.encode(texts[i] or "", add_special_tokens=False).ids, 2], "<u4")
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (at, len(ids), zlib.crc32(ids))
        at += len(ids)


def test_packing(spark, texts):
    df = queries.QUERIES["op4_packing"](spark, SF)
    assert set(df.dtypes) >= {("doc_id", "bigint"), ("start", "bigint"), ("length", "bigint"), ("ids_crc32", "bigint"), ("doc_tokens", "bigint"), ("sequence_id", "bigint"), ("offset", "bigint")}
    tok, pieces, rows = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), defaultdict(list), defaultdict(list)
    for r in df.collect():
        pieces[r.doc_id].append(r)
        rows[r.sequence_id].append(r)
    assert set(pieces) == set(texts)
    for i, t in texts.items():
        ids, at = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 1], "<u4"), 0
        for r in sorted(pieces[i], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[at : at + r.length])
            at += r.length
        assert at == len(ids)
    for own in rows.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    used = sum(r.length for own in rows.values() for r in own)
    whole = sum(n if not n & (n - 1) else 2048 for n in (sum(r.length for r in own) for own in rows.values()))
    assert used >= 0.9 * whole


def test_near_duplicates(spark, texts):
    """Plain sets of word fives: whatever is far above the threshold is in one class, and a class is joined by links near it."""
    df, got = run(spark, "op5_near_dup")
    assert set(got) == set(texts) and df.columns == ["doc_id", "class_id", "is_first"]
    fives = {}
    for i, t in texts.items():
        w = (t or "").lower().split()
        fives[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else {("", i)}
    ids = sorted(texts)
    near = defaultdict(list)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            s = len(fives[a] & fives[b]) / len(fives[a] | fives[b])
            if texts[a] is not None and (texts[a] == texts[b] or s >= 0.87):
                assert got[a].class_id == got[b].class_id
            if s >= 0.7:
                near[a].append(b)
                near[b].append(a)
    for own in {r.class_id for r in got.values()}:
        members = {i for i, r in got.items() if r.class_id == own}
        seen, todo = set(), [min(members)]
        while todo:
            if (i := todo.pop()) not in seen:
                seen.add(i)
                todo += [j for j in near[i] if j in members]
        assert seen == members and own == min(members) and sum(got[i].is_first for i in members) == 1


def test_secrets(spark, texts):
    df, got = run(spark, "op6_secret_scan")
    assign = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
    for i, t in texts.items():
        spans = [("assign", m) for m in assign.finditer(t or "") if len(m[2]) >= 8]
        spans += [("access", m) for m in re.finditer(r"AKIA[A-Z0-9]+", t or "") if len(m[0]) >= 16] + [("hex", m) for m in re.finditer(r"[0-9a-f]+", t or "") if len(m[0]) >= 32]
        spans.sort(key=lambda s: (s[1].start(), ("assign", "access", "hex").index(s[0])))
        joined = [f"{k}:{m.start()}:{m.end()}" for k, m in spans]
        assert got[i].base_sha256 == hashlib.sha256(",".join(joined).encode()).hexdigest()
        assert (got[i].n_assign, got[i].n_access, got[i].n_hex) == tuple(sum(k == kind for k, _ in spans) for kind in ("assign", "access", "hex"))
        assert [s for s in got[i].spans.split(",") if s and not s.startswith("random")] == joined


def test_languages(spark, texts):
    df, got = run(spark, "op7_language_id")
    lang = dict(zip(*(pq.read_table(f"{SF}/documents.parquet").column(c).to_pylist() for c in ("doc_id", "lang")), strict=True))
    assert set(got) == set(texts) and all(r.held_out == out_of_sample(i) and 0 <= r.score <= 1 for i, r in got.items())
    assert all((r.lang_pred == "und") == (not any(map(str.isalpha, texts[i] or ""))) for i, r in got.items())
    test = [i for i in texts if out_of_sample(i) and lang[i] and got[i].lang_pred != "und" and len(texts[i].split()) >= 5]
    assert test and np.mean([got[i].lang_pred == lang[i] for i in test]) >= 0.95


def test_quality(spark, texts):
    df, got = run(spark, "op8_quality_classifier")
    t = pq.read_table(f"{SF}/labels.parquet")
    label = dict(zip(*(t.column(c).to_pylist() for c in ("doc_id", "quality")), strict=True))
    assert set(got) == set(texts) and all(r.held_out == out_of_sample(i) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for i, r in got.items())
    test = [i for i in label if out_of_sample(i) and i in texts and label[i] is not None]
    assert np.mean([got[i].predicted == label[i] for i in test]) >= 0.8


def test_bpe(spark, texts):
    df, got = run(spark, "op9_bpe_table")
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for i, t in texts.items():
        ids = tok.encode(t or "", add_special_tokens=False).ids
        assert (got[i].n_tokens, got[i].ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4")).hexdigest())
        assert got[i].decoded_sha256 == hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_pictures(spark):
    rows = queries.QUERIES["op10_media_copies"](spark, SF).collect()
    label = {r.media_id: r.class_id for r in rows}
    ids = pq.read_table(f"{SF}/embeddings.parquet").column("vec_id").to_pylist()
    assert len(rows) == 2 * len(ids)
    assert np.mean([label[2 * i] == label[2 * i + 1] for i in ids]) >= 0.93
    assert math.isclose(len(set(label.values())), len(ids), rel_tol=0.1)
