"""Registered queries as they are registered, on a folder of tables with odd rows."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from pointset.llm import queries

from . import brute
from .test_operators import EDGES, SF_DIR, SHAPE


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The smallest documents and the edge cases, with columns of clashing names."""
    path = tmp_path_factory.mktemp("tables")
    edges = [e for i, e in enumerate(EDGES) if e not in EDGES[:i]]
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").unionByName(spark.createDataFrame(edges, SHAPE))
    clash = {name: F.lit("?") for name in ("_row", "size", "finish", "taken", "spans", "score", "node", "part", "start", "_th")}
    docs.withColumns(clash).repartition(3).write.parquet(f"{path}/documents.parquet")
    return str(path)


@pytest.fixture(scope="module")
def rows(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet").collect()


def by_id(found):
    out = {r.doc_id: r for r in found.collect()}
    assert found.count() == len(out)
    return out


def test_mixing(spark, folder, rows):
    found = by_id(queries.op2_mixing(spark, folder))
    sizes, taken = Counter(), Counter()
    for r in rows:
        n = len(brute.words(r.text))
        sizes[r.source] += n
        taken[r.source] += found[r.doc_id].taken
        assert found[r.doc_id].size == n and 0 <= found[r.doc_id].taken <= 2 * n
    targets = brute.targets(sizes)
    assert all(abs(taken[s] - float(targets[s])) < 1 for s in sizes)
    assert all(found[r.doc_id].source_size == sizes[r.source] for r in rows)
    assert all(abs(found[r.doc_id].target - float(targets[r.source])) < 1e-6 for r in rows)
    assert by_id(queries.op2_mixing(spark, folder)) == found


def test_personal_data(spark, folder, rows):
    found = by_id(queries.op3_pii(spark, folder))
    names = ("email", "ip", "card", "phone")
    for r in rows:
        spans = brute.base_spans(r.text)
        base = [f"{names[k]}:{a}:{b}" for a, k, b in spans]
        own = found[r.doc_id]
        assert own.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [own.n_email, own.n_ip, own.n_card, own.n_phone] == [sum(s[1] == k for s in spans) for k in range(4)]
        assert set(base) <= set(own.spans.split(",")) | {""}


def test_language(spark, folder, rows):
    found = by_id(queries.op4_language(spark, folder))
    known = {r.lang for r in rows if r.lang}
    right = []
    for r in rows:
        own = found[r.doc_id]
        assert own.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        lettered = any(c.isalpha() for c in r.text or "")
        assert (own.lang_pred in known) if lettered else (own.lang_pred, own.score) == ("und", 0.0)
        assert 0 <= own.score <= 1
        if own.held_out and r.lang and len(r.text or "") > 60 and (r.doc_id or 0) < 9000:
            right.append(own.lang_pred == r.lang)
    assert np.mean(right) > 0.9


def test_tokens(spark, folder, rows):
    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    given = [(-1 if r.doc_id is None else r.doc_id, r.text) for r in rows]
    want = Counter(brute.tokens(given, plain, 2))
    found = queries.op7_tokens(spark, folder).collect()
    assert Counter((-1 if r.doc_id is None else r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in found) == want


def test_packing(spark, folder, rows):
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces, windows = defaultdict(list), defaultdict(list)
    for r in queries.op9_packing(spark, folder).collect():
        pieces[r.doc_id].append(r)
        windows[r.sequence_id].append(r)
    for r in rows:
        ids = [*plain.encode(r.text or "", add_special_tokens=False).ids, 0]
        own = sorted(pieces[r.doc_id], key=lambda p: p.start)
        assert [p.start for p in own] == np.cumsum([0, *[p.length for p in own]])[:-1].tolist()
        assert sum(p.length for p in own) == len(ids) and {p.doc_tokens for p in own} == {len(ids)}
        for p in own:
            assert zlib.crc32(np.array(ids[p.start : p.start + p.length], "<u4").tobytes()) == p.ids_crc32
    for own in windows.values():
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == np.cumsum([0, *[p.length for p in own]])[:-1].tolist()
        assert sum(p.length for p in own) <= 1024


def test_lines(spark, folder, rows):
    found = by_id(queries.op10_lines(spark, folder))
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert Counter(tuple(r[c] for c in columns) for r in found.values()) == Counter(brute.line_metrics(r.doc_id, r.text) for r in rows)
    assert not any(r.base_failed and r.kept for r in found.values())


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_on_odd_tables(spark, folder, name):
    """Null ids, null texts, clashing names, repeated rows and no rows at all."""
    stage = dict(corpus_pipeline.STAGES)[name]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    docs = docs.unionAll(docs.where("doc_id IS NULL OR doc_id IN (9001, 9007)"))
    found = stage(spark, docs, folder)
    if name != "packed":
        assert found.columns == corpus_pipeline.COLUMNS
    ids = Counter(r.doc_id for r in found.select("doc_id").collect())
    everywhere = {r.doc_id for r in docs.select("doc_id").collect()}
    assert set(ids) <= everywhere and 9004 in ids
    if name in ("redact", "packed"):
        assert set(ids) == everywhere
    if name == "language":
        # clean labelled texts stay, whatever their score
        clean = docs.where("lang IS NOT NULL AND text RLIKE '[A-Za-z]'").select("doc_id").collect()
        assert {r.doc_id for r in clean} <= set(ids) and 9001 not in ids and 9002 not in ids
    assert stage(spark, docs.where("false"), folder).count() == 0
