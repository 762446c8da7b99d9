"""The registered queries on the given tables, against SQL, brute force, a library or held-out labels."""

import os

import brute
import pytest
import sentencepiece
from compare import connect, rows_of

from tidewater.llm.queries import ORACLES, PIECES, QUERIES, TOKENIZERS

FOLDER = os.environ.get("TIDEWATER_TESTDATA", "/root/testdata/sf0.001")
WIDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    return sorted((r.doc_id, r.text) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    df = QUERIES[name](spark, FOLDER)
    want = connect(FOLDER).sql(ORACLES[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(want.columns, want.fetchall())


def test_near_duplicates(spark, texts):
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in QUERIES["op1_minhash_dedup"](spark, FOLDER).collect()}
    assert got == brute.near_duplicates(texts)


def test_repeats(spark, texts):
    got = sorted(tuple(r) for r in QUERIES["op3_suffix_dedup"](spark, FOLDER).collect())
    assert got == brute.without_repeats(texts)


def test_licenses(spark, texts):
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op4_license_scan"](spark, FOLDER).collect()}
    assert got == {i: brute.licenses(t) for i, t in texts}


def test_pieces(spark, texts):
    library = sentencepiece.SentencePieceProcessor(model_file=f"{TOKENIZERS}/{PIECES}")
    got = {r.doc_id: r for r in QUERIES["op5_sentencepiece"](spark, FOLDER).collect()}
    assert len(got) == len(texts)
    for i, text in texts:
        assert list(got[i].ids) == library.encode(text)
        assert (got[i].n_ids, got[i].decoded) == (len(got[i].ids), text)


def test_quality(spark):
    scored = QUERIES["op2_quality_classifier"](spark, WIDER)
    assert scored.columns == ["doc_id", "held_out", "score", "predicted"]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{WIDER}/labels.parquet").collect()}
    rows = [r for r in scored.collect() if r.held_out and r.doc_id in labels]
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert sum(r.predicted == labels[r.doc_id] for r in rows) >= 0.93 * len(rows) > 50


def test_pages(spark):
    rows = QUERIES["op7_html_extraction"](spark, FOLDER).collect()
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    assert len(rows) == len(pages)
    for r in rows:
        assert r.n_chars == len(r.text) > 0
        assert not any(beside in r.text for beside in ("©", "<", "track(", "margin:0"))
        title = pages[r.page_id].partition("<h1>")[2].partition("</h1>")[0]
        if "&" not in title:
            assert r.text.startswith(" ".join(title.split()))


def test_shards(spark, texts):
    rows = QUERIES["op13_sharding"](spark, FOLDER).collect()
    assert {r.doc_id: (r["size"], r.text_crc32, r.shard) for r in rows} == brute.shards(texts)
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
        assert r.law == "bytes" and r.grown_shard is None
    assert sorted(slots) == list(range(16)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
