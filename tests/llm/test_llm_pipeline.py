"""The pipeline, stage by stage, each on what the one before it kept."""

import brute
import corpus_pipeline
import pytest
import sentencepiece
from compare import connect

from tidewater.llm.queries import ORACLES, PIECES, TOKENIZERS

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The rows after each stage, written and read again, and a database with the documents of each."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, out[-1], FOLDER).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def sql(docs, name):
    con = connect(FOLDER)
    con.register("kept_documents", docs.toArrow())
    con.sql("CREATE OR REPLACE VIEW documents AS SELECT * FROM kept_documents")
    return [dict(zip(con.sql(ORACLES[name]).columns, r, strict=True)) for r in con.sql(ORACLES[name]).fetchall()]


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_columns(stages):
    assert [s.columns for s in stages[1:5]] == [stages[0].columns] * 4


def test_rules(stages):
    assert ids(stages[1]) == sorted(r["doc_id"] for r in sql(stages[0], "op6_quality_rules") if r["kept"])


def test_exact(stages):
    assert ids(stages[2]) == sorted(r["doc_id"] for r in sql(stages[1], "op9_exact_dedup") if r["kept"])


def test_near(stages):
    want = brute.near_duplicates([(r.doc_id, r.text) for r in stages[2].collect()])
    assert ids(stages[3]) == sorted(i for i, (_, _, kept) in want.items() if kept)


def test_mix(stages):
    want = [r["doc_id"] for r in sql(stages[3], "op10_mixing") for _ in range(r["copies"])]
    assert ids(stages[4]) == sorted(want)


def test_pieces(spark, stages):
    library = sentencepiece.SentencePieceProcessor(model_file=f"{TOKENIZERS}/{PIECES}")
    want = sorted((r.doc_id, library.encode(r.text)) for r in stages[4].collect())
    assert sorted((r.doc_id, list(r.ids)) for r in stages[5].collect()) == want
    assert sorted(map(str, corpus_pipeline.run(spark, FOLDER).collect())) == sorted(map(str, stages[5].collect()))
