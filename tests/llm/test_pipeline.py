"""The pipeline's stages against brute-force versions, each on its own input."""

import re

import brute
import corpus_pipeline
import public_tokenizers as P
import pytest
import sentencepiece
from conftest import DOC_SCHEMA, SF
from egoline.llm.common import written
from pyspark.sql import functions as F
from test_filters import NORMAL, brute_hits, lower
from test_jaccard import brute as brute_components


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(written(stage(spark, out[-1], SF), "test-pipeline"))
    return out


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_are_the_dealt_ones():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "n-gram Jaccard join", "benchmark decontamination", "PII", "SentencePiece"]


def test_columns(steps):
    assert all(s.columns == steps[0].columns for s in steps[:-1])
    assert steps[-1].columns == [*steps[0].columns, "ids", "decoded"]


def test_quality_stage(steps):
    before, after = by_id(steps[0]), by_id(steps[1])
    assert after == {i: before[i] for i in after}
    gone = set(before) - set(after)
    assert {i for i, r in before.items() if brute.quality(r.text)[-1]} <= gone
    assert len(gone) < 0.4 * len(before)


def test_join_stage(steps):
    before, after = by_id(steps[1]), by_id(steps[2])
    assert after == {i: before[i] for i, _, least in brute_components([(i, r.text) for i, r in before.items()], 5, 80) if i == least}


def test_decontamination_stage(spark, steps):
    before, after = by_id(steps[2]), by_id(steps[3])
    items = [(str(r.item_id), NORMAL.findall(lower(r.text or ""))) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for i, r in before.items():
        ws = NORMAL.findall(lower(r.text))
        hit, _ = brute_hits(ws, items, 10)
        if not hit:
            assert after[i] == r
        elif len(hit) > 0.5 * len(ws):
            assert i not in after
        else:
            assert NORMAL.findall(lower(after[i].text)) == [w for k, w in enumerate(ws) if k not in hit]
            assert after[i].n_chars == len(after[i].text)


def test_pii_stage(steps):
    before, after = by_id(steps[3]), by_id(steps[4])
    assert set(before) == set(after)
    for i, r in before.items():
        spans = brute.base_spans(r.text)
        if not spans:
            assert after[i] == r
        else:
            assert not brute.base_spans(after[i].text) and len(re.findall(r"\[(EMAIL|IP|CARD|PHONE)\]", after[i].text)) >= 1


def test_encoding_stage_and_run(spark, steps):
    sp = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    before, after = by_id(steps[4]), by_id(steps[5])
    assert set(before) == set(after)
    assert all(r.ids == sp.encode(r.text) and r.decoded == sp.decode(r.ids) and r.text == before[i].text for i, r in after.items())
    assert by_id(corpus_pipeline.run(spark, SF)) == after


def test_edge_rows(spark):
    rows = [(1, None, None, None, None), (2, "", "en", None, 0), (None, "x " * 80, None, "s", 1), (4, "word " * 70_000, "en", "s", 9)]
    rows += [(10 + i, " ".join(f"t{i % 7}w{k * (i % 7 + 1)}" for k in range(60)), "en", "s", 7) for i in range(14)]
    d = spark.createDataFrame([(*r, "clash", 1) for r in rows], DOC_SCHEMA + ", ids string, c int")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        e = written(stage(spark, d, SF), "test-pipeline")
        assert e.columns == d.columns and stage(spark, d.limit(0), SF).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, d, SF).count() == len(rows)


def test_encoding_and_decoding_share_a_worker(table, capsys):
    from egoline.llm import sentencepiece_chunks as S

    stage, model = dict(corpus_pipeline.STAGES)["SentencePiece"], P.path("piece_bpe_32k.model")
    docs = table([(i, t, "x") for i, t in enumerate(["a b", "", None, "Zeile\nzwei", "ﬁne ｆｕｌｌ", "a b"])], "doc_id long, text string, lang string")
    got = stage(docs.sparkSession, docs.withColumn("ids", F.lit("x")).withColumn("decoded", F.lit(1)), "")
    want = S.decode(S.encode(docs, model), model)
    assert got.schema == want.schema and sorted(got.collect(), key=str) == sorted(want.collect(), key=str)
    capsys.readouterr()
    got.explain()
    assert capsys.readouterr().out.count("MapInArrow") == 1
