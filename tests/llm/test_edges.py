"""Every operator and stage over edge rows and over empty tables."""

import numpy as np
import public_tokenizers
import pytest

from tables import SF_SMALL, edge, edge_labels  # noqa: F401  isort: skip

import corpus_pipeline
from ontime.llm.byte_bpe import byte_bpe
from ontime.llm.exact_dedup import exact_dedup, keep_first
from ontime.llm.hmm_lm import hmm_lm
from ontime.llm.jaccard_join import jaccard_join
from ontime.llm.license_scan import license_scan
from ontime.llm.mixing import mixing
from ontime.llm.pii_crf import pii_crf
from ontime.llm.quality_rules import quality_rules
from ontime.llm.suffix_dedup import suffix_dedup
from ontime.llm.toxicity import toxicity


def bpe(docs, _):
    return byte_bpe(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


OPERATORS = {
    "exact_dedup": lambda d, _: exact_dedup(d), "toxicity": toxicity, "hmm_lm": lambda d, _: hmm_lm(d),
    "suffix_dedup": lambda d, _: suffix_dedup(d), "pii_crf": lambda d, _: pii_crf(d),
    "license_scan": lambda d, _: license_scan(d), "jaccard_join": lambda d, _: jaccard_join(d),
    "quality_rules": lambda d, _: quality_rules(d), "byte_bpe": bpe, "mixing": mixing,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_edge_rows_give_a_row_each(edge, edge_labels, name):
    rows = OPERATORS[name](edge, edge_labels).collect()
    assert sorted(r["doc_id"] or -1 for r in rows) == sorted(r["doc_id"] or -1 for r in edge.collect())
    assert len({repr(r) for r in rows if r["doc_id"] == 1}) == (2 if name == "exact_dedup" else 1)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(edge, edge_labels, name):
    assert OPERATORS[name](edge.limit(0), edge_labels.limit(0)).collect() == []


def test_exact_dedup_defined_cases(edge):
    rows = exact_dedup(edge).collect()
    fox = [r for r in rows if r.doc_id in (1, 2)]
    assert {r.keep_id for r in fox} == {1} and {r.group_size for r in fox} == {3} and sum(r.kept for r in fox) == 1
    empty = {r.doc_id: r for r in rows if r.doc_id in (3, 4)}
    assert empty[3].kept and not empty[4].kept and empty[4].keep_id == 3
    kept = keep_first(edge)
    assert kept.columns == edge.columns
    assert sorted((r.doc_id or -1) for r in kept.collect()) == [-1, 1, 3, 5, 6, 7, 8]


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES[:-1])
def test_stages_keep_the_columns(spark, edge, name, stage):
    out = stage(spark, edge, SF_SMALL)
    assert out.columns == edge.columns
    kept = {r.doc_id for r in out.collect()}
    assert kept >= {1, 3, 5, 6, 7, 8, None}
    assert stage(spark, edge.limit(0), SF_SMALL).count() == 0


def test_pii_reads_very_long_digit_runs(spark):
    text = "9" * 6000 + ".1.1.1 and " + "0" * 6000 + "1.2.3.4 end"
    row = pii_crf(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row.n_ip == 1


def test_byte_bpe_of_neighbouring_copies(spark, monkeypatch):
    rows = [(k // 3, "hello wörld " * (k // 3)) for k in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    out = byte_bpe(frame.coalesce(1), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, keep_ids=True)
    got = sorted((r.doc_id, r.n_tokens, len(r.ids), r.ids_sha256) for r in out.collect())
    one = {r.doc_id: r for r in bpe(frame.dropDuplicates(["doc_id"]), None).collect()}
    assert got == sorted((d, one[d].n_tokens, one[d].n_tokens, one[d].ids_sha256) for d, _ in rows)


def test_toxic_rows_leave_whatever_their_id(spark, monkeypatch):
    from ontime.llm import toxicity as module
    monkeypatch.setattr(module, "train", lambda *_: (["=badword"], np.array([9.0] + [0.0] * len(module.PATTERNS) + [-4.0])))
    rows = [(1, "a clean text", 5), (1, "badword here", 6), (None, "badword too", 7), (None, "clean", 8), (2, None, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score long")
    kept = module.drop_toxic(docs, None)
    assert kept.columns == docs.columns and sorted(r.score for r in kept.collect()) == [5, 8, 9]


def test_stages_keep_clashing_columns(spark, edge):
    clash = edge.selectExpr("*", "77 as place", "78 as key_id", "79 as copies", "80 as copy", "81 as label")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, clash, SF_SMALL)
        assert out.columns == clash.columns
        assert {(r.place, r.key_id, r.copies, r.copy, r.label) for r in out.collect()} == {(77, 78, 79, 80, 81)}


def test_tokenize_stage_over_edge_rows(spark, edge):
    out = dict(corpus_pipeline.STAGES)["byte_bpe"](spark, edge, SF_SMALL).collect()
    assert len(out) == edge.count() and all(r.n_tokens == len(r.ids) for r in out)
