import importlib
import re

import corpus_pipeline as C
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest import SF_SMALL
from edustar.llm import pii_crf as P
from helpers_llm import docs_of, shingle_set
from test_llm_dedup import near_brute
from test_llm_tokens import PATH, check_packing


@pytest.fixture(scope="module")
def kept(spark):
    """The result of each stage as rows, each stage run on what was written of the one before."""
    from edustar.llm.common import written
    docs, out = spark.read.parquet(f"{SF_SMALL}/documents.parquet"), []
    columns = docs.columns
    for name, stage in C.STAGES:
        docs = written(stage(spark, docs, SF_SMALL), f"test-{name}")
        if name != C.STAGES[-1][0]:
            assert docs.columns == columns
        out.append(docs.collect())
    return out


def test_stages_equal_brute_force(spark, kept):
    quality, exact, near, masked, pieces = kept
    first = {}
    for r in sorted(quality, key=lambda r: r.doc_id):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r.text or ""), r.doc_id)
    assert sorted(r.doc_id for r in exact) == sorted(first.values())
    assert sorted(r.doc_id for r in near) == sorted(i for i, _, c in near_brute([(r.doc_id, r.text) for r in exact]) if i == c)
    text = {r.doc_id: r.text for r in near}
    assert {r.doc_id for r in masked} == set(text)
    for r in masked:
        if not any(P.base_spans(text[r.doc_id]).values()):
            assert r.text == text[r.doc_id]
        assert not any(P.base_spans(r.text)[k] for k in ("email", "ip", "card")) and r.n_chars == len(r.text)
    assert check_packing(pieces, {r.doc_id: r.text for r in masked}, Tokenizer.from_file(PATH))[0] == 0


def test_the_filter_keeps_clean_documents(spark, kept):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
    ids = {r.doc_id for r in kept[0]}
    good = [i for i, q in labels.items() if q == 1]
    assert sum(i in ids for i in good) >= 0.98 * len(good)
    assert sum(i in ids for i, q in labels.items() if q == 0) <= 0.1 * len(labels)


def test_run_is_the_stages(spark, kept):
    assert sorted(map(tuple, C.run(spark, SF_SMALL).drop("sequence_id").collect()))[:50] == sorted(
        tuple(v for k, v in r.asDict().items() if k != "sequence_id") for r in kept[-1])[:50]


def test_stages_of_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0)
    from edustar.llm.common import written
    for name, stage in C.STAGES:
        docs = written(stage(spark, docs, SF_SMALL), f"test-empty-{name}")
        assert docs.count() == 0


def test_stages_with_null_ids_and_clashing_names(spark):
    from edustar.llm.common import written
    near = " ".join(f"word{i}" for i in range(60))
    rows = [(1, near), (2, near + " more"), (3, "An own text with mail a@b.co and a@b.co in it"), (None, "a text without a number"), (None, "a text without a number"), (4, None), (5, ""),
            (3, "another text under three"), (6, "AN OWN  text"), (7, "AN OWN\ntext"), (8, "z" * 1_000_000)]
    docs = docs_of(spark, rows, clash=True).withColumn("n_chars", F.length("text"))
    columns, kept = docs.columns, None
    for name, stage in C.STAGES[1:]:
        docs = written(stage(spark, docs, SF_SMALL), f"clash-{name}")
        if name != C.STAGES[-1][0]:
            assert docs.columns == columns
            kept = sorted((str(r.doc_id), r.text) for r in docs.collect()) if name != "pii_masking" else kept
    assert [i for i, _ in kept] == ["1", "3", "3", "4", "6", "8", "None"] and ("None", "a text without a number") in kept
    pieces = docs.collect()
    assert {str(r.doc_id) for r in pieces} == {i for i, _ in kept}


def test_operators_do_not_hide_import_errors():
    for m in ("bpe", "common", "components", "exact_dedup", "fill_middle", "license_scan", "line_dedup", "ngram_join", "packing", "pii_crf", "quality_fm",
              "queries", "spelling_fst", "toxicity", "vector_search", "warc"):
        src = open(importlib.import_module(f"edustar.llm.{m}").__file__).read()
        assert "except ImportError" not in src and "except ModuleNotFoundError" not in src


def test_shingle_helper():
    assert len(shingle_set("a b c d e")) == 2 and docs_of is not None
