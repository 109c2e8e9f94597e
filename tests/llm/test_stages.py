"""Stages of the pipeline on tables with further columns, null ids and nulls everywhere."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline

SENTENCE = {"en": "the cat sat on the mat and the dog ran to the house with the old man", "de": "die katze sitzt auf der matte und der hund läuft mit dem alten mann in das haus"}
#: Names that operators use for columns of their own.
CLASHES = ("turn", "gone", "own_key", "gone_id", "_gone", "items", "n_words", "score", "lang_pred", "row", "node", "hit_from", "size", "rest of it")


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, f"{SENTENCE[lang]} {i} " + " ".join(f"{lang}{i}x{k}" for k in range(20)), lang, "web", 1) for i in range(30) for lang in SENTENCE]
    rows += [(None, rows[4][1], "en", None, None), (99, None, None, None, None), (98, "", None, "web", 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_further_columns_pass_unchanged(spark, docs, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    wide = docs.withColumns({c: F.concat(F.lit(c), F.coalesce(F.md5("text"), F.lit("-"))) for c in CLASHES})
    out = stage(spark, wide, "/root/testdata/sf0.001")
    assert out.columns == wide.columns
    rows, plain = out.collect(), stage(spark, docs, "/root/testdata/sf0.001").collect()
    key = lambda r: repr((r.doc_id, r.text, r.lang, r.source, r.n_chars))
    assert sorted(map(key, rows)) == sorted(map(key, plain)) and rows
    before = {tuple(r[c] for c in CLASHES) for r in wide.collect()}
    assert all(tuple(r[c] for c in CLASHES) in before for r in rows)
