"""Stages of the pipeline on columns whose names clash with their own."""

import pytest

import corpus_pipeline
from frames import prose

NAMES = ["_digest", "_of", "_gone", "_place", "_score", "score", "size", "key", "c0", "component", "a.b"]


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_carry_columns_of_any_name(spark, name):
    texts = [prose(1, 80), prose(1, 80).upper(), prose(1, 80) + " end", prose(2, 80), None, ""]
    rows = [(i, t, "s", i * 7) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, source string, x bigint")
    frame = frame.selectExpr("doc_id", "text", "source", *[f"x + {i} as `{n}`" for i, n in enumerate(NAMES)])
    left = dict(corpus_pipeline.STAGES)[name](spark, frame, "/root/testdata/sf0.001")
    carried = [n for n in NAMES if name != "mix" or n != "size"]
    if name != "mix":
        assert left.columns == frame.columns
    found = left.collect()
    assert found or name == "quality"
    for row in found:
        for n in carried:
            assert row[n] == row.doc_id * 7 + NAMES.index(n)
