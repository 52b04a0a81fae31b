"""The quality stage judges each row by its own source."""

import pytest

import corpus_pipeline as pipeline


@pytest.mark.parametrize("doc_id", [None, 7])
def test_equal_texts_of_different_sources(spark, doc_id):
    """Symbols are common in one source and rare in another, so one of two equal texts goes."""
    def text(i, joint):
        return joint.join(f"w{i}n{k}" for k in range(40))

    rows = [(i + 10, text(i, " ") if i % 2 else text(i, " | "), "en", "prose" if i % 2 else "tables", 1) for i in range(600)]
    rows += [(doc_id, text(1000, " | "), "en", "prose", 1), (doc_id, text(1000, " | "), "en", "tables", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = pipeline.quality_rules(spark, docs, "").where(f"doc_id <=> {doc_id or 'null'}").collect()
    assert [r["source"] for r in kept] == ["tables"]
