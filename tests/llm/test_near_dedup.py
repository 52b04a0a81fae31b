"""The stage against brute force over all pairs: no near copy of five-word shingles may stay."""

import plain
import pytest

import corpus_pipeline as pipeline

SF = "/root/testdata/sf0.01"


def test_no_near_copy_stays(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = dict(docs.select("doc_id", "text").collect())
    apart = [i for i, _, least in plain.near_duplicates(list(texts.items())) if i == least]
    linked = plain.links({i: texts[i] for i in apart}, (4, 5))
    least = plain.classes(linked, apart)
    assert len(linked) >= 4  # which four bits leave
    kept = [r["doc_id"] for r in pipeline.near_dedup(spark, docs, SF).select("doc_id").collect()]
    assert sorted(kept) == [i for i in sorted(apart) if least[i] == i]


@pytest.mark.parametrize("words", [248, 60])
def test_two_words_replaced(spark, words):
    found = [f"word{i}" for i in range(words)]
    near = found[:9] + ["other"] + found[10:-1] + ["end"]
    docs = spark.createDataFrame([(7, " ".join(found)), (8, " ".join(near)), (9, "another text " * 9)], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in pipeline.near_dedup(spark, docs, SF).collect()) == [7, 9]
