"""Fill-in-middle against a brute-force version over code points, and exact round trips."""

import hashlib

import numpy as np
import oracle
import plain
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from siltstone.llm import fim, queries, sql

MARKS = [m.encode() for m in fim.MARKS]


def numbers(key, seed=1):
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    return [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]


def brute(h, text, plain_percent=10, spm_percent=20):
    text = text or ""
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in fim.MARKS) or h[2] % 100 >= 100 - plain_percent:
        return n, "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    if h[3] % 100 < spm_percent:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from("aé日\U0001f600 \n<PSM>\x00\x7f\x80߿￿"), max_size=30), min_size=1, max_size=30))
def test_cut_of_any_texts(texts):
    h = [numbers(i) for i in range(len(texts))]
    column = pa.array([b"before", *(t.encode() for t in texts)], pa.large_binary()).slice(1)
    made = fim.cut(column, list(np.array(h).T), MARKS, 10, 20)
    assert [(int(n), f, p, m, o.decode()) for n, f, p, m, o in zip(*made)] == [brute(x, t) for x, t in zip(h, texts)]


def test_every_place_of_a_word():
    text = "aé日\U0001f600" * 7
    units = fim.Units(np.frombuffer(text.encode(), np.uint8))
    count = np.arange(len(text) + 1)
    assert units.select(count).tolist() == [len(text[:k].encode()) for k in count]
    assert units.rank(units.select(count)).tolist() == count.tolist()


def test_against_brute_force(spark):
    docs = plain.edge_docs(spark, ["has <P> inside", "<", "<<", "日" * 100_000, "<P", "S>", "\U0001f600"])
    for percents in ((10, 20), (0, 0), (0, 100), (100, 0)):
        made = fim.transform(docs, plain_percent=percents[0], spm_percent=percents[1])
        found = made.select("*", fim.restore(F.col("output"), F.col("form")).alias("again")).collect()
        rows = docs.select("doc_id", "text").collect()
        want = sorted([(r[0], *brute(numbers(r[0]), r[1], *percents), r[1] or "") for r in rows], key=repr)
        assert sorted(map(tuple, found), key=repr) == want
    assert fim.transform(plain.empty_docs(spark)).collect() == []


def test_long_texts_are_cut_alone(spark, monkeypatch):
    monkeypatch.setattr(fim, "SLICE_BYTES", 64)
    batch = pa.record_batch([pa.array(range(5))], ["k"])
    column = pa.array([b"a" * 10, b"b" * 500, b"", b"c" * 60, b"d" * 5], pa.large_binary())
    assert list(fim._slices(batch, column)) == [(0, 1), (1, 1), (2, 2), (4, 1)]


def test_marks_that_could_be_mistaken():
    for bad in (("<P>", "<P>", "<M>"), ("aba", "x", "y"), ("ab", "bc", "z"), ("<P>", "P", "z"), ("", "a", "b"), ("a", "b")):
        with pytest.raises(ValueError):
            fim._checked(bad)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    assert oracle.compare(queries.QUERIES["op11_fill_in_middle"](spark, sf), oracle.connect(sf), sql.FILL_IN_MIDDLE) == []
