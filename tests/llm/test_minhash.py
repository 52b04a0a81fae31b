"""Near copies against brute force over all pairs of shingle sets."""

import numpy as np
import oracle
import plain
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from siltstone.llm import minhash, queries, sql


def families(rnd, count, copies, most_words=300, changed=15):
    """Texts of which some share most of their words."""
    texts = {}
    for _ in range(count):
        base = [f"w{x}" for x in rnd.integers(0, 10**6, int(rnd.integers(3, most_words)))]
        for _ in range(copies):
            made = list(base)
            for at in rnd.integers(0, len(made), int(rnd.integers(0, 1 + len(made) // changed))):
                made[at] = f"x{rnd.integers(0, 10**6)}"
            texts[len(texts)] = " ".join(made)
    return texts


@pytest.mark.parametrize("similar", [(85, 100), (4, 5), (1, 1)])
def test_against_all_pairs(spark, monkeypatch, similar):
    texts = families(np.random.default_rng(5), 12, 15) | {1000: None, 1001: "", 1002: " \n", 1003: "two words", 1004: "TWO  Words", 1005: "three"}
    linked = plain.links(texts, similar)
    least = plain.classes(linked, texts)
    rows = list(texts.items())
    docs = spark.createDataFrame([*rows, *rows[:20], *rows[:1] * 40], "doc_id long, text string").withColumn("node", F.lit("clash"))
    want = sorted({(i, len(plain.shingles(t)), least[i], least[i] == i) for i, t in rows})
    assert len(linked) > 20 and (similar == (1, 1) or any(plain.shingles(texts[a]) != plain.shingles(texts[b]) for a, b in linked))
    assert sorted(map(tuple, minhash.near_duplicates(docs, similar=similar).distinct().collect())) == want
    monkeypatch.setattr(minhash, "BROADCAST_ROWS", -1)
    made = minhash.near_duplicates(docs, similar=similar)
    assert made.count() == docs.count()
    assert sorted(map(tuple, made.distinct().collect())) == want
    assert sorted(r[0] for r in minhash.duplicates(docs, similar=similar).collect()) == [i for i, _, _, kept in want if not kept]


def test_rows_it_must_bear(spark):
    docs = plain.edge_docs(spark)
    made = minhash.near_duplicates(docs).collect()
    assert len(made) == docs.count()
    texts = {r["doc_id"]: r["text"] for r in docs.where("doc_id is not null").collect()}
    least = plain.classes(plain.links(texts), texts)
    assert {(r["doc_id"], r["component_id"]) for r in made if r["doc_id"] is not None} == set(least.items())
    assert sorted((r["n_shingles"], r["component_id"], r["kept"]) for r in made if r["doc_id"] is None) == [(0, None, True), (2, None, True)]
    assert minhash.near_duplicates(plain.empty_docs(spark)).collect() == []


def test_null_keys_of_different_texts(spark):
    long = [f"{c}{i}" for c in "ab" for i in range(60)]
    rows = [(None, " ".join(long[:60])), (None, " ".join(long[60:])), (3, " ".join([*long[:59], "end"])), (None, " ".join(long[:60]))]
    made = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, made), key=repr) == [(3, 56, 3, True), (None, 56, 3, False), (None, 56, 3, False), (None, 56, None, True)]


def pairs_verified(spark, monkeypatch, texts, similar):
    seen = []
    verified = minhash._verified

    def counted(pairs, *others):
        seen.append(pairs.count())
        return verified(pairs, *others)

    monkeypatch.setattr(minhash, "_verified", counted)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    classes = minhash.near_duplicates(docs, similar=similar).select("component_id").distinct().count()
    return sum(seen), classes


def test_texts_that_are_not_alike_enough_are_not_compared(spark, monkeypatch):
    """Pairs to verify grow with a group of texts of similarity 0.6, not with its square."""
    counts = []
    for n in (100, 200):
        common = " ".join(f"w{i}" for i in range(75))
        texts = {i: " ".join([common, *(f"x{i}at{at}" for at in range(20))]) for i in range(n)}
        found, classes = pairs_verified(spark, monkeypatch, texts, (4, 5))
        counts.append(found)
        assert classes == len(set(plain.classes(plain.links(texts, (4, 5)), texts).values()))
    assert counts[1] <= max(2.5 * counts[0], 100)


def test_bands_miss_little():
    for similar in ((85, 100), (4, 5), (1, 2), (99, 100)):
        rows, s = minhash.band_rows(similar), similar[0] / similar[1]
        assert (1 - s**rows) ** (minhash.BINS // rows) <= minhash.MISS
    assert minhash.band_rows() == 9
    with pytest.raises(ValueError):
        minhash.band_rows((1, 100))


@pytest.mark.parametrize("size", [7, 40, 300, 5_000])
def test_densified_bins_agree_as_often_as_sets_do(size):
    """Equal bins are as frequent as the similarity, also where most bins are empty."""
    signer = minhash.Signer(9)
    rnd = np.random.default_rng(size)
    shares = []
    for _ in range(60):
        union = np.unique(rnd.integers(0, 1 << 64, size, np.uint64))
        a, b = np.delete(union, np.s_[0 : size // 7]), np.delete(union, np.s_[size - size // 7 :])
        rnd.shuffle(union)
        a, b = np.sort(union[size // 7 :]), np.sort(union[: size - size // 7])
        shares.append((signer.signature(a) == signer.signature(b)).mean())
    true = (size - 2 * (size // 7)) / size
    assert abs(np.mean(shares) - true) < 0.03


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    assert oracle.compare(queries.QUERIES["op13_minhash"](spark, sf), oracle.connect(sf), sql.NEAR_COPIES) == []


@given(st.sets(st.integers(0, 3_000), min_size=1, max_size=400), st.sets(st.integers(0, 3_000), min_size=1, max_size=400))
@settings(max_examples=60, deadline=None)
def test_places_bound_what_is_shared(a, b):
    """What the bound on shared members rests on."""
    hashed = [np.unique(np.array(sorted(x), np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for x in (a, b)]
    on = [np.unpackbits(minhash._place_bits(h).view(np.uint8)).astype(bool) for h in hashed]
    both = (on[0] & on[1]).sum()
    assert len(a & b) <= min(len(a) - on[0].sum() + both, len(b) - on[1].sum() + both)
