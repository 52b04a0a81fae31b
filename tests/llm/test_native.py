"""Quality rules, decontamination, secrets and the ring, built from DataFrame functions alone."""

import random
import time

import oracle
import plain
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from siltstone.llm import decontaminate, quality, ring, secret_scan
from siltstone.session import materialise

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = driver.queries(), driver.oracle_sql()


@pytest.mark.parametrize("name", [n for n in sorted(ORACLES) if n.startswith("op")])
def test_against_sql(spark, name):
    larger = SF.replace("0.001", "0.01")
    assert oracle.compare(QUERIES[name](spark, larger), oracle.connect(larger), ORACLES[name]) == []


def test_no_python_in_native_plans(spark):
    for name in ("op4_secret_scan", "op5_sharding", "op9_decontaminate", "op10_quality"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().toString()
        assert not any(word in plan for word in ("Arrow", "Pandas", "Python")), name


def test_measures(spark):
    docs = plain.edge_docs(spark, ["a b c d e f g h " * 3 + "z", "# $ %&|<>* x", "line\n line\nline\n\n \n \n"])
    rows = quality.base_measures(docs, ["doc_id", "text"]).collect()
    assert len(rows) == docs.count()
    for r in rows:
        text, found = r["text"] or "", plain.words(r["text"])
        assert r["n_words"] == len(found) and r["word_chars"] == sum(map(len, found))
        assert r["n_symbols"] == sum(c in "#*$%&|<>" for c in text)
        assert r["n_dup_lines"] == plain.dup_lines(text) and r["n_repeat_words"] == plain.repeat_words(text)


def test_buckets_keep_order(spark):
    values = sorted({*range(300), *(random.Random(1).randrange(1 << 40) for _ in range(300))})
    rows = spark.createDataFrame([(v,) for v in values], "v long").select("v", quality.bucket(F.col("v")).alias("b")).select(
        "v", "b", quality.bucket_edge(F.col("b"), False).alias("low"), quality.bucket_edge(F.col("b"), True).alias("high")
    ).orderBy("v").collect()
    assert [r["b"] for r in rows] == sorted(r["b"] for r in rows)
    assert all(r["low"] <= r["v"] <= r["high"] and r["high"] - r["low"] <= r["v"] / 32 for r in rows)


def test_sketches_merge(spark):
    measured = quality.base_measures(spark.read.parquet(f"{SF}/documents.parquet"), ["doc_id", "lang", "source"])
    parts = quality.sketches(measured.where("doc_id % 2 = 0"), ["lang"]).unionByName(quality.sketches(measured.where("doc_id % 2 = 1"), ["lang"]))
    merged = parts.groupBy("lang", "measure", "bucket").agg(F.sum("n").alias("n"))
    whole = quality.sketches(measured, ["lang"]).select(*merged.columns)
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, whole.collect()))


def test_fences_follow_the_group(spark):
    """Forty symbols in a hundred are common in one source and rare in another."""
    def text(i, joint):
        return joint.join(f"w{i:04}n{k:02}" for k in range(40))

    rows = [(i, text(i, " ") if i % 2 else text(i, " | "), "en", "prose" if i % 2 else "tables") for i in range(600)]
    rows += [(1000, text(1000, " | "), "en", "prose"), (1001, " ".join(f"w{k:03}" for k in range(40)), "en", "tables")]
    judged = quality.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()
    outliers = {r["doc_id"] for r in judged if r["outlier"] and not r["base_failed"]}
    assert outliers == {1000}


def test_fences_come_from_the_sketches(spark):
    """A group with enough rows has fences of its own, none of them a fixed one."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumns({"lang": F.lit("all"), "source": F.lit("all")})
    measured = materialise(quality.base_measures(docs, ["doc_id", "lang", "source"]), "measured")
    made = quality.thresholds(measured).collect()
    assert [r["own_fences"] for r in made] == [len(quality.MEASURES)]
    assert all(made[0][f"fence_{m.name}"] not in (None, m.fixed) for m in quality.MEASURES)


def test_all_that_passes_of_a_group_may_be_nothing(spark):
    rows = [(i, "few words", "en", "short") for i in range(3)] + [(9, " ".join(f"w{k}" for k in range(40)), "en", "long")]
    judged = quality.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()
    assert sorted((r["doc_id"], r["kept"]) for r in judged) == [(0, False), (1, False), (2, False), (9, True)]


def test_quality_edges(spark):
    docs = plain.edge_docs(spark)
    rows = quality.judge(docs).collect()
    assert len(rows) == docs.count()
    assert all(r["kept"] == (not r["base_failed"] and not r["outlier"]) for r in rows)
    assert all(r["base_failed"] for r in rows if r["n_words"] < 20)
    assert quality.judge(plain.empty_docs(spark)).collect() == []


def test_containment_against_brute_force(spark):
    rnd = random.Random(2)
    items = [" ".join(rnd.choice("abcdefgh") + str(rnd.randrange(9)) for _ in range(rnd.randint(1, 60))) for _ in range(40)]
    filler = " ".join(f"f{i}" for i in range(400))
    texts = []
    for item in items:
        found = item.split()
        for _ in range(3):
            cut = list(found)
            for _ in range(rnd.randint(0, 3)):
                cut[rnd.randrange(len(cut))] = "changed"
            texts.append(f"{filler} {' '.join(cut).upper()}\n{filler}" if rnd.random() < 0.8 else " ".join(cut))
    docs = plain.edge_docs(spark, texts)
    bench = spark.createDataFrame(
        [*enumerate(items), (100, items[3]), (100, items[3]), (101, None), (102, ""), (None, items[5])], "item_id long, text string"
    ).withColumn("doc_id", F.lit("clash"))
    got = sorted(((r["doc_id"], r["item_id"], r["n_shared"]) for r in decontaminate.contaminated(docs, bench).collect()), key=str)
    want = set()
    for d in docs.select("doc_id", "text").collect():
        held = plain.shingles(d["text"])
        for b in bench.select("item_id", "text").collect():
            asked, n = plain.shingles(b["text"]), len(plain.words(b["text"]))
            shared = asked & (held | plain.shingles(d["text"], n) if n < 5 else held)
            if asked and len(shared) >= 0.8 * len(asked):
                want.add((d["doc_id"], b["item_id"], len(shared)))
    assert got == sorted(want, key=str) and len(got) > 30


def test_short_items_inside_long_texts(spark):
    texts = ["the Quick brown fox jumps over it", "quick fox brown", "fox", "a brown fox", "four words are here now", None]
    items = ["quick brown fox", "fox", "brown  fox", "four words are here", "five words of an item", "", None]
    docs, bench = (spark.createDataFrame(list(enumerate(x)), f"{k} long, text string") for x, k in ((texts, "doc_id"), (items, "item_id")))
    got = {(r["doc_id"], r["item_id"], r["n_shingles"], r["n_shared"]) for r in decontaminate.contaminated(docs, bench).collect()}
    assert got == {(d, i, 1, 1) for d, i in ((0, 0), (0, 1), (0, 2), (1, 1), (2, 1), (3, 1), (3, 2), (4, 3))}


def test_containment_without_broadcast(spark, monkeypatch):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    rows = sorted(map(tuple, decontaminate.contaminated(docs, items).collect()))
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", -1)
    assert sorted(map(tuple, decontaminate.contaminated(docs, items).collect())) == rows


def test_containment_of_nothing(spark):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    assert decontaminate.contaminated(plain.empty_docs(spark), items).collect() == []
    assert decontaminate.contaminated(docs, items.limit(0)).collect() == []


KEY = "AKIA" + "ABCDEFGH12345678"
HEX = "0123456789abcdef" * 2
SECRETS = [
    f"password = 'hunter2hunter2' {KEY}", "token=token: abcdefgh1", "API_KEY:short Secret=\"longenough=1/2\"", f"é日 {HEX} x{HEX}g {HEX[:-1]}",
    f"token={HEX}", "passwd=a passwd=bbbbbbbbb", "ſecret=abcdefghi toKen: 12345678", f"{KEY}{KEY} AKIA12", "key Zx9" + "aB3" * 10 + " end",
    "A" * 30, "password\t=abcdefghij password  =  abcdefghij", "secret : 'ab",
]


def test_secrets_against_brute_force(spark):
    docs = plain.edge_docs(spark, SECRETS)
    rows = secret_scan.report(docs.withColumn("value", F.lit("clash"))).collect()
    texts = {}
    for r in docs.select("doc_id", "text").collect():
        texts.setdefault(r["doc_id"], []).append(r["text"])
    assert len(rows) == docs.count()
    for r in rows:
        base = ",".join(s for s in r["spans"].split(",") if s and not s.startswith("mixed"))
        assert base in [plain.base_spans(t) for t in texts[r["doc_id"]]]
        assert sum(r[f"n_{k}"] for k in secret_scan.KINDS) == (r["spans"].count(":") // 2)
    assert secret_scan.report(plain.empty_docs(spark)).collect() == []


def test_ownership_separates_copies(spark):
    live, copied = "token = Zx9aB3Zx9aB3Zx9aB3", "Qw8eR7Qw8eR7Qw8eR7Qw8eR7Qw8eR7"
    rows = [(1, live, "a", "en")] + [(i, f"see {copied}", f"s{i % 5}", "en") for i in range(2, 60)] + [(70, "own Lk5jH4Lk5jH4Lk5jH4Lk5jH4Lk5", "b", "en")]
    found = {r["doc_id"]: r for r in secret_scan.report(spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")).collect()}
    assert found[1]["n_live"] == 1 and found[70]["n_mixed"] == 1
    assert all(found[i]["n_mixed"] == 0 for i in range(2, 60))


def test_ownership_counts_repositories_of_two_owners(spark):
    token = "Qw8eR7Qw8eR7Qw8eR7Qw8eR7Qw8eR7"

    def live(*places):
        rows = [(i, f"see {token}", source, lang) for i, (source, lang) in enumerate(places)]
        return {r["n_live"] for r in secret_scan.report(spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")).collect()}

    assert live(*(("a", f"l{i}") for i in range(9))) == {1}
    assert live(("a", "en"), ("b", "en"), ("b", "fr"), ("b", "fr")) == {1}
    assert live(*(("ab"[i % 2], f"l{i}") for i in range(5))) == {0}


def test_very_many_matches_in_a_text(spark):
    text = " ".join(f"AKIA{i:016d}" for i in range(20_000)) + " token=abcdefgh1"
    begin = time.monotonic()
    made = secret_scan.report(spark.createDataFrame([(1, text, "s", "en")], "doc_id long, text string, source string, lang string")).first()
    assert time.monotonic() - begin < 60
    assert made["n_access"] == 20_000 and made["spans"].startswith("access:0:20,access:21:41") and made["spans"].endswith("assign:420000:420015")


def test_redaction(spark):
    rows = [(1, f"é a password = 'hunter2hunter2' b {KEY}.", "s", "en"), (2, "nothing", "s", "en"), (3, f"token={HEX}!", "t", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    joined = docs.join(secret_scan.scan(docs), "doc_id", "left").select("doc_id", secret_scan.redact(F.col("text"), F.coalesce("spans", F.array())))
    got = {r[0]: r[1] for r in joined.collect()}
    assert got == {1: "é a [SECRET]' b [SECRET].", 2: "nothing", 3: "[SECRET]!"}


def walk(counts, shards):
    """Place keys one at a time, all cells taking their first choice before any takes its second."""
    ring_nodes = ring.nodes(shards)
    total = sum(counts.values())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    waiting = [(c, next((n for n, (at, _) in enumerate(ring_nodes) if at >= c), 0)) for c in sorted(counts) for _ in range(counts[c])]
    placed = []
    while waiting:
        left = []
        for c, n in waiting:
            shard = ring_nodes[n % len(ring_nodes)][1]
            if room[shard]:
                room[shard] -= 1
                placed.append((c, shard))
            else:
                left.append((c, n + 1))
        waiting = left
    return sorted(placed)


def test_settling_against_single_keys():
    rnd = random.Random(8)
    for shards, rows in ((1, 5), (3, 40), (7, 3), (40, 2000)):
        counts = {}
        for _ in range(rows):
            c = rnd.randrange(ring.CELLS)
            counts[c] = counts.get(c, 0) + rnd.randint(1, 4)
        pieces = ring.settle(counts, shards)
        assert sorted((c, s) for c, a, b, s, _ in pieces for _ in range(a, b)) == walk(counts, shards)


def check_balance(rows, shards):
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
    sizes = [len(slots.get(s, [])) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_ring_edges(spark):
    docs = plain.edge_docs(spark)
    rows = ring.assign(docs, shards=4).collect()
    assert len(rows) == docs.count()
    check_balance(rows, 4)
    import zlib

    want = sorted((len((r["text"] or "").encode()) + 16, zlib.crc32((r["text"] or "").encode())) for r in docs.collect())
    assert sorted((r["size"], r["text_crc32"]) for r in rows) == want
    assert ring.assign(plain.empty_docs(spark)).collect() == []


def test_one_key_repeated_often(spark):
    docs = spark.range(3000, numPartitions=6).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("doc_id"), F.lit("t").alias("text"))
    rows = ring.assign(docs).collect()
    check_balance(rows, 40)


def test_a_shard_more_moves_few(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    before, after = ({r["doc_id"]: r["shard"] for r in ring.assign(docs, shards=n).collect()} for n in (40, 41))
    moved = sum(before[k] != after[k] for k in before)
    assert moved < 0.1 * len(before)


def test_shards_do_not_depend_on_how_rows_are_read(spark):
    ids = [None, *range(4000), *[7] * 900, *[8] * 3]
    docs = spark.createDataFrame([(i, f"t{i}") for i in ids], "doc_id long, text string")
    few, many = (
        sorted(map(tuple, ring.assign(docs.repartition(n)).select("doc_id", "text_crc32", "shard", "slot").collect()), key=str) for n in (3, 7)
    )
    assert few == many and len(few) == len(ids)
