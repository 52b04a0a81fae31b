"""The pipeline against a plain version, and its stages on rows they must bear."""

import hashlib
import re

import duckdb
import plain
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from siltstone.llm import sql
from siltstone.session import materialise

SF = "/root/testdata/sf0.001"


def plain_run(sf_dir):
    con = duckdb.connect()
    con.execute(f"create table documents as select * from '{sf_dir}/documents.parquet'")
    con.execute(f"create view benchmark as select * from '{sf_dir}/benchmark.parquet'")
    con.execute(f"delete from documents where doc_id in (select doc_id from ({sql.QUALITY}) where not kept)")
    rows = con.execute("select doc_id, text from documents").fetchall()
    apart = [i for i, _, least in plain.near_duplicates(rows) if i == least]
    texts = {i: t for i, t in rows if i in set(apart)}
    copies = plain.classes(plain.links(texts, (4, 5)), apart)
    keep = [i for i in apart if copies[i] == i]
    con.execute("delete from documents where doc_id not in (select unnest(?::bigint[]))", [keep])
    con.execute(f"delete from documents where doc_id in (select doc_id from ({sql.CONTAMINATED}))")
    spans = dict(con.execute(f"select doc_id, spans from ({sql.SECRETS})").fetchall())
    owners = {}
    texts = con.execute("select doc_id, text, source, lang from documents").fetchall()
    parsed = {}
    for i, text, source, lang in texts:
        for kind, a, b in re.findall(r"(\w+):(\d+):(\d+)", spans[i]):
            value = text[int(a) : int(b)]
            if kind == "assign":
                value = plain.ASSIGN.fullmatch(value)[1]
            parsed.setdefault(i, []).append((int(a), int(b), value))
            owners.setdefault(value, set()).add((source, lang))
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out = []
    for i, text, _, _ in texts:
        at, made = 0, ""
        for a, b, value in sorted(parsed.get(i, [])):
            many = len({s for s, _ in owners[value]})
            if many < 2 or (many < 3 and len(owners[value]) < 5):
                made += f"{text[at:a]}[SECRET]" if a >= at else ""
                at = max(at, b)
        ids = tokenizer.encode(made + text[at:], add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        digest = [hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), decoded)]
        out.append((i, len(ids), *digest))
    return sorted(out)


def test_against_a_plain_version(spark):
    assert sorted(map(tuple, pipeline.run(spark, SF).collect())) == plain_run(SF)


@pytest.fixture(scope="module")
def edges(spark):
    long = " ".join(f"word{i}" for i in range(60))
    docs = plain.edge_docs(spark, [long, long, long.replace("word59", "end"), f"{long} password = 'hunter2hunter2'"])
    for name in ("row", "Gone", "again", "live_spans", "_live", "found_at", "__row", "node", "first", "d1", "least", "group"):
        docs = docs.withColumn(name, F.lit("clash"))
    return materialise(docs.unionByName(docs.where("doc_id is null")), "edges")


@pytest.mark.parametrize("name,stage", pipeline.STAGES)
def test_stages_bear_anything(spark, edges, name, stage):
    made = stage(spark, edges, SF)
    if name != pipeline.STAGES[-1][0]:
        assert made.columns == edges.columns and made.schema["text"].dataType == edges.schema["text"].dataType
        assert stage(spark, edges.limit(0), SF).collect() == []
    assert made.count() <= edges.count()


def test_one_of_each_class_stays(spark, edges):
    kept = pipeline.near_dedup(spark, edges, SF).select("doc_id", "text").collect()
    prints = [plain.fingerprint(r["text"]) for r in kept]
    assert all((a ^ b).bit_count() > 4 for i, a in enumerate(prints) for b in prints[:i])
    everything = edges.select("doc_id", "text").collect()
    least = {c for _, _, c in plain.near_duplicates([(r["doc_id"], r["text"]) for r in everything if r["doc_id"] is not None])}
    assert {r["doc_id"] for r in kept if r["doc_id"] is not None} <= least


def test_rows_without_id_are_told_apart(spark):
    rows = [(None, " ".join(f"{c}{i}" for i in range(40)), "en", "s", 1) for c in "abc"]
    docs = spark.createDataFrame(rows + rows[:1], "doc_id long, text string, lang string, source string, n_chars long")
    assert pipeline.near_dedup(spark, docs, SF).count() == 3
    assert pipeline.benchmark_decontamination(spark, docs, SF).count() == 4


def test_masked_texts_have_their_own_length(spark, edges):
    made = pipeline.secret_scans(spark, edges, SF).where(F.col("text").contains("[SECRET]")).collect()
    assert made and all(r["n_chars"] == len(r["text"]) and "hunter2" not in r["text"] for r in made)
