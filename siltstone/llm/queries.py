"""One query for each operator over its whole table, and its SQL twin where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from siltstone.llm import (
    bpe, decontaminate, fim, langid, minhash, negatives, quality, ring, secret_scan, simhash, sql, token_counts, toxicity,
    url_filter,
)
from siltstone.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        @wraps(run)
        def wrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
            return run(configure(spark), sf_dir.rstrip("/"))

        QUERIES[run.__name__] = wrapped
        if sql is not None:
            ORACLES[run.__name__] = sql
        return wrapped

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of all documents."""
    return token_counts.count_sections(table(spark, sf_dir, "documents"))


@query()
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.withColumn("fingerprint", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")))


@query()
def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on all pages."""
    return url_filter.judge(table(spark, sf_dir, "pages"))


@query(sql.SECRETS)
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of all documents, with how many look live."""
    return secret_scan.report(table(spark, sf_dir, "documents"))


@query()
def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents on a ring of 40 shards, counts at most one apart."""
    placed = ring.assign(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query()
def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token ids and back."""
    return digests(bpe.round_trip(table(spark, sf_dir, "documents")))


def digests(decoded: DataFrame) -> DataFrame:
    """Counts and hashes of ids and their decoded text."""
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query()
def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents, learnt from four fifths of them."""
    docs = table(spark, sf_dir, "documents")
    held_out = langid.remainder(F.col("doc_id"), 5) == 0
    prototypes = langid.learn(docs.where(~held_out))
    return langid.predict(docs, prototypes).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query()
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learnt from two thirds of the labels."""
    docs = table(spark, sf_dir, "documents")
    held_out = langid.remainder(F.col("doc_id"), 3) == 1
    machine = toxicity.learn(docs, table(spark, sf_dir, "labels").where(~held_out))
    return toxicity.score(docs, machine).select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query(sql.CONTAMINATED)
def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query(sql.QUALITY)
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality verdicts on all documents."""
    return quality.judge(table(spark, sf_dir, "documents"))


@query(sql.FILL_IN_MIDDLE)
def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents cut in three and put together again."""
    made = fim.transform(table(spark, sf_dir, "documents"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fim.restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


@query(sql.HARD_NEGATIVES)
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives for every hundredth vector among all; a seventh of the labels is moved on by one."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, label=label)


@query(sql.NEAR_COPIES)
def op13_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents by the words they share."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))
