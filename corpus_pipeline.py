"""From raw documents to token ids, in stages that each read what the one before wrote.

A document is a row; rows with equal ``doc_id`` and equal text are copies of one.
Rows without an id are told apart by their texts.  Extra columns pass through all
stages but the last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from siltstone.llm import bpe, decontaminate, minhash, quality, secret_scan, simhash
from siltstone.session import configure, materialise, scratch_path, scratch_scope
from siltstone.sources.files import remove

#: Rows of a side table that are broadcast at most; more are joined by shuffle.
BROADCAST_ROWS = 500_000

#: Least similarity of five-word shingle sets at which a document is a copy.
COPY = (4, 5)


def free(docs: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``docs`` does not have."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def row_key() -> Column:
    """What tells documents apart: absent ids last, then ids, then the text's hash."""
    return F.struct(F.col("doc_id").isNull().alias("anonymous"), "doc_id", F.xxhash64("text").alias("version"))


def sized(table: DataFrame) -> DataFrame:
    """The written table, to be broadcast only if it is small enough."""
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def without(docs: DataFrame, rows: DataFrame, row: str) -> DataFrame:
    """``docs`` without the rows that ``rows`` names in the column ``row``, which goes."""
    out = free(docs, "gone")
    gone = sized(materialise(rows.select(F.col(row).alias(out)).distinct(), "gone"))
    return docs.join(gone, docs[row].eqNullSafe(gone[out]), "left_anti").drop(row)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the fixed rule or their group's fences reject go.

    Fences differ by language and source, so equal texts of different groups are told apart.
    """
    row = free(docs, "row")
    keyed = docs.withColumn(row, F.struct(row_key().alias("row"), "lang", "source"))
    return without(keyed, quality.judge(keyed, [row]).where(~F.col("kept")), row)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates the document with the least id stays, and one copy of it.

    Classes are those of the fingerprints, and among what these leave those of
    texts that share four fifths of their word shingles.
    """
    row = free(docs, "row")
    keyed = docs.withColumn(row, row_key())
    apart = without(keyed, simhash.duplicates(keyed, row), row).withColumn(row, row_key())
    left = without(apart, minhash.duplicates(apart, row, similar=COPY), row).withColumn(row, row_key())
    again = free(left, "again")
    repeated = materialise(left.groupBy(row).agg(F.count("*").alias(again)).where(F.col(again) > 1).select(F.col(row).alias(again)), "repeated")
    if repeated.isEmpty():
        return left.drop(row)
    # Only rows that repeat exactly are dealt out by key to keep one of each.
    found = sized(repeated)
    same = left[row].eqNullSafe(found[again])
    once = left.join(found, same, "left_semi").dropDuplicates([row])
    return left.join(found, same, "left_anti").unionByName(once).drop(row)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    row = free(docs, "row")
    keyed = docs.withColumn(row, row_key())
    return without(keyed, decontaminate.contaminated(keyed, items, row), row)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets that look live are masked in the texts; widely copied examples stay."""
    row, at, live = (free(docs, name) for name in ("row", "found_at", "live_spans"))
    keyed = docs.withColumn(row, row_key())
    found = secret_scan.scan(keyed, row).select(
        F.col(row).alias(at), F.filter("spans", lambda s: s["live"]).alias(live)
    ).where(F.size(live) > 0)
    found = sized(materialise(found, "secrets"))
    joined = keyed.join(found, keyed[row].eqNullSafe(found[at]), "left")
    hit = F.col(live).isNotNull()
    result = joined.withColumn("text", F.when(hit, secret_scan.redact(F.col("text"), F.col(live))).otherwise(F.col("text")))
    if "n_chars" in docs.columns:  # of the masked text
        result = result.withColumn("n_chars", F.when(hit, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return result.select(*(F.col(f"`{c}`") for c in docs.columns))


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and digests of them and of what they decode to."""
    return bpe.round_trip(docs).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("bpe_encoding", bpe_encoding),
]

#: Byte-pair encoding cannot be said in SQL; the tests run the stages against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again; what a stage leaves behind goes with it."""
    docs = configure(spark).read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    before = None
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        with scratch_scope(spark):
            made = stage(spark, docs, sf_dir)
            made.write.parquet(path)
        docs = spark.read.schema(made.schema).parquet(path)
        if before is not None:
            remove(spark, [before])
        before = path
    return docs
