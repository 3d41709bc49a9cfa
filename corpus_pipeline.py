"""A training corpus from ``documents``: each stage is written as Parquet and reread as the next one's documents.

Documents that the quality classifier rejects go; of each group of near duplicates one row stays, that with the smallest id;
passages of 35 words or more that occur elsewhere go from the texts that are left; what remains is packed
into sequences. All stages but the last keep the columns of ``documents``. Ids may be null or repeated: a row without one comes last in its group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linscore.llm import minhash, packing, quality, substring
from linscore.llm.store import Store
from linscore.session import configure


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is 0.3 or more, learned from the labels of the tables' folder."""
    configure(spark)
    return quality.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates, that with the smallest id; of blank rows that repeat id and text, one."""
    configure(spark)
    ident = F.col("doc_id").cast("bigint")
    if docs.groupBy(ident.alias("id")).count().where("count > 1 or id is null").isEmpty():
        found = minhash.near_duplicates(docs)
        return docs.join(found.where("not kept").select("doc_id"), "doc_id", "left_anti").select(docs.columns)
    # ids that are null or repeated do not tell rows apart: each row gets a key, written so that it stays
    key = "row_key"
    while key in docs.columns:
        key += "_"
    keyed = Store(spark, "near-dedup").write("keyed", docs.withColumn(key, F.monotonically_increasing_id()))
    found = minhash.near_duplicates(keyed.select(F.col(key).alias("doc_id"), "text"))
    blank = F.when(~F.col("text").rlike(r"[^\x09-\x0d\x20]"), F.col("text"))
    rows = keyed.select(F.col(key).alias("key"), ident.alias("id"), blank.alias("blank")).join(
        found.select(F.col("doc_id").alias("key"), "n_shingles", "component_id"), "key"
    )
    first = rows.groupBy(
        F.when(F.col("n_shingles") > 0, F.col("component_id")).alias("component"),
        F.when(F.col("n_shingles") == 0, F.col("id")).alias("own"), "blank",
    ).agg(F.min(F.struct(F.col("id").isNull().alias("last"), "id", "key")).alias("first"))
    return keyed.join(first.select(F.col("first.key").alias(key)), key, "left_semi").select(docs.columns)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the words of repeated passages; ``n_chars`` follows the text."""
    configure(spark)
    found = substring.without_repeats(docs)
    if "n_chars" not in docs.columns:
        return found
    return found.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token windows of all documents, packed into sequences of 1,024."""
    import public_tokenizers

    configure(spark)
    return packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", quality_filter),
    ("MinHash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("packing", pack),
]
# models, hash buckets and tokens are beyond SQL: tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn on ``documents``."""
    store = Store(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = store.write(f"stage-{k}", stage(spark, docs, sf_dir))
        if k:
            store.drop(f"stage-{k - 1}")
    return docs
