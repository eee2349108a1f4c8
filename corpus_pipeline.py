"""The corpus pipeline: documents through five stages, each a table that the next one reads.

quality classifier (rejected documents go), near-duplicates (one document of each class stays),
benchmark decontamination (documents that hold a benchmark item go), secret scan (secrets in the
text are replaced), byte-level BPE (token ids, and the bytes they decode to).

Every stage takes (spark, docs, sf_dir) and works on all documents that its predecessor kept; all
but the last return the columns of documents. Null texts count as empty ones in every stage; null
ids count as ids in every stage; the near-duplicates' takes them for the largest.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwatch.llm import bpe, decontam, neardup, quality, secrets
from tickwatch.llm.common import table
from tickwatch.session import checkpoint_dir, ensure_utc, ship_package

REDACTED = "[SECRET]"


def ready(spark: SparkSession) -> SparkSession:
    ensure_utc(spark)
    ship_package(spark)
    checkpoint_dir(spark)
    return spark


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts good, learned from the rows of labels that aren't held out."""
    scored = quality.quality_scores(docs.withColumn("__text", F.col("text")), table(ready(spark), sf_dir, "labels"))
    return scored.where("predicted = 1").withColumnRenamed("__text", "text").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates one row: that of the smallest id (a null one last), then of the smallest digests.

    Texts without words are alike to no other: of those with the same id one row stays, of those without any one of each.
    """
    ready(spark)
    digest = F.md5(F.encode(F.coalesce("text", F.lit("")), "UTF-8"))
    whole = F.xxhash64(*[c for c, kind in docs.dtypes if "map<" not in kind])  # of all columns: only ties need it
    id_text = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    row = F.struct(F.isnull("doc_id").alias("nameless"), "doc_id", digest.alias("digest"), whole.alias("whole"))
    marked = docs.withColumns({"__row": row, "__id": id_text})
    in_class = neardup.classified(marked.select("doc_id", "text", "__row", "__id"))
    # a class of its own: keys of classes have 16 bytes
    alone = F.when(F.col("__row.nameless"), F.concat(F.lit("without an id "), F.col("__row.digest"), F.col("__row.whole").cast("string")))
    named = in_class.withColumn("class_key", F.coalesce("class_key", F.coalesce(alone, F.concat(F.lit("text without words "), "__id")).cast("binary")))
    stays = (named.groupBy("class_key").agg(F.min("__row").alias("stays"))
             .select("stays.*").select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("__id"), F.col("digest").alias("__digest"), F.col("whole").alias("__whole")))
    rows = marked.select(*docs.columns, "__id", F.col("__row.digest").alias("__digest"), F.col("__row.whole").alias("__whole"))
    place = ["__id", "__digest", "__whole"]
    return rows.join(stays, place, "left_semi").dropDuplicates(place).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.clean(docs, table(ready(spark), sf_dir, "benchmark").select("item_id", "text")).select(*docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with each secret in the text replaced, and n_chars made right for those."""
    ready(spark)
    out = secrets.scan(docs, secrets.fit(docs.select("doc_id", "text")), redacted=REDACTED)
    n_chars = F.when(F.size("spans") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", n_chars).select(*docs.columns)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their token ids, the number of these, and whether the ids decode to the text again."""
    ready(spark)
    p = bpe.BpeParams(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    digest = F.sha2(F.encode(F.coalesce("text", F.lit("")), "UTF-8"), 256)
    both = bpe.decode(bpe.encode(docs.withColumn("__digest", digest), p), p)
    return both.select(*[c for c in docs.columns if c != "text"], "ids", F.size("ids").cast("long").alias("n_tokens"),
                       (F.sha2("decoded", 256) == F.col("__digest")).alias("round_trip"))


STAGES = [("quality", keep_quality), ("near_duplicates", drop_near_duplicates), ("decontamination", drop_contaminated),
          ("secrets", redact_secrets), ("bpe", tokenise)]

#: SQL can express neither the classifier nor the sketches; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents; each result is a Parquet table in the shared checkpoint folder."""
    folder = f"{checkpoint_dir(ready(spark)).rstrip('/')}/pipeline-{uuid.uuid4()}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
