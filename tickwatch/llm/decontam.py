"""Benchmark decontamination: size-partitioned MinHash containment search, DataFrame functions only.

Texts are lower-cased words; a shingle is five words in a row (all words of a shorter text).
Documents are partitioned by their number of shingles, doubling from partition to partition. A
partition's documents are sketched by one-permutation MinHash with four bins for each shingle of
its largest document: the hash space is cut into that many bins, and the least hash of each bin
stays. A test item is sketched with the bins of each partition; items and documents that agree in
a bin are candidates. So an item of a few shingles meets a long document as surely as a short
one, which one sketch size for all documents can't give. Candidates are verified by their exact
containment, the share of the item's shingles that the document holds.

An item's shingle loses its bin to another of the document with a probability of at most 1/8, so
an item with ``short_item`` shingles in a document is missed with at most (1/8)^short_item; items
of fewer shingles are searched with all shingles of the documents instead.

Null, empty and blank texts, of documents or items, hold no shingles and take part in no pair.
Equal texts are compared once; every (doc_id, item_id) that holds is one row, repeated rows and
null ids included as one. Other columns are not used.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwatch.llm.common import written


@dataclass(frozen=True)
class DecontamParams:
    words: int = 5
    threshold: float = 0.8
    short_item: int = 8


def with_shingles(texts: DataFrame, n: int) -> DataFrame:
    """(key, shingles, bits) of texts with shingles; ``key`` digests the text, ``bits`` tells the bins of its partition.

    The words are a column of their own, so that no shingle splits the text again. Explode the (never
    empty) shingles by explode_outer: for explode Spark infers a filter on the array's size, and
    pushing that down would put the splitting into each shingle after all.
    """
    words = F.array_remove(F.split(F.lower("text"), r"[\x20\x09-\x0D]+"), "")
    split = texts.where(F.col("text").rlike(r"[^\x20\x09-\x0D]")).select(F.md5(F.col("text").cast("binary")).alias("key"), words.alias("words"))
    rolled = F.transform(F.sequence(F.lit(1), F.size("words") - (n - 1)), lambda i: F.xxhash64(F.slice("words", i, n)))
    hashed = F.when(F.size("words") >= n, rolled).otherwise(F.array(F.xxhash64("words")))
    held = split.withColumn("shingles", F.sort_array(F.array_distinct(hashed))).drop("words")
    # never null, or Spark would filter on that before the words are split, with the same effect
    return held.withColumn("bits", F.coalesce(F.ceil(F.log2(F.size("shingles"))).cast("int"), F.lit(0)) + 2)


def sketch(held: DataFrame) -> DataFrame:
    """(key, bits, h): the least hash of each of the 2^bits bins of a text."""
    least = F.expr("filter(shingles, (h, i) -> i = 0 OR shiftright(h, 64 - bits) <> shiftright(get(shingles, i - 1), 64 - bits))")
    return held.select("key", "bits", F.explode_outer(least).alias("h"))


def item_sketches(items: DataFrame, n: int) -> DataFrame:
    """(item, n, h, least_bits): each shingle of an item, and the bins from which on it is the least of its bin."""
    held = with_shingles(items.select("text"), n).dropDuplicates(["key"])
    each = held.select(F.col("key").alias("item"), F.size("shingles").alias("n"), "shingles", F.posexplode_outer("shingles").alias("at", "h"))
    apart = F.bin(F.col("h").bitwiseXOR(F.expr("get(shingles, at - 1)")))
    return each.select("item", "n", "h", F.when(F.col("at") == 0, 0).otherwise(65 - F.length(apart)).alias("least_bits"))


def contained(docs: DataFrame, items: DataFrame, p: DecontamParams = DecontamParams()) -> tuple[DataFrame, DataFrame]:
    """(key, item, n_shared, n_shingles, containment) of texts and items, and the texts (doc_id, key) of candidates."""
    # written, so that Spark sees its true size and broadcasts it only where that is small
    of_items = written(item_sketches(items, p.words))
    held = with_shingles(docs.select("text"), p.words)
    agree = (sketch(held).join(of_items.where(F.col("n") >= p.short_item), "h").where("bits >= least_bits")
             .select("key", "item"))
    short = of_items.where(F.col("n") < p.short_item)
    if not short.isEmpty():
        agree = agree.unionByName(held.select("key", F.explode_outer("shingles").alias("h")).join(short, "h").select("key", "item"))
    candidates = written(agree.distinct())
    keyed = docs.where("text IS NOT NULL").select("doc_id", "text", F.md5(F.col("text").cast("binary")).alias("key"))
    found = written(keyed.join(candidates.select("key").distinct(), "key", "left_semi"))
    texts = with_shingles(found.groupBy("key").agg(F.first("text").alias("text")).select("text"), p.words)
    shared = (texts.select("key", F.explode_outer("shingles").alias("h")).join(of_items.select("item", "n", "h"), "h")
              .groupBy("key", "item").agg(F.count(F.lit(1)).alias("n_shared"), F.first("n").cast("long").alias("n_shingles"))
              .join(candidates, ["key", "item"]).withColumn("containment", F.col("n_shared") / F.col("n_shingles")))
    return shared.where(F.col("containment") >= p.threshold), found.select("doc_id", "key").distinct()


def contaminated(docs: DataFrame, items: DataFrame, p: DecontamParams = DecontamParams()) -> DataFrame:
    """(doc_id, item_id, n_shared, n_shingles, containment) of documents that hold an item."""
    pairs, ids = contained(docs, items, p)
    names = items.where("text IS NOT NULL").select("item_id", F.md5(F.col("text").cast("binary")).alias("item")).distinct()
    return pairs.join(ids, "key").join(names, "item").select("doc_id", "item_id", "n_shared", "n_shingles", "containment").distinct()


def clean(docs: DataFrame, items: DataFrame, p: DecontamParams = DecontamParams()) -> DataFrame:
    """The documents, all columns, that hold no item."""
    pairs, _ = contained(docs, items, p)
    digest = F.md5(F.coalesce("text", F.lit("")).cast("binary"))
    return docs.withColumn("__key", digest).join(written(pairs.select(F.col("key").alias("__key")).distinct()), "__key", "left_anti").drop("__key")
