"""Helpers shared by the text operators: batches of texts, word splitting, span digests, slots."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickwatch.session import checkpoint_dir

#: Texts that a Python worker holds split into words at once.
SLICE_DOCS = 256
SLICE_CHARS = 4_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame) -> DataFrame:
    """The rows written to a table in the shared checkpoint folder and read again.

    It cuts the lineage as checkpoint() does, but the plans that read it know its true size, which in
    a loop of joins matters: a checkpoint carries on the estimates of the plan that it replaces.
    """
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/table-{uuid.uuid4()}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sampled_texts(docs: DataFrame, chosen: DataFrame, chars: int) -> DataFrame:
    """The columns of ``chosen`` (doc_id, rank, ...; a bounded number of ids) and the text of each id.

    Where an id has several texts, that with the smallest digest is taken, so there are no more rows
    than ids. Texts are whole: by rank, those are taken that fit in ``chars`` characters with all before them.
    """
    text = F.coalesce("text", F.lit(""))
    each = docs.select("doc_id", text.alias("text")).join(F.broadcast(chosen), "doc_id")
    first = written(each.groupBy(*chosen.columns).agg(F.min(F.struct(F.md5(F.encode("text", "UTF-8")), "text"))["text"].alias("text")))
    lengths = first.select("doc_id", "rank", F.length("text").cast("long").alias("n"))
    so_far = F.sum("n").over(Window.orderBy("rank", "doc_id"))  # one task, over no more rows than ids
    fits = lengths.withColumn("so_far", so_far).where(F.col("so_far") <= chars).select("doc_id")
    return first.join(F.broadcast(fits), "doc_id", "left_semi")


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """True where crc32 of the id as text leaves that remainder (a null id counts as the empty text)."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(modulus)) == remainder


def text_slices(batch: pa.RecordBatch, column: str = "text",
                max_docs: int = SLICE_DOCS, max_chars: int = SLICE_CHARS) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of consecutive rows of a batch; a null text is the empty text.

    A slice ends after ``max_docs`` rows or ``max_chars`` characters, so that one slice of
    long texts costs no more memory than one of short texts.
    """
    texts, start, chars = [], 0, 0
    for i, value in enumerate(batch.column(column)):
        text = value.as_py() or ""
        texts.append(text)
        chars += len(text)
        if len(texts) >= max_docs or chars >= max_chars:
            yield start, texts
            texts, start, chars = [], i + 1, 0
    if texts:
        yield start, texts


def flat_words(texts: list[bytes | str]) -> tuple[list, np.ndarray]:
    """All white-space separated words of the texts in one list, and each text's number of words."""
    split = [t.split() for t in texts]
    return list(chain.from_iterable(split)), np.fromiter(map(len, split), np.int64, len(split))


class Numbering(dict):
    """Numbers words in the order in which they are first met."""

    def __missing__(self, word):
        self[word] = number = len(self)
        return number

    def of(self, words: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def mix64(x: np.ndarray) -> np.ndarray:
    """SplitMix64's finaliser on uint64 values."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def hash64(words: list[str | bytes]) -> np.ndarray:
    """A 64-bit hash of each word, the same in every process."""
    from xxhash import xxh64_intdigest
    return np.fromiter((xxh64_intdigest(w) for w in words), np.uint64, len(words))


def csr_rows(lengths: np.ndarray) -> np.ndarray:
    """The row number of each element of consecutive rows of these lengths."""
    return np.repeat(np.arange(len(lengths)), lengths)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenation of start, start + 1, ... for each (start, length)."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    return np.arange(total) - np.repeat(ends - lengths, lengths) + np.repeat(starts, lengths)


def span_text(spans: list[tuple[int, int, int, str]]) -> str:
    """``kind:start:end`` of spans (start, order of kind, end, kind), by start, then kind."""
    return ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in sorted(spans))


def sha256_hex(value: str | bytes) -> str:
    return hashlib.sha256(value.encode() if isinstance(value, str) else value).hexdigest()


def passed_on(batch: pa.RecordBatch, extra: dict[str, pa.Array]) -> pa.RecordBatch:
    """The batch without its text columns, with more columns behind."""
    names = [n for n in batch.schema.names if n not in extra]
    return pa.RecordBatch.from_arrays([batch.column(n) for n in names] + list(extra.values()), names + list(extra))
