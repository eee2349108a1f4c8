"""Byte-level BPE by overlapping chunks, and its inverse.

``encode`` cuts long texts into overlapping chunks, pre-tokenises the chunks in parallel and
stitches them where both chunks of an overlap start a pre-token: a pre-token depends only on
the text from its start on, so from a common start both scans go on alike. The pieces between
two stitches are encoded in parallel and joined again. A text of one chunk needs no stitch and
is encoded where it lies. ``decode`` concatenates the raw bytes of the ids.

Null and empty texts have no ids. Equal long texts are encoded once, however often they occur;
every input row comes back once with all its other columns (an input column named like an
output column is replaced). An overlap without a common start, as within one endless word,
joins its two chunks to one.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwatch.llm.common import Numbering, csr_rows, passed_on, ranges, text_slices


@dataclass(frozen=True)
class BpeParams:
    ranks_path: str  # base64 token and rank by line
    pattern: str
    chunk_chars: int = 32_768
    overlap_chars: int = 512


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class Encoder:
    """Ids of texts; each distinct pre-token is merged once while it is remembered."""

    def __init__(self, p: BpeParams, keep: int = 200_000):
        import regex
        import tiktoken
        self.pieces = regex.compile(p.pattern).findall
        self.merge = tiktoken.Encoding("ranks", pat_str=p.pattern, mergeable_ranks=read_ranks(p.ranks_path),
                                       special_tokens={}).encode_ordinary
        self.keep = keep
        self._reset()

    def _reset(self) -> None:
        self.known, self.ids = Numbering(), np.empty(0, np.int32)
        self.starts = self.lengths = np.empty(0, np.int64)

    def of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and each text's number of ids."""
        if len(self.known) > self.keep:
            self._reset()
        split = [self.pieces(t) for t in texts]
        before = len(self.known)
        number = self.known.of([piece for pieces in split for piece in pieces])
        if new := [self.merge(piece) for piece in list(self.known)[before:]]:
            lengths = np.fromiter(map(len, new), np.int64, len(new))
            self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(lengths) - lengths])
            self.lengths = np.concatenate([self.lengths, lengths])
            self.ids = np.concatenate([self.ids, np.fromiter((i for ids in new for i in ids), np.int32, int(lengths.sum()))])
        n = self.lengths[number]
        rows = csr_rows(np.fromiter(map(len, split), np.int64, len(split)))
        return self.ids[ranges(self.starts[number], n)], np.bincount(rows, n, minlength=len(texts)).astype(np.int64)


def _encoded(source: DataFrame, keep: list[str], text: str, p: BpeParams, max_chars: int = 500_000) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(p)
        for batch in batches:
            rest = batch.select(keep)
            for start, texts in text_slices(batch, text, max_docs=512, max_chars=max_chars):
                ids, counts = encoder.of(texts)
                offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
                yield passed_on(rest.slice(start, len(texts)), {"ids": pa.ListArray.from_arrays(offsets, pa.array(ids))})

    schema = source.select(*keep).withColumn("ids", F.array(F.lit(1))).schema
    return source.select(*keep, text).mapInArrow(run, schema)


def _boundaries(chunks: DataFrame, p: BpeParams) -> DataFrame:
    """For each chunk the pre-token starts in the overlaps at its head and at its tail, as places in the text.

    A start counts only after a character that isn't white space, so that no look-ahead of the
    pattern reaches over it, and in the tail only where the scan of the chunk isn't cut short.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex
        scan = regex.compile(p.pattern).finditer
        for batch in batches:
            heads, tails = [], []
            for k, text in zip(batch.column("__k").to_pylist(), batch.column("__part").to_pylist()):
                base, head, tail = k * p.chunk_chars, [], []
                for m in scan(text):
                    at = m.start()
                    if at and not text[at - 1].isspace() and m.end() < len(text):
                        if at < p.overlap_chars:
                            head.append(base + at)
                        elif at >= p.chunk_chars:
                            tail.append(base + at)
                heads.append(head)
                tails.append(tail)
            kind = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("__key"), batch.column("__k"), pa.array(heads, kind), pa.array(tails, kind)],
                                             ["__key", "__k", "__head", "__tail"])

    return chunks.mapInArrow(run, "__key string, __k long, __head array<long>, __tail array<long>")


def encode(docs: DataFrame, p: BpeParams) -> DataFrame:
    """The columns of ``docs`` but ``text``, and ``ids``, the array of token ids."""
    keep = [c for c in docs.columns if c not in ("text", "ids")]
    is_long = F.length("text") > p.chunk_chars
    short = _encoded(docs.where(is_long.isNull() | ~is_long), keep, "text", p)

    # every distinct long text once
    long = docs.where(is_long).withColumn("__key", F.sha2("text", 256))
    texts = long.groupBy("__key").agg(F.first("text").alias("__text"))
    size = F.length("__text")
    last = F.floor((size - 1) / p.chunk_chars)
    part = F.substring(F.col("__text"), F.col("__k").cast("int") * p.chunk_chars + 1, F.lit(p.chunk_chars + p.overlap_chars))
    chunks = (texts.select("__key", "__text", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("__k"))
              .select("__key", "__k", part.alias("__part")).repartition("__key", "__k"))
    found = _boundaries(chunks, p)
    tails = found.select("__key", (F.col("__k") + 1).alias("__k"), "__tail")
    stitches = (found.select("__key", "__k", "__head").join(tails, ["__key", "__k"])
                .select("__key", F.array_min(F.array_intersect("__head", "__tail")).alias("__at")).where("__at IS NOT NULL")
                .groupBy("__key").agg(F.sort_array(F.collect_list("__at")).alias("__at")))
    cuts = F.concat(F.array(F.lit(0).cast("long")), F.coalesce("__at", F.array().cast("array<long>")), F.array(size.cast("long")))
    pieces = (texts.join(stitches, "__key", "left").withColumn("__cuts", cuts)
              .select("__key", "__text", "__cuts", F.explode(F.sequence(F.lit(1), F.size("__cuts") - 1)).alias("__k"))
              .select("__key", "__k", F.substring(F.col("__text"), F.element_at("__cuts", F.col("__k")).cast("int") + 1,
                                                  (F.element_at("__cuts", F.col("__k") + 1) - F.element_at("__cuts", F.col("__k"))).cast("int")).alias("__part"))
              .repartition("__key", "__k"))
    whole = (_encoded(pieces, ["__key", "__k"], "__part", p).groupBy("__key")
             .agg(F.sort_array(F.collect_list(F.struct("__k", "ids"))).alias("__parts"))
             .select("__key", F.flatten(F.col("__parts.ids")).alias("ids")))
    return short.unionByName(long.select(*keep, "__key").join(whole, "__key").select(*keep, "ids"))


def decode(encoded: DataFrame, p: BpeParams) -> DataFrame:
    """The columns of ``encoded`` and ``decoded``, the bytes of ``ids`` (null ids: none)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = sorted(read_ranks(p.ranks_path).items(), key=lambda x: x[1])
        numbers = np.array([rank for _, rank in tokens])
        if (numbers != np.arange(len(tokens))).any():
            raise ValueError("the ranks must be 0, 1, 2, ...")
        blob = np.frombuffer(b"".join(t for t, _ in tokens), np.uint8)
        size = np.array([len(t) for t, _ in tokens])
        start = np.cumsum(size) - size
        for batch in batches:
            # rows of about a million ids at once: a slice of long texts takes no more memory than one of short texts
            so_far = np.cumsum(batch.column("ids").value_lengths().fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
            cuts = np.flatnonzero(np.diff(so_far // 1_000_000, prepend=0)) if batch.num_rows else []
            edges = np.unique(np.concatenate([[0], cuts, [batch.num_rows]])).astype(int).tolist()
            for at, end in zip(edges, edges[1:]):
                part = batch.slice(at, end - at)
                column = part.column("ids")
                ids = column.flatten().to_numpy(zero_copy_only=False)
                counts = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                n = size[ids]
                data = blob[ranges(start[ids], n)]
                ends = np.concatenate([[0], np.cumsum(np.bincount(csr_rows(counts), n, minlength=len(counts)))]).astype(np.int32)
                value = pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(ends), pa.py_buffer(data)])
                yield passed_on(part, {"decoded": value})

    return encoded.mapInArrow(run, encoded.withColumn("decoded", F.lit(b"")).schema)
