"""Token counts by pre-token: pieces once per distinct pre-token, joined to per-document frequencies.

``frequencies`` cuts every text into the tokenizer's pre-tokens and counts them by document. The
counts travel by chunk of documents: one row per (chunk, pre-token) holds the documents that have
it, so even the commonest pre-token has one row a chunk. ``pieces`` takes the distinct pre-tokens
of the whole corpus and counts the pieces of each once. ``token_counts`` joins the two and sums
pieces times frequency by document; no ids are kept.

Null and empty texts have 0 tokens. A special string inside a text is one token, as it is for the
tokenizer by default. Rows are counted each on its own, by their place in a chunk, so null or
repeated ids do no harm; other columns pass through (columns named like the outputs are replaced).
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import islice
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwatch.llm.common import SLICE_DOCS, Numbering, passed_on, ranges, text_slices

#: The row of a chunk that carries its documents' own columns instead of counts (no pre-token is empty).
HEADER = ""
#: Stands for a special string in the table of pre-tokens (no pre-token holds letters and others).
SPECIAL = "\0special"
#: Fixed value: the pattern by which the tokenizer file cuts normalised texts.
CUT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


@dataclass(frozen=True)
class TokenParams:
    tokenizer_path: str
    cut: str = CUT
    chunk_docs: int = 16_384  # fewer than 2^16
    chunk_tokens: int = 6_000_000  # pre-tokens in a chunk, but for its last slice of texts
    limit: int = 2048
    specials: tuple[str, ...] = field(default=("<|startoftext|>", "<|endoftext|>"))


class Cutter:
    """Numbers the pre-tokens of texts; each distinct word between white space is cut once.

    The tokenizer's own normaliser and splitter serve any text with characters on which Unicode
    tables or lower-casing could differ; others take the same steps by faster functions.
    """

    def __init__(self, p: TokenParams):
        import regex
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Regex, Tokenizer
        from tokenizers.pre_tokenizers import Split
        self.normalise = Tokenizer.from_file(p.tokenizer_path).normalizer.normalize_str
        self.fast = regex.compile(p.cut).findall
        self.sure = Split(Regex(p.cut), behavior="removed", invert=True).pre_tokenize_str
        self.plain = regex.compile(r"[\t-\r\x20-\x7e\xa0-\u0377\u0400-\u052f]*").fullmatch
        self.special = regex.compile("|".join(map(regex.escape, p.specials)))
        self.reset()

    def reset(self) -> None:
        self.words, self.tokens = Numbering(), Numbering()
        self.flat = self.starts = self.lengths = np.empty(0, np.int64)

    def split(self, text: str) -> list[str]:
        """Words of the normalised text: no pre-token holds white space."""
        if self.plain(text) and is_normalized("NFC", text):
            return text.lower().split()
        return self.normalise(text).split(" ")

    def of(self, texts: list[str]) -> list[np.ndarray]:
        """The number of each pre-token of each text, in order but for special strings, which come last."""
        words, specials = [], []
        for text in texts:
            parts = self.special.split(text) if "<|" in text else [text]
            words.append([w for part in parts for w in self.split(part)])
            specials.append(len(parts) - 1)
        known = len(self.words)
        ids = [self.words.of(x) for x in words]
        if len(self.words) > known:
            new = list(islice(self.words, known, None))
            cut = [self.fast(w) if self.plain(w) else [t for t, _ in self.sure(w)] for w in new]
            lengths = np.fromiter(map(len, cut), np.int64, len(cut))
            self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(lengths) - lengths])
            self.lengths = np.concatenate([self.lengths, lengths])
            self.flat = np.concatenate([self.flat, self.tokens.of([t for x in cut for t in x])])
        out = [self.flat[ranges(self.starts[i], self.lengths[i])].astype(np.int32) for i in ids]
        return [np.append(x, np.full(n, self.tokens[SPECIAL], np.int32)) if n else x for x, n in zip(out, specials)]


MORE = np.dtype([("doc", "<u2"), ("n", "<u4")])


def slices(values: np.ndarray, edge: np.ndarray) -> pa.Array:
    """Binary values, one for each pair of neighbours in ``edge``."""
    width = values.dtype.itemsize
    offsets = ((edge - edge[0]) * width).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(edge) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values[edge[0]:edge[-1]]).tobytes())])


def flattened(column: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    """The values of all rows of a binary column, and the row of each."""
    offsets = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, 4 * column.offset)
    width = np.dtype(kind).itemsize
    data = column.buffers()[2]
    values = np.frombuffer(data, kind, (offsets[-1] - offsets[0]) // width, offsets[0]) if data is not None and offsets[-1] > offsets[0] else np.empty(0, kind)
    return values, np.repeat(np.arange(len(column)), np.diff(offsets) // width)


def frequencies(docs: DataFrame, p: TokenParams) -> DataFrame:
    """(chunk, token, docs, more): the documents of a chunk, as places in it, that hold a pre-token, and how much oftener than once.

    A chunk is numbered by its partition and its place there. Its header row holds the documents' other
    columns and ``n_bytes``, as an Arrow stream.
    """
    keep = [c for c in docs.columns if c not in ("text", "n_bytes", "n_tokens", "over_limit")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, part, serial = Cutter(p), TaskContext.get().partitionId(), 0

        def rows(own: list[pa.RecordBatch], cut: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, own[0].schema) as stream:
                for x in own:
                    stream.write_batch(x)
            key = part << 32 | serial
            none = np.zeros(2, np.int64)
            yield out(key, [HEADER], pa.array([sink.getvalue().to_pybytes()], pa.binary()), slices(np.empty(0, MORE), none))
            lengths = [len(x) for x in cut]
            pair = np.concatenate(cut, dtype=np.int64)
            cut.clear()  # the pairs are all that is needed from here on
            pair <<= 16
            pair |= np.repeat(np.arange(len(lengths)), lengths)
            pair.sort()
            new = np.flatnonzero(np.append(True, pair[1:] != pair[:-1])) if len(pair) else np.empty(0, np.int64)
            n = np.diff(np.append(new, len(pair)))
            token, doc = pair[new] >> 16, (pair[new] & 0xFFFF).astype("<u2")
            first = np.flatnonzero(np.append(True, token[1:] != token[:-1])) if len(token) else np.empty(0, np.int64)
            edge = np.append(first, len(token))
            many = np.flatnonzero(n > 1)
            more = np.empty(len(many), MORE)
            more["doc"], more["n"] = doc[many], n[many] - 1
            more_edge = np.searchsorted(many, edge)
            names = list(cutter.tokens)
            for a in range(0, len(first), 20_000):
                b = min(a + 20_000, len(first))
                yield out(key, [names[t] for t in token[first[a:b]]], slices(doc, edge[a:b + 1]), slices(more, more_edge[a:b + 1]))

        def out(key: int, tokens: list[str], docs: pa.Array, more: pa.Array) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(tokens), key)), pa.array(tokens, pa.string()), docs, more], ["chunk", "token", "docs", "more"])

        own, cut, size = [], [], 0
        most = min(SLICE_DOCS, p.chunk_docs)
        for batch in batches:
            rest = batch.select(keep)
            for start, texts in text_slices(batch, max_docs=most):
                n_bytes = pa.array([len(t.encode()) for t in texts], pa.int64())
                own.append(passed_on(rest.slice(start, len(texts)), {"n_bytes": n_bytes}))
                more = cutter.of(texts)
                cut += more
                size += sum(map(len, more))
                if len(cut) + most > p.chunk_docs or size >= p.chunk_tokens:
                    yield from rows(own, cut)
                    own, cut, size, serial = [], [], 0, serial + 1
                    cutter.reset()
        if cut:
            yield from rows(own, cut)

    return docs.select(*keep, "text").mapInArrow(run, "chunk long, token string, docs binary, more binary")


def pieces(tokens: DataFrame, p: TokenParams) -> DataFrame:
    """(token, n): the number of pieces of each distinct pre-token."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, normalizers
        tokenizer = Tokenizer.from_file(p.tokenizer_path)
        tokenizer.normalizer = normalizers.Sequence([])  # pre-tokens are normalised already
        for batch in batches:
            names = batch.column("token").to_pylist()
            n = []
            for at in range(0, len(names), 4096):
                n += [len(e.ids) for e in tokenizer.encode_batch(names[at:at + 4096], add_special_tokens=False)]
            n = np.array(n, np.int64)
            n[[i for i, name in enumerate(names) if name == SPECIAL]] = 1
            yield pa.RecordBatch.from_arrays([batch.column("token"), pa.array(n)], ["token", "n"])

    return tokens.select("token").distinct().mapInArrow(run, "token string, n long")


def partial_sums(joined: DataFrame, docs: int, held: int = 256) -> DataFrame:
    """(chunk, docs): pieces times frequency by document, summed over the rows of a task (at most ``held`` chunks of ``docs`` documents at once)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}

        def out() -> pa.RecordBatch:
            data = []
            for total in sums.values():
                some = np.flatnonzero(total)
                data.append(packed_sums(some, total[some]))
            return pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array(data, pa.binary())], ["chunk", "docs"])

        for batch in batches:
            chunks, chunk = np.unique(batch.column("chunk").to_numpy(), return_inverse=True)
            if len(sums) + len(chunks) > held and sums:
                yield out()
                sums.clear()
            n = batch.column("n").to_numpy()
            doc, row = flattened(batch.column("docs"), "<u2")
            more, more_row = flattened(batch.column("more"), MORE)
            place = np.concatenate([chunk[row] << 16 | doc, chunk[more_row] << 16 | more["doc"]])
            place, at = np.unique(place, return_inverse=True)
            total = np.bincount(at, np.concatenate([n[row], n[more_row] * more["n"].astype(np.int64)])).astype(np.int64)
            edge = np.searchsorted(place, np.arange(len(chunks) + 1) << 16)
            for key, a, b in zip(chunks.tolist(), edge, edge[1:]):
                if key not in sums:
                    sums[key] = np.zeros(docs, np.int64)
                sums[key][place[a:b] & 0xFFFF] += total[a:b]
        if sums:
            yield out()

    return joined.select("chunk", "n", "docs", "more").mapInArrow(run, "chunk long, docs binary")


def packed_sums(places: np.ndarray, sums: np.ndarray) -> bytes:
    return places.astype(np.uint16).tobytes() + sums.astype(np.int64).tobytes()


def unpacked_sums(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(data) // 10
    return np.frombuffer(data, np.uint16, n), np.frombuffer(data[2 * n:], np.int64, n)


def token_counts(docs: DataFrame, p: TokenParams) -> DataFrame:
    """The columns of ``docs`` but ``text``, and n_bytes, n_tokens and over_limit."""
    counted = frequencies(docs, p).persist(StorageLevel.MEMORY_AND_DISK)
    tokens = counted.where(F.col("token") != HEADER)
    sums = partial_sums(tokens.join(pieces(tokens, p), "token"), p.chunk_docs)
    heads = counted.where(F.col("token") == HEADER).select("chunk", "docs", F.lit(True).alias("head"))
    parts = heads.unionByName(sums.withColumn("head", F.lit(False)))

    def finish(table: pa.Table) -> pa.Table:
        head, total = None, np.zeros(p.chunk_docs, np.int64)
        for is_head, data in zip(table.column("head").to_pylist(), table.column("docs").to_pylist()):
            if is_head:
                head = pa.ipc.open_stream(data).read_all()
            else:
                places, n = unpacked_sums(data)
                total[places] += n
        total = total[:head.num_rows]
        return head.append_column("n_tokens", pa.array(total)).append_column("over_limit", pa.array(total > p.limit))

    keep = [c for c in docs.columns if c not in ("text", "n_bytes", "n_tokens", "over_limit")]
    zero = F.lit(0).cast("long")
    schema = docs.select(*keep).withColumns({"n_bytes": zero, "n_tokens": zero, "over_limit": F.lit(False)}).schema
    return parts.groupBy("chunk").applyInArrow(finish, schema)
