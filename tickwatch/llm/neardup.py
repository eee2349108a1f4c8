"""Near-duplicates of weighted word shingles by ProbMinHash, banding and exact verification.

Texts are lower-cased words; a shingle is five words in a row (all words of a shorter text), its
weight the number of times it occurs. ProbMinHash (Ertl 2020) draws Poisson arrivals for every
shingle at the rate of its weight and stops once none can come first in any register; two texts
agree in a register with probability J_P, their probability Jaccard similarity, which ignores
the scale of the weights and is the Jaccard similarity where they are equal.

1. Texts of equal words are one node. Bands of registers put nodes into buckets.
2. In each bucket every node is compared with the node that meets most others: a star, not all
   pairs. Each pair is verified by the exact J_P of its shingles.
3. Connected components of the verified pairs. Buckets that still hold several components are
   compared again, in blocks: agreement of whole signatures picks the pairs that can reach the
   threshold, and the block's task verifies those exactly. So no bucket hides a link.
4. Components of all links are the classes.

Null, empty and blank texts have no shingles and stand alone. ``class_id`` is the smallest
doc_id of a class (null ids don't count; a class without any id has a null class_id, a text
without words its own doc_id). Repeated rows come back each. Other columns pass through, but
columns named class_id and __node are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwatch.llm.common import Numbering, csr_rows, hash64, mix64, passed_on, text_slices, written

BLOCK = 512  # nodes of a bucket that one task compares with another block


@dataclass(frozen=True)
class NearDupParams:
    words: int = 5
    threshold: float = 0.8
    bands: int = 36
    rows: int = 7  # registers a band
    slack: float = 0.1  # by which an estimate may fall short (four standard errors of 252 registers)
    filter_bits: int = 24  # log2 of the bits of the filter for compared nodes

    @property
    def registers(self) -> int:
        return self.bands * self.rows


def node_key(words: list[str]) -> bytes | None:
    """A 128-bit digest of the words, null without any."""
    from xxhash import xxh3_128_digest
    return xxh3_128_digest("\n".join(words)) if words else None


class Shingles:
    """Hashes and weights of the shingles of texts."""

    def __init__(self, p: NearDupParams, keep: int = 150_000):
        self.n, self.keep = p.words, keep
        self.known, self.hashes = Numbering(), np.empty(0, np.uint64)

    def of(self, split: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text numbers, shingle hashes and weights, in order of text and hash."""
        if len(self.known) > self.keep:
            self.known, self.hashes = Numbering(), np.empty(0, np.uint64)
        before = len(self.known)
        ids = self.known.of([w for words in split for w in words])
        if len(self.known) > before:
            self.hashes = np.concatenate([self.hashes, hash64(list(self.known)[before:])])
        lengths = np.fromiter(map(len, split), np.int64, len(split))
        row, h = csr_rows(lengths), self.hashes[ids]
        place = np.arange(len(h)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        left = np.repeat(lengths, lengths) - place  # words from here to the end of the text
        starts = (left >= self.n) | (place == 0) & (left < self.n)
        code = h.copy()
        with np.errstate(over="ignore"):
            for j in range(1, min(self.n, len(h))):
                step = mix64(code[:-j] + np.uint64(j)) + h[j:]
                code[:-j] = np.where(left[:-j] > j, step, code[:-j])
        row, code = row[starts], code[starts]
        order = np.lexsort((code, row))
        row, code = row[order], code[order]
        new = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (code[1:] != code[:-1]))) if len(row) else np.empty(0, np.int64)
        return row[new], code[new], np.diff(np.append(new, len(row)))


def prob_min_hash(row: np.ndarray, element: np.ndarray, weight: np.ndarray, n: int, registers: int) -> np.ndarray:
    """For each of n texts the element that arrives first in each register.

    Round by round each element that can still come first draws its next arrivals: exponential
    waiting times at the rate of its weight, each with a random register. An element whose last
    arrival is later than the latest register of its text is done (early termination).
    """
    first = np.full(n * registers, np.inf)
    winner = np.zeros(n * registers, np.uint64)
    now, drawn = np.zeros(len(element)), np.zeros(len(element), np.int64)
    while len(element):
        # texts with few elements left draw more arrivals of each at once
        left = np.bincount(row, minlength=n)
        draws = np.clip(registers // (2 * np.maximum(left, 1)), 1, 64)[row]
        at = np.repeat(np.arange(len(element)), draws)
        turn = np.arange(len(at)) - np.repeat(np.cumsum(draws) - draws, draws) + drawn[at]
        with np.errstate(over="ignore"):
            z = mix64(element[at] + (turn + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            register = (mix64(z) >> np.uint64(32)).astype(np.int64) * registers >> 32
        wait = -np.log(((z >> np.uint64(11)).astype(np.float64) + 1) * 2.0 ** -53) / weight[at]
        total = np.cumsum(wait)
        starts = np.cumsum(draws) - draws
        time = total - np.repeat(total[starts] - wait[starts] - now, draws)
        slot = row[at] * registers + register
        np.minimum.at(first, slot, time)
        won = time == first[slot]
        winner[slot[won]] = element[at[won]]
        now = time[starts + draws - 1]
        drawn = drawn + draws
        active = np.unique(row)
        latest = np.zeros(n)
        latest[active] = first.reshape(n, registers)[active].max(1)
        go = now < latest[row]
        row, element, weight, now, drawn = row[go], element[go], weight[go], now[go], drawn[go]
    return winner.reshape(n, registers)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """The exact J_P of two weighted sets (sorted elements, weights)."""
    both, ia, ib = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(both):
        return 0.0
    x, y = a[1].astype(float), b[1].astype(float)
    ratios, times = np.unique(x[ia] / y[ib], return_inverse=True)
    common_x, common_y = x[ia], y[ib]
    only_x, only_y = x.sum() - common_x.sum(), y.sum() - common_y.sum()
    share = np.bincount(times, common_x, minlength=len(ratios))
    return float(sum(s / (only_x + r * only_y + np.maximum(common_x, r * common_y).sum()) for r, s in zip(ratios, share)))


def _split(texts: list[str]) -> list[list[str]]:
    return [t.lower().split() for t in texts]


def nodes(docs: DataFrame, p: NearDupParams) -> DataFrame:
    """(key, first_id, bands, signature) of each distinct text with words; a signature has a byte a register."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(p)
        for batch in batches:
            for start, texts in text_slices(batch, max_docs=128, max_chars=400_000):
                split = _split(texts)
                winner = prob_min_hash(*shingles.of(split), len(texts), p.registers)
                band = np.zeros((len(texts), p.bands), np.uint64)
                with np.errstate(over="ignore"):
                    for r in range(p.rows):
                        band = mix64(band + winner[:, r::p.rows] + np.uint64(r))
                sketch = (mix64(winner) >> np.uint64(56)).astype(np.uint8)
                flat = pa.array(band.view(np.int64).ravel())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([node_key(w) for w in split], pa.binary()), batch.column("doc_id").slice(start, len(texts)),
                     pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1, dtype=np.int32) * p.bands), flat), pa.array([x.tobytes() for x in sketch], pa.binary())],
                    ["key", "doc_id", "bands", "signature"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    sketched = docs.select("doc_id", "text").mapInArrow(run, f"key binary, doc_id {id_type}, bands array<long>, signature binary")
    return (sketched.where("key IS NOT NULL").groupBy("key")
            .agg(F.min("doc_id").alias("first_id"), F.first("bands").alias("bands"), F.first("signature").alias("signature")))


def shared_buckets(sketched: DataFrame) -> DataFrame:
    """(band, bucket, key, n) of the nodes of buckets with two or more."""
    in_band = sketched.select("key", F.posexplode("bands").alias("band", "bucket"))
    sizes = in_band.groupBy("band", "bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return in_band.join(sizes, ["band", "bucket"])


def star_pairs(shared: DataFrame) -> DataFrame:
    """(a, b): each node of a bucket with the node of it that meets most others."""
    meets = shared.groupBy("key").agg(F.sum("n").alias("meets"))
    ranked = shared.join(meets, "key")
    centre = ranked.groupBy("band", "bucket").agg(F.max(F.struct("meets", "key")).alias("centre"))
    met = shared.join(centre, ["band", "bucket"]).select("key", F.col("centre.key").alias("centre")).where("key <> centre")
    return met.select(F.least("key", "centre").alias("a"), F.greatest("key", "centre").alias("b")).distinct()


def block_links(split: DataFrame, content: DataFrame, p: NearDupParams) -> DataFrame:
    """(a, b): verified pairs of nodes of different components in buckets that hold several.

    ``split`` is (band, bucket, key, n, component, signature). A bucket is cut into blocks; each
    pair of blocks is one task's group, of at most some 2 * BLOCK nodes with their shingles. Pairs
    whose signatures can reach the threshold are verified there, each in the first band that it
    shares, so only links leave the task, not pairs.
    """
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    cut = split.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("key", "band"), F.col("blocks")).cast("int"))
    dealt = (cut.join(content, "key").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("band", "bucket", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "key", "component", "signature", "content"))
    least = p.threshold - p.slack

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        low, high, band = int(group["low"].iloc[0]), int(group["high"].iloc[0]), int(group["band"].iloc[0])
        key, own, content = group["key"].to_numpy(), group["own"].to_numpy(), group["content"].to_numpy()
        component = pd.factorize(group["component"].map(bytes))[0]
        sig = np.frombuffer(b"".join(group["signature"]), np.uint8).reshape(len(group), -1)
        left, right = np.flatnonzero(own == low), np.flatnonzero(own == high)
        out = []
        for i in left:
            others = right[(component[right] != component[i]) & ((right > i) | (low != high))]
            if len(others):
                agree = sig[others] == sig[i]
                near = agree.mean(1) >= least
                first = agree[near].reshape(-1, p.bands, p.rows).all(2).argmax(1)
                for j in others[near][first == band]:
                    if similarity(unpacked(content[i]), unpacked(content[j])) >= p.threshold:
                        out.append((key[i], key[j]) if key[i] < key[j] else (key[j], key[i]))
        return pd.DataFrame(out, columns=["a", "b"])

    return dealt.groupBy("band", "bucket", "low", "high").applyInPandas(compare, "a binary, b binary").distinct()


def node_filter(wanted: DataFrame, p: NearDupParams) -> np.ndarray:
    """A bit map of the hashed keys of nodes, of 2^filter_bits bits whatever their number."""
    slot = F.shiftrightunsigned(F.xxhash64("key"), 64 - p.filter_bits)
    ends = wanted.select(slot.alias("slot"))
    bytes_ = ends.groupBy(F.shiftright("slot", 5).alias("at")).agg(F.expr("bit_or(shiftleft(1L, CAST(slot & 31 AS INT))) AS bits")).toPandas()
    bits = np.zeros(1 << p.filter_bits - 5, np.uint32)
    bits[bytes_["at"].to_numpy(np.int64)] = bytes_["bits"].to_numpy(np.int64)
    return bits


def contents(docs: DataFrame, wanted: DataFrame, p: NearDupParams) -> DataFrame:
    """(key, content): the weighted shingles of the wanted nodes (key, each once).

    A bounded bit map leaves out most texts that aren't wanted; the join leaves out the rest.
    """
    bits = docs.sparkSession.sparkContext.broadcast(node_filter(wanted, p))
    keyed = node_keys(docs.select("text"), text=True).withColumnRenamed("__node", "key").where("key IS NOT NULL").withColumn("slot", F.shiftrightunsigned(F.xxhash64("key"), 64 - p.filter_bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(p)
        for batch in batches:
            slot = batch.column("slot").to_numpy()
            batch = batch.filter(pa.array((bits.value[slot >> 5] >> (slot & 31).astype(np.uint32) & 1).astype(bool)))
            for start, texts in text_slices(batch, max_docs=128, max_chars=400_000):
                row, code, weight = shingles.of(_split(texts))
                cut = np.searchsorted(row, np.arange(len(texts) + 1))
                data = [code[a:b].tobytes() + weight[a:b].astype(np.uint32).tobytes() for a, b in zip(cut, cut[1:])]
                yield pa.RecordBatch.from_arrays([batch.column("key").slice(start, len(texts)), pa.array(data, pa.binary())], ["key", "content"])

    found = keyed.select("key", "slot", "text").mapInArrow(run, "key binary, content binary")
    return found.groupBy("key").agg(F.first("content").alias("content")).join(wanted, "key", "left_semi")


def unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(data) // 12
    return np.frombuffer(data, np.uint64, n), np.frombuffer(data, np.uint32, n, 8 * n)


def verified(pairs: DataFrame, content: DataFrame, p: NearDupParams) -> DataFrame:
    """The pairs (a, b) whose exact similarity reaches the threshold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            alike = [similarity(unpacked(x.as_buffer()), unpacked(y.as_buffer())) >= p.threshold
                     for x, y in zip(batch.column("of_a"), batch.column("of_b"))]
            yield batch.select(["a", "b"]).filter(pa.array(alike, pa.bool_()))

    both = (pairs.join(content.select(F.col("key").alias("a"), F.col("content").alias("of_a")), "a")
            .join(content.select(F.col("key").alias("b"), F.col("content").alias("of_b")), "b"))
    return both.select("a", "b", "of_a", "of_b").mapInArrow(run, "a binary, b binary")


def components(links: DataFrame) -> DataFrame:
    """(key, component): the smallest key of the component of each node in links.

    Each round a node takes the smallest label around it, then its label's label, so labels
    travel twice as far each round; every round is a written table.
    """
    both = written(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    label = written(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("key"), F.least("a", "b").alias("component")))
    while True:
        around = (both.join(label.select(F.col("key").alias("b"), "component"), "b").groupBy(F.col("a").alias("key")).agg(F.min("component").alias("near")))
        nearer = label.join(around, "key").select("key", F.col("component").alias("was"), F.least("component", "near").alias("component"))
        jump = nearer.select(F.col("key").alias("component"), F.col("component").alias("further"))
        new = written(nearer.join(jump, "component").select("key", "was", F.least("component", "further").alias("component")))
        label = new.select("key", "component")
        if new.where("was <> component").isEmpty():
            return label


def node_keys(docs: DataFrame, text: bool = False) -> DataFrame:
    """The columns of ``docs`` and ``__node``, the key of each text's node; without the text unless asked for."""
    keep = [c for c in docs.columns if c != "__node" and (text or c != "text")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = [node_key(w) for _, texts in text_slices(batch) for w in _split(texts)]
            yield passed_on(batch.select(keep), {"__node": pa.array(key, pa.binary())})

    source = docs.select(*keep, *([] if text else ["text"]))
    schema = docs.select(*keep).withColumn("__node", F.lit(None).cast("binary")).schema
    return source.mapInArrow(run, schema)


def links(docs: DataFrame, sketched: DataFrame, p: NearDupParams) -> DataFrame:
    """(a, b): verified pairs that connect all nodes of a class."""
    shared = written(shared_buckets(sketched))
    stars = written(star_pairs(shared))
    ends = written(stars.select(F.explode(F.array("a", "b")).alias("key")).distinct())
    linked = written(verified(stars, contents(docs, ends, p), p))
    label = components(linked)
    placed = shared.join(label, "key", "left").withColumn("component", F.coalesce("component", "key"))
    several = placed.groupBy("band", "bucket").agg(F.min("component").alias("least"), F.max("component").alias("most")).where("least <> most").select("band", "bucket")
    split = placed.join(several, ["band", "bucket"]).where("n > 2")  # the pair of a bucket of two has been compared
    split = written(split.join(sketched.select("key", "signature"), "key"))
    inside = written(split.select("key").distinct())
    return linked.unionByName(block_links(split, contents(docs, inside, p), p))


def classified(docs: DataFrame, p: NearDupParams = NearDupParams()) -> DataFrame:
    """The columns of ``docs`` but ``text``, ``class_id``, and ``class_key``, which names the class.

    Where an id is repeated with unlike texts, its classes can share a class_id, never a class_key.
    Rows without words have none: they are alike to no other.
    """
    sketched = written(nodes(docs, p))
    label = components(links(docs, sketched, p))
    of_node = sketched.select("key", "first_id").join(label, "key", "left").withColumn("component", F.coalesce("component", "key"))
    classes = of_node.groupBy("component").agg(F.min("first_id").alias("class_id"))
    by_key = of_node.join(classes, "component").select(F.col("key").alias("__node"), "class_id", F.col("component").alias("class_key"))
    docs = docs.drop("class_id", "class_key")
    out = node_keys(docs).join(by_key, "__node", "left")
    class_id = F.when(F.col("__node").isNull(), F.col("doc_id")).otherwise(F.col("class_id"))
    return out.withColumn("class_id", class_id).select(*[c for c in docs.columns if c != "text"], "class_id", "class_key")


def near_duplicates(docs: DataFrame, p: NearDupParams = NearDupParams()) -> DataFrame:
    """The columns of ``docs`` but ``text``, and ``class_id``."""
    return classified(docs, p).drop("class_key")
