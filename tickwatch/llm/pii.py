"""Personal data by fixed patterns and information-theoretic sanitisation, DataFrame functions only.

Patterns find e-mail addresses, IP addresses, card and phone numbers. What they find are the
protected entities. What a term leaves unknown of an entity is the entity's information content
less the term's pointwise mutual information with it (Sanchez and Batet 2016), which is the
information in p(entity | term); that doesn't depend on the number of texts. The probability is
estimated as df(t, e) / df(t), shrunk by s / (s + ``doubt``): s counts the different texts that hold
both, so a word isn't personal just for being rare, and ``kin`` more where the term is a part of the
entity (a name in an e-mail address), so an entity in a single text is protected too. Terms that
leave at most ``unknown`` bits are spans of kind ``term`` wherever they stand, in texts with and
without that entity: a term that only stands beside it is removed, another generalised. An entity
with no more than ``unknown`` bits itself (in half of all texts) has nothing to reveal.

Places are code points, ends exclusive. Null and empty texts have no spans. Every row is one row
of the result, repeated rows and null ids too; other columns pass through, but columns named
``spans`` and ``sanitised`` are replaced, and those named as in ``INSIDE`` go. ``sanitised`` is null where nothing was found.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwatch.llm.common import written

KINDS = ("email", "ip", "card", "phone")
#: Stands for a separator between two digits, or a dot between two labels, so that a run is one character class.
JOINT, NOT_JOINT = "\ue000", "\ue001"
#: Columns of the operator's own tables.
INSIDE = ("__key", "__text", "__spans", "__terms", "__gone", "__more", "__all")
SPAN = "struct<start:int,ord:int,end:int,kind:string,found:string>"
TERM = r"\p{L}{3,}"


@dataclass(frozen=True)
class PiiParams:
    unknown: float = 1.0  # bits of an entity's information that a term may leave unknown and still reveal it
    doubt: float = 3.0  # weight of the doubt, in texts
    kin: float = 3.0  # evidence, in texts, of a term that is a part of the entity


def places(text: Column, pattern: Column, kind: str, order: int) -> Column:
    """The matches of a pattern as spans, their places summed up from the stretches between them."""
    parts = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, pattern, F.lit(0)).alias("found"))

    def add(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["found"])
        span = F.struct(start.alias("start"), F.lit(order).alias("ord"), end.alias("end"), F.lit(kind).alias("kind"), x["found"].alias("found"))
        return F.when(x["found"].isNull(), acc).otherwise(F.struct(end.alias("at"), F.concat(acc["spans"], F.array(span)).alias("spans")))

    zero = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("spans"))
    return F.aggregate(parts, zero, add)["spans"]


def digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def luhn(found: Column) -> Column:
    """Whether the digits, every second from the right doubled and cast out, sum up to a multiple of ten."""
    doubled = F.transform(F.regexp_extract_all(F.reverse(found), F.lit("[0-9]"), F.lit(0)),
                          lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise((2 * c.cast("int")) % 10 + F.floor(2 * c.cast("int") / 10).cast("int")))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def base_spans(text: Column) -> Column:
    """What the patterns find, by start, then kind; failing matches are dropped without another try."""
    none = F.array().cast(f"array<{SPAN}>")
    plain = F.regexp_replace(text, JOINT, NOT_JOINT)  # a text's own joint characters join nothing

    # a match can start at the start of a run or where the last match ended, not within a run
    labels = F.regexp_replace(plain, r"(?<=[A-Za-z0-9-])\.(?=[A-Za-z0-9-])", JOINT)
    email = rf"(?:(?<![A-Za-z0-9._%+{JOINT}-])|\G)[A-Za-z0-9._%+{JOINT}-]++@[A-Za-z0-9-]++{JOINT}[A-Za-z0-9{JOINT}-]++"
    emails = F.when(text.contains("@"), places(labels, F.lit(email), "email", 0)).otherwise(none)

    ip = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
    ips = F.when(text.rlike(r"[0-9]\.[0-9]"), F.filter(places(text, F.lit(ip), "ip", 1), lambda s: F.forall(
        F.split(s["found"], r"\."), lambda x: F.regexp_replace(x, "^0+(?=[0-9])", "").rlike("^([0-9]|[0-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5])$")))).otherwise(none)

    numbers = F.regexp_replace(plain, r"(?<=[0-9])[\x20-](?=[0-9])", JOINT)
    cards = F.when(text.rlike(r"[0-9](?:[\x20-]?[0-9]){13}"), F.filter(
        places(numbers, F.lit(f"[0-9][0-9{JOINT}]++"), "card", 2),
        lambda s: F.length(digits(s["found"])).between(14, 19) & luhn(s["found"]))).otherwise(none)

    phone = r"\+[0-9][\x20().0-9-]+[0-9]"
    phones = F.when(text.contains("+"), F.filter(places(text, F.lit(phone), "phone", 3),
                                                 lambda s: F.length(digits(s["found"])).between(10, 15))).otherwise(none)
    return F.array_sort(F.concat(emails, ips, cards, phones))


def key(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def term_places(text: Column, wanted: Column) -> Column:
    """The words that are wanted terms, as spans; their places are summed up over all words."""
    parts = F.arrays_zip(F.split(text, F.lit(TERM), -1).alias("gap"), F.regexp_extract_all(text, F.lit(TERM), F.lit(0)).alias("found"))

    def add(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["found"])
        span = F.struct(start.alias("start"), F.lit(len(KINDS)).alias("ord"), end.alias("end"), F.lit("term").alias("kind"), x["found"].alias("found"))
        more = F.when(F.array_contains(wanted, F.lower(x["found"])), F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"])
        return F.when(x["found"].isNull(), acc).otherwise(F.struct(end.alias("at"), more.alias("spans")))

    zero = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("spans"))
    return F.aggregate(parts, zero, add)["spans"]


def terms(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0)))


def parts_of(entity: Column) -> Column:
    """The words in the name of an e-mail address; other entities have none."""
    name = F.when(entity.startswith("email:"), F.regexp_replace(F.lower(F.substring(entity, 7, 1 << 30)), "@.*", "")).otherwise("")
    return F.array_distinct(F.regexp_extract_all(name, F.lit(TERM), F.lit(0)))


def disclosing(docs: DataFrame, found: DataFrame, p: PiiParams) -> DataFrame:
    """(term, gone): the terms that reveal an entity, and whether they reveal one fully.

    ``found`` is (key, text, spans) of the rows with spans. Entities of the same texts meet the same
    terms, so they are counted once, as one group; the terms of all texts are counted once, pre-aggregated.
    """
    entity = F.explode_outer(F.array_distinct(F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["found"]))))
    met = found.select("key", entity.alias("entity"))
    weight = found.groupBy("key").agg(F.count(F.lit(1)).alias("rows"))
    pairs = written(met.distinct().join(weight, "key"))
    # the digests of an entity's texts, in any order, name its group
    alike = [F.bit_xor(F.xxhash64("key", F.lit(seed))).alias(f"g{seed}") for seed in (1, 2)]
    entities = written(pairs.groupBy("entity").agg(F.sum("rows").alias("df_e"), *alike))
    members = written(pairs.join(entities, "entity").select("g1", "g2", "df_e", "key", "rows").distinct())
    parts = entities.select("g1", "g2", F.explode(parts_of(F.col("entity"))).alias("term")).distinct().withColumn("kin", F.lit(p.kin))
    texts = found.groupBy("key").agg(F.first("text").alias("text"))
    beside = members.join(texts, "key").select("g1", "g2", "df_e", "rows", F.explode_outer(terms(F.col("text"))).alias("term"))
    together = beside.groupBy("g1", "g2", "df_e", "term").agg(F.count(F.lit(1)).alias("texts"), F.sum("rows").alias("df_te"))
    least = 2.0 ** -p.unknown
    s = F.col("texts") + F.coalesce("kin", F.lit(0.0))
    # what the evidence can't carry at any df(t) goes before the terms of all texts are met
    backed = written(together.join(parts, ["g1", "g2", "term"], "left").withColumn("s", s).where(F.col("s") >= least * (F.col("s") + p.doubt)))
    alone = docs.select(F.explode_outer(terms(F.col("text"))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df_t"))
    known = backed.join(alone, "term").withColumn("n", docs.select(F.count(F.lit(1))).scalar())
    revealing = known.where((F.log2(F.col("n") / F.col("df_e")) > p.unknown)
                            & (F.col("df_te") * F.col("s") >= least * F.col("df_t") * (F.col("s") + p.doubt)))
    return written(revealing.groupBy("term").agg(F.max(F.col("df_te") >= F.col("df_t")).alias("gone")))


def held(docs: DataFrame, revealing: DataFrame) -> DataFrame:
    """(key, terms, gone): for each text with disclosing terms these terms, and those that reveal fully."""
    # a text's key once, below the explosion, not once a term
    each = docs.select(key(F.col("text")).alias("key"), terms(F.col("text")).alias("terms")).select("key", F.explode_outer("terms").alias("term"))
    # copies of a text become one before the text's terms are gathered
    own = each.join(revealing, "term").groupBy("key", "term").agg(F.first("gone").alias("gone"))
    return written(own.groupBy("key").agg(F.collect_list("term").alias("terms"), F.collect_list(F.when(F.col("gone"), F.col("term"))).alias("gone")))


def sanitised(text: Column, spans: Column, gone: Column) -> Column:
    """The text with spans named by their kinds; terms that reveal fully go, overlapping spans become one."""
    def put(acc: Column, s: Column) -> Column:
        name = F.when((s["kind"] == "term") & F.coalesce(F.array_contains(gone, F.lower(s["found"])), F.lit(False)), "").otherwise(F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
        between = F.substring(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        more = F.when(s["start"] >= acc["at"], F.concat(acc["out"], between, name)).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), more.alias("out"))

    done = F.aggregate(spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), put)
    return F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text)))


def scan(docs: DataFrame, p: PiiParams = PiiParams()) -> DataFrame:
    """The columns of ``docs`` but ``text``, spans (kind, start, end) and the sanitised text."""
    keep = [c for c in docs.columns if c not in ("text", "spans", "sanitised", *INSIDE)]
    text = F.coalesce("text", F.lit(""))
    spanned = docs.select(*keep, text.alias("__text"), base_spans(text).alias("__spans"))
    some = F.size("__spans") > 0
    # a table of all rows, with the text only where something was found
    base = written(spanned.select(*keep, "__spans", key(F.col("__text")).alias("__key"), F.when(some, F.col("__text")).alias("__text")))
    hit = base.where("__text IS NOT NULL")
    plain = docs.select(text.alias("text"))
    own = held(plain, disclosing(plain, hit.select(F.col("__key").alias("key"), F.col("__text").alias("text"), F.col("__spans").alias("spans")), p))
    # the texts that hold a disclosing term but nothing that the patterns find, read again
    beyond = own.select("key").join(hit.select(F.col("__key").alias("key")).distinct(), "key", "left_anti")
    more = (plain.withColumn("key", key(F.col("text"))).join(beyond, "key", "left_semi")
            .groupBy("key").agg(F.first("text").alias("__more")))
    own = own.join(more, "key", "left").select(F.col("key").alias("__key"), F.col("terms").alias("__terms"), F.col("gone").alias("__gone"), "__more")
    full = base.join(own, "__key", "left").withColumn("__text", F.coalesce("__text", "__more"))
    term_spans = F.when(F.col("__terms").isNotNull(), F.filter(
        term_places(F.col("__text"), F.col("__terms")),
        lambda t: ~F.exists("__spans", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))).otherwise(F.array().cast(f"array<{SPAN}>"))
    full = full.withColumn("__all", F.array_sort(F.concat("__spans", term_spans)))
    out = F.transform("__all", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    changed = F.when(F.size("__all") > 0, sanitised(F.col("__text"), F.col("__all"), F.col("__gone")))
    return full.select(*keep, out.alias("spans"), changed.alias("sanitised"))
