"""Severity and detector metadata as column expressions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwatch import constants as C


def _map(d: dict) -> Column:
    return F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in d.items()))


def type_severity(t: Column) -> Column:
    """Severity of one detector type, unknown -> LOW."""
    return F.coalesce(_map(C.TYPE_SEVERITY)[t], F.lit("LOW"))


def _rank_name(rank: Column) -> Column:
    return F.when(rank == 3, F.lit("HIGH")).when(rank == 2, F.lit("MED")).otherwise(F.lit("LOW"))


def top_severity(types: Column) -> Column:
    """Highest severity of the fired list; empty -> LOW."""
    ranks = _map({k: C.SEV_RANK[v] for k, v in C.TYPE_SEVERITY.items()})
    return _rank_name(F.array_max(F.transform(types, lambda t: F.coalesce(ranks[t], F.lit(1)))))


def _overlap_rule(types: Column, high: list[str], med: list[str]) -> Column:
    hi = F.arrays_overlap(types, F.array(*[F.lit(x) for x in high]))
    md = F.arrays_overlap(types, F.array(*[F.lit(x) for x in med]))
    return F.when(F.coalesce(hi, F.lit(False)), F.lit("HIGH")).when(F.coalesce(md, F.lit(False)), F.lit("MED")) \
        .otherwise(F.lit("LOW"))


def fallback_severity(types: Column) -> Column:
    """Used when a log row has no severity field."""
    return _overlap_rule(types, C.FALLBACK_HIGH, C.FALLBACK_MED)


def rules_only_severity(types: Column) -> Column:
    """The rules-only classifier (model types count as LOW)."""
    return _overlap_rule(types, C.RULES_ONLY_HIGH, C.RULES_ONLY_MED)


def severity(types: Column, variant: str = "full") -> Column:
    if variant == "full":
        return top_severity(types)
    if variant == "fallback":
        return fallback_severity(types)
    if variant == "rules_only":
        return rules_only_severity(types)
    raise ValueError(f"unknown severity variant {variant!r}")


def primary_type(types: Column) -> Column:
    """P10: first fired type, else 'unknown'."""
    return F.coalesce(F.try_element_at(types, F.lit(1)), F.lit("unknown"))


def detector_dim(spark: SparkSession) -> DataFrame:
    """The 6-row detector dimension (type, layer, severity, description, is_ml)."""
    rows = [(t, layer, sev, desc, layer in C.ML_LAYERS) for t, (layer, sev, desc) in C.TYPE_META.items()]
    return spark.createDataFrame(rows, "type string, layer string, severity string, description string, is_ml boolean")


def type_layer(t: Column) -> Column:
    return F.coalesce(_map({k: v[0] for k, v in C.TYPE_META.items()})[t], F.lit(C.META_DEFAULT[0]))


def type_meta_severity(t: Column) -> Column:
    return F.coalesce(_map({k: v[1] for k, v in C.TYPE_META.items()})[t], F.lit(C.META_DEFAULT[1]))


def type_description(t: Column) -> Column:
    return F.coalesce(_map({k: v[2] for k, v in C.TYPE_META.items()})[t], F.lit(C.META_DEFAULT[2]))


def layer_tag(layer: Column) -> Column:
    """P21: 'ml' for ML / Deep ML layers, else 'rule'."""
    return F.when(layer.isin(*C.ML_LAYERS), F.lit("ml")).otherwise(F.lit("rule"))
