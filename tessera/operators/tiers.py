"""Tiered resolution: of several ways to get an item's box, the best that holds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import valid_box

# Ranks of the tiers and the gates' thresholds, all strict.
TIER_RANK = {"manual": 3, "match": 2, "derive": 1}
MATCH_MIN, FACE_MIN, HEAD_MIN, SPECIAL_IOU = 0.8, 0.60, 0.55, 0.85
STALE = ("dropped", "no_box", "failed")


def tier_rank(method) -> Column:
    out = F.lit(0)
    for name, rank in TIER_RANK.items():
        out = F.when(F.col(method) == name, rank).otherwise(out)
    return out


def coalesce_tiers(df: DataFrame, tiers: list[tuple[str, Column]], otherwise: str = "no_box") -> DataFrame:
    """method: the first tier whose condition holds; null conditions do not."""
    out = F.lit(otherwise)
    for name, cond in reversed(tiers):
        out = F.when(F.coalesce(cond, F.lit(False)), name).otherwise(out)
    return df.withColumn("method", out)


def match_gate(threshold, box) -> Column:
    return (F.col(threshold) > MATCH_MIN) & valid_box(box)


def derive_gate(detected="detected", confidence="confidence", head_detected="head_detected", head_confidence="head_confidence", face="face_pos", head="head_pos") -> Column:
    """Face and head were both found, both sure enough, both with a position."""
    return (
        F.col(detected) & F.col(head_detected) & (F.col(confidence) > FACE_MIN) & (F.col(head_confidence) > HEAD_MIN) & F.col(face).isNotNull() & F.col(head).isNotNull()
    )


def resolve(items: DataFrame, manual: DataFrame, match: DataFrame, derived: DataFrame, keys: list[str]) -> DataFrame:
    """items with method, box and confidence: manual over match over derive over none.

    manual: keys, box. match: keys, threshold, box. derived: keys, box, confidence (already gated). Left joins on the
    items' keys: Spark broadcasts whichever side its statistics show to be small.
    """
    m = manual.where(valid_box("box")).select(*keys, F.col("box").alias("_m"))
    x = match.where(match_gate("threshold", "box")).select(*keys, F.col("box").alias("_x"), F.col("threshold").alias("_xc"))
    d = derived.where(valid_box("box")).select(*keys, F.col("box").alias("_d"), F.col("confidence").alias("_dc"))
    out = items.join(m, keys, "left").join(x, keys, "left").join(d, keys, "left")
    out = coalesce_tiers(out, [("manual", F.col("_m").isNotNull()), ("match", F.col("_x").isNotNull()), ("derive", F.col("_d").isNotNull())])
    pick = lambda a, b, c: F.when(F.col("method") == "manual", a).when(F.col("method") == "match", b).when(F.col("method") == "derive", c)
    return out.select(*items.columns, "method", pick(F.col("_m"), F.col("_x"), F.col("_d")).alias("box"), pick(F.lit(1.0), F.col("_xc"), F.col("_dc")).alias("confidence"))


def diff_status(diffs: DataFrame, bases: DataFrame, keys: list[str], existing: str = "exists") -> DataFrame:
    """Status of a diff from its base after removal of duplicates: dropped, skipped, no_box or todo."""
    b = bases.select(*keys, F.col("status").alias("_b"), F.col("box").alias("base_box"))
    status = F.when(F.col("_b") == "dropped", "dropped").when(F.col(existing), "skipped").when(F.col("base_box").isNull(), "no_box").otherwise("todo")
    return diffs.join(b, keys, "left").withColumn("status", status).drop("_b")


def special(df: DataFrame, iou: str = "iou") -> DataFrame:
    return df.withColumn("special", F.col(iou) < SPECIAL_IOU)


def stale(items: DataFrame, outputs: DataFrame, keys: list[str], status: str = "status") -> DataFrame:
    """Existing outputs of items that ended without one: to be deleted."""
    return outputs.join(items.where(F.col(status).isin(*STALE)).select(*keys).distinct(), keys, "left_semi")
