"""Counts and summaries: conditional counts, status pivots, quantiles, shares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The statuses an item may end in.
STATUSES = ("ok", "skipped", "no_box", "failed", "dropped")


def counts(df: DataFrame, by: list[str], **conditions: Column) -> DataFrame:
    """total, and how many rows meet each condition; combined before the shuffle."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("total"), *[F.count_if(cond).alias(k) for k, cond in conditions.items()])


def detection_counts(df: DataFrame, by: list[str] | None = None, error: str = "error", detected: str = "detected") -> DataFrame:
    """Of each row one of failed, detected, undetected: an error goes before a detection."""
    bad = F.col(error).isNotNull()
    hit = F.coalesce(F.col(detected), F.lit(False))
    return counts(df, by or [], failed=bad, detected=~bad & hit, undetected=~bad & ~hit)


def status_pivot(items: DataFrame, names: DataFrame, key: str, kind: str, status: str, kinds: tuple, statuses: tuple = STATUSES, flags: dict[str, Column] | None = None) -> DataFrame:
    """One row per name of either table: counts by kind and status, zero where none; flags are or-ed."""
    cells = [F.count_if((F.col(kind) == k) & (F.col(status) == s)).alias(f"{k}_{s}".lower()) for k in kinds for s in statuses]
    sums = [F.count_if(F.col(kind) == k).alias(f"{k}_count".lower()) for k in kinds]
    marks = [F.bool_or(F.coalesce(v, F.lit(False))).alias(k) for k, v in (flags or {}).items()]
    got = items.groupBy(key).agg(*sums, *cells, *marks)
    out = names.select(key).distinct().join(got, key, "full")
    zero = {f: F.coalesce(f, F.lit(False) if t == "boolean" else F.lit(0)) for f, t in out.dtypes if f != key}
    return out.withColumns(zero).orderBy(key)


def quantiles(df: DataFrame, by: list[str], value: str, points: dict[str, float]) -> DataFrame:
    """Linearly interpolated quantiles, exact."""
    p = F.percentile(F.col(value), F.array(*[F.lit(q) for q in points.values()]))
    return df.groupBy(*by).agg(p.alias("_p")).select(*by, *[F.col("_p")[i].alias(k) for i, k in enumerate(points)])


def fit_quality(df: DataFrame, by: list[str], score: str, low: float = 0.80, high: float = 0.90) -> DataFrame:
    """Mean, median, p10, p90, least, and the shares below low and from high on."""
    p = F.percentile(F.col(score), F.array(F.lit(0.1), F.lit(0.5), F.lit(0.9)))
    share = lambda cond: F.avg(cond.cast("double"))
    out = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.avg(score).alias("mean"), F.min(score).alias("least"), p.alias("_p"), share(F.col(score) < low).alias("below"), share(F.col(score) >= high).alias("above")
    )
    return out.select(*by, "n", "mean", "least", F.col("_p")[0].alias("p10"), F.col("_p")[1].alias("median"), F.col("_p")[2].alias("p90"), "below", "above")


def upper_median(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """The element after the middle of the sorted values, by a window and not a collected list."""
    from pyspark.sql import Window

    w = Window.partitionBy(*by)
    out = df.where(F.col(value).isNotNull()).withColumns({"_i": F.row_number().over(w.orderBy(value)), "_n": F.count(F.lit(1)).over(w)})
    return out.where("_i = _n div 2 + 1").select(*by, F.col(value).alias("upper_median"))


def flags(df: DataFrame, by: list[str], some: dict[str, Column], every: dict[str, Column]) -> DataFrame:
    """any-of and all-of marks per group."""
    return df.groupBy(*by).agg(*[F.bool_or(v).alias(k) for k, v in some.items()], *[F.bool_and(v).alias(k) for k, v in every.items()])


def prefix_of_group(df: DataFrame, by: list[str], name: str) -> DataFrame:
    """The longest common prefix of a group: that of its least and largest member."""
    from ..functions.names import common_prefix

    return df.groupBy(*by).agg(F.min(name).alias("_lo"), F.max(name).alias("_hi")).select(*by, common_prefix("_lo", "_hi").alias("prefix"))


def indexed(df: DataFrame, key: str, value: str) -> DataFrame:
    """Sorted distinct values per key."""
    return df.groupBy(key).agg(F.array_sort(F.collect_set(value)).alias("items"))


def owner_counts(items: DataFrame, owner: str, ok: Column, size: str) -> DataFrame:
    """One row: owners with an item that is ok, such items, and the sum of their sizes; combined per owner first."""
    by = items.where(ok).groupBy(owner).agg(F.count(F.lit(1)).alias("items"), F.sum(size).alias("size"))
    zero = lambda x: F.coalesce(F.sum(x), F.lit(0))
    return by.agg(F.count(F.lit(1)).alias("owners"), zero("items").alias("items"), zero("size").alias("size"))
