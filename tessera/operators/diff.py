"""Comparison of snapshots by key: diffs, counts, mirror and restore plans, key sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHANGES = ("added", "removed", "modified", "unchanged")


def manifest_diff(old: DataFrame, new: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys and change of every entry of either snapshot, by one full outer join on the keys. A null value differs from none but null."""
    a = old.select(*keys, F.col(value).alias("_old"), F.lit(True).alias("_in_old"))
    b = new.select(*keys, F.col(value).alias("_new"), F.lit(True).alias("_in_new"))
    change = (
        F.when(F.col("_in_old").isNull(), "added")
        .when(F.col("_in_new").isNull(), "removed")
        .when(F.col("_old").eqNullSafe(F.col("_new")), "unchanged")
        .otherwise("modified")
    )
    return a.join(b, keys, "full").select(*keys, change.alias("change"))


def diff_counts(diff: DataFrame, by: list[str] | None = None) -> DataFrame:
    """One row (a group): the number of each change and total, the entries that changed."""
    of = lambda k: F.count_if(F.col("change") == k)
    counts = [of(k).alias(k) for k in CHANGES] + [F.count_if(F.col("change") != "unchanged").alias("total")]
    return diff.groupBy(*(by or [])).agg(*counts)


def category_diff(old: DataFrame, new: DataFrame, category: str, keys: list[str], value: str) -> DataFrame:
    """manifest_diff within the categories that both sides have."""
    shared = old.select(category).distinct().join(new.select(category).distinct(), category)
    return manifest_diff(old.join(shared, category, "left_semi"), new.join(shared, category, "left_semi"), [category, *keys], value)


def mirror_plan(local: DataFrame, remote: DataFrame, keys: list[str], same: Column, last: Column | None = None) -> DataFrame:
    """keys, action (copy, delete, keep) and ord: what makes remote equal to local; ``last`` rows come after all others.

    same compares columns of ``l`` and ``r``. An empty local side keeps the whole remote side.
    """
    left = local.select(*keys, F.struct(*local.columns).alias("l"))
    right = remote.select(*keys, F.struct(*remote.columns).alias("r"))
    has_local = left.limit(1).agg(F.count(F.lit(1)).alias("_n"))
    action = F.when(F.col("_n") == 0, "keep").when(F.col("r").isNull(), "copy").when(F.col("l").isNull(), "delete").when(same, "keep").otherwise("copy")
    out = left.join(right, keys, "full").crossJoin(F.broadcast(has_local))  # one row
    return out.select(*keys, action.alias("action"), F.coalesce((last if last is not None else F.lit(False)).cast("int"), F.lit(0)).alias("ord"))


def restore_plan(remote: DataFrame, local: DataFrame, keys: list[str]) -> DataFrame:
    """What the local side lacks."""
    return remote.join(local.select(*keys).distinct(), keys, "left_anti")


def key_union(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    return a.select(*keys).unionByName(b.select(*keys)).distinct()


def key_difference(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    return a.select(*keys).subtract(b.select(*keys))


def key_intersection(first: DataFrame, *rest: DataFrame, keys: list[str]) -> DataFrame:
    out = first.select(*keys)
    for other in rest:
        out = out.intersect(other.select(*keys))
    return out
