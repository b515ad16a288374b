"""Order-dependent selection: ranking, early stop, top-1, grids, samples. Every order is total."""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import c, without_variant


def _plain(name: str) -> Column:
    return F.lower(without_variant(name))


def _first(columns: list[str]) -> list[Column]:
    """An order with nulls last."""
    return [F.col(x).asc_nulls_last() for x in columns]


def rank_candidates(pairs: DataFrame, keys: list[str], wanted: str, name: str, limit: int | None = None, ties: tuple[str, ...] = ()) -> DataFrame:
    """pairs with distance (edits between the names without variant, lower case) and rank, nearest first, then by name, then by ties; nulls last."""
    out = pairs.withColumn("distance", F.levenshtein(_plain(wanted), _plain(name)))
    out = out.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*_first(["distance", name, *ties]))))
    return out.where(F.col("rank") <= limit) if limit else out


def nearest_names(items: DataFrame, names: DataFrame, on: list[str], keys: list[str], wanted: str, name: str, limit: int, ties: tuple[str, ...] = ()) -> DataFrame:
    """rank_candidates of items joined with names on the columns on, without making that join's pairs.

    A distance depends on the two names without variant alone. So each pair of different ones is measured once, of names alike the first ``limit`` stand for all, and
    every item gets the nearest of its own name before its key's are ranked. Exact; the cost is that of the different names' pairs, and ``limit`` rows an item.
    """
    w = lambda *by: Window.partitionBy(*by)
    tasks = max(int(items.sparkSession.conf.get("spark.sql.shuffle.partitions")), items.sparkSession.sparkContext.defaultParallelism)
    # in a given number of partitions, for a few rows of names make many pairs
    few = names.withColumn("_s", _plain(name)).repartition(tasks, *on, "_s")
    few = few.withColumn("_n", F.row_number().over(w(*on, "_s").orderBy(*_first([name, *ties])))).where(F.col("_n") <= limit)
    items = items.withColumn("_w", _plain(wanted))
    pairs = items.select(*on, "_w").distinct().join(few, on).withColumn("distance", F.levenshtein("_w", "_s"))
    near = pairs.withColumn("_n", F.row_number().over(w(*on, "_w").orderBy(*_first(["distance", name, *ties])))).where(F.col("_n") <= limit)
    near = near.drop("_s", "_n").withColumnsRenamed({x: f"_on_{x}" for x in on}).withColumnRenamed("_w", "_of")
    same = F.col("_w").eqNullSafe(F.col("_of"))
    for x in on:
        same = same & (F.col(x) == F.col(f"_on_{x}"))
    out = items.join(near, same).drop("_w", "_of", *(f"_on_{x}" for x in on))
    return out.withColumn("rank", F.row_number().over(w(*keys).orderBy(*_first(["distance", name, *ties])))).where(F.col("rank") <= limit)


def early_stop(scored: DataFrame, keys: list[str], order: list[str], score: str, target: float) -> DataFrame:
    """The rows seen until the first score above target; of each key, best marks the answer: the first of the largest scores seen."""
    w = Window.partitionBy(*keys).orderBy(*order)
    passed = F.count_if(F.col(score) > target).over(w.rowsBetween(Window.unboundedPreceding, -1))
    seen = scored.withColumn("_p", passed).where("_p = 0").drop("_p")
    best = Window.partitionBy(*keys).orderBy(F.col(score).desc(), *order)
    return seen.withColumn("best", F.row_number().over(best) == 1)


def first_above(scored: DataFrame, keys: list[str], order: str, score: str, target: float) -> DataFrame:
    """The answer of early_stop alone, as one aggregation with partial sums: no window, no sort."""
    hit = F.min(F.when(F.col(score) > target, F.col(order)))
    best = F.max_by(F.col(order), F.struct(F.col(score), -F.col(order)))
    return scored.groupBy(*keys).agg(F.coalesce(hit, best).alias("pick"))


def top1(df: DataFrame, keys: list[str], score: str, order: str) -> DataFrame:
    """The row of the largest score; the first on ties."""
    w = Window.partitionBy(*keys).orderBy(F.col(score).desc(), order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def gate(df: DataFrame, score: str, least: float, columns: list[str]) -> DataFrame:
    """detected (score >= least), and the columns only where it holds."""
    ok = F.coalesce(F.col(score) >= least, F.lit(False))
    return df.withColumn("detected", ok).withColumns({x: F.when(ok, F.col(x)) for x in columns})


def take_until(df: DataFrame, keys: list[str], order: list[str], accepted: Column, n: int) -> DataFrame:
    """Rows in order until n are accepted, that one included."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("_n", F.coalesce(F.sum(accepted.cast("int")).over(w), F.lit(0))).where(F.col("_n") < n).drop("_n")


def grid(df: DataFrame, keys: list[str], order: list[str], columns: int) -> DataFrame:
    """Column and row of each tile."""
    i = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1
    return df.withColumn("_i", i).withColumns({"grid_col": (F.col("_i") % columns).cast("int"), "grid_row": F.floor(F.col("_i") / columns).cast("int")}).drop("_i")


def evenly_spaced(df: DataFrame, keys: list[str], order: list[str], k: int) -> DataFrame:
    """Rows at k ranks spread evenly from first to last, each once."""
    w = Window.partitionBy(*keys)
    out = df.withColumns({"_i": F.row_number().over(w.orderBy(*order)) - 1, "_n": F.count(F.lit(1)).over(w)})
    picks = F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda j: F.floor(j * (F.col("_n") - 1) / F.lit(max(1, k - 1))).cast("int")))
    return out.where(F.array_contains(picks, F.col("_i"))).drop("_i", "_n")


def rename_collisions(df: DataFrame, name: str, owner: str, order: list[str]) -> DataFrame:
    """target: the name, or owner_name where an earlier row has it in any case."""
    rn = F.row_number().over(Window.partitionBy(F.lower(name)).orderBy(*order))
    return df.withColumn("target", F.when(rn == 1, F.col(name)).otherwise(F.concat_ws("_", owner, name)))


def hash_sample(df: DataFrame, key: str, n: int, seed: str = "") -> DataFrame:
    """n rows in the order of a seeded hash of the key: a sample that needs no driver."""
    return df.withColumn("_h", F.md5(F.concat(F.lit(seed), F.col(key).cast("string")).cast("binary"))).orderBy("_h", key).limit(n).drop("_h")


def seeded_sample(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """The rows that random.Random(seed).sample draws from the sorted keys; all if there are no more than n. Keys come to the driver: for catalogues of files, not for data."""
    keys = [r[0] for r in df.select(key).distinct().orderBy(key).collect()]
    if len(keys) <= n:
        return df
    return df.where(F.col(key).isin(random.Random(seed).sample(keys, n)))


def in_order(df: DataFrame, order: list, n: int | None = None, only: list | None = None, key: str | None = None) -> DataFrame:
    """Selection by keys, then the first n in order."""
    if only is not None and key:
        df = df.where(c(key).isin(only))
    return df.orderBy(*order).limit(n) if n is not None else df


def subset(report: DataFrame, chosen: DataFrame, keys: list[str]) -> DataFrame:
    """The report's rows for the chosen keys."""
    return report.join(chosen.select(*keys).distinct(), keys, "left_semi")


def without_fields(df: DataFrame, entry: str, fields: list[str]) -> DataFrame:
    """A report's entries without the named fields, those that they have."""
    there = set(df.schema[entry].dataType.fieldNames())
    return df.withColumn(entry, F.col(entry).dropFields(*[x for x in fields if x in there])) if there & set(fields) else df


def flattened(bases: DataFrame, keys: list[str], diffs: str, name: str, suffixes: tuple[str, ...] = (".png", ".webp")) -> DataFrame:
    """Distinct pictures among all bases' diffs, alpha textures left out."""
    from ..functions.names import is_alpha_texture

    out = bases.select(*keys, F.explode(diffs).alias(name)).where(~is_alpha_texture(name))
    low = F.lower(name)
    fits = F.lit(False)
    for s in suffixes:
        fits = fits | low.endswith(s)
    return out.where(fits).distinct()
