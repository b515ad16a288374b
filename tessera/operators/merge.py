"""Merging tables of the same thing: priority of sources, upserts, zero-filled unions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_wins(sources: list[tuple[str, DataFrame]], keys: list[str]) -> DataFrame:
    """The union of the sources; of each key the earliest source's row, with the owner as source.

    A struct minimum per key is combined before the shuffle, so no window holds a key's rows.
    """
    tagged = [df.withColumns({"_rank": F.lit(i), "source": F.lit(name)}) for i, (name, df) in enumerate(sources)]
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    rest = [x for x in every.columns if x not in (*keys, "_rank")]
    return every.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.col("_rank")).alias("_row")).select(*keys, "_row.*")


def ranked_first(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key in a total order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def upsert(selected: DataFrame, fresh: DataFrame, previous: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """For every selected key the fresh row, else the previous one; keys with neither are left out."""
    pack = lambda df, name: df.select(*keys, F.struct(*values).alias(name))
    out = selected.join(pack(fresh, "_f"), keys, "left").join(pack(previous, "_p"), keys, "left")
    row = F.coalesce("_f", "_p")
    out = out.withColumn("_row", row).withColumn("origin", F.when(F.col("_f").isNotNull(), "fresh").otherwise("previous")).where("_row is not null")
    return out.select(*selected.columns, "origin", *[F.col("_row")[v].alias(v) for v in values])


def zero_filled(left: DataFrame, right: DataFrame, keys: list[str], counts: list[str]) -> DataFrame:
    """All keys of either side; missing counts are 0."""
    out = left.join(right, keys, "full")
    return out.select(*[x for x in out.columns if x not in counts], *[F.coalesce(x, F.lit(0)).alias(x) for x in counts])


def owners(listing: DataFrame, requests: DataFrame, key: str = "rel") -> DataFrame:
    """Requested items by the source that owns them."""
    found = requests.join(listing.select(key, "source"), key)
    return found.groupBy("source").agg(F.array_sort(F.collect_set(key)).alias("items"))


def unmatched_pool(names: DataFrame, scored: DataFrame, keys: list[str], score: str, least: float) -> DataFrame:
    """Names without any scored row, and those whose best score stays below least."""
    weak = scored.groupBy(*keys).agg(F.max(score).alias("_best")).where(F.col("_best") < least)
    return names.join(scored.select(*keys).distinct(), keys, "left_anti").unionByName(names.join(weak, keys, "left_semi"))


def with_fallback(sprites: DataFrame, merged: DataFrame, keys: list[str], image: str) -> DataFrame:
    """sprites with the merged image where there is one, else their own."""
    side = merged.select(*keys, F.col(image).alias("_merged"))
    return sprites.join(side, keys, "left").withColumn(image, F.coalesce("_merged", image)).drop("_merged")


def retry_failed(requested: DataFrame, delivered: DataFrame, keys: list[str]) -> DataFrame:
    """What a batch did not deliver: to be asked for one by one."""
    return requested.join(delivered.select(*keys).distinct(), keys, "left_anti")


def chosen_categories(listed: DataFrame, wanted: list[str], category: str = "category") -> DataFrame:
    """Rows of the wanted categories with ord, their place in the request; an unknown category is an error."""
    known = {r[0] for r in listed.select(category).distinct().collect()}  # a handful of names
    if unknown := [x for x in wanted if x not in known]:
        raise ValueError(f"unknown categories: {', '.join(unknown)}")
    order = F.create_map(*[F.lit(v) for i, x in enumerate(dict.fromkeys(wanted)) for v in (x, i)]) if wanted else F.create_map()
    return listed.where(F.col(category).isin(wanted)).withColumn("ord", order[F.col(category)])
