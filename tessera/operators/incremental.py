"""State between batch runs: what is left to do, what can be replayed, what must be matched again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def todo(listing: DataFrame, recorded: DataFrame, keys: list[str], done: Column) -> DataFrame:
    """Listed rows that the record doesn't settle; done compares the listing's columns with those of ``seen``."""
    seen = recorded.select(*keys, F.struct(*recorded.columns).alias("seen"))
    return listing.join(seen, keys, "left").where(~F.coalesce(done & F.col("seen").isNotNull(), F.lit(False))).drop("seen")


def fetch_todo(listing: DataFrame, manifest: DataFrame, existing: DataFrame) -> DataFrame:
    """Files to fetch: not recorded with equal size, or gone, or of another digest where the source knows one."""
    there = existing.select("rel", F.lit(True).alias("_exists"))
    same = (F.col("size") == F.col("seen.size")) & F.col("_exists") & (F.col("sha256").isNull() | (F.col("sha256") == F.col("seen.sha256")))
    return todo(listing.join(there, "rel", "left"), manifest, ["rel"], same).drop("_exists")


def unpack_todo(files: DataFrame, done: DataFrame, metas: DataFrame) -> DataFrame:
    """Bundles to unpack: of another digest than unpacked before, or whose metadata are gone."""
    there = metas.select("rel", F.lit(True).alias("_meta"))
    same = (F.col("sha256") == F.col("seen.source_sha256")) & F.col("_meta")
    return todo(files.join(there, "rel", "left"), done, ["rel"], same).drop("_meta")


def covered(selected: DataFrame, previous: DataFrame, keys: list[str]) -> DataFrame:
    return selected.join(previous.select(*keys).distinct(), keys, "left_semi")


def missing(selected: DataFrame, previous: DataFrame, keys: list[str]) -> DataFrame:
    return selected.join(previous.select(*keys).distinct(), keys, "left_anti")


def rematch(classified: DataFrame, old: DataFrame, key: str = "character", threshold: float = 0.9) -> DataFrame:
    """key and status (new, rematch, kept).

    classified: key, candidates. old: key, candidates, bases array<struct<avatar, threshold, error>>. A known character is
    matched again iff its ordered candidate list changed and it has no base or some base failed, lost its avatar from
    the list or scored below the threshold.
    """
    a = classified.select(key, F.col("candidates").alias("_now"))
    b = old.select(key, F.col("candidates").alias("_then"), "bases", F.lit(True).alias("_known"))
    weak = F.exists(
        "bases",
        lambda x: x["error"].isNotNull() | x["threshold"].isNull() | (x["threshold"] < threshold) | ~F.coalesce(F.array_contains(F.col("_now"), x["avatar"]), F.lit(False)),
    )
    again = ~F.col("_now").eqNullSafe(F.col("_then")) & (F.coalesce(F.size("bases"), F.lit(0)).isin(0, -1) | F.coalesce(weak, F.lit(False)))
    status = F.when(F.col("_known").isNull(), "new").when(again, "rematch").otherwise("kept")
    return a.join(b, key, "left").select(key, status.alias("status"))


def cached(items: DataFrame, cache: DataFrame, keys: list[str], fingerprints: list[str], values: list[str]) -> DataFrame:
    """items with the cache's values where key and all fingerprints agree, and hit."""
    side = cache.select(*keys, *fingerprints, F.struct(*values).alias("_v"))
    out = items.join(side, [*keys, *fingerprints], "left")
    return out.select(*items.columns, F.col("_v").isNotNull().alias("hit"), *[F.col("_v")[v].alias(v) for v in values])


def fingerprint(*columns) -> Column:
    """A digest of columns that tells null from empty."""
    return F.sha2(F.to_json(F.struct(*[F.coalesce(F.to_json(F.struct(F.col(x).alias("v"))), F.lit("null")).alias(f"c{i}") for i, x in enumerate(columns)])), 256)


def payload_hash(df: DataFrame, by: list[str], ignoring: list[str], order: list[str]) -> DataFrame:
    """A digest per group of all rows and columns but the ignored ones, in a fixed order; equal digests need no rewrite."""
    kept = [x for x in df.columns if x not in (*by, *ignoring)]
    lead = [*order, *[x for x in kept if x not in order]]
    rows = F.array_sort(F.collect_list(F.struct(*lead)))
    return df.groupBy(*by).agg(F.sha2(F.to_json(rows), 256).alias("digest"))
