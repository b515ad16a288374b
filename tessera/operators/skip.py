"""Skip lists: whole characters, single sprites, and what depends on them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import skip_key, sprite_key, stem


def split_keys(skips: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(character_key, reason) and (character_key, sprite_key, reason) of keys "character" or "character/sprite"."""
    parts = F.split("key", "/", 2)
    chars = skips.where(~F.col("key").contains("/")).select(skip_key("key").alias("character_key"), "reason")
    sprites = skips.where(F.col("key").contains("/")).select(skip_key(parts[0]).alias("character_key"), sprite_key(parts[1]).alias("sprite_key"), "reason")
    return chars, sprites


def filtered(classified: DataFrame, skips: DataFrame) -> DataFrame:
    """classified (character, base, diff; base null: none, diff null: the base itself) without what is skipped.

    A skipped base takes its diffs along; a character whose bases are all skipped goes, one that never had any stays.
    """
    chars, sprites = split_keys(skips)
    keyed = classified.withColumns({"_c": skip_key("character"), "_b": sprite_key("base"), "_d": sprite_key("diff")})
    keyed = keyed.join(chars.select(F.col("character_key").alias("_c")).distinct(), "_c", "left_anti")
    gone = sprites.select(F.col("character_key").alias("_c"), F.col("sprite_key").alias("_s")).distinct()
    out = keyed.join(gone.withColumnRenamed("_s", "_b"), ["_c", "_b"], "left_anti")
    return out.join(gone.withColumnRenamed("_s", "_d"), ["_c", "_d"], "left_anti").select(*classified.columns)


def expanded(classified: DataFrame, skips: DataFrame) -> DataFrame:
    """(character, sprite) that the skips name: a base with its diffs, anything else by its own stem."""
    parts = F.split("key", "/", 2)
    asked = skips.where(F.col("key").contains("/")).select(F.trim(parts[0]).alias("character"), stem(F.trim(parts[1])).alias("sprite"))
    asked = asked.withColumns({"_c": skip_key("character"), "_s": sprite_key("sprite")})
    known = classified.where("base is not null").select(skip_key("character").alias("_c"), sprite_key("base").alias("_s"), stem("base").alias("own"), stem("diff").alias("dep"))
    met = asked.join(known, ["_c", "_s"], "left")
    base = met.select("character", F.coalesce("own", "sprite").alias("sprite"))
    return base.unionByName(met.where("dep is not null").select("character", F.col("dep").alias("sprite"))).distinct()
