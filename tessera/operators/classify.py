"""Bases and diffs from the names of a character's pictures, as grouped expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import common_prefix, dollar_number, first_in_sequence, has_id_prefix, without_png


def classify(sprites: DataFrame) -> DataFrame:
    """character, status (ok, empty), base, diff (null: the base itself), unassigned (instead of both).

    sprites: character, file (null: an empty directory). A lone file is its directory's base. With two or more
    id-like names, the root is their longest common prefix without a trailing separator; bases are the bare
    root and whatever goes on with $, else root_1, root#1 and whatever goes on with $, else the file named as the directory. A single
    id-like name is the base if its number is the first. Where none of this gives a base, the least file is it.
    With one base all other names are its diffs; with several, a diff belongs to the last base of its own $n,
    and a file without such a base is unassigned. All in one shuffle by character.
    """
    w = Window.partitionBy("character")
    some = lambda cond: F.bool_or(F.coalesce(cond, F.lit(False))).over(w)
    f = sprites.where("file is not null").withColumn("name", without_png("file"))
    f = f.withColumns({"like": has_id_prefix("name"), "ln": F.lower("name")})
    f = f.withColumns(
        {
            "files": F.count(F.lit(1)).over(w),
            "least": F.min("file").over(w),
            "ids": F.size(F.collect_set(F.when(F.col("like"), F.col("name"))).over(w)),
            "lo": F.min(F.when(F.col("like"), F.col("name"))).over(w),
            "hi": F.max(F.when(F.col("like"), F.col("name"))).over(w),
        }
    )
    f = f.withColumn("root", F.lower(F.regexp_replace(common_prefix("lo", "hi"), r"[_#$]$", "")))
    exact = lambda text: F.max(F.when(F.col("ln") == text, F.col("name"))).over(w)
    f = f.withColumns(
        {
            "bare": F.col("ln") == F.col("root"),
            "dollar": F.startswith("ln", F.concat("root", F.lit("$"))),
            "under": exact(F.concat("root", F.lit("_1"))),
            "hash": exact(F.concat("root", F.lit("#1"))),
            "own": exact(F.lower("character")),
        }
    )
    numbered = F.coalesce(F.col("name") == F.col("under"), F.lit(False)) | F.coalesce(F.col("name") == F.col("hash"), F.lit(False)) | F.col("dollar")
    rule = F.when(some(F.col("bare")), F.col("bare") | F.col("dollar")).when(some(numbered), numbered).otherwise(F.col("name") == F.col("own"))
    f = f.withColumn("named", F.coalesce(F.when(F.col("ids") > 1, rule).when(F.col("ids") == 1, F.col("like") & first_in_sequence("name")), F.lit(False)))
    f = f.withColumns({"names": F.size(F.collect_set(F.when(F.col("named"), F.col("name"))).over(w)), "lead": F.min(F.when(F.col("named"), F.col("file"))).over(w)})
    is_base = F.when(F.col("files") == 1, True).when(F.col("names") == 0, F.col("file") == F.col("least")).when(F.col("names") == 1, F.col("file") == F.col("lead")).otherwise(F.col("named"))
    f = f.withColumns({"is_base": is_base, "n": dollar_number("name")})
    single = F.when(F.col("names") == 0, F.col("least")).when(F.col("names") == 1, F.col("lead"))
    twin = F.when(F.col("n").isNotNull(), F.max(F.when(F.col("is_base"), F.col("file"))).over(Window.partitionBy("character", "n")))
    f = f.withColumn("owner", F.when(F.col("is_base"), F.col("file")).otherwise(F.coalesce(single, twin)))
    # a file whose name only repeats the single base's is neither base nor diff
    f = f.where(~((F.col("names") == 1) & F.col("named") & ~F.col("is_base")))
    text = F.lit(None).cast("string")
    found = f.select(
        "character",
        F.lit("ok").alias("status"),
        F.col("owner").alias("base"),
        F.when(~F.col("is_base") & F.col("owner").isNotNull(), F.col("file")).alias("diff"),
        F.when(F.col("owner").isNull(), F.col("file")).alias("unassigned"),
    )
    empty = sprites.groupBy("character").agg(F.count("file").alias("n")).where("n = 0")
    return found.unionByName(empty.select("character", F.lit("empty").alias("status"), text.alias("base"), text.alias("diff"), text.alias("unassigned")))


def summary(classified: DataFrame) -> DataFrame:
    """total, ok, empty, no_base (never set), base_files, diff_files."""
    per = classified.groupBy("character").agg(F.max("status").alias("status"), F.count_if(F.expr("base is not null and diff is null")).alias("b"), F.count("diff").alias("d"))
    return per.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("status") == "ok").alias("ok"), F.count_if(F.col("status") == "empty").alias("empty"), F.lit(0).cast("long").alias("no_base"),
        F.coalesce(F.sum("b"), F.lit(0)).alias("base_files"), F.coalesce(F.sum("d"), F.lit(0)).alias("diff_files"),
    )
