"""Pipelines as lists of steps: each takes the tables so far and adds its own, stopping at the first failure."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import matchable, numeric_id
from ..operators import classify, dedup, fit, images, rank, skip, stats, tiers
from ..operators.incremental import missing

Tables = dict[str, DataFrame]
Step = Callable[[Tables], Tables]


@dataclass
class Outcome:
    """What a run did: the tables, and for each step its state and seconds."""

    tables: Tables
    steps: list[dict] = field(default_factory=list)

    @property
    def ok(self) -> bool:
        return all(s["status"] == "ok" for s in self.steps)


def run(steps: list[tuple[str, Step]], tables: Tables, first: str | None = None, until: str | None = None) -> Outcome:
    """The steps from first to until, in order; a failure ends the run and is reported, not raised."""
    names = [n for n, _ in steps]
    a, b = (names.index(first) if first else 0), (names.index(until) if until else len(names) - 1)
    if a > b:
        raise ValueError(f"{first} comes after {until}")
    out = Outcome(dict(tables))
    for name, step in steps[a : b + 1]:
        began = time.time()
        try:
            out.tables |= step(out.tables)
            out.steps.append({"step": name, "status": "ok", "seconds": time.time() - began})
        except Exception as e:  # noqa: BLE001  the report tells
            out.steps.append({"step": name, "status": "failed", "seconds": time.time() - began, "error": f"{type(e).__name__}: {e}"})
            break
    return out


def classify_step(tables: Tables) -> Tables:
    done = classify.classify(tables["sprites"])
    if "skips" in tables:
        done = skip.filtered(done.select("character", "base", "diff", "status", "unassigned"), tables["skips"])
    return {"classified": done, "classify_stats": classify.summary(done)}


def match_step(tables: Tables, target: float = 0.85) -> Tables:
    """The best avatar of every base. tables: classified, sprite_images (character, file, image), avatars (avatar, image)."""
    picture = ["height", "width", "channels", "data"]
    heads = tables["classified"].where("base is not null and diff is null").select("character", "base").where(matchable("character"))
    bases = heads.join(tables["sprite_images"].withColumnRenamed("file", "base"), ["character", "base"])
    pool = tables["avatars"].withColumn("seq", numeric_id(F.concat("avatar", F.lit("_"))))
    pairs = heads.withColumn("seq", numeric_id(F.concat("character", F.lit("_")))).join(pool.select("seq", "avatar"), "seq")
    ranked = rank.rank_candidates(pairs, ["character", "base"], "character", "avatar").select("character", "base", "avatar", "rank")
    cands = ranked.join(tables["avatars"].select("avatar", *picture), "avatar").select("character", "base", "avatar", "rank", *picture)
    return {"match": images.match_bases(bases.select("character", "base", *picture), cands, target), "candidates": ranked}


def resolve_step(tables: Tables, least: float = 0.9) -> Tables:
    """Boxes of bases by tier, crops, and which bases repeat another's avatar. tables: classified, match, manual, derived, sprite_images."""
    heads = tables["classified"].where("base is not null and diff is null").select("character", F.col("base").alias("item"))
    match = tables["match"].where("error is null").select("character", F.col("base").alias("item"), "threshold", "box")
    found = tiers.resolve(heads, tables["manual"], match, tables["derived"], ["character", "item"])
    pictures = tables["sprite_images"].withColumnRenamed("file", "item")
    boxed = found.where("box is not null").join(pictures, ["character", "item"])
    crops = images.crops(boxed, ["character", "item", "method", "confidence"])
    return {"resolved": found, "crops": crops}


def dedup_step(tables: Tables, least: float = 0.9) -> Tables:
    """status of each crop that has a pixel vector: tables vectors (character, item, method, confidence, pixels)."""
    v = dedup.ordered(tables["vectors"], ["character"], [tiers.tier_rank("method").desc(), F.col("confidence").desc(), F.col("item")])
    return {"kept": dedup.greedy(v, ["character"], "rank", "pixels", least, ["item"])}


def derive_step(tables: Tables, min_conf: float = fit.MIN_CONFIDENCE) -> Tables:
    """The model of boxes from faces and heads, and how well it fits. tables: fit_input (see fit.fit_rows)."""
    rows = fit.targets(fit.features(fit.fit_rows(tables["fit_input"], min_conf)))
    model = fit.ols(rows)
    scored = fit.with_iou(fit.predict(rows, model))
    spark = rows.sparkSession
    kind = "min_conf double, fit_samples long, feature_order array<string>, coef array<array<double>>, r2 map<string,double>"
    row = spark.createDataFrame([(min_conf, model["n"], model["feature_order"], model["coef"], model["r2"])], kind)
    return {"model": row, "fit_rows": scored, "fit_stats": stats.fit_quality(scored, [], "iou")}


def detect_step(tables: Tables, detector, threshold: float = 0.95) -> Tables:
    """Detections of sure matches that no earlier report has. tables: match, sprite_images, detections (earlier; may be absent)."""
    sure = tables["match"].where(F.col("threshold") > threshold).select("character", "base")
    if "detections" in tables:
        sure = missing(sure, tables["detections"], ["character", "base"])
    todo = sure.join(tables["sprite_images"].withColumnRenamed("file", "base"), ["character", "base"])
    return {"new_detections": images.detect(todo, ["character", "base"], detector)}


RUN = [("classify", classify_step), ("match", match_step), ("resolve", resolve_step)]
BUILD_MODEL = [("derive", derive_step)]


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def progress(df: DataFrame, order: list[str], label: str) -> DataFrame:
    """index, total and label of every item: what a progress display would tell."""
    total = df.agg(F.count(F.lit(1)).alias("total"))
    at = F.row_number().over(Window.orderBy(*order))
    return df.select(F.col(label).alias("label"), at.alias("index")).crossJoin(F.broadcast(total))  # one row
