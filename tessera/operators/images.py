"""Pixel work over tables: matching, composing, cropping, detecting, converting. A failing row gets an error, never the job.

Filters belong before these operators: Catalyst does not push predicates through them.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import packed, pixels

MATCH = (
    "character string, base string, avatar string, threshold double, box array<int>, box_norm array<double>, error string, "
    "offsets array<struct<avatar:string,offset:int,width:int,height:int,threshold:double,x:int,y:int>>"
)


def _decoded(row) -> np.ndarray:
    return pixels.from_row(int(row["height"]), int(row["width"]), int(row["channels"]), bytes(row["data"]))


def match_bases(bases: DataFrame, candidates: DataFrame, target: float = pixels.TARGET, coarse: int = pixels.COARSE, keep_offsets: bool = False) -> DataFrame:
    """The best avatar of every base, candidates tried by rank until one scores above target.

    bases: character, base and image columns (height, width, channels, data). candidates: character, base, avatar, rank
    and image columns. A base and its candidates are one task's group: the picture is prepared and transformed once, and
    the early stop saves the rest. Unreadable avatars are passed over; the first reason is kept if none is left.
    """

    def run(key, one: pd.DataFrame, many: pd.DataFrame) -> pd.DataFrame:
        if one.empty:
            return pd.DataFrame()
        first = one.iloc[0]
        out = {"character": first["character"], "base": first["base"], "avatar": None, "threshold": None, "box": None, "box_norm": None, "error": None, "offsets": None}
        try:
            image = _decoded(first)
            scene = pixels.Correlator(pixels.prepared_base(image))
        except Exception as e:  # noqa: BLE001
            return pd.DataFrame([out | {"error": f"base: {e}"}])
        reason, best, offsets = None, None, []
        for _, c in many.sort_values(["rank", "avatar"]).iterrows():
            try:
                search = pixels.SizeFit(scene, pixels.prepared_avatar(_decoded(c)))
                score, box = search.run(coarse=coarse, target=target)
            except Exception as e:  # noqa: BLE001
                reason = reason or f"{c['avatar']}: {e}"
                continue
            h, w = search.avatar.shape
            offsets += [(c["avatar"], o, w + o, h + o, s, x, y - pixels.TOP) for o, (s, x, y) in search.trace.items()] if keep_offsets else []
            if best is None or score > best[0]:
                best = (score, box, c["avatar"])
            if score > target:
                break
        if best is None:
            return pd.DataFrame([out | {"error": reason or "no candidate"}])
        score, box, name = best
        fx, fy = image.shape[1] / pixels.SIDE, image.shape[0] / pixels.SIDE
        whole = [int(np.rint(v * f)) for v, f in zip(box, (fx, fy, fx, fy), strict=True)]
        return pd.DataFrame([out | {"avatar": name, "threshold": score, "box": whole, "box_norm": [v / pixels.SIDE for v in box], "offsets": offsets or None}])

    keys = ["character", "base"]
    bases, candidates = bases.toDF(*bases.columns), candidates.toDF(*candidates.columns)  # both may stem from one table
    return bases.groupBy(*keys).cogroup(candidates.groupBy(*keys)).applyInPandas(run, MATCH)


def face_groups(df: DataFrame, column: str) -> DataFrame:
    """groups: the face groups in a JSON document."""
    import json

    kind = "array<struct<facePos:struct<x:int,y:int>,faceSize:struct<x:int,y:int>>>"

    @F.pandas_udf(kind)
    def found(texts: pd.Series) -> pd.Series:
        def one(text):
            try:
                return packed.face_groups(json.loads(text))
            except (TypeError, ValueError):
                return []

        return texts.map(one)

    return df.withColumn("groups", found(column))


def group_of_diff(df: DataFrame, groups: str = "groups", diff: str = "diff") -> DataFrame:
    """group: the one of the diff's $n (the first without it); null outside the list."""
    from ..functions.names import dollar_number, stem

    n = F.coalesce(dollar_number(stem(diff)), F.lit(1))
    return df.withColumn("group", F.when(n >= 1, F.try_element_at(groups, n)))


def _pictures(df: DataFrame, columns: list[str], schema: str, one: Callable) -> DataFrame:
    """Rows through one(row) -> values of schema's own columns, beside the given ones; errors in the column error."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    names = [x.strip().split(" ")[0] for x in schema.split(", ")]
    full = ", ".join([*(f"`{c}` {kinds[c]}" for c in columns), schema, "error string"])

    def run(frames):
        for frame in frames:
            rows = []
            for row in frame.to_dict("records"):
                values = dict.fromkeys(names)
                error = None
                try:
                    values |= dict(zip(names, one(row), strict=True))
                except Exception as e:  # noqa: BLE001
                    error = f"{type(e).__name__}: {e}"
                rows.append([row[c] for c in columns] + [values[n] for n in names] + [error])
            yield pd.DataFrame(rows, columns=[*columns, *names, "error"])

    return df.mapInPandas(run, full)


def crops(df: DataFrame, keys: list[str], size: int = 180) -> DataFrame:
    """png of every row's box; df: keys, height, width, channels, data, box."""
    return _pictures(df, keys, "png binary", lambda r: (pixels.png(pixels.crop(_decoded(r), list(r["box"]), size)),))


def composed(df: DataFrame, keys: list[str]) -> DataFrame:
    """iou (opaque parts of diff and base in the base's box) and data of every diff on its base.

    df: keys, group, box and structs base, diff, alpha (may be null) of image columns.
    """

    def one(r):
        base, diff = _decoded(r["base"]), _decoded(r["diff"])
        alpha = None if r.get("alpha") is None else _decoded(r["alpha"])
        group = r["group"] if r["group"] is None or isinstance(r["group"], dict) else r["group"].asDict(True)
        whole = pixels.compose(base, diff, group, alpha)
        box = None if r["box"] is None else list(r["box"])
        return pixels.mask_iou(whole, base, box), whole.shape[0], whole.shape[1], whole.tobytes()

    return _pictures(df, keys, "iou double, height int, width int, data binary", one)


def detect(df: DataFrame, keys: list[str], detector: Callable[[np.ndarray], list[dict]], least: float = 0.3, scale: float = 1.1) -> DataFrame:
    """detected, box (grown, clipped) and confidence of the surest detection, the first on ties.

    detector: picture -> [{"bbox": [x0, y0, x1, y1], "confidence": c}]; it is sent to the tasks.
    """

    def one(r):
        image = _decoded(r)
        found = detector(image)
        best = max(found, key=lambda f: f["confidence"], default=None)
        if best is None or best["confidence"] < least:
            return False, None, None
        x1, y1, x2, y2 = best["bbox"]
        dx, dy = (x2 - x1) * (scale - 1) / 2, (y2 - y1) * (scale - 1) / 2
        h, w = image.shape[:2]
        clip = lambda v, most: int(np.rint(min(max(v, 0), most)))
        return True, [clip(x1 - dx, w), clip(y1 - dy, h), clip(x2 + dx, w), clip(y2 + dy, h)], float(best["confidence"])

    return _pictures(df, keys, "detected boolean, box array<int>, confidence double", one)


def contact_sheets(tiles: DataFrame, key: str = "character", order: str = "ord", columns: int = 3) -> DataFrame:
    """png of each character's tiles in order; rows without data are missing tiles."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(order)
        images = [None if r["data"] is None else _decoded(r) for r in frame.to_dict("records")]
        return pd.DataFrame({key: [frame[key].iloc[0]], "png": [pixels.png(pixels.sheet(images, columns))], "tiles": [len(images)], "missing": [sum(i is None for i in images)]})

    return tiles.groupBy(key).applyInPandas(run, f"{key} string, png binary, tiles long, missing long")


def converted(images: DataFrame, existing: DataFrame, keys: list[str], encoder: Callable[[np.ndarray], bytes], force: bool = False) -> DataFrame:
    """Pictures encoded anew by an injected encoder; those that exist are left out unless forced."""
    rest = images if force else images.join(existing.select(*keys).distinct(), keys, "left_anti")
    return _pictures(rest, keys, "encoded binary", lambda r: (encoder(_decoded(r)),))


def inflated(df: DataFrame, column: str, size: str) -> DataFrame:
    """content of swapped LZ4 blocks; null where a block is broken."""

    @F.arrow_udf("binary")
    def run(blocks: pa.Array, sizes: pa.Array) -> pa.Array:
        out = []
        for b, n in zip(blocks.to_pylist(), sizes.to_pylist(), strict=True):
            try:
                out.append(None if b is None or n is None else packed.inflate(b, n))
            except ValueError:
                out.append(None)
        return pa.array(out, pa.binary())

    return df.withColumn("content", run(column, size))


def written(df: DataFrame, keys: list[str], path: str, data: str = "png") -> DataFrame:
    """Write every picture under its relative path in a shared folder, by rename, so that a retried task changes nothing; returns keys, status."""
    import os
    import tempfile

    def one(r):
        target = os.path.join(path, r["rel"])
        os.makedirs(os.path.dirname(target), exist_ok=True)
        fd, temp = tempfile.mkstemp(dir=os.path.dirname(target), suffix=".tmp")
        with os.fdopen(fd, "wb") as f:
            f.write(r[data])
        os.replace(temp, target)
        return ("ok",)

    return _pictures(df, keys, "status string", one)


def match_views(df: DataFrame, keys: list[str]) -> DataFrame:
    """png of every matched base with its box, score and avatar; rows without a match have none.

    df: keys, height, width, channels, data, box_norm, threshold and avatar, a struct of image columns or null.
    """

    def one(r):
        if r["box_norm"] is None or r["threshold"] is None:
            return (None,)
        avatar = None if r["avatar"] is None else _decoded(r["avatar"].asDict() if hasattr(r["avatar"], "asDict") else r["avatar"])
        return (pixels.png(pixels.match_view(_decoded(r), avatar, list(r["box_norm"]), float(r["threshold"]))),)

    return _pictures(df, keys, "png binary", one)
