"""Least squares over any number of rows from one aggregation, and linear prediction of boxes."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import centre, iou, linear, square_box

# The features in order, and the least confidence of rows to fit on (strict).
FEATURES = ("fx", "fy", "fw", "fh", "hx", "hy", "hw", "hh")
TARGETS = ("cx", "cy", "s")
MIN_CONFIDENCE = 0.8


def fit_rows(df: DataFrame, min_conf: float = MIN_CONFIDENCE) -> DataFrame:
    """Rows with face and head both found and both surer than min_conf."""
    return df.where(F.col("detected") & F.col("head_detected") & (F.col("confidence") > min_conf) & (F.col("head_confidence") > min_conf))


def features(df: DataFrame, face: str = "face_pos", head: str = "head_pos") -> DataFrame:
    """Centres and sizes of face and head as FEATURES."""
    (fx, fy), (hx, hy) = centre(face), centre(head)
    f, h = F.col(face), F.col(head)
    values = (fx, fy, f["w"], f["h"], hx, hy, h["w"], h["h"])
    return df.withColumns({k: v.cast("double") for k, v in zip(FEATURES, values, strict=True)})


def targets(df: DataFrame, box: str = "box") -> DataFrame:
    """Centre and side of the matched box as TARGETS."""
    b = F.col(box)
    return df.withColumns({"cx": (b[0] + b[2]) / 2, "cy": (b[1] + b[3]) / 2, "s": ((b[2] - b[0]) + (b[3] - b[1])) / 2})


def gram(df: DataFrame, xs: list[str], ys: list[str]) -> DataFrame:
    """One row: n and every sum of products of features, targets and 1. One shuffle of one row a task."""
    cols = [*xs, *ys]
    sums = [F.sum(F.col(a).cast("double") * F.col(b).cast("double")).alias(f"{a}_{b}") for i, a in enumerate(cols) for b in cols[i:]]
    return df.agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.col(c).cast("double")).alias(f"{c}_1") for c in cols], *sums)


def ols(df: DataFrame, xs: list[str] = list(FEATURES), ys: list[str] = list(TARGETS)) -> dict:
    """coef (features + 1 rows, a column for each target), r2 and n: the minimum-norm solution, from centred sums.

    Fewer than two rows are an error; a target without variance has r2 0.
    """
    df = df.dropna(subset=[*xs, *ys])
    means = df.agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(c) for c in (*xs, *ys)]).first()
    if means["n"] < 2:
        raise ValueError("a fit needs two rows at least")
    mean = {c: float(means[c]) for c in (*xs, *ys)}
    # centred once more: squares of large values would lose the small differences
    centred = df.select(*[(F.col(c).cast("double") - F.lit(mean[c])).alias(c) for c in (*xs, *ys)])
    row = gram(centred, xs, ys).first()
    get = lambda a, b: row[f"{a}_{b}"] if f"{a}_{b}" in row else row[f"{b}_{a}"]
    mx, my = np.array([mean[x] for x in xs]), np.array([mean[y] for y in ys])
    xx = np.array([[get(a, b) for b in xs] for a in xs])
    xy = np.array([[get(a, b) for b in ys] for a in xs])
    n = row["n"]
    # the intercept's column is one of the unknowns whose norm is least, so the full system is solved
    big = np.zeros((len(xs) + 1, len(xs) + 1))
    big[:-1, :-1], big[:-1, -1], big[-1, :-1], big[-1, -1] = xx + n * np.outer(mx, mx), n * mx, n * mx, n
    right = np.vstack([xy + n * np.outer(mx, my), n * my])
    if np.linalg.matrix_rank(xx, hermitian=True) == len(xs):
        w = np.linalg.solve(xx, xy)
        coef = np.vstack([w, my - mx @ w])
    else:
        coef = np.linalg.pinv(big, rcond=1e-11, hermitian=True) @ right
    w = coef[:-1]
    total = np.array([get(y, y) for y in ys])
    left = total - 2 * (w * xy).sum(0) + np.einsum("at,ab,bt->t", w, xx, w)
    r2 = np.where(total > 0, 1 - left / np.where(total > 0, total, 1), 0.0)
    return {"coef": coef.tolist(), "feature_order": list(xs), "r2": dict(zip(ys, r2.tolist(), strict=True)), "n": int(n)}


def check_model(model: dict, rows: int = 9, columns: int = 3) -> dict:
    """The model, if its coefficients have the right shape; else ValueError."""
    coef = model.get("coef")
    if not isinstance(coef, list) or len(coef) != rows or any(not isinstance(r, list) or len(r) != columns for r in coef):
        raise ValueError(f"coef must have {rows} rows of {columns}")
    return model


def predict(df: DataFrame, model: dict) -> DataFrame:
    """px1..py2: the square predicted from the model's features, in its own feature order."""
    xs = model.get("feature_order") or list(FEATURES)
    cx, cy, s = (linear(list(xs), [row[k] for row in model["coef"]]) for k in range(3))
    return df.withColumns(dict(zip(("px1", "py1", "px2", "py2"), square_box(cx, cy, s), strict=True)))


def with_iou(df: DataFrame, box: str = "box") -> DataFrame:
    b = F.col(box)
    return df.withColumn("iou", iou([b[0], b[1], b[2], b[3]], ["px1", "py1", "px2", "py2"]))


def ols_single(df: DataFrame, by: list[str], x: str, y: str) -> DataFrame:
    """slope, intercept and r2 of y on x per group, by built-in aggregates."""
    fitted = lambda f, name: f(F.col(y), F.col(x)).alias(name)
    return df.groupBy(*by).agg(fitted(F.regr_slope, "slope"), fitted(F.regr_intercept, "intercept"), fitted(F.regr_r2, "r2"))
