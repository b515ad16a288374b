"""Boxes as columns: [x1, y1, x2, y2] in pixels; y may be negative. All are built-in column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .names import c


def half_even(x) -> Column:
    return F.rint(c(x)).cast("int")


def iou(a: list, b: list) -> Column:
    """Intersection over union of two boxes given as four columns each; 0 when the union has no area."""
    a, b = [c(x) for x in a], [c(x) for x in b]
    zero = F.lit(0.0)
    w = F.greatest(zero, F.least(a[2], b[2]) - F.greatest(a[0], b[0]))
    h = F.greatest(zero, F.least(a[3], b[3]) - F.greatest(a[1], b[1]))
    area = lambda k: (k[2] - k[0]) * (k[3] - k[1])
    union = area(a) + area(b) - w * h
    return F.when(union > 0, w * h / union).otherwise(zero)


def valid_box(box) -> Column:
    """Four numbers, none missing."""
    return (F.size(c(box)) == 4) & F.forall(c(box), lambda x: x.isNotNull())


def scale_box(box: list, factor: float = 1.1) -> list[Column]:
    """The box grown about its centre."""
    x1, y1, x2, y2 = (c(v) for v in box)
    dx, dy = (x2 - x1) * (factor - 1) / 2, (y2 - y1) * (factor - 1) / 2
    return [x1 - dx, y1 - dy, x2 + dx, y2 + dy]


def clip_box(box: list, width, height) -> list[Column]:
    lo = lambda v, most: F.least(F.greatest(c(v), F.lit(0)), c(most))
    return [lo(box[0], width), lo(box[1], height), lo(box[2], width), lo(box[3], height)]


def rect(box: list) -> Column:
    """{x, y, w, h} of a box with inclusive corners."""
    x1, y1, x2, y2 = (c(v) for v in box)
    return F.struct(x1.alias("x"), y1.alias("y"), (x2 - x1 + 1).alias("w"), (y2 - y1 + 1).alias("h"))


def corners(r) -> list[Column]:
    """The inclusive corners of {x, y, w, h}."""
    r = c(r)
    return [r["x"], r["y"], r["x"] + r["w"] - 1, r["y"] + r["h"] - 1]


def normalised(box: list, width, height) -> list[Column]:
    return [c(box[0]) / c(width), c(box[1]) / c(height), c(box[2]) / c(width), c(box[3]) / c(height)]


def rescale(box: list, width, height, side: int = 1024) -> list[Column]:
    """A box found on a square of the given side, in pixels of the original."""
    fx, fy = c(width) / F.lit(side), c(height) / F.lit(side)
    return [half_even(c(box[0]) * fx), half_even(c(box[1]) * fy), half_even(c(box[2]) * fx), half_even(c(box[3]) * fy)]


def centre(r) -> tuple[Column, Column]:
    r = c(r)
    return r["x"] + r["w"] / 2, r["y"] + r["h"] / 2


def centre_error(ax, ay, bx, by) -> Column:
    return F.hypot(c(ax) - c(bx), c(ay) - c(by))


def linear(features: list, weights: list[float]) -> Column:
    """The weighted sum of the features; a weight more than features is the intercept."""
    out = F.lit(float(weights[len(features)])) if len(weights) > len(features) else F.lit(0.0)
    for x, w in zip(features, weights, strict=False):
        out = out + c(x) * F.lit(float(w))
    return out


def square_box(cx, cy, side) -> list[Column]:
    """The square of the given centre and side, in whole pixels."""
    half = c(side) / 2
    return [half_even(c(cx) - half), half_even(c(cy) - half), half_even(c(cx) + half), half_even(c(cy) + half)]
