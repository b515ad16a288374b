"""Pixel kernels against answers known by construction, and their operators over tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions import packed, pixels
from tessera.operators import images
from tessera.sources import tables

IMAGE = "height int, width int, channels int, data binary"


def avatar(seed=1, side=180):
    """A transparent square with a filled ellipse, a white disc and spots."""
    rng = np.random.default_rng(seed)
    y, x = np.mgrid[:side, :side] / side - 0.5
    out = np.zeros((side, side, 4), np.uint8)
    out[(x / 0.42) ** 2 + (y / 0.48) ** 2 < 1] = [*rng.integers(60, 200, 3), 255]
    out[x**2 + (y + 0.05) ** 2 < 0.02] = 255
    for _ in range(12):
        a, b = rng.uniform(-0.3, 0.3, 2)
        out[(x - a) ** 2 + (y - b) ** 2 < 0.003] = [*rng.integers(0, 255, 3), 255]
    return out


def scene(top=200, left=300, seed=1, scale=1.0):
    out = np.zeros((1024, 1024, 4), np.uint8)
    out[:, :, 3] = 255
    side = int(180 * scale)
    a = pixels.resize(avatar(seed), side, side)
    t, b = max(0, top), min(1024, top + side)
    part = a[t - top : b - top]
    m = part[:, :, 3:] > 0
    out[t:b, left : left + side] = np.where(m, part, out[t:b, left : left + side])
    return out


def search(base, template):
    return pixels.SizeFit(pixels.Correlator(pixels.prepared_base(base)), pixels.prepared_avatar(template))


def box_iou(a, b):
    w, h = max(0, min(a[2], b[2]) - max(a[0], b[0])), max(0, min(a[3], b[3]) - max(a[1], b[1]))
    area = lambda k: (k[2] - k[0]) * (k[3] - k[1])
    return w * h / (area(a) + area(b) - w * h)


def test_search_finds_a_paste():
    s = search(scene(), avatar())
    score, box = s.run()
    assert score > 0.9 and box == (300, 200, 480, 380) and max(v[0] for v in s.trace.values()) <= 1 + 1e-9


def test_search_above_the_edge_and_scaled():
    score, box = search(scene(top=-50), avatar()).run()
    assert score > 0.70 and box_iou(box, (300, -50, 480, 130)) > 0.9
    score, box = search(scene(scale=1.25), avatar()).run()
    assert box_iou(box, (300, 200, 525, 425)) > 0.95
    s = search(scene(scale=1.9), avatar())
    s.run()
    assert all(130 < 180 + o <= 325 for o in s.trace if o not in (0, 5))


def tried(peak, height):
    """The sizes a search tries, in order, and its answer, when scores fall off evenly from a peak."""
    seen = {}
    fit = pixels.SizeFit(None, np.zeros((180, 180)))
    best = pixels.climb(lambda o: seen.setdefault(o, height - abs(o - peak) / 200), fit.fits)
    return list(seen), best


def test_search_path_below_the_target():
    # coarse steps up to the peak, one past it, and ten more looked at in vain
    assert tried(20, 0.8) == (list(range(0, 80, 5)), 20)


def test_search_path_across_the_target():
    # 10 is the first past the target: its neighbours are looked at, near before far, then steps are fine from 10 on
    assert tried(20, 0.9) == ([0, 5, 10, 9, 11, 8, 12, 7, 13, 6, 14, *range(15, 32)], 20)


def test_search_path_turns_once_when_scores_are_low():
    # down to the smallest size, then the other way from the start up to the largest
    assert tried(-30, 0.6) == ([0, 5, *range(-5, -50, -5), *range(10, 150, 5)], -30)


def test_crop_pads_and_rejects_empty():
    base = np.full((64, 64, 4), 255, np.uint8)
    assert pixels.crop(base, [0, 0, 32, 32])[5, 5, 3] == 255
    assert pixels.crop(base, [-32, -32, 32, 32])[0, 0, 3] == 0
    assert pixels.crop(base, [0, 0, 32, 32]).shape == (180, 180, 4)
    with pytest.raises(ValueError):
        pixels.crop(base, [5, 5, 5, 9])


def test_composition_keeps_alpha_outside():
    base = scene()
    diff = np.full((64, 64, 4), 90, np.uint8)
    group = {"facePos": {"x": 10, "y": 10}, "faceSize": {"x": 64, "y": 64}}
    out = pixels.compose(base, diff, group)
    assert (out[10:74, 10:74, :3] == 90).all() and (out[80:, 80:] == base[80:, 80:]).all()
    assert pixels.compose(base, base, None) is not None
    for bad in (None, {"facePos": {"x": 1}}, {"facePos": {"x": 1, "y": 1}, "faceSize": {"x": 0, "y": 4}}):
        with pytest.raises(ValueError):
            pixels.compose(base, diff, bad)


def test_masks_and_similarity():
    a, empty = avatar(), np.zeros((180, 180, 4), np.uint8)
    assert pixels.mask_iou(empty, empty) == 1.0 and pixels.mask_iou(a, empty) == 0.0
    half = a.copy()
    half[90:] = 0
    assert 0 < pixels.mask_iou(a, half) < 1 and pixels.mask_iou(a, half, [0, 0, 180, 90]) == 1.0
    assert pixels.similarity(a, a) > 0.99 > pixels.similarity(a, np.full_like(a, 255) - a // 2)


def test_lz4_round_trip():
    data = b"abcabcabcabcabcabcabcabc" + bytes(range(40))
    block = bytes([(3 << 4) | 15]) + b"abc" + bytes([3, 0]) + bytes([2]) + bytes([(15 << 4), len(data) - 24 - 15]) + data[24:]
    assert packed.inflate(block, len(data), swapped=False) == data
    mixed = packed.swap(block, len(data), swapped=False)
    assert mixed != block and packed.swap(mixed, len(data)) == block and packed.inflate(mixed, len(data)) == data
    with pytest.raises(ValueError):
        packed.inflate(block[:6], len(data))


def test_face_groups_in_sibling_branches():
    tree = {"groups": [{"FacePos": {"x": 489, "y": 84}, "faceSize": {"x": 85, "y": 60}}], "more": {"p": {"facePos": {"x": 492, "y": 81}}, "s": {"FaceSize": {"x": 87, "y": 60}}}}
    got = packed.face_groups(tree)
    assert [tuple(g[k][c] for k in ("facePos", "faceSize") for c in "xy") for g in got] == [(489, 84, 85, 60), (492, 81, 87, 60)]


def as_row(image):
    return (*image.shape, image.tobytes())


def test_matching_stops_at_the_first_good_candidate(spark):
    bases = spark.createDataFrame([("c", "b", *as_row(scene()))], f"character string, base string, {IMAGE}")
    cands = [("c", "b", "good", 1, *as_row(avatar())), ("c", "b", "other", 2, *as_row(avatar(7)))]
    df = spark.createDataFrame(cands, f"character string, base string, avatar string, rank int, {IMAGE}")
    r = images.match_bases(bases, df, keep_offsets=True).first()
    assert r["avatar"] == "good" and r["box"] == [300, 200, 480, 380] and {o["avatar"] for o in r["offsets"]} == {"good"}
    broken = spark.createDataFrame([("c", "b", "bad", 1, 5, 5, 4, b"x")], df.schema)
    assert "bad" in images.match_bases(bases, broken).first()["error"]


def test_crops_detection_and_sheets(spark):
    df = spark.createDataFrame([("a", *as_row(scene()), [300, 200, 480, 380]), ("b", *as_row(scene()), [3, 3, 3, 3])], f"k string, {IMAGE}, box array<int>")
    out = {r["k"]: r for r in images.crops(df, ["k"]).collect()}
    assert out["a"]["png"][:4] == b"\x89PNG" and out["a"]["error"] is None and "empty" in out["b"]["error"]
    face = lambda image: [{"bbox": [100, 50, 140, 90], "confidence": 0.9}, {"bbox": [0, 0, 1, 1], "confidence": 0.9}]
    r = images.detect(df.select("k", "height", "width", "channels", "data"), ["k"], face).first()
    assert r["detected"] and r["box"] == [98, 48, 142, 92]
    tiles = spark.createDataFrame([("x", 0, *as_row(avatar())), ("x", 1, None, None, None, None)], f"character string, ord int, {IMAGE}")
    s = images.contact_sheets(tiles).first()
    assert (s["tiles"], s["missing"]) == (2, 1)


def test_image_scan_and_groups(spark, tmp_path):
    (tmp_path / "a.png").write_bytes(pixels.png(avatar()))
    (tmp_path / "bad.png").write_bytes(b"no picture")
    got = {r["path"].rsplit("/", 1)[1]: r for r in tables.images(spark, str(tmp_path)).collect()}
    assert np.array_equal(pixels.from_row(180, 180, 4, got["a.png"]["data"]), avatar()) and got["bad.png"]["error"] == "unreadable"
    df = spark.createDataFrame([("b$2.png", [1, 2]), ("b.png", [1, 2]), ("b$3.png", [1, 2]), ("b$0.png", [1, 2])], "diff string, groups array<int>")
    assert [r["group"] for r in images.group_of_diff(df).select("group").collect()] == [2, 1, None, None]
    j = spark.createDataFrame([('{"facePos":{"x":1,"y":2},"faceSize":{"x":3,"y":4}}',), ("broken",)], "t string")
    assert [len(r["groups"]) for r in images.face_groups(j, "t").collect()] == [1, 0]


def test_match_views(spark):
    white = np.full((64, 64, 4), 255, np.uint8)
    view = pixels.match_view(white, avatar(side=360), [0.25, 0.5, 0.75, 1.0], 0.9174)
    assert view.shape == (512, 512, 3) and (view[256:259, 128:256] == pixels.RED).all() and (view[300, 140] == 255).all()
    assert (view[232:256, 128:220] == pixels.RED).all(2).any() and (view[-180:, -180:] != 255).any() and (view[:200] == 255).all()
    assert pixels.numeral("8").sum() > pixels.numeral("1").sum() > 0 and pixels.numeral("").shape[1] == 0
    row = (64, 64, 4, white.tobytes())
    df = spark.createDataFrame([("a", *row, [0.0, 0.0, 0.5, 0.5], 0.9, row), ("b", *row, None, None, None), ("c", *row, [0.0, 0.0, 0.5, 0.5], 0.9, None)], f"base string, {IMAGE}, box_norm array<double>, threshold double, avatar struct<{IMAGE.replace(' ', ':').replace(',:', ',')}>")
    out = {r["base"]: r for r in images.match_views(df, ["base"]).collect()}
    assert out["b"]["png"] is None and all(out[k]["png"].startswith(b"\x89PNG") and out[k]["error"] is None for k in "ac")
