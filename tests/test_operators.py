"""Operators on small constructed tables with known answers."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions import geometry, names
from tessera.operators import classify, dedup, diff, fit, incremental, merge, rank, skip, stats, tiers


def values(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_manifest_diff_and_counts(spark):
    old = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "rel string, sha256 string")
    new = spark.createDataFrame([("b", "2"), ("c", "9"), ("d", "4")], "rel string, sha256 string")
    d = diff.manifest_diff(old, new, ["rel"], "sha256")
    assert values(d, "rel", "change") == [("a", "removed"), ("b", "unchanged"), ("c", "modified"), ("d", "added")]
    assert diff.diff_counts(d).first().asDict() == {"added": 1, "removed": 1, "modified": 1, "unchanged": 1, "total": 3}


def test_mirror_plan_keeps_remote_without_local(spark):
    schema = "rel string, v int"
    local, remote = spark.createDataFrame([], schema), spark.createDataFrame([("x", 1)], schema)
    assert values(diff.mirror_plan(local, remote, ["rel"], F.col("l.v") == F.col("r.v")), "rel", "action") == [("x", "keep")]
    local = spark.createDataFrame([("x", 2), ("y", 1), ("manifest.json", 1)], schema)
    plan = diff.mirror_plan(local, remote, ["rel"], F.col("l.v") == F.col("r.v"), F.col("rel") == "manifest.json")
    assert values(plan, "ord", "rel", "action") == [(0, "x", "copy"), (0, "y", "copy"), (1, "manifest.json", "copy")]


def test_first_source_wins(spark):
    a = spark.createDataFrame([("c/a.ab", 10), ("v/dup.ab", 30)], "rel string, size long")
    b = spark.createDataFrame([("c/c.ab", 5), ("v/dup.ab", 999)], "rel string, size long")
    got = merge.first_wins([("adb", a), ("apk", b)], ["rel"])
    assert values(got, "rel", "size", "source") == [("c/a.ab", 10, "adb"), ("c/c.ab", 5, "apk"), ("v/dup.ab", 30, "adb")]
    asked = spark.createDataFrame([("c/c.ab",), ("v/dup.ab",)], "rel string")
    assert values(merge.owners(got, asked), "source", "items") == [("adb", ["v/dup.ab"]), ("apk", ["c/c.ab"])]


def test_status_pivot_fills_names_without_items(spark):
    items = spark.createDataFrame([("avg_1", "base", "ok", "match", True), ("avg_1", "diff", "ok", "derive", True), ("avg_1", "diff", "special", None, False)], "n string, k string, s string, m string, f boolean")
    names_ = spark.createDataFrame([("avg_1",), ("avg_2",), ("avg_3",)], "n string")
    out = stats.status_pivot(items, names_, "n", "k", "s", ("base", "diff"), flags={"has_avatar": F.col("f")}).collect()
    assert [r["n"] for r in out] == ["avg_1", "avg_2", "avg_3"]
    assert (out[0]["base_count"], out[0]["diff_count"], out[0]["base_ok"], out[0]["diff_ok"], out[0]["has_avatar"]) == (1, 2, 1, 1, True)
    assert sum(v for k, v in out[2].asDict().items() if k != "n") == 0


@pytest.mark.parametrize(
    "before,now,bases,status",
    [
        (["a"], ["a"], [("a", 0.5, None)], "kept"),
        (["a"], ["a", "b"], [("a", 0.85, None)], "rematch"),
        (["a"], ["a", "b"], [("a", 0.95, None)], "kept"),
        (["a"], ["a", "b"], [("a", 0.95, "broken")], "rematch"),
        (["a"], ["b"], [("a", 0.95, None)], "rematch"),
        ([], ["b"], [], "rematch"),
        ([], [], [], "kept"),
    ],
)
def test_rematch_table(spark, before, now, bases, status):
    kind = "character string, candidates array<string>"
    a = spark.createDataFrame([("x", now)], kind)
    b = spark.createDataFrame([("x", before, bases)], kind + ", bases array<struct<avatar:string,threshold:double,error:string>>")
    assert incremental.rematch(a, b).first()["status"] == status


def test_covered_missing_and_upsert(spark):
    sel = spark.createDataFrame([("a", 1), ("b", 1), ("c", 1)], "k string, o int")
    old = spark.createDataFrame([("a", 0.1), ("z", 0.2)], "k string, v double")
    assert values(incremental.covered(sel, old, ["k"]), "k") == [("a",)]
    assert values(incremental.missing(sel, old, ["k"]), "k") == [("b",), ("c",)]
    fresh = spark.createDataFrame([("b", 0.9), ("a", 0.8)], "k string, v double")
    assert values(merge.upsert(sel, fresh, old, ["k"], ["v"]), "k", "v", "origin") == [("a", 0.8, "fresh"), ("b", 0.9, "fresh")]


def test_skip_keys_filter_and_expansion(spark):
    c = spark.createDataFrame(
        [("avg_001_a_1", "x", None), ("avg_002_b_1", "base1", None), ("avg_002_b_1", "base1", "d1"), ("avg_002_b_1", "base2", None), ("avg_002_b_1", "base2", "d3"), ("none", None, None)],
        "character string, base string, diff string",
    )
    s = spark.createDataFrame([("AVG_001_a_1", "r"), ("avg_002_b_1/BASE1.png", "r"), ("avg_002_b_1/standalone", "r")], "key string, reason string")
    assert values(skip.filtered(c, s).fillna(""), "character", "base", "diff") == [("avg_002_b_1", "base2", ""), ("avg_002_b_1", "base2", "d3"), ("none", "", "")]
    assert values(skip.expanded(c, s), "sprite") == [("base1",), ("d1",), ("standalone",)]


CASES = [
    ("avg_1012_skadisp_1", [f"avg_1012_skadisp_{i}" for i in range(1, 9)], {"avg_1012_skadisp_1": 7}, 0),
    ("avg_1014_nearl2_1", ["avg_1014_nearl2_1$1", "avg_1014_nearl2_1$2", "1$1", "2$1", "1$2", "2$2"], {"avg_1014_nearl2_1$1": 2, "avg_1014_nearl2_1$2": 2}, 0),
    ("char_017_homura_3", [f"char_017_homura_{i}" for i in (1, 2, 3)], {"char_017_homura_1": 2}, 0),
    ("char_201_moeshd", ["char_201_moeshd"] + [f"char_201_moeshd_{i}" for i in range(1, 8)], {"char_201_moeshd": 7}, 0),
    ("char_264_mountain_1", [f"char_264_Mountain_1#{i}" for i in (1, 2, 3)], {"char_264_Mountain_1#1": 2}, 0),
    ("char_242_mayer", [f"char_242_mayer#{i}" for i in range(2, 6)], {"char_242_mayer#2": 3}, 0),
    ("char_242_one", ["anything"], {"anything": 0}, 0),
    ("avg_274_astesia_1", ["avg_274_Astesia_1", "avg_274_Astesia_2"], {"avg_274_Astesia_1": 1}, 0),
    ("char_190_clour", ["char_190_clour", "char_007_closre_1"], {"char_190_clour": 1}, 0),
]


def test_classification(spark):
    rows = [(c, f"{f}.png") for c, fs, _, _ in CASES for f in fs] + [("avg_empty_1", None)]
    out = classify.classify(spark.createDataFrame(rows, "character string, file string")).cache()
    for c, _, bases, loose in CASES:
        mine = [r for r in out.collect() if r["character"] == c]
        got = {r["base"][:-4]: sum(x["base"] == r["base"] and x["diff"] is not None for x in mine) for r in mine if r["base"] and r["diff"] is None}
        assert got == bases, c
        assert sum(r["unassigned"] is not None for r in mine) == loose, c
    assert [r["status"] for r in out.collect() if r["character"] == "avg_empty_1"] == ["empty"]
    s = classify.summary(out).first()
    assert (s["total"], s["ok"], s["empty"], s["no_base"]) == (len(CASES) + 1, len(CASES), 1, 0)


def test_candidate_ranking(spark):
    avatars = [f"char_196_sunbr{x}" for x in ("_2", "_summer#1", "")]
    for wanted, order in (("char_196_sunbr_1", ["char_196_sunbr", "char_196_sunbr_2", "char_196_sunbr_summer#1"]), ("char_196_sunbr_summer", ["char_196_sunbr_summer#1", "char_196_sunbr", "char_196_sunbr_2"])):
        df = spark.createDataFrame([(wanted, a) for a in avatars], "w string, a string")
        got = [r["a"] for r in rank.rank_candidates(df, ["w"], "w", "a").orderBy("rank").collect()]
        assert got[0] == order[0] and set(got) == set(order)


def _named(spark):
    """Items and names with repeats, variants, empty names and nulls, two rows of a key and a group without names."""
    word = ["ring", "Ring_2", "ring_3", "bolt", "gear_1", "", "_7", None]
    items = [(i // 2, f"g{i % 3}" if i % 7 else None, word[i % 8]) for i in range(60)]
    names_ = [(100 + i, f"g{i % 2}" if i % 11 else None, word[(i * 5) % 8]) for i in range(40)]
    return spark.createDataFrame(items, "k int, g string, wanted string"), spark.createDataFrame(names_, "n int, g string, name string")


def test_nearest_names_equal_ranked_pairs(spark):
    items, found = _named(spark)
    got = rank.nearest_names(items, found, ["g"], ["k"], "wanted", "name", 3, ("n",)).select("k", "name", "distance", "rank").collect()
    want = rank.rank_candidates(items.join(found, "g"), ["k"], "wanted", "name", 3, ("n",)).select("k", "name", "distance", "rank").collect()
    assert got and sorted(map(tuple, got), key=repr) == sorted(map(tuple, want), key=repr)
    assert max(r["rank"] for r in got if r["distance"] is None) > 1  # names without a distance come last


def test_nearest_names_measure_each_pair_of_names_once(spark):
    """The rows that levenshtein meets are the pairs of different names, not of rows."""
    items = spark.range(3000).selectExpr("id k", "'g' g", "concat('part ', id % 5) wanted")
    found = spark.range(400).selectExpr("id n", "'g' g", "concat('name ', char(97 + id % 4), '_', id) name")
    out = rank.nearest_names(items, found, ["g"], ["k"], "wanted", "name", 3, ("n",))
    assert out.count() == 9000
    out.collect()
    plan, most, queue = out._jdf.queryExecution().executedPlan(), 0, []
    queue.append(plan)
    while queue:
        node = queue.pop()
        if "Adaptive" in node.nodeName():
            node = node.executedPlan()
        if "QueryStage" in node.nodeName():
            node = node.plan()
        if "Join" in node.nodeName() and "_of" not in node.simpleString(1000):
            most = max(most, node.metrics().apply("numOutputRows").value())
        queue += [node.children().apply(i) for i in range(node.children().size())]
    assert 0 < most <= 5 * 4 * 3


def test_names(spark):
    df = spark.createDataFrame([("avg_003_kalts_1",), ("char_242_mayer",), ("avg_npc_010",), ("npc_001",), ("char_1012_skadi2_1",)], "n string")
    got = {r["n"]: (r["m"], r["i"]) for r in df.select("n", names.matchable("n").alias("m"), names.numeric_id("n").alias("i")).collect()}
    assert got["avg_003_kalts_1"] == (True, "003") and got["char_1012_skadi2_1"][1] == "1012" and got["avg_npc_010"][0] is False and got["npc_001"] == (False, None)
    one = spark.range(1).select(
        names.without_png(F.lit("a.png.PNG")).alias("p"), names.stem(F.lit("a.png.png")).alias("s"), names.fold_dots(F.lit("../..x")).alias("d"), names.byte_text(F.lit(1536)).alias("b"),
        names.version_token(F.lit("2.3.81"), F.lit(7)).alias("v"), names.version_token(F.lit("beta"), F.lit(7)).alias("w"), names.common_prefix(F.lit("abc"), F.lit("abd")).alias("l"),
        names.package_of(F.lit("/data/app/com.a.b-1/base.apk"), "x").alias("k"), names.elapsed_text(F.lit(75)).alias("e"),
    ).first()
    assert tuple(one) == ("a", "a.png", "./.x", "1.5 KB", "2381", "7", "ab", "com.a.b", "1m15s")
    assert names.glob_regex("a*.[!x]?") == r"(?s)^(?:a.*\.[^x].)$"


def test_byte_text_rounds_ties_to_even(spark):
    sizes = [1023, 1280, 1792, 3328, 1048575, 5 << 18, 13 << 18, 5 << 28, 13 << 28, None]
    got = [r["t"] for r in spark.createDataFrame([(i, n) for i, n in enumerate(sizes)], "i int, n long").orderBy("i").select(names.byte_text("n").alias("t")).collect()]
    assert got == ["1023 B", "1.2 KB", "1.8 KB", "3.2 KB", "1024.0 KB", "1.2 MB", "3.2 MB", "1.2 GB", "3.2 GB", None]


def test_boxes(spark):
    one = spark.range(1).select(
        geometry.iou([F.lit(v) for v in (0, 0, 2, 2)], [F.lit(v) for v in (0, 0, 2, 2)]).alias("same"), geometry.iou([F.lit(v) for v in (0, 0, 1, 1)], [F.lit(v) for v in (5, 5, 6, 6)]).alias("apart"),
        geometry.half_even(F.lit(2.5)).alias("h"), geometry.rect([F.lit(v) for v in (1, 2, 3, 4)]).alias("r"), F.array(*geometry.scale_box([F.lit(v) for v in (0, 0, 10, 10)])).alias("s"),
    ).first()
    assert (one["same"], one["apart"], one["h"], tuple(one["r"])) == (1.0, 0.0, 2, (1, 2, 3, 3))
    assert np.allclose(one["s"], [-0.5, -0.5, 10.5, 10.5])


def test_tiers_prefer_manual(spark):
    items = spark.createDataFrame([("c", i) for i in "abcd"], "character string, item string")
    manual = spark.createDataFrame([("c", "a", [1, 2, 3, 4])], "character string, item string, box array<int>")
    match = spark.createDataFrame([("c", "a", 0.99, [9, 9, 9, 9]), ("c", "b", 0.9, [5, 5, 9, 9]), ("c", "c", 0.8, [5, 5, 9, 9])], "character string, item string, threshold double, box array<int>")
    derived = spark.createDataFrame([("c", "c", [7, 7, 8, 8], 0.7)], "character string, item string, box array<int>, confidence double")
    out = {r["item"]: (r["method"], r["box"] and r["box"][0], r["confidence"]) for r in tiers.resolve(items, manual, match, derived, ["character", "item"]).collect()}
    assert out == {"a": ("manual", 1, 1.0), "b": ("match", 5, 0.9), "c": ("derive", 7, 0.7), "d": ("no_box", None, None)}


def test_greedy_dedup_drops_only_against_kept(spark):
    v = {"a": [1.0, 0.0, 0.0, 0.0], "b": [1.0, 0.5, 0.0, 0.0], "c": [0.0, 1.0, 0.0, 0.0]}
    df = spark.createDataFrame([("x", k, i, v[k]) for i, k in enumerate("abc")], "character string, item string, rank int, vec array<double>")
    got = dedup.greedy(df, ["character"], "rank", "vec", 0.5, ["item"])
    assert values(got, "item", "status") == [("a", "ok"), ("b", "dropped"), ("c", "ok")]


def test_all_pairs_of_a_group_are_compared(spark):
    rows = [("b" if i == 40 else "a", i, None if i == 7 else [float(i), 1.0]) for i in range(41)] + [("a", None, [1.0, 1.0]), (None, 50, [1.0, 1.0]), (None, 51, [1.0, 1.0])]
    got = dedup.pair_products(spark.createDataFrame(rows, "label string, id long, v array<float>"), ["label"], "id", "v", block=6).collect()
    want = {("a", i, j, None if 7 in (i, j) else i * j + 1.0) for i in range(40) for j in range(i + 1, 40)}
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_ols_full_rank_and_deficient(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 2)) * [3, 50] + [100, 2000]
    y = x @ [[2.0], [-0.5]] + 7
    df = spark.createDataFrame([(float(a), float(b), float(c[0])) for (a, b), c in zip(x, y, strict=True)], "a double, b double, y double")
    model = fit.ols(df, ["a", "b"], ["y"])
    assert np.allclose(np.array(model["coef"]).ravel(), [2, -0.5, 7], atol=1e-6) and abs(model["r2"]["y"] - 1) < 1e-9
    flat = spark.createDataFrame([(3.0, 1.0), (3.0, 2.0), (3.0, 6.0)], "a double, y double")
    want, *_ = np.linalg.lstsq(np.array([[3.0, 1], [3, 1], [3, 1]]), np.array([1.0, 2, 6]), rcond=None)
    assert np.allclose(np.array(fit.ols(flat, ["a"], ["y"])["coef"]).ravel(), want)
    still = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0)], "a double, y double")
    assert fit.ols(still, ["a"], ["y"])["r2"]["y"] == 0.0
    with pytest.raises(ValueError):
        fit.ols(still.limit(1), ["a"], ["y"])


def test_predict_unit_model(spark):
    coef = [[0.0] * 3 for _ in range(9)]
    coef[0][0] = coef[1][1] = coef[2][2] = 1.0
    model = fit.check_model({"coef": coef})
    kind = "struct<x:int,y:int,w:int,h:int>"
    df = spark.createDataFrame([((100, 50, 40, 40), (80, 20, 80, 90))], f"face_pos {kind}, head_pos {kind}")
    assert tuple(fit.predict(fit.features(df), model).select("px1", "py1", "px2", "py2").first()) == (100, 50, 140, 90)
    with pytest.raises(ValueError):
        fit.check_model({"coef": coef[:5]})
