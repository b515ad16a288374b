"""Scans, sinks, streams and pipelines over files made by the test."""

import io
import json
import tarfile

import numpy as np
from pyspark.sql import functions as F

from tessera.functions import pixels
from tessera.plans import pipeline
from tessera.sources import sinks, tables
from tessera.streaming import ingest


def lines(spark, text):
    return spark.createDataFrame([(x,) for x in text.splitlines()], "value string")


def test_listings(spark):
    ls = lines(spark, "total 4\n-rw-rw---- 1 root sdcard_rw 10022 2026-07-22 00:19 a.ab\n-rw-rw---- 1 root sdcard_rw 5 2026-07-22 00:19 notes.txt")
    assert [tuple(r) for r in tables.ls_listing(ls, "avatars").collect()] == [("avatars/a.ab", 10022)]
    head = "Archive: x\n  Length  Date  Time  Name\n-----\n"
    base = lines(spark, head + "    10022  2026-07-22 00:19   assets/ui_char_avatar_0.ab\n  1  2026-07-22 00:19   assets/dup.ab\n 10023   2 files")
    split = lines(spark, head + "  20  2026-07-22 00:19   assets/split_only.ab\n  99  2026-07-22 00:19   assets/dup.ab")
    got = {r["rel"]: r["size"] for r in tables.archives_listing([("split.apk", split), ("base.apk", base)]).collect()}
    assert got == {"dup.ab": 1, "split_only.ab": 20, "ui_char_avatar_0.ab": 10022}


def test_directory_and_category_scans(spark, tmp_path):
    d = tmp_path / "avg" / "characters"
    d.mkdir(parents=True)
    (d / "b.ab").write_bytes(b"xx")
    (d / "a.txt").write_bytes(b"x")
    got = tables.list_files(spark, str(tmp_path), "characters", with_digest=True).collect()
    assert [(r["rel"], r["size"]) for r in got] == [("characters/b.ab", 2)] and len(got[0]["sha256"]) == 64
    assert tables.list_files(spark, str(tmp_path), "avatars").count() == 0
    r = tmp_path / "recognition"
    for name in ("r.json", "face_detect_vis/v.png", "derive/model.json", "manifest.json", "x.tmp"):
        (r / name).parent.mkdir(parents=True, exist_ok=True)
        (r / name).write_bytes(b"1")
    first = tables.scan_category(spark, str(r), ["face_detect_vis"])
    assert sorted(x["rel"] for x in first.collect()) == ["derive/model.json", "r.json"]
    old = spark.createDataFrame([("r.json", 1, "recorded")], "rel string, size long, sha256 string")
    kept = {x["rel"]: x["sha256"] for x in tables.scan_category(spark, str(r), ["face_detect_vis"], old, strict=False).collect()}
    assert kept["r.json"] == "recorded" and len(kept["derive/model.json"]) == 64


def test_reports_are_read_in_order_and_tolerantly(spark, tmp_path):
    (tmp_path / "m.json").write_text('{"images": {"c/b": [1,2,3,4], "c/a": [1,2]}}')
    (tmp_path / "n.json").write_text("{broken")
    texts = tables.json_texts(spark, str(tmp_path / "*.json"))
    assert [tuple(r) for r in tables.manual_boxes(texts).collect()] == [("c", "b", [1, 2, 3, 4])]
    assert tables.json_texts(spark, str(tmp_path / "none.json")).count() == 0
    doc = spark.createDataFrame([('{"z": "1", "a": "2"}',)], "text string")
    assert [(r["ord"], r["key"]) for r in tables.map_report(doc, "", "string").collect()] == [(0, "z"), (1, "a")]


def test_packs_and_bundles(spark):
    raw = io.BytesIO()
    with tarfile.open(fileobj=raw, mode="w") as tar:
        for name, data in (("a.ab", b"12"), ("b.ab", b"123")):
            info = tarfile.TarInfo(name)
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))
    packs = spark.createDataFrame([(bytearray(raw.getvalue()),)], "content binary")
    want = spark.createDataFrame([("a.ab", 2), ("b.ab", 9), ("c.ab", 1)], "rel string, size long")
    assert {r["rel"]: r["error"] for r in tables.unpack_tars(packs, want).collect()} == {"a.ab": None, "b.ab": "size differs", "c.ab": "missing in the pack"}
    files = spark.createDataFrame([("p", bytearray(b"ok")), ("q", bytearray(b"no"))], "path string, content binary")

    def parser(raw):
        if raw == b"no":
            raise ValueError("bad")
        yield "texture", "t", raw

    got = {r["path"]: (r["kind"], r["error"]) for r in tables.parse_bundles(files, parser).collect()}
    assert got == {"p": ("texture", None), "q": (None, "ValueError: bad")}


def test_sinks(spark, tmp_path, capsys):
    p = str(tmp_path / "out" / "r.json")
    assert sinks.write_report({"a": 1, "game_version": "9"}, p) and not sinks.write_report({"a": 1, "game_version": "9"}, p)
    doc = json.loads(open(p).read())
    assert doc["game_version"] == "9" and list(doc)[:4] == ["schema_version", "pipeline_version", "game_version", "generated_at"]
    assert sinks.write_report({"a": 1}, "-") and '"a": 1' in capsys.readouterr().out
    log = str(tmp_path / "log")
    assert sinks.append_log(log, {"n": 1, "generated_at": "x"}) and not sinks.append_log(log, {"n": 1, "generated_at": "y"}) and sinks.append_log(log, {"n": 2, "generated_at": "y"})
    df = spark.createDataFrame([("b", True, None), ("a", False, 2)], "npc_id string, has_avatar boolean, n int")
    digest = sinks.write_csv(df, str(tmp_path / "t.csv"), "npc_id")
    assert open(tmp_path / "t.csv").read() == "npc_id,has_avatar,n\na,0,2\nb,1,\n" and open(tmp_path / "t.csv.sha256").read().startswith(digest)
    assert sinks.index_document(spark.createDataFrame([("c", "y"), ("c", "x")], "k string, v string"), "k", "v") == {"c": [[], ["x", "y"], ["npc"]]}
    nested = sinks.nested(spark.createDataFrame([('q"k', "i", 1, None)], "k string, i string, n int, m string"), "k", "i", ["n", "m"]).first()
    assert json.loads(nested["doc"]) == {"i": {"n": 1}}


def test_stream_upserts_and_replays(spark, tmp_path):
    src, out, cp = tmp_path / "in", str(tmp_path / "rec"), str(tmp_path / "cp")
    src.mkdir()
    (src / "a.ab").write_bytes(b"1")
    go = lambda: ingest.upsert_stream(ingest.new_files(spark, str(src)), out, cp, ["path"]).awaitTermination()
    go()
    (src / "b.ab").write_bytes(b"22")
    go()
    go()
    got = {r["path"].rsplit("/", 1)[1]: r["size"] for r in ingest.latest(spark, out).collect()}
    assert got == {"a.ab": 1, "b.ab": 2}


def test_pipeline_end_to_end(spark):
    rng = np.random.default_rng(3)
    face = rng.integers(0, 255, (180, 180, 4)).astype(np.uint8)
    face = pixels.resize(pixels.resize(face, 18, 18), 180, 180)
    face[:, :, 3] = 255
    base = np.zeros((1024, 1024, 4), np.uint8)
    base[:, :, 3] = 255
    base[100:280, 400:580] = face
    row = lambda i: (*i.shape, bytearray(i.tobytes()))
    picture = "height int, width int, channels int, data binary"
    t = {
        "sprites": spark.createDataFrame([("avg_007_x_1", "avg_007_x_1.png"), ("avg_007_x_1", "avg_007_x_2.png")], "character string, file string"),
        "sprite_images": spark.createDataFrame([("avg_007_x_1", "avg_007_x_1.png", *row(base))], f"character string, file string, {picture}"),
        "avatars": spark.createDataFrame([("char_007_x", *row(face)), ("char_008_y", *row(face))], f"avatar string, {picture}"),
        "manual": spark.createDataFrame([], "character string, item string, box array<int>"),
        "derived": spark.createDataFrame([], "character string, item string, box array<int>, confidence double"),
    }
    out = pipeline.run(pipeline.RUN, t)
    assert out.ok
    m = out.tables["match"].first()
    assert m["avatar"] == "char_007_x" and m["box"] == [400, 100, 580, 280]
    c = out.tables["crops"].first()
    assert c["method"] == "match" and c["error"] is None and c["png"][:4] == b"\x89PNG"
    bad = pipeline.run([("boom", lambda _: 1 / 0), ("never", lambda _: {})], {})
    assert not bad.ok and [s["step"] for s in bad.steps] == ["boom"]


def test_derive(spark):
    kind = "detected boolean, head_detected boolean, confidence double, head_confidence double, face_pos struct<x:int,y:int,w:int,h:int>, head_pos struct<x:int,y:int,w:int,h:int>, box array<int>"
    rng = np.random.default_rng(2)
    rows = []
    for _ in range(40):
        x, y, w, h = (int(v) for v in (*rng.integers(50, 400, 2), *rng.integers(30, 90, 2)))
        hx, hy, hw, hh = x - int(rng.integers(0, 30)), y - int(rng.integers(0, 30)), w + int(rng.integers(20, 60)), h + int(rng.integers(20, 60))
        rows.append((True, True, 0.95, 0.9, (x, y, w, h), (hx, hy, hw, hh), [x - w, y - w, x + 2 * w, y + 2 * w]))
    rows.append((True, True, 0.95, 0.8, rows[0][4], rows[0][5], rows[0][6]))
    out = pipeline.derive_step({"fit_input": spark.createDataFrame(rows, kind)})
    m, s = out["model"].first(), out["fit_stats"].first()
    assert m["fit_samples"] == 40 and len(m["coef"]) == 9 and m["r2"]["cx"] > 0.9999 and s["mean"] > 0.95
    assert out["fit_rows"].agg(F.count(F.lit(1))).first()[0] == 40


def test_source_registry_and_data_source(spark, tmp_path):
    from tessera.sources import listing

    d = tmp_path / "tree" / "spritepack"
    d.mkdir(parents=True)
    (d / "dup.ab").write_bytes(b"123")
    (tmp_path / "ls.txt").write_text("-rw-rw---- 1 root sdcard_rw 99 2026-07-22 00:19 dup.ab\n-rw-rw---- 1 root sdcard_rw 7 2026-07-22 00:19 only.ab\n")
    config = {"apk": {"root": str(tmp_path / "tree")}, "adb": {"listings": {"avatars": str(tmp_path / "ls.txt")}}}
    both = listing.make_source(["adb", "apk"], config)
    got = {r["rel"]: (r["size"], r["source"]) for r in both.files(spark, "avatars").collect()}
    assert got == {"avatars/dup.ab": (99, "adb"), "avatars/only.ab": (7, "adb")}
    assert listing.make_source(["apk"], config).files(spark, "avatars").first()["size"] == 3 and both.supports("characters")
    for bad in ([], ["nope"]):
        try:
            listing.make_source(bad, config)
        except ValueError:
            continue
        raise AssertionError
    spark.dataSource.register(listing.ListingDataSource)
    text = "Archive\n  10022  2026-07-22 00:19   assets/x/a.ab\n  5  2026-07-22 00:19   b.ab\n 7  2 files"
    df = spark.read.format("listing").option("text", text).option("style", "unzip").option("linesPerPartition", 2).load()
    assert sorted((r["name"], r["size"]) for r in df.collect()) == [("a.ab", 10022), ("b.ab", 5)]


def test_windowed_counts(spark, tmp_path):
    rows = [("2026-01-01 00:10:00", "a"), ("2026-01-01 00:50:00", "a"), ("2026-01-01 01:05:00", "b")]
    df = spark.createDataFrame(rows, "t string, k string").select(F.to_timestamp("t").alias("t"), "k")
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = ingest.counts_by_window(stream, "t", ["k"]).writeStream.outputMode("complete").format("memory").queryName("windowed").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted((r["k"], r["n"]) for r in spark.table("windowed").collect()) == [("a", 2), ("b", 1)]
