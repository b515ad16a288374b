"""Named queries over scans, reports, tiers, names and boxes: the tables stand in for listings, documents and items."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geometry, names
from ..operators import fit, incremental, merge, rank, stats, tiers
from ..sources import sinks, tables
from .catalogue import query, t


# --- listings


def _ls(df, key, name, size):
    return df.select(F.concat(F.lit("-rw-r--r-- 1 u g "), F.col(size).cast("string"), F.lit(" 2026-01-02 10:00 /data/"), F.col(key).cast("string"), F.lit("_"), name).alias("value"))


@query("""
select 'avatars/' || p_partkey || '_' || regexp_extract(p_name, '[^/]+$', 0) || '.ab' rel, p_size::bigint size from part where p_partkey % 3 <> 0
""")
def q52_ls_listing(spark, sf):
    ending = F.when(F.col("p_partkey") % 3 == 0, F.lit(".txt")).otherwise(F.lit(".ab"))
    lines = _ls(t(spark, sf, "part"), "p_partkey", F.concat("p_name", ending), "p_size")
    total = spark.range(1).select(F.lit("total 12").alias("value"))
    return tables.ls_listing(lines.unionByName(total), "avatars")


def _unzip(df, name, size):
    return df.select(F.concat(F.lpad(F.col(size).cast("string"), 9, " "), F.lit("  2026-07-22 00:19   assets/AB/"), name, F.lit(".ab")).alias("value"))


@query("""
with a as (select 'k' || s_suppkey || '.ab' rel, (s_suppkey + 10)::bigint size, 0 p, 'base.apk' source from supplier union all
  select 'k' || c_custkey || '.ab', (c_custkey + 5)::bigint, 1, 'split.apk' from customer where c_custkey % 2 = 0)
select rel, size, source from (select *, row_number() over (partition by rel order by p) n from a) where n = 1
""")
def q53_archive_listings(spark, sf):
    head = spark.range(1).select(F.lit("  Length      Date    Time    Name").alias("value"))
    base = _unzip(t(spark, sf, "supplier").withColumn("n", F.col("s_suppkey") + 10), F.concat(F.lit("k"), F.col("s_suppkey").cast("string")), "n")
    split = _unzip(t(spark, sf, "customer").where("c_custkey % 2 = 0").withColumn("n", F.col("c_custkey") + 5), F.concat(F.lit("k"), F.col("c_custkey").cast("string")), "n")
    return tables.archives_listing([("split.apk", split), ("base.apk", head.unionByName(base))])


@query("""
with l as (select c_custkey rel, 'adb' source from customer where c_custkey % 2 = 0 union all select s_suppkey, 'apk' from supplier where s_suppkey % 2 = 1)
select source, list_sort(list(rel)) items from l where rel % 3 = 0 group by 1
""")
def q54_owners(spark, sf):
    a = t(spark, sf, "customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("rel"))
    b = t(spark, sf, "supplier").where("s_suppkey % 2 = 1").select(F.col("s_suppkey").alias("rel"))
    listing = merge.first_wins([("adb", a), ("apk", b)], ["rel"])
    return merge.owners(listing, listing.where("rel % 3 = 0").select("rel"))


@query("""
select page_id path, 'title' kind, regexp_extract(html, '<title>([^<]*)</title>', 1) name, case when page_id % 5 = 0 then 'ValueError: odd bundle' end error from pages
""")
def q55_parse_bundles(spark, sf):
    def parser(raw):
        page, sep, text = raw.partition(b"\0")
        if int(page) % 5 == 0:
            raise ValueError("odd bundle")
        start = text.find(b"<title>")
        title = text[start + 7 : text.find(b"</title>")] if start >= 0 else b""
        return [("title", title.decode(), b"")]

    files = t(spark, sf, "pages").select(F.col("page_id").cast("string").alias("path"), F.concat(F.col("page_id").cast("string").cast("binary"), F.lit(b"\0"), F.col("html").cast("binary")).alias("content"))
    out = tables.parse_bundles(files, parser).join(t(spark, sf, "pages").select(F.col("page_id").cast("string").alias("path"), F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("whole")), "path")
    # a failing bundle keeps its row, and its title is told by the table beside it
    return out.select(F.col("path").cast("long").alias("path"), F.lit("title").alias("kind"), F.coalesce("name", "whole").alias("name"), "error")


# --- documents


@query("select event_type as key, count(*)::bigint n, count(distinct user_id)::bigint users, sum(value) total from events group by 1")
def q56_map_report(spark, sf):
    c = t(spark, sf, "events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("v"))
    texts = sinks.nested(c, "user_id", "event_type", ["n", "v"]).select(F.col("doc").alias("text"))
    broken = spark.range(1).select(F.lit("{not a document").alias("text"))
    rows = tables.map_report(texts.unionByName(broken), "", "struct<n: bigint, v: double>")
    return rows.groupBy("key").agg(F.sum("value.n").alias("n"), F.count(F.lit(1)).alias("users"), F.sum("value.v").alias("total"))


@query("""
select p_brand as character, p_partkey || '.png' item, [p_size, 1, p_size + 40, 41] box from part where p_partkey % 4 <> 0
""")
def q57_manual_boxes(spark, sf):
    key = F.concat("p_brand", F.lit("/"), F.col("p_partkey").cast("string"), F.lit(".png"))
    box = F.when(F.col("p_partkey") % 4 == 0, F.array("p_size", F.lit(1))).otherwise(F.array(F.col("p_size"), F.lit(1), F.col("p_size") + 40, F.lit(41)))
    flat = F.to_json(F.create_map(key, box))
    text = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit('{"images":'), flat, F.lit("}"))).otherwise(flat)
    return tables.manual_boxes(t(spark, sf, "part").select(text.alias("text")))


@query("select 'k' || s_suppkey as key, case when s_suppkey % 2 = 0 then 'blurred' else '' end reason from supplier")
def q58_skip_list(spark, sf):
    entry = F.create_map(F.concat(F.lit("k"), F.col("s_suppkey").cast("string")), F.when(F.col("s_suppkey") % 2 == 0, "blurred").otherwise(""))
    return tables.skip_list(t(spark, sf, "supplier").select(F.to_json(entry).alias("text")))


@query("""
select doc_id, coalesce(case when doc_id % 3 = 0 then 10 end, case when doc_id % 4 <> 0 then n_chars end)::int width, coalesce(case when doc_id % 3 = 0 then 20 end, case when doc_id % 4 <> 0 then n_chars + 1 end)::int height
from documents where doc_id % 3 = 0 or doc_id % 2 = 0
""")
def q59_image_sizes(spark, sf):
    d = t(spark, sf, "documents").select("doc_id", F.col("n_chars").cast("int").alias("n"))
    known = d.where("doc_id % 3 = 0").select("doc_id", F.lit(10).alias("width"), F.lit(20).alias("height"))
    scanned = d.where("doc_id % 2 = 0").select("doc_id", F.expr("case when doc_id % 4 = 0 then -1 else n end").alias("width"), (F.col("n") + 1).alias("height"))
    return tables.image_sizes(known, scanned, ["doc_id"])


@query("select p_partkey, p_size width, (case when p_partkey % 3 = 0 then p_size else 7 end)::int height from part where p_partkey % 2 = 0 and p_size = (case when p_partkey % 3 = 0 then p_size else 7 end)")
def q60_square_avatars(spark, sf):
    p = t(spark, sf, "part").select("p_partkey", F.when(F.col("p_partkey") % 2 == 0, "Char_1_x").otherwise("npc_1").alias("name"), F.col("p_size").alias("width"), F.expr("case when p_partkey % 3 = 0 then p_size else 7 end").alias("height"))
    return tables.square_avatars(p).drop("name")


# --- tiers


@query("""
with i as (select o_orderkey, o_custkey % 10 m, (o_orderkey % 100) / 100.0::double h from orders),
r as (select *, case when m = 0 then 'manual' when m <> 1 and h > 0.8 and o_orderkey % 4 <> 0 then 'match' when o_orderkey % 5 > 1 and m <> 2 then 'derive' else 'no_box' end method from i)
select o_orderkey, method, case method when 'manual' then [1, 2, 3, 4] when 'match' then [0, 0, m::int, m::int] when 'derive' then [5, 5, 6, 6] end box,
  case method when 'manual' then 1.0::double when 'match' then h when 'derive' then 0.5::double end confidence from r
""")
def q61_resolve(spark, sf):
    i = t(spark, sf, "orders").select("o_orderkey", (F.col("o_custkey") % 10).alias("m"), ((F.col("o_orderkey") % 100) / 100.0).alias("h"))
    four = lambda *x: F.array(*[F.lit(v) if isinstance(v, int) else F.col(v).cast("int") for v in x])
    # the box of every item with m = 1 is broken, on either side
    broken = F.array(F.lit(1))
    manual = i.where("m in (0, 1)").select("o_orderkey", F.when(F.col("m") == 0, four(1, 2, 3, 4)).otherwise(broken).alias("box"))
    match = i.where("o_orderkey % 4 <> 0").select("o_orderkey", F.col("h").alias("threshold"), F.when(F.col("m") == 1, broken).otherwise(four(0, 0, "m", "m")).alias("box"))
    derived = i.where("o_orderkey % 5 > 1 and m <> 2").select("o_orderkey", four(5, 5, 6, 6).alias("box"), F.lit(0.5).alias("confidence"))
    return tiers.resolve(i.select("o_orderkey"), manual, match, derived, ["o_orderkey"])


@query("""
select event_id, value > 60 and event_id % 3 <> 0 and event_id % 2 = 0 and value > 55 and user_id % 5 <> 0 gated, value > 80 and event_id % 7 <> 0 matched from events where value is not null
""")
def q62_gates(spark, sf):
    pos = F.when(F.col("user_id") % 5 != 0, F.struct(F.lit(1).alias("x")))
    e = t(spark, sf, "events").where("value is not null").select("event_id", (F.col("event_id") % 3 != 0).alias("detected"), (F.col("event_id") % 2 == 0).alias("head_detected"), (F.col("value") / 100).alias("confidence"), (F.col("value") / 100).alias("head_confidence"), pos.alias("face_pos"), F.struct(F.lit(1).alias("x")).alias("head_pos"), F.when(F.col("event_id") % 7 != 0, F.array(*[F.lit(i) for i in range(4)])).otherwise(F.array(F.lit(1))).alias("box"))
    return e.select("event_id", tiers.derive_gate().alias("gated"), tiers.match_gate("confidence", "box").alias("matched"))


@query("""
with b as (select o_orderkey, case when o_orderstatus = 'P' then 'dropped' else 'ok' end s, case when o_totalprice > 150000 then [1, 2] end box from orders where o_orderkey % 9 <> 0)
select l_orderkey o_orderkey, l_linenumber, case when s = 'dropped' then 'dropped' when l_linenumber % 3 = 0 then 'skipped' when box is null then 'no_box' else 'todo' end status, box as base_box
from lineitem left join b on o_orderkey = l_orderkey
""")
def q63_diff_status(spark, sf):
    bases = t(spark, sf, "orders").where("o_orderkey % 9 <> 0").select("o_orderkey", F.when(F.col("o_orderstatus") == "P", "dropped").otherwise("ok").alias("status"), F.when(F.col("o_totalprice") > 150000, F.array(F.lit(1), F.lit(2))).alias("box"))
    diffs = t(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", (F.col("l_linenumber") % 3 == 0).alias("exists"))
    return tiers.diff_status(diffs, bases, ["o_orderkey"]).drop("exists")


# --- counters

_METHODS = ("manual", "match", "derive")


def _extraction(spark, sf):
    status = F.expr("element_at(array('ok', 'skipped', 'no_box', 'failed', 'dropped'), cast(1 + l_linenumber % 5 as int))")
    method = F.expr("element_at(array('manual', 'match', 'derive'), cast(1 + l_partkey % 3 as int))")
    return t(spark, sf, "lineitem").select("l_suppkey", F.when(F.col("l_returnflag") == "N", "base").otherwise("diff").alias("kind"), status.alias("status"), method.alias("method"), (F.col("l_tax") > 0.07).alias("special"))


_CELLS = {f"{k}_{s}": f"kind = '{k}' and status = '{s}'" for k in ("base", "diff") for s in stats.STATUSES} | {f"{k}_ok_{m}": f"kind = '{k}' and status = 'ok' and method = '{m}'" for k in ("base", "diff") for m in _METHODS}
_CELLS |= {f"{k}_special": f"kind = '{k}' and special" for k in ("base", "diff")} | {k: f"kind = '{k}'" for k in ("base", "diff")}


@query(
    "with i as (select case when l_returnflag = 'N' then 'base' else 'diff' end kind, (['ok', 'skipped', 'no_box', 'failed', 'dropped'])[1 + l_linenumber % 5] status, (['manual', 'match', 'derive'])[1 + l_partkey % 3] as method, l_tax > 0.07 special from lineitem) "
    "select count(*) total, " + ", ".join(f"(count(*) filter ({cond}))::bigint {name}" for name, cond in _CELLS.items()) + " from i"
)
def q64_extraction_counters(spark, sf):
    return stats.counts(_extraction(spark, sf), [], **{k: F.expr(v) for k, v in _CELLS.items()})


@query("""
select source, count(*) total, (count(*) filter (quality = 1))::bigint ok, (count(*) filter (quality = 0 and toxic = 0))::bigint empty, (count(*) filter (quality = 0 and toxic = 1))::bigint failed, (count(*) filter (quality is null))::bigint no_avatar
from documents left join labels using (doc_id) group by 1
""")
def q65_match_stats(spark, sf):
    d = t(spark, sf, "documents").join(t(spark, sf, "labels"), "doc_id", "left")
    return stats.counts(d, ["source"], ok=F.expr("quality = 1"), empty=F.expr("quality = 0 and toxic = 0"), failed=F.expr("quality = 0 and toxic = 1"), no_avatar=F.expr("quality is null"))


# --- state


@query("""
select o_orderkey as rel, sha256(o_custkey::varchar) sha256 from orders
where not (o_orderkey % 3 <> 0 and o_orderkey % 11 <> 0 and o_orderkey % 5 <> 0)
""")
def q66_unpack_todo(spark, sf):
    o = t(spark, sf, "orders")
    sha = lambda x: F.sha2(x.cast("string"), 256)
    files = o.select(F.col("o_orderkey").alias("rel"), sha(F.col("o_custkey")).alias("sha256"))
    done = o.where("o_orderkey % 3 <> 0").select(F.col("o_orderkey").alias("rel"), sha(F.when(F.col("o_orderkey") % 11 == 0, F.col("o_custkey") + 1).otherwise(F.col("o_custkey"))).alias("source_sha256"))
    metas = o.where("o_orderkey % 5 <> 0").select(F.col("o_orderkey").alias("rel"))
    return incremental.unpack_todo(files, done, metas)


@query("select 'covered' part, doc_id from documents where doc_id in (select doc_id from labels) union all select 'missing', doc_id from documents where doc_id not in (select doc_id from labels)")
def q67_incremental_detection(spark, sf):
    d, seen = t(spark, sf, "documents").select("doc_id"), t(spark, sf, "labels")
    parts = [f(d, seen, ["doc_id"]).select(F.lit(n).alias("part"), "doc_id") for n, f in (("covered", incremental.covered), ("missing", incremental.missing))]
    return parts[0].unionByName(parts[1])


@query("""
select o_orderstatus as category, count(*) files, sum(o_custkey)::bigint bytes, sha256('[' || string_agg('{"rel":' || o_orderkey || ',"sha256":"' || sha256(o_custkey::varchar) || '"}', ',' order by o_orderkey) || ']') digest from orders group by 1
""")
def q68_category_manifest(spark, sf):
    o = t(spark, sf, "orders").select(F.col("o_orderstatus").alias("category"), F.col("o_orderkey").alias("rel"), F.col("o_custkey").alias("size"), F.sha2(F.col("o_custkey").cast("string"), 256).alias("sha256"))
    return sinks.category_manifest(o)


@query("""
with a as (select count(distinct o_custkey) x, sum(hash(o_orderkey) % 2) y from orders) select count(*)::bigint as rows, count(distinct f)::bigint prints from (select o_orderkey, o_custkey::varchar || '|' || coalesce(case when o_orderkey % 2 = 0 then o_orderstatus end, '~') f from orders)
""")
def q69_fingerprints(spark, sf):
    o = t(spark, sf, "orders").select("o_custkey", F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderstatus")).alias("s"))
    prints = o.select(incremental.fingerprint("o_custkey", "s").alias("f"))
    return prints.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("f").alias("prints"))


# --- names


@query(r"""
with n as (select p_partkey, case p_partkey % 4 when 0 then 'Av.g_12_x.PNG.png' when 1 then '.hidden' when 2 then ' Char_7_A#1.png ' else 'npc_9/alpha.PNG' end x from part)
select p_partkey, regexp_replace(x, '(?i)(\.png)+$', '') plain, case p_partkey % 4 when 0 then 'Av.g_12_x.PNG' when 1 then '.hidden' when 2 then ' Char_7_A#1' else 'npc_9/alpha' end stem,
  split_part(x, '/', 1) first, lower(trim(x)) skip, case p_partkey % 4 when 0 then 'av.g_12_x.png' when 1 then '.hidden' when 2 then 'char_7_a#1' else 'npc_9/alpha' end sprite, p_partkey % 4 = 3 alpha,
  p_partkey % 4 in (0, 2) globbed from n
""")
def q70_name_functions(spark, sf):
    x = F.expr("case p_partkey % 4 when 0 then 'Av.g_12_x.PNG.png' when 1 then '.hidden' when 2 then ' Char_7_A#1.png ' else 'npc_9/alpha.PNG' end")
    n = t(spark, sf, "part").select("p_partkey", x.alias("x"))
    glob = F.col("x").rlike(names.glob_regex("*[!a].?ng*"))
    return n.select("p_partkey", names.without_png("x").alias("plain"), names.stem("x").alias("stem"), names.first_segment("x").alias("first"), names.skip_key("x").alias("skip"), names.sprite_key("x").alias("sprite"), names.is_alpha_texture("x").alias("alpha"), glob.alias("globbed"))


@query(r"""
select o_orderkey, case when o_orderkey % 2 = 0 then '12' || o_orderkey else o_custkey::varchar end token, case when o_orderkey % 3 = 0 then 'com.game.x' else 'none' end package,
  case when o_custkey < 1024 then o_custkey || ' B' else printf('%.1f KB', o_custkey / 1024.0) end size_text from orders where o_custkey < 1048576
""")
def q71_version_and_sizes(spark, sf):
    o = t(spark, sf, "orders").where("o_custkey < 1048576")
    version = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("v1.2."), F.col("o_orderkey").cast("string"))).otherwise("beta")
    place = F.when(F.col("o_orderkey") % 3 == 0, "/data/app/~~a==/com.game.x-b==/base.apk").otherwise("/elsewhere")
    return o.select("o_orderkey", names.version_token(version, "o_custkey").alias("token"), names.package_of(place, "none").alias("package"), names.byte_text("o_custkey").alias("size_text"))


# --- boxes and fits


@query("""
with b as (select l_orderkey, l_linenumber, l_quantity x1, l_linenumber y1, l_quantity + 40 x2, l_linenumber + 20 y2 from lineitem)
select l_orderkey, l_linenumber, round(x1 - 40 * 0.05, 6) gx1, round((y2 + 20 * 0.05)::double, 6) gy2, least(greatest(x2, 0), 60) cx2, greatest(least(y1, 3), 0)::int cy1, x1 / 100 nx1, y2 / 50 ny2,
  round_even(x2 * (2000 / 1024), 0)::int ox2, round_even(y2 * (500 / 1024), 0)::int oy2, 41.0::double rw, 21 rh, x2 rx2, sqrt(power(x1 - x2, 2) + power(y1 - y2, 2)) error from b
""")
def q72_box_functions(spark, sf):
    box = ["x1", "y1", "x2", "y2"]
    b = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("x1"), F.col("l_linenumber").alias("y1"), (F.col("l_quantity") + 40).alias("x2"), (F.col("l_linenumber") + 20).alias("y2"))
    g, c, n, o, r = geometry.scale_box(box), geometry.clip_box(box, F.lit(60), F.lit(3)), geometry.normalised(box, F.lit(100), F.lit(50)), geometry.rescale(box, F.lit(2000), F.lit(500)), geometry.rect(box)
    out = b.withColumn("r", r)
    back = geometry.corners("r")
    return out.select(
        "l_orderkey", "l_linenumber", F.round(g[0], 6).alias("gx1"), F.round(g[3], 6).alias("gy2"), c[2].alias("cx2"), c[1].alias("cy1"), n[0].alias("nx1"), n[3].alias("ny2"), o[2].alias("ox2"), o[3].alias("oy2"),
        F.col("r.w").alias("rw"), F.col("r.h").alias("rh"), back[2].alias("rx2"), geometry.centre_error("x1", "y1", "x2", "y2").alias("error"),
    )


@query("""
with r as (select l_orderkey, l_linenumber, l_quantity q, l_tax x from lineitem where l_linenumber % 2 = 1 and l_partkey % 3 <> 0 and l_discount > 0.05 and l_tax > 0.03)
select l_orderkey, l_linenumber, q + 5 fx, 2 * q + 10 fy, 10.0::double fw, 20.0::double fh, q + 20 cx, q + 50 cy, 70.0::double s from r
""")
def q73_fit_rows(spark, sf):
    rect = lambda x, y, w, h: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"), F.lit(w).alias("w"), F.lit(h).alias("h"))
    q = F.col("l_quantity")
    rows = t(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_linenumber") % 2 == 1).alias("detected"), (F.col("l_partkey") % 3 != 0).alias("head_detected"), (F.col("l_discount") + 0.75).alias("confidence"), (F.col("l_tax") + 0.77).alias("head_confidence"),
        rect(q, 2 * q, 10.0, 20.0).alias("face_pos"), rect(q, q, 30.0, 30.0).alias("head_pos"), F.array(q - 10, q + 10, q + 50, q + 90).alias("box"),
    )
    out = fit.targets(fit.features(fit.fit_rows(rows.withColumns({"confidence": F.round("confidence", 6), "head_confidence": F.round("head_confidence", 6)}))))
    return out.select("l_orderkey", "l_linenumber", "fx", "fy", "fw", "fh", "cx", "cy", "s")


@query("select doc_id, lang from (select *, row_number() over (order by lang, doc_id desc) n from documents where source in (select min(source) from documents union all select max(source) from documents)) where n <= 50")
def q74_selection_in_order(spark, sf):
    d = t(spark, sf, "documents")
    ends = d.agg(F.min("source"), F.max("source")).first()
    return rank.in_order(d, [F.col("lang"), F.col("doc_id").desc()], 50, list(ends), "source").select("doc_id", "lang")


@query("""
select 'sum' as key, sum(l_quantity) v, sum(l_quantity * l_discount) w from lineitem
""")
def q75_gram_cells(spark, sf):
    g = fit.gram(t(spark, sf, "lineitem"), ["l_quantity"], ["l_discount"])
    return g.select(F.lit("sum").alias("key"), F.col("l_quantity_1").alias("v"), F.col("l_quantity_l_discount").alias("w"))


# --- selections and fallbacks


@query("""
select o_orderkey, case o_orderstatus when 'P' then 0 else 1 end ord from orders where o_orderstatus in ('P', 'F')
""")
def q76_chosen_categories(spark, sf):
    o = t(spark, sf, "orders").select("o_orderkey", F.col("o_orderstatus").alias("category"))
    return merge.chosen_categories(o, ["P", "F"]).select("o_orderkey", "ord")


@query("select doc_id, case when doc_id % 3 = 0 then 'merged' else source end image from documents")
def q77_merged_or_own(spark, sf):
    d = t(spark, sf, "documents").select("doc_id", F.col("source").alias("image"))
    return merge.with_fallback(d, d.where("doc_id % 3 = 0").select("doc_id", F.lit("merged").alias("image")), ["doc_id"], "image")


@query("select o_orderkey from orders where o_orderkey % 7 = 0 or o_orderstatus = 'P'")
def q78_batch_fallback(spark, sf):
    o = t(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return merge.retry_failed(o.select("o_orderkey"), o.where("o_orderkey % 7 <> 0 and o_orderstatus <> 'P'"), ["o_orderkey"])


_REPORT = """(select o_custkey as character, o_orderkey base, o_totalprice threshold, o_totalprice > 250000 large, o_orderkey % 4 <> 0 ok from orders)"""


@query(f"select character, count(*) entries, (count(*) filter (ok))::bigint ok, sum(case when ok then threshold end) total from {_REPORT} where character % 3 = 0 group by 1")
def q79_report_subset(spark, sf):
    o = t(spark, sf, "orders")
    report = o.select(F.col("o_custkey").alias("character"), F.struct(F.col("o_orderkey").alias("base"), F.col("o_totalprice").alias("threshold"), F.lit("kept aside").alias("offsets"), (F.col("o_orderkey") % 4 != 0).alias("ok")).alias("entry"))
    chosen = report.select("character").where("character % 3 = 0").distinct()
    part = rank.subset(report, chosen, ["character"])
    slim = rank.without_fields(part, "entry", ["offsets"])
    assert "offsets" not in slim.schema["entry"].dataType.fieldNames()
    total = slim.where("entry.ok").groupBy("character").agg(F.sum("entry.threshold").alias("total"))
    return stats.counts(slim, ["character"], ok=F.col("entry.ok")).withColumnRenamed("total", "entries").join(total, "character", "left")


@query("""
select distinct o_custkey as character, l_linenumber || case when l_partkey % 5 = 0 then '.jpg' else '.png' end image from lineitem join orders on o_orderkey = l_orderkey where l_partkey % 7 <> 0 and l_partkey % 5 <> 0
""")
def q80_flattened_diffs(spark, sf):
    name = F.when(F.col("l_partkey") % 7 == 0, "alpha.png").otherwise(F.concat(F.col("l_linenumber").cast("string"), F.when(F.col("l_partkey") % 5 == 0, ".jpg").otherwise(".png")))
    items = t(spark, sf, "lineitem").join(t(spark, sf, "orders"), F.col("o_orderkey") == F.col("l_orderkey")).select(F.col("o_custkey").alias("character"), "o_orderkey", name.alias("image"))
    bases = items.groupBy("character", "o_orderkey").agg(F.collect_set("image").alias("diffs"))
    return rank.flattened(bases, ["character"], "diffs", "image", suffixes=(".png",))


@query("select case when l_linenumber % 2 = 0 then l_orderkey end as character, list_sort(list(distinct l_linenumber)) dropped from lineitem where l_returnflag = 'R' and l_linenumber % 2 = 0 group by 1")
def q81_dropped_by_character(spark, sf):
    items = t(spark, sf, "lineitem").where("l_linenumber % 2 = 0").select(F.col("l_orderkey").alias("character"), F.col("l_linenumber").alias("item"), F.when(F.col("l_returnflag") == "R", "dropped").otherwise("ok").alias("status"))
    return stats.indexed(items.where(F.col("status") == "dropped").withColumnRenamed("character", "key"), "key", "item").toDF("character", "dropped")
