"""Named queries: every relational operator on the star-schema tables, with the SQL that must agree.

Each entry pairs a function of (spark, directory) with a statement; both run over whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry, names
from ..operators import dedup, diff, fit, incremental, merge, rank, skip, stats, tiers

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None):
    def keep(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return keep


def queries() -> dict[str, Query]:
    from . import assets  # noqa: F401  registers its queries

    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(_SQL)


def t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _snapshots(spark, sf, *extra) -> tuple[DataFrame, DataFrame]:
    """Two snapshots of orders: the old without every 7th key, the new without every 5th and with every 11th changed."""
    o = t(spark, sf, "orders")
    sha = lambda x: F.sha2(x.cast("string"), 256).alias("sha256")
    old = o.where("o_orderkey % 7 <> 0").select(*extra, F.col("o_orderkey").alias("rel"), sha(F.col("o_custkey")))
    changed = F.when(F.col("o_orderkey") % 11 == 0, F.col("o_custkey") + 1).otherwise(F.col("o_custkey"))
    new = o.where("o_orderkey % 5 <> 0").select(*extra, F.col("o_orderkey").alias("rel"), sha(changed))
    return old, new


_SNAP = """
old as (select {x} o_orderkey rel, sha256(o_custkey::varchar) s from orders where o_orderkey % 7 <> 0),
new as (select {x} o_orderkey rel, sha256((case when o_orderkey % 11 = 0 then o_custkey + 1 else o_custkey end)::varchar) s from orders where o_orderkey % 5 <> 0)
"""
_CHANGE = "case when o.rel is null then 'added' when n.rel is null then 'removed' when o.s = n.s then 'unchanged' else 'modified' end"
_COUNTS = ", ".join(f"count(*) filter (change = '{k}')::bigint {k}" for k in diff.CHANGES) + ", count(*) filter (change <> 'unchanged')::bigint total"


@query(f"with {_SNAP.format(x='')}, d as (select {_CHANGE} change from old o full join new n on o.rel = n.rel) select {_COUNTS} from d")
def q01_manifest_diff(spark, sf):
    return diff.diff_counts(diff.manifest_diff(*_snapshots(spark, sf), ["rel"], "sha256"))


@query(f"with {_SNAP.format(x='')}, d as (select coalesce(o.rel, n.rel) rel, {_CHANGE} change from old o full join new n on o.rel = n.rel) select * from d where change <> 'unchanged'")
def q02_manifest_diff_rows(spark, sf):
    return diff.manifest_diff(*_snapshots(spark, sf), ["rel"], "sha256").where("change <> 'unchanged'").orderBy("rel")


@query(
    f"with {_SNAP.format(x='o_orderstatus category,')}, shared as (select category from old intersect select category from new), "
    f"d as (select coalesce(o.category, n.category) category, {_CHANGE} change from old o full join new n on o.rel = n.rel and o.category = n.category) "
    f"select category, {_COUNTS} from d join shared using (category) group by category"
)
def q03_category_diff(spark, sf):
    old, new = _snapshots(spark, sf, F.col("o_orderstatus").alias("category"))
    return diff.diff_counts(diff.category_diff(old, new, "category", ["rel"], "sha256"), ["category"])


@query("""
select c_custkey, coalesce(n, 0)::bigint order_count, coalesce(f, 0)::bigint order_f, coalesce(o, 0)::bigint order_o, coalesce(p, 0)::bigint order_p, coalesce(big, false) has_big
from customer left join (select o_custkey, count(*) n, count(*) filter (o_orderstatus = 'F') f, count(*) filter (o_orderstatus = 'O') o,
  count(*) filter (o_orderstatus = 'P') p, bool_or(o_totalprice > 300000) big from orders group by 1) on c_custkey = o_custkey
""")
def q04_status_pivot(spark, sf):
    items = t(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), F.lit("order").alias("kind"), "o_orderstatus", "o_totalprice")
    return stats.status_pivot(items, t(spark, sf, "customer"), "c_custkey", "kind", "o_orderstatus", ("order",), ("F", "O", "P"), {"has_big": F.col("o_totalprice") > 300000})


@query("""
with per as (select o_custkey, o_orderkey, o_orderstatus, count(l_orderkey) n from orders left join lineitem on l_orderkey = o_orderkey group by all)
select count(distinct case when o_orderstatus = 'F' then o_custkey end)::bigint with_ok, count(*) filter (o_orderstatus = 'F')::bigint ok_orders,
  coalesce(sum(n) filter (o_orderstatus = 'F'), 0)::bigint ok_lines from per
""")
def q05_two_level_counts(spark, sf):
    lines = t(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("n"))
    per = t(spark, sf, "orders").join(lines, "o_orderkey", "left")
    return stats.owner_counts(per, "o_custkey", F.col("o_orderstatus") == "F", "n").toDF("with_ok", "ok_orders", "ok_lines")


@query(r"""
with p as (select p_partkey, p_name, p_brand, regexp_replace(lower(p_name), '_\d+$', '') s from part),
s as (select s_suppkey, s_name, regexp_replace(lower(s_name), '_\d+$', '') s, 'Brand#' || (1 + s_suppkey % 25) brand from supplier),
d as (select p_partkey, s_suppkey, s_name, levenshtein(p.s, s.s)::int distance from p join s on p.p_brand = s.brand),
r as (select *, row_number() over (partition by p_partkey order by distance, s_name)::int rank from d)
select p_partkey, s_suppkey, distance, rank from r where rank <= 3
""")
def q06_candidate_rank(spark, sf):
    s = t(spark, sf, "supplier").select("s_suppkey", "s_name", F.concat(F.lit("Brand#"), 1 + F.col("s_suppkey") % 25).alias("p_brand"))
    p = t(spark, sf, "part").select("p_partkey", "p_name", "p_brand")
    return rank.nearest_names(p, s, ["p_brand"], ["p_partkey"], "p_name", "s_name", 3, ("s_suppkey",)).select("p_partkey", "s_suppkey", "distance", "rank")


@query("""
with a as (select c_custkey k, c_name name, 0 p, 'adb' source from customer where c_custkey % 2 = 0 union all select s_suppkey, s_name, 1, 'apk' from supplier)
select k as rel, name, source from (select *, row_number() over (partition by k order by p) rn from a) where rn = 1
""")
def q07_first_source_wins(spark, sf):
    a = t(spark, sf, "customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("rel"), F.col("c_name").alias("name"))
    b = t(spark, sf, "supplier").select(F.col("s_suppkey").alias("rel"), F.col("s_name").alias("name"))
    return merge.first_wins([("adb", a), ("apk", b)], ["rel"])


@query("select user_id, coalesce(min(event_id) filter (value > 250), arg_max(event_id, {'v': value, 'e': -event_id})) pick from events group by user_id")
def q08_early_stop(spark, sf):
    return rank.first_above(t(spark, sf, "events"), ["user_id"], "event_id", "value", 250)


@query("""
with p as (select *, coalesce(count(*) filter (value > 250) over (partition by user_id order by event_id rows between unbounded preceding and 1 preceding), 0) n from events),
s as (select user_id, event_id, value from p where n = 0)
select user_id, event_id, value, row_number() over (partition by user_id order by value desc, event_id) = 1 best from s
""")
def q08b_early_stop_rows(spark, sf):
    return rank.early_stop(t(spark, sf, "events"), ["user_id"], ["event_id"], "value", 250).select("user_id", "event_id", "value", "best")


@query("""
select user_id, case when value >= 200 then event_id else -1 end event_id, case when value >= 200 then value end value, coalesce(value >= 200, false) detected from (
  select *, row_number() over (partition by user_id order by value desc nulls last, event_id) rn from events) where rn = 1
""")
def q09_top1_gate(spark, sf):
    best = rank.top1(t(spark, sf, "events").select("user_id", "event_id", "value"), ["user_id"], "value", "event_id")
    flagged = best.withColumn("score", F.col("value"))
    return rank.gate(flagged, "score", 200, ["event_id", "value"]).drop("score").withColumn("event_id", F.coalesce("event_id", F.lit(-1)))


@query("""
select d.doc_id, case when quality = 1 then 'manual' when n_chars > 2000 then 'match' when lang = 'en' then 'derive' else 'no_box' end as method,
  case when quality = 1 then 3 when n_chars > 2000 then 2 when lang = 'en' then 1 else 0 end tier
from documents d left join labels l on d.doc_id = l.doc_id
""")
def q10_tier_coalesce(spark, sf):
    d = t(spark, sf, "documents").select("doc_id", "n_chars", "lang").join(t(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
    out = tiers.coalesce_tiers(d, [("manual", F.col("quality") == 1), ("match", F.col("n_chars") > 2000), ("derive", F.col("lang") == "en")])
    return out.select("doc_id", "method", tiers.tier_rank("method").alias("tier"))


_BOX = "l_quantity x1, l_linenumber * 3.0 y1, l_quantity + l_partkey % 17 x2, l_linenumber * 3.0 + l_suppkey % 13 y2"


@query(f"""
with b as (select l_orderkey, l_linenumber, {_BOX} from lineitem),
p as (select a.l_orderkey, a.l_linenumber, greatest(0, least(a.x2, b.x2) - greatest(a.x1, b.x1)) * greatest(0, least(a.y2, b.y2) - greatest(a.y1, b.y1)) i,
  (a.x2 - a.x1) * (a.y2 - a.y1) + (b.x2 - b.x1) * (b.y2 - b.y1) s from b a join b on a.l_orderkey = b.l_orderkey and b.l_linenumber = a.l_linenumber + 1)
select l_orderkey, l_linenumber, case when s - i > 0 then i / (s - i) else 0::double end iou from p
""")
def q11_box_iou(spark, sf):
    b = t(spark, sf, "lineitem").selectExpr("l_orderkey", "l_linenumber", *[x.strip() for x in _BOX.replace("l_linenumber * 3.0", "l_linenumber * 3.0D").split(",")])
    nxt = b.select("l_orderkey", (F.col("l_linenumber") - 1).alias("l_linenumber"), *[F.col(x).alias(f"b{x}") for x in ("x1", "y1", "x2", "y2")])
    return b.join(nxt, ["l_orderkey", "l_linenumber"]).select("l_orderkey", "l_linenumber", geometry.iou(["x1", "y1", "x2", "y2"], ["bx1", "by1", "bx2", "by2"]).alias("iou"))


@query("select l_returnflag, quantile_cont(l_extendedprice, 0.1) p10, quantile_cont(l_extendedprice, 0.5) p50, quantile_cont(l_extendedprice, 0.9) p90 from lineitem group by 1")
def q12_quantile_summary(spark, sf):
    return stats.quantiles(t(spark, sf, "lineitem"), ["l_returnflag"], "l_extendedprice", {"p10": 0.1, "p50": 0.5, "p90": 0.9})


@query("select l_returnflag, list_sort(list(l_extendedprice))[count(*) // 2 + 1] upper_median from lineitem group by 1")
def q13_upper_median(spark, sf):
    return stats.upper_median(t(spark, sf, "lineitem"), ["l_returnflag"], "l_extendedprice")


@query("select l_orderkey, l_linenumber, round_even(l_quantity / 2, 0)::int half from lineitem")
def q14_half_even(spark, sf):
    return t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", geometry.half_even(F.col("l_quantity") / 2).alias("half"))


@query("select l_returnflag, regr_slope(l_extendedprice, l_quantity) slope, regr_intercept(l_extendedprice, l_quantity) intercept, regr_r2(l_extendedprice, l_quantity) r2 from lineitem group by 1")
def q15_ols_single(spark, sf):
    return fit.ols_single(t(spark, sf, "lineitem"), ["l_returnflag"], "l_quantity", "l_extendedprice")


_G = ["l_quantity", "l_discount", "l_tax", "l_linenumber", "l_extendedprice"]


@query("select count(*) n, " + ", ".join([f"sum({a}::double) {a}_1" for a in _G] + [f"sum({a}::double * {b}) {a}_{b}" for i, a in enumerate(_G) for b in _G[i:]]) + " from lineitem")
def q16_ols_gram(spark, sf):
    return fit.gram(t(spark, sf, "lineitem"), _G[:-1], _G[-1:])


@query("""
with m as (select avg(l_quantity) mx, avg(l_discount) mz, avg(l_extendedprice) my from lineitem),
s as (select sum((l_quantity - mx) ^ 2) xx, sum((l_discount - mz) ^ 2) zz, sum((l_quantity - mx) * (l_discount - mz)) xz,
  sum((l_quantity - mx) * (l_extendedprice - my)) xy, sum((l_discount - mz) * (l_extendedprice - my)) zy, any_value(mx) mx, any_value(mz) mz, any_value(my) my from lineitem, m),
w as (select (xy * zz - zy * xz) / (xx * zz - xz * xz) a, (zy * xx - xy * xz) / (xx * zz - xz * xz) b, mx, mz, my from s)
select round(a, 4) w_quantity, round(b, 2) w_discount, round(my - a * mx - b * mz, 2) intercept from w
""")
def q17_ols_multi(spark, sf):
    model = fit.ols(t(spark, sf, "lineitem"), ["l_quantity", "l_discount"], ["l_extendedprice"])
    (a,), (b,), (c,) = model["coef"]
    return spark.createDataFrame([(round(a, 4), round(b, 2), round(c, 2))], "w_quantity double, w_discount double, intercept double")


@query("""
select l_returnflag, count(*) n, avg(l_discount * 10) mean, min(l_discount * 10) least, quantile_cont(l_discount * 10, 0.1) p10, quantile_cont(l_discount * 10, 0.5) median,
  quantile_cont(l_discount * 10, 0.9) p90, avg((l_discount * 10 < 0.25)::int::double) below, avg((l_discount * 10 >= 0.75)::int::double) above from lineitem group by 1
""")
def q18_fit_quality(spark, sf):
    return stats.fit_quality(t(spark, sf, "lineitem").withColumn("iou", F.col("l_discount") * 10), ["l_returnflag"], "iou", 0.25, 0.75)


@query("""
with recursive z as (select label, vec_id, embedding::double[] v, row_number() over (partition by label order by vec_id) rk from embeddings),
c as (select *, list_transform(v, lambda x: x - list_avg(v)) u from z),
g as (select label, rk, [u] kept, vec_id, 'ok' status from c where rk = 1
  union all
  select c.label, c.rk, case when len(list_filter(g.kept, lambda k: list_cosine_similarity(k, c.u) > 0.2)) = 0 then list_append(g.kept, c.u) else g.kept end, c.vec_id,
    case when len(list_filter(g.kept, lambda k: list_cosine_similarity(k, c.u) > 0.2)) = 0 then 'ok' else 'dropped' end
  from g join c on c.label = g.label and c.rk = g.rk + 1)
select label, vec_id, status from g
""")
def q19_greedy_dedup(spark, sf):
    e = t(spark, sf, "embeddings")
    return dedup.greedy(dedup.ordered(e, ["label"], [F.col("vec_id")]), ["label"], "rank", "embedding", 0.2, ["vec_id"])


@query("""
select a.label, a.vec_id lo, b.vec_id hi, list_inner_product(a.embedding::double[], b.embedding::double[]) sim
from embeddings a join embeddings b on a.label = b.label and a.vec_id < b.vec_id
""")
def q20_pair_similarity(spark, sf):
    return dedup.pair_products(t(spark, sf, "embeddings"), ["label"], "vec_id", "embedding")


@query("select doc_id, lang from documents where doc_id not in (select doc_id from labels)")
def q21_anti_join(spark, sf):
    return diff.restore_plan(t(spark, sf, "documents").select("doc_id", "lang"), t(spark, sf, "labels"), ["doc_id"])


@query("select doc_id, lang from documents where doc_id in (select doc_id from labels)")
def q22_semi_join(spark, sf):
    return incremental.covered(t(spark, sf, "documents").select("doc_id", "lang"), t(spark, sf, "labels"), ["doc_id"])


@query("""
select o.o_orderkey, case when f.o_orderkey is not null then 'fresh' else 'previous' end origin, coalesce(f.price, p.price) price
from orders o left join (select o_orderkey, o_totalprice * 2 price from orders where o_orderkey % 3 = 0) f on f.o_orderkey = o.o_orderkey
left join (select o_orderkey, o_totalprice price from orders where o_orderkey % 2 = 0) p on p.o_orderkey = o.o_orderkey where coalesce(f.price, p.price) is not null
""")
def q23_upsert_merge(spark, sf):
    o = t(spark, sf, "orders")
    fresh = o.where("o_orderkey % 3 = 0").select("o_orderkey", (F.col("o_totalprice") * 2).alias("price"))
    old = o.where("o_orderkey % 2 = 0").select("o_orderkey", F.col("o_totalprice").alias("price"))
    return merge.upsert(o.select("o_orderkey"), fresh, old, ["o_orderkey"], ["price"])


@query("""
with now as (select o_custkey c, list_sort(list(o_orderkey::varchar)) k from orders where o_orderkey % 5 <> 0 group by 1),
old as (select o_custkey c, list_sort(list(o_orderkey::varchar)) k, list({'a': o_orderkey::varchar, 't': case when o_totalprice > 30000 then 0.95 else 0.5 end}) b from orders where o_orderkey % 6 <> 0 group by 1)
select now.c as character, case when old.c is null then 'new' when now.k <> old.k and len(list_filter(b, lambda x: x.t < 0.9 or not list_contains(now.k, x.a))) > 0 then 'rematch' else 'kept' end status
from now left join old on now.c = old.c
""")
def q24_rematch_plan(spark, sf):
    o = t(spark, sf, "orders").withColumn("k", F.col("o_orderkey").cast("string"))
    now = o.where("o_orderkey % 5 <> 0").groupBy(F.col("o_custkey").alias("character")).agg(F.array_sort(F.collect_list("k")).alias("candidates"))
    base = F.struct(F.col("k").alias("avatar"), F.when(F.col("o_totalprice") > 30000, 0.95).otherwise(0.5).alias("threshold"), F.lit(None).cast("string").alias("error"))
    old = o.where("o_orderkey % 6 <> 0").groupBy(F.col("o_custkey").alias("character")).agg(F.array_sort(F.collect_list("k")).alias("candidates"), F.collect_list(base).alias("bases"))
    return incremental.rematch(now, old)


@query("""
select o.o_orderkey rel, o.o_custkey size from orders o left join (select o_orderkey, case when o_orderkey % 13 = 0 then o_custkey + 1 else o_custkey end s from orders where o_orderkey % 4 <> 0) m
on m.o_orderkey = o.o_orderkey where m.s is null or m.s <> o.o_custkey or o.o_orderkey % 9 = 0
""")
def q25_incremental_skip(spark, sf):
    o = t(spark, sf, "orders")
    listing = o.select(F.col("o_orderkey").alias("rel"), F.col("o_custkey").alias("size"), F.lit(None).cast("string").alias("sha256"))
    size = F.when(F.col("o_orderkey") % 13 == 0, F.col("o_custkey") + 1).otherwise(F.col("o_custkey"))
    manifest = o.where("o_orderkey % 4 <> 0").select(F.col("o_orderkey").alias("rel"), size.alias("size"), F.lit("x").alias("sha256"))
    existing = o.where("o_orderkey % 9 <> 0").select(F.col("o_orderkey").alias("rel"))
    return incremental.fetch_todo(listing, manifest, existing).select("rel", "size")


_CLASSIFIED = "p_brand character, case when p_size % 7 = 0 then null else 'B' || (p_size % 5) end base, case when p_partkey % 3 = 0 or p_size % 7 = 0 then null else p_name || '_' || p_partkey end diff"


def _classified(spark, sf):
    p = t(spark, sf, "part")
    none = F.lit(None).cast("string")
    base = F.when(F.col("p_size") % 7 == 0, none).otherwise(F.concat(F.lit("B"), F.col("p_size") % 5))
    d = F.when((F.col("p_partkey") % 3 == 0) | (F.col("p_size") % 7 == 0), none).otherwise(F.concat_ws("_", "p_name", "p_partkey"))
    return p.select(F.col("p_brand").alias("character"), base.alias("base"), d.alias("diff"))


@query(f"""
with c as (select {_CLASSIFIED} from part)
select * from c where lower(character) not in ('brand#1', 'brand#12') and not (lower(character) = 'brand#2' and coalesce(lower(base), '') = 'b1') and not (lower(character) = 'brand#3' and coalesce(lower(base), '') = 'b2')
""")
def q26_skip_filter(spark, sf):
    skips = spark.createDataFrame([("brand#1", "x"), (" Brand#12 ", "x"), ("Brand#2/B1.png", "x"), ("BRAND#3/b2", "y")], "key string, reason string")
    return skip.filtered(_classified(spark, sf), skips)


@query(f"""
with c as (select {_CLASSIFIED} from part),
s as (select * from (values ('Brand#2', 'B1'), ('Brand#3', 'b2'), ('Brand#4', 'alone'), ('Nobody', 'x')) v(character, sprite)),
m as (select s.character, coalesce(c.base, s.sprite) sprite, c.diff from s left join c on lower(c.character) = lower(s.character) and lower(c.base) = lower(s.sprite))
select character, sprite from m union select character, regexp_replace(diff, '\\.[^.]*$', '') from m where diff is not null
""")
def q27_skip_expand(spark, sf):
    skips = spark.createDataFrame([("Brand#2/B1.png", "x"), ("Brand#3/b2", "x"), ("Brand#4/alone.png", "x"), ("Nobody/x", "y")], "key string, reason string")
    return skip.expanded(_classified(spark, sf), skips)


@query("""
with l as (select o_orderkey k, o_custkey v from orders where o_orderkey % 7 <> 0),
r as (select o_orderkey k, case when o_orderkey % 11 = 0 then o_custkey + 1 else o_custkey end v from orders where o_orderkey % 5 <> 0)
select coalesce(l.k, r.k) rel, case when r.k is null then 'copy' when l.k is null then 'delete' when l.v = r.v then 'keep' else 'copy' end as action, (coalesce(l.k, r.k) % 100 = 0)::int ord
from l full join r on l.k = r.k
""")
def q28_mirror_plan(spark, sf):
    o = t(spark, sf, "orders")
    local = o.where("o_orderkey % 7 <> 0").select(F.col("o_orderkey").alias("rel"), F.col("o_custkey").alias("v"))
    remote = o.where("o_orderkey % 5 <> 0").select(F.col("o_orderkey").alias("rel"), F.when(F.col("o_orderkey") % 11 == 0, F.col("o_custkey") + 1).otherwise(F.col("o_custkey")).alias("v"))
    return diff.mirror_plan(local, remote, ["rel"], F.col("l.v") == F.col("r.v"), F.col("rel") % 100 == 0).orderBy("ord", "rel")


@query("select o_custkey from orders where o_orderstatus = 'F' intersect select o_custkey from orders where o_totalprice > 100000 intersect select o_custkey from orders where o_orderpriority like '1%'")
def q29_three_way_intersect(spark, sf):
    o = t(spark, sf, "orders")
    return diff.key_intersection(o.where("o_orderstatus = 'F'"), o.where("o_totalprice > 100000"), o.where("o_orderpriority like '1%'"), keys=["o_custkey"])


@query("""
select c_custkey from customer where c_custkey not in (select o_custkey from orders)
union all select c_custkey from customer where c_custkey in (select o_custkey from orders group by 1 having max(o_totalprice) < 250000)
""")
def q30_unmatched_pool(spark, sf):
    c, o = t(spark, sf, "customer").select("c_custkey"), t(spark, sf, "orders").withColumnRenamed("o_custkey", "c_custkey")
    return merge.unmatched_pool(c, o, ["c_custkey"], "o_totalprice", 250000)


@query("""
with a as (select distinct o_custkey k from orders where o_totalprice > 200000), b as (select distinct o_custkey k from orders where o_orderstatus = 'O')
select 'difference' op, k from (select k from a except select k from b) union all select 'intersection', k from (select k from a intersect select k from b) union all select 'union', k from (select k from a union select k from b)
""")
def q31_set_ops(spark, sf):
    o = t(spark, sf, "orders").withColumnRenamed("o_custkey", "k")
    a, b = o.where("o_totalprice > 200000"), o.where("o_orderstatus = 'O'")
    parts = [("difference", diff.key_difference(a, b, ["k"])), ("intersection", diff.key_intersection(a, b, keys=["k"])), ("union", diff.key_union(a, b, ["k"]))]
    out = None
    for name, df in parts:
        df = df.select(F.lit(name).alias("op"), "k")
        out = df if out is None else out.unionByName(df)
    return out


@query("""
with m as (select p_type, min(p_name) lo, max(p_name) hi from part group by 1)
select p_type, lo[1:list_max(list_filter(range(0, least(len(lo), len(hi)) + 1), lambda i: lo[1:i] = hi[1:i]))] prefix from m
""")
def q32_common_prefix(spark, sf):
    return stats.prefix_of_group(t(spark, sf, "part"), ["p_type"], "p_name")


_NAME = "case p_partkey % 5 when 0 then 'avg_' || p_partkey || '_' || p_name || '_1' when 1 then 'char_' || p_partkey || '_' || p_name || '#' || p_size when 2 then 'npc_' || p_name || '$' || p_size when 3 then 'Avg_' || p_partkey || '_x.png.PNG' else p_name end"


@query(f"""
with n as (select p_partkey, {_NAME} s from part)
select p_partkey, regexp_matches(s, '(?i)^avg_[0-9]+_.+|^char_[0-9]+_.*') matchable, nullif(regexp_extract(s, '(?i)^(?:avg|char)_([0-9]+)_', 1), '') id,
  lower(s) like 'avg\\_%' escape '\\' or lower(s) like 'char\\_%' escape '\\' or lower(s) like 'avgnew\\_%' escape '\\' or lower(s) like 'npc\\_%' escape '\\' as like_id,
  regexp_replace(s, '_[0-9]+$', '') bare, regexp_replace(s, '(?i)(\\.png)+$', '') no_png, coalesce(nullif(regexp_extract(s, '\\$([0-9]+)$', 1), '')::int, -1) dollar,
  case when regexp_matches(s, '\\$[0-9]+$') then true when regexp_extract(s, '[#_]([0-9]+)$', 1) <> '' then regexp_extract(s, '[#_]([0-9]+)$', 1) = '1' else true end first_seq from n
""")
def q33_name_parse(spark, sf):
    n = t(spark, sf, "part").select("p_partkey", F.expr(_NAME).alias("s"))
    return n.select(
        "p_partkey", names.matchable("s").alias("matchable"), names.numeric_id("s").alias("id"), names.has_id_prefix("s").alias("like_id"), names.without_variant("s").alias("bare"),
        names.without_png("s").alias("no_png"), F.coalesce(names.dollar_number("s"), F.lit(-1)).alias("dollar"), names.first_in_sequence("s").alias("first_seq"),
    )


@query("select doc_id, source, ((row_number() over (partition by source order by doc_id) - 1) % 3)::int grid_col, ((row_number() over (partition by source order by doc_id) - 1) // 3)::int grid_row from documents")
def q34_grid_layout(spark, sf):
    return rank.grid(t(spark, sf, "documents").select("doc_id", "source"), ["source"], ["doc_id"], 3)


@query("""
select user_id, event_id, value from (select *, coalesce(sum((value > 50)::int) over (partition by user_id order by event_id rows between unbounded preceding and 1 preceding), 0) n from events) where n < 5
""")
def q35_take_until_n(spark, sf):
    return rank.take_until(t(spark, sf, "events").select("user_id", "event_id", "value"), ["user_id"], ["event_id"], F.col("value") > 50, 5)


@query("""
select p_partkey, case when row_number() over (partition by lower(p_name) order by p_partkey) = 1 then p_name else p_brand || '_' || p_name end target from part
""")
def q36_rename_collision(spark, sf):
    return rank.rename_collisions(t(spark, sf, "part").select("p_partkey", "p_name", "p_brand"), "p_name", "p_brand", ["p_partkey"]).select("p_partkey", "target")


@query("select o_orderkey from orders order by md5('42' || o_orderkey::varchar), o_orderkey limit 100")
def q37_seeded_sample(spark, sf):
    return rank.hash_sample(t(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 100, "42")


@query("""
with c as (select user_id, event_type, count(*) n from events group by all)
select user_id, '{' || string_agg('"' || event_type || '":{"n":' || n || '}', ',' order by event_type) || '}' doc from c group by 1
""")
def q38_nested_report(spark, sf):
    from ..sources.sinks import nested

    c = t(spark, sf, "events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    return nested(c, "user_id", "event_type", ["n"])


@query("select event_id, json_extract_string(props, '$.k')::bigint k from events")
def q39_json_explode(spark, sf):
    from ..sources.tables import json_field

    return t(spark, sf, "events").select("event_id", json_field("props", "k", "bigint").alias("k"))


@query("select doc_id, sha256(text) sha256, length(text)::int size from documents")
def q40_content_hash(spark, sf):
    return t(spark, sf, "documents").select("doc_id", names.digest("text").alias("sha256"), F.length("text").alias("size"))


@query("""
select source, count(*) total, count(*) filter (quality is null)::bigint failed, count(*) filter (quality = 1)::bigint detected, count(*) filter (quality is not null and quality <> 1)::bigint undetected
from documents d left join labels l on l.doc_id = d.doc_id group by 1
""")
def q41_stats_counts(spark, sf):
    d = t(spark, sf, "documents").select("doc_id", "source").join(t(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
    marked = d.select("source", F.when(F.col("quality").isNull(), "no label").alias("error"), (F.col("quality") == 1).alias("detected"))
    return stats.detection_counts(marked, ["source"])


@query("""
with p as (select l_orderkey, l_linenumber, 0.5 * l_quantity + 2 * l_discount + 3 cx, 0.25 * l_quantity - 1 cy, 2 * l_quantity + 10 * l_tax + 4 s from lineitem)
select l_orderkey, l_linenumber, round_even(cx - s / 2, 0)::int x1, round_even(cy - s / 2, 0)::int y1, round_even(cx + s / 2, 0)::int x2, round_even(cy + s / 2, 0)::int y2 from p
""")
def q42_linear_predict(spark, sf):
    xs = ["l_quantity", "l_discount", "l_tax"]
    cx, cy, s = geometry.linear(xs, [0.5, 2, 0, 3]), geometry.linear(xs, [0.25, 0, 0, -1]), geometry.linear(xs, [2, 0, 10, 4])
    return t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *[v.alias(n) for n, v in zip(("x1", "y1", "x2", "y2"), geometry.square_box(cx, cy, s), strict=True)])


@query("""
select o_orderstatus, sha256('[' || string_agg('{"o_orderkey":' || o_orderkey || ',"o_custkey":' || o_custkey || '}', ',' order by o_orderkey) || ']') digest from orders group by 1
""")
def q43_idempotent_hash(spark, sf):
    o = t(spark, sf, "orders").select("o_orderstatus", "o_orderkey", "o_custkey", "o_orderdate")
    return incremental.payload_hash(o, ["o_orderstatus"], ["o_orderdate"], ["o_orderkey"])


@query("""
with r as (select user_id, event_id, value, row_number() over (partition by user_id order by value, event_id) - 1 i, count(*) over (partition by user_id) n from events)
select user_id, event_id from r where i in (select (j * (n - 1)) // 4 from range(5) k(j))
""")
def q44_evenly_spaced(spark, sf):
    return rank.evenly_spaced(t(spark, sf, "events").select("user_id", "event_id", "value"), ["user_id"], ["value", "event_id"], 5).select("user_id", "event_id")


@query("""
select n_nationkey, n_name, coalesce(c, 0)::bigint customers, coalesce(s, 0)::bigint suppliers from nation
left join (select c_nationkey k, count(*) c from customer group by 1) on k = n_nationkey left join (select s_nationkey j, count(*) s from supplier group by 1) on j = n_nationkey
""")
def q45_zero_filled(spark, sf):
    c = t(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("customers"))
    s = t(spark, sf, "supplier").groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("suppliers"))
    both = merge.zero_filled(c, s, ["n_nationkey"], ["customers", "suppliers"])
    out = t(spark, sf, "nation").select("n_nationkey", "n_name").join(both, "n_nationkey", "left")
    return out.select("n_nationkey", "n_name", *[F.coalesce(x, F.lit(0)).alias(x) for x in ("customers", "suppliers")])


@query(r"""
select page_id, regexp_extract(url, '[^/]+$', 0) name, regexp_matches(url, '(?s)^(?:http://.*)$') or regexp_matches(url, '(?s)^(?:http://.*/.*)$') excluded,
  regexp_replace(url, '\.{2,}', '.', 'g') folded, translate(url, '$#', '__') safe from pages
""")
def q46_path_functions(spark, sf):
    return t(spark, sf, "pages").select(
        "page_id", names.base_name("url").alias("name"), names.excluded("url", ["http://*"]).alias("excluded"), names.fold_dots("url").alias("folded"), names.safe_file("url").alias("safe")
    )


@query("select l_returnflag, bool_or(l_quantity > 49) any_large, bool_and(l_quantity > 0) all_positive from lineitem group by 1")
def q47_flags(spark, sf):
    return stats.flags(t(spark, sf, "lineitem"), ["l_returnflag"], {"any_large": F.col("l_quantity") > 49}, {"all_positive": F.col("l_quantity") > 0})


@query("select lang as key, list_sort(list(distinct source)) items from documents group by 1")
def q48_index(spark, sf):
    return stats.indexed(t(spark, sf, "documents").withColumnRenamed("lang", "key"), "key", "source")


@query("""
with items as (select l_orderkey, l_linenumber, case when l_shipdate < timestamp '1995-01-01' then 'dropped' when l_discount = 0 then 'no_box' else 'ok' end status from lineitem)
select l_orderkey, l_linenumber from items where l_linenumber <= 4 and (l_orderkey, l_linenumber) in (select (l_orderkey, l_linenumber) from items where status <> 'ok')
""")
def q49_stale_outputs(spark, sf):
    status = F.when(F.col("l_shipdate") < F.lit("1995-01-01").cast("timestamp_ntz"), "dropped").when(F.col("l_discount") == 0, "no_box").otherwise("ok")
    items = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", status.alias("status"))
    return tiers.stale(items, items.where("l_linenumber <= 4").select("l_orderkey", "l_linenumber"), ["l_orderkey", "l_linenumber"])


@query("""
with i as (select o_orderkey k, o_custkey f from orders), c as (select o_orderkey k, case when o_orderkey % 3 = 0 then o_custkey + 1 else o_custkey end f, o_totalprice v from orders where o_orderkey % 2 = 0)
select i.k, i.f, c.v is not null as hit, c.v from i left join c on c.k = i.k and c.f = i.f
""")
def q50_cache_lookup(spark, sf):
    o = t(spark, sf, "orders")
    items = o.select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("f"))
    cache = o.where("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("k"), F.when(F.col("o_orderkey") % 3 == 0, F.col("o_custkey") + 1).otherwise(F.col("o_custkey")).alias("f"), F.col("o_totalprice").alias("v"))
    return incremental.cached(items, cache, ["k"], ["f"], ["v"])
