"""Mixing sources to target weights by Pfair scheduling, with DataFrame operations only.

A source's documents are put in the order of a hash of their id and cut into blocks of ``block_docs``.
With exact weights c_s / L (integers; L is their sum), block i of source s is
released at floor((i-1) * L / c_s) and due at ceil(i * L / c_s); at every slot the released block with
the earliest deadline runs. Since the weights sum to one, every deadline is met, so after any number
of slots each source is less than one block from its share of the weights as given. The schedule repeats every L slots: it
is computed once for L slots, or for as many as the blocks need if that is less, and a document's slot follows from its rank by arithmetic. Ranks come from counts by hash
range and a window inside each range, so a source with a third of all rows is no one task's work.

Weights that are given count as the decimal numbers they are written as, over the sources that have documents. Weight 0 means never, and so does
leaving a source out: its documents stay, with rank and block but without a slot, and out of the mix. Without weights the targets are whole parts of
``period`` (16 for each source, if that is more), in proportion to the roots of the sources' counts, one part at least.

``in_mix`` tells slots before the first one that some source can no longer fill: there the deviation
bound holds. Later slots keep the remaining sources in proportion; nothing is dropped or repeated.

Edge cases: documents of a null source form a source of their own (its weight is that of None); rows with null or equal ids are ranked
in some order, side by side, and all kept; an empty table gives an empty result; more than ``MAX_SOURCES`` sources
are refused, for the schedule is made by one task; columns named like the result's give way.
"""

from __future__ import annotations

import math
from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, materialise, table

BLOCK_DOCS, PERIOD, RANGE_ROWS, MAX_SOURCES = 32, 1000, 2048, 4000

#: Slots of a job, in STEP arrays of STEP_SLOTS, for schedules that are longer.
STEP, STEP_SLOTS = 16, 4096

#: The slots of a stretch from {start} on, given the next block of each source; and the next blocks after it.
_STRETCH = """
aggregate(sequence({start}, {end} - 1L),
  named_struct('next', {next}, 'out', cast(array() as array<int>)),
  (a, t) -> element_at(transform(
    array(array_min(transform(quotas, (q, s) -> named_struct(
      'due', case when ((a.next[s] - 1L) * total) div q <= t then (a.next[s] * total + q - 1L) div q else 9223372036854775807L end,
      'source', s))).source),
    p -> named_struct('next', transform(a.next, (x, s) -> if(s = p, x + 1L, x)), 'out', concat(a.out, array(p)))), 1))
"""
_SCHEDULE = f"""
aggregate(sequence({{start}}, {{end}} - 1L, {STEP_SLOTS}L),
  named_struct('next', {{next}}, 'out', cast(array() as array<array<int>>)),
  (b, u) -> element_at(transform(array({_STRETCH.format(start="u", end=f"least(u + {STEP_SLOTS}L, {{end}})", next="b.next")}),
    d -> named_struct('next', d.next, 'out', concat(b.out, array(d.out)))), 1))
"""


def whole_weights(weights: dict[str | None, float], present: list[str]) -> dict[str, int]:
    """Integers in the exact proportion of the weights, as written, for the keys of the sources that have documents and a weight above 0."""
    if any(v < 0 for v in weights.values()):
        raise ValueError("weights must not be negative")
    exact = {("0" if k is None else f"1{k}"): Fraction(str(v)) for k, v in weights.items() if v > 0}
    exact = {k: v for k, v in exact.items() if k in present}
    scale = math.lcm(*(v.denominator for v in exact.values())) if exact else 1
    whole = {k: int(v * scale) for k, v in exact.items()}
    common = math.gcd(*whole.values()) or 1
    return {k: v // common for k, v in whole.items()}


def quotas(counts: DataFrame, weights: dict[str, int] | None = None, period: int = PERIOD) -> DataFrame:
    """(skey, n, c): weights as integers; without any, parts of the period in proportion to the roots of the counts."""
    if weights is not None:
        given = F.create_map(*[F.lit(x) for k, v in weights.items() for x in (k, v)]) if weights else F.expr("cast(map() as map<string,bigint>)")
        return counts.withColumn("c", given[F.col("skey")].cast("long")).where("c is not null").select("skey", "n", "c")
    every = Window.partitionBy(F.lit(0))
    root = counts.withColumn("r", F.floor(F.sqrt(F.col("n").cast("double")) * 1000).cast("long"))
    root = root.withColumn("s", F.sum("r").over(every)).withColumn("k", F.count(F.lit(1)).over(every))
    return root.select("skey", "n", F.expr(f"greatest(1L, (greatest({int(period)}L, 16L * k) * r) div greatest(s, 1L))").alias("c"))


def schedule(q: DataFrame, slots: int | None = None) -> DataFrame:
    """(skey, c, total, i, at): the slot of every source's i-th block, from 0, in the first slots of a period (all of them by default)."""
    packed = q.agg(F.array_sort(F.collect_list(F.struct("skey", "c"))).alias("all"), F.sum("c").alias("total")).where("size(all) > 0")
    packed = packed.select("all", "total", F.expr("transform(all, x -> x.c)").alias("quotas"))
    most = STEP * STEP_SLOTS
    last = "total" if slots is None else f"least(total, {int(slots)}L)"
    if slots is None or slots <= most:
        parts = packed.withColumn("out", F.expr(_SCHEDULE.format(start="0L", end=last, next="transform(quotas, x -> 1L)") + ".out")).withColumn("start", F.lit(0).cast("long"))
    else:  # one job after the other; the next blocks of all sources pass between them
        parts, after = None, "transform(quotas, x -> 1L)"
        packed = materialise(packed)
        for start in range(0, slots, most):
            end = f"least({last}, {start + most}L)"
            made = materialise(packed.where(f"{end} > {start}").withColumn("made", F.expr(_SCHEDULE.format(start=f"{start}L", end=end, next=after))).withColumn("start", F.lit(start).cast("long")))
            if (row := made.select("made.next").first()) is None:
                break
            after = f"array({', '.join(f'{x}L' for x in row['next'])})"
            made = made.select("all", "total", "quotas", F.col("made.out").alias("out"), "start")
            parts = made if parts is None else parts.unionByName(made)
    slot = parts.select("all", "total", "start", F.posexplode(F.flatten("out")).alias("at", "p")).select(F.expr("all[p].skey").alias("skey"), F.expr("all[p].c").alias("c"), "total", (F.col("start") + F.col("at")).alias("at"))
    order = Window.partitionBy("skey").orderBy("at")
    return slot.select("skey", "c", "total", (F.row_number().over(order) - 1).cast("long").alias("i"), F.col("at").cast("long").alias("at"))


def mix(docs: DataFrame, weights: dict[str, float] | None = None, block_docs: int = BLOCK_DOCS, period: int = PERIOD, id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """docs with rank (within the source, from 0), block, slot and in_mix; sort by slot, rank to read the mixture."""
    keyed = docs.withColumns(
        {
            "_t_skey": F.coalesce(F.concat(F.lit("1"), F.col(source_col)), F.lit("0")),
            "_t_hash": F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")),
        }
    )
    slim = keyed.select("_t_skey", "_t_hash")
    counts = slim.groupBy(F.col("_t_skey").alias("skey")).agg(F.count(F.lit(1)).alias("n"))
    seen = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("k")).first()
    if seen["k"] > MAX_SOURCES:
        raise ValueError(f"{seen['k']} sources; at most {MAX_SOURCES} can be scheduled")
    digits = 1
    while 16**digits * RANGE_ROWS < seen["n"]:
        digits += 1
    span = F.substring("_t_hash", 1, digits)
    ranges = slim.groupBy("_t_skey", span.alias("_t_range")).agg(F.count(F.lit(1)).alias("_t_n"))
    before = Window.partitionBy("_t_skey").orderBy("_t_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("_t_skey", "_t_range", F.coalesce(F.sum("_t_n").over(before), F.lit(0)).alias("_t_base"))

    whole, slots = None, None
    if weights is not None:
        present = {r["skey"]: r["n"] for r in counts.collect()}  # at most MAX_SOURCES rows
        whole = whole_weights(weights, list(present))
        blocks = {k: -(-present[k] // block_docs) for k in whole}
        slots = max((-(-(blocks[k] + 1) * sum(whole.values()) // c) for k, c in whole.items()), default=0)
    q = quotas(counts, whole, period)
    plan = schedule(q, slots)
    # the first block that each source lacks; before the earliest of their slots every source still delivers
    lacks = q.select("skey", F.ceil(F.col("n") / F.lit(block_docs)).cast("long").alias("nb"), F.col("c").alias("qc"))
    horizon = plan.join(lacks, "skey").where("i = nb % qc").agg(F.min(F.expr("(nb div qc) * total + at")).alias("_t_horizon"))
    # one row a slot of the period
    plan = plan.crossJoin(horizon).select(F.col("skey").alias("_t_skey"), F.col("i").alias("_t_i"), F.col("at").alias("_t_at"), F.col("total").alias("_t_total"), "_t_horizon")
    sizes = q.select(F.col("skey").alias("_t_skey"), F.col("c").alias("_t_c"))  # at most MAX_SOURCES rows

    ranked = keyed.withColumn("_t_range", span).join(ranges, ["_t_skey", "_t_range"])
    place = Window.partitionBy("_t_skey", "_t_range").orderBy("_t_hash", F.col(id_col))
    ranked = ranked.withColumn("_t_rank", F.col("_t_base") + F.row_number().over(place) - 1)
    ranked = ranked.withColumn("_t_block", F.expr(f"_t_rank div {int(block_docs)}"))
    how = "inner" if weights is None else "left"
    ranked = ranked.join(F.broadcast(sizes), "_t_skey", how).withColumn("_t_i", F.expr("_t_block % _t_c"))
    plan = F.broadcast(plan) if slots is None or slots <= BROADCAST_ROWS else plan
    out = ranked.join(plan, ["_t_skey", "_t_i"], how).withColumn("_t_slot", F.expr("(_t_block div _t_c) * _t_total + _t_at"))
    kept = [c for c in docs.columns if c not in ("rank", "block", "slot", "in_mix")]  # columns of those names give way
    return out.select(*kept, *[F.col(f"_t_{c}").alias(c) for c in ("rank", "block", "slot")], F.expr("coalesce(_t_slot < _t_horizon, false)").alias("in_mix"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents").select("doc_id", "source"))


ORACLE_SQL = f"""
with recursive n as (select coalesce('1' || source, '0') skey, count(*) n from documents group by 1),
r as (select *, floor(sqrt(n::double) * 1000)::bigint r from n),
q as (select skey, n, greatest(1, (greatest({PERIOD}, 16 * count(*) over ()) * r) // (sum(r) over ())::bigint)::bigint c, row_number() over (order by skey) k from r),
z as (select list(c order by k) q, sum(c)::bigint total from q),
e(t, nxt, p) as (
  select -1::bigint, list_transform(q, lambda x: 1::bigint), 0::bigint from z
  union all
  select t, list_transform(nxt, lambda x, i: case when i = p then x + 1 else x end), p from (
    select e.t + 1 as t, e.nxt, list_min(list_transform(range(1, len(z.q) + 1), lambda s:
      case when ((e.nxt[s] - 1) * z.total) // z.q[s] <= e.t + 1 then ((e.nxt[s] * z.total + z.q[s] - 1) // z.q[s]) * 100000 + s else 9000000000000000000 end)) % 100000 as p
    from e, z where e.t + 1 < z.total)),
plan as (select q.skey, q.c, q.n, e.t as at_slot, row_number() over (partition by p order by t) - 1 as i from e join q on q.k = e.p where e.t >= 0),
h as (select min(((n + {BLOCK_DOCS - 1}) // {BLOCK_DOCS}) // c * (select total from z) + at_slot) horizon from plan where i = ((n + {BLOCK_DOCS - 1}) // {BLOCK_DOCS}) % c),
d as (select doc_id, source, coalesce('1' || source, '0') skey, row_number() over (partition by source order by md5(coalesce(doc_id::varchar, '')), doc_id) - 1 as rank from documents),
b as (select d.*, d.rank // {BLOCK_DOCS} as block from d)
select doc_id, source, rank, block, (block // c) * (select total from z) + at_slot as slot,
  (block // c) * (select total from z) + at_slot < (select horizon from h) as in_mix
from b join plan on plan.skey = b.skey and plan.i = b.block % plan.c
"""
