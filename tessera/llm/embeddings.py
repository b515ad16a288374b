"""Near-duplicate vectors by an inverted multi-index: product grid, multi-sequence traversal, exact check.

Equal vectors of a label form a class; the index holds classes. Unit vectors are halved, each half has a
codebook of its own (k-means on ``FIT_ROWS`` vectors, up to ``MAX_FIT`` where the codes grow with the data, taken in the order of a hash), and every class lies in
one cell of the grid (label, code of the first half, code of the second). Each class probes the grid by
multi-sequence traversal: cells in rising order of the sum of the halves' lower bounds on the squared
distance to the cell, until that sum exceeds ``reach`` times the squared distance of the threshold. With reach 1 the bound
proves that no partner is left (recall 1); a smaller one visits fewer cells. It is fitted to ``TARGET_RECALL`` on linked pairs
that brute force finds for ``FIT_QUERIES`` classes against all rows. Members of visited cells are verified by cosine in double precision.

Cells and their probes are cut into blocks, so a cell of any size is many tasks' work; a block pair returns
sums of links and a spanning forest, never all pairs. Edge cases: null, empty and zero vectors, vectors with
null or non-finite components and those with a null label or id have no link, form their own component
and are kept (a null id gives a null component); vectors of different lengths never link; repeated rows
are each reported and count as each other's links; ties need no rule; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, materialise, small, table

COSINE, FIT_ROWS, MAX_FIT, FIT_QUERIES, FIT_PAIRS, CELL_ROWS, BLOCK_ROWS, TARGET_RECALL = 0.98, 8192, 65_536, 512, 5000, 24, 256, 0.998


def unit_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id, label, unit (little-endian doubles; null if the row cannot link)."""

    def run(batches):
        for batch in batches:
            out = []
            for v, label, vid in zip(batch.column("embedding").to_pylist(), batch.column("label").to_pylist(), batch.column("vec_id").to_pylist(), strict=True):
                unit = None
                if v and label is not None and vid is not None and not any(x is None for x in v):
                    a = np.array(v, np.float64)
                    top = np.abs(a).max()
                    if np.isfinite(top) and top > 0:
                        a = a / top  # neither squares nor their sum leave the range
                        unit = (a / np.sqrt(a @ a)).astype("<f8").tobytes()
                out.append(unit)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(out, pa.binary())], names=["vec_id", "label", "unit"])

    return vectors.mapInArrow(run, "vec_id long, label long, unit binary")


class Grid:
    """Two codebooks per vector length and the bounds of the traversal."""

    def __init__(self, sample: list[np.ndarray], codes: int, cosine: float = COSINE, reach: float = 1.0):
        self.limit = reach * (2 - 2 * cosine) + 1e-9
        self.books: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for d in sorted({len(v) for v in sample}):
            own = np.stack([v for v in sample if len(v) == d])
            self.books[d] = kmeans(own[:, : d // 2], codes, 1), kmeans(own[:, d // 2 :], codes, 2)

    def _books(self, d: int) -> tuple[np.ndarray, np.ndarray]:
        # a length that the sample missed has one cell
        return self.books.get(d) or (np.zeros((1, d // 2)), np.zeros((1, d - d // 2)))

    def halves(self, v: np.ndarray):
        a, b = self._books(len(v))
        return (a, v[: len(v) // 2]), (b, v[len(v) // 2 :])

    def cell(self, v: np.ndarray) -> tuple[int, int]:
        (a, x), (b, y) = self.halves(v)
        return int(((a - x) ** 2).sum(1).argmin()), int(((b - y) ** 2).sum(1).argmin())

    def probes(self, v: np.ndarray) -> list[tuple[int, int]]:
        """Cells in rising order of their bound, by multi-sequence traversal of the two sorted halves."""
        lists = [bounds(book, half) for book, half in self.halves(v)]
        (o1, l1), (o2, l2) = ((np.argsort(b, kind="stable"), np.sort(b)) for b in lists)
        l1, l2, o1, o2 = l1.tolist(), l2.tolist(), o1.tolist(), o2.tolist()
        heap, out, seen = [(l1[0] + l2[0], 0, 0)], [], {(0, 0)}
        while heap:
            bound, i, j = heapq.heappop(heap)
            if bound > self.limit:
                break
            out.append((o1[i], o2[j]))
            for x, y in ((i + 1, j), (i, j + 1)):
                if x < len(l1) and y < len(l2) and (x, y) not in seen:
                    seen.add((x, y))
                    heapq.heappush(heap, (l1[x] + l2[y], x, y))
        return out


def bounds(book: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Lower bounds on the squared distance from x to every centre's cell, by the plane between it and x's own."""
    d = ((book - x) ** 2).sum(1)
    own = int(d.argmin())
    apart = np.sqrt(((book - book[own]) ** 2).sum(1))
    return np.where(apart > 0, (np.maximum(0.0, d - d[own]) / (2 * np.maximum(apart, 1e-300))) ** 2, 0.0)


def kmeans(x: np.ndarray, codes: int, seed: int, rounds: int = 12) -> np.ndarray:
    book = x[np.random.default_rng(seed).permutation(len(x))[:codes]].copy()
    for _ in range(rounds):
        d = (book * book).sum(1)[None, :] - 2 * x @ book.T
        own = d.argmin(1)
        for c in range(len(book)):
            m = own == c
            if m.any():
                book[c] = x[m].mean(0)
    return np.unique(book, axis=0)


def linked_sample(classes: DataFrame, cosine: float, queries: int = FIT_QUERIES, pairs: int = FIT_PAIRS) -> list[tuple[np.ndarray, np.ndarray]]:
    """Linked pairs by brute force: queries classes, in the order of a hash, against all; at most pairs of them, in the order of a hash."""
    asked = [(r["label"], r["cid"], np.frombuffer(bytes(r["unit"]), "<f8")) for r in classes.orderBy(F.xxhash64("cid", F.lit(5)), "cid").limit(queries).select("label", "cid", "unit").collect()]
    shared = classes.sparkSession.sparkContext.broadcast(asked)  # at most FIT_QUERIES vectors

    def run(batches):
        of: dict = {}
        for n, (label, cid, v) in enumerate(shared.value):
            of.setdefault((label, len(v)), []).append((n, cid, v))
        stacks = {k: (np.array([x[0] for x in m]), np.array([x[1] for x in m]), np.stack([x[2] for x in m])) for k, m in of.items()}
        for batch in batches:
            out_n, out_u = [], []
            for label, cid, raw in zip(batch.column("label").to_pylist(), batch.column("cid").to_pylist(), batch.column("unit").to_pylist(), strict=True):
                v = np.frombuffer(raw, "<f8")
                if (label, len(v)) in stacks:
                    n, ids, m = stacks[label, len(v)]
                    for k in n[(m @ v >= cosine) & (ids != cid)].tolist():
                        out_n.append(k)
                        out_u.append(raw)
            yield pa.RecordBatch.from_arrays([pa.array(out_n, pa.int32()), pa.array(out_u, pa.binary())], names=["n", "unit"])

    found = classes.select("label", "cid", "unit").mapInArrow(run, "n int, unit binary")
    return [(asked[r["n"]][2], np.frombuffer(bytes(r["unit"]), "<f8")) for r in found.orderBy(F.xxhash64("n", "unit")).limit(pairs).collect()]


def fit_reach(grid: Grid, linked: list[tuple[np.ndarray, np.ndarray]], target: float, cosine: float = COSINE) -> float:
    """The least reach at which probes meet the target share of the linked pairs; 1 (proven) without any pair."""
    if target >= 1 or not linked:
        return 1.0
    need = []
    for x, y in linked:
        i, j = grid.cell(y)
        (a, left), (b, right) = grid.halves(x)
        need.append((bounds(a, left)[i] + bounds(b, right)[j]) / (2 - 2 * cosine))
    return float(min(1.0, 1.05 * np.quantile(need, target, method="higher") + 1e-6))


def _cells(classes: DataFrame, grid: Grid, probing: bool) -> DataFrame:
    shared = classes.sparkSession.sparkContext.broadcast(grid)

    def run(batches):
        g = shared.value
        for batch in batches:
            take, c1, c2 = [], [], []
            for n, raw in enumerate(batch.column("unit").to_pylist()):
                v = np.frombuffer(raw, "<f8")
                for a, b in g.probes(v) if probing else [g.cell(v)]:
                    take.append(n)
                    c1.append(a)
                    c2.append(b)
            rows = batch.take(pa.array(take, pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [*(rows.column(c) for c in ("label", "cid", "weight", "unit")), pa.array(c1, pa.int32()), pa.array(c2, pa.int32())], names=["label", "cid", "weight", "unit", "c1", "c2"]
            )

    cells = classes.select("label", "cid", "weight", "unit").mapInArrow(run, "label long, cid long, weight long, unit binary, c1 int, c2 int")
    return cells.withColumn("size", F.length("unit"))


def _met(held: DataFrame, probe: DataFrame) -> DataFrame:
    """(held, probe): every pair of a block of a cell's members and a block of its probes, about BLOCK_ROWS rows each.

    A cell with more has several blocks of either side, and each pair of them has a key of its own: neither the
    grouping nor the join brings a cell to one task.
    """
    key = ["label", "c1", "c2", "size"]
    held, probe = materialise(held), materialise(probe)
    count = lambda df, name: df.groupBy(*key).agg((1 + F.expr(f"count(1) div {BLOCK_ROWS}")).alias(name))
    parts = count(held, "held_parts").join(count(probe, "probe_parts"), key)
    large = materialise(parts.where("held_parts > 1 or probe_parts > 1"))  # at most one row for BLOCK_ROWS of the tables
    side = F.broadcast(large) if small(large) else large

    def blocks(df: DataFrame, name: str, other: str) -> DataFrame:
        cut = df.join(side, key, "left").withColumns({f"{x}_parts": F.coalesce(f"{x}_parts", F.lit(1)).cast("long") for x in ("held", "probe")})
        cut = cut.withColumn(f"{name}_block", F.expr(f"pmod(xxhash64(cid, 7), {name}_parts)"))
        packed = cut.groupBy(*key, f"{name}_block", f"{other}_parts").agg(F.collect_list(F.struct("cid", "weight", "unit")).alias(name))
        return packed.withColumn(f"{other}_block", F.explode(F.expr(f"sequence(0L, {other}_parts - 1)"))).drop(f"{other}_parts")

    met = blocks(held, "held", "probe").join(blocks(probe, "probe", "held"), [*key, "held_block", "probe_block"])
    return met.select("probe", "held")


def _compare(met: DataFrame, cosine: float) -> DataFrame:
    def matrix(side):
        return (
            np.array([x["cid"] for x in side], np.int64),
            np.array([x["weight"] for x in side], np.int64),
            np.stack([np.frombuffer(x["unit"], "<f8") for x in side]),
        )

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                p, _, x = matrix(batch.column("probe")[i].as_py())
                q, w, y = matrix(batch.column("held")[i].as_py())
                linked = x @ y.T >= cosine
                count = linked @ w
                rows = np.flatnonzero(count)
                # spanning forest: labels spread between probes and members until they rest
                ids = np.where(linked.any(0), q, np.iinfo(np.int64).max)
                big = np.iinfo(np.int64).max
                while len(rows):
                    up = np.minimum(np.where(linked, ids[None, :], big).min(1), p)
                    down = np.minimum(np.where(linked, up[:, None], big).min(0), ids)
                    if (down == ids).all():
                        break
                    ids = down
                a, b, n = [p[rows]], [p[rows]], [count[rows]]
                if len(rows):
                    cols = np.flatnonzero(linked.any(0))
                    one, two = np.concatenate([p[rows], q[cols]]), np.concatenate([up[rows], ids[cols]])
                    edge = one != two
                    a.append(one[edge])
                    b.append(two[edge])
                    n.append(np.zeros(int(edge.sum()), np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(z)) for z in (a, b, n)], names=["a", "b", "n"])

    return met.mapInArrow(run, "a long, b long, n long")


def dedup(vectors: DataFrame, cosine: float = COSINE, target_recall: float = TARGET_RECALL) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept. vectors: vec_id, embedding, label."""
    slim = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), F.col("label").cast("long").alias("label"))
    units = materialise(unit_vectors(slim).withColumn("digest", F.sha2(F.col("unit"), 256)))
    valid = units.where("unit is not null")
    classes = materialise(valid.groupBy("label", "digest").agg(F.min("vec_id").alias("cid"), F.count(F.lit(1)).alias("weight"), F.first("unit").alias("unit")))
    total = classes.agg(F.count(F.lit(1)), F.count_distinct("label")).first()
    # the grid grows with the classes of a label, as far as MAX_FIT vectors can fit its codebooks; beyond that cells grow, in more blocks
    codes = int(np.clip(np.ceil(np.sqrt(total[0] / max(1, total[1]) / CELL_ROWS)), 2, MAX_FIT // 8))
    sample = [np.frombuffer(bytes(r["unit"]), "<f8") for r in classes.orderBy(F.xxhash64("cid"), "cid").limit(max(FIT_ROWS, 8 * codes)).select("unit").collect()]
    grid = Grid(sample, codes, cosine)
    grid.limit *= fit_reach(grid, linked_sample(classes, cosine) if target_recall < 1 else [], target_recall, cosine)
    met = materialise(_compare(_met(_cells(classes, grid, False), _cells(classes, grid, True)), cosine))
    links = met.groupBy(F.col("a").alias("cid")).agg(F.sum("n").alias("n_links"))
    # an id with different vectors is one node: its classes' links add up in its components
    part = components(met.where("a <> b").select("a", "b")).withColumnRenamed("node", "cid")
    known = classes.select("label", "digest", "cid").join(links, "cid", "left").join(part, "cid", "left")
    known = known.select("label", "digest", (F.coalesce("n_links", F.lit(1)) - 1).alias("n_links"), F.coalesce("component", "cid").alias("component_id"))
    out = units.join(known, ["label", "digest"], "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(table(spark, sf_dir, "embeddings"))


ORACLE_SQL = f"""
with recursive v as (
  select vec_id, label, embedding::double[] e from embeddings
  where label is not null and embedding is not null and vec_id is not null),
links as (
  select a.vec_id a, b.vec_id b from v a join v b on a.label = b.label and a.vec_id <> b.vec_id
  where len(a.e) = len(b.e) and list_cosine_similarity(a.e, b.e) >= {COSINE}),
reach(a, b) as (select vec_id, vec_id from embeddings union select r.a, l.b from reach r join links l on r.b = l.a)
select e.vec_id, coalesce(n.n, 0)::bigint n_links, c.c as component_id, e.vec_id = c.c as kept
from embeddings e
left join (select a, count(*) n from links group by a) n on n.a = e.vec_id
left join (select a, min(b) c from reach group by a) c on c.a = e.vec_id
"""
