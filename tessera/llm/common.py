"""What the corpus operators share: reading tables, scratch tables, components."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in spark.checkpoint.dir, or the one set on the context.

    Where neither is set, a session within one machine gets a temporary folder of its own; on a cluster that is an error, for
    executors would not share it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="tessera-")
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext.getCheckpointDir() or root
    return root.rstrip("/")


def materialise(df: DataFrame) -> DataFrame:
    """Write df as a table in the shared folder and read it again: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/tessera/{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._tessera_path = path
    return out


_ROWS, _BYTES, BATCH_BYTES = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20


def small_batches(spark: SparkSession, rows: int = 2000) -> dict[str, str]:
    """Lower the session's Arrow batches to so many rows and ``BATCH_BYTES``, for results that are evaluated after their function has returned.

    Whole texts and segments would make the usual 10,000 rows heavy. Returns the settings as they were.
    """
    before = {key: spark.conf.get(key) for key in (_ROWS, _BYTES)}
    for key, most in ((_ROWS, rows), (_BYTES, BATCH_BYTES)):
        if not 0 < int(before[key].lower().rstrip("b")) <= most:
            spark.conf.set(key, str(most))
    return before


@contextmanager
def arrow_rows(spark: SparkSession, rows: int):
    """small_batches, within it only."""
    before = small_batches(spark, rows)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def discard(*tables: DataFrame) -> None:
    """Delete materialised tables that nothing will read any more, not even to recompute a lost partition."""
    for df in tables:
        if path := getattr(df, "_tessera_path", None):
            jvm = df.sparkSession.sparkContext._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


#: Tables of ids are broadcast up to so many rows (a few dozen bytes each), else joined by shuffle; keys with more rows than HEAVY apart.
BROADCAST_ROWS, HEAVY = 250_000, 10_000


def small(df: DataFrame, rows: int | None = None) -> bool:
    """Whether a materialised table has at most BROADCAST_ROWS rows."""
    rows = BROADCAST_ROWS if rows is None else rows
    return df.limit(rows + 1).count() <= rows


def looked_up(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """left with right's columns by key, null where it has none; right: one materialised row a key, with its number of rows in left as ``times``.

    A small table is broadcast. Else the keys of more than HEAVY rows are, of which there are few, and the others meet by shuffle, so
    no task gets a hot key.
    """
    if small(right):
        return left.join(F.broadcast(right.drop("times")), key, "left")
    heavy = right.where(F.col("times") > HEAVY).drop("times")
    light = right.where(F.col("times") <= HEAVY).drop("times")
    return left.join(F.broadcast(heavy), key).unionByName(left.join(F.broadcast(heavy.select(key)), key, "left_anti").join(light, key, "left"))


CONTRACT_EDGES = 300_000


def _contracted(edges: DataFrame) -> DataFrame:
    """Edges (u, v) of each partition, so many at a time, replaced by a star around every component's least node."""

    def run(batches):
        held, n = [], 0

        def flush():
            parent: dict[int, int] = {}

            def root(x):
                while (p := parent.get(x, x)) != x:
                    parent[x] = x = parent.get(p, p)
                return x

            for us, vs in held:
                for a, b in zip(us, vs, strict=True):
                    a, b = root(a), root(b)
                    if a != b:
                        parent[max(a, b)] = min(a, b)
            held.clear()
            pairs = [(x, root(x)) for x in parent]
            return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], names=["u", "v"])

        for batch in batches:
            held.append((batch.column("u").to_pylist(), batch.column("v").to_pylist()))
            n += batch.num_rows
            if n >= CONTRACT_EDGES:
                yield flush()
                n = 0
        if held:
            yield flush()

    return edges.mapInArrow(run, "u long, v long")


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """Connected components of an undirected edge list: local contraction, then large-star and small-star rounds.

    Returns (node, component): component is the smallest node reachable. Nodes without an edge do not
    appear; null ends and loops are dropped. Contraction works on what lies in a partition, a bounded number of
    edges at a time; the rounds, shuffles on a node, join what lies apart, and stop when all edges form stars.
    """
    e = (
        edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v"))
        .where("u is not null and v is not null and u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    e = materialise(e)
    for _ in range(max_rounds):
        parts = 1 + e.count() // CONTRACT_EDGES
        last, e = e, materialise(_contracted(e.coalesce(parts)).distinct())
        discard(last)
        if parts == 1:  # one task held all edges, so its stars are the components
            break
        inner = e.select(F.col("v").alias("u")).distinct()
        if e.join(inner, "u", "left_semi").isEmpty() and e.groupBy("u").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
            break
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # large star: every larger neighbour points at the least of the neighbourhood
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: every smaller neighbour, and the node itself, points at the least neighbour
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(joined.select("u", F.col("m").alias("v")))
        last, e = e, materialise(small.where("u <> v").distinct())
        discard(last)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = e.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
