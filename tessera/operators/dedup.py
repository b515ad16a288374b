"""Greedy removal of duplicates in order, and similarities of pairs."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type


def ordered(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """rank of each item within its group, in a total order."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def ordered_pairs(df: DataFrame, keys: list[str], rank: str, columns: list[str]) -> DataFrame:
    """Pairs (lo, hi) of each group with lo before hi. Quadratic in a group, as the comparison is: for groups of one character's items."""
    lo = df.select(*keys, F.struct(F.col(rank).alias("rank"), *columns).alias("lo"))
    hi = df.select(*keys, F.struct(F.col(rank).alias("rank"), *columns).alias("hi"))
    return lo.join(hi, keys).where("lo.rank < hi.rank")


def pair_products(df: DataFrame, keys: list[str], rank: str, vector: str, block: int = 256) -> DataFrame:
    """lo, hi and sim (inner product) of every pair of a group with lo before hi, as block products.

    A group is dealt to blocks of about ``block`` rows by a hash, each pair of blocks is one small task's matrix
    product, so a large group is many tasks. Null keys and ranks pair with nothing; a null vector gives a null sim.
    """
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    named = df.select(*keys, rank, vector).dropna(subset=[*keys, rank])
    counts = named.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int").alias("__n"))
    dealt = named.join(counts, keys).withColumn("__b", F.pmod(F.xxhash64(rank), F.col("__n")).cast("int"))
    last = F.col("__n") - 1
    left = dealt.select(*keys, rank, vector, F.col("__b").alias("__lo"), F.explode(F.sequence("__b", last)).alias("__hi"), F.lit(True).alias("__left"))
    right = dealt.select(*keys, rank, vector, F.explode(F.sequence(F.lit(0), "__b")).alias("__lo"), F.col("__b").alias("__hi"), F.lit(False).alias("__left"))

    def matrix(t: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        c = t.column(vector).combine_chunks()
        known = c.is_valid().to_numpy(zero_copy_only=False)
        flat = c.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        x = np.zeros((len(c), len(flat) // max(1, int(known.sum()))))
        x[known] = flat.reshape(int(known.sum()), x.shape[1])
        return t.column(rank).to_numpy(), x, known

    def run(t: pa.Table) -> pa.Table:
        a, b = t.filter(t.column("__left")), t.filter(pc.invert(t.column("__left")))
        if not a.num_rows or not b.num_rows:
            return schema_of.empty_table()
        (ra, x, ka), (rb, y, kb) = matrix(a), matrix(b)
        same = a.column("__lo")[0].as_py() == a.column("__hi")[0].as_py()
        i, j = np.nonzero(ra[:, None] < rb[None, :] if same else ra[:, None] != rb[None, :])
        width = max(x.shape[1], y.shape[1])
        x, y = (z if z.shape[1] == width else np.zeros((len(z), width)) for z in (x, y))
        sim = pa.array((x @ y.T)[i, j], mask=~(ka[i] & kb[j]))
        first = a.select(keys).slice(0, 1).take(np.zeros(len(i), np.int64))
        return pa.table([*first.columns, pa.array(np.minimum(ra[i], rb[j])), pa.array(np.maximum(ra[i], rb[j])), sim], names=[*keys, "lo", "hi", "sim"])

    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in keys), f"lo {kinds[rank]}", f"hi {kinds[rank]}", "sim double"])
    schema_of = pa.schema([*((c, _arrow(df, c)) for c in keys), ("lo", _arrow(df, rank)), ("hi", _arrow(df, rank)), ("sim", pa.float64())])
    at = [*keys, "__lo", "__hi"]
    return left.unionByName(right).groupBy(*at).applyInArrow(run, schema)


def _arrow(df: DataFrame, column: str) -> pa.DataType:
    return to_arrow_type(df.schema[column].dataType)


def greedy(df: DataFrame, keys: list[str], rank: str, vector: str, least: float, carry: list[str]) -> DataFrame:
    """status of each item: dropped if its correlation with an item before it that is still kept exceeds least, else ok.

    The decision on an item needs those before it, so a group is one task's work; the groups (the items of one
    character) are small and many. Vectors are compared with the kept ones at once, as a matrix product.
    """

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by(rank)
        x = np.array(t.column(vector).to_pylist(), np.float64)
        x = x - x.mean(1, keepdims=True)
        norm = np.sqrt((x * x).sum(1, keepdims=True))
        x = np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)
        kept, n, status = np.empty_like(x), 0, []
        for row in x:
            hit = n > 0 and float((kept[:n] @ row).max()) > least
            status.append("dropped" if hit else "ok")
            if not hit:
                kept[n] = row
                n += 1
        return pa.table([*(t.column(c) for c in (*keys, *carry)), pa.array(status)], names=[*keys, *carry, "status"])

    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in (*keys, *carry)) + ", status string"
    return df.select(*dict.fromkeys([*keys, *carry, rank, vector])).groupBy(*keys).applyInArrow(run, schema)


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)
