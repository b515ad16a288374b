"""Near duplicates: an exact Jaccard join on 5-word shingles, by vertical partitioning.

Documents with equal shingle sets are one class; the join runs on classes. The global order of shingles
is (logarithm of the document frequency, hash): frequencies are counted over all documents, and
those of the most frequent shingles, at most ``MAX_LISTED``, are shared with every task; the others count as
rare. The order only steers the work, the result does not depend on it.

1. Candidates: two sets that reach the threshold share a shingle among the first n - ceil(t n) + 1 of
   their order. Those prefixes are dealt out by shingle, a very frequent one by task besides. Under a shingle of few classes all pairs are tried, else
   neighbours by size only. A parity sketch of each set bounds the difference of two sets from below and rules out most pairs, none that links.
2. Verification: the order is cut into ``FRAGMENTS`` ranges, every set into segments; the overlaps of a
   pair's segments are counted apart for each fragment and summed per pair.
3. Rounds: linked classes contract to components, and under each shingle where components still meet, neighbours of different
   components are tried again, in another order, until a round links nothing (``ROUNDS`` at most). A pair is asked once, and a round asks at most one pair for each
   row, so a group of near copies costs pairs in proportion to its size.
4. What then remains under a shingle in different components is compared in blocks, and verified inside the task: pairs are no rows, and
   a task returns fewer links than it has classes. So no link between components is lost.

Edge cases: a text of fewer than 5 words has one shingle, its whole sequence; null and empty texts have
none, link with nothing and form their own component; rows with a null id keep their row but lend no id to a
component (all-null components get null); repeated rows fall into one class; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_rows, components, discard, looked_up, materialise, small, table
from .runs import bucket_count, bucket_of, deltas, planes, undeltas, unplanes
from .text import chunks, mix, shingle_sets, text_bytes

SHINGLE, PERCENT = 5, 75
MAX_LISTED, FRAGMENTS, BATCH_ENTRIES, BLOCK, BLOCK_SHINGLES, FEW, HOT, ROUNDS, ARROW_ROWS = 1 << 20, 4, 800_000, 1024, 1_000_000, 4, 2000, 3, 1000


def sets_of(batch: pa.RecordBatch, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row and hash of every distinct shingle; size and signature of every row's set."""
    rows, grams = shingle_sets(*text_bytes(batch.column("text")), n=n)
    size = np.bincount(rows, minlength=batch.num_rows).astype(np.int64) if len(rows) else np.zeros(batch.num_rows, np.int64)
    sig = np.zeros(batch.num_rows, np.uint64)
    if len(rows):
        heads = np.flatnonzero(np.diff(rows, prepend=-1))
        sig[rows[heads]] = mix(np.add.reduceat(mix(grams ^ np.uint64(0x5851F42D4C957F2D)), heads) + size[rows[heads]].astype(np.uint64))
    return rows, grams, size, sig.view(np.int64)


def first_of_class(rows, grams, size, sig, seen: set) -> tuple[np.ndarray, np.ndarray]:
    """The shingles of the rows whose class this task has not met yet; seen is its bounded memory."""
    keep = np.zeros(len(size), bool)
    for i in np.flatnonzero(size).tolist():
        s = int(sig[i])
        if s not in seen:
            seen.add(s)
            keep[i] = True
    m = keep[rows]
    return rows[m], grams[m]


def _batches(rows: list[tuple], names: list[str], types: list) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def sketches(rows: np.ndarray, grams: np.ndarray, size: np.ndarray) -> list[bytes | None]:
    """Parities of every row's shingles over 2 to 4 bits for each of them: the bits in which two rows differ
    are no more than the shingles in which they do."""
    out: list[bytes | None] = [None] * len(size)
    heads = np.flatnonzero(np.diff(rows, prepend=-1)).tolist()
    for i, j in zip(heads, [*heads[1:], len(rows)][: len(heads)], strict=True):
        bits = 1 << max(7, int(2 * (j - i) - 1).bit_length())
        hit = np.bincount((grams[i:j] & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
        out[int(rows[i])] = np.packbits(hit.astype(np.uint8)).tobytes()
    return out


def fold(sketch: np.ndarray, width: int) -> np.ndarray:
    """Sketches (one a row) of fewer bytes: parities of the parts."""
    return np.bitwise_xor.reduce(sketch.reshape(len(sketch), -1, width), axis=1)


def may_link(a: np.ndarray, na: np.ndarray, b: np.ndarray, nb: np.ndarray, percent: int) -> np.ndarray:
    """Whether rows of equally wide sketches can reach the threshold; never false for a pair that does."""
    apart = np.bitwise_count(a ^ b).sum(-1, dtype=np.int64)
    # a Jaccard of t leaves (1 - t) / (1 + t) of both sizes unshared
    return ((100 + percent) * apart <= (100 - percent) * (na + nb)) & (100 * np.minimum(na, nb) >= percent * np.maximum(na, nb))


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, sig and sketch of every document."""

    def run(batches):
        for batch in chunks(batches):
            rows, grams, size, sig = sets_of(batch)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(size), pa.array(sig), pa.array(sketches(rows, grams, size), pa.binary())], names=["doc_id", "n_shingles", "sig", "sketch"]
            )

    return docs.mapInArrow(run, "doc_id long, n_shingles long, sig long, sketch binary")


def plausible(pairs: DataFrame, sketch: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) that their sketches do not rule out; sketch: sig, n, sketch of every class in them."""
    for side in "ab":
        pairs = pairs.join(sketch.select(F.col("sig").alias(side), F.col("n").alias(f"n{side}"), F.col("sketch").alias(f"s{side}")), side)

    def run(batches):
        for batch in batches:
            na, nb = (batch.column(c).to_numpy() for c in ("na", "nb"))
            keep = []
            for n, (x, y) in enumerate(zip(batch.column("sa"), batch.column("sb"), strict=True)):
                x, y = (np.frombuffer(z.as_py(), np.uint8)[None, :] for z in (x, y))
                width = min(x.shape[1], y.shape[1])
                if may_link(fold(x, width), na[n], fold(y, width), nb[n], percent)[0]:
                    keep.append(n)
            rows = pa.array(keep, pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(c).take(rows) for c in ("a", "b")], names=["a", "b"])

    return pairs.select("a", "na", "sa", "b", "nb", "sb").mapInArrow(run, "a long, b long")


def neighbours(placed: DataFrame, turn: int, percent: int = PERCENT) -> DataFrame:
    """Pairs (a, b) of classes of different components that lie side by side under a shingle; placed: token, sig, n, component.

    Rows are range-sorted, so a shingle with any number of classes spreads over many tasks; each row starts one pair
    at most. The order changes with the turn: by size first, then by a hash of it.
    """
    keyed = placed.withColumn("k", F.col("n") if turn == 0 else F.expr(f"xxhash64(component, {int(turn)}) % 1048576 * 4096 + pmod(xxhash64(sig, {int(turn)}), 4096)"))
    order = ["token", "k", "sig"]

    def run(batches):
        last = [np.zeros(0, np.int64)] * 4
        for batch in batches:
            held = [np.concatenate([x, batch.column(c).to_numpy()]) for x, c in zip(last, ("token", "sig", "n", "component"), strict=True)]
            token, sig, n, comp = held
            m = (token[1:] == token[:-1]) & (comp[1:] != comp[:-1]) & (100 * np.minimum(n[1:], n[:-1]) >= percent * np.maximum(n[1:], n[:-1]))
            a, b = sig[1:][m], sig[:-1][m]
            last = [x[-1:] for x in held]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    return keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("token", "sig", "n", "component").mapInArrow(run, "a long, b long").distinct()


class Block:
    """Rows of one or two blocks of classes under a shingle, and which of them may link across components."""

    def __init__(self, t: pa.Table, percent: int):
        self.sig, self.n, self.own = (t.column(c).to_numpy() for c in ("sig", "n", "own"))
        self.two = t.num_rows > 0 and t.column("lo")[0].as_py() != t.column("hi")[0].as_py()
        names, self.comp = np.unique(t.column("component").to_numpy(), return_inverse=True)
        self.most = int(np.bincount(self.comp).argmax()) if len(names) else 0
        self.percent = percent
        raw = [x.as_py() for x in t.column("sketch")]
        by_width: dict[int, list[int]] = {}
        for i, x in enumerate(raw):
            by_width.setdefault(len(x), []).append(i)
        self.held = {w: (np.array(m), np.stack([np.frombuffer(raw[i], np.uint8) for i in m])) for w, m in by_width.items()}

    def pairs(self):
        """(row, rows): each pair that is not ruled out once at least; rows of the largest component only as partners."""
        for w, (m, s) in self.held.items():
            for v in (w // 2, w, 2 * w):
                if v not in self.held:
                    continue
                other, t = self.held[v]
                narrow = min(v, w)
                x, y = fold(s, narrow), fold(t, narrow)
                if narrow % 8 == 0:
                    x, y = x.view(np.uint64), y.view(np.uint64)
                for k in np.flatnonzero(self.comp[m] != self.most).tolist():
                    i = int(m[k])
                    fit = may_link(x[k][None, :], self.n[i], y, self.n[other], self.percent) & (self.comp[other] != self.comp[i])
                    if self.two:
                        fit &= self.own[other] != self.own[i]
                    if fit.any():
                        yield i, other[fit]


def blocks(placed: DataFrame, sketch: DataFrame) -> DataFrame:
    """The classes of each shingle in blocks of bounded size, a copy for every pair of blocks: token, lo, hi, own, sig, n, component, sketch."""
    size = placed.groupBy("token").agg((1 + F.greatest(F.expr(f"count(1) div {BLOCK}"), F.expr(f"sum(n) div {BLOCK_SHINGLES}"))).alias("parts")).where("parts > 1")
    size = materialise(size)  # at most a row for BLOCK classes
    side = F.broadcast(size) if small(size) else size
    dealt = placed.join(side, "token", "left").withColumn("cuts", F.coalesce("parts", F.lit(1)).cast("long")).drop("parts").withColumn("own", F.expr("pmod(xxhash64(sig, 3), cuts)"))
    dealt = dealt.withColumn("other", F.explode(F.expr("sequence(0L, cuts - 1)"))).withColumns({"lo": F.least("own", "other"), "hi": F.greatest("own", "other")})
    return dealt.drop("other").join(sketch.select("sig", "sketch"), "sig")


def rest(docs: DataFrame, placed: DataFrame, sketch: DataFrame, found: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links (a, b) that join all components which the pairs under placed's shingles join.

    A shingle's classes meet in blocks, compared and verified inside the task: no pair is a row. A task tells only links that
    join two components it has not joined yet, so it returns fewer links than it has classes.
    """
    dealt = materialise(blocks(placed, sketch))

    def rivals(t: pa.Table) -> pa.Table:
        block, hit = Block(t, percent), np.zeros(t.num_rows, bool)
        for i, js in block.pairs():
            hit[i] = True
            hit[js] = True
        return t.filter(pa.array(hit))

    def links(t: pa.Table) -> pa.Table:
        block, parent, out, sets = Block(t, percent), {}, [], {}
        parts = t.column("parts")

        def of(i):
            if i not in sets:
                sets[i] = [undeltas(x) for x in parts[i].as_py()]
            return sets[i]

        def root(x):
            while (p := parent.get(x, x)) != x:
                x = p
            return x

        for i, js in block.pairs():
            for j in js.tolist():
                a, b = root(int(block.comp[i])), root(int(block.comp[j]))
                if a == b:
                    continue
                both = sum(len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(of(i), of(j), strict=True))
                if 100 * both >= percent * (int(block.n[i]) + int(block.n[j]) - both):
                    parent[max(a, b)] = min(a, b)
                    out.append((int(block.sig[i]), int(block.sig[j])))
        return pa.Table.from_batches([_batches(out, ["a", "b"], [pa.int64(), pa.int64()])])

    near = materialise(dealt.groupBy("token", "lo", "hi").applyInArrow(rivals, dealt.schema))
    # of blocks with the same classes, dealt alike, one is enough
    key = [F.count(F.lit(1)).alias("c"), F.expr("bit_xor(xxhash64(sig))").alias("x"), F.expr("bit_xor(xxhash64(sig, 1))").alias("y")]
    once = near.groupBy("token", "lo", "hi", "cuts").agg(*key).groupBy("lo", "hi", "cuts", "c", "x", "y").agg(F.min("token").alias("token")).select("token", "lo", "hi")
    near = materialise(near.join(once, ["token", "lo", "hi"], "left_semi"))
    discard(dealt)
    parts = segments(docs, near.select("sig"), found).select("sig", "parts").dropDuplicates(["sig"])
    return near.join(parts, "sig").groupBy("token", "lo", "hi").applyInArrow(links, "a long, b long").distinct()


def frequency_classes(docs: DataFrame, buckets: int, limit: int = MAX_LISTED) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles, as sorted 40-bit values, and the logarithms of their frequencies; at most limit."""

    def count(batches):
        held, seen, n = [], set(), 0

        def flush():
            value, times = np.unique(np.concatenate(held), return_counts=True)
            b = bucket_of(value << np.uint64(24), buckets)
            cut = np.concatenate([[0], np.flatnonzero(np.diff(b)) + 1, [len(b)]])
            rows = [(int(b[i]), deltas(value[i:j]), planes(times[i:j].astype(np.uint32))) for i, j in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]
            held.clear()
            seen.clear()
            return _batches(rows, ["bucket", "value", "times"], [pa.int32(), pa.binary(), pa.binary()])

        for batch in chunks(batches):
            _, grams = first_of_class(*sets_of(batch), seen)
            held.append(grams >> np.uint64(24))
            n += len(grams)
            if n >= BATCH_ENTRIES:
                yield flush()
                n = 0
        if n:
            yield flush()

    def total(t: pa.Table) -> pa.Table:
        value = np.concatenate([undeltas(x.as_py()) for x in t.column("value")])
        times = np.concatenate([unplanes(x.as_py(), np.uint32) for x in t.column("times")]).astype(np.int64)
        order = np.argsort(value)
        value, times = value[order], times[order]
        heads = np.flatnonzero(np.diff(value, prepend=value[:1] + np.uint64(1)))
        value, times = value[heads], np.add.reduceat(times, heads)
        level = np.floor(np.log2(times)).astype(np.int32)
        rows = [(int(k), int((level == k).sum()), deltas(value[level == k])) for k in np.unique(level[level >= 2]).tolist()]
        return pa.Table.from_batches([_batches(rows, ["level", "n", "value"], [pa.int32(), pa.int64(), pa.binary()])])

    counted = docs.mapInArrow(count, "bucket int, value binary, times binary")
    found = materialise(counted.groupBy("bucket").applyInArrow(total, "level int, n long, value binary"))
    least, room = 1 << 30, limit
    for r in found.groupBy("level").agg(F.sum("n").alias("n")).orderBy(F.desc("level")).collect():
        if r["n"] > room:
            break
        least, room = r["level"], room - r["n"]
    got = [(undeltas(bytes(r["value"])), r["level"]) for r in found.where(F.col("level") >= least).select("level", "value").collect()]
    discard(found)
    if not got:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint8)
    value = np.concatenate([v for v, _ in got])
    level = np.concatenate([np.full(len(v), k, np.uint8) for v, k in got])
    order = np.argsort(value)
    return value[order], level[order]


def prefixes(docs: DataFrame, buckets: int, listed: tuple[np.ndarray, np.ndarray], percent: int = PERCENT) -> DataFrame:
    """(token, sig, n, few, hot, next): classes that share a prefix shingle with another.

    next holds the classes to try first: the following one by size under the shingle, for a shingle of ``FEW`` classes or fewer (few)
    all following ones, so that nothing remains to be tried there. A shingle with more than ``HOT`` classes in one run (hot) is dealt by task besides,
    so no task holds a group; classes under it may be told more than once.
    """
    shared = docs.sparkSession.sparkContext.broadcast(listed)  # at most MAX_LISTED entries of 9 bytes

    def emit(batches):
        value, level = shared.value
        held, seen, n = [], set(), 0
        task = 1 + TaskContext.get().partitionId()

        def entries(b, salt, token, sig, size, hot):
            own, first, place = np.unique(sig, return_index=True, return_inverse=True)
            return b, salt, deltas(token), planes(place.astype(np.uint32)), planes(own), planes(size[first].astype(np.uint32)), deltas(hot)

        def flush():
            token, sig, size = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.argsort(token, kind="stable")
            token, sig, size = token[order], sig[order], size[order]
            heads = np.flatnonzero(np.diff(token, prepend=token[:1] + np.uint64(1)))
            counts = np.diff(np.append(heads, len(token)))
            hot = np.repeat(counts > HOT, counts)
            b = bucket_of(token, buckets)
            cut = np.concatenate([[0], np.flatnonzero(np.diff(b)) + 1, [len(b)]])
            held.clear()
            seen.clear()
            rows = []
            for i, j in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
                h, x = hot[i:j], (token[i:j], sig[i:j], size[i:j])
                rows.append(entries(int(b[i]), 0, *(y[~h] for y in x), np.unique(x[0][h])))
                if h.any():
                    rows.append(entries(int(b[i]), task, *(y[h] for y in x), np.zeros(0, np.uint64)))
            return _batches(rows, ["bucket", "salt", "token", "place", "sig", "n", "hot"], [pa.int32(), pa.int32(), *[pa.binary()] * 5])

        for batch in chunks(batches):
            rows, grams, size, sig = sets_of(batch)
            rows, grams = first_of_class(rows, grams, size, sig, seen)
            if not len(rows):
                continue
            if len(value):
                short = grams >> np.uint64(24)
                at = np.minimum(np.searchsorted(value, short), len(value) - 1)
                rank = np.where(value[at] == short, level[at], 0).astype(np.uint8)
                order = np.lexsort((grams, rank, rows))
                rows, grams = rows[order], grams[order]
            heads = np.flatnonzero(np.diff(rows, prepend=-1))
            counts = np.diff(np.append(heads, len(rows)))
            place = np.arange(len(rows)) - np.repeat(heads, counts)
            own = size[rows]
            keep = place < own - (percent * own + 99) // 100 + 1
            held.append((grams[keep], sig[rows[keep]], own[keep]))
            n += int(keep.sum())
            if n >= BATCH_ENTRIES:
                yield flush()
                n = 0
        if n:
            yield flush()

    def meet(key, t):
        token = np.concatenate([undeltas(x.as_py()) for x in t.column("token")])
        place = [unplanes(x.as_py(), np.uint32) for x in t.column("place")]
        sig = np.concatenate([unplanes(x.as_py(), np.int64)[p] for x, p in zip(t.column("sig"), place, strict=True)])
        size = np.concatenate([unplanes(x.as_py(), np.uint32)[p] for x, p in zip(t.column("n"), place, strict=True)]).astype(np.int64)
        salted = key[1].as_py() > 0
        hot = np.unique(np.concatenate([undeltas(x.as_py()) for x in t.column("hot")]))
        order = np.lexsort((sig, size, token))
        token, sig, size = token[order], sig[order], size[order]
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (sig[1:] != sig[:-1])
        token, sig, size = token[new], sig[new], size[new]
        heads = np.flatnonzero(np.diff(token, prepend=token[:1] + np.uint64(1)))
        counts = np.diff(np.append(heads, len(token)))
        count = np.repeat(counts, counts)
        warm = np.full(len(token), True) if salted else np.isin(token, hot)
        many = (count > 1) | warm
        token, sig, size, warm, few = token[many], sig[many], size[many], warm[many], (count <= FEW)[many] & ~warm[many]
        after = np.zeros((len(token), FEW - 1), np.int64)
        valid = np.zeros((len(token), FEW - 1), bool)
        for s in range(1, FEW):
            at = np.arange(max(0, len(token) - s))
            near = (token[at] == token[at + s]) & (100 * size[at] >= percent * size[at + s])
            valid[at, s - 1] = near if s == 1 else near & few[at]
            after[at, s - 1] = sig[at + s]
        offsets = np.concatenate([[0], np.cumsum(valid.sum(1))]).astype(np.int32)
        following = pa.ListArray.from_arrays(pa.array(offsets), pa.array(after[valid]))
        return pa.table([pa.array(token.view(np.int64)), pa.array(sig), pa.array(size), pa.array(few), pa.array(warm), following], names=["token", "sig", "n", "few", "hot", "next"])

    dealt = docs.mapInArrow(emit, "bucket int, salt int, token binary, place binary, sig binary, n binary, hot binary")
    return dealt.groupBy("bucket", "salt").applyInArrow(meet, "token long, sig long, n long, few boolean, hot boolean, next array<long>")


def segments(docs: DataFrame, members: DataFrame, found: DataFrame) -> DataFrame:
    """(sig, n, parts) of the classes in members, a segment for each fragment; found: doc_id, n_shingles, sig of all documents."""
    wanted = found.join(members.distinct(), "sig", "left_semi").groupBy("sig").agg(F.min("doc_id").alias("doc_id"))
    wanted = materialise(wanted.select("doc_id", F.col("sig").alias("want")))
    side = F.broadcast(wanted) if small(wanted) else wanted
    picked = docs.join(side, "doc_id").select("text", "want")

    def cut(batches):
        for batch in chunks(batches):
            rows, grams, size, sig = sets_of(batch)
            want = batch.column("want").to_numpy(zero_copy_only=False) if "want" in batch.schema.names else sig
            out = []
            for r in range(batch.num_rows):
                if sig[r] and sig[r] == want[r]:  # a row that merely shares its id with the class's is not meant
                    own = grams[np.searchsorted(rows, r) : np.searchsorted(rows, r + 1)]
                    edges = np.searchsorted(bucket_of(own, FRAGMENTS), np.arange(FRAGMENTS + 1))
                    out.append((int(sig[r]), int(size[r]), [deltas(own[i:j]) for i, j in zip(edges[:-1], edges[1:], strict=True)]))
            yield _batches(out, ["sig", "n", "parts"], [pa.int64(), pa.int64(), pa.list_(pa.binary())])

    kind = "sig long, n long, parts array<binary>"
    out = picked.mapInArrow(cut, kind)
    unnamed = wanted.where("doc_id is null").select(F.col("want").alias("sig"))
    if not unnamed.isEmpty():  # classes of rows without an id
        out = out.unionByName(docs.where("doc_id is null").select("text").mapInArrow(cut, kind).join(unnamed, "sig", "left_semi"))
    return out


def verified(docs: DataFrame, pairs: DataFrame, found: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) of classes that reach the threshold; pairs: distinct a, b, materialised."""
    parts = segments(docs, pairs.select(F.col("a").alias("sig")).unionByName(pairs.select(F.col("b").alias("sig"))), found)
    left = parts.select(F.col("sig").alias("a"), F.col("n").alias("na"), F.col("parts").alias("pa"))
    right = parts.select(F.col("sig").alias("b"), F.col("n").alias("nb"), F.col("parts").alias("pb"))
    met = pairs.join(left, "a").join(right, "b")

    def overlap(batches):
        for batch in batches:
            counts = [
                [len(np.intersect1d(undeltas(x), undeltas(y), assume_unique=True)) for x, y in zip(one.as_py(), two.as_py(), strict=True)]
                for one, two in zip(batch.column("pa"), batch.column("pb"), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("a", "b", "na", "nb")), pa.array(counts, pa.list_(pa.int64()))], names=["a", "b", "na", "nb", "counts"])

    partial = met.select("a", "b", "na", "nb", "pa", "pb").mapInArrow(overlap, "a long, b long, na long, nb long, counts array<long>")
    summed = partial.withColumn("both", F.expr("aggregate(counts, 0L, (x, y) -> x + y)"))
    return summed.where(f"100 * both >= {int(percent)} * (na + nb - both)").select("a", "b").distinct()


def mixed(members: DataFrame, part: DataFrame) -> DataFrame:
    """(token, sig, n, component) under the shingles where components meet; of shingles with the same classes the least only."""
    left = members.where("not few")
    left = left.where("not hot").select("token", "sig", "n").unionByName(left.where("hot").select("token", "sig", "n").distinct())
    placed = left.join(part.withColumnRenamed("node", "sig"), "sig", "left").select("token", "sig", "n", F.coalesce("component", "sig").alias("component"))
    key = [F.count(F.lit(1)).alias("c"), F.expr("bit_xor(xxhash64(sig))").alias("x"), F.expr("bit_xor(xxhash64(sig, 1))").alias("y")]
    met = placed.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), *key).where("lo <> hi")
    return placed.join(met.groupBy("c", "x", "y").agg(F.min("token").alias("token")).select("token"), "token", "left_semi")


def _linked(docs: DataFrame, buckets: int, percent: int, told: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """Classes of all documents, and (node, component) of the linked ones; told gets the number of pairs verified in each round."""
    found = materialise(classes(docs))
    members = materialise(prefixes(docs, buckets, frequency_classes(docs, buckets), percent))
    sketch = materialise(
        found.where("sketch is not null").join(members.select("sig").distinct(), "sig", "left_semi").groupBy("sig").agg(F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"))
    )
    pairs = members.select(F.col("sig").alias("p"), F.explode("next").alias("q")).select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct()
    links, tried, left, used = None, None, members, []
    for turn in range(ROUNDS + 1):
        if turn:
            if left.isEmpty():
                break
            pairs = neighbours(left, turn - 1, percent).join(tried, ["a", "b"], "left_anti")
        asked = materialise(plausible(pairs, sketch, percent))
        new = materialise(verified(docs, asked, found, percent))
        if told is not None:
            told[turn] = asked.count()
        used += [asked, new]
        gained = turn == 0 or not new.isEmpty()
        tried = asked if tried is None else tried.unionByName(asked)
        links = new if links is None else links.unionByName(new)
        if gained:
            part = components(links)
            last, left = left, materialise(mixed(members if turn == 0 else left.selectExpr("token", "sig", "n", "false few", "false hot"), part))
            if turn:
                discard(last)
        else:
            break
    if not left.isEmpty():
        new = materialise(rest(docs, left, sketch, found, percent))
        if not new.isEmpty():
            part = components(links.unionByName(new))
        used.append(new)
    discard(members, sketch, left, *used)
    return found, part


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, class_sig, component_sig (null without words)."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    buckets = bucket_count(docs, 4)
    with arrow_rows(docs.sparkSession, ARROW_ROWS):
        found, part = _linked(docs, buckets, percent)
    each = found.where("n_shingles > 0").groupBy("sig").agg(F.count(F.lit(1)).alias("times"), F.min("doc_id").alias("least"))
    each = each.join(part.withColumnRenamed("node", "sig"), "sig", "left").withColumn("component_sig", F.coalesce("component", "sig"))
    # a class of one row, linked with none, needs no telling
    each = materialise(each.where("component is not null or times > 1").select("sig", "times", "least", "component_sig"))
    least = each.groupBy("component_sig").agg(F.min("least").alias("component_id"))
    told = materialise(each.join(least, "component_sig").select("sig", "times", "component_id", "component_sig"))
    discard(each)
    words = found.where("n_shingles > 0").select("doc_id", "n_shingles", "sig")
    full = looked_up(words, told, "sig").select(
        "doc_id", "n_shingles", F.when(F.col("component_sig").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.col("sig").alias("class_sig"), F.coalesce("component_sig", "sig").alias("component_sig"),
    )
    none = F.lit(None).cast("long")
    alone = found.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), none.alias("class_sig"), none.alias("component_sig"))
    return full.unionByName(alone)


def signatures():
    """The column function that gives a text's class: the signature of its shingle set, null without words."""

    @F.arrow_udf("long")
    def class_sig(text: pa.Array) -> pa.Array:
        out = []
        for batch in chunks(iter([pa.RecordBatch.from_arrays([text], names=["text"])])):
            _, _, size, sig = sets_of(batch)
            out.append(pa.array(sig, mask=size == 0))
        return pa.concat_arrays(out) if out else pa.array([], pa.int64())

    return class_sig


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """The rows of docs, one for each group of near duplicates: that of the smallest id, named ids before null ones.

    Decided by row: one that shares its id with a copy, but not its shingles, stays. Of rows with equal id and
    equal shingles the one of least text stays; texts without words all stay.
    """
    found = materialise(join(docs, id_col, text_col, percent).where("class_sig is not null").select("doc_id", "class_sig", "component_sig"))
    key = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "class_sig")
    groups = materialise(found.groupBy("component_sig").agg(F.count(F.lit(1)).alias("times"), F.min(key).alias("first")).where("times > 1"))
    met = looked_up(found, groups, "component_sig").where("first is not null").withColumn("kept", F.expr("doc_id <=> first.doc_id and class_sig = first.class_sig"))
    rows = materialise(met.groupBy("doc_id", "class_sig", "kept").agg(F.count(F.lit(1)).alias("times")).where("not kept or times > 1"))
    sig = "class_sig"
    while sig in docs.columns:
        sig = f"_{sig}"
    rows = rows.select(F.col("doc_id").alias(f"{sig}_id"), F.col("class_sig").alias(f"{sig}_of"), F.col("kept").alias(f"{sig}_kept"))
    named = docs.withColumn(sig, signatures()(F.col(text_col).cast("string")))
    same = F.col(id_col).cast("long").eqNullSafe(F.col(f"{sig}_id")) & (F.col(sig) == F.col(f"{sig}_of"))

    def those(kept: bool) -> DataFrame:
        part = rows.where(F.col(f"{sig}_kept") == F.lit(kept)).drop(f"{sig}_kept")
        return F.broadcast(part) if small(part) else part

    out = named.join(those(False), same, "left_anti")
    repeated = those(True)
    if not repeated.isEmpty():
        again = out.join(repeated, same, "left_semi").groupBy(F.col(id_col).alias(f"{sig}_id"), sig).agg(F.min_by(F.struct(*docs.columns), F.col(text_col)).alias(f"{sig}_row"))
        out = out.join(repeated, same, "left_anti").select(*docs.columns).unionByName(again.select(f"{sig}_row.*"))
    return out.select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents")).drop("class_sig", "component_sig")


ORACLE_SQL = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') w from documents),
s as (select distinct doc_id, g from (
  select doc_id, unnest(case when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda i: w[i:i + 4]) when len(w) > 0 then [w] else [] end) g from w)),
n as (select doc_id, count(*) n from s group by 1),
p as (select a.doc_id a, b.doc_id b, count(*) c from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by all),
l as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 75 * (x.n + y.n - c)),
e as (select a, b from l union all select b, a from l),
reach(a, b) as (select doc_id, doc_id from documents union select r.a, e.b from reach r join e on e.a = r.b)
select d.doc_id, coalesce(n.n, 0)::bigint n_shingles, c.c component_id
from documents d left join n on n.doc_id = d.doc_id join (select a, min(b) c from reach group by a) c on c.a = d.doc_id
"""
