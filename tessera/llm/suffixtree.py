"""Language-model scores from a probabilistic suffix tree over words.

Symbols are lower-cased words and one end after each text. The root is the discounted unigram distribution of
the training texts (its discount, by the numbers of words seen once and twice, goes to unseen words).
Below it, contexts of any length are kept where they matter. A context is a candidate if its longest proper suffix is a
state (or the root) and it is followed by some word ``least`` times; those words are its listed continuations. It becomes a state if its occurrences times the
Kullback-Leibler divergence of its next-word distribution from that of its longest proper suffix reach
``gain`` nats; the tree grows a word deeper as long as a round keeps any context. Neither bound depends on the size of the corpus, so what is gathered grows with it.
Continuations that are not listed share the rest of the mass in the suffix's proportions, so
every state's distribution sums to one. A text's score is the sum of log10 probabilities, each from the
longest suffix that is a state.

The tree is a table of (key, value): a state has one entry, and each of its listed words one, and a token's log10 probability is its root's plus
the values of all states on its chain of suffixes and of those that list it. So scoring adds values up by key, in any order: the ``HEAD_ENTRIES``
most used are broadcast (20 to 24 bytes each), all others meet the texts by ranges of the key: texts are cut into runs, a run sends each range its keys as one
sorted array with the places of the texts that want them, and gets back one sum a text. A bit table of fixed size (``BITS``) tells most keys that the
table does not hold; it steers the work only.

Counts are made of all training texts by sorted runs, merged by hash range. The ``HEAD_WORDS`` most
frequent words are broadcast (20 to 28 bytes each, while the tree grows also their ranks); all other words meet their counts as keys do, so counts are exact
for every word. Edge cases: a null or empty text is its end alone; rows with a null id are training rows; repeated rows are
each scored; without training rows every probability is 1 (score 0); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import gc

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  pa.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_rows, discard, materialise, table
from .runs import bucket_count, bucket_of, count_run, deltas, planes, squeezed, sum_runs, undeltas, unplanes, unsqueezed
from .text import chunks, mix, text_bytes, word_hashes, words

HEAD_WORDS, HEAD_ENTRIES, BITS, LEAST, GAIN, DISCOUNT = 1 << 19, 1 << 20, 1 << 26, 6, 12.0, 0.6
RUN_TOKENS, RUN_EVENTS, RUN_KEYS, RUN_TEXTS, ARROW_ROWS = 1_000_000, 600_000, 2_000_000, 20_000, 2000
SENT_EVENTS = 2_000_000  # a task's runs of events are merged, and sent once they hold so many different ones (32 bytes each)
END = np.uint64(0x3C6EF372FE94F82B)
_BLOCK = 1 << 16  # bits in a row of the bit table, all of it if it is smaller
ENTRY, WORD, TEXT = range(3)  # what a row that goes to the ranges holds: keys of entries, words, or a text's own figures


def tokens(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes with an end after each text, and their rows."""
    data, offsets = text_bytes(batch.column("text"))
    starts, ends, rows = words(data, offsets)
    h = word_hashes(data, starts, ends, lower=True)
    n = batch.num_rows
    out, owner = np.full(len(h) + n, END, np.uint64), np.empty(len(h) + n, np.int64)
    out[np.arange(len(h)) + rows] = h
    owner[np.arange(len(h)) + rows] = rows
    last = np.cumsum(np.bincount(rows, minlength=n)) + np.arange(n)
    owner[last] = np.arange(n)
    return out, owner


def _counts(docs: DataFrame, buckets: int, emit, least: int) -> DataFrame:
    """(value, times) binary rows, sorted runs without overlap, of what emit(tokens, rows, train) gives, if seen least times."""

    def count(batches):
        held, n = [], 0

        def flush():
            rows = count_run(np.concatenate(held), buckets, -1)
            held.clear()
            value, times = ([squeezed(r[k]) for r in rows] for k in (1, 2))
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array(value, pa.binary()), pa.array(times, pa.binary())], names=["bucket", "value", "times"])

        for batch in chunks(batches):
            got = emit(*tokens(batch), batch.column("train").to_numpy(zero_copy_only=False).astype(bool))
            held.append(got)
            n += len(got)
            if n >= RUN_TOKENS:
                yield flush()
                n = 0
        if n:
            yield flush()

    def total(t: pa.Table) -> pa.Table:
        value, times = sum_runs(*([unsqueezed(x) for x in t.column(c).to_pylist()] for c in ("value", "times")))
        keep = times >= least
        value, times = value[keep], times[keep]
        return pa.table([pa.array([deltas(value)], pa.binary()), pa.array([planes(times)], pa.binary())], names=["value", "times"])

    return docs.mapInArrow(count, "bucket int, value binary, times binary").groupBy("bucket").applyInArrow(total, "value binary, times binary")


def _collected(rows) -> tuple[np.ndarray, np.ndarray]:
    got = [(undeltas(bytes(r["value"])), unplanes(bytes(r["times"]), np.int64)) for r in rows]
    value, times = (np.concatenate(x) for x in zip(*got, strict=True)) if got else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    order = np.argsort(value)
    return value[order], times[order]


def find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places of wanted in the sorted keys; -1 where they are not."""
    if not len(keys):
        return np.full(len(wanted), -1, np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


def starts(keys: np.ndarray) -> np.ndarray:
    """Where each of the equal ranges of all hashes begins in the sorted keys, about one key in two ranges."""
    bits = max(1, len(keys).bit_length())
    return np.append(np.searchsorted(keys, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)), len(keys)).astype(np.int32)


def find_hashed(keys: np.ndarray, start: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """find among keys that are hashes, by their starts."""
    out = np.full(len(wanted), -1, np.int64)
    part = (wanted >> np.uint64(64 - (len(start) - 1).bit_length() + 1)).astype(np.int64)
    at, end = start[part], start[part + 1]
    left = np.flatnonzero(at < end)
    while len(left):
        here = at[left]
        hit = keys[here] == wanted[left]
        out[left[hit]] = here[hit]
        at[left] = here + 1
        left = left[~hit & (here + 1 < end[left])]
    return out


def chain(h: np.ndarray, rows: np.ndarray, depth: int, above: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The key of the context of so many words before each place, from the keys one word shorter; and where there are so many."""
    out, ok = np.zeros(len(h), np.uint64), np.zeros(len(h), bool)
    if len(h) > depth:
        ok[depth:] = rows[depth:] == rows[:-depth]
        longer = h[:-depth] if above is None else above[depth:] * np.uint64(0x9E3779B97F4A7C15) + h[:-depth]
        out[depth:] = mix(longer + np.uint64(depth))
    return out, ok


class Bits:
    """A bit table of fixed size over keys: a key it holds is always found, others seldom."""

    def __init__(self, raw: np.ndarray):
        self.raw = raw

    @staticmethod
    def places(keys: np.ndarray, bits: int) -> np.ndarray:
        return (mix(keys ^ np.uint64(0xA24BAED4963EE407)) & np.uint64(bits - 1)).astype(np.int64)  # bits: a power of two

    def has(self, keys: np.ndarray) -> np.ndarray:
        at = self.places(keys, len(self.raw) * 8)
        return (self.raw[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1

    @classmethod
    def of(cls, keys: DataFrame, bits: int | None = None) -> Bits:
        """Of a column of keys: gathered in blocks on the executors; the driver gets BITS / 8 bytes at most."""
        bits = bits or BITS
        block_bytes = min(_BLOCK, bits) // 8

        def spread(batches):
            whole = np.zeros(bits, bool)
            for batch in batches:
                whole[cls.places(batch.column(0).to_numpy().view(np.uint64), bits)] = True
            packed = np.packbits(whole, bitorder="little").reshape(-1, block_bytes)
            used = np.flatnonzero(packed.any(1))
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array([packed[i].tobytes() for i in used], pa.binary())], names=["block", "bits"])

        def union(t: pa.Table) -> pa.Table:
            got = np.bitwise_or.reduce([np.frombuffer(x.as_py(), np.uint8) for x in t.column("bits")])
            return pa.table([t.column("block")[:1], pa.array([got.tobytes()], pa.binary())], names=["block", "bits"])

        raw = np.zeros(bits // 8, np.uint8).reshape(-1, block_bytes)
        found = keys.mapInArrow(spread, "block long, bits binary").groupBy("block").applyInArrow(union, "block long, bits binary").toArrow()
        for block, part in zip(found.column("block").to_pylist(), found.column("bits").to_pylist(), strict=True):
            raw[block] = np.frombuffer(part, np.uint8)
        return cls(raw.reshape(-1))


class Tree:
    """The fitted tree: the root's head words as arrays, its other words and all entries as tables."""

    def __init__(self, head, counts, n, v, once, twice, tail):
        self.head, self.counts, self.n, self.v, self.tail = head, counts, n, v, tail
        self.discount = min(0.9, max(0.1, once / (once + 2 * twice))) if once else 0.5
        self.root = np.log10((counts - self.discount) / n) if n else np.zeros(len(head))
        self.unseen = float(np.log10(self.discount * v / n)) if n else 0.0
        self.depth, self.levels = 0, []  # levels: (key, value, times) of each depth

    def entries(self) -> DataFrame | None:
        out = None
        for level in self.levels:
            out = level if out is None else out.unionByName(level)
        return out


class Codes:
    """Words as numbers: those that are broadcast by their rank, so that usual ones vary in their low planes only; others by their place among the row's own."""

    def __init__(self, head: np.ndarray, head_starts: np.ndarray, ranked: np.ndarray, rank: np.ndarray):
        self.head, self.starts, self.ranked, self.rank = head, head_starts, ranked, rank

    @staticmethod
    def arrays(head: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, ...]:
        order = np.argsort(-counts, kind="stable")
        rank = np.empty(len(head), np.uint32)
        rank[order] = np.arange(len(head), dtype=np.uint32)
        return head, starts(head), head[order], rank

    def numbers(self, words_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks, and which words have one."""
        at = find_hashed(self.head, self.starts, words_)
        known = at >= 0
        return self.rank[np.maximum(at, 0)] if len(self.rank) else np.zeros(len(words_), np.uint32), known

    def pack(self, words_: np.ndarray, ranks: np.ndarray, known: np.ndarray) -> bytes:
        own, places = np.unique(words_[~known], return_inverse=True)
        code = ranks.copy()
        code[~known] = places + len(self.rank)
        return squeezed(np.uint64(len(own)).tobytes() + deltas(own) + planes(code))

    def unpack(self, raw: bytes) -> np.ndarray:
        raw = unsqueezed(raw)
        end = 8 + 8 * int(np.frombuffer(raw, np.uint64, 1)[0])
        return np.concatenate([self.ranked, undeltas(raw[8:end])])[unplanes(raw[end:], np.uint32)]


def _summed(columns: list[np.ndarray], order: np.ndarray, keys: int) -> list[np.ndarray]:
    """Rows in an order that brings equal ones of the first columns together, each once, with the sum of the last column."""
    columns = [x[order] for x in columns]
    new = np.zeros(len(order), bool)
    new[:1] = True
    for x in columns[:keys]:
        new[1:] |= x[1:] != x[:-1]
    heads = np.flatnonzero(new)
    return [*(x[heads] for x in columns[:-1]), np.add.reduceat(columns[-1], heads)]


def _merged(parts: list[tuple]) -> list[np.ndarray]:
    """(above, first, word, times) of several runs as one, by the upper bits of each: where those are equal, a group or an event may stand twice, to be met in total."""
    columns = [np.concatenate(x) for x in zip(*parts, strict=True)]
    above, first, word, _ = columns
    return _summed(columns, np.argsort((above >> np.uint64(40) << np.uint64(40)) | (first >> np.uint64(44) << np.uint64(20)) | (word >> np.uint64(44))), 3)


def _key(above: np.ndarray, word: np.ndarray, depth: int) -> np.ndarray:
    """The key of a context of so many words, from the key of its longest proper suffix (0: none) and its first word; as in chain."""
    return mix(above * np.uint64(0x9E3779B97F4A7C15) + word + np.uint64(depth))


def _events(train: DataFrame, depth: int, buckets: int, seen, codes) -> DataFrame:
    """(ctx, above, word, times, total): contexts of so many words with the words that follow them ``least`` times; see _level.

    seen: the broadcast bit table of, at depth 1, the words seen ``least`` times: no other can be listed or be followed by one that is. Below, of all depths before:
    keys of states, and of words listed after any context. A state's suffixes are states, so a place is left at the first of its contexts that is none.
    codes: the broadcast arrays of Codes. A row holds contexts by the key of their longest proper suffix and their first word, which take less room than their keys.
    """

    def count(batches):
        held, n, runs, known, code = [], 0, [], Bits(seen.value), Codes(*codes.value)

        def run():
            nonlocal runs
            runs.append(_merged(held))
            held.clear()
            if len(runs) > 1 and sum(len(r[0]) for r in runs) >= SENT_EVENTS:
                runs = [_merged(runs)]

        def flush():
            above, first, word, times = _merged(runs) if len(runs) > 1 else runs[0]
            runs.clear()
            new = np.concatenate([[True], (above[1:] != above[:-1]) | (first[1:] != first[:-1])])
            heads = np.flatnonzero(new)
            size = np.diff(np.append(heads, len(above))).astype(np.uint32)
            above, first = above[heads], first[heads]
            b = bucket_of(_key(above, first, depth), buckets)
            b = b.astype(np.uint16) if buckets <= 1 << 16 else b  # sorted by counting
            order = np.argsort(b, kind="stable")
            events = np.argsort(np.repeat(b, size), kind="stable")
            above, first, size, word, times = above[order], first[order], size[order], word[events], times[events]
            b, ends = b[order], np.append(0, np.cumsum(size, dtype=np.int64))
            first_ranks, word_ranks = code.numbers(first), code.numbers(word)
            cut = np.concatenate([[0], np.flatnonzero(np.diff(b)) + 1, [len(b)]])
            rows = []
            for i, j in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
                a = np.flatnonzero(np.concatenate([[True], above[i + 1 : j] != above[i : j - 1]]))
                contexts, e = np.diff(np.append(a, j - i)).astype(np.uint32), slice(ends[i], ends[j])
                row = [squeezed(x) for x in (deltas(above[i:j][a]), planes(contexts), planes(size[i:j]), planes(times[e]))]
                rows.append((int(b[i]), *row, code.pack(first[i:j], *(x[i:j] for x in first_ranks)), code.pack(word[e], *(x[e] for x in word_ranks))))
            columns = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), *(pa.array(c, pa.binary()) for c in columns[1:])], names=names)

        for batch in chunks(batches):
            h, rows = tokens(batch)
            if not len(h):
                continue
            at = np.flatnonzero(chain(h, rows, 1)[1])
            above = np.zeros(len(at), np.uint64)
            if depth == 1:
                listed = known.has(h)
                at, above = at[listed[at - 1]], above[listed[at - 1]]
            for d in range(2, depth + 1):
                above = _key(above, h[at - d + 1], d - 1)
                states = known.has(~above)
                if d == depth:
                    listed = np.zeros(len(h), bool)
                    listed[at] = known.has(above + h[at])  # the word is listed after the shorter context
                    states &= listed[at - 1]  # so is the context's own last word, a place earlier
                states &= at >= d
                states[states] = rows[at[states]] == rows[at[states] - d]
                at, above = at[states], above[states]
            word = np.where(listed[at], h[at], np.uint64(0))
            if len(at):
                held.append((above, h[at - depth], word, np.ones(len(at), np.int64)))
                n += len(at)
            if n >= RUN_EVENTS:
                run()
                n = 0
                if len(runs[0][0]) >= SENT_EVENTS:
                    yield flush()
        if n:
            run()
        if runs:
            yield flush()

    names = ["bucket", "above", "contexts", "size", "times", "first", "word"]

    def total(t: pa.Table) -> pa.Table:
        parts, code = [], Codes(*codes.value)
        for r in range(t.num_rows):
            above, contexts, size, times, first, word = (t.column(x)[r].as_py() for x in names[1:])
            above, contexts, size, times = undeltas(unsqueezed(above)), *(unplanes(unsqueezed(x), t_) for x, t_ in ((contexts, np.uint32), (size, np.uint32), (times, np.int64)))
            above = np.repeat(above, contexts)
            ctx = _key(above, code.unpack(first), depth)
            parts.append((np.repeat(ctx, size), code.unpack(word), np.repeat(above, size), times))
        columns = [np.concatenate(x) for x in zip(*parts, strict=True)]
        ctx, word, above, times = _summed(columns, np.lexsort(columns[1::-1]), 2)
        first = np.flatnonzero(np.concatenate([[True], ctx[1:] != ctx[:-1]]))
        every = np.repeat(np.add.reduceat(times, first), np.diff(np.append(first, len(ctx))))
        keep = (times >= least) & (word != 0)
        columns = [ctx[keep].view(np.int64), above[keep].view(np.int64), word[keep].view(np.int64), times[keep], every[keep]]
        return pa.table([pa.array(c) for c in columns], names=["ctx", "above", "word", "times", "total"])

    least = LEAST
    dealt = train.mapInArrow(count, "bucket int, above binary, contexts binary, size binary, times binary, first binary, word binary")
    return dealt.groupBy("bucket").applyInArrow(total, "ctx long, above long, word long, times long, total long")


def _wrapped(a: str, b: str) -> str:
    """a + b modulo 2^64, as keys add up."""
    return f"cast(pmod(cast({a} as decimal(38,0)) + {b} + 9223372036854775808, 18446744073709551616) - 9223372036854775808 as long)"


def _level(tree: Tree, listed: DataFrame, above: DataFrame | None, gain: float) -> tuple[DataFrame, DataFrame, Bits] | None:
    """Entries (key, value, times), and (key, logp) of the listed words, of the contexts that diverge, and the Bits of states and all listed words; None if none does."""
    if above is None:
        shared = listed.sparkSession.sparkContext.broadcast((tree.head, tree.root))

        def rooted(batches):
            head, root = shared.value
            for batch in batches:
                at = find(head, batch.column("word").to_numpy().view(np.uint64))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(root[at], mask=at < 0)], names=[*batch.schema.names, "logq"])

        known = listed.mapInArrow(rooted, "ctx long, above long, word long, times long, total long, logq double")
        tail = tree.tail.select("word", F.log10((F.col("n") - tree.discount) / float(tree.n)).alias("tailq"))
        rare = known.where("logq is null").drop("logq").join(tail, "word").withColumnRenamed("tailq", "logq")
        known = known.where("logq is not null").unionByName(rare)
    else:
        known = listed.withColumn("key", F.expr(_wrapped("above", "word"))).join(above.withColumnRenamed("logp", "logq"), "key").drop("key")
    known = materialise(known.select("ctx", "word", "times", "total", "logq"))
    discard(listed)
    sums = known.withColumns({"p": F.expr(f"(times - {DISCOUNT}) / total"), "q": F.expr("power(10D, logq)")}).groupBy("ctx").agg(
        F.first("total").alias("n"),
        F.greatest(1 - F.sum("p"), F.lit(1e-9)).alias("rp"),
        F.greatest(1 - F.sum("q"), F.lit(1e-9)).alias("rq"),
        F.sum(F.expr("times / total * ln(times / total / q)")).alias("kl"),
        F.greatest(1 - F.sum(F.expr("times / total")), F.lit(0.0)).alias("rest"),
    )
    sums = sums.where(F.expr(f"n * (kl + case when rest > 0 then rest * ln(greatest(rest, 1e-12) / rq) else 0 end) >= {gain}"))
    states = materialise(sums.select("ctx", "n", F.expr("log10(rp / rq)").alias("rest")))
    if states.isEmpty():
        discard(known, states)
        return None
    words = known.join(states.drop("n"), "ctx").withColumn("key", F.expr(_wrapped("ctx", "word")))
    words = words.withColumn("logp", F.expr(f"log10((times - {DISCOUNT}) / total)"))
    words = materialise(words.select("key", "logp", F.expr("logp - logq - rest").alias("value"), "times"))
    # a state's own key is its context's complement
    entries = states.select(F.expr("~ctx").alias("key"), F.col("rest").alias("value"), F.col("n").alias("times")).unionByName(words.select("key", "value", "times"))
    seen = Bits.of(entries.select("key").unionByName(known.select(F.expr(_wrapped("ctx", "word")).alias("key"))))
    discard(known)
    return entries, words.select("key", "logp"), seen


def _settle(spark: SparkSession) -> None:
    """Let Spark delete shuffle files that no query needs any more: it does so only when the driver collects its garbage, and they would add up until then."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def fit(docs: DataFrame, gain: float = GAIN, head_words: int = HEAD_WORDS) -> Tree:
    """The tree of the training rows. docs: text, train."""
    buckets = bucket_count(docs)
    train = docs.where("train").select("text", "train")
    words_seen = materialise(_counts(train, buckets, lambda h, rows, mask: h, 1))

    def levels(batches):
        for batch in batches:
            out = np.zeros((64, 4), np.int64)
            for x in batch.column("times").to_pylist():
                n = unplanes(x, np.int64)
                level = np.floor(np.log2(n)).astype(np.int64)
                out[:, 0] += np.bincount(level, minlength=64)
                out[:, 1] += np.bincount(level, n, minlength=64).astype(np.int64)
                out[0, 2] += int((n == 1).sum())
                out[0, 3] += int((n == 2).sum())
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(64)), *(pa.array(out[:, k]) for k in range(4))], names=["level", "words", "tokens", "once", "twice"])

    found = words_seen.select("times").mapInArrow(levels, "level long, words long, tokens long, once long, twice long")
    found = found.groupBy("level").agg(*(F.sum(c).alias(c) for c in ("words", "tokens", "once", "twice"))).orderBy(F.desc("level")).collect()
    n, v = sum(r["tokens"] for r in found), sum(r["words"] for r in found)
    least, room = 1 << 40, head_words
    for r in found:
        if r["words"] > room:
            break
        least, room = 1 << r["level"], room - r["words"]

    def split(batches, top: bool):
        for batch in batches:
            for value, times in zip(batch.column("value").to_pylist(), batch.column("times").to_pylist(), strict=True):
                w, c = undeltas(value), unplanes(times, np.int64)
                keep = (c >= least) | (w == END)
                if top:
                    yield pa.RecordBatch.from_arrays([pa.array([deltas(w[keep])], pa.binary()), pa.array([planes(c[keep])], pa.binary())], names=["value", "times"])
                else:
                    yield pa.RecordBatch.from_arrays([pa.array(w[~keep].view(np.int64)), pa.array(c[~keep])], names=["word", "n"])

    head, counts = _collected(words_seen.mapInArrow(lambda b: split(b, True), "value binary, times binary").collect())
    tail = words_seen.mapInArrow(lambda b: split(b, False), "word long, n long")
    tree = Tree(head, counts, n, v, sum(r["once"] for r in found), sum(r["twice"] for r in found), tail)
    least_times = LEAST

    def frequent(batches):
        for batch in batches:
            for value, times in zip(batch.column("value").to_pylist(), batch.column("times").to_pylist(), strict=True):
                yield pa.RecordBatch.from_arrays([pa.array(undeltas(value)[unplanes(times, np.int64) >= least_times].view(np.int64))], names=["word"])

    spark, above = docs.sparkSession, None
    seen = spark.sparkContext.broadcast(Bits.of(words_seen.mapInArrow(frequent, "word long")).raw) if n else None
    codes = spark.sparkContext.broadcast(Codes.arrays(head, counts))
    while n:
        listed = materialise(_events(train, tree.depth + 1, buckets, seen, codes))
        _settle(spark)
        level = None if listed.isEmpty() else _level(tree, listed, above, gain)
        if level is None:
            break
        _settle(spark)
        entries, above, bits = level
        tree.levels.append(entries)
        tree.depth += 1
        if tree.depth > 1:
            bits.raw |= seen.value
        seen.destroy()
        seen = spark.sparkContext.broadcast(bits.raw)
    for shared in filter(None, (seen, codes)):
        shared.destroy()
    return tree


def head_entries(tree: Tree, most: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Keys and values of the most used entries, at most so many, sorted by key; and how often an entry of them is used at least."""
    every = tree.entries()
    if every is None:
        return np.zeros(0, np.uint64), np.zeros(0), 0
    least, room = 1 << 40, most
    for r in every.groupBy(F.floor(F.log2("times")).alias("level")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("level")).collect():
        if r["n"] > room:
            break
        least, room = 1 << r["level"], room - r["n"]
    got = every.where(F.col("times") >= least).select("key", "value").toArrow()
    keys, values = got.column("key").to_numpy().view(np.uint64), got.column("value").to_numpy()
    order = np.argsort(keys)
    return keys[order], values[order], least


def score(docs: DataFrame, tree: Tree, head_entries_at_most: int = HEAD_ENTRIES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score. docs: doc_id, text, train."""
    keys_, values_, least = head_entries(tree, head_entries_at_most)
    rest = tree.entries().where(F.col("times") < least) if tree.levels else None
    more = Bits.of(rest.select("key")) if rest is not None and not rest.isEmpty() else None
    buckets = bucket_count(docs)
    _settle(docs.sparkSession)
    at_once = (tree.head, starts(tree.head), tree.counts, tree.root, tree.n, tree.v, tree.unseen, tree.depth, keys_, starts(keys_), values_, more and more.raw)
    shared = docs.sparkSession.sparkContext.broadcast(at_once)
    named = {"doc_id": pa.int64(), "train": pa.bool_(), "n_tokens": pa.int64(), "n_known": pa.int64(), "base_score": pa.float64(), "score": pa.float64()}
    sent = {"bucket": pa.int32(), "run": pa.int64(), "kind": pa.int32(), "place": pa.int32(), **named, "keys": pa.binary(), "size": pa.binary(), "docs": pa.binary(), "times": pa.binary()}
    back = {"run": pa.int64(), "place": pa.int32(), **named, "docs": pa.binary(), "known": pa.binary(), "base": pa.binary(), "sums": pa.binary()}
    kinds = "bucket int, run long, kind int, place int, doc_id long, train boolean, n_tokens long, n_known long, base_score double, score double, keys binary, size binary, docs binary, times binary"
    kinds_back = "run long, place int, doc_id long, train boolean, n_tokens long, n_known long, base_score double, score double, docs binary, known binary, base binary, sums binary"
    n_all, v_all, discount, unseen = float(tree.n), float(tree.n + tree.v + 1), tree.discount, tree.unseen

    def filled(columns: dict, schema: dict, rows: int) -> list:
        return [columns[c] if isinstance(columns.get(c), pa.Array) else pa.array(columns[c], t) if c in columns else pa.nulls(rows, t) for c, t in schema.items()]

    def run(batches):
        head, head_starts, counts, root, n_train, v_train, unseen, depth, known_keys, key_starts, known_values, elsewhere = shared.value
        elsewhere = None if elsewhere is None else Bits(elsewhere)
        run, place = TaskContext.get().partitionId() << 34, 0
        held, n_held = {ENTRY: [], WORD: []}, 0

        def flush():
            rows = []
            for kind, parts in held.items():
                if not parts:
                    continue
                docs_, keys = (np.concatenate(x) for x in zip(*parts, strict=True))
                parts.clear()
                order = np.argsort(keys, kind="stable")
                docs_, keys = docs_[order], keys[order]
                heads = np.flatnonzero(np.concatenate([[True], (docs_[1:] != docs_[:-1]) | (keys[1:] != keys[:-1])])[: len(keys)])
                times = np.diff(np.append(heads, len(keys))).astype(np.uint32)
                docs_, keys = docs_[heads], keys[heads]
                b = bucket_of(keys, buckets)
                cut = np.concatenate([[0], np.flatnonzero(np.diff(b)) + 1, [len(b)]])
                for i, j in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
                    if j > i:
                        first = np.flatnonzero(np.concatenate([[True], keys[i + 1 : j] != keys[i : j - 1]]))
                        size = np.diff(np.append(first, j - i)).astype(np.uint32)
                        rows.append((int(b[i]), kind, *(squeezed(x) for x in (deltas(keys[i:j][first]), planes(size), planes(docs_[i:j]), planes(times[i:j])))))
            columns = {c: [r[k] for r in rows] for k, c in enumerate(("bucket", "kind", "keys", "size", "docs", "times"))}
            return pa.RecordBatch.from_arrays(filled({**columns, "run": [run] * len(rows)}, sent, len(rows)), names=list(sent))

        for batch in chunks(batches):
            h, rows = tokens(batch)
            n = batch.num_rows
            ids = find_hashed(head, head_starts, h)
            known = ids >= 0
            safe = np.maximum(ids, 0)
            # a word that is not broadcast counts as never seen until its count is met
            logp = np.where(known, root[safe], unseen) if len(root) else np.full(len(ids), unseen)
            never = np.log10(1.0 / (n_train + v_train + 1))
            base = np.where(known, np.log10((counts[safe] + 1.0) / (n_train + v_train + 1)), never) if len(counts) else np.full(len(ids), never)
            texts = (rows + place).astype(np.uint32)
            held[WORD].append((texts[~known], h[~known]))
            n_held += int((~known).sum())
            ctx, live = None, np.ones(len(h), bool)
            for d in range(1, depth + 1):
                ctx, ok = chain(h, rows, d, ctx)
                at = np.flatnonzero(ok & live)
                if not len(at):
                    break
                live = np.zeros(len(h), bool)
                for states in (True, False):
                    keys = ~ctx[at] if states else ctx[at] + h[at]
                    found = find_hashed(known_keys, key_starts, keys)
                    hit = found >= 0
                    logp[at[hit]] += known_values[found[hit]]
                    if elsewhere is not None:
                        there = np.flatnonzero(~hit)
                        there = there[elsewhere.has(keys[there])]
                        held[ENTRY].append((texts[at[there]], keys[there]))
                        n_held += len(there)
                        hit[there] = True
                    if states:  # only a state's words and longer contexts have entries
                        at = at[hit]
                        live[at] = True
            sums = lambda z: np.bincount(rows, z, minlength=n)  # noqa: B023, E731
            columns = {"bucket": np.full(n, (run >> 34) * 7919 % buckets + run % buckets) % buckets, "run": np.full(n, run), "kind": np.full(n, TEXT), "place": np.arange(place, place + n)}
            columns |= {"doc_id": batch.column("doc_id"), "train": batch.column("train"), "n_tokens": np.bincount(rows, minlength=n), "n_known": sums(known).astype(np.int64)}
            yield pa.RecordBatch.from_arrays(filled({**columns, "base_score": sums(base), "score": sums(logp)}, sent, n), names=list(sent))
            place += n
            if n_held >= RUN_KEYS or place >= RUN_TEXTS:
                yield flush()
                run, place, n_held = run + 1, 0, 0
        if place:
            yield flush()

    def summed(met: dict[int, list]) -> dict[int, list]:
        """(places, known, base, sums) of each run, each place once."""
        out = {}
        for run, parts in met.items():
            places, *sums = (np.concatenate(x) for x in zip(*parts, strict=True))
            docs_, inverse = np.unique(places, return_inverse=True)
            out[run] = [(docs_, *(np.bincount(inverse, x, len(docs_)) for x in sums))]
        return out

    def met_rows(met: dict[int, list]) -> list:
        rows = [(run, *(squeezed(planes(x)) for x in part)) for run, parts in met.items() for part in parts]
        return filled({c: [r[k] for r in rows] for k, c in enumerate(("run", "docs", "known", "base", "sums"))}, back, len(rows))

    def met_part(blobs, r: int) -> tuple[np.ndarray, ...]:
        docs_, *sums = (unsqueezed(blobs.column(c)[r].as_py()) for c in ("docs", "known", "base", "sums"))
        return unplanes(docs_, np.uint32), *(unplanes(x, np.float64) for x in sums)

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        """The texts as they are, and of each run's keys one sum a text."""
        table = {}
        kind, key, value = (right.column(c).to_numpy() for c in ("kind", "key", "value"))
        for k in (ENTRY, WORD):
            keys = key[kind == k].view(np.uint64)
            order = np.argsort(keys)
            table[k] = keys[order], value[kind == k][order]
        met: dict[int, list] = {}
        blobs = left.filter(pa.compute.not_equal(left.column("kind"), TEXT))
        for r in range(blobs.num_rows):
            k = blobs.column("kind")[r].as_py()
            keys, values = table[k]
            wanted, size, places, times = (unsqueezed(blobs.column(c)[r].as_py()) for c in ("keys", "size", "docs", "times"))
            at = np.repeat(find(keys, undeltas(wanted)), unplanes(size, np.uint32))
            hit = np.flatnonzero(at >= 0)
            if not len(hit):
                continue
            places, times, v = unplanes(places, np.uint32)[hit], unplanes(times, np.uint32)[hit].astype(float), values[at[hit]]
            if k == ENTRY:
                got = places, np.zeros(len(hit)), np.zeros(len(hit)), times * v
            else:
                got = places, times, times * np.log10(v + 1), times * (np.log10((v - discount) / n_all) - unseen)
            met.setdefault(blobs.column("run")[r].as_py(), []).append(got)
        texts = left.filter(pa.compute.equal(left.column("kind"), TEXT))
        whole = pa.Table.from_arrays([texts.column(c) if c in sent and c != "docs" else pa.chunked_array([pa.nulls(texts.num_rows, t)]) for c, t in back.items()], names=list(back))
        return pa.concat_tables([whole, pa.Table.from_arrays(met_rows(summed(met)), names=list(back))])

    def gather(batches):
        """The same with the sums of all ranges that a task met added up, so that a text gets back one sum a task, not a range."""
        met: dict[int, list] = {}
        for batch in batches:
            texts = batch.filter(pa.compute.is_valid(batch.column("place")))
            if texts.num_rows:
                yield texts
            blobs = batch.filter(pa.compute.is_null(batch.column("place")))
            for r in range(blobs.num_rows):
                met.setdefault(blobs.column("run")[r].as_py(), []).append(met_part(blobs, r))
            if sum(len(x[0]) for parts in met.values() for x in parts) >= RUN_KEYS:
                met = summed(met)
                if sum(len(x[0]) for parts in met.values() for x in parts) >= RUN_KEYS // 2:
                    yield pa.RecordBatch.from_arrays(met_rows(met), names=list(back))
                    met = {}
        if met:
            yield pa.RecordBatch.from_arrays(met_rows(summed(met)), names=list(back))

    def total(t: pa.Table) -> pa.Table:
        texts = t.filter(pa.compute.is_valid(t.column("place")))
        n, place = texts.num_rows, texts.column("place").to_numpy()
        more = np.zeros((3, n))
        blobs = t.filter(pa.compute.is_null(t.column("place")))
        for r in range(blobs.num_rows):
            places, *sums = met_part(blobs, r)
            for k, x in enumerate(sums):
                more[k, places] += x
        known, base, sums = more[:, place]
        plus = lambda c, x: texts.column(c).to_numpy() + x
        columns = [texts.column("doc_id"), pa.compute.invert(texts.column("train")), texts.column("n_tokens"), plus("n_known", known.astype(np.int64)), np.full(n, int(n_all)), plus("base_score", base), plus("score", sums)]
        return pa.table([x if isinstance(x, pa.ChunkedArray) else pa.array(x) for x in columns], names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    def dealt(keys: DataFrame, kind: int) -> DataFrame:
        bucket = F.shiftright(F.shiftrightunsigned("key", 32) * buckets, 32).cast("int")
        return keys.select(bucket.alias("bucket"), F.lit(kind).alias("kind"), "key", F.col("value").cast("double").alias("value"))

    known = dealt(tree.tail.select(F.col("word").alias("key"), F.col("n").alias("value")), WORD)
    if more is not None:
        known = known.unionByName(dealt(rest.select("key", "value"), ENTRY))
    out = docs.select("doc_id", "text", "train").mapInArrow(run, kinds).groupBy("bucket").cogroup(known.groupBy("bucket")).applyInArrow(meet, kinds_back).mapInArrow(gather, kinds_back)
    return materialise(out.groupBy("run").applyInArrow(total, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 2
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", (~F.coalesce(held_out, F.lit(False))).alias("train"))
    with arrow_rows(spark, ARROW_ROWS):
        return score(docs, fit(docs))
