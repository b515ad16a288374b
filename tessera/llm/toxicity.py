"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Fit (labels of training rows only): a bounded, hash-ordered sample of at most ``max_examples`` labelled
documents, copies with one label once (their 3-word shingle sets are equal); all of their terms whose presence differs between the classes by a chi-square of at least
``min_chi2`` (a test, not a number of terms); inverse document frequencies of those terms over all documents of
the corpus; an isotonic map from leave-one-out votes to probabilities.

Score: the query's ``k`` nearest examples by exact cosine. Postings lie in blocks of examples aligned over
all terms, each with its largest weight; blocks are opened in falling order of the query's upper
bound, until no unopened block can beat the k-th best. Votes are weighted by 1 / (distance + 0.05),
and calibrated. The neighbours are returned as evidence.

Edge cases: null and empty texts, and texts without an informative term, have no neighbour and get the
calibrated rate of such training texts; without labelled rows of both classes all scores are the
observed rate (0 without any). Ties in similarity go to the smaller example id. Null labels and labelled
ids without a document are ignored; of an id's conflicting labels the larger counts. One row per input row, null ids too.
"""

from __future__ import annotations

import re
from collections import Counter
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_rows, discard, materialise, table
from .text import chunks, shingle_sets, text_bytes

MAX_EXAMPLES, MIN_CHI2, MIN_DF, K, BLOCK, FIRST_BLOCKS, ARROW_ROWS = 12_000, 24.0, 5, 25, 64, 16, 2000
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")


def terms(text: str | None) -> dict[str, int]:
    """Counts of the lower-cased words, without punctuation at their ends."""
    out: dict[str, int] = {}
    for w, n in Counter((text or "").lower().split()).items():
        if not w.isalnum():
            w = _EDGE.sub("", w)
        if w:
            out[w] = out.get(w, 0) + n
    return out


class Model:
    """A fitted classifier: small arrays, bounded by max_examples and their texts."""

    def __init__(self, vocabulary: dict[str, int], idf: np.ndarray, bags: list[dict[int, int]], ids, labels, k: int = K):
        self.vocabulary, self.idf, self.k = vocabulary, idf, k
        self.ids, self.labels = np.asarray(ids, np.int64), np.asarray(labels, np.float64)
        self.prior = float(self.labels.mean()) if len(self.labels) else 0.0
        # like examples side by side: a block's bound is tight where its members share their heaviest terms
        vectors = [self.vector(b) for b in bags]
        heaviest = [tuple(t[np.lexsort((t, -w))].tolist()) for t, w in vectors]
        order = sorted(range(len(bags)), key=lambda i: (not heaviest[i], heaviest[i], self.ids[i]))
        vectors, self.ids, self.labels = [vectors[i] for i in order], self.ids[order], self.labels[order]
        n = len(bags)
        self.vectors = vectors
        self.blocks = (n + BLOCK - 1) // BLOCK
        term = np.concatenate([t for t, _ in vectors]) if n else np.zeros(0, np.int64)
        example = np.repeat(np.arange(n), [len(t) for t, _ in vectors])
        order = np.argsort(term, kind="stable")
        self.posting_ids = example[order].astype(np.int32)
        self.posting_weights = np.concatenate([w for _, w in vectors])[order] if n else np.zeros(0)
        # where each term's postings of each block begin; the next entry is where they end
        cell = term[order] * max(1, self.blocks) + self.posting_ids // BLOCK
        self.marks = np.searchsorted(cell, np.arange(len(vocabulary) * max(1, self.blocks) + 1)).astype(np.int32)
        self.block_max = np.zeros((len(vocabulary), max(1, self.blocks)), np.float32)
        np.maximum.at(self.block_max.reshape(-1), cell, (self.posting_weights * (1 + 1e-6)).astype(np.float32))
        self.curve = (np.zeros(1), np.full(1, self.prior))
        self.bare = self.prior

    def bag(self, text: str | None) -> dict[int, int]:
        out: dict[int, int] = {}
        get = self.vocabulary.get
        for w, n in terms(text).items():
            if (t := get(w)) is not None:
                out[t] = n
        return out

    def vector(self, bag: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
        t = np.array(sorted(bag), np.int64)
        w = (1 + np.log(np.array([bag[x] for x in t.tolist()], np.float64))) * self.idf[t] if len(t) else np.zeros(0)
        norm = np.sqrt((w * w).sum())
        return (t, w / norm) if norm > 0 else (t[:0], w[:0])

    def nearest(self, t: np.ndarray, w: np.ndarray, k: int, skip: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Example numbers and exact cosines of the k nearest with a positive cosine, best first."""
        if not len(t):
            return np.zeros(0, np.int64), np.zeros(0)
        bound = w @ self.block_max[t]
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        best_i, best_s, at, step = np.zeros(0, np.int64), np.zeros(0), 0, FIRST_BLOCKS
        while at < len(order) and (len(best_s) < k or bound[order[at]] >= best_s[-1]):
            opened = order[at : at + step]
            if len(best_s) >= k:
                opened = opened[bound[opened] >= best_s[-1]]
            at, step = at + step, step * 2
            cell = (t[:, None] * self.blocks + opened[None, :]).reshape(-1)
            lo, size = self.marks[cell], self.marks[cell + 1] - self.marks[cell]
            # postings of all opened cells side by side
            total = int(size.sum())
            start = np.cumsum(size) - size
            at_posting = np.repeat(lo - start, size) + np.arange(total)
            ids = self.posting_ids[at_posting]
            weight = np.repeat(np.repeat(w, len(opened)), size) * self.posting_weights[at_posting]
            sums = np.bincount(ids, weight, minlength=len(self.ids))
            found = np.flatnonzero(sums > 0)
            found = found[found != skip]
            best_i, best_s = np.concatenate([best_i, found]), np.concatenate([best_s, sums[found]])
            if len(best_s) > 4 * k:  # all that may still be among the k nearest, ties included
                least = np.partition(best_s, len(best_s) - k)[len(best_s) - k]
                best_i, best_s = best_i[best_s >= least], best_s[best_s >= least]
            top = np.lexsort((self.ids[best_i], -best_s))[:k]
            best_i, best_s = best_i[top], best_s[top]
        return best_i, best_s

    def vote(self, i: np.ndarray, s: np.ndarray) -> float:
        weight = 1 / (np.maximum(0.0, 1 - s) + 0.05)
        return float((weight * self.labels[i]).sum() / weight.sum())

    def left_out(self, n: int) -> float:
        """The vote on an example without itself; nan without a neighbour."""
        i, s = self.nearest(*self.vectors[n], self.k, skip=n)
        return self.vote(i, s) if len(i) else float("nan")

    def calibrate(self, votes: np.ndarray) -> None:
        """Fit the map from votes to probabilities to every example's left-out vote."""
        bare = np.isnan(votes)
        self.bare = float((self.labels[bare].sum() + self.prior) / (bare.sum() + 1))
        if not bare.all():
            x, y = votes[~bare], self.labels[~bare]
            order = np.argsort(x, kind="stable")
            self.curve = isotonic(x[order], y[order])

    def score(self, text: str | None) -> tuple[float, np.ndarray, np.ndarray]:
        t, w = self.vector(self.bag(text))
        i, s = self.nearest(t, w, self.k)
        if not len(i):
            return self.bare, i, s
        v = self.vote(i, s)
        # the vote breaks ties within a level of the calibrated steps
        p = float(np.interp(v, *self.curve))
        return min(1.0, max(0.0, 0.998 * p + 0.002 * v)), i, s


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over equal-width steps of x: centres and means, rising."""
    level: list[list[float]] = []
    for a, b in zip(x.tolist(), y.tolist(), strict=True):
        level.append([b, 1.0, a])
        while len(level) > 1 and (level[-2][0] >= level[-1][0] or level[-2][2] / level[-2][1] == level[-1][2] / level[-1][1]):
            m, n, c = level.pop()
            p = level[-1]
            level[-1] = [(p[0] * p[1] + m * n) / (p[1] + n), p[1] + n, p[2] + c]
    xs, ys = np.array([c / n for _, n, c in level]), np.array([(m * n + 0.5 * float(y.mean())) / (n + 0.5) for m, n, _ in level])
    return xs, np.maximum.accumulate(ys)


def fold(id_col: str = "doc_id", folds: int = 5):
    """crc32 of the id's text, modulo the number of folds; a null id is in fold 0."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(folds)), F.lit(0))


def fit(docs: DataFrame, labels: DataFrame, max_examples: int = MAX_EXAMPLES, min_chi2: float = MIN_CHI2, k: int = K) -> Model:
    """docs: doc_id, text of the whole corpus; labels: doc_id, toxic of the training rows only."""
    marks = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("__toxic"))
    # a bounded sample of labelled rows, in the order of a hash: at most max_examples small rows are broadcast
    chosen = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_examples)
    picked = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    # copies would pass for independent evidence: of texts with equal 3-word shingle sets and one label the smallest id stays
    examples = materialise(_bags(picked).groupBy("digest", "toxic").agg(F.min(F.struct("doc_id", "words", "counts")).alias("x")).select("toxic", "x.*"))
    ranked = (
        examples.select("toxic", F.explode("words").alias("w"))
        .groupBy("w")
        .agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b"))
        .crossJoin(F.broadcast(examples.agg(F.sum("toxic").alias("n1"), F.sum(1 - F.col("toxic")).alias("n0"))))
        .where(f"a + b >= {MIN_DF} and n0 > 0 and n1 > 0")
        .withColumn("chi2", F.expr("(n0 + n1) * power(cast(a * (n0 - b) - b * (n1 - a) as double), 2) / nullif((a + b) * (n0 + n1 - a - b) * cast(n1 as double) * n0, 0)"))
        .where(F.col("chi2") >= min_chi2)
        .orderBy(F.desc("chi2"), "w")
        .select("w")
        .collect()
    )
    vocabulary = {r["w"]: i for i, r in enumerate(ranked)}
    total, df = corpus_df(docs, vocabulary)
    idf = np.log((total + 1) / (df + 1)) + 1e-3
    slim = _numbered(examples, vocabulary).orderBy("doc_id", "toxic").collect()
    discard(examples)
    bags = [dict(zip(*(np.frombuffer(r[c], np.int32).tolist() for c in ("terms", "counts")), strict=True)) for r in slim]
    model = Model(vocabulary, idf, bags, [r["doc_id"] for r in slim], [r["toxic"] for r in slim], k)
    if 0 < model.prior < 1:
        model.calibrate(_left_out(docs.sparkSession, model))
    return model


def _left_out(spark: SparkSession, model: Model) -> np.ndarray:
    """Every example's left-out vote, made by the executors: at most max_examples numbers."""
    shared, n = spark.sparkContext.broadcast(model), len(model.ids)

    def run(batches):
        for batch in batches:
            at = batch.column("id").to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array([shared.value.left_out(i) for i in at], pa.float64())], names=["id", "vote"])

    got = spark.range(0, n, 1, max(1, n // 200)).mapInArrow(run, "id long, vote double").toArrow()
    votes = np.full(n, np.nan)
    votes[got.column("id").to_numpy()] = got.column("vote").to_numpy(zero_copy_only=False)
    shared.unpersist()
    return votes


def shingle_digests(column: pa.Array) -> list[bytes]:
    """128 bits of the set of 3-word shingles of every row."""
    rows, values = shingle_sets(*text_bytes(column), n=3)
    cut = np.searchsorted(rows, np.arange(len(column) + 1)).tolist()
    return [blake2b(values[i:j].tobytes(), digest_size=16).digest() for i, j in zip(cut[:-1], cut[1:], strict=True)]


def _numbered(examples: DataFrame, vocabulary: dict[str, int]) -> DataFrame:
    """doc_id, toxic and the vocabulary's terms with their counts, as int32 buffers."""

    def run(batches):
        for batch in batches:
            terms_, counts = [], []
            for ws, ns in zip(batch.column("words").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                pairs = [(t, n) for w, n in zip(ws, ns, strict=True) if (t := vocabulary.get(w)) is not None]
                terms_.append(np.array([t for t, _ in pairs], np.int32).tobytes())
                counts.append(np.array([n for _, n in pairs], np.int32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("toxic"), pa.array(terms_, pa.binary()), pa.array(counts, pa.binary())], names=["doc_id", "toxic", "terms", "counts"]
            )

    return examples.select("doc_id", "toxic", "words", "counts").mapInArrow(run, "doc_id long, toxic int, terms binary, counts binary")


def _bags(picked: DataFrame) -> DataFrame:
    """doc_id, toxic and the distinct terms with counts of the bounded sample."""

    def run(batches):
        for batch in chunks(batches):
            words, counts = [], []
            for t in batch.column("text").to_pylist():
                c = terms(t)
                words.append(list(c))
                counts.append(list(c.values()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(shingle_digests(batch.column("text")), pa.binary()), batch.column("doc_id").cast(pa.int64()), batch.column("__toxic"), pa.array(words, pa.list_(pa.string())), pa.array(counts, pa.list_(pa.int32()))],
                names=["digest", "doc_id", "toxic", "words", "counts"],
            )

    return picked.mapInArrow(run, "digest binary, doc_id long, toxic int, words array<string>, counts array<int>")


def corpus_df(docs: DataFrame, vocabulary: dict[str, int]) -> tuple[int, np.ndarray]:
    """Number of documents, and of those with each term, over the whole corpus; one small row a task."""
    n = len(vocabulary)

    def run(batches):
        df, total = np.zeros(n, np.int64), 0
        for batch in chunks(batches):
            for t in batch.column("text").to_pylist():
                total += 1
                hit = vocabulary.keys() & terms(t).keys()
                for w in hit:
                    df[vocabulary[w]] += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([[-1], at]), pa.int32()), pa.array(np.concatenate([[total], df[at]]), pa.int64())], names=["term", "n"]
        )

    rows = docs.select("text").mapInArrow(run, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    df, total = np.zeros(n, np.float64), 0
    for r in rows:
        if r["term"] < 0:
            total = r["n"]
        else:
            df[r["term"]] = r["n"]
    return total, df


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", evidence: int = 5) -> DataFrame:
    """One row per document: score, predicted and the nearest examples as evidence. Narrow: no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()

    def run(batches):
        m = shared.value
        for batch in chunks(batches):
            got = [m.score(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([g[0] for g in got], pa.float64()),
                    pa.array([int(g[0] >= 0.5) for g in got], pa.int32()),
                    pa.array([m.ids[g[1][:evidence]].tolist() for g in got], pa.list_(pa.int64())),
                    pa.array([g[2][:evidence].tolist() for g in got], pa.list_(pa.float64())),
                ],
                names=["doc_id", "score", "predicted", "nearest", "similarity"],
            )

    return source.mapInArrow(run, f"doc_id {kind}, score double, predicted int, nearest array<long>, similarity array<double>")


def scorer(spark: SparkSession, model: Model):
    """The score as a function of a text column."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def run(texts: pa.Array) -> pa.Array:
        m = shared.value
        return pa.array([m.score(t)[0] for t in texts.to_pylist()], pa.float64())

    return run


def train(spark: SparkSession, sf_dir: str, docs: DataFrame | None = None) -> Model:
    """Fit on the labelled rows outside fold 0."""
    docs = table(spark, sf_dir, "documents") if docs is None else docs
    with arrow_rows(spark, ARROW_ROWS):
        return fit(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic").where(fold() != 0))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = score(docs, train(spark, sf_dir, docs))
    return out.select("doc_id", (fold() == 0).alias("held_out"), "score", "predicted", "nearest", "similarity")
