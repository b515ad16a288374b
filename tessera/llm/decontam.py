"""Benchmark decontamination: CGK embedding, bit-sampling LSH over item-sized windows, exact verification.

Texts and items are sequences of lower-cased words. An item of L words is found where some stretch of a
document is within floor(``ratio`` * L) word edits of it.

1. Where to look: with e edits, some run of ceil((L - e) / (e + 1)) words of the item survives; so a window
   that matches holds an intact k-gram of the item, k at most that. Looking up k-grams only loses nothing.
2. Around those places every item-sized window is embedded by CGK random walks (edit distance becomes
   Hamming distance): at step j the walk outputs its current word and advances by a random bit of
   (j, word). Tables sample ``SAMPLES`` output positions each; the number of walks is raised until at each item length
   simulated edits at the largest distance are found with probability ``recall``. Lengths that ``MAX_WALKS`` do not bring there,
   and all longer ones, have no walks: each stretch with as many of the item's k-grams as the edits must leave is verified.
3. A window that shares a table's key with an item is verified by exact edit distance, ends free.

The items are broadcast ``ITEMS_PER_PASS`` at a time, so broadcast and driver are bounded for any benchmark; documents
stay where they are (no shuffle), and are scanned once a pass. Edge cases: null or wordless texts and items match nothing; equal
items are all reported; repeated documents are each reported; items too short for an edit must match exactly;
null ids, of documents and items, are carried through; texts of any length are read whole; other columns are ignored, or kept by ``clean``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, table
from .text import chunks, gram_hashes, mix, text_bytes, word_hashes, words

RATIO, RECALL, SEED_GRAM = 0.2, 0.99, 4
TABLES, SAMPLES, MAX_WALKS, TRIALS, ITEMS_PER_PASS = 8, 3, 16, 200, 20_000
_PAD = np.uint64(0xA0761D6478BD642F)
_KEY = np.uint64(0xE7037ED1A0B428DB)


def walk(sym: np.ndarray, steps: int, number: int) -> tuple[np.ndarray, np.ndarray]:
    """CGK walk over the columns of sym (words by offset; row i holds offset i): outputs and offsets by step."""
    reach, m = sym.shape
    at = np.zeros(m, np.int64)
    cols = np.arange(m)
    out, where = np.empty((steps, m), np.uint64), np.empty((steps, m), np.int32)
    for j in range(steps):
        w = sym[np.minimum(at, reach - 1), cols]
        out[j], where[j] = w, at
        salt = np.uint64((number * 0x9FB21C651E98DF25 + (j + 1) * 0xD6E8FEB86659FD93) & 0xFFFFFFFFFFFFFFFF)
        at = at + ((mix(w ^ salt) >> np.uint64(17)) & np.uint64(1)).astype(np.int64)
    return out, where


class Items:
    """The index of one pass's items; small arrays in proportion to the items."""

    def __init__(self, ids: list[int | None], hashes: list[np.ndarray], ratio: float = RATIO, recall: float = RECALL, walks: int | None = None):
        self.ids, self.words = list(ids), hashes
        self.sizes = np.array([len(h) for h in hashes], np.int64)
        self.edits = np.floor(self.sizes * ratio + 1e-9).astype(np.int64)
        self.lengths = np.unique(self.sizes)
        self.top = int(self.sizes.max(initial=0))
        rng = np.random.default_rng(9)
        self.places = {int(n): rng.integers(0, max(1, 2 * n), (MAX_WALKS, TABLES, SAMPLES)) for n in self.lengths}
        self.edit_of = {int(n): int(np.floor(n * ratio + 1e-9)) for n in self.lengths}
        # walks of each length; 0: exact
        self.walks = {int(n): walks for n in self.lengths} if walks else self._needed(recall)
        self.exact = self._exact()
        self.seeds: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        by_gram: dict[int, list] = {}
        for h in hashes:
            if not self.walks[len(h)]:
                continue
            k = self._gram(len(h))
            g = gram_hashes(h, k, seed=k)
            by_gram.setdefault(k, []).append((g, np.full(len(g), len(h)), np.arange(len(g))))
        for k, parts in by_gram.items():
            g, size, off = (np.concatenate(x) for x in zip(*parts, strict=True))
            trio = np.unique(np.stack([g, size.astype(np.uint64), off.astype(np.uint64)], 1), axis=0)
            self.seeds[k] = trio[:, 0].copy(), trio[:, 1].astype(np.int64), trio[:, 2].astype(np.int64)
        self.tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for n in self.lengths.tolist():
            if not self.walks[n]:
                continue
            own = np.flatnonzero(self.sizes == n)
            sym = np.stack([self.words[i] for i in own], 1)
            key = self.keys(sym, np.full(len(own), n), self.walks[n])
            flat, item = key.reshape(-1), np.tile(own, key.shape[0])
            order = np.argsort(flat, kind="stable")
            self.tables[n] = flat[order], item[order]

    def keys(self, sym: np.ndarray, size: np.ndarray, walks: int) -> np.ndarray:
        """LSH keys, one row for each table of each walk, of windows given as columns with their lengths."""
        out = np.empty((walks * TABLES, sym.shape[1]), np.uint64)
        for w in range(walks):
            got, where = walk(sym, 2 * int(size.max(initial=1)), w)
            for n in np.unique(size).tolist():
                cols = np.flatnonzero(size == n)
                for t in range(TABLES):
                    key = np.full(len(cols), (w * TABLES + t) * 0x9E3779B1 + n, np.uint64)
                    for j in self.places[n][w, t].tolist():
                        key = mix(key * _KEY + np.where(where[j, cols] < n, got[j, cols], _PAD))
                    out[w * TABLES + t, cols] = key
        return out

    def _needed(self, recall: float) -> dict[int, int]:
        """Walks of each length after which simulated edits at the largest distance collide with probability recall; 0 where none do."""
        out, rng = dict.fromkeys(self.lengths.tolist(), 0), np.random.default_rng(10)
        for n in self.lengths.tolist():
            own = np.flatnonzero(self.sizes == n)
            pick = own[np.linspace(0, len(own) - 1, TRIALS).astype(int)]
            edited = []
            for i in pick.tolist():
                x = self.words[i].tolist()
                for _ in range(self.edit_of[n]):
                    p, kind = int(rng.integers(0, max(1, len(x)))), int(rng.integers(0, 3))
                    new = int(rng.integers(1, 1 << 62))
                    x[p : p + (kind != 1)] = [] if kind == 2 else [new]
                edited.append(np.array((x + rng.integers(1, 1 << 62, n).tolist())[:n], np.uint64))
            both = np.stack([*(self.words[i] for i in pick.tolist()), *edited], 1)
            k = self.keys(both, np.full(2 * TRIALS, n), MAX_WALKS)
            hit = (k[:, :TRIALS] == k[:, TRIALS:]).reshape(MAX_WALKS, TABLES, TRIALS).any(1)
            enough = np.flatnonzero(np.logical_or.accumulate(hit, axis=0).mean(1) >= recall)
            if not len(enough):
                break
            out[n] = int(enough[0]) + 1
        # each length's figure is an estimate: all that have walks get as many as the neediest
        most = max(out.values(), default=0)
        return {n: most if w else 0 for n, w in out.items()}

    def _exact(self) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """k-grams of the items without walks, sorted, with their item and place; by k."""
        by_gram: dict[int, list] = {}
        for i, h in enumerate(self.words):
            if not self.walks[len(h)]:
                k = self._gram(len(h))
                g = gram_hashes(h, k, seed=k)
                by_gram.setdefault(k, []).append((g, np.full(len(g), i), np.arange(len(g))))
        out = {}
        for k, parts in by_gram.items():
            g, item, off = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.argsort(g, kind="stable")
            out[k] = g[order], item[order], off[order]
        return out

    def _gram(self, n: int) -> int:
        e = self.edit_of[n]
        return min(SEED_GRAM, -(-(n - e) // (e + 1)))

    def _stretches(self, h: np.ndarray, rows: np.ndarray) -> list[tuple[int, int, int]]:
        """(item, a word within its edits of the start) wherever enough k-grams of an item without walks lie along one another, and its row."""
        found: list[tuple[int, int, int]] = []
        for k, (seed, item, off) in self.exact.items():
            g = gram_hashes(h, k, seed=k)
            ok = np.flatnonzero(rows[: len(g)] == rows[k - 1 :]) if len(g) else np.zeros(0, np.int64)
            g = g[ok]
            lo, hi = np.searchsorted(seed, g, "left"), np.searchsorted(seed, g, "right")
            near = np.flatnonzero(hi > lo)
            if not len(near):
                continue
            lo, count = lo[near], (hi - lo)[near]
            entry = np.repeat(lo - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
            q = np.repeat(ok[near], count)
            start, owner = q - off[entry], item[entry]
            order = np.lexsort((start, rows[q], owner))
            start, owner, row = start[order], owner[order], rows[q][order]
            cut = np.concatenate([[0], np.flatnonzero((np.diff(owner) != 0) | (np.diff(row) != 0)) + 1, [len(owner)]])
            for i, j in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
                n, e = int(self.sizes[owner[i]]), int(self.edits[owner[i]])
                # an edit breaks at most k of the item's k-grams; those left start within e of the stretch
                least = max(1, n - k + 1 - k * e)
                s = start[i:j]
                many = np.searchsorted(s, s + 2 * e, "right") - np.arange(len(s)) >= least
                found += [(int(owner[i]), x, int(row[i])) for x in np.unique(s[many]).tolist()]
        return found

    def find(self, h: np.ndarray, rows: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(row, item, first word, end, distance) in a chunk's words h with their rows; indices into the chunk."""
        starts, sizes = [], []
        for k, (seed, size, off) in self.seeds.items():
            g = gram_hashes(h, k, seed=k)
            if not len(g):
                continue
            ok = np.flatnonzero(rows[: len(g)] == rows[k - 1 :])
            g = g[ok]
            lo = np.searchsorted(seed, g, "left")
            near = np.flatnonzero(seed[np.minimum(lo, len(seed) - 1)] == g)
            if not len(near):
                continue
            lo, hi = lo[near], np.searchsorted(seed, g[near], "right")
            count = hi - lo
            entry = np.repeat(lo - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
            q = np.repeat(ok[near], count)
            for e in np.unique([self.edit_of[n] for n in np.unique(size[entry]).tolist()]).tolist():
                mine = np.array([self.edit_of[n] == e for n in self.lengths.tolist()])[np.searchsorted(self.lengths, size[entry])]
                at = (q - off[entry])[mine][:, None] + np.arange(-e, e + 1)
                at = np.maximum(at, 0)
                row = np.repeat(rows[q[mine]], 2 * e + 1)
                flat, n = at.reshape(-1), np.repeat(size[entry][mine], 2 * e + 1)
                flat = np.minimum(flat, len(h) - 1)
                keep = rows[flat] == row
                starts.append(flat[keep])
                sizes.append(n[keep])
        found = self._stretches(h, rows)
        if starts:
            both = np.unique(np.stack([np.concatenate(starts), np.concatenate(sizes)], 1), axis=0)
            of = np.array([self.walks[n] for n in self.lengths.tolist()])[np.searchsorted(self.lengths, both[:, 1])]
            for walks in np.unique(of).tolist():
                found += self._collide(h, rows, *both[of == walks].T, walks)
        out, last = [], {}
        for item, s, row in sorted(set(found)):
            if s < last.get((row, item), -1):
                continue
            if hit := self.verify(h, rows, item, s, row):
                last[row, item] = hit[1]
                out.append((row, item, *hit))
        return out

    def _collide(self, h: np.ndarray, rows: np.ndarray, start: np.ndarray, size: np.ndarray, walks: int) -> list[tuple[int, int, int]]:
        """(item, first word, row) of the windows that share a key with an item of their length."""
        found: list[tuple[int, int, int]] = []
        for a in range(0, len(start), 8192):
            s, n = start[a : a + 8192], size[a : a + 8192]
            at = s[None, :] + np.arange(int(n.max()))[:, None]
            end = np.minimum(at, len(h) - 1)
            sym = np.where((at < len(h)) & (rows[end] == rows[s][None, :]), h[end], _PAD)
            key = self.keys(sym, n, walks)
            for x in np.unique(n).tolist():
                cols = np.flatnonzero(n == x)
                keys, item = self.tables[x]
                k = key[:, cols]
                lo, hi = np.searchsorted(keys, k, "left"), np.searchsorted(keys, k, "right")
                r, c = np.nonzero(hi > lo)
                for i, j, col in zip(lo[r, c].tolist(), hi[r, c].tolist(), c.tolist(), strict=True):
                    found += [(int(y), int(s[cols[col]]), int(rows[s[cols[col]]])) for y in item[i:j]]
        return found

    def verify(self, h: np.ndarray, rows: np.ndarray, item: int, s: int, row: int) -> tuple[int, int, int] | None:
        """The best stretch near s within the item's edits: first word, end, distance."""
        x, e = self.words[item], int(self.edits[item])
        n = len(x)
        if s >= 0 and rows[s] == row and s + n <= len(h) and rows[s + n - 1] == row and np.array_equal(h[s : s + n], x):
            return s, s + n, 0
        lo, hi = max(0, s - e), min(len(h), s + n + e)
        here = np.flatnonzero(rows[lo:hi] == row)
        lo, hi = lo + int(here[0]), lo + int(here[-1]) + 1
        y = h[lo:hi]
        last = edit_row(x, y, True)
        end = int(last.argmin())
        if last[end] > e:
            return None
        back = edit_row(x[::-1], y[:end][::-1], False)
        return lo + end - int(back.argmin()), lo + end, int(last[end])


def edit_row(x: np.ndarray, y: np.ndarray, free: bool) -> np.ndarray:
    """Edit distances of the whole of x to the stretches of y that end at each place; free: they may begin anywhere."""
    n = np.arange(len(y) + 1)
    d = np.zeros(len(y) + 1, np.int64) if free else n.copy()
    for i, w in enumerate(x):
        t = d + 1
        t[1:] = np.minimum(t[1:], d[:-1] + (y != w))
        t[0] = i + 1
        d = np.minimum.accumulate(t - n) + n
    return d


def item_words(texts: list[str | None]) -> list[np.ndarray]:
    data, offsets = text_bytes(pa.array(texts, pa.string()))
    starts, ends, rows = words(data, offsets)
    h = word_hashes(data, starts, ends, lower=True)
    cut = np.searchsorted(rows, np.arange(len(texts) + 1))
    return [h[cut[i] : cut[i + 1]] for i in range(len(texts))]


def hits(docs: DataFrame, items: DataFrame, ratio: float = RATIO, recall: float = RECALL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document, item and place: doc_id, item_id, start, end (words), distance, item_words, similarity."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = None
    for index, last in _passes(items, ratio, recall):
        shared = docs.sparkSession.sparkContext.broadcast(index)
        part = _scan(docs, shared)
        if out is not None or not last:  # more than one pass: only the running one's index is held
            part = materialise(part)
            shared.destroy()
        out = part if out is None else out.unionByName(part)
    return out


def _passes(items: DataFrame, ratio: float, recall: float):
    """(index, whether it is the last) for each ``ITEMS_PER_PASS`` items, one after the other; one without items if there are none."""
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    passes = max(1, -(-items.count() // ITEMS_PER_PASS))
    for p in range(passes):
        got = (items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == p) if passes > 1 else items).orderBy("item_id", "text").collect()
        kept = [(r["item_id"], w) for r, w in zip(got, item_words([r["text"] for r in got]), strict=True) if len(w)]
        yield Items([i for i, _ in kept], [w for _, w in kept], ratio, recall), p == passes - 1


def _scan(docs: DataFrame, shared) -> DataFrame:
    names = ["doc_id", "item_id", "start", "end", "distance", "item_words"]

    def run(batches):
        found = shared.value
        for batch in chunks(batches):
            data, offsets = text_bytes(batch.column("text"))
            starts, ends, rows = words(data, offsets)
            got = found.find(word_hashes(data, starts, ends, lower=True), rows) if found.ids else []
            ids = batch.column("doc_id")
            first = np.searchsorted(rows, np.arange(batch.num_rows))
            cols = [
                [ids[r].as_py() for r, *_ in got],
                [found.ids[i] for _, i, *_ in got],
                [s - int(first[r]) for r, _, s, _, _ in got],
                [e - int(first[r]) for r, _, _, e, _ in got],
                [d for *_, d in got],
                [int(found.sizes[i]) for _, i, *_ in got],
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=names)

    out = docs.mapInArrow(run, ", ".join(f"`{n}` long" for n in names))
    return out.withColumn("similarity", 1 - F.col("distance") / F.col("item_words"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def clean(docs: DataFrame, items: DataFrame, ratio: float = RATIO, recall: float = RECALL, text_col: str = "text") -> DataFrame:
    """docs without those that hold an item; all columns stay. Narrow: a filter, no join."""
    first = True
    for index, last in _passes(items, ratio, recall):
        if not index.ids:
            continue
        shared = docs.sparkSession.sparkContext.broadcast(index)
        docs = docs.where(~_holds(shared)(F.col(text_col).cast("string")))
        if not (first and last):  # more than one pass: only the running one's index is held
            docs = materialise(docs)
            shared.destroy()
        first = False
    return docs


def _holds(shared):
    @F.arrow_udf("boolean")
    def holds(texts: pa.Array) -> pa.Array:
        parts = []
        for batch in chunks([pa.RecordBatch.from_arrays([texts], names=["text"])]):
            data, offsets = text_bytes(batch.column("text"))
            starts, ends, rows = words(data, offsets)
            flag = np.zeros(batch.num_rows, bool)
            for r, *_ in shared.value.find(word_hashes(data, starts, ends, lower=True), rows):
                flag[r] = True
            parts.append(flag)
        return pa.array(np.concatenate(parts) if parts else np.zeros(0, bool))

    return holds
