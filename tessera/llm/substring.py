"""Removal of repeated 13-word passages over a log-structured fingerprint index.

Windows of ``WINDOW`` consecutive words are fingerprinted in two parts: the least hash of the 5-word
grams inside it (which neighbouring windows share, so one entry of the index stands for several windows) and all 64 bits
of the whole window's hash, the check. Each batch of texts becomes one sorted, immutable run per bucket of the
fingerprint's range: entries (fingerprint, smallest document id, position, mask and checks of the
windows). Within a batch, windows that repeat are settled at once and only the least document's copy goes into the run,
so a passage of any frequency costs one entry a batch. Runs of a bucket, and of the history if there is
one, are merge-joined: equal fingerprints and equal checks make equal windows, and a window whose
least document is smaller than its own is removed. Windows around one frequent gram share the first part, so only the check's
64 bits count against false matches: words are not compared. ``compact`` folds all runs of a bucket into one. A run says how many buckets it was
dealt to, and is dealt anew where a batch or a compaction has another number.

Order: a window is removed iff its word sequence also starts in a document of smaller id; windows are judged on the
input. Edge cases: null texts have no words; texts below 13 words keep all; a null id counts as larger
than all others; rows with one id are one document for the order, and removals find their row by id and checksum of the
text, so equal rows get equal results and others their own; windows never span documents; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import zlib
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_rows, materialise, table
from .runs import bucket_count, bucket_of, deltas, planes, undeltas, unplanes
from .text import chunks, gram_hashes, release, text_bytes, word_hashes, words

WINDOW, GRAM = 13, 5
RUN_WORDS, BUCKETS_PER_16MB, ARROW_ROWS = 700_000, 6, 1500
LAST = np.iinfo(np.int64).max
_RUN = "bucket int, dealt int, fp binary, doc binary, pos binary, mask binary, checks binary, tag binary"


def fingerprints(hashes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For words with their rows: the index of every window's first word, its fingerprint and its check."""
    n = len(hashes) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    grams = gram_hashes(hashes, GRAM, seed=GRAM)
    low = grams.copy()
    reach, left = 1, WINDOW - GRAM + 1  # sliding minimum by doubling
    while reach < left:
        step = min(reach, left - reach)
        low = np.minimum(low[: len(low) - step], low[step:])
        reach += step
    whole = gram_hashes(hashes, WINDOW, seed=WINDOW)
    at = np.flatnonzero(rows[:n] == rows[WINDOW - 1 :])
    return at, low[at], whole[at]


def tags(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A checksum of every row's text."""
    return np.array([zlib.crc32(data[i:j]) for i, j in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)], np.uint32)


def least_docs(fp: np.ndarray, check: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by (fingerprint, check) and, in that order, the least document of every window's group."""
    order = np.argsort(check)
    f, c = fp[order], check[order]
    if ((c[1:] == c[:-1]) & (f[1:] != f[:-1])).any():  # one check under two fingerprints
        order = np.lexsort((fp, check))
        f, c = fp[order], check[order]
    new = np.empty(len(order), bool)
    new[:1] = True
    new[1:] = (f[1:] != f[:-1]) | (c[1:] != c[:-1])
    starts = np.flatnonzero(new)
    low = np.minimum.reduceat(doc[order], starts) if len(order) else doc[order]
    return order, np.repeat(low, np.diff(np.append(starts, len(order))))


def _pack(bucket: int, buckets: int, fp, doc, pos, mask, check, tag) -> tuple:
    return bucket, buckets, deltas(fp), planes(doc), planes(pos), planes(mask), planes(check), planes(tag)


def make_run(fp: np.ndarray, check: np.ndarray, doc: np.ndarray, pos: np.ndarray, tag: np.ndarray, buckets: int) -> list[tuple]:
    """A sorted run per bucket of windows given in order of document, tag and position."""
    if not len(fp):
        return []
    head = np.empty(len(fp), bool)
    head[0] = True
    head[1:] = (fp[1:] != fp[:-1]) | (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1]) | (pos[1:] < pos[:-1])
    entry = np.cumsum(head) - 1
    start = pos[np.flatnonzero(head)]
    far = (pos - start[entry]) // 16  # a mask holds 16 windows
    head[1:] |= (far[1:] != far[:-1]) & (entry[1:] == entry[:-1])
    heads = np.flatnonzero(head)
    entry = np.cumsum(head) - 1
    bit = (pos - pos[heads][entry]).astype(np.uint16)
    mask = np.bitwise_or.reduceat(np.left_shift(np.uint16(1), bit), heads)
    order = np.argsort(fp[heads], kind="stable")
    size = np.diff(np.append(heads, len(fp)))
    lead = heads[order]
    windows = np.repeat(lead - np.concatenate([[0], np.cumsum(size[order])[:-1]]), size[order]) + np.arange(len(fp))
    f, d, p, m, c, t = fp[lead], doc[lead], pos[lead].astype(np.uint32), mask[order], check[windows], tag[lead]
    b = bucket_of(f, buckets)
    cut = np.concatenate([[0], np.flatnonzero(np.diff(b)) + 1, [len(b)]])
    first = np.concatenate([[0], np.cumsum(size[order])])
    return [_pack(int(b[i]), buckets, f[i:j], d[i:j], p[i:j], m[i:j], c[first[i] : first[j]], t[i:j]) for i, j in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]


def expand(fp: bytes, doc: bytes, pos: bytes, mask: bytes, checks: bytes, tag: bytes) -> tuple:
    """The windows of a run: fingerprint, check, document, position, tag."""
    f, d, p, m, t = undeltas(fp), unplanes(doc, np.int64), unplanes(pos, np.uint32), unplanes(mask, np.uint16), unplanes(tag, np.uint32)
    bits = (m[:, None] >> np.arange(16, dtype=np.uint16)) & 1
    e, bit = np.nonzero(bits)
    return f[e], unplanes(checks, np.uint64), d[e], (p[e] + bit).astype(np.int64), t[e]


def _home(doc: np.ndarray, buckets: int) -> np.ndarray:
    """pmod(xxhash64(doc), buckets), as Spark has it."""
    u = np.uint64
    one, two, three, four, five = (u(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
    k = doc.view(u) * two
    k = (k << u(31) | k >> u(33)) * one
    h = k ^ u((42 + int(five) + 8) & 0xFFFFFFFFFFFFFFFF)
    h = (h << u(27) | h >> u(37)) * one + four
    h = (h ^ h >> u(33)) * two
    h = (h ^ h >> u(29)) * three
    h ^= h >> u(32)
    return np.mod(h.view(np.int64), buckets).astype(np.int32)


def _removals(doc: np.ndarray, pos: np.ndarray, tag: np.ndarray, buckets: int) -> list[tuple]:
    """Rows (home, doc, pos, tag) of removed windows, one for each home bucket of their documents."""
    if not len(doc):
        return []
    home = _home(doc, buckets)
    order = np.lexsort((pos, doc, home))
    home, doc, pos, tag = home[order], doc[order], pos[order], tag[order]
    cut = np.concatenate([[0], np.flatnonzero(np.diff(home)) + 1, [len(home)]])
    return [(int(home[i]), planes(doc[i:j]), planes(pos[i:j].astype(np.uint32)), planes(tag[i:j])) for i, j in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


_RUN_NAMES = ["bucket", "dealt", "fp", "doc", "pos", "mask", "checks", "tag"]
_RUN_TYPES = [pa.int32(), pa.int32(), *[pa.binary()] * 6]


def runs(docs: DataFrame, buckets: int) -> DataFrame:
    """The runs of docs (doc_id long, text), with settled removals as rows without a fingerprint."""

    def run(batches):
        held: list[tuple] = []
        count = 0

        def flush():
            fp, check, doc, pos, tag = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            order, low = least_docs(fp, check, doc)
            least = np.empty_like(low)
            least[order] = low
            gone = doc > least
            # one copy of a window within a document is enough for the index, but each of them must be told of removal
            done = [(home, buckets, None, d, p, None, None, t) for home, d, p, t in _removals(doc[gone], pos[gone], tag[gone], buckets)]
            stay = ~gone
            out = make_run(fp[stay], check[stay], doc[stay], pos[stay], tag[stay], buckets) + done
            for i in range(0, len(out), 64):
                yield _batch(out[i : i + 64], _RUN_NAMES, _RUN_TYPES)

        for batch in chunks(batches):
            data, offsets = text_bytes(batch.column("text"))
            starts, ends, rows = words(data, offsets)
            at, fp, check = fingerprints(word_hashes(data, starts, ends), rows)
            if not len(at):
                continue
            ids = batch.column("doc_id").fill_null(LAST).to_numpy(zero_copy_only=False)
            first = np.searchsorted(rows, np.arange(len(offsets) - 1))
            held.append((fp, check, ids[rows[at]], at - first[rows[at]], tags(data, offsets)[rows[at]]))
            count += len(at)
            if count >= RUN_WORDS:
                yield from flush()
                count = 0
        if held:
            yield from flush()

    return docs.mapInArrow(run, _RUN)


def redealt(history: DataFrame, buckets: int) -> DataFrame:
    """The runs of a history in so many buckets; those that were dealt otherwise are cut anew, run by run."""

    def deal(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                parts = expand(*(batch.column(c)[r].as_py() for c in _RUN_NAMES[2:]))
                order = np.lexsort((parts[3], parts[4], parts[2]))
                yield _batch(make_run(*(x[order] for x in parts), buckets), _RUN_NAMES, _RUN_TYPES)

    runs = history.where("fp is not null")
    same = F.col("dealt") == F.lit(buckets)
    return runs.where(same).select(*_RUN_NAMES).unionByName(runs.where(~same).select(*_RUN_NAMES).mapInArrow(deal, _RUN))


def _load(t: pa.Table) -> tuple[tuple, list]:
    passed, sums = [], np.cumsum([0] + [x.size // 8 for x in (np.frombuffer(c.as_buffer() or b"", np.uint8) for c in t.column("checks"))])
    n = int(sums[-1])
    out = np.empty(n, np.uint64), np.empty(n, np.uint64), np.empty(n, np.int64), np.empty(n, np.uint32), np.empty(n, np.uint32)
    for k in range(t.num_rows):  # a run at a time: only its own expansion is held beside the result
        fp, doc, pos, mask, checks, tag = (t.column(c)[k].as_py() for c in ("fp", "doc", "pos", "mask", "checks", "tag"))
        if fp is None:
            passed.append((doc, pos, tag))
        else:
            for whole, part in zip(out, expand(fp, doc, pos, mask, checks, tag), strict=True):
                whole[sums[k] : sums[k + 1]] = part
    return out, passed


def merge(found: DataFrame, buckets: int, history: DataFrame | None = None) -> DataFrame:
    """Removed windows (home, doc, pos, tag) of the runs in found, judged against each other and the history's runs."""
    schema = "home int, doc binary, pos binary, tag binary"
    both = found.withColumn("fresh", F.lit(True))
    if history is not None:
        both = both.unionByName(redealt(history, buckets).withColumn("fresh", F.lit(False)))

    def join(t: pa.Table) -> pa.Table:
        fresh = pc.equal(t.column("fresh"), True)
        home = int(t.column("bucket")[0].as_py())
        (fp, check, doc, pos, tag), passed = _load(t.filter(fresh))
        own = len(fp)
        if not pc.all(fresh).as_py():
            old, _ = _load(t.filter(pc.invert(fresh)))
            fp, check, doc, pos, tag = (np.concatenate([a, b]) for a, b in zip((fp, check, doc, pos, tag), old, strict=True))
        del t
        order, low = least_docs(fp, check, doc)
        gone = order[(doc[order] > low) & (order < own)]
        out = _removals(doc[gone], pos[gone], tag[gone], buckets)
        out += [(home, *x) for x in passed]
        del fp, check, doc, pos, tag, order, low, gone
        release()
        return pa.Table.from_batches([_batch(out, ["home", "doc", "pos", "tag"], [pa.int32(), pa.binary(), pa.binary(), pa.binary()])])

    return both.groupBy("bucket").applyInArrow(join, schema)


def compact(found: DataFrame, history: DataFrame | None = None, buckets: int = 16) -> DataFrame:
    """All runs of a bucket as one sorted run that keeps the least document of every window."""
    both = redealt(found if history is None else found.unionByName(history), buckets)

    def fold(t: pa.Table) -> pa.Table:
        (fp, check, doc, pos, tag), _ = _load(t)
        order, low = least_docs(fp, check, doc)
        keep = np.sort(order[doc[order] == low])
        keep = keep[np.lexsort((pos[keep], tag[keep], doc[keep]))]
        rows = make_run(fp[keep], check[keep], doc[keep], pos[keep], tag[keep], buckets)
        return pa.Table.from_batches([_batch(rows, _RUN_NAMES, _RUN_TYPES)])

    return both.groupBy("bucket").applyInArrow(fold, _RUN)


def apply(docs: DataFrame, removed: DataFrame, buckets: int, keep_text: bool = False) -> DataFrame:
    """One row per document: n_words, n_removed, kept_sha256, and text (the kept words) if asked for.

    Documents and removals meet by home bucket, a hash range of ids with a few MB of text.
    """
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + (", text string" if keep_text else "")
    names = [x.split()[0] for x in schema.split(", ")]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()][: len(names)]

    def clean(texts: pa.Table, gone: pa.Table) -> pa.Table:
        kinds = {"doc": np.int64, "pos": np.uint32, "tag": np.uint32}
        doc, pos, tag = (np.concatenate([np.zeros(0, k), *(unplanes(x.as_py(), k) for x in gone.column(c))]) for c, k in kinds.items())
        order = np.argsort(doc, kind="stable")
        doc, pos, tag = doc[order], pos[order].astype(np.int64), tag[order]
        ids = texts.column("doc_id").to_pylist()
        keys = np.array([LAST if i is None else i for i in ids], np.int64)
        lo, hi = np.searchsorted(doc, keys, "left").tolist(), np.searchsorted(doc, keys, "right").tolist()
        out = []
        for n, text in enumerate(texts.column("text")):
            raw = (text.as_py() or "").encode()
            found = raw.split()
            count, cut = len(found), 0
            if hi[n] > lo[n]:
                at = pos[lo[n] : hi[n]][tag[lo[n] : hi[n]] == zlib.crc32(raw)]  # rows that share an id are told apart by their texts
                at = at[at + WINDOW <= count]
                change = np.zeros(count + 1, np.int64)
                np.add.at(change, at, 1)
                np.add.at(change, at + WINDOW, -1)
                left = np.cumsum(change[:-1]) == 0
                found = list(compress(found, left.tolist()))
                cut = count - len(found)
            kept = b" ".join(found)
            row = (ids[n], count, cut, hashlib.sha256(kept).hexdigest())
            out.append((*row, kept.decode()) if keep_text else row)
        del doc, pos, tag, order
        release()
        return pa.Table.from_batches([_batch(out, names, types)])

    homed = docs.withColumn("home", F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(LAST))), F.lit(buckets)).cast("int"))
    return homed.groupBy("home").cogroup(removed.groupBy("home")).applyInArrow(clean, schema)


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", history: DataFrame | None = None, buckets: int | None = None, keep_text: bool = False) -> DataFrame:
    """Documents without passages that start in a document of smaller id, of this batch or of the history's runs."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    buckets = buckets or bucket_count(docs, BUCKETS_PER_16MB)
    with arrow_rows(docs.sparkSession, ARROW_ROWS):
        removed = materialise(merge(runs(docs, buckets), buckets, history))
    return apply(docs, removed, buckets, keep_text)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(table(spark, sf_dir, "documents"))


ORACLE_SQL = r"""
with w as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') w from documents),
win as (select doc_id, i, w[i:i + 12] g from (select doc_id, w, unnest(range(1, len(w) - 11)) i from w where len(w) >= 13)),
low as (select g, min(doc_id) m from win group by g),
gone as (select distinct doc_id, unnest(range(i, i + 13)) p from win join low using (g) where m < doc_id),
every as (select doc_id, unnest(w) word, unnest(range(1, len(w) + 1)) p from w),
kept as (select doc_id, string_agg(word, ' ' order by p) t from every anti join gone using (doc_id, p) group by 1),
cut as (select doc_id, count(*) n from gone group by 1)
select w.doc_id, len(w.w)::bigint n_words, coalesce(cut.n, 0)::bigint n_removed, sha256(coalesce(kept.t, '')) kept_sha256
from w left join kept on kept.doc_id = w.doc_id left join cut on cut.doc_id = w.doc_id
"""
