"""Sinks: versioned reports, indexes, CSV with a digest, logs. Documents are small; tables are written by Spark."""

from __future__ import annotations

import csv
import hashlib
import io
import json
import os
import tempfile
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA_VERSION = 1
# Columns of the per-character table, in order.
KINDS = ("base", "diff")


def now_text() -> str:
    return datetime.now(UTC).isoformat(timespec="seconds")


def header(game_version: str | None, pipeline_version: str = "1") -> dict:
    return {"schema_version": SCHEMA_VERSION, "pipeline_version": pipeline_version, "game_version": game_version or "unknown", "generated_at": now_text()}


def write_atomic(path: str, data: bytes) -> None:
    """Through a temporary file and a rename: readers see the old or the new document, whatever fails."""
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    fd, temp = tempfile.mkstemp(dir=Path(path).parent, suffix=".tmp")
    try:
        with os.fdopen(fd, "wb") as f:
            f.write(data)
        os.replace(temp, path)
    except BaseException:
        Path(temp).unlink(missing_ok=True)
        raise


def write_report(payload: dict, path: str, game_version: str | None = None, idempotent: bool = True) -> bool:
    """Write a document under its header (the payload's keys win); "-" prints. False if only the time would change."""
    document = header(game_version) | payload
    if path == "-":
        print(json.dumps(document, ensure_ascii=False, indent=2))
        return True
    if idempotent and os.path.exists(path):
        try:
            old = json.loads(Path(path).read_text(encoding="utf-8"))
        except ValueError:
            old = None
        strip = lambda d: {k: v for k, v in d.items() if k != "generated_at"}
        if isinstance(old, dict) and strip(old) == strip(document):
            return False
    write_atomic(path, json.dumps(document, ensure_ascii=False, indent=2).encode())
    return True


def nested(df: DataFrame, outer: str, inner: str, fields: list[str]) -> DataFrame:
    """outer, doc: the rows of each outer key as one JSON object by inner key; null fields are left out."""
    entry = F.struct(F.col(inner), F.to_json(F.struct(*fields)))
    entries = F.array_sort(F.collect_list(entry))
    parts = F.transform(entries, lambda e: F.concat(F.to_json(F.struct(e[inner].alias("k"))).substr(F.lit(6), F.lit(1 << 20)).substr(F.lit(1), F.length(F.to_json(F.struct(e[inner].alias("k")))) - 6), F.lit(":"), e["col2"]))
    return df.groupBy(outer).agg(F.concat(F.lit("{"), F.array_join(parts, ","), F.lit("}")).alias("doc"))


def index_document(df: DataFrame, key: str, value: str) -> dict:
    """{key: [[], [sorted values], [kind]]}: a compact index; a document of names, so it is collected."""
    rows = df.groupBy(key).agg(F.array_sort(F.collect_set(value)).alias("v")).orderBy(key).collect()
    return {r[key]: [[], list(r["v"]), ["npc"]] for r in rows}


def write_csv(df: DataFrame, path: str, order: str) -> str:
    """One CSV file in order, and its SHA-256 beside it; returns the digest. For tables of one row a character."""
    out = io.StringIO()
    writer = csv.writer(out, lineterminator="\n")
    writer.writerow(df.columns)
    for row in df.orderBy(order).toLocalIterator():
        writer.writerow(["" if v is None else int(v) if isinstance(v, bool) else v for v in row])
    data = out.getvalue().encode()
    digest = hashlib.sha256(data).hexdigest()
    write_atomic(path, data)
    write_atomic(f"{path}.sha256", f"{digest}  {Path(path).name}\n".encode())
    return digest


def append_log(path: str, entry: dict, strict: bool = True) -> bool:
    """Append a line of JSON unless it equals the last one (strict: but for the time it was made)."""
    ignore = {"generated_at"} if strict else set()
    last = None
    if os.path.exists(path):
        lines = [x for x in Path(path).read_text(encoding="utf-8").splitlines() if x.strip()]
        last = json.loads(lines[-1]) if lines else None
    strip = lambda d: {k: v for k, v in d.items() if k not in ignore}
    if last is not None and strip(last) == strip(entry):
        return False
    with open(path, "a", encoding="utf-8") as f:
        f.write(json.dumps(entry, ensure_ascii=False) + "\n")
    return True


def append_table(df: DataFrame, path: str) -> None:
    """Append rows of a growing record (failures, changes) as JSON lines, by Spark."""
    df.write.mode("append").json(path)


def category_manifest(df: DataFrame) -> DataFrame:
    """Per category the number of files, their size and a digest over all (rel, sha256) in order."""
    rows = F.array_sort(F.collect_list(F.struct("rel", "sha256")))
    return df.groupBy("category").agg(F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes"), F.sha2(F.to_json(rows), 256).alias("digest"))
