"""Scans: listings, directories, digests, reports, images, packs. All read through Spark's readers."""

from __future__ import annotations

import io
import tarfile

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import LS_LINE, UNZIP_LINE, base_name, digest, excluded

# Where a category's files lie.
CATEGORY_PATHS = {"characters": "avg/characters", "avatars": "spritepack"}
BINARY = "path string, modificationTime timestamp, length long, content binary"


def _binary(spark: SparkSession, path: str, glob: str | None = None, recursive: bool = False) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    reader = reader.option("pathGlobFilter", glob) if glob else reader
    try:
        return reader.load(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], BINARY)  # a missing directory lists nothing


def relative(path, root: str):
    """The path below root, whatever scheme the reader put before it."""
    return F.substring_index(path, root.rstrip("/").split("://")[-1].removeprefix("file:") + "/", -1)


def list_files(spark: SparkSession, root: str, category: str, with_digest: bool = False) -> DataFrame:
    """rel, size (and sha256) of a category's bundles. Without with_digest no content is read."""
    path = f"{root.rstrip('/')}/{CATEGORY_PATHS[category]}"
    df = _binary(spark, path, "*.ab")
    cols = [F.concat(F.lit(f"{category}/"), base_name("path")).alias("rel"), F.col("length").alias("size")]
    return df.select(*cols, *([digest("content").alias("sha256")] if with_digest else []))


def ls_listing(lines: DataFrame, category: str, suffix: str = ".ab") -> DataFrame:
    """rel, size from lines of ls -l (value string); other lines yield nothing."""
    name = base_name(F.regexp_extract("value", LS_LINE, 2))
    df = lines.where(F.col("value").rlike(LS_LINE)).select(F.regexp_extract("value", LS_LINE, 1).try_cast("long").alias("size"), name.alias("name"))
    return df.where(F.lower("name").endswith(suffix)).select(F.concat(F.lit(f"{category}/"), F.col("name")).alias("rel"), "size")


def unzip_listing(lines: DataFrame) -> DataFrame:
    """size, name from lines of unzip -l; header, rule and total lines yield nothing."""
    df = lines.where(F.col("value").rlike(UNZIP_LINE))
    return df.select(F.regexp_extract("value", UNZIP_LINE, 1).try_cast("long").alias("size"), F.regexp_extract("value", UNZIP_LINE, 2).alias("name"))


def archives_listing(archives: list[tuple[str, DataFrame]]) -> DataFrame:
    """rel, size over several archives: base.apk first, the others by name; the first listing of a name wins."""
    from ..operators.merge import first_wins

    order = sorted(archives, key=lambda a: (a[0] != "base.apk", a[0]))
    parsed = [(n, unzip_listing(df).where(F.lower("name").endswith(".ab")).withColumn("rel", base_name("name")).select("rel", "size")) for n, df in order]
    return first_wins(parsed, ["rel"])


def scan_category(spark: SparkSession, root: str, exclude: list[str] = (), previous: DataFrame | None = None, strict: bool = True) -> DataFrame:
    """rel, size, sha256 of all files below root but manifests, temporaries and excluded ones.

    With previous and strict off, a file of unchanged size keeps its recorded digest; strict recomputes it,
    so that edits of equal size are seen.
    """
    df = _binary(spark, root, recursive=True)
    df = df.withColumn("rel", relative(F.col("path"), root)).where(~base_name("path").isin("manifest.json") & ~F.col("path").endswith(".tmp"))
    if exclude:
        df = df.where(~excluded("rel", list(exclude)))
    if previous is None or strict:
        return df.select("rel", F.col("length").alias("size"), digest("content").alias("sha256"))
    old = previous.select("rel", F.col("size").alias("_size"), F.col("sha256").alias("_sha"))
    met = df.select("rel", F.col("length").alias("size"), "path").join(old, "rel", "left")
    kept = met.where("_size = size and _sha is not null").select("rel", "size", F.col("_sha").alias("sha256"))
    fresh = met.where("not coalesce(_size = size and _sha is not null, false)").select("rel")
    read = df.join(fresh, "rel", "left_semi").select("rel", F.col("length").alias("size"), digest("content").alias("sha256"))
    return kept.unionByName(read)


def json_texts(spark: SparkSession, path: str) -> DataFrame:
    """path, text of whole files; a missing path gives none."""
    try:
        return spark.read.option("wholetext", "true").text(path).select(F.input_file_name().alias("path"), F.col("value").alias("text"))
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], "path string, text string")


def json_field(text, name: str, kind: str):
    """A field of a small document in a column; null where the document is broken or lacks it."""
    return F.from_json(text, f"`{name}` {kind}")[name]


def map_report(texts: DataFrame, root: str, value: str) -> DataFrame:
    """ord, key, value of the object under root (a field name; empty: the document itself), in document order. Broken documents give no rows."""
    field = F.get_json_object("text", f"$.{root}") if root else F.col("text")
    parsed = F.from_json(field, f"map<string, {value}>")
    return texts.select(F.posexplode(F.map_entries(parsed)).alias("ord", "e")).select("ord", F.col("e.key").alias("key"), F.col("e.value").alias("value"))


def manual_boxes(texts: DataFrame) -> DataFrame:
    """character, item, box of manual overrides, flat or wrapped under images; bad boxes are left out."""
    from ..functions.geometry import valid_box

    inner = F.coalesce(F.get_json_object("text", "$.images"), F.col("text"))
    flat = texts.select(inner.alias("text"))
    rows = map_report(flat, "", "array<int>").where(valid_box("value"))
    parts = F.split("key", "/", 2)
    return rows.select(parts[0].alias("character"), parts[1].alias("item"), F.col("value").alias("box"))


def skip_list(texts: DataFrame) -> DataFrame:
    """key, reason; an unreadable list is empty."""
    return map_report(texts, "", "string").select("key", F.col("value").alias("reason"))


def images(spark: SparkSession, path: str) -> DataFrame:
    """path, height, width, channels, data (BGR or BGRA, row by row), error for unreadable files."""
    df = spark.read.format("image").option("dropInvalid", "false").option("recursiveFileLookup", "true").load(path).select("image.*")
    bad = F.col("height") < 0
    return df.select(F.col("origin").alias("path"), "height", "width", F.col("nChannels").alias("channels"), "data", F.when(bad, F.lit("unreadable")).alias("error"))


def image_sizes(sizes: DataFrame, scanned: DataFrame, keys: list[str]) -> DataFrame:
    """width, height from metadata where they have them, else from the file; null where neither."""
    a = sizes.select(*keys, F.struct("width", "height").alias("_m"))
    b = scanned.select(*keys, F.when(F.col("width") > 0, F.struct("width", "height")).alias("_f"))
    out = a.join(b, keys, "full").withColumn("_s", F.coalesce("_m", "_f"))
    return out.select(*keys, F.col("_s.width").alias("width"), F.col("_s.height").alias("height"))


def square_avatars(df: DataFrame, name: str = "name") -> DataFrame:
    """Square pictures of characters."""
    return df.where(F.lower(name).startswith("char_") & (F.col("width") == F.col("height")))


def unpack_tars(packs: DataFrame, expected: DataFrame) -> DataFrame:
    """rel, content, error of the expected members (rel, size) of tar packs (content binary): absent or of another size is an error."""

    def members(batches):
        for batch in batches:
            rel, content = [], []
            for raw in batch.column("content").to_pylist():
                with tarfile.open(fileobj=io.BytesIO(raw)) as tar:
                    for m in tar:
                        if m.isfile():
                            rel.append(m.name.removeprefix("./"))
                            content.append(tar.extractfile(m).read())
            yield pa.RecordBatch.from_arrays([pa.array(rel, pa.string()), pa.array(content, pa.binary())], names=["rel", "content"])

    got = packs.select("content").mapInArrow(members, "rel string, content binary")
    out = expected.join(got, "rel", "left")
    error = F.when(F.col("content").isNull(), "missing in the pack").when(F.length("content") != F.col("size"), "size differs")
    return out.select("rel", F.when(error.isNull(), F.col("content")).alias("content"), error.alias("error"))


def parse_bundles(files: DataFrame, parser) -> DataFrame:
    """Parts of bundles by an injected parser: bytes -> iterable of (kind, name, payload bytes). A failing bundle is a row with error."""

    def run(batches):
        for batch in batches:
            rows = []
            for path, raw in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                try:
                    rows += [(path, kind, name, payload, None) for kind, name, payload in parser(raw)]
                except Exception as e:  # noqa: BLE001  a bundle must not end the job
                    rows.append((path, None, None, None, f"{type(e).__name__}: {e}"))
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
            types = [pa.string(), pa.string(), pa.string(), pa.binary(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, types, strict=True)], names=["path", "kind", "name", "payload", "error"])

    return files.select("path", "content").mapInArrow(run, "path string, kind string, name string, payload binary, error string")
