"""Sources of assets behind one interface, a registry of them, and a data source for listing files."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.names import LS_LINE, UNZIP_LINE
from ..operators.merge import first_wins
from . import tables


class AssetSource:
    """rel, size of a category's bundles, with sha256 where the source can tell it (else null)."""

    name = "source"
    knows_digest = False

    def supports(self, category: str) -> bool:
        return category in tables.CATEGORY_PATHS

    def files(self, spark: SparkSession, category: str) -> DataFrame:
        raise NotImplementedError


class DirectorySource(AssetSource):
    """An unpacked tree; a missing directory lists nothing."""

    knows_digest = True

    def __init__(self, root: str, name: str = "apk"):
        self.root, self.name = root, name

    def files(self, spark: SparkSession, category: str) -> DataFrame:
        return tables.list_files(spark, self.root, category, with_digest=True)


class ListingSource(AssetSource):
    """Text of ls -l for each category, as files that Spark can read."""

    def __init__(self, paths: dict[str, str], name: str = "adb"):
        self.paths, self.name = paths, name

    def supports(self, category: str) -> bool:
        return category in self.paths

    def files(self, spark: SparkSession, category: str) -> DataFrame:
        return tables.ls_listing(spark.read.text(self.paths[category]), category).withColumn("sha256", F.lit(None).cast("string"))


class ArchiveSource(AssetSource):
    """Text of unzip -l for several archives; base.apk is first."""

    def __init__(self, paths: dict[str, str], name: str = "apk-adb"):
        self.paths, self.name = paths, name

    def files(self, spark: SparkSession, category: str) -> DataFrame:
        part = f"/{tables.CATEGORY_PATHS[category]}/"
        found = [(n, spark.read.text(p).where(F.col("value").contains(part))) for n, p in self.paths.items()]
        got = tables.archives_listing(found)
        return got.select(F.concat(F.lit(f"{category}/"), "rel").alias("rel"), "size", F.lit(None).cast("string").alias("sha256"))


class Composite(AssetSource):
    """Several sources; of a file that more than one has, the earliest one's counts, and it is named as the owner."""

    name = "multi"

    def __init__(self, sources: list[AssetSource]):
        self.sources = sources

    def supports(self, category: str) -> bool:
        return any(s.supports(category) for s in self.sources)

    def files(self, spark: SparkSession, category: str) -> DataFrame:
        return first_wins([(s.name, s.files(spark, category)) for s in self.sources if s.supports(category)], ["rel"])


_REGISTRY: dict[str, Callable[[dict], AssetSource]] = {
    "apk": lambda c: DirectorySource(c["root"]),
    "adb": lambda c: ListingSource(c["listings"]),
    "apk-adb": lambda c: ArchiveSource(c["archives"]),
}


def register(name: str, make: Callable[[dict], AssetSource]) -> None:
    """Add a kind of source."""
    _REGISTRY[name] = make


def make_source(names: list[str], config: dict[str, dict]) -> AssetSource:
    """The named sources, each with its own settings; one alone is itself, several are a composite in that order."""
    unknown = [n for n in names if n not in _REGISTRY]
    if unknown or not names:
        raise ValueError(f"unknown sources: {', '.join(unknown) or 'none given'}; known: {', '.join(sorted(_REGISTRY))}")
    made = [_REGISTRY[n](config.get(n, {})) for n in names]
    return made[0] if len(made) == 1 else Composite(made)


class _Lines(InputPartition):
    def __init__(self, first: int, lines: list[str]):
        self.first, self.lines = first, lines


class ListingReader(DataSourceReader):
    def __init__(self, options: dict):
        self.text, self.style, self.size = options.get("text", ""), options.get("style", "ls"), int(options.get("linesperpartition", "5000"))

    def partitions(self) -> list[InputPartition]:
        lines = self.text.splitlines()
        return [_Lines(i, lines[i : i + self.size]) for i in range(0, max(1, len(lines)), self.size)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        pattern = re.compile(LS_LINE if self.style == "ls" else UNZIP_LINE)
        for i, line in enumerate(partition.lines):
            if m := pattern.match(line):
                yield partition.first + i, m[2].rsplit("/", 1)[-1], int(m[1])


class ListingDataSource(DataSource):
    """spark.read.format("listing").option("text", output).option("style", "ls" or "unzip"): output of a command as rows."""

    @classmethod
    def name(cls) -> str:
        return "listing"

    def schema(self) -> str:
        return "line int, name string, size long"

    def reader(self, schema) -> DataSourceReader:
        return ListingReader(dict(self.options))
