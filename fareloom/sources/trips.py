"""Trip record readers."""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fareloom.schema import TRIP_COLUMNS


def read_trips(spark: SparkSession, path: str) -> DataFrame:
    """Parquet trips with the schema the files carry."""
    return spark.read.parquet(path)


def read_clean_trips(
    spark: SparkSession,
    path: str,
    since: tuple[int, int] | None = None,
    until: tuple[int, int] | None = None,
) -> DataFrame:
    """Cleaned trips, optionally only the months ``since``..``until``, both (year, month) and kept.

    The bounds become predicates on the partition columns, so the files of other months are not read.
    """
    trips = spark.read.parquet(path)
    if since is not None:
        trips = trips.filter(_from_month(since))
    if until is not None:
        year, month = until
        later = (F.col("year") > year) | ((F.col("year") == year) & (F.col("month") > month))
        trips = trips.filter(~later)
    return trips


def _from_month(since: tuple[int, int]) -> Column:
    year, month = since
    return (F.col("year") > year) | ((F.col("year") == year) & (F.col("month") >= month))


#: Sets of paths whose common schema is asked for at a time; each is one job, whose tasks read footers.
SCHEMAS_AT_ONCE = 16


@dataclass(frozen=True)
class ScanGroup:
    """Folders and files that one scan can read: one set of partition folders, one set of types."""

    keys: tuple[str, ...]
    schema: StructType
    paths: tuple[str, ...]


def _kinds(schema: StructType) -> tuple:
    return tuple(sorted((field.name, field.dataType.simpleString()) for field in schema))


def _below(path: str, root: str) -> str:
    """The part of a path below a root, however the scheme of either is written."""
    bare = [re.sub(r"^[A-Za-z][\w+.-]*:(//[^/]*)?", "", name) for name in (path, root)]
    return bare[0].removeprefix(bare[1].rstrip("/")).lstrip("/")


def _merged(spark: SparkSession, root: str, paths: list[str]) -> StructType | None:
    """The common schema out of all footers, which tasks read, or None if types differ."""
    scan = spark.read.option("mergeSchema", True).option("basePath", root)
    try:
        return scan.parquet(*paths).schema
    except Exception as error:  # an analysis error or a wrapped Java one, depending on the place
        if "CANNOT_MERGE" not in str(error):
            raise
        return None


def scan_groups(spark: SparkSession, root: str) -> list[ScanGroup]:
    """What to scan together, so that every file below ``root`` is read exactly once.

    Spark lists the files, all those it would read itself. A folder is named as a whole unless it has
    folders below it; such a folder's own files are named one by one, apart from those in
    ``key=value`` folders, as a scan that finds partition folders leaves other files out. Tasks read
    all footers in one job; where types differ, the paths are halved in order until they agree, and a
    folder that disagrees in itself is opened into its files. So the number of jobs grows with the
    places where types change, not with the number of folders: twice the logarithm for each.
    """
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
        .select("path", F.regexp_replace("path", "/[^/]*$", "").alias("folder"))
    )
    folders = {row["folder"] for row in files.select("folder").distinct().collect()}
    parents = set()
    for folder in folders:
        steps = _below(folder, root).split("/")
        parents.update(folder.rsplit("/", n)[0] for n in range(1, len(steps) + 1) if steps != [""])

    def opened(names: list[str]) -> list[str]:
        chosen = files.filter(F.col("folder").isin(names)).select("path").orderBy("path")
        return [row["path"] for row in chosen.collect()] if names else []

    alike: dict[tuple[str, ...], list[str]] = {}
    for path in [*(folders - parents), *opened(sorted(folders & parents))]:
        below = _below(path, root).split("/")
        named = below if path in folders else below[:-1]
        keys = tuple(step.split("=", 1)[0] for step in named if "=" in step)
        alike.setdefault(keys, []).append(path)

    def parted(paths: list[str]) -> list[list[str]]:
        if len(paths) > 1:
            half = len(paths) // 2
            return [paths[:half], paths[half:]]
        inside = opened(paths)
        if not inside or inside == paths:
            raise ValueError(f"types differ within {paths[0]}")
        return [inside]

    groups: dict[tuple, ScanGroup] = {}
    waiting = [(keys, sorted(paths)) for keys, paths in alike.items()]
    with ThreadPoolExecutor(SCHEMAS_AT_ONCE) as pool:
        while waiting:
            schemas = list(pool.map(lambda some: _merged(spark, root, some[1]), waiting))
            disagreeing = []
            for (keys, paths), schema in zip(waiting, schemas, strict=True):
                if schema is None:
                    disagreeing += [(keys, part) for part in parted(paths)]
                    continue
                known = groups.get((keys, _kinds(schema)))
                groups[keys, _kinds(schema)] = ScanGroup(
                    keys, schema, (*(known.paths if known else ()), *paths)
                )
            waiting = disagreeing
    return list(groups.values())


def read_trips_pinned(
    spark: SparkSession, root: str, columns: dict[str, str] | None = None
) -> DataFrame:
    """Parquet trips whose column types drift between files, under one pinned schema.

    Files are grouped by the types they carry; each group is scanned as it is (vectorised), cast to
    the pinned types, and the groups are united. Columns a group lacks become NULL. ``key=value``
    folders below ``root`` add their partition columns, NULL for files outside of them.
    """
    columns = columns or TRIP_COLUMNS
    known = {name.lower() for name in columns}
    groups = scan_groups(spark, root)
    if not groups:
        raise ValueError(f"no parquet files below {root}")

    def pinned(group: ScanGroup) -> DataFrame:
        scan = spark.read.schema(group.schema).option("basePath", root).parquet(*group.paths)
        present = {name.lower() for name in scan.columns}
        wanted = [
            (F.col(name) if name.lower() in present else F.lit(None)).cast(kind).alias(name)
            for name, kind in columns.items()
        ]
        return scan.select(*wanted, *(key for key in group.keys if key.lower() not in known))

    return reduce(
        lambda left, right: left.unionByName(right, allowMissingColumns=True), map(pinned, groups)
    )
