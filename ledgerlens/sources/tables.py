"""Tables at rest as complete, immutable versions below one folder.

A version is written whole (:func:`write_version`), as the partitions that differ from an earlier one (:func:`amend_version`), or as rows that come to those
of an earlier one (:func:`extend_version`): in the latter cases its folder holds a list of partitions and the folders that each is found in, and what is there stays where it is.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

_PREFIX = "version="
_CHANGED = "changed="


class StaleVersion(RuntimeError):
    """Another writer has made a version since the one that was to be amended."""


def _names(spark: SparkSession, folder: str) -> list[str]:
    """What lies in a folder; nothing where there is none."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return [status.getPath().getName() for status in fs.listStatus(path)] if fs.exists(path) else []


def versions(spark: SparkSession, root: str) -> list[int]:
    """Completed versions, oldest first. A version without its success mark is not one."""
    found = [n for n in _names(spark, root) if n.startswith(_PREFIX)]
    return sorted(int(n[len(_PREFIX):]) for n in found if "_SUCCESS" in _names(spark, f"{root}/{n}"))


def partition_list(spark: SparkSession, root: str, number: int) -> list[tuple[str, str]]:
    """The partitions of a version by the name of their folder, each with a folder of the table that holds rows of it."""
    whole = f"{_PREFIX}{number:06d}"
    if f"{_CHANGED}{number:06d}" in _names(spark, root):
        return [(r["partition"], r["folder"]) for r in spark.read.parquet(f"{root}/{whole}").collect()]
    return [(n, whole) for n in _names(spark, f"{root}/{whole}") if "=" in n]


def partition_folders(spark: SparkSession, root: str, number: int) -> dict[str, str]:
    """The partitions of a version that was never extended, and the folder of the table that holds each."""
    return dict(partition_list(spark, root, number))


def parts_of_partition(spark: SparkSession, root: str, number: int) -> int:
    """Folders that the partition with the most of them is read from."""
    return max(Counter(n for n, _ in partition_list(spark, root, number)).values(), default=0)


def _claim(spark: SparkSession, root: str) -> int:
    """Number of the next version, taken by creating a file that no other writer can create again."""
    number = max(versions(spark, root), default=0) + 1
    while True:
        mark = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/_claims/{number:06d}")
        if mark.getFileSystem(spark._jsc.hadoopConfiguration()).createNewFile(mark):
            return number
        number += 1


def write_version(
    df: DataFrame,
    root: str,
    partition_by: Sequence[str] = ("empresa",),
    sort_within: Sequence[str] = ("fecha_corte",),
    cluster_by: Sequence[str] = (),
    number: int | None = None,
) -> int:
    """Write ``df`` as the next version and return its number.

    Readers keep the previous version until this one is complete. Rows stay in the tasks that made
    them, sorted by date within each file so that date ranges skip row groups. With ``cluster_by`` they are
    dealt by ranges of partition, date and these columns first, so that a file holds few dates and date ranges skip files;
    give columns that tell rows of one date apart, as rows equal in all of them share a task. ``number`` is given for a table
    that is numbered like another.
    """
    spark = df.sparkSession
    number = _claim(spark, root) if number is None else number
    keys = (*partition_by, *sort_within, *cluster_by)
    if cluster_by:
        df = df.repartitionByRange(*keys)
    _write(df, f"{root}/{_PREFIX}{number:06d}", partition_by, keys)
    return number


def _write(df: DataFrame, path: str, partition_by: Sequence[str], keys: Sequence[str]) -> None:
    df.sortWithinPartitions(*keys).write.mode("overwrite").option("compression", "zstd").partitionBy(*partition_by).parquet(path)


def amend_version(
    df: DataFrame, root: str, base: int, partition_by: Sequence[str] = ("empresa",), sort_within: Sequence[str] = ("fecha_corte",), number: int | None = None,
) -> int:
    """The next version: the partitions that ``df`` has rows of are as in ``df``, the others as in version ``base``, whose files are not touched.

    ``df`` must hold all rows of the partitions it has rows of. Its rows are written beside the versions first; the list of partitions makes the version
    visible, and is refused where another version has come after ``base``. Readers of earlier versions are left alone.
    """
    return _follow(df, root, base, partition_by, sort_within, number, keep=False)


def extend_version(
    df: DataFrame, root: str, base: int, partition_by: Sequence[str] = ("empresa",), sort_within: Sequence[str] = ("fecha_corte",), number: int | None = None,
) -> int:
    """The next version: the rows of version ``base``, whose files are neither read nor touched, and those of ``df``. Else like :func:`amend_version`."""
    return _follow(df, root, base, partition_by, sort_within, number, keep=True)


def _follow(df: DataFrame, root: str, base: int, partition_by: Sequence[str], sort_within: Sequence[str], number: int | None, keep: bool) -> int:
    spark = df.sparkSession
    known = partition_list(spark, root, base)
    number = _claim(spark, root) if number is None else number
    changed = f"{_CHANGED}{number:06d}"
    _write(df, f"{root}/{changed}", partition_by, (*partition_by, *sort_within))
    named = {n for n in _names(spark, f"{root}/{changed}") if "=" in n}
    known = [(n, f) for n, f in known if keep or n not in named] + [(n, changed) for n in named]
    if versions(spark, root)[-1] != base:
        raise StaleVersion(f"version {base} of {root} is no longer the latest")
    # One row per partition and folder.
    listed = spark.createDataFrame(sorted(known), "partition string, folder string").coalesce(1)
    listed.write.parquet(f"{root}/{_PREFIX}{number:06d}")
    return number


def read_version(spark: SparkSession, root: str, number: int | None = None) -> DataFrame:
    """A version of the table, the latest by default."""
    if number is None:
        known = versions(spark, root)
        if not known:
            raise FileNotFoundError(f"no complete version below {root}")
        number = known[-1]
    if f"{_CHANGED}{number:06d}" not in _names(spark, root):
        return spark.read.parquet(f"{root}/{_PREFIX}{number:06d}")
    paths = defaultdict(list)
    for name, folder in partition_list(spark, root, number):
        paths[folder].append(f"{root}/{folder}/{name}")
    # The partition column is read from the names below each folder.
    parts = [spark.read.option("basePath", f"{root}/{folder}").parquet(*named) for folder, named in sorted(paths.items())]
    return reduce(DataFrame.unionByName, parts)


def write_beside(df: DataFrame, root: str, number: int, name: str, files: int | None = 1) -> None:
    """Keep a report of a version next to it: in one file if it is small, else with ``files=None`` as its tasks write it."""
    out = df if files is None else df.coalesce(files)
    out.write.mode("overwrite").parquet(f"{root}/{name}/{_PREFIX}{number:06d}")


def read_beside(spark: SparkSession, root: str, name: str, number: int | None = None) -> DataFrame:
    """A report kept by :func:`write_beside`, of the latest version by default."""
    number = versions(spark, root)[-1] if number is None else number
    return spark.read.parquet(f"{root}/{name}/{_PREFIX}{number:06d}")
