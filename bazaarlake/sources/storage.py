"""Writing and reading stored tables on a plain file system."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _folder(spark: SparkSession, path: str):
    path_class = spark._jvm.org.apache.hadoop.fs.Path
    folder = path_class(path)
    return path_class, folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    _, folder, fs = _folder(spark, path)
    return fs.exists(folder)


def _children(spark: SparkSession, path: str) -> list[str]:
    """Names of committed sub-folders (those with a _SUCCESS mark)."""
    path_class, folder, fs = _folder(spark, path)
    if not fs.exists(folder):
        return []
    return [
        s.getPath().getName()
        for s in fs.listStatus(folder)
        if s.isDirectory() and fs.exists(path_class(s.getPath(), "_SUCCESS"))
    ]


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of all sub-folders."""
    _, folder, fs = _folder(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory()] if fs.exists(folder) else []


def mark_committed(spark: SparkSession, path: str) -> None:
    """Give a folder the mark that ``numbered_children`` looks for."""
    path_class, folder, fs = _folder(spark, path)
    fs.create(path_class(folder, "_SUCCESS"), True).close()


def drop_folder(spark: SparkSession, path: str) -> None:
    _, folder, fs = _folder(spark, path)
    fs.delete(folder, True)


def numbered_children(spark: SparkSession, path: str, label: str) -> list[int]:
    """Sorted numbers n of committed sub-folders named ``label=n``."""
    prefix = f"{label}="
    return sorted(int(n[len(prefix):]) for n in _children(spark, path) if n.startswith(prefix))


def drop_children(spark: SparkSession, path: str, label: str, up_to: int) -> None:
    """Delete committed sub-folders ``label=n`` with n up to the given number."""
    for n in numbered_children(spark, path, label):
        if n <= up_to:
            _, folder, fs = _folder(spark, f"{path}/{label}={n}")
            fs.delete(folder, True)


def publish(df: DataFrame, root: str, keep: int = 2, sort_key: Sequence[str] = ()) -> str:
    """Full rebuild, in storage order if a sort key is given: write the next version folder. Readers switch to it only once it is committed, so they
    see the old table or the new one, never an empty or half-written one; a failed write leaves the old one.

    The last ``keep`` versions stay, so that a reader of the previous one can finish; older ones are deleted.
    """
    spark = df.sparkSession
    versions = numbered_children(spark, root, "version")
    number = (versions[-1] if versions else 0) + 1
    path = f"{root}/version={number}"
    if sort_key:
        write_sorted(df, path, sort_key)
    else:
        df.write.mode("overwrite").parquet(path)
    drop_children(spark, root, "version", number - keep)
    return path


def read_published(spark: SparkSession, root: str) -> DataFrame:
    versions = numbered_children(spark, root, "version")
    if not versions:
        raise FileNotFoundError(f"no committed version below {root}")
    return spark.read.parquet(f"{root}/version={versions[-1]}")


def append_batch(df: DataFrame, root: str, batch_id: int | str) -> None:
    """Append one batch to a log. The batch owns its folder (a number, or a folder below one), so repeating it replaces it."""
    df.write.mode("overwrite").parquet(f"{root}/batch_id={batch_id}")


def insert_if_absent(existing: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """Add the new rows whose key is not stored yet; stored rows are kept as they are."""
    return existing.unionByName(new.dropDuplicates(list(key)).join(existing.select(*key), list(key), "left_anti"))


def sorted_layout(df: DataFrame, sort_key: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Range-partition and sort for storage, so readers skip files by min/max of the leading columns.

    Ranges are cut over the whole sort key: a single date with a large share of the rows still spreads over
    many files.
    """
    cols = [F.col(c) for c in sort_key]
    ranged = df.repartitionByRange(partitions, *cols) if partitions else df.repartitionByRange(*cols)
    return ranged.sortWithinPartitions(*cols)


def write_sorted(df: DataFrame, path: str, sort_key: Sequence[str]) -> None:
    """Write ``df`` in storage order to ``path``.

    Cutting ranges takes a sample of the rows, for which a join would be made once more; the rows are stored as they come first.
    """
    parent, _, name = path.rpartition("/")
    draft = f"{parent}/_unsorted-{name}"
    df.write.mode("overwrite").parquet(draft)
    sorted_layout(df.sparkSession.read.schema(df.schema).parquet(draft), sort_key).write.mode("overwrite").parquet(path)
    drop_folder(df.sparkSession, draft)
