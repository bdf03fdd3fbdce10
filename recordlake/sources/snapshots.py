"""Versioned tables on plain Parquet: data in ``v=<n>`` folders, one small pointer file. One writer at a time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

POINTER = "CURRENT"


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def exists(spark: SparkSession, path: str) -> bool:
    fs, path_of = _fs(spark, path)
    return fs.exists(path_of(path))


def folders(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match and were written to the end."""
    fs, path_of = _fs(spark, pattern.split("*")[0])
    found = fs.globStatus(path_of(f"{pattern}/_SUCCESS")) or []
    return sorted(s.getPath().getParent().toString() for s in found)


def move(spark: SparkSession, path: str, target: str) -> None:
    """Rename a folder; the target must not be there."""
    fs, path_of = _fs(spark, path)
    if not fs.rename(path_of(path), path_of(target)):
        raise OSError(f"cannot rename {path} to {target}")


def remove(spark: SparkSession, path: str) -> None:
    fs, path_of = _fs(spark, path)
    fs.delete(path_of(path), True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file next to its final name and rename it over the old one."""
    fs, path_of = _fs(spark, path)
    temporary = path_of(f"{path}.new")
    stream = fs.create(temporary, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    target = path_of(path)
    if fs.exists(target):
        fs.delete(target, False)
    fs.rename(temporary, target)


def read_text(spark: SparkSession, path: str) -> str | None:
    if not exists(spark, path):
        return None
    rows = spark.read.text(path).limit(1).collect()
    return rows[0][0] if rows else None


def current_version(spark: SparkSession, root: str) -> int | None:
    text = read_text(spark, f"{root}/{POINTER}")
    if text is None and exists(spark, f"{root}/{POINTER}.new"):
        text = read_text(spark, f"{root}/{POINTER}.new")  # stopped between delete and rename
    return int(text) if text else None


def version_path(root: str, version: int) -> str:
    return f"{root}/v={version}"


def read_current(spark: SparkSession, root: str) -> DataFrame:
    version = current_version(spark, root)
    if version is None:
        raise ValueError(f"no published version under {root}")
    return spark.read.parquet(version_path(root, version))


def stage(df: DataFrame, root: str, partition_by: tuple[str, ...] = ()) -> int:
    """Write the next version without publishing it; earlier versions stay."""
    version = (current_version(df.sparkSession, root) or 0) + 1
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(version_path(root, version))
    return version


def publish(spark: SparkSession, root: str, version: int) -> None:
    write_text(spark, f"{root}/{POINTER}", str(version))


def commit(df: DataFrame, root: str, partition_by: tuple[str, ...] = ()) -> int:
    version = stage(df, root, partition_by)
    publish(df.sparkSession, root, version)
    return version

