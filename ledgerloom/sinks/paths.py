"""Small file-system steps on whatever store a path names."""

import time
import uuid

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    """(file system, path) as Hadoop objects."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = file_system(spark, path)
    return fs.exists(hadoop_path)


def delete(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = file_system(spark, path)
    fs.delete(hadoop_path, True)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = file_system(spark, path)
    fs.mkdirs(hadoop_path)


def matching(spark: SparkSession, pattern: str) -> set[str]:
    """Files matching a glob pattern."""
    return set(sizes(spark, pattern))


def sizes(spark: SparkSession, pattern: str) -> dict[str, int]:
    """Files matching a glob pattern, with their bytes."""
    fs, hadoop_path = file_system(spark, pattern)
    return {str(status.getPath()): status.getLen() for status in fs.globStatus(hadoop_path) or ()}


def names(spark: SparkSession, folder: str) -> list[str]:
    """What is in a folder; nothing if it isn't there."""
    fs, hadoop_path = file_system(spark, folder)
    if not fs.exists(hadoop_path):
        return []
    return sorted(str(status.getPath().getName()) for status in fs.listStatus(hadoop_path))


def part_files(spark: SparkSession, path: str, suffix: str) -> list[str]:
    fs, hadoop_path = file_system(spark, path)
    names = [str(status.getPath().getName()) for status in fs.listStatus(hadoop_path)]
    return sorted(n for n in names if n.startswith("part-") and n.endswith(suffix))


def rename(spark: SparkSession, source: str, target: str) -> None:
    fs, source_path = file_system(spark, source)
    if not fs.rename(source_path, spark._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"could not rename {source} to {target}")


def replace_file(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file over another in one step: readers find the old one or the new one. On a local
    disk the plain rename does that; the checksums beside both files go first, as they could not follow in the same step."""
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    fs, target_path = file_system(spark, target)
    if fs.getScheme() == "file":
        raw = fs.getRawFileSystem()
        for path in (source, target):
            folder, name = path.rsplit("/", 1)
            raw.delete(jvm.org.apache.hadoop.fs.Path(f"{folder}/.{name}.crc"), False)
        if not raw.rename(jvm.org.apache.hadoop.fs.Path(source), target_path):
            raise OSError(f"could not rename {source} to {target}")
        return
    rename_option = jvm.org.apache.hadoop.fs.Options.Rename
    options = gateway.new_array(rename_option, 1)
    options[0] = rename_option.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(jvm.org.apache.hadoop.fs.Path(source), target_path, options)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small text file; None if there is none."""
    fs, hadoop_path = file_system(spark, path)
    if not fs.exists(hadoop_path):
        return None
    stream = fs.open(hadoop_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file, whole or not at all: written beside ``path`` and put in its place."""
    folder, name = path.rsplit("/", 1)
    beside = f"{folder}/.{name}-{uuid.uuid4().hex}"
    fs, hadoop_path = file_system(spark, beside)
    stream = fs.create(hadoop_path)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    replace_file(spark, beside, path)


def claim(spark: SparkSession, path: str) -> bool:
    """Make an empty file; False if it is there already."""
    fs, hadoop_path = file_system(spark, path)
    fs.mkdirs(hadoop_path.getParent())
    return fs.createNewFile(hadoop_path)


def age_seconds(spark: SparkSession, path: str) -> float | None:
    """Seconds since a file was written; None if it is gone."""
    status = (file_system(spark, path)[0].globStatus(file_system(spark, path)[1]) or [None])[0]
    return None if status is None else time.time() - status.getModificationTime() / 1000


def delete_if_empty(spark: SparkSession, folder: str) -> None:
    if exists(spark, folder) and not names(spark, folder):
        delete(spark, folder)
