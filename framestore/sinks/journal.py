"""Small files beside the rows of a table: which batches it holds, and a change of files that is under way.

Their names begin with an underscore, so Spark does not read them as rows.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

_LEDGER = "_framestore_ledger"
_JOURNAL = "_framestore_commit"


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def read_json(spark: SparkSession, path: str) -> dict | None:
    """The object in a small file, or None without the file."""
    fs, file = _file_system(spark, path)
    if not fs.exists(file):
        return None
    stream = fs.open(file)
    try:
        return json.loads(bytes(stream.readAllBytes()))
    finally:
        stream.close()


def write_json(spark: SparkSession, path: str, value: dict) -> None:
    """Write a small file whole or not at all; an older one is exchanged in one step."""
    fs, file = _file_system(spark, path)
    part = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    stream = fs.create(part, True)
    try:
        stream.write(json.dumps(value).encode())
    finally:
        stream.close()
    rename = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(part, file, how)


def data_files(spark: SparkSession, folder: str) -> list[str]:
    """The names of the files in a folder that Spark reads as rows."""
    fs, path = _file_system(spark, folder)
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    return sorted(n for n in names if not n.startswith(("_", ".")))


def partition_folders(spark: SparkSession, folder: str, depth: int) -> list[str]:
    """The names of the partition folders below a folder, as `a=1/b=2`."""
    fs, root = _file_system(spark, folder)
    names = [""]
    for _ in range(depth):
        below = []
        for name in names:
            here = spark._jvm.org.apache.hadoop.fs.Path(root, name) if name else root
            found = [s.getPath().getName() for s in fs.listStatus(here) if s.isDirectory()]
            below += [f"{name}/{n}" if name else n for n in found if "=" in n]
        names = below
    return sorted(names)


def read_ledger(spark: SparkSession, location: str) -> dict[str, int]:
    """The last applied batch of each source, of the rows in `location`."""
    return read_json(spark, f"{location}/{_LEDGER}") or {}


def write_ledger(spark: SparkSession, location: str, ledger: dict[str, int]) -> None:
    if ledger:
        write_json(spark, f"{location}/{_LEDGER}", ledger)


def exchange_files(spark: SparkSession, location: str, folder: str, removed: list[str], ledger: dict[str, int]) -> None:
    """Move the files of `folder` into `location` and delete the `removed` ones there.

    The list of both is written first. From then on the change counts as made: `finish_exchange`
    completes it after a failure. What comes before leaves the table as it was.
    """
    change = {"folder": folder, "added": data_files(spark, folder), "removed": removed, "ledger": ledger}
    write_json(spark, f"{location}/{_JOURNAL}", change)
    finish_exchange(spark, location)


def finish_exchange(spark: SparkSession, location: str) -> bool:
    """Complete an exchange of files that was begun in `location`. Every step may be done again. True if there was one."""
    change = read_json(spark, f"{location}/{_JOURNAL}")
    if change is None:
        return False
    fs, root = _file_system(spark, location)
    new_path = spark._jvm.org.apache.hadoop.fs.Path
    folder = new_path(change["folder"])
    for name in change["added"]:
        source = new_path(folder, name)
        if fs.exists(source) and not fs.rename(source, new_path(root, name)):
            raise OSError(f"Could not move {source} to {location}")
    for name in change["removed"]:
        fs.delete(new_path(root, name), False)
    write_ledger(spark, location, change["ledger"])
    fs.delete(folder, True)
    fs.delete(new_path(root, _JOURNAL), False)
    return True
