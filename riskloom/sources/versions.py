"""Small state that several runs change: versioned, committed in one step, never half written.

A store is a folder with ``data/<id>/`` (Parquet) and ``versions/<number>.json``. Every version holds the whole state, so it
is for tables with a row per model, activation or decision, not for rows of data. A writer puts its files below a new
folder first and then claims the next number. The file that claims it appears whole or not at all, and only one writer gets
a number: by a hard link on a local or mounted file system, elsewhere by a rename that refuses an existing target. The file
system has to do the latter atomically, as HDFS does; plain object stores do not.

Readers follow the highest version. Folders that no version names belong to runs that died or lost; they change nothing.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

#: How often ``update`` starts again after it lost a number to another writer.
ATTEMPTS = 20


#: Scheme of file systems that know hard links.
LOCAL = "file"


class CommitConflict(RuntimeError):
    """Another writer has committed the version that this one wanted to write."""


@dataclass(frozen=True)
class Version:
    number: int
    folder: str
    #: Names the run that wrote it, so that a repeated run is recognised.
    token: str | None


def _fs(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _numbers(spark: SparkSession, root: str) -> list[int]:
    fs, place = _fs(spark, f"{root}/versions")
    if not fs.exists(place):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(place)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def _read_text(spark: SparkSession, path: str) -> str:
    fs, place = _fs(spark, path)
    stream = fs.open(place)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, place = _fs(spark, path)
    stream = fs.create(place, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of all versions, in order."""
    return _numbers(spark, root)


def version(spark: SparkSession, root: str, number: int | None = None) -> Version | None:
    """A version, by default the highest; None where the store has none."""
    if number is None:
        known = _numbers(spark, root)
        if not known:
            return None
        number = known[-1]
    found = json.loads(_read_text(spark, f"{root}/versions/{number:012d}.json"))
    return Version(number, f"{root}/data/{found['data']}", found["token"])


def read(spark: SparkSession, root: str, number: int | None = None) -> DataFrame | None:
    """The state at a version, by default the highest; None where the store has none."""
    found = version(spark, root, number)
    return None if found is None else spark.read.parquet(found.folder)


def _claim(spark: SparkSession, prepared: str, target: str) -> bool:
    """Give the prepared file its final name; False if the name is taken."""
    fs, source = _fs(spark, prepared)
    if fs.getUri().getScheme() == LOCAL:
        local = lambda p: spark._jvm.org.apache.hadoop.fs.Path(p).toUri().getPath()
        try:
            os.link(local(prepared), local(target))
        except FileExistsError:
            return False
        return True
    hadoop = spark._jvm.org.apache.hadoop.fs
    context = hadoop.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    options[0] = hadoop.Options.Rename.NONE
    try:
        context.rename(source, hadoop.Path(target), options)
    except Py4JJavaError as e:
        if "FileAlreadyExistsException" in e.java_exception.getClass().getName():
            return False
        raise
    return True


def commit(df: DataFrame, root: str, base: int, token: str | None = None) -> int:
    """Write ``df`` as the version after ``base``; ``CommitConflict`` if another writer has it already.

    ``df`` is read while nothing names its files, so it may read the store itself.
    """
    spark = df.sparkSession
    name = uuid.uuid4().hex
    df.write.parquet(f"{root}/data/{name}")
    fs, place = _fs(spark, f"{root}/versions")
    fs.mkdirs(place)
    # Names that end in .claim are no versions.
    prepared = f"{root}/versions/{name}.claim"
    _write_text(spark, prepared, json.dumps({"data": name, "token": token}))
    won = _claim(spark, prepared, f"{root}/versions/{base + 1:012d}.json")
    left = _fs(spark, prepared)[1]
    if fs.exists(left):
        fs.delete(left, False)
    if not won:
        raise CommitConflict(f"version {base + 1} of {root} was committed by another writer")
    return base + 1


def update(
    spark: SparkSession,
    root: str,
    change: Callable[[DataFrame | None], DataFrame],
    token: str | None = None,
    attempts: int = ATTEMPTS,
) -> int:
    """Commit ``change`` of the state (None before the first version); begins again when another writer was faster.

    With a ``token``, nothing happens if a version was written under it: a repeated run finds its own commit.
    """
    tried = 0
    while True:
        now = version(spark, root)
        if token is not None and now is not None:
            for number in reversed(_numbers(spark, root)):
                if version(spark, root, number).token == token:
                    return number
        try:
            return commit(change(None if now is None else spark.read.parquet(now.folder)), root,
                          0 if now is None else now.number, token)
        except CommitConflict:
            tried += 1
            if tried >= attempts:
                raise
