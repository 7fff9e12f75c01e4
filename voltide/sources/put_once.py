"""Files that are written once and whole: whoever comes second is told so.

The text goes to a file of its own first and then gets its name in one step that fails where the name is
taken: a rename on HDFS and the stores that follow its rules, a hard link on local disks (a local rename would
replace). Readers see all of a file or none of it.
"""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import SparkSession


def _file(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def put_if_absent(spark: SparkSession, path: str, record: dict) -> bool:
    """Write the record under the path; False, and no change, if the path is there already."""
    place, fs = _file(spark, path)
    data = json.dumps(record, sort_keys=True, default=str).encode()
    fs.mkdirs(place.getParent())
    if fs.exists(place):
        return False
    folder = place.getParent()
    draft = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder, f".{place.getName()}-{uuid.uuid4().hex}")
    if fs.getUri().getScheme() == "file":
        local = draft.toUri().getPath()
        with open(local, "xb") as f:
            f.write(data)
            f.flush()
            os.fsync(f.fileno())
        try:
            os.link(local, place.toUri().getPath())
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(local)
    out = fs.create(draft, False)
    out.write(data)
    out.close()
    if not fs.exists(place) and fs.rename(draft, place):
        return True
    fs.delete(draft, False)
    return False


def records(spark: SparkSession, folder: str) -> dict[int, dict]:
    """The records of a folder by the number in their names. For small control data, read by the driver."""
    place, fs = _file(spark, folder)
    if not fs.exists(place):
        return {}
    out = {}
    for status in fs.listStatus(place):
        name = status.getPath().getName()
        if not name.endswith(".json") or name.startswith("."):
            continue
        stream = fs.open(status.getPath())
        try:
            out[int(name.removesuffix(".json"))] = json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()
    return out


def numbered(folder: str, n: int) -> str:
    return f"{folder}/{n:010d}.json"
