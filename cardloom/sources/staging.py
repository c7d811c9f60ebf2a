"""Stage tables: written once to shared storage, read back with a known size."""

from __future__ import annotations

import hashlib
import json
import tempfile
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_root: ContextVar[str | None] = ContextVar("stage_root", default=None)
_fallback_dir: str | None = None


@contextmanager
def stage_root(path: str) -> Iterator[None]:
    """Stages without a path of their own go below ``path`` meanwhile. They may be
    deleted once the job's results are written."""
    token = _root.set(path.rstrip("/"))
    try:
        yield
    finally:
        _root.reset(token)


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``stage_root``, or that named by ``spark.checkpoint.dir``. Only
    where neither is given (tests, one machine) is a temporary one made."""
    global _fallback_dir
    named = _root.get() or spark.conf.get("spark.checkpoint.dir", None)
    named = named or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if _fallback_dir is None:
        _fallback_dir = tempfile.mkdtemp(prefix="cardloom-")
    return _fallback_dir


def _file_system(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def finished(spark: SparkSession, path: str) -> bool:
    """Whether a stage was written there to its end."""
    place, fs = _file_system(spark, f"{path}/_SUCCESS")
    return fs.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    place, fs = _file_system(spark, path)
    fs.delete(place, True)


# What a stage was made of, beside it: its maker, the settings that went in, and the plan and
# files of every input.


def _roots(df: DataFrame) -> list[str] | None:
    """The folders and files a frame reads; None where some of it comes from elsewhere."""
    found: list[str] = []
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        kind = leaf.getClass().getSimpleName()
        if kind in ("Range", "OneRowRelation"):
            continue  # their plan says it all
        if not kind.startswith("LogicalRelation") or not hasattr(leaf.relation(), "location"):
            return None
        try:
            paths = leaf.relation().location().rootPaths()
        except Exception:  # a relation without files
            return None
        found += [paths.apply(k).toString() for k in range(paths.size())]
    return sorted(found)


def _plan(df: DataFrame) -> str:
    """The analyzed plan without the numbers that differ from run to run."""
    spark = df.sparkSession
    key = "spark.sql.debug.maxToStringFields"
    before = spark.conf.get(key)
    spark.conf.set(key, str(1 << 20))
    try:
        return df._jdf.queryExecution().analyzed().canonicalized().toString()
    finally:
        spark.conf.set(key, before)


def fingerprint(df: DataFrame) -> dict:
    """What a frame is, without computing it: its plan, and number, total size and a
    digest of path, size and time of the files it reads. They are listed by tasks; one
    row of sums comes back. A frame that reads no files is told by its rows."""
    spark = df.sparkSession
    plan = hashlib.sha256(_plan(df).encode()).hexdigest()
    roots = _roots(df)
    if roots:
        listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(roots)
        what = ["path", "length", "modificationTime"]
        size = F.sum("length")
    elif roots is None:
        listed, what, size = df, [f"`{c}`" for c in df.columns], F.lit(None).cast("long")
    else:
        return {"plan": plan}
    row = listed.agg(
        F.count(F.lit(1)).alias("n"),
        size.alias("bytes"),
        F.sum(F.xxhash64(*what).cast("decimal(38,0)")).alias("digest"),
    ).first()
    return {"plan": plan, "n": row["n"], "bytes": row["bytes"], "digest": str(row["digest"])}


def manifest(name: str, settings: Mapping[str, object], inputs: Sequence[DataFrame]) -> dict:
    return {
        "name": name,
        "settings": {k: repr(v) for k, v in sorted(settings.items())},
        "inputs": [fingerprint(df) for df in inputs],
    }


def _manifest_path(path: str) -> str:
    return f"{path.rstrip('/')}.manifest"


def read_manifest(spark: SparkSession, path: str) -> dict | None:
    place, fs = _file_system(spark, _manifest_path(path))
    if not fs.exists(place):
        return None
    stream = fs.open(place)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        return json.loads(text)
    except (ValueError, Py4JJavaError):  # cut off while it was written: no record
        return None
    finally:
        stream.close()


def _write_manifest(spark: SparkSession, path: str, record: dict) -> None:
    place, fs = _file_system(spark, _manifest_path(path))
    stream = fs.create(place, True)
    try:
        stream.write(bytearray(json.dumps(record, sort_keys=True).encode()))
    finally:
        stream.close()


def resumed(
    spark: SparkSession,
    make: Callable[[], DataFrame],
    path: str,
    name: str = "",
    settings: Mapping[str, object] | None = None,
    inputs: Sequence[DataFrame] = (),
) -> DataFrame:
    """The stage at ``path``: read where an earlier run finished it from equal inputs and
    settings, else made and written. What an interrupted run left there, or one with other
    inputs, is overwritten. Stages that operators make meanwhile are deleted once it is there.

    ``inputs`` are compared by plan and files: a file added, replaced or of another
    size makes the stage anew, and so everything that reads it.
    """
    record = manifest(name, settings or {}, inputs)
    if not finished(spark, path) or read_manifest(spark, path) != record:
        place, fs = _file_system(spark, _manifest_path(path))
        fs.delete(place, False)  # until the stage is whole it has no record
        work = f"{path.rstrip('/')}.work"
        with stage_root(work):
            stage_write(make(), path, mode="overwrite")
        _write_manifest(spark, path, record)
        remove(spark, work)
    return stage_read(spark, path)


def stage_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/cardloom/{name}-{uuid.uuid4().hex}"


def stage_write(
    df: DataFrame, path: str, mode: str = "error", partition_by: Sequence[str] = ()
) -> str:
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)
    return path


def stage_read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def staged(
    df: DataFrame, name: str, path: str | None = None, partition_by: Sequence[str] = ()
) -> DataFrame:
    """Write and read back. Cuts the lineage, survives lost executors, and gives
    the optimizer the real size of the table."""
    spark = df.sparkSession
    path = stage_write(df, path or stage_path(spark, name), partition_by=partition_by)
    return stage_read(spark, path)
