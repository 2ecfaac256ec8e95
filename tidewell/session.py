"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import sys
import tempfile
import types
import uuid

from pyspark.sql import DataFrame, SparkSession

_SCRATCH: dict[str, list[str]] = {}
_LOCAL_BASE: dict[str, str] = {}


def build_session(app: str = "tidewell", cpus: int | str = "*", **conf: str) -> SparkSession:
    """Local session with the settings the library expects; a cluster sets its own."""
    partitions = str(os.cpu_count() or 8) if cpus == "*" else str(cpus)
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": partitions,
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.driver.memory": "12g",
        "spark.tidewell.spread": partitions,
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of its own: executors on other
    machines could not read it, and losing the machine would lose the rows.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_BASE:
        _LOCAL_BASE[app] = tempfile.mkdtemp(prefix="tidewell-")
    return _LOCAL_BASE[app]


def new_folder(spark: SparkSession, name: str) -> str:
    """Path of a new folder in the shared one, deleted by ``release_scratch``."""
    path = f"{scratch_dir(spark)}/tidewell/{name}-{uuid.uuid4().hex}"
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def open_store(uri: str):
    """File system and path of a folder for tasks that read or write files; a plain path is a mounted folder."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri.removeprefix("file:"))


def read_folder(uri: str):
    """All rows of a folder of Parquet files as an Arrow table, for tasks that need a small table whole."""
    import pyarrow as pa
    import pyarrow.parquet as pq
    from pyarrow import fs

    store, base = open_store(uri)
    found = store.get_file_info(fs.FileSelector(base, allow_not_found=True))
    parts = []
    for name in sorted(f.path for f in found if f.path.endswith(".parquet")):
        with store.open_input_file(name) as source:
            parts.append(pq.ParquetFile(source).read())
    return pa.concat_tables(parts) if parts else pa.table({})


def kept_in_worker(key: str, make, most: int = 8):
    """What ``make`` gives, kept for the later tasks of a Python worker; at most ``most`` things are kept.

    They are held by an entry of sys.modules, as the names of code that is sent by value are new in every task.
    """
    held = sys.modules.setdefault("_tidewell_kept", types.ModuleType("_tidewell_kept")).__dict__.setdefault("held", {})
    if key not in held:
        while len(held) >= most:
            held.pop(next(iter(held)))
        held[key] = make()
    return held[key]


def settle(df: DataFrame, options: dict[str, str] | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where two branches must see the very same rows (range partition numbers,
    sampled bounds): a lost executor then re-reads files instead of re-sampling.
    ``options`` are those of the Parquet writer.
    """
    spark = df.sparkSession
    path = new_folder(spark, "rows")
    df.write.options(**options or {}).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.settled_path = path
    return out


def drop_settled(*frames: DataFrame) -> None:
    """Delete what ``settle`` wrote for these frames, once nothing reads them any more."""
    for df in frames:
        spark, path = df.sparkSession, getattr(df, "settled_path", None)
        mine = _SCRATCH.get(spark.sparkContext.applicationId, [])
        if path in mine:
            mine.remove(path)
            _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def release_scratch(spark: SparkSession) -> int:
    """Delete the folders this application settled or opened; call when their results are consumed."""
    paths = _SCRATCH.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        _delete(spark, path)
    return len(paths)


def spread(df: DataFrame) -> DataFrame:
    """Deal rows of costly work out to ``spark.tidewell.spread`` tasks; without that setting the scan's tasks stay.

    Meant for tables of a few files on many cores, where a scan has fewer tasks than there are cores.
    """
    tasks = df.sparkSession.conf.get("spark.tidewell.spread", None)
    return df.repartition(int(tasks)) if tasks else df
