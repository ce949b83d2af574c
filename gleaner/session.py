"""Session set-up and the shared scratch folder that jobs use to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(app_name: str = "gleaner", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library relies on (UTC, AQE, skew join)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, or the checkpoint folder that the program set itself.

    Without either nothing can be shared between executors, so it fails.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder that the driver and all executors share")
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the scratch root; never reused, so a rerun cannot read old data."""
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    _scratch.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


#: The scratch paths handed out, by application.
_scratch: dict[str, list[str]] = {}


def release(spark: SparkSession) -> int:
    """Delete all scratch data of this application, once its results are written elsewhere; the number of paths."""
    paths = _scratch.pop(spark.sparkContext.applicationId, [])
    for name in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
    return len(paths)


def path_exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(place)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage on storage that outlives executors, computes the plan once, and gives the
    planner real sizes for the joins that follow.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def setting(spark: SparkSession, name: str, value: int | str) -> Iterator[None]:
    """A setting of the session for what runs inside; then as before."""
    before = spark.conf.get(name)
    spark.conf.set(name, str(value))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def pack(archive: Path) -> Path:
    """This package, texts included, as a zip that Python imports from."""
    package = Path(__file__).resolve().parent
    with zipfile.ZipFile(archive, "w") as bundle:
        for path in sorted(path for ending in ("py", "txt") for path in package.rglob(f"*.{ending}")):
            bundle.write(path, path.relative_to(package.parent))
    return archive


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, for sessions that were not started with ``--py-files``."""
    context = spark.sparkContext
    if getattr(context, "_gleaner_shipped", False):
        return
    archive = pack(Path(tempfile.mkdtemp(prefix="gleaner-zip-")) / "gleaner.zip")
    context.addPyFile(str(archive))
    context._gleaner_shipped = True
