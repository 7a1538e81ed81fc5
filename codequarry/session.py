"""Session settings the jobs expect, and the shared folder for written intermediates."""

import atexit
import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Whole functions travel to numpy in Arrow batches; rows may be up to a mebibyte each.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


def local_session(cores: int = 8, app: str = "codequarry", memory: str = "12g") -> SparkSession:
    """Session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="codequarry-"))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's folder for intermediates, as the session names it.

    Where it names none, a local master gets a temporary folder; a cluster has to name one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="codequarry-")
    return _local_dirs[app]


_local_dirs: dict[str, str] = {}
# Paths given out and not yet deleted, by Spark application.
_given: dict[str, list[str]] = {}


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; deleted by ``release``, or when Python ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _given.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Used where several branches start from one expensive table: lineage ends at the files, a
    lost executor costs a re-read, and each branch prunes to the columns it needs.
    """
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, keep: int = 0) -> None:
    """Delete the intermediates of this application but the first ``keep``."""
    given = _given.get(spark.sparkContext.applicationId, [])
    conf = spark._jsc.hadoopConfiguration()
    for path in given[keep:]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(conf).delete(folder, True)
    del given[keep:]


@contextlib.contextmanager
def intermediates(spark: SparkSession) -> Iterator[None]:
    """Deletes on leaving what was written inside; results have to be written out before."""
    before = len(_given.get(spark.sparkContext.applicationId, []))
    try:
        yield
    finally:
        release(spark, keep=before)


@atexit.register
def _release_all() -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None:
        with contextlib.suppress(Exception):  # the JVM may be gone already
            release(spark)
