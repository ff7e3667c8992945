"""Session settings and the shared folder that holds derived tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_ROOTS: dict[str, str] = {}

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # AQE turns a shuffled join into a broadcast only once the measured size allows
    # it, and splits the partition of a hot key over several tasks.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Files of a query's shuffles go when it ends, and not when the driver's heap is next collected:
    # a run of many steps holds those of the step at hand. Stored steps never read them.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}

#: For the tables of a warehouse. Sorts and hash aggregates of a task that reads one of them stay in
#: memory when its split is small, whatever the table's size.
WAREHOUSE_SETTINGS = {
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.files.maxPartitionBytes": "32m",
}


def tune(spark: SparkSession, settings: dict[str, str] = RUNTIME_SETTINGS) -> SparkSession:
    """Apply the runtime settings the engine relies on to an existing session."""
    for name, value in settings.items():
        spark.conf.set(name, value)
    return spark


def local_session(app: str = "starloom", cpus: str = "8", memory: str = "8g", **extra: str
                  ) -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", cpus)
    )
    for name, value in {**RUNTIME_SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder for derived tables, reachable by every executor.

    It is the one the cluster names in ``spark.checkpoint.dir``. Only a local master,
    where driver and executors are one process, may fall back to a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="starloom-")
    return _LOCAL_ROOTS[app]


class Scratch:
    """Parquet tables written once each below a fresh folder of the shared root.

    Storing a frame cuts its lineage in a way that survives the loss of executors, and
    fixes values such as partition numbers which a recomputation might change.
    """

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = root or f"{shared_root(spark)}/starloom-{uuid.uuid4().hex[:12]}"

    def part(self, name: str) -> Scratch:
        """A folder of its own inside, which can be cleared by itself."""
        return Scratch(self.spark, self.path(name))

    def clear(self) -> None:
        """Remove all tables; frames that read them must not be used any more."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}-{uuid.uuid4().hex[:12]}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and return a frame that reads it back."""
        path = self.path(name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

