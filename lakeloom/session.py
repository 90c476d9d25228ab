"""Session settings and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Runtime settings every job in this package relies on. They can be set on a
# live session, so the package also works on a session built by someone else.
RUNTIME_SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join partition even where that costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Stream state on local disk instead of the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

TARGET_PARTITION_BYTES = 128 * 1024 * 1024
SCRATCH_SETTING = "spark.checkpoint.dir"


def shuffle_partitions(cores: int, input_bytes: int | None = None) -> int:
    """Upper bound for shuffle partitions; adaptive execution merges small ones."""
    by_cores = max(cores, 1) * 3
    if not input_bytes:
        return by_cores
    return max(by_cores, -(-input_bytes // TARGET_PARTITION_BYTES))


def build_session(
    app: str = "lakeloom",
    master: str | None = None,
    input_bytes: int | None = None,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or get) a session with the package's settings.

    ``input_bytes`` is the size of the largest input; it sizes the shuffle.
    """
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if "spark.sql.shuffle.partitions" not in (settings or {}):
        cores = spark.sparkContext.defaultParallelism
        spark.conf.set("spark.sql.shuffle.partitions", shuffle_partitions(cores, input_bytes))
    return spark


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session; they stay set.

    Results depend on them (time zone, ANSI arithmetic), so a session that needs other
    values should be another one (``spark.newSession()``).
    """
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session may
    fall back to a temporary folder: on a cluster, executors would not see it.
    """
    named = spark.conf.get(SCRATCH_SETTING, None)
    if not named:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        named = current.get() if current.isDefined() else None
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {SCRATCH_SETTING} to a folder all executors share")
    local = tempfile.mkdtemp(prefix="lakeloom-")
    spark.sparkContext.setCheckpointDir(local)
    return scratch_root(spark)


_made_here: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused folder name below the scratch root."""
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"
    _made_here.append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Remove the scratch folders this process named; returns how many there were.

    For callers that have read or stored all results: DataFrames that still refer to
    scratch tables cannot be read afterwards.
    """
    paths = [spark._jvm.org.apache.hadoop.fs.Path(p) for p in _made_here]
    found = [p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True) for p in paths]
    _made_here.clear()
    return sum(found)


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once and read it back: cuts lineage, survives lost executors."""
    return materialize_counted(df, label)[0]


def materialize_counted(df: DataFrame, label: str = "stage") -> tuple[DataFrame, int]:
    """The same, with the row count taken by the writing job."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), int(seen.get.get("n", 0))
