"""Session defaults, shared-folder checkpoints and the size checks behind join strategies."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# A lookup table at or below this many rows may be broadcast; the rows are counted first.
BROADCAST_ROWS_CONF = "spark.medloom.broadcastRows"
BROADCAST_ROWS_DEFAULT = 500_000
# Below this estimated input size one hot key still fits a single task, so joins stay unsalted.
SALT_BYTES_CONF = "spark.medloom.saltBytes"
SALT_BYTES_DEFAULT = 8 * 1024**3
# A join key with more rows than this is spread over several tasks.
HOT_KEY_ROWS_CONF = "spark.medloom.hotKeyRows"
HOT_KEY_ROWS_DEFAULT = 5_000_000
SALT_FACTOR_CONF = "spark.medloom.saltFactor"
SALT_FACTOR_DEFAULT = 32
# Windows over whole groups hold their rows in sorters, so a task gets the groups of about so many bytes of input files.
PARTITION_BYTES_CONF = "spark.medloom.partitionBytes"
PARTITION_BYTES_DEFAULT = 4 * 1024**2
MOST_PARTITIONS = 1 << 20  # sizes beyond stand for unknown ones


def local_session(app: str = "medloom", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benches. Clusters bring their own session."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def conf_int(spark: SparkSession, key: str, default: int) -> int:
    return int(spark.conf.get(key, str(default)))


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables that driver and executors share: ``spark.checkpoint.dir`` of the session.

    Only a local master may go without; a temporary folder is made for it. Elsewhere a machine's own folder would be lost to
    the others, so the setting is required.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
        folder = context.getCheckpointDir()
    return folder


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage in the shared folder, so a lost executor never recomputes ``df``.

    A written table does so in a fraction of the space of ``checkpoint()``, which stores whole rows unpacked.
    """
    return written(df)


def scratch_path(spark: SparkSession, kind: str = "table") -> str:
    """A new path in the shared folder. What is written there goes when the driver's JVM ends."""
    path = f"{shared_folder(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(target)  # only what exists can be marked
    system.deleteOnExit(target)
    return path


def written(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read on from it, so that later scans read only their columns.

    It is packed by zstd, which takes less disk than the session's default. The table goes when the driver's JVM ends.
    """
    spark = df.sparkSession
    path = f"{scratch_path(spark)}/data"
    df.write.parquet(path, compression="zstd")
    return spark.read.schema(df.schema).parquet(path)


def fits_broadcast(df: DataFrame) -> bool:
    """Count up to the limit, so the answer costs no more than the limit itself."""
    cap = conf_int(df.sparkSession, BROADCAST_ROWS_CONF, BROADCAST_ROWS_DEFAULT)
    return cap > 0 and df.limit(cap + 1).count() <= cap


def scan_bytes(df: DataFrame) -> int:
    """Bytes of the files below ``df`` as Spark sees them; no job is run."""
    spark = df.sparkSession
    total = 0
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    for i in range(leaves.size()):
        total += int(str(leaves.apply(i).stats().sizeInBytes()))
    return total


def may_be_skewed(df: DataFrame) -> bool:
    limit = conf_int(df.sparkSession, SALT_BYTES_CONF, SALT_BYTES_DEFAULT)
    try:
        return scan_bytes(df) > limit
    except Exception:  # no JVM handle (for example a remote session): take the careful way
        return True


def placed(df: DataFrame, source: DataFrame, *keys: str) -> DataFrame:
    """``df`` placed by ``keys`` in a number of partitions that grows with the files below ``source``.

    Shuffled rows of numbers compress well, so that a partition merged up to the session's advisory size may hold millions of them.
    What fits one partition, or has no known size, is left to the session.
    """
    size = conf_int(df.sparkSession, PARTITION_BYTES_CONF, PARTITION_BYTES_DEFAULT)
    try:
        parts = -(-scan_bytes(source) // size)
    except Exception:  # no JVM handle
        return df
    return df.repartition(parts, *keys) if 1 < parts < MOST_PARTITIONS else df
