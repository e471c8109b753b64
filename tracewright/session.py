"""Session helpers: a tuned local session and durable lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(app: str = "tracewright", master: str | None = None, cores: int | None = None):
    """Session for tests and benchmarks; a cluster passes its own session instead."""
    builder = SparkSession.builder.appName(app)
    if master:
        # A local session is one JVM: its driver memory is all the memory there is.
        builder = builder.master(master).config("spark.driver.memory", "8g")
    if cores:
        builder = builder.config("spark.sql.shuffle.partitions", str(cores))
    return (
        builder.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


_DURABLE = "tracewright-"
_local_folder: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, named by ``spark.checkpoint.dir``."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    application = context.applicationId
    if application not in _local_folder:
        _local_folder[application] = tempfile.mkdtemp(prefix="tracewright-")
    return _local_folder[application]


def durable(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back from there.

    Used where a value that is only stable within one execution (a partition id) must stay
    the same for every later reader, also after executors are lost, and where several
    results start from one intermediate. A columnar table, so each reader scans only the
    columns it needs. What ``release`` does not delete is the cluster's to clean up.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/{_DURABLE}{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def release(*tables: DataFrame) -> None:
    """Delete tables that ``durable`` wrote, once all that was made from them is written itself."""
    for table in tables:
        context = table.sparkSession.sparkContext
        for folder in {name.rpartition("/")[0] for name in table.inputFiles()}:
            if folder.rpartition("/")[2].startswith(_DURABLE):
                path = context._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


BROADCAST_ROWS = 200_000


def is_small(proven_rows: int | None) -> bool:
    return proven_rows is not None and proven_rows <= BROADCAST_ROWS


def broadcast_if_small(df: DataFrame, proven_rows: int | None) -> DataFrame:
    """Broadcast hint only behind a proven row bound; otherwise Spark picks the join."""
    return F.broadcast(df) if is_small(proven_rows) else df
