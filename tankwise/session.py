"""Session settings and staged tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Java compiles no method of more than 8,000 bytes of code, it interprets them: whole-stage code that is longer
#: runs many times slower than the same operators one by one, whose code Spark splits into short methods.
CODE = {"spark.sql.codegen.hugeMethodLimit": "8000"}


def build_session(app: str = "tankwise", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators assume (UTC, adaptive execution)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.ui.enabled": "false",
        # Stateful stream operators with timers need this store.
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
        # Recording a call site for every column expression dominates the building of wide plans.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **CODE,
    } | {key.replace("__", "."): value for key, value in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the session time zone, so that calendar parts do not depend on the host, and the limit of code."""
    for name, value in {"spark.sql.session.timeZone": "UTC", **CODE}.items():
        spark.conf.set(name, value)
    return spark


def stage_root(spark: SparkSession) -> str:
    """The shared folder for staged tables: the cluster's checkpoint folder.

    Only a local session without that setting gets a folder on this machine."""
    context = spark.sparkContext
    root = (
        spark.conf.get("spark.checkpoint.dir", None)
        or context.getConf().get("spark.checkpoint.dir")
        or context.getCheckpointDir()
    )
    if root is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="tankwise-stage-")
        context.setCheckpointDir(root)
    return root


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Later jobs then neither repeat the lineage nor depend on executors that held cached blocks."""
    spark = df.sparkSession
    path = f"{stage_root(spark).rstrip('/')}/staged/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def staged_path(spark: SparkSession, kind: str) -> str:
    """A folder name of its own below the shared folder, for files that are not tables."""
    return f"{stage_root(spark).rstrip('/')}/{kind}/{uuid.uuid4().hex}"


def staged_bytes(df: DataFrame) -> int:
    """Bytes of the files that :func:`stage` wrote for a frame."""
    spark, total = df.sparkSession, 0
    for folder in {name.rpartition("/")[0] for name in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        total += path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
    return total


def release(*staged: DataFrame) -> None:
    """Delete what :func:`stage` wrote for these frames, once nothing reads them any more.

    Only files below the shared folder's ``staged`` are deleted."""
    for df in staged:
        spark = df.sparkSession
        for folder in {name.rpartition("/")[0] for name in df.inputFiles()}:
            if "/staged/" in folder:
                path = spark._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
