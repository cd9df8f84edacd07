"""Session helpers: local builder for tests and benches, and lineage cuts."""

from __future__ import annotations

import atexit
import contextlib
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Runtime settings the operators rely on. A hot join key is split by AQE, and the
# split is kept even when a later step needs one more exchange because of it.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def local_session(cores: str | int = 8, app: str = "replyloom", memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Call sites of column expressions cost one round trip each while a plan is built.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in ADAPTIVE.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def tune(spark: SparkSession) -> SparkSession:
    """Turn on the adaptive settings in a session somebody else made.

    On a cluster a shuffle starts with several partitions per core unless the session names a number;
    AQE merges the small ones afterwards.
    """
    for key, value in ADAPTIVE.items():
        spark.conf.set(key, value)
    context = spark.sparkContext
    if not context.master.startswith("local") and spark.conf.get(INITIAL_PARTITIONS, None) is None:
        start = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * context.defaultParallelism)
        spark.conf.set(INITIAL_PARTITIONS, str(start))
    return spark


def default_stage_folder(warehouse: str, master: str) -> str:
    """Where stage tables go when the session names no folder: below the warehouse, unless other machines cannot see that."""
    on_this_machine = warehouse.startswith("file:") or "://" not in warehouse
    if on_this_machine and not master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors reach; the warehouse is a folder of this machine")
    return f"{warehouse}/replyloom-stages"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder for stage tables and checkpoints, one that Spark's file system resolves on every machine.

    It is ``spark.checkpoint.dir``, or a folder below the warehouse where that is not set. A warehouse on one machine's disk is refused
    on a cluster.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        context.setCheckpointDir(named or default_stage_folder(spark.conf.get("spark.sql.warehouse.dir"), context.master))
    return context.getCheckpointDir()


def _delete(jvm, configuration, name: str, ending: bool = False) -> None:
    # When the process ends, the JVM may be gone already.
    with contextlib.suppress(Exception) if ending else contextlib.nullcontext():
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(configuration).delete(path, True)


_STAGES: list[str] = []
_FOLDERS: set[str] = set()


def new_stage(spark: SparkSession) -> str:
    """A new path in the checkpoint folder; it is removed with the stage tables."""
    # Spark's checkpoint folder is the application's own, so nothing in it outlives the process.
    tables = f"{ensure_checkpoint_dir(spark)}/tables"
    if tables not in _FOLDERS:
        _FOLDERS.add(tables)
        context = spark.sparkContext
        atexit.register(_delete, context._jvm, context._jsc.hadoopConfiguration(), tables, True)
    _STAGES.append(f"{tables}/{uuid.uuid4().hex}")
    return _STAGES[-1]


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once as a table in the checkpoint folder and go on from the files.

    A table cuts the lineage as a checkpoint does, and later steps still read only the columns and row
    groups they need and know its size when they plan a join. It stays until ``drop_stages``.
    """
    spark = df.sparkSession
    path = new_stage(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt over all cores where its input has fewer splits than there are cores, as one small file has.

    For work that costs much per row. Larger inputs are left as they lie, so nothing is shuffled there.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def stages() -> int:
    """A mark for ``drop_stages``: how many stage tables there are now."""
    return len(_STAGES)


def drop_stages(spark: SparkSession, since: int = 0) -> None:
    """Remove the stage tables written after the mark ``since``; frames built on them can no longer be read."""
    jvm = spark.sparkContext._jvm
    configuration = spark.sparkContext._jsc.hadoopConfiguration()
    while len(_STAGES) > since:
        _delete(jvm, configuration, _STAGES.pop())


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint, for narrow loop state that is read back whole."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def cut_counting(df: DataFrame, condition: Column) -> tuple[DataFrame, int]:
    """``cut_lineage`` and the number of rows that satisfy ``condition``, from the same job."""
    observation = Observation()
    written = cut_lineage(df.observe(observation, F.count_if(condition).alias("n")))
    return written, observation.get["n"]


def write_counting(df: DataFrame, condition: Column) -> tuple[DataFrame, int]:
    """As ``cut_counting``, but as a stage table: a checkpoint keeps what the planner inferred, which can grow with every round of a loop."""
    observation = Observation()
    written = materialize(df.observe(observation, F.count_if(condition).alias("n")))
    return written, observation.get["n"]
