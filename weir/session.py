"""Session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)

#: Rows of a batch that goes to Python, or that the Parquet reader decodes at once, where a
#: row holds a whole text.
TEXT_ROWS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": 1000,
    "spark.sql.parquet.columnarReaderBatchSize": 512,
}


def configure(spark: SparkSession) -> SparkSession:
    """Set the runtime options that results depend on; sizing stays the cluster's."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def configure_texts(spark: SparkSession) -> SparkSession:
    """Batches of few rows, for tables of whole texts: by default a batch for Python has
    10,000 rows, which a task holds in Spark, in Arrow and in the worker at once. Only the
    memory of tasks depends on it; smaller settings of the cluster stay."""
    for key, rows in TEXT_ROWS.items():
        if not 0 < int(spark.conf.get(key)) <= rows:
            spark.conf.set(key, str(rows))
    return spark


def configure_streaming(spark: SparkSession) -> SparkSession:
    """``configure`` plus the state store that keyed state and timers need.

    Changelog checkpointing writes only the changes of a micro-batch to the
    checkpoint, so commit time follows the batch and not the size of the state.
    """
    configure(spark)
    _ = spark.streams  # starts the coordinator that batch runs of processors need, too
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    spark.conf.set(
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true"
    )
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names in ``spark.checkpoint.dir``. Where it
    is unset, a local session, whose tasks all see one disk, gets a folder beside its
    warehouse."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_weir_checkpoint"
