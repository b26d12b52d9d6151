"""Session defaults and the shared folder for cut lineage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # p_date=20251130 directories must read back as strings, not ints
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.parquet.compression.codec": "snappy",
    # item sets come from rows already sorted by user: aggregate them in that order
    "spark.sql.execution.replaceHashWithSortAgg": "true",
    # what a stream has seen is kept on disk, and its changes with the checkpoint
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # rankings by row number need no buffer: cut keys before the shuffle whatever the limit
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000000000",
}
# on a cluster: many shuffle partitions at first, which adaptive execution merges by size
CLUSTER_DEFAULTS = {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8192"}


def session_builder(
    app_name: str, master: str | None = None, extra: dict[str, str] | None = None
) -> SparkSession.Builder:
    """A builder with the defaults the plans were written for; ``extra`` wins over them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    far = {} if (master or "").startswith("local") else CLUSTER_DEFAULTS
    for key, value in {**DEFAULTS, **far, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Where the cluster names none, use one below the warehouse: tables live there, so it is
    reachable from wherever the tables are. A warehouse on local disks is none on a cluster.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    return fallback_dir(warehouse, spark.sparkContext.master)


def fallback_dir(warehouse: str, master: str) -> str:
    if not master.startswith("local") and (warehouse.startswith("file:") or "://" not in warehouse):
        raise ValueError(
            f"the warehouse {warehouse} may lie on local disks: name a shared folder in spark.checkpoint.dir"
        )
    return f"{warehouse}/_covisit_shared"


class Staged:
    """A frame written once to the shared folder and read back, so its lineage ends there.

    Unlike a cached frame it outlives lost executors, and unlike two runs of one lazy plan
    it gives all its readers the same rows. Use as a context manager: the files go when the
    block ends.
    """

    def __init__(self, df: DataFrame, label: str):
        self._spark = df.sparkSession
        self.path = f"{shared_dir(self._spark)}/staged/{label}-{uuid.uuid4().hex}"
        try:
            df.write.parquet(self.path)
        except BaseException:
            self.close()
            raise
        self.frame = self._spark.read.schema(df.schema).parquet(self.path)

    def __enter__(self) -> DataFrame:
        return self.frame

    def __exit__(self, *exc: object) -> None:
        self.close()

    def close(self) -> None:
        jvm_path = self._spark._jvm.org.apache.hadoop.fs.Path(self.path)
        conf = self._spark._jsparkSession.sessionState().newHadoopConf()
        jvm_path.getFileSystem(conf).delete(jvm_path, True)
