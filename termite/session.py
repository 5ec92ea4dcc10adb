"""Session and scratch-space helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "termite") -> SparkSession:
    """A local session for tests and the benchmark (the cluster brings its own).

    Adaptive execution re-plans joins and coalesces partitions from runtime
    statistics; the web UI stays off."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="termite-ckpt-"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A cluster must name one that all its machines share; only a local session,
    whose tasks run on this machine, gets a folder of its own if it is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext._jsc.sc().conf().get("spark.checkpoint.dir", "")  # type: ignore[attr-defined]
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="termite-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path below the checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/termite/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (written to the shared checkpoint folder), so that a
    lost executor recomputes from the written files, not the whole lineage."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a fresh shared path and read back: later uses read the
    files, and nothing stays cached on executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


_SHIPPED = False


def ship_package(spark: SparkSession) -> None:  # noqa: ARG001 (kept for call sites)
    """Make the pandas UDFs of ``termite`` runnable on executors that do not
    have the package installed: their functions are pickled by value into
    the task closures (pyspark's bundled cloudpickle), so no file is written
    or distributed."""
    global _SHIPPED
    if _SHIPPED:
        return
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules["termite"])
    _SHIPPED = True
