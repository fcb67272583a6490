"""Intermediate tables on shared storage, which survive the loss of executors."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which every executor must reach.

    Only a local session, whose executors share the driver's disk, gets a folder of its own where none is named;
    a cluster without the setting raises ``ValueError``.
    """
    folder = spark.conf.get(SETTING, None) or spark.sparkContext.getConf().get(SETTING)
    if not folder:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError(f"set {SETTING} to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="pressgrid-")
        spark.conf.set(SETTING, folder)
    return folder.rstrip("/")


def stage(rows: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write ``rows`` once and read them back, so that several results can start from them.

    A Parquet table keeps column pruning for the readers, which a checkpointed RDD does not.
    """
    spark = rows.sparkSession
    path = f"{folder or shared_folder(spark)}/pressgrid-{uuid4().hex}/{name}"
    rows.write.mode("overwrite").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


class Stages:
    """Owner of steps that several results start from; ``close`` (or leaving a ``with`` block) gives them up.

    Without a folder a step is persisted on the executors' disks. Nothing runs when it is named: Spark computes it with
    the first action that needs it, once for equal plans, and computes lost parts anew. With a ``folder``, which all executors must
    reach, a step is written there when it is named, and survives the loss of every executor.
    """

    def __init__(self, folder: str | None = None) -> None:
        self.folder = folder
        self._held: list[DataFrame] = []
        self._written: list[tuple[SparkSession, str]] = []

    def keep(self, rows: DataFrame, name: str = "rows") -> DataFrame:
        if self.folder is None:
            self._held.append(rows.persist(StorageLevel.DISK_ONLY))
            return rows
        spark, path = rows.sparkSession, f"{self.folder.rstrip('/')}/pressgrid-{uuid4().hex}"
        self._written.append((spark, path))
        rows.write.parquet(f"{path}/{name}")
        return spark.read.schema(rows.schema).parquet(f"{path}/{name}")

    def close(self) -> None:
        while self._held:
            self._held.pop().unpersist()
        while self._written:
            spark, path = self._written.pop()
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)

    def __enter__(self) -> Stages:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()


#: Owner of steps that no one else owns; ``STAGES.close()`` gives them up.
STAGES = Stages()
