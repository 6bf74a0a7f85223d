"""Session settings the jobs rely on."""

from __future__ import annotations

import hashlib
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even where that adds a shuffle for a later operator
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # lines already partitioned by region and part also serve joins by region, part and month
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # HotSpot never compiles a method above 8000 bytes: wide projections then run in its interpreter, many times slower. Beyond
    # this size Spark takes its plain projections, which it splits into small methods
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # the shuffle files of a stage that has been written go at once, not when the driver happens to collect garbage
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}
_TIME_ZONE = "spark.sql.session.timeZone"
_GIVEN_UP = ".given-up"


def configure(spark: SparkSession) -> SparkSession:
    """Set what the jobs rely on, but for keys that the caller has set; results need the time zone, so it is always set."""
    given = {k for k, _ in spark.sparkContext.getConf().getAll()}
    for key, value in _DEFAULTS.items():
        if key == _TIME_ZONE or (key not in given and not _changed(spark, key)):
            spark.conf.set(key, value)
    return spark


def _changed(spark: SparkSession, key: str) -> bool:
    """Whether the session has a value of its own for a key."""
    return spark._jsparkSession.sessionState().conf().contains(key)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts: the cluster's setting, else one for this local run."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current is None:
        configured = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
        if configured is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            configured = tempfile.mkdtemp(prefix="sparecost-checkpoint-")
        context.setCheckpointDir(configured)
        current = context.getCheckpointDir()
    return current


def stage_end(df: DataFrame) -> DataFrame:
    """Write a stage to shared storage and read it back.

    Later stages do not depend on executors that may be lost, and read only the columns they need.
    """
    path = f"{checkpoint_dir(df.sparkSession)}/stage-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Stages:
    """The stored stages of one run. A run that failed continues behind its last finished stage.

    A stage is finished once the writer has put its success mark. Stages of a run are found again by the name of the run
    and by what it was made from (`basis`: parameters, and the schemas of the inputs): with another basis they start anew. Leave the
    `with` block after the result is written: without an error the stages are deleted, with one they stay.
    """

    def __init__(self, spark: SparkSession, run: str | None = None, basis: object = ""):
        digest = hashlib.sha256(repr(basis).encode()).hexdigest()[:16]
        self.spark, self.resumed, self.path = spark, [], f"{checkpoint_dir(spark)}/run-{run or uuid.uuid4().hex}-{digest}"
        self._cuts: list[str] = []

    def __enter__(self) -> Stages:
        return self

    def __exit__(self, kind, *_) -> None:
        if kind is None:
            self.clear()

    def _at(self, name: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def _fs(self):
        return self._at("x").getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def clear(self) -> None:
        self._fs().delete(self._at("."), True)

    def end(self, name: str, build: Callable[[], DataFrame], instead_of: str | None = None) -> DataFrame | None:
        """The stage `name`: read if an earlier run has finished it, else built, written and read.

        instead_of: an earlier stage that only this one reads. Once this one is finished its files go and its mark stays, so
        one cut of the lines is stored at a time and not all; a later run is given None for it, and must not read it.
        """
        path = f"{self.path}/{name}"
        if self._fs().exists(self._at(f"{name}/_SUCCESS")):
            self.resumed.append(name)
        else:
            build().write.mode("overwrite").option("compression", "zstd").parquet(path)
        while self._cuts:
            self._fs().delete(self._at(self._cuts.pop()), True)
        if instead_of is not None:
            self.give_up(instead_of)
        return None if self._fs().exists(self._at(f"{name}{_GIVEN_UP}")) else self.spark.read.parquet(path)

    def cut(self, df: DataFrame) -> DataFrame:
        """Rows within a stage, written and read: their shuffle files go. They are deleted once the stage is finished."""
        name = f"cut-{len(self._cuts)}"
        df.write.mode("overwrite").option("compression", "zstd").parquet(f"{self.path}/{name}")
        self._cuts.append(name)
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{name}")

    def give_up(self, name: str) -> None:
        """Delete the files of a finished stage that nothing reads any more; its mark stays."""
        if not self._fs().exists(self._at(f"{name}{_GIVEN_UP}")):
            self._fs().create(self._at(f"{name}{_GIVEN_UP}"), True).close()
            for status in self._fs().listStatus(self._at(name)):
                if status.getPath().getName() != "_SUCCESS":
                    self._fs().delete(status.getPath(), True)
