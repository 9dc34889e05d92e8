"""Stored runs and the model registry: Parquet folders in a shared file system, published whole.

Everything is written under a fresh name first and then moved to its final name by a rename that
refuses a name already taken.  A reader sees a folder complete or not at all, and of two writers of
one name exactly one succeeds (as far as the file system's rename is atomic, as HDFS' is).  Any path
Spark can write works; nothing is read or written outside Spark and the Hadoop file system API.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.operators import metrics as M
from tabforge.session import stored

RUN_FIELDS = ("run_id string, model_name string, accuracy double, mae double, f1_macro double, bal_acc double,"
              " roc_auc_ovr double")
CONFUSION_FIELDS = "label string, pred string, n long"
REGISTRY_FIELDS = "name string, version int, stage string, run_id string, path string"


class Conflict(RuntimeError):
    """The name or version is already taken: somebody else was first."""


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, path: str):
    p = _path(spark, path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _files(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, without those being written."""
    fs, p = _files(spark, path)
    found = [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []
    return sorted(n for n in found if not n.startswith(("_", ".")))


def publish(spark: SparkSession, draft: str, final: str) -> str:
    """Move a finished folder to its name; :class:`Conflict` if the name is taken."""
    fs, p = _files(spark, final)
    fs.mkdirs(p.getParent())
    hadoop = spark._jvm.org.apache.hadoop.fs
    plain = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        hadoop.FileContext.getFileContext(p.toUri(), spark._jsc.hadoopConfiguration()).rename(_path(spark, draft), p, plain)
    except Py4JJavaError as e:
        if "FileAlreadyExists" not in e.java_exception.getClass().getName():
            raise
        _files(spark, draft)[0].delete(_path(spark, draft), True)
        raise Conflict(f"{final} is already taken") from None
    return final


def draft_of(final: str) -> str:
    """A fresh hidden name beside the final one."""
    folder, _, name = final.rstrip("/").rpartition("/")
    return f"{folder}/_draft-{name}-{uuid.uuid4().hex[:12]}"


def write_json(spark: SparkSession, value, path: str) -> None:
    spark.createDataFrame([(json.dumps(value),)], "value string").coalesce(1).write.text(path)


def read_json(spark: SparkSession, path: str):
    return json.loads(spark.read.text(path).first()["value"])


class Runs:
    """Evaluated runs: one folder per run with its metrics and its confusion counts; never changed once there."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, f"{root.rstrip('/')}/runs"

    def append(self, metrics: DataFrame, confusion: DataFrame, model: Callable[[str], None] | None = None) -> str:
        """Store one run (``metrics``: one row of :data:`RUN_FIELDS`); returns its id.  A taken id is a :class:`Conflict`.

        ``model`` writes what belongs to the run into the folder it is given, ``model`` of the run.
        """
        kept = metrics.select([c.split()[0] for c in RUN_FIELDS.split(", ")]).collect()   # one row
        run_id = kept[0]["run_id"]
        final = f"{self.root}/{run_id}"
        draft = draft_of(final)
        self.spark.createDataFrame(kept, RUN_FIELDS).coalesce(1).write.parquet(f"{draft}/metrics")
        confusion.select("label", "pred", "n").coalesce(1).write.parquet(f"{draft}/confusion")
        if model:
            model(f"{draft}/model")
        publish(self.spark, draft, final)
        return run_id

    def evaluate(self, run_id: str, model_name: str, pred: DataFrame, model: Callable[[str], None] | None = None) -> str:
        """Metrics and confusion counts of a predictions table, stored as a run; the table is written once and read from there."""
        kept = stored(pred, "run-predictions")
        return self.append(M.run_metrics(kept, run_id, model_name), M.confusion_matrix(kept), model)

    def ids(self) -> list[str]:
        return names(self.spark, self.root)

    def table(self) -> DataFrame:
        """All runs, a row each."""
        paths = [f"{self.root}/{i}/metrics" for i in self.ids()]
        reader = self.spark.read.schema(RUN_FIELDS)
        return reader.parquet(*paths) if paths else self.spark.createDataFrame([], RUN_FIELDS)

    def confusion(self, run_id: str) -> DataFrame:
        return self.spark.read.schema(CONFUSION_FIELDS).parquet(f"{self.root}/{run_id}/confusion")


class Registry:
    """Model versions and their stages: numbered complete snapshots of one small table.

    A change reads the newest snapshot, writes the next one and publishes it under the next number.
    If that number is taken meanwhile, the change fails with :class:`Conflict` and leaves no trace.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, f"{root.rstrip('/')}/registry"

    def snapshot(self) -> int:
        """Number of the newest snapshot, 0 if there is none."""
        return max((int(n[1:]) for n in names(self.spark, self.root)), default=0)

    def table(self, snapshot: int | None = None) -> DataFrame:
        snapshot = self.snapshot() if snapshot is None else snapshot
        if not snapshot:
            return self.spark.createDataFrame([], REGISTRY_FIELDS)
        return self.spark.read.schema(REGISTRY_FIELDS).parquet(f"{self.root}/s{snapshot:08d}")

    def commit(self, table: DataFrame, after: int) -> int:
        """Publish ``table`` as the snapshot that follows ``after``."""
        final = f"{self.root}/s{after + 1:08d}"
        draft = draft_of(final)
        table.coalesce(1).write.parquet(draft)
        publish(self.spark, draft, final)
        return after + 1

    def register(self, name: str, run_id: str, path: str, stage: str = "Archived", after: int | None = None) -> int:
        """A new version of a model in the given stage; returns its number."""
        after = self.snapshot() if after is None else after
        old = self.table(after)
        version = (old.where(F.col("name") == name).agg(F.max("version")).first()[0] or 0) + 1
        row = self.spark.createDataFrame([(name, version, stage, run_id, path)], REGISTRY_FIELDS)
        self.commit(old.unionByName(row), after)
        return version

    def promote(self, name: str, best: DataFrame, after: int | None = None) -> int:
        """``best`` (one run) becomes the Production version; an older Production version becomes Archived."""
        after = self.snapshot() if after is None else after
        table = M.promote_best(self.table(after), best, name)
        return self.commit(table, after)

    def production(self, name: str) -> dict | None:
        """M3: version, path and run of the newest Production version, or None."""
        row = M.latest_production(self.table(), name).first()
        return row.asDict() if row["version"] is not None else None
