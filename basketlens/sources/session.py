"""Session helpers: shared folders for written intermediates and checkpoints."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A machine-local folder is used only in local mode, where no cluster
    setting exists.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if sc.applicationId not in _LOCAL_DIRS:
        _LOCAL_DIRS[sc.applicationId] = "file://" + tempfile.mkdtemp(prefix="basketlens-")
    return _LOCAL_DIRS[sc.applicationId]


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no earlier write has used."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df, label: str = "cut", group_bytes: int | None = None):
    """Write ``df`` to the shared folder and read it back (survives lost executors).

    ``group_bytes`` bounds the row groups: what a task holds of the file while it writes, and, where rows are long, what the reader
    makes into one batch.
    """
    path = fresh_path(df.sparkSession, label)
    writer = df.write
    if group_bytes is not None:
        # Sizes are looked at after each row, as a hundred long ones would be many times the bound.
        writer = writer.option("parquet.block.size", group_bytes).option("parquet.block.size.row.check.min", 1).option(
            "parquet.page.size.row.check.min", 1)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, most: int = 8 << 20) -> None:
    """Hand rows to Python in Arrow batches of about ``most`` bytes (or one row); a setting of the session that changes no result.

    Spark's own bounds let a batch hold all the files of a task.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(most))
