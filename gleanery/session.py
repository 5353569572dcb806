"""Session helpers: table scans, reliable checkpoints and size-checked broadcasts."""

from __future__ import annotations

import atexit
import os
import pathlib
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast only if it was counted and holds at most this many rows.
BROADCAST_ROWS = 100_000


def local_session(cores: str = "8", name: str = "gleanery") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


def ship(spark: SparkSession) -> None:
    """Give the package to the Python workers, wherever they run and whatever their path.

    Spark serves the archive from the driver, as it does with ``--py-files``.
    """
    context = spark.sparkContext
    if getattr(context, "_has_gleanery", False):
        return
    root = pathlib.Path(__file__).resolve().parent
    if root.is_dir():  # else it runs from an archive that was given along already
        folder = tempfile.mkdtemp(prefix="gleanery-")  # Spark serves the archive from here until the driver ends
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        archive = os.path.join(folder, "gleanery.zip")
        with zipfile.ZipFile(archive, "w") as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, f.relative_to(root.parent))
        context.addPyFile(archive)
    context._has_gleanery = True


def give_file(spark: SparkSession, parts: Iterable[bytes]) -> str:
    """Write a file part by part and give it to all machines, each once; ``SparkFiles.get`` of its name finds it there."""
    folder = tempfile.mkdtemp(prefix="gleanery-")  # as in ``ship``
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    name = uuid.uuid4().hex
    with open(os.path.join(folder, name), "wb") as f:
        f.writelines(parts)
    spark.sparkContext.addFile(f.name)
    return name


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Scan one table; naming the columns keeps the read schema narrow."""
    ship(spark)
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share, as ``spark.checkpoint.dir`` names it.

    A folder of this machine is taken only where the session names none and runs on this
    machine alone, as in tests; on a cluster each executor would write to its own disk.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that all executors share")
        named = os.path.join(tempfile.gettempdir(), "gleanery-checkpoints")
        spark.sparkContext.setCheckpointDir(named)
    return named


def checkpoint(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage, in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """Partition by ``columns`` for work that is heavy for its bytes.

    Adaptive execution would join small partitions by their size, and leave a few tasks
    with all the work.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    asked = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(2 * cores, asked), *columns)


def drained(stream: DataFrame, mode: str = "append") -> DataFrame:
    """Run a stream over all that is there now and read its rows, with the ``batch`` each came in."""
    spark = stream.sparkSession
    ship(spark)
    at, written = f"{shared_folder(spark)}/streams/{uuid.uuid4().hex}", []

    def write(batch: DataFrame, n: int) -> None:
        batch.write.mode("overwrite").parquet(f"{at}/out/batch={n}")
        written.append(n)

    stream.writeStream.outputMode(mode).option("checkpointLocation", f"{at}/state").trigger(availableNow=True).foreachBatch(write).start().awaitTermination()
    if not written:  # a stream without any file has no batch
        return spark.createDataFrame([], stream.schema).withColumn("batch", F.lit(0))
    return spark.read.parquet(f"{at}/out")


def small_side(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Checkpoint ``df`` and mark it for broadcast if it was counted to be within ``limit``.

    Above the limit it comes back unmarked, so that joins with it are shuffled.
    """
    kept = checkpoint(df)
    return F.broadcast(kept) if kept.count() <= limit else kept
