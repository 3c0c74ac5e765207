"""Session helpers: a local session for tests/bench, and checkpoint-dir handling.

On a cluster the session comes from the caller; nothing here overrides a setting
the cluster already made.  ``spark.checkpoint.dir`` is read from the session and
only set when it is missing (tests, local bench).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOCAL_DEFAULTS = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "16g",
}


def local_session(cores: int | str = "*", app: str = "boxframe", **conf: str) -> SparkSession:
    """A local session with sane defaults for tests and the bench."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in {**LOCAL_DEFAULTS, **conf}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, setting a scratch one only if unset.

    A cluster names a shared folder in ``spark.checkpoint.dir``; that one is used
    as is.  Only an unset session on a local master (tests) gets a fresh ``mktemp``
    folder; on a cluster an unset folder is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="boxframe-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the reliable checkpoint dir (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """``df`` as a compressed table below the reliable checkpoint dir: cuts lineage like :func:`cut_lineage`, in a
    fraction of the bytes, and a reader takes only the columns that it needs.  Partitioning is not kept."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/rows-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def computed_once(df: DataFrame, keep: list[str]) -> DataFrame:
    """``df`` with all columns but ``keep`` out of a generator, so that filters, join conditions and projections above
    read them instead of repeating their expressions (the generated code stays small enough to be compiled)."""
    rest = [c for c in df.columns if c not in keep]
    return df.select(*keep, F.inline(F.array(F.struct(*rest)))).select(*df.columns)


def ship_package(spark: SparkSession) -> None:
    """Make ``boxframe`` importable in Python workers (pandas UDFs, ``mapInPandas``).

    Zips the package once per SparkContext and hands it to ``addPyFile``; Spark
    distributes it to every executor.  A no-op when already shipped."""
    import zipfile

    sc = spark.sparkContext
    if getattr(sc, "_boxframe_shipped", False):
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="boxframe-pkg-"), "boxframe.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(out)
    sc._boxframe_shipped = True
