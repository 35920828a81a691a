"""Session settings and shipping of this package to executors."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_SHIPPED = "CITELOOM_SHIPPED"


def build(master: str = "local[*]", partitions: int = 8, **conf: str) -> SparkSession:
    """A session for local work; on a cluster the session given by the cluster is used as it is."""
    builder = SparkSession.builder.master(master).appName("citeloom")
    settings = {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    } | conf
    return builder.config(map=settings).getOrCreate()


def ship(spark: SparkSession) -> SparkSession:
    """Makes this package importable on all executors, once per application."""
    context = spark.sparkContext
    if os.environ.get(_SHIPPED) == context.applicationId:
        return spark
    root = Path(__file__).resolve().parent
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    name = os.path.join(tempfile.mkdtemp(prefix="citeloom-"), "citeloom.zip")
    Path(name).write_bytes(data.getvalue())
    context.addPyFile(name)
    os.environ[_SHIPPED] = context.applicationId
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session. It has to be set."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def stage(df: DataFrame, name: str) -> DataFrame:
    """Writes a table into the shared folder and reads it back: it is computed once, and lost executors cost nothing."""
    spark = df.sparkSession
    path = os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
