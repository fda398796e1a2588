"""Session helpers: sane defaults and the shared folder for durable intermediates."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def build_session(app: str = "shelfcount", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and skew handling on, in UTC."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` as the cluster sets it.

    Only a local-mode session may fall back to a fresh folder under the machine's
    temporary directory; elsewhere a missing setting is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="run-")
    context.setCheckpointDir(folder)
    return folder


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Session settings that hold inside the block."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


_owned: ContextVar[str | None] = ContextVar("owned", default=None)


@contextmanager
def owned_scratch(spark: SparkSession) -> Iterator[str]:
    """Durable intermediates written inside the block are deleted at its end.

    Results that read them must have been written or collected by then.
    """
    folder = os.path.join(shared_folder(spark), "scratch", uuid.uuid4().hex)
    token = _owned.set(folder)
    try:
        yield folder
    finally:
        _owned.reset(token)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder, or below that of ``owned_scratch``."""
    base = _owned.get() or os.path.join(shared_folder(spark), "scratch")
    return os.path.join(base, uuid.uuid4().hex, name)


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and go on from the written copy.

    The copy survives lost executors, ends the lineage, and later reads touch only the columns
    they need. Columns of no type become text.
    """
    spark = df.sparkSession
    void = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NullType)]
    stored = df.withColumns({c: F.col(f"`{c}`").cast("string") for c in void}) if void else df
    path = scratch_path(spark, "table")
    stored.write.parquet(path)
    return spark.read.schema(stored.schema).parquet(path)
