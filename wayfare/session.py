"""Session settings the plans rely on, and the shared folder for written intermediates."""

from __future__ import annotations

import atexit
import shutil
import uuid
from functools import lru_cache

from pyspark.sql import SparkSession

# Runtime settings; all of them can be set on a session that already runs.
RUNTIME = {
    # Every timestamp in the data model is UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot join key feeding a window or aggregate on the same key would otherwise stay in
    # one task, because splitting it costs an extra shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Python workers get batches of bounded size, however long the rows are.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
    # JSON objects with a repeated key keep the last value, as most JSON readers do.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(app: str = "wayfare", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or get) a session with the runtime settings and the web page switched off."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder name below the cluster's shared folder (``spark.checkpoint.dir``).

    Without that setting, a local master writes below its warehouse and removes it at exit; a
    cluster must name the folder, since the executors of another machine read it too.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        shared = _below_warehouse(spark.conf.get("spark.sql.warehouse.dir"))
    return f"{shared.rstrip('/')}/wayfare/{label}-{uuid.uuid4().hex}"


@lru_cache
def _below_warehouse(warehouse: str) -> str:
    folder = f"{warehouse.rstrip('/')}/_scratch-{uuid.uuid4().hex}"
    atexit.register(shutil.rmtree, folder.removeprefix("file:"), ignore_errors=True)
    return folder
