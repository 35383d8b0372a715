"""Spark session helpers.

The engine never hard-codes cluster settings: on a real cluster the session
comes from ``spark-submit`` and its defaults.  ``build_session`` is the local
entry point used by tests and ``bench.py``; ``checkpoint_dir`` reads the shared
checkpoint folder the cluster names and only invents one when it is unset.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# Settings every job relies on (UTC calendar arithmetic, ANSI casts that fail
# loudly like the warehouse did, adaptive execution for skew and join choice).
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Broadcast only sides whose (estimated or runtime-measured) size is under
    # this bound; bigger sides fall back to a shuffled sort-merge join.
    "spark.sql.autoBroadcastJoinThreshold": str(1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(1024 * 1024),
    "spark.sql.parquet.filterPushdown": "true",
    # Batches to Python tasks are bounded in bytes and rows, whatever a row holds.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 * 1024 * 1024),
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2048",
    "spark.ui.enabled": "false",
}


def build_session(
    app: str = "starwright",
    cpus: int | str = "*",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Local session with the engine's settings (tests, bench, smoke runs)."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    conf = dict(CORE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(
        shuffle_partitions or (cpus if cpus != "*" else os.cpu_count() or 8)
    )
    conf.setdefault("spark.driver.memory", "8g")
    conf.setdefault("spark.ui.showConsoleProgress", "false")
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_core_conf(spark)
    return spark


def apply_core_conf(spark: SparkSession) -> None:
    """Pin the runtime SQL settings on an existing session (driver-made ones too)."""
    for key, value in CORE_CONF.items():
        if key.startswith("spark.sql."):
            spark.conf.set(key, value)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application: a worker
    started from another folder or on another machine cannot import it otherwise."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    archive = os.path.join(tempfile.mkdtemp(prefix="starwright-package-"), "starwright.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for file in sorted([*package.rglob("*.py"), *package.parent.glob("corpus_pipeline.py")]):
            z.write(file, file.relative_to(package.parent))
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)


_FALLBACK_DIRS: dict[str, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Uses ``spark.checkpoint.dir`` from the session (on a cluster: a shared
    file system path).  Only when it is unset, as in unit tests, a local
    folder is created once per application and registered with
    ``setCheckpointDir`` (the config itself cannot change at runtime).
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        app = spark.sparkContext.applicationId
        if app not in _FALLBACK_DIRS:
            _FALLBACK_DIRS[app] = tempfile.mkdtemp(prefix="starwright-ckpt-")
        path = _FALLBACK_DIRS[app]
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path
