"""Session settings, the package on executors, and the one place that decides where scratch tables go."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def build_session(app_name: str = "ludolake", master: str | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A session with the settings every job here relies on (UTC, AQE, skew join, Arrow)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
        "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    }
    settings.update(extra or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_roots: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    On a cluster a missing setting is an error, as executors could not see a local folder. A local session,
    whose one process is driver and executor, then gets a folder of its own for each application.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    app = context.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="ludolake-")
    return _local_roots[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, never reused folder under the shared root."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Sends this package to the executors, once for each application, as ``--py-files`` would."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="ludolake-code-")) / f"ludolake-{app}.zip"  # Spark's file server hands it out
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, str(file.relative_to(package.parent)))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)
