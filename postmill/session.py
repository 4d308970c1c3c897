"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# Settings the jobs rely on. Speculation would ask a model twice for the same mails.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.speculation": "false",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app: str = "postmill", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the recommended settings; ``extra`` holds more ``key=value`` pairs."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the folder that ``spark.checkpoint.dir`` names.

    Every executor must be able to reach it. A machine-local folder is used only
    in local mode, where there is one machine; on a cluster the setting is required.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        application = spark.sparkContext.applicationId
        if application not in _local_dirs:
            _local_dirs[application] = tempfile.mkdtemp(prefix="postmill-")
        base = _local_dirs[application]
    return f"{base.rstrip('/')}/postmill/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def clear_shared(spark: SparkSession) -> bool:
    """Delete what this application has written to the shared folder; returns if there was any.

    Call it after the last read of a result: results are read from these tables, and a
    result that is not written elsewhere is lost with them.
    """
    own = shared_dir(spark, "x").rpartition("/")[0]
    path = spark._jvm.org.apache.hadoop.fs.Path(own)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(files.delete(path, True))


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers, once per application.

    Functions that run in workers are sent by name, so the workers need the modules.
    Spark's own file service hands the archive to every executor, also to later ones.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="postmill-")) / "postmill.zip"
    with zipfile.ZipFile(archive, "w") as target:
        for module in sorted(package.rglob("*.py")):
            target.write(module, module.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
