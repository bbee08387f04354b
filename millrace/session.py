"""Session defaults, and making this package importable on executors."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
_shipped: set[str] = set()


def session(name: str = "millrace", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the engine's defaults; ANSI stays on, so casts that may fail are try_ casts."""
    b = SparkSession.builder.appName(name)
    if master:
        b = b.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    return b.config(map=defaults | {k.replace("__", "."): v for k, v in conf.items()}).getOrCreate()


def shared_base(spark: SparkSession) -> str:
    """The folder that all machines see; a temporary one only in local mode, and only where none is set."""
    context = spark.sparkContext
    base = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not base:
        if not (context.master or "").startswith("local[") and context.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = f"file://{tempfile.mkdtemp(prefix='millrace-')}"
        context.setCheckpointDir(base)
    return base.rstrip("/")


def ensure_importable(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package: by path in local mode, else as a shipped archive, once an application."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return spark
    _shipped.add(sc.applicationId)
    if str(ROOT) in os.environ.get("PYTHONPATH", "").split(":"):
        return spark
    if sc.master.startswith("local[") or sc.master == "local":
        sc.environment["PYTHONPATH"] = ":".join(x for x in (str(ROOT), sc.environment.get("PYTHONPATH", "")) if x)
        return spark
    archive = Path(tempfile.mkdtemp(prefix="millrace-package-")) / "millrace_package.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for p in (ROOT / "millrace").rglob("*.py"):
            z.write(p, p.relative_to(ROOT))
    sc.addPyFile(str(archive))
    return spark
