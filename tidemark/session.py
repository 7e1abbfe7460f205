"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid
from collections.abc import Iterator

from pyarrow import fs
from pyspark.sql import SparkSession

_LOCAL_FALLBACK: dict[str, str] = {}
_JOBS: list[str] = []


def build_session(app_name: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; ANSI mode stays on."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.ui.enabled": "false",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which every executor can reach.

    Only a local session without that setting falls back to a folder of its own.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master.split("[")[0] != "local":
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_FALLBACK:
        _LOCAL_FALLBACK[app] = tempfile.mkdtemp(prefix="tidemark-")
        spark.sparkContext.setCheckpointDir(_LOCAL_FALLBACK[app])
    return _LOCAL_FALLBACK[app]


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, or below the folder of the job at hand."""
    return f"{_JOBS[-1] if _JOBS else shared_folder(spark) + '/tidemark'}/{label}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def job_folder(spark: SparkSession, name: str) -> Iterator[str]:
    """Intermediate tables made inside lie in one folder, which is removed at the end.

    Operators return frames that read their intermediate tables, so what is to
    be kept has to be written before the block ends.
    """
    path = new_folder(spark, f"job-{name}")
    _JOBS.append(path)
    try:
        yield path
    finally:
        _JOBS.remove(path)
        system, place = fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
        if system.get_file_info(place).type != fs.FileType.NotFound:
            system.delete_dir(place)


def checkpointed(df):
    """``df`` written to the shared checkpoint folder, with its lineage cut."""
    shared_folder(df.sparkSession)
    return df.checkpoint()
