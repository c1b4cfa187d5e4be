"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import getpass
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Applied by `build_session`; on a cluster, sizes (memory, cores, shuffle partitions) and
# object-store access come from its own configuration.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # The JVM does not compile longer methods. Stages that would need one fall back to shorter
    # ones per operator instead of running uncompiled.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Without the Python line of every column in error messages, plans are built faster.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "meterline", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings above; `settings` use `__` for dots and win over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in settings.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder name under `spark.checkpoint.dir`, which every executor must reach.

    Only a local session without that setting gets a folder of its own; a cluster
    without it is refused, since a machine-local folder would be lost with its machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or _own_folder(spark)
    return f"{root.rstrip('/')}/meterline/{label}-{uuid.uuid4().hex}"


def shared_path(spark: SparkSession, name: str) -> str:
    """A folder under `spark.checkpoint.dir` that later applications find again under the same name.

    A local session without that setting has it in its user's temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return f"{root.rstrip('/')}/meterline/{name}"
    _own_folder(spark)  # refuses a cluster
    return f"{tempfile.gettempdir()}/meterline-{getpass.getuser()}/{name}"


# The setting cannot be changed on a running session, so a folder made here is kept here.
_OWN_FOLDERS: dict[str, str] = {}


def _own_folder(spark: SparkSession) -> str:
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    application = spark.sparkContext.applicationId
    if application not in _OWN_FOLDERS:
        _OWN_FOLDERS[application] = tempfile.mkdtemp(prefix="meterline-")
        atexit.register(shutil.rmtree, _OWN_FOLDERS[application], ignore_errors=True)
    return _OWN_FOLDERS[application]
