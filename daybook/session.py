"""Session helpers: a local session for tests and benches, and the shared folder of a cluster."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import SparkSession

_local_base: dict[str, str] = {}
_made: list[str] = []


def local_session(cpus: int | str = "*", memory: str = "8g", name: str = "daybook") -> SparkSession:
    """Local session for tests and benches. On a cluster the session comes from the caller."""
    partitions = cpus if str(cpus).isdigit() else 8
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # Methods beyond 8000 bytes are never compiled by the JVM; wide casts are, column by column, without fusion.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which every executor can reach.

    Only a local session may do without the setting; it then gets a folder of its own under /tmp.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or None
    if base is None:
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "local")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        if "base" not in _local_base:
            _local_base["base"] = tempfile.mkdtemp(prefix="daybook-")
            atexit.register(shutil.rmtree, _local_base["base"], ignore_errors=True)
        base = _local_base["base"]
    _made.append(f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}")
    return _made[-1]


def shared_folders() -> list[str]:
    """The folders that this driver has made below the shared one and not dropped, in that order."""
    return list(_made)


def drop_shared_folders(spark: SparkSession, folders: Iterable[str] | None = None) -> None:
    """Delete the given folders, or all that this driver has made below the shared one, once nothing reads them any more."""
    for path in shared_folders() if folders is None else list(folders):
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
        if path in _made:
            _made.remove(path)


def ship_package(spark: SparkSession) -> str:
    """Send this package to the executors of a session, where it is not installed; returns the archive."""
    package = os.path.dirname(os.path.abspath(__file__))
    archive = shutil.make_archive(
        os.path.join(tempfile.mkdtemp(prefix="daybook-"), os.path.basename(package)), "zip", os.path.dirname(package),
        os.path.basename(package))
    spark.sparkContext.addPyFile(archive)
    return archive
