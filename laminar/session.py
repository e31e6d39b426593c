"""Session settings and the shared working folder for written layer tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import SparkSession

# Settings every job relies on: ANSI casts are the strict casts of the
# reference's dialect, timestamps are compared in UTC, and AQE coalesces the
# shuffle partitions of the small per-state aggregates and splits skewed joins.
SESSION_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "laminar", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings above.

    On a cluster leave ``master`` unset and size ``shuffle_partitions`` to the
    data (AQE coalesces small stages); on one machine pass ``local[N]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_CONF)
    conf["spark.ui.enabled"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_conf(spark)
    return spark


def apply_conf(spark: SparkSession) -> None:
    """Apply the runtime SQL settings to a session someone else built."""
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session; only when it is unset on a local master (tests) a fresh
    temporary folder is chosen and registered, so ``checkpoint()`` works too.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # a remote (Connect) session has no local SparkContext
        sc = None
    if not root and sc is not None:
        root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root and (sc is None or not sc.master.startswith("local")):      # a remote session cannot be told to be local
        raise RuntimeError("set spark.checkpoint.dir to a folder that the whole cluster shares")
    if not root:
        root = tempfile.mkdtemp(prefix="laminar-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


_MADE: list[str] = []


def workspace(spark: SparkSession, name: str) -> str:
    """A new, never reused folder for the layer tables of one run; it stays until ``release``."""
    path = f"{checkpoint_root(spark)}/laminar/{name}-{uuid.uuid4().hex[:12]}"
    _MADE.append(path)
    return path


def workspaces() -> list[str]:
    """The folders that this process has asked for and not released, oldest first."""
    return list(_MADE)


def release(spark: SparkSession, paths: Iterable[str]) -> None:
    """Remove folders of ``workspace``; frames that still read them must not be used again."""
    for path in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
        if path in _MADE:
            _MADE.remove(path)


__all__ = ["SESSION_CONF", "build_session", "apply_conf", "checkpoint_root", "workspace", "workspaces", "release"]
