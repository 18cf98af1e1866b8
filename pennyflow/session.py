"""Session defaults and the shared working folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(name: str = "pennyflow", **extra: str) -> SparkSession:
    """A session with the settings the jobs expect; the cluster's own settings win where given."""
    builder = (
        SparkSession.builder.appName(name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # state on disk, so that a stream's memory does not grow with its keys
        .config(STATE_STORE, ROCKS_DB)
    )
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


@lru_cache(maxsize=1)
def _local_root() -> str:
    """One temporary folder for this process, gone with it."""
    root = tempfile.mkdtemp(prefix="pennyflow-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    return root


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder.

    Only a local master may fall back to a temporary folder: on a cluster a machine-local folder
    would not survive the loss of that machine, so the setting is demanded there.
    """
    root = spark.conf.get(CHECKPOINT_SETTING, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder all executors share")
        root = _local_root()
    return os.path.join(root, f"{purpose}-{uuid.uuid4().hex}")
