"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def configure(spark: SparkSession) -> SparkSession:
    """Pin what results depend on (UTC) and adapt plans at run time.

    Stream state lies outside the heap, in a local session too.
    """
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    spark.conf.set(STATE_STORE, ROCKSDB)
    return spark


def workspace(spark: SparkSession, purpose: str) -> str:
    """A fresh folder that driver and executors all reach.

    The cluster names the shared folder in ``spark.checkpoint.dir``. Only a
    local session without that setting gets a temporary folder; a cluster
    without it is an error, because a machine-local folder would lose data.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/lakekeel/{purpose}-{uuid.uuid4().hex}"


def together(*actions: Callable[[], object]) -> list:
    """Run independent actions side by side, so that small jobs do not wait behind large ones.

    They run in the caller's job group: stopping a stream stops them too.
    """
    with ThreadPoolExecutor(max_workers=len(actions)) as pool:
        return [running.result() for running in [pool.submit(inheritable_thread_target(action)) for action in actions]]
