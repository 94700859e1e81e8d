"""Session construction and the shared checkpoint folder.

On a cluster the session comes from ``spark-submit`` and already names
``spark.checkpoint.dir`` (a shared folder, e.g. on HDFS or object storage).
``checkpoint_dir`` reads that setting; only when it is unset (local tests)
does it create a scratch folder.
"""

from __future__ import annotations

import os
import re
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that matter at scale. AQE re-plans joins from runtime sizes,
# splits skewed join partitions and coalesces small shuffle partitions.
# Static broadcast is off: its size comes from file-size estimates, which do
# not bound exploded rows (a 10 MB text file is many times that as tokens).
# A side is broadcast only when its measured shuffle output is under the
# adaptive threshold.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


# Partition sizing for 100 TB-class inputs on a large cluster. Shuffles start
# with many partitions and AQE coalesces them to ~256 MB each, so no reducer
# holds more than it can spill-free sort or hash; scans split files at 256 MB;
# a skewed join partition (5x the median and over 1 GB) is split.
# Streams are different: a stateful query fixes its state partitions at its
# first start and AQE does not coalesce them, so start streams with
# spark.sql.shuffle.partitions sized to the state (a few per core), and bound
# sink files with the stream writers' ``output_files``.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "16384",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "16384",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def get_session(master: str | None = None, app_name: str = "tallyflow",
                shuffle_partitions: int | None = None,
                extra_conf: dict[str, str] | None = None,
                profile: str = "local") -> SparkSession:
    """Return the active session or build one with ``DEFAULT_CONF``
    (plus ``CLUSTER_CONF`` when ``profile="cluster"``)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if profile == "cluster":
        conf.update(CLUSTER_CONF)
    elif profile != "local":
        raise ValueError("profile must be 'local' or 'cluster'")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def with_conf(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Session settings for a while; what was set before is set again."""
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the session.

    Reads ``spark.checkpoint.dir``; where it is unset, a local master gets a
    scratch folder of its own (tests), and a cluster an error: a folder of one
    machine would not be shared.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if not re.match(r"local($|\[)", master):
            raise ValueError(f"set spark.checkpoint.dir to a shared folder (master {master})")
        d = tempfile.mkdtemp(prefix="tallyflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def sub_dir(spark: SparkSession, name: str) -> str:
    """A named folder under the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), name)
