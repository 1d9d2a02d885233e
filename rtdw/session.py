"""Session construction and cluster-facing settings.

The library never hard-codes a scratch folder: stored tables, stream checkpoints and
keyed tables lie under the shared folder named by the cluster in ``spark.checkpoint.dir``. Only
when that is unset (tests, laptops) do we pick one ourselves.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins from measured shuffle sizes
# (a broadcast only happens below the threshold, i.e. behind a size check),
# coalesces small partitions and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "rtdw", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder (a path or a URI).

    The cluster names it in ``spark.checkpoint.dir``. Only a local master may
    leave it unset: a folder on one machine is no shared folder, so on a
    cluster that is an error, not a fallback.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        current = tempfile.mkdtemp(prefix="rtdw-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    spark.sparkContext.setCheckpointDir(current)
    return current


def ship_package(spark: SparkSession) -> None:
    """Make ``rtdw`` importable in Python workers (state processors, UDTF):
    zip the package on the driver and hand that local file to ``addPyFile``,
    which serves it to every executor itself; no shared folder is involved."""
    if spark.conf.get("rtdw.package.shipped", "false") == "true":
        return
    import shutil

    pkg = os.path.dirname(os.path.abspath(__file__))
    archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="rtdw-pkg-"), "rtdw"), "zip",
                                  root_dir=os.path.dirname(pkg), base_dir="rtdw")
    spark.sparkContext.addPyFile(archive)
    spark.conf.set("rtdw.package.shipped", "true")


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Session settings for a time: a query that starts meanwhile keeps them."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def state_dir(spark: SparkSession, name: str) -> str:
    """A per-query streaming checkpoint location under the shared folder."""
    return "/".join((ensure_checkpoint_dir(spark).rstrip("/"), "streams", name))
