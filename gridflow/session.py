"""Session construction and cluster-shared locations."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

# Settings every gridflow job relies on: UTC clock (the driver tables hold
# timestamp_ntz values and all times are handled as epoch milliseconds), ANSI
# mode stays on (Spark 4 default) so code uses try_cast where input may be junk,
# and AQE re-plans joins / coalesces partitions from runtime statistics.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``gridflow`` importable in the Python workers (the pandas-UDF and
    keyed-state functions live in it): zip the package once per process and add
    it to the session (``addPyFile``; ``addArtifacts`` under Spark Connect)."""
    try:
        app = spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001  (Spark Connect)
        app = "connect:" + str(id(spark))
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="gridflow-pkg-"), "gridflow.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _dirs, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    try:
        spark.sparkContext.addPyFile(path)
    except Exception:  # noqa: BLE001
        spark.addArtifacts(path, pyfile=True)
    _SHIPPED.add(app)


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "gridflow", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the gridflow defaults.

    On a cluster leave ``master`` unset so spark-submit decides; tests pass
    ``local[*]``.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    try:
        spark.sparkContext.setLogLevel("ERROR")
    except Exception:  # noqa: BLE001
        pass
    ship_package(spark)
    return spark


def checkpoint_dir(spark: SparkSession, sub: str | None = None) -> str:
    """Shared folder for checkpoints and materialised intermediates.

    Read from ``spark.checkpoint.dir`` (set by the cluster to shared storage).
    Only when it is unset in local mode -- tests -- a fresh scratch folder is created
    and recorded in the session so later calls agree; elsewhere it must be set.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="gridflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", base)
    try:  # classic sessions: also the folder for DataFrame.checkpoint(); absent under Spark Connect
        spark.sparkContext.setCheckpointDir(base)
    except Exception:  # noqa: BLE001
        pass
    if sub:
        return os.path.join(base, sub)
    return base
