"""Session construction and shared-folder helpers.

Library code never builds its own session: every operator takes DataFrames,
every registered query takes the caller's ``SparkSession``.  ``build_session``
is for tests, the bench and local runs only.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "riverbed") -> SparkSession:
    """Local session with the settings the library is tested under.

    On a cluster the deployment owns these settings; the values that matter
    for correctness (UTC session zone) are repeated here so local runs agree
    with DuckDB.
    """
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    Read from the session; a private folder is created only when the setting
    is absent and the master is local (tests, the bench).  On a cluster with
    no shared folder configured we refuse instead of writing to a
    machine-local path that executors cannot see.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        conf_dir = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        conf_dir = tempfile.mkdtemp(prefix="riverbed-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(conf_dir)
    return conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused path under the shared folder."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``riverbed`` importable by Python workers (functions given to
    ``mapInArrow``, pandas UDFs and stateful processors are pickled by
    reference).  Once per application the driver zips the package in a folder
    of its own and hands it to ``addPyFile``, which sends it to every executor,
    later ones too; no executor reads the driver's folder, and the shared
    folder may be in any store."""
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    import shutil
    pkg = os.path.dirname(os.path.abspath(__file__))
    base = os.path.join(tempfile.mkdtemp(prefix="riverbed-pkg-"), "riverbed-" + uuid.uuid4().hex[:8])
    sc.addPyFile(shutil.make_archive(base, "zip", os.path.dirname(pkg), os.path.basename(pkg)))
    _SHIPPED.add(app)


def materialize(df, name: str):
    """Write ``df`` once as parquet under the shared folder and read it back.

    Used where a plan would otherwise be computed twice (both sides of a join)
    or where an iteration's lineage must be cut.  Unlike ``checkpoint()`` on an
    uncached plan, the plan runs once; the files survive executor loss."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("error").parquet(path)
    return spark.read.parquet(path)

