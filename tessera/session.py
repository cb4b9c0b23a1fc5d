"""Session helpers: a test/bench session and shared scratch locations.

Scratch output (sink round trips, streaming checkpoints, state versions of
iterative jobs) lives under the folder the cluster names in
``spark.checkpoint.dir``. A folder is only created here when that setting is
unset, which is the case in unit tests.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tessera") -> SparkSession:
    """A local session configured the way the tests and bench expect."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def checkpoint_root(spark: SparkSession) -> str:
    """Root of the shared checkpoint folder; set one only when unset."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        sc_dir = spark.sparkContext.getCheckpointDir()
        if sc_dir:
            return sc_dir
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors share (master {master})")
        root = tempfile.mkdtemp(prefix="tessera-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
        spark.sparkContext.setCheckpointDir(root)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/tessera/{name}-{uuid.uuid4().hex}"


def unique_name(prefix: str) -> str:
    """A unique catalog identifier (tables, views, streaming queries)."""
    return f"{prefix}_{uuid.uuid4().hex[:12]}"


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tessera`` importable on executors (once per SparkContext).

    Python functions handed to ``mapInPandas`` / ``applyInPandas*`` /
    ``foreachPartition`` are pickled by reference to their module, so the
    package is zipped into the shared checkpoint folder and added with
    ``addPyFile``, the way a cluster job ships its code.
    """
    import io
    import os
    import zipfile

    sc = spark.sparkContext
    key = f"{sc.applicationId}/{sc.startTime}"
    if key in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
        for dirpath, _dirs, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    zf.write(full, os.path.relpath(full, root))
    target_dir = scratch_path(spark, "pyfiles")
    if "://" in target_dir and not target_dir.startswith("file:"):
        # remote filesystem: write through the JVM's Hadoop client
        jvm = sc._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{target_dir}/tessera.zip")
        fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
        out = fs.create(path, True)
        out.write(bytearray(buf.getvalue()))
        out.close()
        target = f"{target_dir}/tessera.zip"
    else:
        local_dir = target_dir[len("file:"):] if target_dir.startswith("file:") else target_dir
        os.makedirs(local_dir, exist_ok=True)
        target = os.path.join(local_dir, "tessera.zip")
        with open(target, "wb") as fh:
            fh.write(buf.getvalue())
    sc.addPyFile(target)
    _SHIPPED.add(key)
