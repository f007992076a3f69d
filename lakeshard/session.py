"""Session construction and the shared scratch location.

Intermediate tables (staged compactions, copies of test tables, lineage
cuts) go below the folder the cluster names in ``spark.checkpoint.dir``.
That setting is read from the session; only when it is unset (local runs
and tests) do we create one.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # remove checkpoint files once their DataFrame is garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "lakeshard", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings this library relies on."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(_DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``lakeshard`` importable in the Python workers (once per application).

    Functions run by ``mapInPandas`` and pandas UDFs refer to this package;
    the workers only see the driver's ``sys.path`` when they happen to start
    in the same folder.  The package is zipped and added with ``addPyFile``,
    which ships it to every executor.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    import shutil

    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out = tempfile.mkdtemp(prefix="lakeshard-pkg-")
    archive = shutil.make_archive(os.path.join(out, "lakeshard"), "zip",
                                  root_dir=os.path.dirname(pkg_dir), base_dir="lakeshard")
    sc.addPyFile(archive)
    _SHIPPED.add(app)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, creating a local one only if unset."""
    sc = spark.sparkContext
    cur = sc.getCheckpointDir()
    if cur:
        return cur
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the whole cluster shares")
        conf_dir = tempfile.mkdtemp(prefix="lakeshard-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def _strip_scheme(path: str) -> str:
    return path[len("file:"):] if path.startswith("file:") else path


def scratch_dir(spark: SparkSession, name: str = "work") -> str:
    """A fresh, unique folder below the shared checkpoint location."""
    root = ensure_checkpoint_dir(spark)
    path = f"{root.rstrip('/')}/lakeshard/{name}-{uuid.uuid4().hex[:12]}"
    local = _strip_scheme(path)
    if "://" not in local:
        os.makedirs(local, exist_ok=True)
    return path


def scale_conf(input_bytes: int, total_cores: int,
               partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings sized for an input of ``input_bytes`` on ``total_cores`` cores.

    Shuffle partitions: enough that each holds about ``partition_bytes``
    (at least two waves of tasks), so sorts and hash aggregates fit in
    executor memory.  AQE then merges the ones that turn out small, and splits
    skewed join partitions above five times the median.
    """
    import math

    parts = max(2 * total_cores, math.ceil(input_bytes / partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(min(partition_bytes, 1 << 30)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
    }
