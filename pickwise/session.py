"""SparkSession helpers.

``get_session`` is for tests, the bench and local runs. On a cluster the
session comes from the platform; the library only reads settings from it.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings the operators are designed around: AQE re-plans joins from
# measured sizes (broadcast only below the threshold, skew splitting above).
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # coalesce shuffle partitions to the advisory size, not to the core count
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.session.timeZone": "UTC",
}


def get_session(master: str = "local[8]", shuffle_partitions: int = 8,
                app_name: str = "pickwise", extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(master).appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
    )
    for k, v in {**RECOMMENDED_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Only when the session has none and runs in local mode (tests) a scratch
    folder is set; on a cluster a missing setting is an error.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server owns the checkpoint folder
        return spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getConf().get("spark.checkpoint.dir", None)
    if current:
        sc.setCheckpointDir(current)
        return current
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return sc._jsc.sc().getCheckpointDir().get()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder: lineage cuts must survive "
                           "executor loss and a machine-local folder does not")
    local = tempfile.mkdtemp(prefix="pickwise-ckpt-")
    sc.setCheckpointDir(local)
    return local


def scratch_dir(spark: SparkSession, prefix: str = "run-") -> str:
    """A fresh folder for written intermediate tables, inside the shared
    checkpoint folder (a new one per call)."""
    import uuid

    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{prefix}{uuid.uuid4().hex[:12]}"


def session_key(spark: SparkSession) -> str:
    """Identifies the running application (for per-session caches)."""
    return spark.conf.get("spark.app.id", None) or str(id(spark))
