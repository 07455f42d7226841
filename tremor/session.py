"""Session helpers: the settings every job relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the catalogue semantics depend on (time zone for year extraction,
# ANSI casts so that bad input must go through try_cast) plus AQE for runtime
# re-planning: partition coalescing and skew-join splitting.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Python call-site capture on every Column call makes building a plan cost
    # about 4x more py4j time; error messages lose the Python line, nothing else.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(master: str | None = None, app: str = "tremor", conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_conf(spark)
    return spark


def apply_conf(spark: SparkSession) -> None:
    """Pin the settings results depend on in an existing session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.ansi.enabled", "true")


_LOCAL_SHARED: dict[str, str] = {}


def jvm_context(spark: SparkSession):
    """The SparkContext of a classic session, or None (e.g. a Spark Connect client)."""
    try:
        return spark.sparkContext
    except Exception:
        return None


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only when it is unset and the master is local (tests) is a scratch folder
    used instead; on a cluster an unset value is an error, never a local path.
    """
    sc = jvm_context(spark)
    configured = sc.getConf().get("spark.checkpoint.dir", None) if sc is not None else None
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:
            configured = None
    if configured:
        return configured.rstrip("/")
    if sc is None:
        raise RuntimeError("spark.checkpoint.dir is not set on the server")
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: tremor checkpoints and stores derived tables there, "
            "so it must name a folder every executor can reach"
        )
    key = sc.applicationId
    if key not in _LOCAL_SHARED:
        _LOCAL_SHARED[key] = tempfile.mkdtemp(prefix="tremor-shared-", dir=os.environ.get("TMPDIR", "/tmp"))
    return _LOCAL_SHARED[key]


def checkpoint_dir(spark: SparkSession) -> str:
    """Make ``DataFrame.checkpoint`` write under the shared folder; return the folder in use."""
    sc = jvm_context(spark)
    if sc is None:
        # A remote client: the server's own spark.checkpoint.dir is used.
        return shared_dir(spark)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(f"{shared_dir(spark)}/checkpoints")
    return sc.getCheckpointDir()
