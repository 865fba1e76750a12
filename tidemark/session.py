"""Session construction and shared-folder resolution.

All jobs take a ``SparkSession`` from the caller.  ``get_session`` is the
convenience used by tests, the bench and the command line: it pins the
session zone to UTC (event-time arithmetic must not follow the host zone),
turns on adaptive execution (runtime broadcast conversion, partition
coalescing, skew-join splitting) and keeps the web UI off.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on.  Partition counts are not fixed here: on a
# cluster they come from the submit configuration; AQE coalesces small ones.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tidemark", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in conf.items():
        if not k.startswith("spark.ui") and "stateStore.providerClass" not in k:
            try:
                spark.conf.set(k, v)
            except Exception:  # static conf on an existing session
                pass
    spark.sparkContext.setLogLevel("WARN")
    ensure_checkpoint_dir(spark)
    return spark


_LOCAL_FALLBACK: dict[str, str] = {}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the submitter and points at shared storage.
    Only when it is unset (local tests) a fresh scratch folder is created and
    registered as the context's checkpoint folder (the setting itself is
    static and cannot be changed on a running session).
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path
    try:
        sc = spark.sparkContext
    except Exception:      # no context in this client (Spark Connect): scratch folder only
        return _LOCAL_FALLBACK.setdefault("dir", tempfile.mkdtemp(prefix="tidemark-ckpt-"))
    current = sc.getCheckpointDir()
    if current:
        return current
    path = tempfile.mkdtemp(prefix="tidemark-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path below the shared checkpoint folder (state, snapshots, lineage cuts)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, *parts])


def configured_path(spark: SparkSession, *parts: str) -> str:
    """A path below the folder that ``spark.checkpoint.dir`` names.  Jobs keep
    their progress there; without the setting a restarted job would begin anew
    in another folder, so it is refused."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise ValueError("set spark.checkpoint.dir to a shared folder, or give the job a "
                         "state_root: its progress must survive a restart")
    return "/".join([base.rstrip("/"), *parts])


STATE_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def require_state_provider(spark: SparkSession) -> None:
    """The keyed processors need the RocksDB state store, which only takes
    effect where the session has it."""
    if "RocksDB" not in (spark.conf.get(STATE_PROVIDER, None) or ""):
        raise ValueError(f"set {STATE_PROVIDER}={BASE_CONF[STATE_PROVIDER]}")


ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def let_workers_import(spark: SparkSession) -> None:
    """Let Python workers that share this machine's folders import the package
    wherever the job was started from.  On a cluster the package is installed, or
    sent along with ``--py-files``."""
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, *paths]))


def default_local_session() -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    return get_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus))
