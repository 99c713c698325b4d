"""Session construction and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every clickguard session wants; cluster defaults win for the rest.
BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "clickguard", **extra: str) -> SparkSession:
    """A local[N] session for tests and the bench (one JVM, UI off)."""
    b = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
         .config("spark.driver.bindAddress", "127.0.0.1")
         .config("spark.driver.host", "127.0.0.1")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "8g"))
    for k, v in {**BASE_CONF, **extra}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Reason texts and window bounds are rendered in the session zone;
    the registered queries pin it to UTC so results do not depend on the
    machine's zone."""
    # no fallback argument: Spark validates a given default as a zone id
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@contextmanager
def session_conf(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """`settings` in force inside the block, the session's own ones after it. A
    streaming query keeps those it was started with."""
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


#: Pane rings keep a value, a timer and its index per ip, which only this store can.
ROCKSDB_STATE = {k: v for k, v in BASE_CONF.items() if k.startswith("spark.sql.streaming.stateStore.")}

_FALLBACK: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, as named by ``spark.checkpoint.dir``.

    Only when the setting is absent on a local master (tests) is a folder of
    our own created and registered as the checkpoint dir; executors on other
    machines would not see one, so elsewhere its absence is an error.
    """
    base = None
    try:
        base = spark.conf.get("spark.checkpoint.dir", None)
    except Exception:  # noqa: BLE001 - static conf not exposed on some builds
        base = None
    sc = None
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - no SparkContext on a Connect session
        sc = None
    if not base and sc is not None:
        base = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if sc is None or not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        key = sc.applicationId
        if key not in _FALLBACK:
            _FALLBACK[key] = tempfile.mkdtemp(prefix="clickguard-")
            sc.setCheckpointDir(_FALLBACK[key])
        base = _FALLBACK[key]
    return base.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A path below the shared folder: ``<dir>/clickguard/<parts>/<uuid>``."""
    p = "/".join([shared_dir(spark), "clickguard", *parts])
    if unique:
        p = f"{p}/{uuid.uuid4().hex}"
    return p


def is_local_path(path: str) -> bool:
    return path.startswith("/") or path.startswith("file:")


def local_fs_path(path: str) -> str:
    return path[len("file:"):] if path.startswith("file:") else path


def apply_base_conf(spark: SparkSession) -> None:
    """The engine's session settings where the user set none: a job started
    from the command line renders times and keeps state as the tests do."""
    for k, v in BASE_CONF.items():
        if k.startswith("spark.sql.") and not spark.sparkContext.getConf().contains(k):
            spark.conf.set(k, v)


def shuffle_partitions_for(shuffle_bytes: int, cores: int = 8,
                           target_bytes: int = 256 << 20) -> int:
    """Initial `spark.sql.shuffle.partitions` for a windowed aggregate.

    `shuffle_bytes` is what the exchange carries after map-side combine:
    take it from a sample run's shuffle-write metric (it grows with the
    number of distinct (ip, window) keys per map task, not with the raw
    events), or for a stream from the per-trigger cap. Partitions of about
    `target_bytes` keep every reducer's hash map in memory; AQE coalesces
    small ones in batch. At least two per core, so one slow task does not
    idle the rest. For a stream this is also the state partition count,
    fixed when its checkpoint is first created.
    """
    n = -(-max(1, shuffle_bytes) // target_bytes)
    return int(max(2 * cores, n))
