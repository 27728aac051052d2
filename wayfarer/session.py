"""Session construction for tests / benchmarks and a shared scratch folder for materialised data."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int | None = None, app: str = "wayfarer",
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A local session for tests and benchmarks. Jobs themselves never build sessions."""
    parts = shuffle_partitions or (8 if cpus == "*" else int(cpus))
    b = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.host", "127.0.0.1")
         .config("spark.driver.bindAddress", "127.0.0.1")
         .config("spark.driver.memory", "16g")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.shuffle.partitions", str(parts))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scale_conf(shuffle_bytes: int, target_partition_bytes: int = 256 << 20, cores: int = 8) -> dict[str, str]:
    """Session settings for a run whose largest shuffle is about ``shuffle_bytes``.

    Start with enough shuffle partitions for ~``target_partition_bytes`` each (never fewer
    than the cores), and let AQE coalesce small ones and split skewed ones at run time.
    """
    parts = max(cores, -(-shuffle_bytes // target_partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.files.maxPartitionBytes": str(min(target_partition_bytes, 512 << 20)),
    }


BYTES_PER_PARTITION = 8 << 20  # of stored input, for each shuffle partition of a sized session
READ_BYTES, SHUFFLED_BYTES = 16 << 20, 8 << 20  # the most that a task of it reads of a file, or is given of a shuffle


def sized_session(spark: SparkSession, input_bytes: int) -> SparkSession:
    """A session beside ``spark`` (its context, catalog and settings) for jobs over ``input_bytes`` of stored tables.

    It has a shuffle partition for each ``BYTES_PER_PARTITION`` of input, and at least those of ``spark``; AQE
    merges them up to ``SHUFFLED_BYTES``. So a larger input makes more tasks, not larger ones: what a task sorts
    and aggregates in memory stays the same. The settings of ``spark`` itself are left alone."""
    sized = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if sized.conf.isModifiable(key) and sized.conf.get(key, None) != value:
            sized.conf.set(key, value)
    wanted = -(-input_bytes // BYTES_PER_PARTITION)
    for key in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.initialPartitionNum"):
        now = sized.conf.get(key, None)
        if now and int(now) < wanted:
            sized.conf.set(key, str(wanted))
    for key, most in (("spark.sql.files.maxPartitionBytes", READ_BYTES), ("spark.sql.adaptive.advisoryPartitionSizeInBytes", SHUFFLED_BYTES)):
        if _bytes(sized.conf.get(key)) > most:
            sized.conf.set(key, str(most))
    return sized


def _bytes(text: str) -> int:
    """The bytes of a size setting, such as ``64MB``, ``8m`` or ``134217728b``."""
    number, unit = re.fullmatch(r"(\d+)([kmgtp]?)b?", text.strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set (HDFS / object store): executors would each write to their own
    disk otherwise, so an unset folder raises unless the master is local. Only then, as in tests, a
    local temporary folder is created and registered as the checkpoint dir.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext  # not available over Spark Connect
    except Exception:  # noqa: BLE001
        sc = None
    if not configured and sc is not None:
        configured = sc.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    master = sc.master if sc is not None else spark.conf.get("spark.master", "")
    if not (master == "local" or master.startswith("local[")):
        raise ValueError(f"spark.checkpoint.dir is not set and the master is {master!r}: name a folder all executors share")
    local = tempfile.mkdtemp(prefix="wayfarer-ckpt-")
    if sc is not None:
        sc.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-path of the shared folder for one materialisation."""
    return f"{shared_dir(spark)}/wayfarer/{name}-{uuid.uuid4().hex[:12]}"
