"""Session settings. Where a job runs and how wide it is stay with the caller."""

from __future__ import annotations

import tempfile
from collections.abc import Iterable, Mapping

import pyspark
from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def kafka_package(spark_version: str = pyspark.__version__, scala: str = "2.13") -> str:
    """Maven coordinate of Spark's own Kafka connector for this Spark."""
    return f"org.apache.spark:spark-sql-kafka-0-10_{scala}:{spark_version}"


def object_store_settings(
    endpoint: str,
    access_key: str | None = None,
    secret_key: str | None = None,
    *,
    region: str = "us-east-1",
    path_style: bool = True,
    timeout_ms: int = 5000,
) -> dict[str, str]:
    """S3A settings for dimension tables on an object store.

    Without keys the credentials provider chain of the cluster stays in charge.
    """
    s3a = {
        "endpoint": endpoint,
        "endpoint.region": region,
        "path.style.access": str(path_style).lower(),
        "connection.ssl.enabled": str(not endpoint.startswith("http://")).lower(),
        "connection.establish.timeout": str(timeout_ms),
        "connection.timeout": str(timeout_ms),
        "socket.timeout": str(timeout_ms),
    }
    if access_key and secret_key:
        s3a["access.key"] = access_key
        s3a["secret.key"] = secret_key
        s3a["aws.credentials.provider"] = (
            "org.apache.hadoop.fs.s3a.SimpleAWSCredentialsProvider"
        )
    return {f"spark.hadoop.fs.s3a.{k}": v for k, v in s3a.items()}


def state_store_settings() -> dict[str, str]:
    """State on local disk with changelog checkpoints: for windows that outgrow the heap."""
    return {
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }


def session(
    app_name: str,
    *,
    packages: Iterable[str] = (),
    settings: Mapping[str, str] | None = None,
    log_level: str = "WARN",
) -> SparkSession:
    """A session in UTC with adaptive plans; no master and no fixed parallelism.

    Connector packages can only be added before the JVM starts, so asking a
    running session for one it lacks is an error and not a silent no-op.
    """
    wanted = list(packages)
    running = SparkSession.getActiveSession()
    if running is not None and wanted:
        loaded = running.conf.get("spark.jars.packages", "") or ""
        missing = [p for p in wanted if p not in loaded.split(",")]
        if missing:
            raise RuntimeError(f"session already runs without packages {missing}; stop it first")

    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **(settings or {}),
    }
    if wanted:
        conf["spark.jars.packages"] = ",".join(wanted)
    builder = SparkSession.builder.appName(app_name)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel(log_level)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir`` or what the context was given.

    Only a local session may fall back to a folder of its own.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set on this cluster")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="motorpulse-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")
