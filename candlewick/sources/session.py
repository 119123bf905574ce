"""Sessions: object stores, shuffles and adaptive execution, all by configuration."""

from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class ObjectStore:
    """An S3-compatible store. Keys may be left out where the cluster provides credentials. ``path_style`` puts the bucket in the path; ``tls`` off uses plain HTTP."""

    endpoint: str
    access_key: str | None = None
    secret_key: str | None = None
    path_style: bool = True
    tls: bool = False
    region: str | None = None

    def settings(self) -> dict[str, str]:
        """``fs.s3a`` settings, all under ``spark.hadoop``; the committer is one that doesn't rename."""
        a = "spark.hadoop.fs.s3a."
        out = {
            f"{a}endpoint": self.endpoint, f"{a}path.style.access": str(self.path_style).lower(), f"{a}connection.ssl.enabled": str(self.tls).lower(),
            f"{a}committer.name": "magic", f"{a}committer.magic.enabled": "true",
        }
        for key, value in (("access.key", self.access_key), ("secret.key", self.secret_key), ("endpoint.region", self.region)):
            if value is not None:
                out[f"{a}{key}"] = value
        return out


def settings(store: ObjectStore | None = None, extra: dict[str, str] | None = None) -> dict[str, str]:
    """What the operators rely on: UTC, adaptive execution with skew handling, Arrow; then the store's, then ``extra``, which wins."""
    base = {
        "spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true", "spark.sql.sources.partitionOverwriteMode": "dynamic", "spark.sql.parquet.filterPushdown": "true", "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    return {**base, **(store.settings() if store else {}), **(extra or {})}


def session(name: str = "candlewick", master: str | None = None, store: ObjectStore | None = None, extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in settings(store, extra).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def effective(spark: SparkSession) -> dict[str, str]:
    """The session's settings, secrets hidden."""
    got = dict(spark.sparkContext.getConf().getAll())
    return {k: "***" if any(x in k.lower() for x in ("secret", "password", "access.key", "token")) else v for k, v in sorted(got.items())}
