"""Spark session with the settings the operators assume."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.python.filterPushdown.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}
#: For public buckets that are read without credentials: ``session(settings=ANONYMOUS)``.
ANONYMOUS = {"spark.hadoop.fs.s3a.aws.credentials.provider": "org.apache.hadoop.fs.s3a.AnonymousAWSCredentialsProvider"}


def session(master: str | None = None, settings: dict[str, str] | None = None) -> SparkSession:
    """A session; on a cluster leave ``master`` to spark-submit."""
    builder = SparkSession.builder.appName("nephogrid").config(map=SETTINGS | (settings or {}))
    return (builder.master(master) if master else builder).getOrCreate()
