"""Session defaults. A cluster's own settings win; these only fill what is unset."""

from __future__ import annotations

from pyspark.sql import SparkSession

# The JVM does not compile methods over 8000 bytes of bytecode. Stages that would need a longer one
# run faster as separate operators, so sessions built here let Spark fall back at that size. A session
# made elsewhere keeps its own settings.
_TUNING = {"spark.sql.codegen.hugeMethodLimit": "8000"}
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(app: str = "caseloom", master: str | None = None, **conf: str) -> SparkSession:
    """Create or reuse a session with adaptive execution on and a fixed time zone."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**_DEFAULTS, **_TUNING, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shuffle_width(spark: SparkSession) -> int:
    """The session's shuffle partition count, used to size ordered parts."""
    return max(2, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
