"""Session for local work; on a cluster, pass the session you are given."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# The virtual machine compiles no method above 8000 bytes of code, and interprets it instead. A step of many columns that Spark puts into
# one method is then several times as slow as the same step without whole-stage code.
COMPILED_BYTES = "8000"


# Folders that a task writes to at the same time; rows of more than these are sorted by folder first.
FOLDERS_AT_ONCE = "16"


@contextmanager
def _settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """Settings of the session, restored at the end."""
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def wide_steps(spark: SparkSession):
    """For writing tables of many columns: whole-stage code only where the virtual machine compiles it, and no sort of wide rows to write them to a few folders."""
    return _settings(spark, {"spark.sql.codegen.hugeMethodLimit": COMPILED_BYTES, "spark.sql.maxConcurrentOutputFileWriters": FOLDERS_AT_ONCE})


def hashed_joins(spark: SparkSession):
    """For lookups of many rows by text: shuffled joins build a hash table of the smaller side instead of sorting both by their keys.

    Only where adaptive execution has measured that no part of that side is larger than it makes the parts of a shuffle; all others are still sorted.
    """
    return _settings(spark, {"spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")})


def local_session(cpus: int = 8, app: str = "retailmart", memory: str = "8g") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        # Many small reports per session: keep more than the default 100 compiled stages.
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
