"""Session with the settings the pipeline relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Wall-clock times are stored without a zone, money is exact and never wraps
# round silently, and the physical plan is sized at run time.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Filters and joins are sized by the statistics of published tables.
    "spark.sql.cbo.enabled": "true",
    "spark.sql.cbo.joinReorder.enabled": "true",
    # The JVM does not compile methods beyond 8000 bytes of code. Parsing twenty columns in one
    # generated method would run interpreted; beyond the limit Spark generates smaller ones.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


_MIB = 1 << 20


def sized_for(input_bytes: int) -> dict[str, str]:
    """Settings for jobs over this much input.

    Adaptive execution merges tasks that turn out small, so their number may be generous; it cannot
    add tasks where there are too few. A scan task reads as much as a shuffle task, up to a
    gibibyte: every scan task writes a block for every shuffle task, and the blocks must not get tiny.
    """
    task = min(max(128 * _MIB, input_bytes // 100_000), 1024 * _MIB)
    return {
        "spark.sql.shuffle.partitions": str(max(200, input_bytes // task)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * _MIB),
        "spark.sql.files.maxPartitionBytes": str(task),
    }


def size_to_input(spark: SparkSession, input_bytes: int) -> None:
    """Apply ``sized_for`` to so much input, unless the session's task count was set by hand."""
    if spark.sparkContext.getConf().contains("spark.sql.shuffle.partitions"):
        return
    for key, value in sized_for(input_bytes).items():
        spark.conf.set(key, value)


def build_session(
    app_name: str = "tripmill",
    master: str | None = None,
    conf: dict[str, str] | None = None,
    durable: bool = False,
) -> SparkSession:
    """Session with ``DEFAULTS``; ``conf`` overrides them (see ``sized_for``).

    ``durable`` asks for a catalog that outlasts the process, and fails where there is none.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if durable:
        builder = builder.enableHiveSupport()
    for key, value in {**DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    catalog = spark.conf.get("spark.sql.catalogImplementation", "in-memory")
    if durable and catalog == "in-memory" and spark.conf.get("spark.sql.defaultCatalog") == "spark_catalog":
        raise RuntimeError(
            "the session's catalog is in memory: tables would be lost with the process; "
            "start the session with Hive support or another default catalog"
        )
    return spark
