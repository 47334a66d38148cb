"""Table, snapshot and report sinks."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F


def ensure_schema(spark: SparkSession, catalog: str, schema: str, location: str | None = None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{catalog}`.`{schema}`{place}")


def session_info(spark: SparkSession) -> DataFrame:
    return spark.sql("SELECT current_user() AS user, current_catalog() AS catalog, current_schema() AS schema")


def list_schemas(spark: SparkSession, catalog: str) -> DataFrame:
    return spark.sql(f"SHOW SCHEMAS IN `{catalog}`")


def list_tables(spark: SparkSession, schema: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {schema}").where(~F.col("isTemporary")).select("tableName")


def write_table(df: DataFrame, table: str, fmt: str = "parquet", bucket_by: tuple[int, str] | None = None) -> None:
    """Replace a table, its schema included.

    ``bucket_by=(n, column)`` lays files out so that later aggregates and joins on that column need no
    shuffle.  The new table is written beside the old one, read once, and then takes its name, so that a write that
    fails leaves the old table as it was.  Delta replaces a table by a commit of its own.
    """
    if fmt == "delta":
        _save(df.write.format(fmt).mode("overwrite").option("overwriteSchema", "true"), table, bucket_by)
        return
    spark, staged, retired = df.sparkSession, _beside(table, "__staged"), _beside(table, "__retired")
    if not spark.catalog.tableExists(table) and spark.catalog.tableExists(retired):
        _rename(spark, retired, table)  # a swap that was cut off
    spark.sql(f"DROP TABLE IF EXISTS {staged}")
    _save(df.write.format(fmt).mode("errorifexists"), staged, bucket_by)
    spark.table(staged).agg(F.count(F.lit(1))).collect()
    _swap(spark, table, staged, retired)


def _beside(table: str, suffix: str) -> str:
    return f"{table[:-1]}{suffix}`" if table.endswith("`") else f"{table}{suffix}"


def _rename(spark: SparkSession, table: str, name: str) -> None:
    """A new name is given without its catalog, which stays."""
    spark.sql(f"ALTER TABLE {table} RENAME TO {'.'.join(name.split('.')[-2:])}")


def _save(writer: DataFrameWriter, table: str, bucket_by: tuple[int, str] | None) -> None:
    if bucket_by:
        writer = writer.bucketBy(bucket_by[0], bucket_by[1]).sortBy(bucket_by[1])
    writer.saveAsTable(table)


def _swap(spark: SparkSession, table: str, staged: str, retired: str) -> None:
    """Give ``staged`` the name of ``table``; the old table keeps its rows until then and returns if that fails."""
    spark.sql(f"DROP TABLE IF EXISTS {retired}")
    replaced = spark.catalog.tableExists(table)
    if replaced:
        _rename(spark, table, retired)
    try:
        _rename(spark, staged, table)
    except Exception:
        if replaced:
            _rename(spark, retired, table)
        raise
    spark.sql(f"DROP TABLE IF EXISTS {retired}")


def write_tables(
    spark: SparkSession,
    frames: dict[str, DataFrame],
    fmt: str = "parquet",
    bucket_by: dict[str, tuple[int, str]] | None = None,
) -> DataFrame:
    """Write each frame, by the layout that ``bucket_by`` has for its table, and report the row counts of the tables.

    Counting the table reads file footers; counting the frame would run its plan a second time.
    """
    for table, df in frames.items():
        write_table(df, table, fmt, (bucket_by or {}).get(table))
    counts = [
        spark.table(table).agg(F.lit(table).alias("table_name"), F.count(F.lit(1)).alias("row_count"))
        for table in frames
    ]
    report = counts[0]
    for count in counts[1:]:
        report = report.unionByName(count)
    return report


def _is_complete(spark: SparkSession, path: str) -> bool:
    try:
        return not spark.read.schema("complete boolean").parquet(f"{path}/complete").isEmpty()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False


def create_snapshot_once(df: DataFrame, path: str) -> bool:
    """Write a Parquet snapshot unless there is a complete one already; says whether it did.

    A mark is written behind the rows.  Rows without it come from a write that was lost, and are written again.
    """
    spark = df.sparkSession
    if _is_complete(spark, path):
        return False
    df.write.mode("overwrite").parquet(f"{path}/rows")
    spark.range(1).selectExpr("true AS complete").coalesce(1).write.mode("overwrite").parquet(f"{path}/complete")
    return True


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    if not _is_complete(spark, path):
        raise ValueError(f"no complete snapshot at {path}")
    return spark.read.parquet(f"{path}/rows")


def write_report_csv(report: DataFrame, path: str) -> None:
    """One CSV file with a header.  Reports have a handful of rows, so one task writes them."""
    report.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_report_json(report: DataFrame, path: str) -> None:
    report.coalesce(1).write.mode("overwrite").json(path)
