"""Stored tables by path, name or connector, and the catalog statements."""

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, name=None, path=None, format="parquet", **options) -> DataFrame:
    """A catalog table, or files / a connector by format name and options."""
    if name:
        return spark.table(name)
    reader = spark.read.format(format).options(**options)
    return reader.load(path) if path else reader.load()


def show_catalogs(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW CATALOGS")


def use_schema(spark: SparkSession, name: str) -> None:
    spark.sql(f"USE {name}")


def show_tables(spark: SparkSession, schema=None) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {schema}" if schema else "SHOW TABLES")


def describe_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"DESCRIBE TABLE {name}").select("col_name", "data_type")
