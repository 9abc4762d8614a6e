"""Tables and views by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

FEATURE_VIEW = "court_cases"
SAMPLE_COLUMNS = (
    "race", "gender", "attorneyType", "dispositionText", "netSentenceDays", "totalFinancial",
)


def register(df: DataFrame, name: str, persist: bool = False) -> DataFrame:
    """Create or replace a view, or a stored table when ``persist`` is set."""
    if persist:
        df.write.mode("overwrite").option("compression", "zstd").saveAsTable(name)
    else:
        df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def list_tables(spark: SparkSession) -> DataFrame:
    """Name and kind of every table and view that is visible."""
    return spark.sql("SHOW TABLES").select(F.col("tableName").alias("name"), F.col("isTemporary").alias("temporary"))


def describe(spark: SparkSession, name: str) -> DataFrame:
    """Columns and types of a table."""
    return spark.sql(f"DESCRIBE TABLE `{name}`").select(F.col("col_name").alias("column_name"), F.col("data_type").alias("column_type"))


def preview(spark: SparkSession, name: str, n: int = 100) -> DataFrame:
    """As many rows of a table as asked for."""
    return spark.table(name).limit(n)


def run_sql(spark: SparkSession, text: str) -> tuple[DataFrame, int]:
    """Result of a statement and its row count."""
    result = spark.sql(text)
    return result, result.count()


def sample_features(df: DataFrame, n: int = 10000) -> DataFrame:
    """Notebook-sized sample of the feature columns that are present: the first rows in their order."""
    columns = [c for c in SAMPLE_COLUMNS if c in df.columns]
    return df.select(*columns).orderBy(*columns).limit(n)
