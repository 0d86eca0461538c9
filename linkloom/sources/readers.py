"""Text sources (tab-separated, all strings), truth tables, and checks of stored tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Cells that count as missing in a text source.
NA_CELLS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def read_text_table(spark: SparkSession, path: str) -> DataFrame:
    """Every column a string, quotes and line breaks in cells kept, blanks not trimmed, missing cells null."""
    reader = spark.read.options(
        sep="\t", header=True, quote='"', escape='"', multiLine=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, inferSchema=False, emptyValue="",
    )
    df = reader.csv(path)
    return df.select([F.when(~F.col(f"`{c}`").isin(NA_CELLS), F.col(f"`{c}`")).alias(c) for c in df.columns])


def load_source(spark: SparkSession, path: str) -> DataFrame:
    """A source table: missing cells are empty strings."""
    return read_text_table(spark, path).na.fill("")


def load_truth(spark: SparkSession, path: str) -> DataFrame:
    return load_source(spark, path)


def erase_na(df: DataFrame) -> DataFrame:
    """Missing-value spellings of all string columns as empty strings."""
    kinds = dict(df.dtypes)
    return df.withColumns({c: F.when(F.col(c).isNull() | F.col(c).isin(NA_CELLS), "").otherwise(F.col(c)) for c in df.columns if kinds[c] == "string"})


def is_valid_table(spark: SparkSession, path: str, columns: set[str], rows: int | None = None) -> bool:
    """Whether a finished Parquet table with these columns (and so many rows) is at ``path``; reads footers only."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(spark._jvm.org.apache.hadoop.fs.Path(at, "_SUCCESS")):
        return False
    try:
        df = spark.read.parquet(path)
    except AnalysisException:
        return False
    return columns <= set(df.columns) and (rows is None or df.count() == rows)
