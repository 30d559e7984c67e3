"""Writing tables and the CSV deliverables."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from renalis.operators.collect import COLLECTIONS
from renalis.session import delete_folder

RAW_EXPORTS = [
    "AKI_ONSETS", "CONSORT_DIAGRAM_BC", "CONSORT_DIAGRAM_AD", "AKI_DEMO_DEATH", "AKI_DEMO",
    *[name for name, spec in COLLECTIONS.items() if spec.exported],
]
DEID_EXPORTS = [n if n.startswith("CONSORT") else f"DEID_{n}" for n in RAW_EXPORTS]


def save_table(df: DataFrame, name: str, database: str) -> DataFrame:
    """Replace a catalog table and read it back."""
    spark: SparkSession = df.sparkSession
    df.write.mode("overwrite").saveAsTable(f"{database}.{name}")
    return spark.table(f"{database}.{name}")


def as_text(df: DataFrame) -> DataFrame:
    """All columns as the text that the files hold: dates as yyyy-MM-dd, times to the second."""
    columns = []
    for f in df.schema.fields:
        value = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            value = F.date_format(value, "yyyy-MM-dd HH:mm:ss")
        columns.append(value.cast("string").alias(f.name))
    return df.select(*columns)


def checksum(columns: list[str]) -> Column:
    """An aggregate over text columns that depends neither on the order of rows nor of columns.

    Each value is its length in characters, a colon and the text; the values of a row follow each
    other by column name. Nulls count as empty, as CSV readers do not tell them apart. The sum of the
    first 15 hex digits of the rows' MD5, as numbers, can be told again by any tool. Equal rows count
    as often as they occur.
    """
    values = []
    for name in sorted(columns):
        value = F.coalesce(F.col(f"`{name}`"), F.lit(""))
        values.append(F.concat(F.length(value).cast("string"), F.lit(":"), value))
    number = F.conv(F.substring(F.md5(F.concat(*values)), 1, 15), 16, 10)
    total = F.sum(number.cast("decimal(28,0)"))
    return F.coalesce(total, F.lit(0).cast("decimal(38,0)")).cast("string")


@dataclass(frozen=True)
class Export:
    rows: int
    checksum: str


def write_csv(df: DataFrame, path: str) -> Export:
    """UTF-8 CSV with a header in each part file; dates as yyyy-MM-dd, times to the second.

    Rows and checksum are observed while the files are written. Blanks around values stay.
    """
    seen = Observation()
    text = as_text(df)
    (
        text.observe(
            seen, F.count(F.lit(1)).alias("rows"), checksum(text.columns).alias("checksum")
        )
        .write.mode("overwrite")
        .option("header", True)
        .option("encoding", "UTF-8")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return Export(seen.get["rows"], seen.get["checksum"])


def export_csv(df: DataFrame, path: str) -> int:
    """write_csv(); returns the number of rows."""
    return write_csv(df, path).rows


MANIFEST = "_MANIFEST"
_MANIFEST_SCHEMA = "TABLE string, N_ROWS long, CHECKSUM string, COLUMNS array<string>"


def export_all(tables: dict[str, DataFrame], folder: str, names: list[str]) -> list[str]:
    """Export the listed tables that are present and not empty; returns the names written.

    Each table is computed once. The folder of one that turns out empty is removed again. A manifest
    beside the tables says what was written; verify_export() compares.
    """
    entries, spark = [], None
    for name in names:
        table = tables.get(name)
        if table is None:
            continue
        spark = table.sparkSession
        done = write_csv(table, f"{folder}/{name}")
        if done.rows:
            entries.append((name, done.rows, done.checksum, table.columns))
        else:
            delete_folder(spark, f"{folder}/{name}")
    if spark is not None:
        listed = spark.createDataFrame(entries, _MANIFEST_SCHEMA).coalesce(1)
        listed.write.mode("overwrite").json(f"{folder}/{MANIFEST}")
    return [e[0] for e in entries]


def _found(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """One row: number of rows and checksum of the files, nulls where they are not the table."""
    nothing = "cast(null as long) as FOUND_ROWS", "cast(null as string) as FOUND_CHECKSUM"
    try:
        # Values may hold line breaks.
        text = spark.read.option("header", True).option("multiLine", True).csv(path)
    except AnalysisException:
        return spark.range(1).selectExpr(*nothing)
    if text.columns != columns:
        return spark.range(1).selectExpr(*nothing)
    return text.agg(
        F.count(F.lit(1)).alias("FOUND_ROWS"), checksum(columns).alias("FOUND_CHECKSUM")
    )


def verify_export(spark: SparkSession, folder: str) -> DataFrame:
    """The manifest's tables with the rows and checksums that their files have now, and INTACT."""
    listed = spark.read.schema(_MANIFEST_SCHEMA).json(f"{folder}/{MANIFEST}")
    empty = spark.createDataFrame(
        [], "TABLE string, N_ROWS long, CHECKSUM string, FOUND_ROWS long, FOUND_CHECKSUM string"
    )
    frames = [empty]
    for row in listed.collect():  # at most one row for each kind of table
        own = [F.lit(row.TABLE).alias("TABLE"), F.lit(row.N_ROWS).cast("long").alias("N_ROWS")]
        found = _found(spark, f"{folder}/{row.TABLE}", row.COLUMNS)
        frames.append(
            found.select(*own, F.lit(row.CHECKSUM).alias("CHECKSUM"), "FOUND_ROWS", "FOUND_CHECKSUM")
        )
    same = F.col("N_ROWS").eqNullSafe(F.col("FOUND_ROWS")) & F.col("CHECKSUM").eqNullSafe(
        F.col("FOUND_CHECKSUM")
    )
    return reduce(DataFrame.unionByName, frames).withColumn("INTACT", same)
