"""Reading the common-data-model tables of a site."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from renalis.sources.schemas import OPTIONAL_TABLES, REQUIRED_TABLES, SCHEMAS, conform

# What an analysis error says if a table is not there. Any other error is a damaged table.
_ABSENT = ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND", "SCHEMA_NOT_FOUND")
# The same from databases behind JDBC: SQLSTATE 42P01 and 42S02, and vendors' own texts.
_ABSENT_JDBC = ("42P01", "42S02", "ORA-00942", "Invalid object name")

_EXTENSIONS = {"parquet": ".parquet", "orc": ".orc", "csv": ".csv"}


def _read_file(spark: SparkSession, root: str, table: str, fmt: str) -> DataFrame:
    path = f"{root}/{table.lower()}{_EXTENSIONS[fmt]}"
    if fmt == "csv":
        # Exports may hold any subset of the columns, so the header decides and conform() types it.
        return spark.read.option("header", True).option("encoding", "UTF-8").csv(path)
    return spark.read.format(fmt).load(path)


# Number of a key's part, in the databases' own hash functions.
_PART_OF = {
    "oracle": "ORA_HASH({key}, {last})",
    "postgres": "MOD(ABS(CAST(HASHTEXT(CAST({key} AS TEXT)) AS BIGINT)), {parts})",
    "tsql": "ABS(CAST(CHECKSUM({key}) AS BIGINT)) % {parts}",
}


def split_predicates(vendor: str, parts: int, key: str = "PATID") -> list[str]:
    """Conditions of which each row meets exactly one, to read a table over so many connections.

    Keys may be text, as identifiers are: the database hashes them. Rows without a key are in the
    first part.
    """
    part = _PART_OF[vendor].format(key=key, parts=parts, last=parts - 1)
    rest = [f"{key} IS NOT NULL AND {part} = {i}" for i in range(1, parts)]
    return [f"{key} IS NULL OR {part} = 0", *rest]


def _read_jdbc(
    spark: SparkSession, url: str, schema: str, table: str, options: dict, predicates: list[str]
) -> DataFrame:
    name = f"{schema}.{table}" if schema else table
    if predicates:
        return spark.read.jdbc(url, name, predicates=predicates, properties=options)
    return spark.read.format("jdbc").options(url=url, dbtable=name, **options).load()


def is_absent(error: Exception) -> bool:
    """Whether reading failed because there is no such table."""
    if isinstance(error, AnalysisException):
        return (error.getCondition() or "").split(".")[0] in _ABSENT
    return any(mark in str(error) for mark in _ABSENT_JDBC)


def load_cdm(
    spark: SparkSession,
    source: str,
    fmt: str = "parquet",
    schema: str | None = None,
    options: dict | None = None,
    tables: list[str] | None = None,
    predicates: list[str] | None = None,
) -> dict[str, DataFrame]:
    """The site's tables by name.

    ``source`` is a directory of files (fmt parquet, orc or csv), a catalog database (fmt table) or
    a JDBC address (fmt jdbc, with ``schema`` and, for parallel reads, ``predicates`` such as those of
    split_predicates(), or the usual partitioning ``options``). The connections of a split read see
    the table at slightly different times: read from a copy that nobody writes to. Optional tables that a site does not have are left out; one that is there and
    cannot be read is an error.
    """
    found = {}
    for table in tables or [*REQUIRED_TABLES, *OPTIONAL_TABLES]:
        try:
            if fmt == "table":
                df = spark.table(f"{source}.{table}")
            elif fmt == "jdbc":
                df = _read_jdbc(spark, source, schema or "", table, options or {}, predicates or [])
            else:
                df = _read_file(spark, source, table, fmt)
        except (AnalysisException, Py4JJavaError) as error:
            if table in OPTIONAL_TABLES and is_absent(error):
                continue
            raise
        found[table] = conform(df, table) if table in SCHEMAS else df
    return found
