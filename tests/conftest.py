from __future__ import annotations

import os
import sys
from datetime import date, datetime

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from renalis import preset, session  # noqa: E402
from renalis.sources.schemas import SCHEMAS  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    spark = (
        SparkSession.builder.master("local[4]")
        .appName("renalis-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield session.tune(spark)
    spark.stop()


@pytest.fixture
def work(spark):
    space = session.Workspace(spark)
    yield space
    space.clear()


@pytest.fixture
def oracle_cfg():
    return preset("oracle", window_start=date(2010, 1, 1))


def d(text: str | None) -> date | None:
    return date.fromisoformat(text) if text else None


def ts(text: str | None) -> datetime | None:
    return datetime.fromisoformat(text) if text else None


_KINDS = {
    "string": T.StringType(),
    "date": T.DateType(),
    "ts": T.TimestampNTZType(),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
}


def frame(spark, columns: str, rows: list[tuple]):
    """DataFrame from 'NAME:kind ...' with dates and timestamps given as text."""
    fields = [c.split(":") for c in columns.split()]
    schema = T.StructType([T.StructField(n, _KINDS[k]) for n, k in fields])
    convert = {"date": d, "ts": ts}
    data = [
        tuple(convert.get(k, lambda v: v)(v) for v, (_, k) in zip(row, fields)) for row in rows
    ]
    return spark.createDataFrame(data, schema)


def table(spark, name: str, rows: list[dict]):
    """Rows of a common-data-model table; columns left out are NULL."""
    schema = SCHEMAS[name]
    data = []
    for row in rows:
        unknown = set(row) - set(schema.names)
        assert not unknown, unknown
        data.append(
            tuple(
                d(row.get(f.name)) if isinstance(f.dataType, T.DateType) else row.get(f.name)
                for f in schema.fields
            )
        )
    return spark.createDataFrame(data, schema)


def stay(enc: str, pat: str, admit: str, discharge: str, kind: str = "IP", **more) -> dict:
    """ENCOUNTER row from 'date time' texts."""
    a_day, _, a_time = admit.partition(" ")
    d_day, _, d_time = discharge.partition(" ")
    return {
        "ENCOUNTERID": enc, "PATID": pat, "ENC_TYPE": kind,
        "ADMIT_DATE": a_day, "ADMIT_TIME": a_time or None,
        "DISCHARGE_DATE": d_day, "DISCHARGE_TIME": d_time or None, **more,
    }


def scr(pat: str, order: str, taken: str, value: float, result: str | None = None, **more) -> dict:
    """Serum creatinine row of LAB_RESULT_CM; taken and result are 'date time' texts."""
    result = result or taken
    return {
        "PATID": pat, "LAB_LOINC": "2160-0", "RESULT_UNIT": "mg/dL", "SPECIMEN_SOURCE": "SER_PLAS",
        "RESULT_NUM": value, "LAB_ORDER_DATE": order,
        "SPECIMEN_DATE": taken.split()[0], "SPECIMEN_TIME": taken.split()[1],
        "RESULT_DATE": result.split()[0], "RESULT_TIME": result.split()[1], **more,
    }


def person(pat: str, birth: str = "1960-01-01", sex: str = "M", race: str = "05") -> dict:
    return {"PATID": pat, "BIRTH_DATE": birth, "SEX": sex, "RACE": race}


def site(spark, **rows) -> dict:
    """A whole site: tables not given are empty."""
    names = ["ENCOUNTER", "DEMOGRAPHIC", "LAB_RESULT_CM", "DIAGNOSIS", "PROCEDURES", "DEATH"]
    return {n: table(spark, n, rows.get(n, [])) for n in names}
