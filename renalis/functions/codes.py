"""Clinical code sets and the predicates built from them."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Codes as the study defines them.
SCR_LOINC = ["2160-0", "38483-4", "14682-9", "21232-4", "35203-9", "44784-7", "59826-8"]

VITAL_CODES = [
    "8480-6", "8459-0", "8460-8", "8461-6", "75997-7", "8462-4", "8453-3", "8454-1", "8455-8",
    "75995-1", "3137-7", "8302-2", "8308-9", "3138-5", "3141-9", "29463-7", "8335-2", "3142-7",
    "8341-0", "8340-2", "39156-5", "89270-3", "722499006", "11366-2", "11367-0", "39240-7",
    "39243-1", "63608-4", "63638-1", "64234-8", "67741-9", "72166-2", "74010-0", "74011-8",
    "81229-7", "82769-1", "8663-7", "8664-5", "88029-4", "88030-2", "88031-0", "95494-1",
    "95529-4", "96101-1", "96103-7",
]
VITAL_NAMES = [
    "SYSTOLIC", "HT", "SMOKING", "TOBACCO_TYPE", "TOBACCO", "DIASTOLIC", "ORIGINAL_BMI", "WT",
]

# set -> [(code system, kind of match, codes)]
CODE_SETS: dict[str, list[tuple[str, str, list[str]]]] = {
    "ESRD_DX": [
        ("09", "contains", ["585.6"]),
        ("10", "contains", ["N18.6"]),
    ],
    "RRT_DX": [
        ("09", "prefix", ["V45.1", "V56.", "V42.0", "996.81"]),
        ("10", "prefix", ["Z49.31", "Z99.2", "Z94.0"]),
        ("10", "exact", ["T86.10", "T86.11", "T86.12"]),
    ],
    "DIALYSIS_PX": [
        ("CH", "exact", ["90935", "90937"]),
        ("CH", "prefix", ["9094", "9095", "9096", "9097", "9098", "9099"]),
        ("09", "exact", ["39.93", "39.95", "54.98"]),
        ("10", "exact", ["5A1D00Z", "5A1D60Z", "5A1D70Z", "5A1D80Z", "5A1D90Z"]),
    ],
    "TRANSPLANT_PX": [
        ("CH", "exact", [
            "50300", "50320", "50323", "50325", "50327", "50328", "50329", "50340", "50360",
            "50365", "50370", "50380",
        ]),
        ("09", "exact", ["55.51", "55.52", "55.53", "55.54", "55.61", "55.69"]),
        ("10", "exact", [
            "0TY00Z0", "0TY00Z1", "0TY00Z2", "0TY10Z0", "0TY10Z1", "0TY10Z2", "0TB00ZZ",
            "0TB10ZZ", "0TT00ZZ", "0TT10ZZ", "0TT20ZZ",
        ]),
    ],
    "BURN_DX": [
        ("09", "prefix", [
            "906.5", "906.6", "906.7", "906.8", "906.9", "940", "941", "942", "943", "944", "945",
            "946", "947", "948", "949",
        ]),
        ("10", "prefix", [
            "T20.", "T21.", "T22.", "T23.", "T24.", "T25.", "T26.", "T27.", "T28.", "T30.",
            "T31.", "T32.",
        ]),
    ],
}


def _matches(code: Column, kind: str, codes: list[str]) -> Column:
    if kind == "exact":
        return code.isin(codes)
    if kind == "contains":
        return reduce(or_, [code.contains(c) for c in codes])
    # Prefixes of one length are one set lookup, instead of a test per prefix.
    lengths = sorted({len(c) for c in codes})
    return reduce(
        or_, [F.substring(code, 1, n).isin([c for c in codes if len(c) == n]) for n in lengths]
    )


def code_match(name: str, type_col: str, code_col: str) -> Column:
    """True where (code system, code) belongs to the set; pushed down to the scan by Catalyst."""
    return reduce(
        or_,
        [
            (F.col(type_col) == system) & _matches(F.col(code_col), kind, codes)
            for system, kind, codes in CODE_SETS[name]
        ],
    )


def in_any_set(names: list[str], type_col: str, code_col: str) -> Column:
    """True where (code system, code) belongs to one of the sets, for a filter ahead of a join.

    Where a view computes the code, Catalyst puts its expression into the filter: here once, and not
    in each comparison.
    """
    record = F.struct(F.col(type_col).alias("type"), F.col(code_col).alias("code"))
    return F.exists(
        F.array(record),
        lambda r: reduce(
            or_,
            [
                (r["type"] == system) & _matches(r["code"], kind, codes)
                for name in names
                for system, kind, codes in CODE_SETS[name]
            ],
        ),
    )


def code_sets(spark: SparkSession) -> DataFrame:
    """The sets as a table: set_name, code_type, match, code."""
    rows = [
        (name, system, kind, code)
        for name, rules in CODE_SETS.items()
        for system, kind, codes in rules
        for code in codes
    ]
    rows += [("SCR_LOINC", "LC", "exact", c) for c in SCR_LOINC]
    rows += [("VITAL_CODES", "LC", "exact", c) for c in VITAL_CODES]
    rows += [("VITAL_NAMES", "TX", "exact", c) for c in VITAL_NAMES]
    return spark.createDataFrame(
        rows, "set_name string, code_type string, match string, code string"
    )
