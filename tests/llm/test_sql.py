"""Registered queries against their SQL, on small tables with odd rows."""

from __future__ import annotations

import os

import duckdb
import pytest

from renalis.llm import oracle, registry
from tests.llm.rows import edge_rows

HOSTS = [
    "a.com", "A.com:8080", "user:pw@a.com", "b.a.com.", "c.org:", "example.org", "x.example.org", "10.0.0.1",
    "10.0.0.1:80", "10.0.0.2", "[::1]:443", "[::1]", "localhost", "", "net", "d.net", "e.d.net", "1.2.3.4.5",
]
PATHS = ["/de/x", "/es/?q", "/en/1#f", "/fr/", "", "?a/b", "#/fr/"]


def page_rows():
    urls = [f"https://{h}{p}" for h in HOSTS for p in PATHS] + [None, "", "no scheme", "://", "a://b://c/"]
    html = ["", "<p>one</p>", "é\r\n", "WARC/1.1\r\nx", None, "two"]
    return [(i, u, html[i % len(html)] if i % 4 else f"own {i}") for i, u in enumerate(urls)]


def document_rows():
    known = {i: t for i, t in edge_rows() if i is not None}
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    texts = [" ".join(words[j:] + words[:j]) for j in range(10)]
    texts += [" ".join(words) + f" more{j}" for j in range(4)] + ["Alpha\tBETA", "alpha beta", "alpha", "É é"]
    start = max(known, default=0) + 1
    return [*known.items(), *((start + j, t) for j, t in enumerate(texts * 2))]


@pytest.fixture
def folder(spark, tmp_path):
    labels = [(i, int(i % 3 > 0), int(i % 5 == 0)) for i in range(100)] + [(7, 1, 0), (1, None, 1)]
    tables = {
        "pages": spark.createDataFrame(page_rows(), "page_id long, url string, html string"),
        "labels": spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
        "documents": spark.createDataFrame(document_rows(), "doc_id long, text string"),
    }
    for name, rows in tables.items():
        rows.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("name", ["op5_host_reputation", "op7_warc_revisits", "op10_hyperminhash"])
def test_query_and_sql_agree(spark, folder, name):
    con = duckdb.connect()
    for file in os.listdir(folder):
        con.sql(f"create view {file.removesuffix('.parquet')} as from '{folder}/{file}/*.parquet'")
    got = registry.queries()[name](spark, folder)
    want = con.sql(oracle.SQL[name])
    assert sorted(want.columns) == sorted(got.columns)
    columns = sorted(got.columns)
    rows = sorted(str(tuple(r)) for r in got.select(*columns).collect())
    assert rows == sorted(map(str, want.project(", ".join(columns)).fetchall())) and rows
