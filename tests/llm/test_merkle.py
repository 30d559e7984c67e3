from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from renalis.llm import merkle, oracle
from tests.llm.rows import CLASHING, edge_rows

SCHEMA = "doc_id long, text string, source string, lang string, n_chars long"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, more: int = 0) -> str:
    n = row["n_chars"]
    values = [row["doc_id"], row["source"], row["lang"], None if n is None else n + more, row["text"]]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(leaves: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    levels = [leaves]
    while len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([sha("".join(low[i : i + 2])) for i in range(0, len(low), 2)])
    proofs = []
    for i in range(len(leaves)):
        proof = []
        for level in levels[:-1]:
            j = i ^ 1
            beside = level[j] if j < len(level) else ""
            proof.append((beside, "") if j < i else ("", beside))
            i //= 2
        proofs.append(proof)
    return levels[-1][0], proofs


def by_hand(rows: list[dict]) -> list[tuple]:
    groups = defaultdict(list)
    for r in rows:
        groups[r["lang"]].append(r)
    if not rows:
        return []
    names = sorted(groups, key=lambda k: (k is not None, (k or "").encode()))
    for k in names:
        groups[k].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
    subs = {k: tree([leaf(r) for r in groups[k]]) for k in names}
    root, tops = tree([subs[k][0] for k in names])
    out = []
    for k, top in zip(names, tops):
        for r, proof in zip(groups[k], subs[k][1]):
            i = r["doc_id"]
            node = leaf(r, int(i is not None and zlib.crc32(str(i).encode()) % 7 == 0))
            for left, right in proof + top:
                node = sha(left + node + right)
            beside = sha("".join(a + b for a, b in proof + top))
            out.append((i, leaf(r), subs[k][0], root, beside, node, node == root))
    return sorted(out, key=str)


def audited(spark, work, rows, schema=SCHEMA):
    docs = spark.createDataFrame(rows, schema)
    got = sorted((tuple(r) for r in merkle.audit(docs, work).collect()), key=str)
    return got, by_hand([r.asDict() for r in docs.collect()])


@pytest.mark.parametrize("n", [0, 1, 2, 3, 5, 16, 17, 33])
def test_small_trees(spark, work, n, monkeypatch):
    monkeypatch.setattr(merkle, "SPAN", 2)  # blocks of four, so that trees take several rounds
    rows = [(i * 5 % 37, f"t{i}", "s", "en", i) for i in range(n)]
    got, want = audited(spark, work, rows)
    assert got == want


def test_groups_nulls_and_repeated_rows(spark, work):
    rows = [
        (i if i % 5 else None, None if i % 7 == 0 else f"text {i}", "src" if i % 2 else None,
         ["en", None, "de", "é", "", "ä"][i % 6] if i > 50 else "en", i if i % 3 else None)
        for i in range(150)
    ]
    rows += [(3, "one", "s", "xx", 3)] * 3 + [(3, "other", "s", "xx", 3), (9, "alone", "s", "fr", 1)]
    got, want = audited(spark, work, rows)
    assert got == want
    assert {r[-1] for r in got} == {True, False}


def test_edge_rows_and_clashing_columns(spark, work):
    columns = [c for c in CLASHING if c != "lang"] + ["grp", "digest", "pos", "seg", "proof", "level"]
    schema = SCHEMA + "".join(f", `{c}` string" for c in columns)
    rows = [(i, t, "s", None, 1, *["x"] * len(columns)) for i, t in edge_rows()]
    got, want = audited(spark, work, rows, schema)
    assert got == want


def test_one_changed_value_is_found(spark, work):
    rows = [(i, f"t{i}", "s", "en", i) for i in range(20)]
    docs = spark.createDataFrame(rows, SCHEMA)
    proofs = merkle.manifest(docs, work).proofs
    changed = docs.withColumn("text", F.when(F.col("doc_id") == 7, "x").otherwise(F.col("text")))
    again = changed.select("doc_id", merkle.leaf([F.col(c) for c in merkle.COLUMNS]).alias("again"))
    checked = merkle.verify(proofs.join(again, proofs["id"] == again["doc_id"]), F.col("again"))
    assert [r.id for r in checked.filter("not verified").collect()] == [7]


def test_salted_ancestors(spark, work, monkeypatch):
    """More than 2^16 leaves of one group, so that the last joins go by copies."""
    docs = spark.range(70_000).select(
        F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"), F.lit("s").alias("source"),
        F.lit("en").alias("lang"), F.lit(1).cast("long").alias("n_chars"),
    )
    found = merkle.audit(docs, work).filter("doc_id % 10007 = 0 or doc_id > 69990").collect()
    want = {r[0]: r for r in by_hand([r.asDict() for r in docs.collect()])}
    assert len(found) == 16 and all(tuple(r) == want[r.doc_id] for r in found)


def test_sql(spark, work):
    path = "/root/testdata/sf0.001/documents.parquet"
    docs = spark.read.parquet(path)
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{path}'")
    got = sorted(tuple(r) for r in merkle.audit(docs, work).collect())
    assert got == sorted(con.sql(oracle.MERKLE).fetchall())
