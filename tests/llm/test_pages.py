from __future__ import annotations

import base64
import hashlib
import random
from urllib.parse import urlsplit

import pytest
from pyspark.sql import functions as F

from renalis.llm import host_reputation, warc
from renalis.llm.host_reputation import RULES, Rule

CLASHING = ["id", "digest", "original", "value", "body", "host", "path", "n", "k", "mean", "salt"]


def pages(spark, rows):
    """page_id, url, html and clashing columns."""
    extra = ", ".join(f"`{c}` string" for c in CLASHING)
    data = [(*r, *["x"] * len(CLASHING)) for r in rows]
    return spark.createDataFrame(data, f"page_id long, url string, html string, {extra}")


# ---- archives -------------------------------------------------------------------------------------


def sha1(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


PAYLOADS = [
    "<p>a</p>", "", None, "é漢字🙂", "x\r\n\r\ny\r\n\r\n", "WARC/1.1\r\nWARC-Type: response\r\n\r\n",
    "\r\n\r\nWARC/1.1\r\nWARC-Type: revisit\r\nContent-Length: 0\r\n\r\n\r\n\r\n", "\n", "\r\n",
    "z" * 200_000, "WARC/1.1", "HTTP/1.1 200 OK\r\n\r\n", " lead and trail ",
]


def check_archive(spark, work, rows, min_bytes=0):
    path = work.folder("warc")
    got = sorted(map(tuple, warc.archive(pages(spark, rows), path, work, min_bytes).collect()))
    first = {}
    for i, _, html in sorted(rows, key=lambda r: r[0]):
        first.setdefault(html or "", i)
    want, seen = [], set()
    for i, _, html in rows:
        size, digest = len((html or "").encode()), sha1(html)
        origin = first[html or ""]
        if size < min_bytes or (origin == i and (i, digest) not in seen):
            want.append((i, size, digest, "response", None))
        else:
            want.append((i, size, digest, "revisit", origin))
        seen.add((i, digest))
    assert [tuple(x) for x in got] == sorted(want, key=lambda r: [(v is None, v) for v in r])
    return path


def test_every_payload_comes_back(spark, work):
    rows = [(i, f"http://h/{i}", p) for i, p in enumerate(PAYLOADS)]
    rows += [(100 + i, f"http://other/{i}", p) for i, p in enumerate(PAYLOADS)]
    path = check_archive(spark, work, rows)
    found = warc.read_archives(spark, path).collect()
    assert {r.payload for r in found if r.type == "response"} == {p or "" for p in PAYLOADS}
    assert all(r.digest == r.found_digest for r in found if r.type == "response")


def test_revisits_of_a_payload_many_pages_share(spark, work):
    rng = random.Random(1)
    rows = [(i, f"http://h/{i}", f"page {rng.randrange(200)}" if i % 3 else "same") for i in range(900)]
    check_archive(spark, work, rows)
    check_archive(spark, work, rows, min_bytes=7)


def test_repeated_rows_and_odd_headers(spark, work):
    rows = [(1, "http://a", "p"), (1, "http://a", "p"), (1, "http://b", "p"), (2, None, "p"),
            (3, "http://x\r\nWARC-Type: revisit\r\n\r\n", "q"), (-4, "", "q"),
            (7, "http://x/WARC/1.1", "r")]
    check_archive(spark, work, rows)


def test_rows_without_id(spark, work):
    rows = [(None, "u", "only"), (None, "v", "p"), (5, "w", "p")]
    got = warc.archive(pages(spark, rows), work.folder("warc"), work).collect()
    assert sorted((r.page_id is None, r.record_type, r.refers_to or 0) for r in got) == [
        (False, "response", 0), (True, "response", 0), (True, "revisit", 5),
    ]


def test_files_are_archives(spark, work):
    import gzip
    import os

    path = work.folder("warc")
    warc.write_archives(pages(spark, [(1, "http://a", "p"), (2, "http://b", "p")]), path)
    text = b"".join(
        gzip.open(f"{path}/{f}").read() for f in sorted(os.listdir(path)) if f.endswith(".gz")
    )
    kinds = []
    while text:  # as any reader does: version, headers, a block of Content-Length, two line breaks
        head, _, rest = text.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        assert lines[0] == "WARC/1.1"
        fields = dict(line.split(": ", 1) for line in lines[1:])
        n = int(fields["Content-Length"])
        assert rest[n : n + 4] == b"\r\n\r\n"
        kinds.append((fields["WARC-Type"], fields["WARC-Record-ID"], fields.get("WARC-Refers-To")))
        text = rest[n + 4 :]
    assert sorted(kinds) == [
        ("response", "<urn:page:1>", None), ("revisit", "<urn:page:2>", "<urn:page:1>"),
    ]


def test_empty_table(spark, work):
    assert warc.archive(pages(spark, []), work.folder("warc"), work).count() == 0


# ---- hosts ----------------------------------------------------------------------------------------

URLS = [
    "http://a.example.com/fr/1?x=1", "https://A.Example.COM/de/#t", "http://example.org", None, "",
    "http://example.org/", "no scheme/at.all", "x://y://z/p", "http://example.org/es/", "://h/p?q",
    "http://m.example.org/en/1", "http://m.example.org/en/2", "http://notexample.org/es/",
    "http://user@host:80/p", "http://h?q/x", "http://h#q/x", "http://com/fr/", "http://xcom/fr/",
    "http://ÄB.com/de/", "http:///path", "http://h/a\nb?c\nd",
]


def parts_by_definition(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])
    rest = rest[:end]
    cut = rest.find("/") if "/" in rest else len(rest)
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    return host, rest[cut:]


def rule_by_definition(host, path):
    fits = [
        r for r in RULES
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    return max(fits, key=lambda r: len(r.text), default=None)


def label_rows(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_urls_and_rules(spark, work):
    rows = [(i, u, None) for i, u in enumerate(URLS)] + [(0, URLS[0], None), (None, URLS[1], "x")]
    got = host_reputation.judge(pages(spark, rows), label_rows(spark, []), RULES, work).collect()
    assert len(got) == len(rows)
    for r in got:
        url = URLS[r.page_id] if r.page_id is not None else URLS[1]
        host, path = parts_by_definition(url)
        rule = rule_by_definition(host, path)
        assert (r.host, r.path) == (host, path), url
        assert (r.rule, r.verdict) == ((rule.text, rule.verdict) if rule else (None, "allow")), url
    assert urlsplit(URLS[0]).hostname == "a.example.com"


def site_rows(bad_rates, labelled=200, hosts_per_site=4):
    """Pages of some hosts for each registered domain, bad with the domain's rate."""
    rng = random.Random(3)
    rows, labels, n = [], [], 0
    for domain, rate in bad_rates.items():
        for h in range(hosts_per_site):
            for _ in range(labelled // hosts_per_site):
                rows.append((n, f"http://h{h}.{domain}/p", None))
                labels.append((n, int(rng.random() >= rate), 0))
                n += 1
        rows.append((n, f"http://new.{domain}/p", None))  # a host that no label covers
        n += 1
    return rows, labels


def test_bad_hosts_are_blocked_and_new_ones_take_after_their_domain(spark, work):
    rates = {"bad.net": 0.95, "good.net": 0.05, "fair.net": 0.3, "poor.org": 0.9, "fine.org": 0.02}
    rows, labels = site_rows(rates)
    got = host_reputation.judge(pages(spark, rows), label_rows(spark, labels), [], work).collect()
    verdicts = {r.host: r.verdict for r in got}
    for domain, rate in rates.items():
        for host in ("h0", "h3", "new"):
            assert verdicts[f"{host}.{domain}"] == ("block" if rate > 0.8 else "allow"), (host, domain)


def test_one_bad_page_does_not_block_a_host(spark, work):
    rows, labels = site_rows({"good.net": 0.05, "fair.net": 0.1, "fine.net": 0.02})
    rows.append((9_999, "http://small.good.net/p", None))
    labels.append((9_999, 0, 1))
    got = host_reputation.judge(pages(spark, rows), label_rows(spark, labels), [], work).collect()
    small = next(r for r in got if r.host == "small.good.net")
    assert small.verdict == "allow" and 0.05 < small.bad_rate < 0.6


def test_shrinkage_by_hand(spark, work):
    """The posterior of a host is that of its counts under the prior of its domain."""
    rows, labels = site_rows({"bad.net": 0.9, "good.net": 0.1, "fair.net": 0.4})
    labels += [(labels[0][0], 1, 1), (None, 0, 1)]  # a page labelled twice, and a label without id
    got = host_reputation.judge(pages(spark, rows), label_rows(spark, labels), [], work).collect()
    bad = {}
    for i, quality, toxic in labels:
        bad[i] = max(bad.get(i, 0), toxic, 1 - quality)
    n = sum(1 for i, u, _ in rows if "h0.bad.net" in u)
    k = sum(bad[i] for i, u, _ in rows if "h0.bad.net" in u)
    row = next(r for r in got if r.host == "h0.bad.net")
    domain = [bad[i] for i, u, _ in rows if "bad.net" in u and i in bad]
    low, high = sorted([k / n, sum(domain) / len(domain)])
    assert low - 0.05 <= row.bad_rate <= high + 0.05 and row.lower_bound < row.bad_rate


@pytest.mark.parametrize("labels", [[], [(0, None, None)], [(0, 0, 1)] * 3])
def test_few_labels_and_empty_tables(spark, work, labels):
    rules = [Rule("block", "h", "/")]
    got = host_reputation.judge(
        pages(spark, [(0, "http://h/p", None), (1, "http://i/p", None)]), label_rows(spark, labels),
        rules, work,
    )
    assert {r.host: r.rule for r in got.collect()} == {"h": "h/", "i": None}
    assert host_reputation.judge(pages(spark, []), label_rows(spark, labels), rules, work).count() == 0


def test_levels_of_hosts(spark):
    want = {
        "a.b.com": ("b.com", "com"), "b.com:8080": ("b.com", "com"), "me:pw@b.com": ("b.com", "com"),
        "b.com.": ("b.com", "com"), "b.com.:1": ("b.com", "com"), "10.0.0.1:80": ("10.0.0.1", "[address]"),
        "[::1]:443": ("[::1]", "[address]"), "localhost": ("localhost", "localhost"), "": ("", ""),
    }
    hosts = spark.createDataFrame([(h,) for h in want], "host string")
    domain, suffix = host_reputation.levels(F.col("host"))
    got = hosts.select("host", domain.alias("d"), suffix.alias("s")).collect()
    assert {r.host: (r.d, r.s) for r in got} == want
