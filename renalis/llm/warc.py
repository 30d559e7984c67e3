"""WARC archives with revisit records: written and read by Spark's text files, headers shuffled alone.

Records are text, as the payload is UTF-8, and each ends in two line breaks: a text file whose lines
end in them is an archive, which Spark writes through its committer to any store. Read with the
version line as the separator, its lines are the records again, without ever holding a whole archive.
A payload that contains the version line itself is sent in base64.
"""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from renalis.session import Workspace

VERSION = "WARC/1.1\r\n"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_CONV32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"  # the digits that conv() gives
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
_ENCODED = "Content-Transfer-Encoding: base64\r\n"


def base32(sha1_hex: Column) -> Column:
    """A SHA-1 of 40 hex digits in base32, upper case, as WARC headers have it."""
    letters = []
    for part in range(4):  # 40 bits are 8 letters
        digits = F.conv(F.substring(sha1_hex, 10 * part + 1, 10), 16, 32)
        letters.append(F.lpad(digits, 8, "0"))
    return F.translate(F.concat(*letters), _CONV32, _BASE32)


def _name(id_: Column) -> Column:
    """The id as text, "-" for a null: a key that joins and windows can share."""
    return F.coalesce(id_.cast("string"), F.lit("-"))


def headers(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """id, its name, url, digest (hex) and bytes of each row; no payload."""
    payload = F.coalesce(F.col(html_col), F.lit(""))
    return pages.select(
        F.col(id_col).alias("id"),
        _name(F.col(id_col)).alias("name"),
        F.col(url_col).alias("url"),
        F.sha1(payload).alias("digest"),
        F.octet_length(payload).cast("long").alias("bytes"),
    )


def originals(head: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(digest, original, uri): for each payload of at least min_bytes, the smallest id that has it and
    the first url of that id.

    Tasks send one row for each digest they have seen, so a payload that a third of all pages share
    costs no more than any other. Null ids count only where there is no other.
    """
    named = F.struct("id", "url")
    first = F.coalesce(F.min(F.when(F.col("id").isNotNull(), named)), F.min(named))
    return (
        head.filter(F.col("bytes") >= min_bytes)
        .groupBy("digest")
        .agg(first.alias("first"))
        .select("digest", F.col("first.id").alias("original"), F.col("first.url").alias("uri"))
    )


def resolved(head: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(name, digest, original, uri) of each distinct id and digest; original null: always a response."""
    distinct = head.select("name", "digest").distinct()
    return distinct.join(originals(head, min_bytes), "digest", "left")


def _line(name: str, value: Column) -> Column:
    """A header line; none for a null.

    Line breaks in the value are percent-encoded, and so is its end where that would look like a
    version line.
    """
    clean = value
    for char in ("\r", "\n"):
        clean = F.replace(clean, F.lit(char), F.lit(f"%{ord(char):02X}"))
    line = F.concat(F.lit(f"{name}: "), clean, F.lit("\r\n"))
    escaped = f"{VERSION[:-3]}%{ord(VERSION[-3]):02X}\r\n"
    return F.coalesce(F.replace(line, F.lit(VERSION), F.lit(escaped)), F.lit(""))


def _record_id(id_: Column, nth: Column) -> Column:
    """The first record of an id is urn:page:ID; further rows with that id and payload add a number."""
    return F.concat(
        F.lit("<urn:page:"), _name(id_), F.when(nth > 1, F.concat(F.lit("."), nth)).otherwise(""), F.lit(">")
    )


def _body(payload: Column) -> Column:
    """The HTTP response: the payload as it is, or in base64 if it would look like a new record."""
    plain = F.concat(F.lit(_HTTP + "\r\n"), payload)
    encoded = F.concat(F.lit(_HTTP + _ENCODED + "\r\n"), F.base64(F.encode(payload, "UTF-8")))
    ended = F.concat(payload, F.lit(END))
    return F.when(F.contains(ended, F.lit(VERSION)), encoded).otherwise(plain)


def records(
    pages: DataFrame,
    min_bytes: int = 0,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    date: datetime | None = None,
) -> DataFrame:
    """`value`: one WARC record per page, without the line breaks that end it.

    All records are of one date, that of the call if none is given: their headers are fresh ones.

    Headers alone meet by digest. Their decision then comes to the pages by id and digest, a key that
    one payload shared by many pages does not make hot. Of several rows with the id of the original
    and its payload, the first by url is the response.
    """
    payload = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(
        F.col(id_col).alias("id"),
        _name(F.col(id_col)).alias("name"),
        F.col(url_col).alias("url"),
        payload.alias("payload"),
        F.sha1(payload).alias("digest"),
    )
    written = (date or datetime.now(UTC)).strftime("%Y-%m-%dT%H:%M:%SZ")
    decided = resolved(headers(pages, id_col, url_col, html_col), min_bytes)
    rows = rows.join(decided, ["digest", "name"])
    nth = F.row_number().over(W.partitionBy("digest", "name").orderBy("url"))  # no further shuffle
    small = F.octet_length("payload") < min_bytes
    first = F.col("id").eqNullSafe(F.col("original")) & (F.col("nth") == 1)
    rows = rows.withColumn("nth", nth).withColumn("response", small | first)
    body = F.when(F.col("response"), _body(F.col("payload"))).otherwise(F.lit(_HTTP + "\r\n"))
    rows = rows.withColumn("body", body)
    revisit = ~F.col("response")
    kind = F.when(F.col("response"), "response").otherwise("revisit")
    value = F.concat(
        F.lit(VERSION),
        _line("WARC-Type", kind),
        _line("WARC-Record-ID", _record_id(F.col("id"), F.col("nth"))),
        _line("WARC-Date", F.lit(written)),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32(F.col("digest")))),
        _line("WARC-Refers-To", F.when(revisit, _record_id(F.col("original"), F.lit(1)))),
        _line("WARC-Refers-To-Target-URI", F.when(revisit, F.col("uri"))),
        _line("WARC-Refers-To-Date", F.when(revisit, F.lit(written))),
        _line("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line("Content-Length", F.octet_length("body").cast("string")),
        F.lit("\r\n"),
        F.col("body"),
    )
    return rows.select(value.alias("value"))


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, **columns: str) -> None:
    """Deduplicated archives (gzip) under path, one for each task."""
    found = records(pages, min_bytes, **columns)
    found.write.option("lineSep", END).option("compression", "gzip").text(path)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """type, id, digest, refers_to, uri, payload, found_digest of each record, the payload decoded.

    found_digest is that of the payload read. A record whose length is not that of its header raises
    an error.
    """
    lines = (
        spark.read.schema("value string")
        .option("lineSep", VERSION)
        .text(path)
        .filter(F.col("value") != "")
    )
    # Record headers, HTTP headers, and the rest, which the two line breaks at the end close.
    rows = lines.select("value", F.split("value", END, 3).alias("part")).select(
        F.concat(F.lit("\r\n"), F.col("part")[0]).alias("head"),
        F.col("part")[1].alias("http"),
        F.expr("substring(part[2], 1, length(part[2]) - 4)").alias("body"),
        F.octet_length("value").alias("size"),
    )

    def field(name: str) -> Column:
        value = F.regexp_extract("head", rf"\r\n{name}: ([^\r\n]*)", 1)
        return F.when(value != "", value)

    page = r"^<urn:page:(-?[0-9]*)(?:\.[0-9]+)?>$"
    # The block is the value without the record's headers and the line breaks around it.
    block = F.col("size") - F.octet_length("head") + 2 - 8
    rows = rows.select(
        field("WARC-Type").alias("type"),
        F.regexp_extract(field("WARC-Record-ID"), page, 1).alias("id"),
        F.regexp_extract(field("WARC-Payload-Digest"), "^sha1:(.*)$", 1).alias("digest"),
        F.regexp_extract(field("WARC-Refers-To"), page, 1).alias("refers_to"),
        field("WARC-Target-URI").alias("uri"),
        F.assert_true(
            field("Content-Length").cast("long") == block,
            F.lit("a record's length is not that of its header"),
        ).alias("whole"),
        F.contains("http", F.lit(_ENCODED.strip())).alias("encoded"),
        "body",
    )
    decoded = F.decode(F.unbase64("body"), "UTF-8")
    payload = F.when(F.col("encoded"), decoded).otherwise(F.col("body"))
    response = F.col("type") == "response"
    rows = rows.filter("whole is null").withColumn("payload", F.when(response, payload))
    return rows.select(
        "type",
        F.col("id").try_cast("long").alias("id"),
        "digest",
        F.col("refers_to").try_cast("long").alias("refers_to"),
        "uri",
        "payload",
        F.when(response, base32(F.sha1(F.col("payload")))).alias("found_digest"),
    )


def resolve_revisits(found: DataFrame, work: Workspace) -> DataFrame:
    """id, payload_bytes, payload_digest, record_type, refers_to: revisits joined to their originals.

    The records are read once; only their headers are kept, as a table, and meet by digest.
    """
    head = work.cut(
        found.select(
            "id", "type", "digest", "refers_to", "found_digest",
            F.octet_length("payload").cast("long").alias("n"),
        ),
        "headers",
    )
    sources = (
        head.filter("type = 'response'")
        .groupBy("digest")
        .agg(F.max("n").alias("s_n"), F.max("found_digest").alias("s_digest"))
    )
    response = head.filter("type = 'response'").select(
        "id", F.col("n").alias("payload_bytes"), F.col("found_digest").alias("payload_digest"),
        F.col("type").alias("record_type"), "refers_to",
    )
    revisits = (
        head.filter("type = 'revisit'")
        .join(sources, "digest", "left")
        .select(
            "id", F.col("s_n").alias("payload_bytes"), F.col("s_digest").alias("payload_digest"),
            F.col("type").alias("record_type"), "refers_to",
        )
    )
    return response.unionByName(revisits)


def archive(
    pages: DataFrame,
    path: str,
    work: Workspace,
    min_bytes: int = 0,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """Writes archives of the pages to path, reads them back, and returns one row per page.

    page id, payload_bytes, payload_digest, record_type, refers_to, all taken from the archives. A
    null payload is empty; empty payloads are equal to each other. Rows repeated with the same id and
    payload are a response and revisits of it. Rows without an id are archived as page "-", are
    originals only of payloads that no page with an id has, and have null as id and refers_to. An
    empty table gives no rows. Other columns are not read.
    """
    spark = pages.sparkSession
    write_archives(pages, path, min_bytes, id_col=id_col, url_col=url_col, html_col=html_col)
    found = resolve_revisits(read_archives(spark, path), work)
    return found.select(
        F.col("id").alias(id_col), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
