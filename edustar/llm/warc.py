r"""WARC derivatives: a metadata and a plain-text conversion record for every response record.

``responses`` makes response records of pages (a WARC header and an HTTP response as one text); ``derive`` takes
response records, splits header, HTTP header and payload, and builds two records that refer to the response
(WARC-Refers-To) and keep its target URI and date. Both carry, in their own headers, every WARC header line of the
source (its digests among them) behind ``X-Source-`` and every HTTP header line behind ``X-Source-HTTP-``:

* metadata (application/warc-fields): the HTTP status and every HTTP header line of the source with the prefix
  ``http-``, the source's digests, whether the payload digest still holds ("unknown" for a digest that isn't
  ``sha256:`` and hex), title, and outlinks;
* conversion (text/plain): the text of the page: without comments, scripts, styles and tags, block tags as line ends.

Record ids are UUIDs made from the source's id, and a response's from its page, URL and payload digest, so a run again gives the
same records and different ones never share an id. Digests are
``sha256:`` and lower-case hex of the bytes. ``write_warc`` stores records as gzip members, a file per task.
Only DataFrame functions are used.

Defined results: null url and html count as empty; an empty page gives records with an empty block. Repeated rows give
repeated records. Responses that are null or lack a header are taken as an empty header and payload.
An empty table gives an empty result. Extra columns have no effect; ``key`` columns are passed through.
"""

from __future__ import annotations

import gzip

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shared_dir, table

CRLF = "\r\n"
DATE = "2024-01-01T00:00:00Z"  # the pages carry no fetch time
# Entities that are decoded, in this order (others stay as they are).
ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&amp;", "&")]
DROPPED = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>|<head\b.*?</head\s*>"
# DROPPED, or white space other than spaces; one class of characters leads, so that other characters are passed over quickly.
DROPPED_OR_SPACE = r"[<\t\n\x0B\f\r](?:(?<!<)[\t\n\x0B\f\r]*|(?is:!--.*?-->|script\b.*?</script\s*>|style\b.*?</style\s*>|head\b.*?</head\s*>))"
BREAKS = r"(?i)</?(?:p|div|br|hr|li|ul|ol|tr|table|h[1-6]|nav|section|article|header|footer|main|aside|blockquote|pre|dl|dt|dd|form)\b[^>]*>"
TAGS = r"<[!/?a-zA-Z][^>]*>"
# Runs of spaces and line ends: one line end (first group) stays of those with any, one space (second group) of others.
RUNS = r"(?=[ \n])(?: *(\n)[ \n]*| +( ))"
TITLE = r"(?is)<title[^>]*>(.*?)</title>"
LINKS = r"""(?i)<a\s[^>]*?href\s*=\s*["']([^"']*)["']"""


def digest(c: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(c, 256))


def uuid_of(c: Column) -> Column:
    h = F.md5(c)
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))


def responses(pages: DataFrame, date: str = DATE) -> DataFrame:
    """key (page_id) and the response record of every page."""
    url, html = F.coalesce("url", F.lit("")), F.coalesce("html", F.lit(""))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.octet_length(html).cast("string"),
                    F.lit(f"{CRLF}X-Page-Id: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(CRLF * 2))
    key = F.concat(F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(" "), url, F.lit(" "), digest(html))
    head = F.concat_ws(CRLF, F.lit("WARC/1.1"), F.lit("WARC-Type: response"), F.concat(F.lit("WARC-Record-ID: "), uuid_of(key)),
                       F.concat(F.lit("WARC-Target-URI: "), url), F.lit(f"WARC-Date: {date}"),
                       F.concat(F.lit("WARC-Block-Digest: "), digest(F.concat(http, html))), F.concat(F.lit("WARC-Payload-Digest: "), digest(html)),
                       F.lit("Content-Type: application/http; msgtype=response"),
                       F.concat(F.lit("Content-Length: "), F.octet_length(F.concat(http, html)).cast("string")))
    return pages.select(F.col("page_id").alias("key"), F.concat(head, F.lit(CRLF * 2), http, html, F.lit(CRLF * 2)).alias("record"))


def _field(head: Column, folded: Column, name: str) -> Column:
    """A header field, found in the head with A-Z lower-cased and a line end before its first line."""
    at = F.locate(f"{CRLF}{name.lower()}:", folded)
    return F.when(at > 0, F.trim(F.substring_index(F.substr(head, at + len(name) + 1), CRLF, 1))).otherwise("")


def _entities(t: Column) -> Column:
    """Entities decoded; looking for one costs much less than replacing it."""
    pairs = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in ENTITIES])
    return F.aggregate(pairs, t, lambda t, e: F.when(t.contains(e.a), F.replace(t, e.a, e.b)).otherwise(t))


def _trimmed(t: Column) -> Column:
    # "$" also stands before a closing U+0085, U+2028 or U+2029: white space before it goes as well
    closed = t.endswith("\u0085") | t.endswith("\u2028") | t.endswith("\u2029")
    return F.when(closed, F.regexp_replace(t, r"^[ \n]+|[ \n]+$", "")).otherwise(F.btrim(t, F.lit(" \n")))


def plain_text(html: Column) -> Column:
    # every pass over the text costs much: white space is mapped along with the dropped parts, its runs collapse once, at the end
    t = F.regexp_replace(html, DROPPED_OR_SPACE, " ")
    t = F.regexp_replace(F.regexp_replace(t, BREAKS, "\n"), TAGS, "")
    t = F.regexp_replace(_entities(t), RUNS, "$1$2")
    return F.transform(F.array(t), _trimmed)[0]  # the lambda's variable: t is computed once for all its uses


def parsed(records: DataFrame) -> DataFrame:
    """key, the fields of the WARC header, HTTP header and payload of response records."""
    r = F.coalesce("record", F.lit(""))
    cut = F.locate(CRLF * 2, r)
    head = F.when(cut > 0, F.substr(r, F.lit(1), cut - 1)).otherwise(F.lit(""))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    d = records.select("key", head.alias("head"), F.concat(F.lit(CRLF), F.translate(head, upper, upper.lower())).alias("folded"), F.when(cut > 0, F.substr(r, cut + 4)).otherwise(F.lit("")).alias("rest"))
    # the record ends with two line ends that are no part of the block
    block = F.when(F.col("rest").endswith(CRLF * 2), F.substr("rest", F.lit(1), F.length("rest") - 4)).otherwise(F.col("rest"))
    d = d.select("key", "head", "folded", block.alias("block"))
    cut = F.locate(CRLF * 2, F.col("block"))
    return d.select(
        "key", F.filter(F.split("head", CRLF), lambda x: x.contains(":")).alias("warc"), _field(F.col("head"), F.col("folded"), "WARC-Record-ID").alias("refers_to"), _field(F.col("head"), F.col("folded"), "WARC-Target-URI").alias("target_uri"),
        _field(F.col("head"), F.col("folded"), "WARC-Date").alias("date"), _field(F.col("head"), F.col("folded"), "WARC-Payload-Digest").alias("payload_digest"),
        _field(F.col("head"), F.col("folded"), "WARC-Block-Digest").alias("source_block_digest"),
        F.when(cut > 0, F.substr("block", F.lit(1), cut - 1)).otherwise(F.lit("")).alias("http"),
        F.when(cut > 0, F.substr("block", cut + 4)).otherwise(F.col("block")).alias("payload"))


def derive(records: DataFrame) -> DataFrame:
    """Two records per response: key, warc_type, record_id, refers_to, target_uri, date, content_type, block, digests, record."""
    p = parsed(records)
    status = F.regexp_extract("http", r"^HTTP/\S+ +(\d+)", 1)
    http = F.filter(F.split("http", CRLF), lambda x: x.contains(":"))
    lines = F.transform(http, lambda x: F.concat(F.lit("http-"), x))
    source = F.concat(F.transform("warc", lambda x: F.concat(F.lit("X-Source-"), x)), F.transform(http, lambda x: F.concat(F.lit("X-Source-HTTP-"), x)))
    holds = F.when(F.col("payload_digest").rlike("^sha256:[0-9a-f]{64}$"), (digest(F.col("payload")) == F.col("payload_digest")).cast("string")).otherwise("unknown")
    links = F.transform(F.regexp_extract_all("payload", F.lit(LINKS), 1), lambda x: F.concat(F.lit("outlink: "), x))
    title = F.trim(F.regexp_replace(F.regexp_extract("payload", TITLE, 1), r"\s+", " "))
    fields = F.concat(F.array(F.concat(F.lit("http-status: "), status)), lines, F.array(
        F.concat(F.lit("source-block-digest: "), F.col("source_block_digest")), F.concat(F.lit("source-payload-digest: "), F.col("payload_digest")),
        F.concat(F.lit("payload-digest-holds: "), holds),
        F.concat(F.lit("title: "), title)), links)
    kinds = F.array(
        F.struct(F.lit("metadata").alias("warc_type"), F.lit("application/warc-fields").alias("content_type"), F.concat(F.array_join(fields, CRLF), F.lit(CRLF)).alias("block")),
        F.struct(F.lit("conversion").alias("warc_type"), F.lit("text/plain; charset=utf-8").alias("content_type"), plain_text(F.col("payload")).alias("block")))
    d = p.select("key", "refers_to", "target_uri", "date", "payload_digest", F.array_join(source, CRLF).alias("source"), F.explode(kinds).alias("k")).select("*", "k.*").drop("k")
    d = d.withColumn("record_id", uuid_of(F.concat("refers_to", F.lit(" "), "warc_type"))).withColumn("block_digest", digest(F.col("block"))) \
        .withColumn("content_length", F.octet_length("block").cast("long"))
    head = F.concat_ws(CRLF, F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), "warc_type"), F.concat(F.lit("WARC-Record-ID: "), "record_id"),
                       F.concat(F.lit("WARC-Refers-To: "), "refers_to"), F.concat(F.lit("WARC-Target-URI: "), "target_uri"),
                       F.concat(F.lit("WARC-Date: "), "date"), F.concat(F.lit("WARC-Block-Digest: "), "block_digest"), F.nullif("source", F.lit("")),
                       F.concat(F.lit("Content-Type: "), "content_type"), F.concat(F.lit("Content-Length: "), F.col("content_length").cast("string")))
    return d.withColumn("record", F.concat(head, F.lit(CRLF * 2), "block", F.lit(CRLF * 2))).drop("source")


def _members(batches):
    for b in batches:
        for r in b.column(0).to_pylist():
            yield pa.RecordBatch.from_arrays([pa.array([gzip.compress((r or "").encode(), mtime=0)], pa.binary())], names=["member"])


def write_warc(records: DataFrame, path: str | None = None) -> str:
    """Store records as gzip members (a column ``member`` of bytes, in order per file; joined they are a .warc.gz)."""
    path = path or shared_dir(records.sparkSession, "warc")
    records.select("record").mapInArrow(_members, "member binary").write.parquet(path)
    return path


def op3_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = derive(responses(table(spark, sf_dir, "pages")))
    return d.select(F.col("key").alias("page_id"), "warc_type", "record_id", "refers_to", "target_uri", "date", "content_type", "content_length",
                    "block_digest", "payload_digest", F.sha2("record", 256).alias("record_sha256"))


def _sql() -> str:
    q = lambda s: "'" + s.replace("'", "''") + "'"
    nl = "(chr(13) || chr(10))"
    uid = lambda c: f"'<urn:uuid:' || regexp_replace(md5({c}), '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})$', '\\1-\\2-\\3-\\4-\\5') || '>'"
    text = f"regexp_replace(html, {q(DROPPED)}, ' ', 'g')"
    text = f"regexp_replace(regexp_replace({text}, '\\s+', ' ', 'g'), {q(BREAKS)}, chr(10), 'g')"
    text = f"regexp_replace({text}, {q(TAGS)}, '', 'g')"
    for a, b in ENTITIES:
        text = f"replace({text}, {q(a)}, {q(b)})"
    text = f"regexp_replace({text}, '[ \\t]+', ' ', 'g')"
    text = f"regexp_replace(regexp_replace({text}, ' ?\\n[ \\n]*', chr(10), 'g'), '^[ \\n]+|[ \\n]+$', '', 'g')"
    return f"""
WITH p AS (SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html FROM pages),
h AS (SELECT *, 'Content-Type: text/html; charset=utf-8' AS h1, 'Content-Length: ' || strlen(html) AS h2,
             'X-Page-Id: ' || coalesce(CAST(page_id AS VARCHAR), '') AS h3, 'sha256:' || sha256(html) AS payload_digest,
             {uid("coalesce(CAST(page_id AS VARCHAR), '') || ' ' || url || ' sha256:' || sha256(html)")} AS refers_to FROM p),
s AS (SELECT *, 'sha256:' || sha256('HTTP/1.1 200 OK' || {nl} || h1 || {nl} || h2 || {nl} || h3 || {nl} || {nl} || html) AS source_digest,
             regexp_extract_all(html, {q(LINKS)}, 1) AS links,
             trim(regexp_replace(regexp_extract(html, {q(TITLE)}, 1), '\\s+', ' ', 'g')) AS title,
             strlen('HTTP/1.1 200 OK' || {nl} || h1 || {nl} || h2 || {nl} || h3 || {nl} || {nl} || html) AS source_length FROM h),
x AS (SELECT *, array_to_string(list_concat(list_transform(['WARC-Type: response', 'WARC-Record-ID: ' || refers_to, 'WARC-Target-URI: ' || url, 'WARC-Date: {DATE}',
                 'WARC-Block-Digest: ' || source_digest, 'WARC-Payload-Digest: ' || payload_digest, 'Content-Type: application/http; msgtype=response',
                 'Content-Length: ' || source_length], lambda x: 'X-Source-' || x), ['X-Source-HTTP-' || h1, 'X-Source-HTTP-' || h2, 'X-Source-HTTP-' || h3]), {nl}) AS source FROM s),
k AS (SELECT page_id, url, refers_to, payload_digest, source, 'metadata' AS warc_type, 'application/warc-fields' AS content_type,
             array_to_string(list_concat(['http-status: 200', 'http-' || h1, 'http-' || h2, 'http-' || h3,
                 'source-block-digest: ' || source_digest, 'source-payload-digest: ' || payload_digest, 'payload-digest-holds: true', 'title: ' || title],
                 list_transform(links, lambda x: 'outlink: ' || x)), {nl}) || {nl} AS block FROM x
      UNION ALL
      SELECT page_id, url, refers_to, payload_digest, source, 'conversion', 'text/plain; charset=utf-8', {text} FROM x),
r AS (SELECT *, {uid("refers_to || ' ' || warc_type")} AS record_id, 'sha256:' || sha256(block) AS block_digest, CAST(strlen(block) AS BIGINT) AS content_length FROM k)
SELECT page_id, warc_type, record_id, refers_to, trim(url) AS target_uri, '{DATE}' AS date, content_type, content_length, block_digest, payload_digest,
       sha256('WARC/1.1' || {nl} || 'WARC-Type: ' || warc_type || {nl} || 'WARC-Record-ID: ' || record_id || {nl} || 'WARC-Refers-To: ' || refers_to || {nl} ||
              'WARC-Target-URI: ' || trim(url) || {nl} || 'WARC-Date: {DATE}' || {nl} || 'WARC-Block-Digest: ' || block_digest || {nl} || source || {nl} ||
              'Content-Type: ' || content_type || {nl} || 'Content-Length: ' || content_length || {nl} || {nl} || block || {nl} || {nl}) AS record_sha256
FROM r
"""


OP3_SQL = _sql()
