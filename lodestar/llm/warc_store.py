"""Content-addressed WARC archive (operator 10).

Two tables make an archive.  ``payloads`` stores every distinct payload once,
keyed by its SHA-256; ``headers`` stores, per record, the exact bytes that
precede the payload (WARC header block and HTTP header) and the payload key.
``read_archive`` checks each stored payload against its key and joins the two
tables back; the original record is header, payload (not for a revisit) and
the closing blank lines.

Defined cases: a null html is the empty payload; a null url leaves
``WARC-Target-URI`` out; an empty url, or one with control characters or spaces, is percent-encoded as a whole
and marked so, and reads back as it was; a null
page_id leaves ``X-Page-ID`` out and such a record is a revisit whenever
another record of that payload has an id.  Of equal payloads of at least
``min_bytes`` bytes the record(s) with the largest page_id are ``response``,
all others ``revisit``; smaller payloads are all ``response``.  Repeated rows
give one record each.  Other input columns are ignored.  An empty table gives
an empty archive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the WARC and HTTP formats and of RFC 4648 base32.
WARC_VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_CONV32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
CRLF = "\r\n"


def base32_of_hex(h: Column, n_hex: int = 40) -> Column:
    """Base32 of a hex string whose bytes are a multiple of five (SHA-1: 20)."""
    parts = [F.lpad(F.conv(F.substring(h, i + 1, 10), 16, 32), 8, "0") for i in range(0, n_hex, 10)]
    return F.translate(F.concat(*parts), _CONV32, BASE32)


def _uuid(seed: Column) -> Column:
    h = F.md5(seed)
    return F.concat(F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-"), F.substring(h, 13, 4),
                    F.lit("-"), F.substring(h, 17, 4), F.lit("-"), F.substring(h, 21, 12))


def _record_uuid(page: Column, key: Column) -> Column:
    return _uuid(F.concat_ws("|", F.coalesce(page.cast("string"), F.lit("-")), key).cast("binary"))


def _odd_url(url: Column) -> Column:
    """Whether a header cannot hold the url as it is: it is empty or has control characters or spaces."""
    return (url == "") | F.regexp_like(url, F.lit("[\\x00-\\x20\\x7F]"))


def _safe_url(url: Column) -> Column:
    """The url, or where a header cannot hold it, all of it percent-encoded, each byte and the sign itself."""
    return F.when(_odd_url(url), F.replace(F.url_encode(url), F.lit("+"), F.lit("%20"))).otherwise(url)


def _field(name: str, value: Column) -> Column:
    """``name: value`` and a line end, or nothing for a null value."""
    return F.when(value.isNotNull(), F.concat(F.lit(name + ": "), value, F.lit(CRLF))).otherwise(F.lit(""))


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                  html_col: str = "html", min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write the two tables of the archive under ``path``.

    Copies of one payload may be a third of all rows: grouping by digest
    combines on the map side, and the join that brings each group's largest id
    back to its records carries narrow rows only (AQE splits a hot digest).
    """
    body = F.coalesce(F.encode(F.col(html_col), "UTF-8"), F.lit("").cast("binary"))
    p = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                     body.alias("payload"))
    keyed = p.withColumn("blob", F.sha2("payload", 256))

    # 1. one copy of each payload, keyed by digest
    (keyed.groupBy("blob").agg(F.first("payload").alias("payload"))
     .write.parquet(f"{path}/payloads"))

    # 2. exact headers, one per record
    narrow = keyed.select("page_id", "url", "blob", F.octet_length("payload").cast("bigint").alias("n"),
                          F.sha1("payload").alias("sha1"))
    last = (narrow.filter(F.col("n") >= min_bytes).groupBy("blob")
            .agg(F.max("page_id").alias("last_id")).filter(F.col("last_id").isNotNull()))
    recs = narrow.join(last, "blob", "left")
    revisit = F.col("last_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last_id"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.col("n").cast("string"), F.lit(CRLF * 2))
    block_len = F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(F.col("n"))
    header = F.concat(
        F.lit(f"{WARC_VERSION}{CRLF}"),
        _field("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        _field("WARC-Record-ID", F.concat(F.lit("<urn:uuid:"), _record_uuid(F.col("page_id"), F.col("blob")),
                                          F.lit(">"))),
        _field("WARC-Date", F.lit(date)),
        _field("WARC-Target-URI", _safe_url(F.col("url"))),
        _field("X-Target-URI-Encoded", F.when(_odd_url(F.col("url")), F.lit("yes"))),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32_of_hex(F.col("sha1")))),
        _field("WARC-Profile", F.when(revisit, F.lit(REVISIT_PROFILE))),
        _field("WARC-Refers-To", F.when(revisit, F.concat(
            F.lit("<urn:uuid:"), _record_uuid(F.col("last_id"), F.col("blob")), F.lit(">")))),
        _field("X-Refers-To-Page-ID", F.when(revisit, F.col("last_id").cast("string"))),
        _field("X-Page-ID", F.col("page_id").cast("string")),
        _field("Content-Type", F.lit("application/http;msgtype=response")),
        _field("Content-Length", block_len.cast("string")),
        F.lit(CRLF), http)
    recs.select(F.encode(header, "UTF-8").alias("header"), "blob").write.parquet(f"{path}/headers")


def _get(name: str) -> Column:
    v = F.regexp_extract(F.col("head"), f"(?:^|\\n){name}: ([^\\r]*)\\r\\n", 1)
    return F.when(v != "", v)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Reconstruct the records: fields parsed from the stored headers, facts of
    the stored payload, ``payload`` itself and ``record`` (the exact WARC bytes).

    A payload that no longer matches its key raises an error, and so does a record whose payload is
    not there.  ``payload_bytes``
    and ``payload_digest`` are computed from the stored payload bytes before the
    join, so a reader that selects only those moves no payload.
    """
    blobs = spark.read.schema("blob string, payload binary").parquet(f"{path}/payloads").select(
        F.when(F.sha2("payload", 256) == F.col("blob"), F.col("blob"))
        .otherwise(F.raise_error(F.concat(F.lit("payload does not match its digest "), "blob"))).alias("blob"),
        "payload", F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        base32_of_hex(F.sha1("payload")).alias("payload_digest"))
    heads = spark.read.schema("header binary, blob string").parquet(f"{path}/headers")
    recs = heads.withColumn("head", F.decode("header", "UTF-8")).select(
        "blob", "header",
        _get("X-Page-ID").cast("bigint").alias("page_id"),
        _get("WARC-Type").alias("record_type"),
        _get("X-Refers-To-Page-ID").cast("bigint").alias("refers_to"),
        F.when(_get("X-Target-URI-Encoded").isNull(), _get("WARC-Target-URI"))
        .otherwise(F.url_decode(F.coalesce(_get("WARC-Target-URI"), F.lit("")))).alias("url"),
        F.substring_index(_get("WARC-Payload-Digest"), ":", -1).alias("declared_digest"))
    tail = F.lit(CRLF * 2).cast("binary")
    none = F.lit("").cast("binary")
    lost = F.raise_error(F.concat(F.lit("no payload with digest "), F.col("blob")))
    both = recs.join(blobs, "blob", "left")
    both = both.withColumns({c: F.when(F.col("payload_bytes").isNull(), lost).otherwise(F.col(c))
                             for c in ("payload", "payload_bytes", "payload_digest")})
    whole = F.concat(F.col("header"), F.when(F.col("record_type") == "response", F.col("payload")).otherwise(none), tail)
    return both.withColumn("record", F.when(F.col("payload_bytes") >= 0, whole))  # of a revisit too: it looks its payload up
