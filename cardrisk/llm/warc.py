"""A content-addressed WARC archive: payload bytes once, exact record headers apart, records put together by joins.

An archive is a folder of two tables. ``payloads`` holds the bytes of each distinct payload under its SHA-256, ``headers``
one row per record with everything that comes before the payload, byte for byte: the WARC header and the HTTP head of the
block. Records that share a payload are one ``response``, that of the greatest row, and ``revisit`` records without bytes
of their own. Reading checks every stored payload against its key and joins it to the headers; a record's length and
digest are then those that its header states.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardrisk.llm import bloom
from cardrisk.operators.sizing import left_join_dim
from cardrisk.session import materialise

# ---- fixed values: what a record says ------------------------------------------------------
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
EPOCH = "1970-01-01T00:00:00Z"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
# --------------------------------------------------------------------------------------------

#: Digits as ``conv`` writes a number to base 32.
CONV32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
#: Payloads with more records than this share of all are joined by themselves, at most a thousand of them.
BROADCAST_ROWS = 1_000


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: five hexadecimal digits make four of base 32."""
    digest = F.sha1(payload)
    fours = [F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*fours), CONV32, BASE32)


def _field(value: Column) -> Column:
    """A value that fits on a header line: control characters, spaces and per cent signs before them are escaped."""
    for mark, written in (("\r", "%0D"), ("\n", "%0A"), ("\t", "%09"), (" ", "%20")):
        value = F.replace(value, F.lit(mark), F.lit(written))
    return value


def _record_id(row: Column, url: Column, copy: Column) -> Column:
    """Unique among the records of an archive: the row's id, its URL and which of its exact copies it is."""
    return F.concat(F.lit("<urn:page:"), F.coalesce(row.cast("string"), F.lit("")), F.lit(":"),
                    F.substring(F.sha2(F.coalesce(F.concat(F.lit("u"), url), F.lit("")), 256), 1, 16), F.lit(":"),
                    copy.cast("string"), F.lit(">"))


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """One row per record, without payload bytes: id, url, copy, digest, sha1, bytes, and the record it refers to.

    Exact copies of a row are told apart by a number, so that each has a record of its own. Of the records of a payload
    the one with the greatest (id, url, copy) is the response; a null is less than any value.
    """
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary")
    slim = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.sha2(payload, 256).alias("digest"),
        base32_sha1(payload).alias("sha1"), F.octet_length(payload).cast("long").alias("bytes"))
    counted = slim.groupBy("id", "url", "digest", "sha1", "bytes").agg(F.count("*").alias("copies"))
    counted = materialise(counted)
    first = counted.groupBy("digest").agg(
        F.max(F.struct("id", "url", "copies")).alias("of"), F.sum("copies").alias("records"))
    shared = materialise(first.filter("records > 1"))
    joined = left_join_dim(counted, shared, "digest", weight="records", max_rows=BROADCAST_ROWS)
    every = joined.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    own, other = _record_id(F.col("id"), F.col("url"), F.col("copy")), _record_id(F.col("of.id"), F.col("of.url"), F.col("of.copies"))
    return every.select("id", "url", "digest", "sha1", "bytes", own.alias("record_id"),
                        F.when(F.col("of").isNotNull() & (own != other), other).alias("refers_to"),
                        F.when(F.col("of").isNotNull() & (own != other), F.col("of.id")).alias("refers_id"))


def header_text(date: str = EPOCH) -> Column:
    """The exact bytes in front of a record's payload, from the columns of ``records``."""
    revisit = F.col("refers_to").isNotNull()
    size = F.when(revisit, F.lit(len(HTTP_HEAD))).otherwise(F.col("bytes") + len(HTTP_HEAD))

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))

    nothing = F.lit("")
    return F.concat(
        F.lit(VERSION + "\r\n"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", F.col("record_id")),
        line("WARC-Date", F.lit(date)),
        F.coalesce(line("WARC-Target-URI", _field(F.col("url"))), nothing),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.coalesce(line("WARC-Refers-To", F.col("refers_to")), nothing),
        F.when(revisit, line("WARC-Profile", F.lit(REVISIT_PROFILE))).otherwise(nothing),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", size.cast("string")),
        F.lit("\r\n" + HTTP_HEAD),
    )


def write(pages: DataFrame, archive: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
          date: str = EPOCH) -> None:
    """Writes the archive of a table of pages.

    A null payload is empty, and an empty one is stored like any other. Null ids and URLs give records without them;
    repeated rows have a record each; other columns are not read. An empty table gives two empty tables. Payloads that
    only one record has, told by a Bloom filter of the others' digests, are written where they are; only those that may
    be shared are shuffled, combined before the shuffle, so that a payload of a third of all rows is one row a task.
    """
    spark = pages.sparkSession
    found = materialise(records(pages, id_col, url_col, payload_col))
    text = header_text(date).cast("binary")
    found.select("id", "digest", text.alias("header")).write.mode("overwrite").parquet(f"{archive}/headers")

    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary")
    stored = pages.select(payload.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    shared = found.groupBy("digest").agg(F.count("*").alias("n")).filter("n > 1").select("digest")
    shared = materialise(shared)
    flagged = bloom.probe(stored, F.col("digest"), bloom.build(shared, "digest", shared.count()), "maybe")
    single = flagged.filter("not maybe").select("digest", "payload")
    several = flagged.filter("maybe").groupBy("digest").agg(F.first("payload").alias("payload"))
    single.unionByName(several).write.mode("overwrite").parquet(f"{archive}/payloads")


def _stated(name: str) -> Column:
    """A named field of a record's header; null where it has none."""
    return F.nullif(F.regexp_extract(F.col("head"), rf"(?md)^{name}: ([^\r\n]*)", 1), F.lit(""))


def read(spark: SparkSession, archive: str) -> DataFrame:
    """Every record of an archive: id, its header's fields, header bytes and the full payload.

    Raises where a stored payload is not what its key says, a payload is missing, or a record's stated digest or length
    is not that of its payload. A revisit has the payload of its response. Payloads of more than a thousandth of all
    records are spread over many tasks.
    """
    headers = spark.read.parquet(f"{archive}/headers")
    payloads = spark.read.parquet(f"{archive}/payloads")
    records_of = materialise(headers.groupBy("digest").agg(F.count("*").alias("records")))
    total = records_of.agg(F.sum("records")).first()[0] or 0
    hot = records_of.filter(F.col("records") > total / BROADCAST_ROWS).select(
        "digest", F.greatest(F.ceil(F.col("records") * BROADCAST_ROWS / max(total, 1)), F.lit(1)).cast("int").alias("salts"))
    # At most a thousand digests, each with as many salts as it has thousandths of the records.
    hot = F.broadcast(hot)
    spread = F.pmod(F.xxhash64("header"), F.coalesce("salts", F.lit(1))).cast("int")
    left = headers.join(hot, "digest", "left").select("id", "header", "digest", spread.alias("salt"))
    salts = F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)
    checked = F.when(F.sha2("payload", 256) == F.col("digest"), F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("payload is not what its digest says: "), F.col("digest"))))
    stored = payloads.select("digest", checked.alias("payload"), base32_sha1(F.col("payload")).alias("sha1")).join(hot, "digest", "left")
    right = stored.select("digest", F.explode(salts).alias("salt"), "payload", "sha1")
    joined = left.join(right, ["digest", "salt"], "left").withColumn("head", F.col("header").cast("string"))
    fields = joined.select(
        "id", "header", "payload", "sha1", _stated("WARC-Type").alias("record_type"), _stated("WARC-Record-ID").alias("record_id"),
        _stated("WARC-Target-URI").alias("url"), _stated("WARC-Refers-To").alias("refers_to"),
        F.substring(_stated("WARC-Payload-Digest"), 6, 32).alias("payload_digest"), _stated("Content-Length").cast("long").alias("size"))
    size = len(HTTP_HEAD) + F.when(F.col("record_type") == "response", F.octet_length("payload")).otherwise(0)
    sound = (F.col("sha1") == F.col("payload_digest")) & (F.col("size") == size)
    fault = F.raise_error(F.concat(F.lit("record does not match its payload: "), F.col("record_id")))
    return fields.select("id", "record_id", "record_type", "url", "refers_to", "payload_digest", "header",
                         F.when(F.coalesce(sound, F.lit(False)), F.col("payload")).otherwise(fault).alias("payload"))


def record_bytes(read_back: DataFrame) -> DataFrame:
    """record_id and the record as a WARC file holds it; a revisit ends with its HTTP head."""
    body = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    return read_back.select("record_id", F.concat("header", body, F.lit(b"\r\n\r\n")).alias("record"))


def digest(read_back: DataFrame) -> DataFrame:
    """Per record: page_id, payload_bytes, payload_digest, record_type and the page that a revisit refers to."""
    of = F.nullif(F.regexp_extract("refers_to", r"^<urn:page:([^:]*):", 1), F.lit(""))
    kind = read_back.schema["id"].dataType
    return read_back.select(F.col("id").alias("page_id"), F.octet_length("payload").cast("long").alias("payload_bytes"),
                            "payload_digest", "record_type", of.cast(kind).alias("refers_to"))
