"""WARC derivatives: each response becomes a metadata record and a plain-text conversion record that refer to it.

Record ids are derived from the source record's id, so a repeated run gives the same records and links.  Everything is a
projection of one row: no shuffle.  Character references are decoded in Python, the rest by DataFrame functions.
"""

from __future__ import annotations

import html as markup
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerwise.llm.common import small_batches

# fixed values: elements whose content is not text, elements that end a line, what may be a character reference
BLOCK_TAGS = "address|article|aside|blockquote|body|br|div|dl|dt|dd|footer|form|h1|h2|h3|h4|h5|h6|head|header|hr|html|li|main|nav|ol|p|pre|section|table|title|td|th|tr|ul"
REFERENCE = re.compile(r"&(?:#0*([0-9]+);?|#[xX]0*([0-9a-fA-F]+);?|[a-zA-Z][a-zA-Z0-9]*;?)")
STEPS = [(r"(?s)<!--.*?-->", ""), (r"(?is)<script\b.*?</script\s*>", ""), (r"(?is)<style\b.*?</style\s*>", ""),
         (rf"(?i)</?(?:{BLOCK_TAGS})\b[^>]*>", "\n"), (r"<[^>]*>", "")]
SPACES = [(r"[ \t\r\f]+", " "), (r" ?\n[ \n]*", "\n"), (r"^[ \n]+", ""), (r"[ \n]+$", "")]
EPOCH = "1970-01-01T00:00:00Z"
CRLF = "\r\n"


def _character(found: re.Match) -> str:
    """What a character reference stands for by the HTML rules; a no-break space becomes a space.  Unknown names stay."""
    number, base = (found[1], "") if found[1] else (found[2], "x")
    if number and len(number) > 7:  # beyond the last character, whatever the digits
        return "\ufffd"
    return markup.unescape(f"&#{base}{number};" if number else found[0]).replace("\xa0", " ")


def decode(texts: pa.Array) -> pa.Array:
    """Texts with every named and numeric character reference decoded, once."""
    return pa.array([t if t is None or "&" not in t else REFERENCE.sub(_character, t) for t in texts.to_pylist()], pa.string())


def plain_text(html: Column) -> Column:
    out = F.coalesce(html, F.lit(""))
    for pattern, to in STEPS:
        out = F.regexp_replace(out, pattern, to)
    out = F.arrow_udf(decode, "string")(out)
    for pattern, to in SPACES:
        out = F.regexp_replace(out, pattern, to)
    return out


def record_id(*parts: Column) -> Column:
    h = F.md5(F.concat_ws("\x1f", *parts))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                                                     F.substring(h, 17, 4), F.substring(h, 21, 12)), F.lit(">"))


def digest(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(text, 256))


def _one_line(value: Column) -> Column:
    """A header value holds no line break."""
    return F.replace(F.replace(F.coalesce(value, F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def responses(pages: DataFrame) -> DataFrame:
    """Response records from raw pages (page_id, url, html); a page carries no headers or date of its own."""
    return pages.select("page_id", record_id(F.lit("response"), F.coalesce(F.col("page_id").cast("string"), F.lit("")),
                                             F.coalesce("url", F.lit(""))).alias("record_id"),
                        F.col("url").alias("target_uri"), F.lit(EPOCH).alias("date"), F.lit("text/html; charset=UTF-8").alias("content_type"),
                        F.create_map(F.lit("Content-Type"), F.lit("text/html; charset=UTF-8")).alias("headers"), F.col("html").alias("payload"))


def derivatives(source: DataFrame) -> DataFrame:
    """Two records per response: kind 'metadata' and 'conversion'.

    ``source`` needs page_id, record_id, target_uri, date, headers (map) and payload.  Returns page_id, kind, record_id,
    refers_to (the response), concurrent_to (the other derivative), target_uri, date, content_type, block,
    block_digest, payload_digest (of the response), content_length (bytes of the block) and record (the whole WARC
    record: header lines, empty line, block; the two line ends after it are the writer's separator).
    Null payload counts as empty, null address as empty, null headers as none; line breaks in header values are percent-encoded.
    Repeated rows give repeated records.  Other columns are ignored.  Empty table: empty result.
    """
    small_batches(source.sparkSession)
    uri, day = _one_line(F.col("target_uri")), _one_line(F.coalesce("date", F.lit(EPOCH)))
    payload = F.coalesce("payload", F.lit(""))
    fields = F.array_join(F.transform(F.array_sort(F.map_entries(F.coalesce("headers", F.expr("map()").cast("map<string,string>")))),
                                      lambda e: F.concat(F.lit("source-header: "), _one_line(e["key"]), F.lit(": "), _one_line(e["value"]), F.lit(CRLF))), "")
    about = F.concat(fields, F.lit("source-length: "), F.octet_length(payload).cast("string"), F.lit(CRLF),
                     F.lit("source-digest: "), digest(payload), F.lit(CRLF))
    ids = {k: record_id(F.lit(k), F.col("record_id")) for k in ("metadata", "conversion")}
    rec = lambda kind, other, what, block: F.struct(F.lit(kind).alias("kind"), ids[kind].alias("record_id"), ids[other].alias("concurrent_to"),
                                                    F.lit(what).alias("content_type"), block.alias("block"))
    both = F.array(rec("metadata", "conversion", "application/warc-fields", about),
                   rec("conversion", "metadata", "text/plain; charset=UTF-8", plain_text(F.col("payload"))))
    x = source.select("page_id", F.col("record_id").alias("refers_to"), uri.alias("target_uri"), day.alias("date"),
                      digest(payload).alias("payload_digest"), F.explode(both).alias("r"))
    x = x.select("page_id", "r.kind", "r.record_id", "refers_to", "r.concurrent_to", "target_uri", "date", "r.content_type", "r.block",
                 digest(F.col("r.block")).alias("block_digest"), "payload_digest", F.octet_length("r.block").cast("long").alias("content_length"))
    head = [("WARC-Type", "kind"), ("WARC-Record-ID", "record_id"), ("WARC-Date", "date"), ("WARC-Target-URI", "target_uri"),
            ("WARC-Refers-To", "refers_to"), ("WARC-Concurrent-To", "concurrent_to"), ("WARC-Block-Digest", "block_digest"),
            ("Content-Type", "content_type"), ("Content-Length", "content_length")]
    lines = [x for name, c in head for x in (F.lit(f"{name}: "), F.col(c).cast("string"), F.lit(CRLF))]
    return x.withColumn("record", F.concat(F.lit("WARC/1.1" + CRLF), *lines, F.lit(CRLF), F.col("block")))


def write_warc(records: DataFrame, path: str) -> None:
    """Write whole records as WARC files, one per partition; a record ends with two line ends."""
    records.select("record").write.option("lineSep", CRLF + CRLF).text(path)
