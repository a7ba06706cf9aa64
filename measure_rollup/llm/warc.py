"""Derived WARC records: each response becomes a metadata and a plain-text conversion record.

A derived record keeps its response's identifier (``WARC-Refers-To``), address and date
(``WARC-Refers-To-Target-URI``, ``WARC-Refers-To-Date``) and has a digest of its own block. The
metadata record's block (``application/warc-fields``) holds the source's HTTP status and
headers, its block and payload digests, the page's title and its links. The conversion
record's block is the page's text: without head, comments, scripts and styles, a line for
each block element, entities decoded, white space collapsed. Identifiers follow
from the response, so a record that is derived again is the same record.

Everything is column expressions but one case: texts with an entity other than those in
``ENTITIES`` go through Python's table of all of them, in Arrow batches.

Files: ``write_records`` writes WARC files with Spark's text sink, whose line separator is
the end of a record; ``read_records`` reads such files in splits at the border of two records
and checks each block against its Content-Length.

Defined cases: null html is an empty page, an empty text and a record of length 0. A null
address leaves its headers out. Null page ids are part of the identifier as empty text.
Repeated rows give repeated records with the same identifier. Unclosed comments, scripts and
styles lose their tags only. Empty tables give empty results. Other columns are not read.
"""

from __future__ import annotations

import html as entities
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

DATE = "1970-01-01T00:00:00Z"  # of responses made from a table, which has no dates

# Patterns that Java's and RE2's regular expressions take alike.
HIDDEN = (
    r"(?is)<(?:!--.*?--|head\b.*?</head\s*|script\b.*?</script\s*|style\b.*?</style\s*"
    r"|noscript\b.*?</noscript\s*|template\b.*?</template\s*)>"
)
BLOCKS = (
    r"(?i)</?(?:address|article|aside|blockquote|br|dd|div|dl|dt|figcaption|figure|footer|form"
    r"|h[1-6]|header|hr|li|main|nav|ol|p|pre|section|table|td|th|tr|ul)(?:[\s/][^>]*)?>"
)
TAGS = r"<[a-zA-Z/!?][^>]*>"
TITLE = r"(?is)<title\b[^>]*>(.*?)</title\s*>"
# A link's value with its quotes, if it has any.
LINK = r"""(?i)\shref\s*=\s*("[^"]*"|'[^']*'|[^\s"'>][^\s>]*)"""
# Entities decoded by column expressions, in this order.
ENTITIES = {
    "&lt;": "<",
    "&gt;": ">",
    "&quot;": '"',
    "&apos;": "'",
    "&#39;": "'",
    "&nbsp;": "\u00a0",
    "&copy;": "\u00a9",
    "&middot;": "\u00b7",
    "&amp;": "&",
}
OTHER_ENTITY = "&(?!(?:" + "|".join(e[1:-1] for e in ENTITIES) + ");)(?:#|[a-zA-Z])"
SPACES = r"[ \t\f\r\x0B\x{A0}]{2,}|[\t\f\r\x0B\x{A0}]"  # all but what is a single space already
LINES = r" ?\n[ \n]*"
END = "\r\n\r\n"

RECORD = (
    "warc_type string, record_id string, refers_to string, target_uri string, warc_date string,"
    " content_type string, content_length long, block_digest string, payload_digest string,"
    " headers string, block string"
)


@F.pandas_udf(StringType())
def _all_entities(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield texts.map(entities.unescape, na_action="ignore")


def decoded(text: Column) -> Column:
    """Entities decoded once; ``&amp;`` last, so that what it guards is not decoded.

    ``text`` is used several times: it should be a column, not a long expression.
    """
    known = text
    for entity, sign in ENTITIES.items():
        known = F.replace(known, F.lit(entity), F.lit(sign))
    odd = text.rlike(OTHER_ENTITY)
    return F.when(odd, _all_entities(F.when(odd, text))).otherwise(known)


def collapsed(text: Column) -> Column:
    lines = F.regexp_replace(F.regexp_replace(text, SPACES, " "), LINES, "\n")
    return F.btrim(lines, F.lit(" \n"))


def without_markup(page: Column) -> Column:
    """The page's visible text, entities and white space as they are."""
    visible = F.regexp_replace(page, HIDDEN, "\n")
    return F.regexp_replace(F.regexp_replace(visible, BLOCKS, "\n"), TAGS, "")


def digest(block: Column) -> Column:
    """``sha1:`` and the digest in base 32, by eight digits at a time."""
    sha = F.sha1(block.cast("binary"))
    parts = (F.lpad(F.conv(F.substring(sha, at, 10), 16, 32), 8, "0") for at in (1, 11, 21, 31))
    digits, letters = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    return F.concat(F.lit("sha1:"), F.translate(F.concat(*parts), digits, letters))


def identifier(*parts: Column) -> Column:
    """A URN that follows from the parts; null parts are empty."""
    key = F.concat_ws("\n", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts))
    md5 = F.md5(key.cast("binary"))
    groups = (F.substring(md5, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *groups), F.lit(">"))


def _field(name: str, value: Column, end: str = "\r\n") -> Column:
    """A header line, or nothing for a null. Line ends inside a value would end the header."""
    flat = F.regexp_replace(value.cast("string"), r"[\r\n]+", " ")
    return F.coalesce(F.concat(F.lit(f"{name}: "), flat, F.lit(end)), F.lit(""))


def _length(text: Column) -> Column:
    return F.octet_length(text).cast("long")


def responses(pages: DataFrame, date: str = DATE) -> DataFrame:
    """Response records of pages (page_id, url, html), as a crawler would have stored them."""
    rows = pages.select(
        "page_id", F.col("url").alias("target_uri"), F.coalesce("html", F.lit("")).alias("payload")
    )
    rows = rows.withColumn("payload_digest", digest(F.col("payload")))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        _length(F.col("payload")).cast("string"),
        F.lit(END),
    )
    rows = rows.select(
        F.lit("response").alias("warc_type"),
        identifier(F.lit("response"), F.col("page_id"), F.col("target_uri"), F.col("payload_digest")).alias(
            "record_id"
        ),
        F.lit(None).cast("string").alias("refers_to"),
        "target_uri",
        F.lit(date).alias("warc_date"),
        F.lit("application/http; msgtype=response").alias("content_type"),
        "payload_digest",
        F.concat(http, "payload").alias("block"),
    )
    return _sealed(rows)


def _unquoted(value: Column) -> Column:
    quoted = F.startswith(value, F.lit('"')) | F.startswith(value, F.lit("'"))
    return F.when(quoted, F.substring(value, F.lit(2), F.length(value) - 2)).otherwise(value)


def _sealed(rows: DataFrame, *more: Column) -> DataFrame:
    """``rows`` with their block's length and digest, and the record's header lines."""
    rows = rows.withColumn("content_length", _length(F.col("block"))).withColumn(
        "block_digest", digest(F.col("block"))
    )
    headers = F.concat(
        F.lit("WARC/1.0\r\n"),
        _field("WARC-Type", F.col("warc_type")),
        _field("WARC-Record-ID", F.col("record_id")),
        _field("WARC-Date", F.col("warc_date")),
        _field("WARC-Target-URI", F.col("target_uri")),
        _field("WARC-Refers-To", F.col("refers_to")),
        _field("WARC-Refers-To-Target-URI", F.when(F.col("refers_to").isNotNull(), F.col("target_uri"))),
        _field("WARC-Refers-To-Date", F.when(F.col("refers_to").isNotNull(), F.col("warc_date"))),
        _field("WARC-Block-Digest", F.col("block_digest")),
        _field("WARC-Payload-Digest", F.col("payload_digest")),
        _field("Content-Type", F.col("content_type")),
        _field("Content-Length", F.col("content_length"), ""),
    )
    names = [column.split()[0] for column in RECORD.split(", ")]
    return rows.withColumn("headers", headers).select(*names)


def derivatives(records: DataFrame) -> DataFrame:
    """A metadata and a conversion record of each response among ``records``."""
    split = F.instr("block", END)
    rows = records.filter("warc_type = 'response'").select(
        F.col("record_id").alias("refers_to"),
        "target_uri",
        "warc_date",
        F.col("block_digest").alias("source_block"),
        F.col("payload_digest").alias("source_payload"),
        F.when(split > 0, F.expr("left(block, instr(block, '\\r\\n\\r\\n') - 1)"))
        .otherwise("")
        .alias("http"),
        F.when(split > 0, F.expr("substring(block, instr(block, '\\r\\n\\r\\n') + 4)"))
        .otherwise(F.col("block"))
        .alias("payload"),
    )
    # each step is a projection of its own, so that no pattern is searched for twice
    rows = rows.select(
        *(c for c in rows.columns if c != "payload"),
        F.regexp_extract("payload", TITLE, 1).alias("title"),
        F.array_distinct(F.transform(F.regexp_extract_all("payload", F.lit(LINK), 1), _unquoted)).alias("links"),
        without_markup(F.col("payload")).alias("text"),
    )
    rows = rows.withColumns({name: decoded(F.col(name)) for name in ("title", "text")})
    rows = rows.withColumns({name: collapsed(F.col(name)) for name in ("title", "text")})
    fields = F.concat(
        _field("refers-to", F.col("refers_to")),
        _field("source-block-digest", F.col("source_block")),
        _field("source-payload-digest", F.col("source_payload")),
        # the status line and the headers, each as a field of its own
        F.when(
            F.col("http") != "",
            F.concat(
                F.lit("http-status: "),
                F.regexp_replace(F.replace("http", F.lit("\r")), "\n", "\r\nhttp-header-"),
                F.lit("\r\n"),
            ),
        ).otherwise(""),
        _field("title", F.when(F.col("title") != "", F.col("title"))),
        F.concat_ws("", F.transform("links", lambda uri: _field("outlink", decoded_uri(uri)))),
    )
    kinds = F.array(
        F.struct(
            F.lit("metadata").alias("warc_type"),
            F.lit("application/warc-fields").alias("content_type"),
            fields.alias("block"),
        ),
        F.struct(
            F.lit("conversion").alias("warc_type"),
            F.lit("text/plain; charset=utf-8").alias("content_type"),
            F.col("text").alias("block"),
        ),
    )
    made = rows.select("refers_to", "target_uri", "warc_date", F.inline(kinds)).select(
        "warc_type",
        identifier(F.col("warc_type"), F.col("refers_to")).alias("record_id"),
        "refers_to",
        "target_uri",
        "warc_date",
        "content_type",
        F.lit(None).cast("string").alias("payload_digest"),
        "block",
    )
    return _sealed(made)


def decoded_uri(uri: Column) -> Column:
    """An address as it stands in an attribute: ampersands are the only entity used there."""
    return F.replace(uri, F.lit("&amp;"), F.lit("&"))


def write_records(records: DataFrame, path: str, compression: str = "none") -> None:
    """WARC files, one record after the other; ``compression='gzip'`` for .warc.gz files."""
    record = F.concat("headers", F.lit(END), "block").alias("value")
    records.select(record).write.option("lineSep", END).option("compression", compression).text(path)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Records of WARC files in the columns of ``RECORD``, and ``whole``: whether the block has its length.

    A block that itself holds the border of two records comes out short, with ``whole`` false.
    """
    border = f"{END}WARC/1.0\r\n"
    lines = spark.read.option("lineSep", border).option("recursiveFileLookup", True).text(path)
    rest = F.regexp_replace("value", r"^WARC/1.0\r\n", "")
    rows = lines.select(rest.alias("rest")).select(
        F.regexp_extract("rest", r"(?s)^(.*?)\r\n\r\n", 1).alias("head"),
        F.expr("substring(rest, instr(rest, '\\r\\n\\r\\n') + 4)").alias("block"),
    )

    def header(name: str) -> Column:
        found = F.regexp_extract("head", rf"(?im)^{name}:[ \t]*(.*?)[ \t]*$", 1)
        return F.when(found != "", found)

    length = header("Content-Length").cast("long")
    # the last record of a file keeps its end
    ended = F.when(
        (F.octet_length("block") == length + 4) & F.endswith("block", F.lit(END)),
        F.expr("left(block, length(block) - 4)"),
    ).otherwise(F.col("block"))
    return rows.select(
        header("WARC-Type").alias("warc_type"),
        header("WARC-Record-ID").alias("record_id"),
        header("WARC-Refers-To").alias("refers_to"),
        header("WARC-Target-URI").alias("target_uri"),
        header("WARC-Date").alias("warc_date"),
        header("Content-Type").alias("content_type"),
        length.alias("content_length"),
        header("WARC-Block-Digest").alias("block_digest"),
        header("WARC-Payload-Digest").alias("payload_digest"),
        F.concat(F.lit("WARC/1.0\r\n"), "head").alias("headers"),
        ended.alias("block"),
    ).withColumn("whole", F.coalesce(F.octet_length("block") == F.col("content_length"), F.lit(False)))
