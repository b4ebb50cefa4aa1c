"""Keys, positions and other text codecs as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hex16(number: Column) -> Column:
    """Fixed-width lower-case hex, so that text order is number order."""
    return F.lpad(F.lower(F.hex(number)), 16, "0")


def position(major: Column, minor: Column) -> Column:
    """A feed position: two fixed-width numbers, major first."""
    return F.concat(hex16(major), hex16(minor))


def unhex16(text: Column) -> Column:
    return F.conv(text, 16, 10).cast("long")


def decode_position(text: Column) -> tuple[Column, Column]:
    return unhex16(F.substring(text, 1, 16)), unhex16(F.substring(text, 17, 16))


def custody_key(document_uid: Column, batch: Column, index: Column, sha256: Column) -> Column:
    return F.concat_ws("/", F.lit("documents"), document_uid, F.lit("files"), batch, index, sha256)


def percent_encoded(text: Column) -> Column:
    """RFC 3986 percent-encoding of all but unreserved characters (url_encode writes forms: a space as '+')."""
    return F.replace(F.replace(F.replace(F.url_encode(text), F.lit("+"), F.lit("%20")), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def bucket_and_key(url: Column) -> tuple[Column, Column, Column]:
    """bucket, key and whether the URL is a plain s3://bucket/key without query or fragment."""
    ok = url.rlike(r"^s3://[^/?#]+/[^?#]+$")
    return F.regexp_extract(url, r"^s3://([^/?#]+)/", 1), F.regexp_extract(url, r"^s3://[^/?#]+/(.*)$", 1), ok


def html_escaped(text: Column) -> Column:
    out = text
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def squeezed(text: Column) -> Column:
    """Without white space, Unicode's included: for equality of answers that differ in layout only."""
    return F.regexp_replace(text, r"(?U)\s+", "")
