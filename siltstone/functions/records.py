"""Record codec and row identities."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Partitions are 10^9 apart in a row id; a content id has eight decimal digits
# and uses the first ten characters of each field; a label shows 40 and 20 characters.
OFFSETS_PER_PARTITION = 10 ** 9
CONTENT_ID_RANGE = 10 ** 8
CONTENT_ID_PREFIX = 10
LABEL_FORMAT = "%8d | %-40s | %-20s"


def encode_payload(text: Column) -> Column:
    """The text as a JSON string literal."""
    return F.when(text.isNotNull(), F.btrim(F.to_json(F.array(text)), F.lit("[]")))


def decode_payload(value: Column) -> Column:
    """The text of one JSON value; anything else, and the JSON null, is taken as it is."""
    decoded = F.from_json(F.concat(F.lit("["), value, F.lit("]")), "array<string>")
    return F.coalesce(F.when(F.size(decoded) == 1, decoded[0]), value)


def header(key: str, value: Column) -> Column:
    """One record header."""
    return F.struct(F.lit(key).alias("key"), value.cast("binary").alias("value"))


def header_text(headers: Column, key: str, position: int) -> Column:
    """Text of the header with this key, else of the header at this position, else NULL."""
    named = F.try_element_at(F.filter(headers, lambda entry: entry["key"] == key), F.lit(1))
    return F.coalesce(named["value"], F.try_element_at(headers, F.lit(position))["value"]).cast("string")


def strip_newlines(text: Column) -> Column:
    return F.translate(text, "\n", "")


def record_id(partition: Column, offset: Column) -> Column:
    """Row id from the position in the record stream; an offset beyond the range of a partition is an error."""
    row_id = partition.cast("long") * F.lit(OFFSETS_PER_PARTITION).cast("long") + offset.cast("long")
    beyond = F.raise_error(F.concat(F.lit("offset beyond the range of row ids: "), offset.cast("string"))).cast("long")
    return F.when(offset.cast("long") >= OFFSETS_PER_PARTITION, beyond).otherwise(row_id)


def content_id(*fields: Column) -> Column:
    """SHA-1 of the field beginnings as an integer modulo 10^8; 0 when a field is NULL.

    The 160-bit number is folded in 32-bit steps, which keeps every product inside a long.
    """
    digest = F.sha1(F.concat(*[F.substring(field, 1, CONTENT_ID_PREFIX) for field in fields]))

    def fold(total: Column, start: int) -> Column:
        chunk = F.conv(F.substring(digest, start, 8), 16, 10).cast("long")
        return (total * F.lit(1 << 32).cast("long") + chunk) % F.lit(CONTENT_ID_RANGE).cast("long")

    return F.coalesce(reduce(fold, range(1, 41, 8), F.lit(0).cast("long")), F.lit(0).cast("long"))


def content_digest(*fields: Column) -> Column:
    """SHA-256 of the whole fields: tells postings apart where the short content id cannot."""
    return F.sha2(F.concat_ws("\x1f", *[F.coalesce(field, F.lit("")) for field in fields]), 256)


def row_label(row_id: Column, title: Column, company: Column) -> Column:
    """Fixed-width one-line label."""
    return F.format_string(LABEL_FORMAT, row_id, F.substring(title, 1, 40), F.substring(company, 1, 20))


def or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def or_empty_array(values: Column) -> Column:
    return F.coalesce(values, F.array().cast("array<string>"))
