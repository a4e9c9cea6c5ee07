"""The message header: one zero byte, then a big-endian 4-byte schema id."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HEADER_LENGTH = 5
MAGIC = b"\x00"


def has_header(value: Column) -> Column:
    return (F.length(value) > HEADER_LENGTH) & (F.substring(value, 1, 1) == F.lit(MAGIC))


def message_body(value: Column) -> Column:
    """The payload; a message without a header is a payload as a whole."""
    return F.when(has_header(value), F.substring(value, HEADER_LENGTH + 1, 2**31 - 1 - HEADER_LENGTH)).otherwise(value)


def schema_id(value: Column) -> Column:
    return F.when(has_header(value), F.conv(F.hex(F.substring(value, 2, 4)), 16, 10).cast("long"))


def add_header(body: Column, schema: Column) -> Column:
    return F.concat(F.lit(MAGIC), F.unhex(F.lpad(F.hex(schema), 8, "0")), body)


def lossy_text(raw: Column) -> Column:
    """Bytes as text; bytes that are not UTF-8 become replacement characters, never an error."""
    return F.make_valid_utf8(raw.cast("string"))
