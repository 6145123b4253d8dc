"""Message payloads: bytes to typed columns and rows to message bodies.

Everything here is a built-in expression, so decoding stays in the JVM and reading
fewer columns prunes the parsing as well.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The fields of the Common Log Format and of RFC 3164 syslog lines.
CLF_FIELDS = ["host", "ident", "user", "time", "request", "status", "bytes"]
CLF_PATTERN = (
    r"\A(\S++) (\S++) (\S++) \[([^\]]*+)\] "
    r'"([^"\\]*+(?:\\.[^"\\]*+)*+)" (\d{3}|-) (\d++|-)(?: .*)?\s*\z'
)
SYSLOG_FIELDS = ["priority", "time", "host", "app", "pid", "message"]
SYSLOG_PATTERN = (
    r"(?s)\A<(\d{1,3})>([A-Z][a-z]{2} [ \d]\d \d{2}:\d{2}:\d{2}) (\S++) "
    r"([^\s:\[]++)(?:\[([^\]]*+)\])?: ?(.*)\z"
)

_SEPARATOR = "\x01"


def payload_text(value: Column) -> Column:
    """Payload bytes as UTF-8 text. Malformed bytes become U+FFFD, they do not fail the run."""
    return F.make_valid_utf8(value.cast("string"))


def delimited_fields(value: Column, fields: list[T.StructField], separator: str) -> list[Column]:
    """CSV or TSV payload into the fields by position; bad values and missing fields are null."""
    # The CSV reader has no bytes type: read text, then cast.
    ddl = ", ".join(
        f"`{f.name.replace('`', '``')}` "
        + ("string" if isinstance(f.dataType, T.BinaryType) else f.dataType.simpleString())
        for f in fields
    )
    row = F.from_csv(payload_text(value), ddl, {"sep": separator, "mode": "PERMISSIVE"})
    return [row.getField(f.name).cast(f.dataType).alias(f.name) for f in fields]


def pattern_fields(
    value: Column, fields: list[T.StructField], pattern: str, groups: list[int], total: int
) -> list[Column]:
    """Fields from the numbered groups of a pattern's first match; all null where there is none.

    The line is matched once for all fields: a match is replaced by its groups between
    separators, and the line split there. The groups of the first match are the pieces
    from 1 on; without a match there is only piece 0. A line that itself holds the
    separator takes the slower way, one match per group.
    """
    line = payload_text(value)
    numbers = range(1, total + 1)
    groups_text = "".join(f"{_SEPARATOR}${g}" for g in numbers) + _SEPARATOR
    pieces = F.split(F.regexp_replace(line, pattern, groups_text), _SEPARATOR)
    match_each = F.when(
        line.rlike(pattern), F.array(F.lit(""), *[F.regexp_extract(line, pattern, g) for g in numbers])
    )
    found = F.when(F.contains(line, F.lit(_SEPARATOR)), match_each).otherwise(pieces)
    out = []
    for field, group in zip(fields, groups):
        text = F.nullif(F.get(found, F.lit(group)), F.lit(""))
        out.append(text.try_cast(field.dataType).alias(field.name))
    return out


def csv_body(columns: list[str]) -> Column:
    """Values in order joined by commas, null as empty, no quoting."""
    return F.concat_ws(",", *[F.coalesce(F.col(_quoted(c)).cast("string"), F.lit("")) for c in columns])


def json_body(columns: list[str]) -> Column:
    """The row as one JSON object, nulls kept."""
    return F.to_json(F.struct(*[F.col(_quoted(c)) for c in columns]), {"ignoreNullFields": "false"})


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
