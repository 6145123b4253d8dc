"""The declared schema of a topic: which fields are metadata, which come from the payload."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import types as T

from topicwright.functions.grok import Grok, GrokError, compile_grok, is_grok
from topicwright.functions.payload import CLF_FIELDS, SYSLOG_FIELDS

# Names of payload formats.
FORMATS = ["binary", "clf", "csv", "grok", "syslog", "text", "tsv"]

# Names of the plain and logical types in a record schema.
_PLAIN_TYPES = {
    "boolean": T.BooleanType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "bytes": T.BinaryType(),
    "string": T.StringType(),
    "null": T.NullType(),
}
_LOGICAL_TYPES = {
    "date": T.DateType(),
    "timestamp-millis": T.TimestampType(),
    "timestamp-micros": T.TimestampType(),
}


class ShapeError(ValueError):
    """Every problem found in a declared schema, one per line."""

    def __init__(self, problems: list[str]):
        super().__init__("\n".join(problems))
        self.problems = problems


def record_schema(text: str) -> T.StructType:
    """A record schema in JSON (fields with name and type, unions with null) as a StructType."""
    record = json.loads(text)
    fields = []
    for declared in record["fields"]:
        data_type, nullable = _field_type(declared["type"])
        fields.append(T.StructField(declared["name"], data_type, nullable))
    return T.StructType(fields)


def _field_type(declared) -> tuple[T.DataType, bool]:
    if isinstance(declared, list):
        others = [d for d in declared if d != "null"]
        if len(others) != 1:
            raise ShapeError([f"Only unions of null and one other type are supported, not {declared}."])
        return _field_type(others[0])[0], len(others) < len(declared)
    if isinstance(declared, dict):
        logical = declared.get("logicalType")
        if logical == "decimal":
            return T.DecimalType(declared["precision"], declared.get("scale", 0)), False
        if logical in _LOGICAL_TYPES:
            return _LOGICAL_TYPES[logical], False
        if logical is None:
            return _field_type(declared["type"])
        raise ShapeError([f"Unsupported logical type '{logical}'."])
    if declared not in _PLAIN_TYPES:
        raise ShapeError([f"Unsupported type '{declared}'."])
    return _PLAIN_TYPES[declared], declared == "null"


@dataclass(frozen=True)
class RecordShape:
    """Output columns of a topic read. ``schema``: StructType, DDL text or record JSON."""

    schema: T.StructType | str
    format: str | None = None
    key_field: str | None = None
    partition_field: str | None = None
    offset_field: str | None = None
    time_field: str | None = None
    # A Grok pattern, whose fields are taken by name, or a regular expression with one group per message field.
    pattern: str | None = None
    # Pattern names beside the usual ones.
    definitions: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self):
        schema = self.schema
        if isinstance(schema, str):
            is_json = schema.lstrip().startswith("{")
            schema = record_schema(schema) if is_json else T.StructType.fromDDL(schema)
            object.__setattr__(self, "schema", schema)
        object.__setattr__(self, "format", self.format.lower() if self.format else None)
        problems = self._problems()
        if problems:
            raise ShapeError(problems)

    @property
    def metadata_fields(self) -> dict[str, str]:
        """Output field name of each metadata column that was asked for."""
        named = {
            self.time_field: "time",
            self.key_field: "key",
            self.partition_field: "partition",
            self.offset_field: "offset",
        }
        return {name: kind for name, kind in named.items() if name}

    @property
    def message_fields(self) -> list[T.StructField]:
        return [f for f in self.schema.fields if f.name not in self.metadata_fields]

    @property
    def grok(self) -> Grok | None:
        """The compiled pattern, if it refers to pattern names."""
        return compile_grok(self.pattern, self.definitions) if self.pattern and is_grok(self.pattern) else None

    @property
    def groups(self) -> int:
        """Number of groups in the user's pattern."""
        plain = re.sub(r"\[[^\]]*\]", "", re.sub(r"\\.", "", self.pattern))
        return len(re.findall(r"\((?!\?)|\(\?<[A-Za-z]", plain))

    def _problems(self) -> list[str]:
        problems = []
        if self.time_field and self.time_field == self.key_field:
            problems.append(f"Time and key cannot both be in field '{self.key_field}'.")
        expected = [
            ("time", self.time_field, T.LongType()),
            ("key", self.key_field, T.BinaryType()),
            ("partition", self.partition_field, T.IntegerType()),
            ("offset", self.offset_field, T.LongType()),
        ]
        by_name = {f.name: f.dataType for f in self.schema.fields}
        for kind, name, data_type in expected:
            if not name:
                continue
            if name not in by_name:
                problems.append(f"The schema has no field '{name}' for the {kind}.")
            elif by_name[name] != data_type:
                found = by_name[name].simpleString()
                problems.append(
                    f"Field '{name}' for the {kind} must be {data_type.simpleString()}, but is {found}."
                )
        if not self.message_fields:
            problems.append("The schema has no message field.")
            return problems
        return problems + self._format_problems()

    def _format_problems(self) -> list[str]:
        fields = self.message_fields
        names = [f.name for f in fields]
        if self.format is None or self.format == "binary":
            if len(fields) > 1:
                return [f"Raw messages fill one message field, not {len(fields)} ({', '.join(names)})."]
            if not isinstance(fields[0].dataType, T.BinaryType):
                found = fields[0].dataType.simpleString()
                return [f"Raw messages need a binary field, but {names[0]} is {found}."]
            return []
        if self.format not in FORMATS:
            return [f"Unable to read messages of format '{self.format}'. Use one of {', '.join(FORMATS)}."]
        if self.format == "text" and (len(fields) > 1 or not isinstance(fields[0].dataType, T.StringType)):
            return ["The text format needs exactly one message field, of type string."]
        known = {"clf": CLF_FIELDS, "syslog": SYSLOG_FIELDS}.get(self.format)
        unknown = [n for n in names if known is not None and n not in known]
        if unknown:
            return [f"The {self.format} format has no field {', '.join(unknown)}. It has {', '.join(known)}."]
        if self.format == "grok":
            if not self.pattern:
                return ["The grok format needs a pattern with one group per message field."]
            if is_grok(self.pattern):
                return self._grok_problems()
            if self.groups != len(fields):
                return [f"The pattern has {self.groups} groups for {len(fields)} message fields."]
        return []

    def _grok_problems(self) -> list[str]:
        try:
            found = dict(self.grok.fields)
        except GrokError as error:
            return [str(error)]
        problems = [f"The pattern has no field '{f.name}'." for f in self.message_fields if f.name not in found]
        for f in self.message_fields:
            kind = found.get(f.name)
            if kind and kind != f.dataType.simpleString():
                problems.append(f"Field '{f.name}' is {f.dataType.simpleString()}, but {kind} in the pattern.")
        return problems
