"""Message contracts: Avro schema text read as Spark types, and the fixed contracts of the feeds."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import types as T

# Avro primitive types that carry over; any other type makes the field unsupported.
PRIMITIVES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
}


def _spark_type(avro: object) -> tuple[T.DataType | None, bool]:
    """(Spark type or None, nullable). Of several non-null union branches the last one counts."""
    if isinstance(avro, list):
        branches = [b for b in avro if b != "null"]
        kind = _spark_type(branches[-1])[0] if branches else None
        return kind, "null" in avro
    if isinstance(avro, dict):
        return _spark_type(avro.get("type")) if avro.get("type") in PRIMITIVES else (None, False)
    return PRIMITIVES.get(avro), False


def struct_from_avsc(text: str) -> T.StructType:
    """The reader schema of one Avro record; unsupported fields are left out."""
    record = json.loads(text)
    if record.get("type") != "record":
        raise ValueError("an Avro contract must be a record")
    fields = []
    for field in record["fields"]:
        kind, nullable = _spark_type(field["type"])
        if kind is not None:
            fields.append(T.StructField(field["name"], kind, nullable))
    return T.StructType(fields)


#: Types that a reader may widen a writer's type to.
WIDER = {
    T.IntegerType(): (T.LongType(), T.FloatType(), T.DoubleType()),
    T.LongType(): (T.FloatType(), T.DoubleType()),
    T.FloatType(): (T.DoubleType(),),
}


@dataclass(frozen=True)
class Source:
    """Where a reader's field comes from: a field of the writer, or else a constant."""

    name: str
    kind: T.DataType
    writer: str | None
    default: object = None
    required: bool = False


def resolve(writer: str, reader: str) -> list[Source] | None:
    """How records of one Avro schema read under another one; None where they can't.

    A field is found under its name or an alias of the reader's; one the writer lacks takes the reader's default, or
    null where it may be null; numbers may be widened; fields only the writer has are dropped.
    """
    written = {f.name: f.dataType for f in struct_from_avsc(writer).fields}
    declared = {f["name"]: f for f in json.loads(reader)["fields"]}
    sources = []
    for field in struct_from_avsc(reader).fields:
        own = declared[field.name]
        name = next((n for n in (field.name, *own.get("aliases", ())) if n in written), None)
        if name is None and "default" not in own and not field.nullable:
            return None
        if name is not None and written[name] != field.dataType and field.dataType not in WIDER.get(written[name], ()):
            return None
        sources.append(Source(field.name, field.dataType, name, own.get("default"), not field.nullable))
    return sources


def required_fields(contract: T.StructType) -> list[str]:
    return [f.name for f in contract.fields if not f.nullable]


def record_schema(record: str, /, **fields: object) -> str:
    """The Avro text of a record; a field is a type, or a dictionary with its type, default or aliases."""
    listed = [{"name": k, **(v if isinstance(v, dict) else {"type": v})} for k, v in fields.items()]
    return json.dumps({"type": "record", "name": record, "fields": listed})


# The field names and types of the feeds.
OPTIONAL_TEXT = ["null", "string"]
TELEMETRY_AVSC = record_schema("MachineTelemetry", device_id="string", timestamp="long", vibration="double",
                               temperature="double", pressure="double", status="string")
CONTEXT_AVSC = record_schema("MachineContextEvent", device_id="string", event_type="string", event_timestamp="long",
                             run_id=OPTIONAL_TEXT, part_no=OPTIONAL_TEXT, recipe_name=OPTIONAL_TEXT)
CONTROL_AVSC = record_schema("MachineControlRules", version="string", machine_type="string", max_vibration="double",
                             min_vibration="double", max_temperature="double", min_temperature="double",
                             max_pressure="double", min_pressure="double", rule_profile="string")
METRIC_AVSC = record_schema("MachineMetrics", mc_name="string", temp="double", pressure="double")
USER_AVSC = record_schema("User", id="string", name="string", email=OPTIONAL_TEXT)

TELEMETRY = struct_from_avsc(TELEMETRY_AVSC)
CONTEXT = struct_from_avsc(CONTEXT_AVSC)
CONTROL = struct_from_avsc(CONTROL_AVSC)
METRIC = struct_from_avsc(METRIC_AVSC)
USER = struct_from_avsc(USER_AVSC)

CONTROL_DOCUMENT = T.StructType([
    T.StructField("version", T.IntegerType()),
    T.StructField("rules", T.StructType([
        T.StructField("max_safe_temp", T.DoubleType()),
        T.StructField("max_safe_pressure", T.DoubleType()),
    ])),
])
