"""Decoding of raw messages, with bad ones kept beside the good ones.

A decoded frame has the message columns, `record` (the typed fields) and `error`, which is null
on good messages. Splitting it is two filters; nothing is thrown away except null values, which
carry no message.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackline.functions.fields import PREFIX, field_name, typed_name
from trackline.functions.wire import lossy_text, message_body, schema_id
from trackline.sources import contracts

UNDECODABLE = "undecodable"
MISSING_FIELD = "missing_required_field"
CONTRACT_VIOLATION = "contract_violation"
IMPLAUSIBLE = "implausible"
UNKNOWN_SCHEMA = "unknown_schema"
INCOMPATIBLE_SCHEMA = "incompatible_schema"
#: Most fields that messages may bring beside those of the contract; each becomes a column.
MOST_FIELDS = 2_000
_CORRUPT = "__corrupt_record"


def _nullable(contract: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in contract.fields])


def _parse_json(body: Column, contract: T.StructType) -> Column:
    schema = _nullable(contract).add(_CORRUPT, T.StringType())
    return F.from_json(body.cast("string"), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})


def _parse_avro(body: Column, avsc: str) -> Column:
    from pyspark.sql.avro.functions import from_avro  # needs the spark-avro package on the cluster

    return from_avro(body, avsc, {"mode": "PERMISSIVE"})


def _wrong_text_type(body: Column, contract: T.StructType) -> Column:
    """True when a text field holds a JSON value of another type (a lenient parser would convert it)."""
    document = F.try_parse_json(body.cast("string"))
    checks = [
        F.schema_of_variant(F.try_variant_get(document, f"$.{f.name}", "variant")).isin("STRING", "VOID")
        for f in contract.fields if isinstance(f.dataType, T.StringType)
    ]
    wrong = F.lit(False)
    for ok in checks:
        wrong = wrong | ~F.coalesce(ok, F.lit(True))
    return wrong


def decode(messages: DataFrame, contract: T.StructType, required: list[str], *, avsc: str | None = None,
           strict: bool = False) -> DataFrame:
    """Decode `value`; JSON bodies by default, Avro bodies when `avsc` is given.

    Parsing happens inside a generator, so that filters on its outcome cannot be pushed down
    into a second parse of the same message.
    """
    body = message_body(F.col("value"))
    parsed = _parse_avro(body, avsc) if avsc else _parse_json(body, contract)
    extra = [_wrong_text_type(body, contract).alias("wrong_type")] if strict and not avsc else []
    rows = messages.filter(F.col("value").isNotNull()).select(
        "*", F.explode(F.array(F.struct(parsed.alias("record"), *extra))).alias("_parsed"))

    record = F.col("_parsed.record")
    if avsc:  # a permissive Avro parser gives a record of nulls for bytes it cannot read
        failed = F.lit(True)
        for f in contract.fields:
            failed = failed & record[f.name].isNull()
        failed = record.isNull() | failed
    else:
        failed = record.isNull() | record[_CORRUPT].isNotNull()
    missing = F.lit(False)
    for name in required:
        missing = missing | record[name].isNull()
    error = F.when(failed, UNDECODABLE).when(missing, MISSING_FIELD)
    if extra:
        error = error.when(F.col("_parsed.wrong_type"), CONTRACT_VIOLATION)
    typed = F.struct(*[record[f.name].alias(f.name) for f in contract.fields])
    return rows.select("*", typed.alias("record"), error.alias("error")).drop("_parsed")


def _resolved(body: Column, writer: str, reader: str, avro: bool) -> Column:
    """One message written under `writer` as struct<record of the reader, error>; parsed once, in the lambda's argument."""
    sources = contracts.resolve(writer, reader)
    contract = contracts.struct_from_avsc(reader)
    if sources is None:
        nothing = F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in contract.fields])
        return F.struct(nothing.alias("record"), F.lit(INCOMPATIBLE_SCHEMA).alias("error"))
    written = contracts.struct_from_avsc(writer)
    parsed = _parse_avro(body, writer) if avro else _parse_json(body, written)

    def read(found: Column) -> Column:
        values = [found[s.writer].cast(s.kind) if s.writer else F.lit(s.default).cast(s.kind) for s in sources]
        failed, missing = found.isNull(), F.lit(False)
        if avro:
            nulls = [found[f.name].isNull() for f in written.fields]
            failed = failed | reduce(Column.__and__, nulls)
        else:
            failed = failed | found[_CORRUPT].isNotNull()
        for source, value in zip(sources, values, strict=True):
            missing = missing | value.isNull() if source.required else missing
        record = F.struct(*[v.alias(s.name) for s, v in zip(sources, values, strict=True)])
        return F.struct(record.alias("record"), F.when(failed, UNDECODABLE).when(missing, MISSING_FIELD).alias("error"))

    return F.transform(F.array(parsed), read)[0]


def decode_by_schema(messages: DataFrame, writers: dict[int, str], reader: str, *, avro: bool = False) -> DataFrame:
    """Decode a topic whose messages were written under several schemas, told by the id in their header, to one frame.

    `writers` are the Avro schemas by id, `reader` the one to read them as (see `contracts.resolve`). A message without a
    header is read as the reader's own. One with an id that nobody knows, or whose schema does not fit the reader's,
    is a dead letter. One pass: of each message only the schema of its id is tried.
    """
    body, number = message_body(F.col("value")), schema_id(F.col("value"))
    outcome = F.when(number.isNull(), _resolved(body, reader, reader, avro))
    for known, writer in sorted(writers.items()):
        outcome = outcome.when(number == known, _resolved(body, writer, reader, avro))
    rows = messages.filter(F.col("value").isNotNull()).select("*", F.explode(F.array(outcome)).alias("_parsed"))
    contract = contracts.struct_from_avsc(reader)
    record = F.struct(*[F.col(f"_parsed.record.{f.name}").alias(f.name) for f in contract.fields])
    error = F.when(F.col("_parsed").isNull(), UNKNOWN_SCHEMA).otherwise(F.col("_parsed.error"))
    return rows.select("*", record.alias("record"), error.alias("error")).drop("_parsed")


def _open_type(found: str) -> str:
    """The column type for a type found in messages; what is no plain number, text or flag travels as JSON text."""
    if found == "BIGINT":
        return "bigint"
    if found in ("DOUBLE", "FLOAT") or found.startswith("DECIMAL"):
        return "double"
    return {"STRING": "string", "BOOLEAN": "boolean"}.get(found, "variant")


def with_open_fields(decoded: DataFrame) -> DataFrame:
    """Add the JSON fields that the contract does not name to the records of decoded messages, with the types found.

    One pass over the messages finds names and types, counted together in each task; a field that is a whole number in some
    messages and a fraction in others is a double, one of no common type is JSON text. Names come in
    alphabetical order after those of the contract; a name that differs from another one in case only is refused.
    """
    document = F.try_parse_json(message_body(F.col("value")).cast("string"))
    rows = decoded.withColumn("_doc", F.explode(F.array(document)))
    spark, declared = decoded.sparkSession, decoded.schema["record"].dataType.fieldNames()
    fields = rows.filter("error IS NULL").select("_doc").lateralJoin(spark.tvf.variant_explode(F.col("_doc").outer()))
    found = fields.filter(~F.col("key").isin(declared)).groupBy("key").agg(
        F.schema_of_variant_agg("value").alias("kind")).limit(MOST_FIELDS + 1).collect()
    if len(found) > MOST_FIELDS:
        raise ValueError(f"messages bring more than {MOST_FIELDS} fields that the contract does not name")
    names = [n.lower() for n in (*declared, *(f.key for f in found))]
    if len(set(names)) < len(names):
        raise ValueError("two fields have names that differ in case only")
    extra = []
    for field in sorted(found, key=lambda f: f.key):
        quote = '"' if "'" in field.key else "'"
        value = F.try_variant_get("_doc", f"$[{quote}{field.key}{quote}]", "variant")
        kind = _open_type(field.kind)
        typed = F.to_json(value) if kind == "variant" else F.try_variant_get(value, "$", kind)
        extra.append(F.when(F.col("error").isNull(), typed).alias(field.key))
    record = F.struct(*[F.col("record")[n].alias(n) for n in declared], *extra)
    return rows.withColumn("record", record).drop("_doc")


def good_records(decoded: DataFrame) -> DataFrame:
    """The typed fields of good messages; `seq` is the message offset.

    A field called `seq` travels under a prefix (see `functions.fields`); the operators on readings do the same for
    fields named like other columns of theirs.
    """
    names = decoded.schema["record"].dataType.fieldNames()
    if any(name.startswith(PREFIX) for name in names):
        raise ValueError(f"no field may start with {PREFIX}")
    fields = [F.col("record").getField(name).alias(f"{PREFIX}{name}" if name == "seq" else name) for name in names]
    return decoded.filter(F.col("error").isNull()).select(*fields, F.col("offset").alias("seq"))


def decode_rule_log(messages: DataFrame, contract: T.StructType) -> DataFrame:
    """Limit records of a control topic, decoded; what cannot be used goes to the dead letters, not to the rules."""
    return decode(messages, contract, ["machine_type"])


def rule_records(decoded: DataFrame) -> DataFrame:
    """The usable limit records as a rule log; the message time is the log time."""
    good = decoded.filter(F.col("error").isNull())
    return good.select("record.*", "offset", F.unix_millis("timestamp").alias("log_time"))


def dead_letters(decoded: DataFrame, source: str) -> DataFrame:
    """Bad messages with their unchanged bytes, a readable form and the reason."""
    return decoded.filter(F.col("error").isNotNull()).select(
        F.lit(source).alias("source"), F.col("value").alias("raw"), lossy_text(F.col("value")).alias("raw_text"),
        "error", "offset")


def reject_implausible_metrics(decoded: DataFrame) -> DataFrame:
    """Mark metrics that were cut at the wrong place: no machine name, or a temperature above 1000."""
    temp = F.col("record.temp")
    odd = (F.col("record.mc_name") == "") | ((temp > 1000) & ~F.isnan(temp))
    return decoded.withColumn("error", F.when(F.col("error").isNull() & odd, IMPLAUSIBLE).otherwise(F.col("error")))


def numeric_fields(records: DataFrame, identity: tuple[str, ...] = ("device_id", "timestamp", "seq")) -> Column:
    """The numeric fields of a record as map<name, double>, nulls left out."""
    entries = [
        F.struct(F.lit(field_name(f.name)), F.col(f.name).cast("double"))
        for f in records.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in identity
    ]
    named = F.filter(F.array(*entries), lambda e: e["col2"].isNotNull())
    return F.map_from_entries(named)


def error_headers(decoded: DataFrame) -> DataFrame:
    """Bad messages as outgoing messages: bytes unchanged, the reason in a header."""
    header = F.array(F.struct(F.lit("error_message").alias("key"), F.col("error").cast("binary").alias("value")))
    return decoded.filter(F.col("error").isNotNull()).select("key", "value", header.alias("headers"))


def union_families(*families: DataFrame) -> DataFrame:
    """Readings of several machine families as one frame; fields a family lacks are null.

    Where families give a field other types, each type gets a column of its own, named `<field>__as_<type>`, so no
    value is converted and no family fails another; `field_name` gives the field back.
    """
    types: dict[str, set[str]] = {}
    for family in families:
        for field in family.schema.fields:
            types.setdefault(field.name, set()).add(field.dataType.simpleString())
    mixed = {name for name, found in types.items() if len(found) > 1}
    families = [family.withColumnsRenamed({
        f.name: typed_name(f.name, f.dataType.simpleString()) for f in family.schema.fields if f.name in mixed})
        for family in families]
    first, *rest = families
    for other in rest:
        first = first.unionByName(other, allowMissingColumns=True)
    return first
