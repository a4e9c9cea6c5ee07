"""Text contracts of the outputs: encoded rows and JSON documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackline.functions.fields import field_name
from trackline.functions.names import device_path

# The type tag of each supported field type; other types are left out of a row.
TYPE_TAGS = {
    T.StringType: "TEXT",
    T.IntegerType: "INT32",
    T.LongType: "INT64",
    T.FloatType: "FLOAT",
    T.DoubleType: "DOUBLE",
    T.BooleanType: "BOOLEAN",
}

# The cycle fields of an encoded row, in output order.
CYCLE_FIELDS = ("run_id", "part_no", "recipe_name", "track_in", "track_out", "context_event", "data_point_count")
IDENTITY = ("device_id", "timestamp", "seq", "kind_rank", "context_complete", "last_track_out", "machine_type",
            "is_late", *CYCLE_FIELDS)


def type_tag(data_type: T.DataType) -> str | None:
    return TYPE_TAGS.get(type(data_type))


def field_text(value: Column) -> Column:
    """A value as text that may stand in a comma-separated list."""
    return F.replace(value.cast("string"), F.lit(","), F.lit(";"))


def encoded_fields(frame: DataFrame) -> list[tuple[str, str]]:
    """(name, tag) of what an encoded row of this frame can hold, sensors first."""
    sensors = [(f.name, type_tag(f.dataType)) for f in frame.schema.fields if f.name not in IDENTITY]
    cycle = [(name, type_tag(frame.schema[name].dataType)) for name in CYCLE_FIELDS if name in frame.columns]
    return [(name, tag) for name, tag in sensors + cycle if tag is not None]


def encoded_rows(enriched: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """device, timestamp and three parallel comma-separated lists; null fields are left out. `keep` passes columns on."""
    fields = encoded_fields(enriched.drop(*keep))

    def joined(pick) -> Column:
        return F.concat_ws(",", *[F.when(F.col(name).isNotNull(), pick(name, tag)) for name, tag in fields])

    return enriched.select(
        *keep, device_path(F.col("device_id")).alias("device"),
        F.col("timestamp").cast("string").alias("timestamp"),
        joined(lambda name, tag: F.lit(field_name(name))).alias("measurements"),
        joined(lambda name, tag: F.lit(tag)).alias("types"),
        joined(lambda name, tag: field_text(F.col(name))).alias("values"),
    )


def _document(*fields: str | Column) -> Column:
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def incomplete_document(reason: str = "reason") -> Column:
    """JSON of an incomplete track. Which keys appear depends on the reason; nulls are kept."""
    head = ["device_id", "timestamp", reason]
    return (
        F.when(F.col(reason) == "abandoned_cycle",
               _document(*head, "abandoned_run_id", "abandoned_part_no", "abandoned_track_in",
                         "data_point_count_at_abandonment"))
        .when(F.col(reason) == "orphaned_track_out", _document(*head))
        .when(F.col("last_track_out").isNull(), _document(*head, "last_track_out"))
        .otherwise(_document(*head, "last_track_out", "gap_since_last_track_out_ms"))
    )


def alert_document() -> Column:
    """JSON of an alert; limit breaches and zone rules end in different keys."""
    head = ["alert_type", "timestamp", "measurement", "value", "device_id"]
    return F.when(
        F.col("alert_type") == "limit_breach",
        _document(*head, "limit_type", "limit_value", "rule_profile", "rule_version"),
    ).otherwise(_document(*head, "rule_number", "rule_description"))
