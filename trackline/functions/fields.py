"""Names of sensor fields: any field a machine sends is kept, whatever it is called.

Fields that share a name with a column of the library travel under a prefix; outputs give their own names back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

PREFIX, TYPED = "field__", "__as_"
#: Columns that identify a reading; callers name them so themselves.
IDENTITY = ("device_id", "timestamp", "seq")
#: Columns that the operators add to readings, at any step.
RESERVED = frozenset((
    "kind_rank", "ev", "slice", "phase", "n_seed", "out_seed", "prev", "n_before", "last_out", "open", "is_late",
    "context_complete", "run_id", "part_no", "recipe_name", "track_in", "track_out", "context_event",
    "data_point_count", "last_track_out", "machine_type", "rule", "limit", "carried", "offset", "batch", "document",
    "_read", "_prev", "_start", "_base", "_width", "_slice_of", "_rank", "_phase", "_shown", "_last", "_from", "_until"))


def held_name(name: str) -> str:
    """The column under which a field travels."""
    return PREFIX + name if name.lower() in RESERVED else name


def typed_name(column: str, kind: str) -> str:
    """The column for a field's values of one type, where machine families disagree about the type."""
    return f"{column}{TYPED}{kind}"


def field_name(column: str) -> str:
    """The field that a column holds."""
    return column.removeprefix(PREFIX).partition(TYPED)[0]


def held(readings: DataFrame, sliced: bool = False) -> DataFrame:
    """Readings with fields of reserved names under the prefix. `sliced` says that `slice` is the library's own."""
    own = (*IDENTITY, "slice") if sliced else IDENTITY
    return readings.withColumnsRenamed({c: held_name(c) for c in readings.columns if c not in own})
