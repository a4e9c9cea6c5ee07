"""Names derived from a device id."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The root of device paths and the key of rows without a device.
DEVICE_PATH_ROOT = "root.local.home.arpa"
UNROUTED = "__unrouted__"


def machine_type(device_id: Column) -> Column:
    """The device id without a trailing number: Press-A-01 is a Press-A."""
    return F.regexp_replace(device_id, r"-[0-9]+$", "")


def path_part(name: Column) -> Column:
    return F.translate(name, "-", "_")


def device_path(device_id: Column, root: str = DEVICE_PATH_ROOT) -> Column:
    return F.concat_ws(".", F.lit(root), path_part(machine_type(device_id)), path_part(device_id))


def routing_key(device_id: Column) -> Column:
    return F.coalesce(device_id, F.lit(UNROUTED))
