"""Input frames for the tests."""

from __future__ import annotations

import random

READINGS = "device_id string, timestamp long, seq long, vibration double, temperature double, pressure double, status string"
EVENTS = ("device_id string, event_type string, event_timestamp long, seq long, run_id string, part_no string, "
          "recipe_name string")
RULES = ("offset long, log_time long, version string, machine_type string, max_vibration double, min_vibration double, "
         "max_temperature double, min_temperature double, max_pressure double, min_pressure double, "
         "rule_profile string")

# The limit records the fixture steps refer to.
PRESS_RULES = [
    (0, 0, "v1.0.0", "Press-A", 5.5, 1.5, 90.0, 70.0, 75.0, 55.0, "HIGH_PRECISION_STRICT"),
    (1, 0, "v1.0.0", "Press-B", 8.5, 1.0, 115.0, 60.0, 95.0, 45.0, "STANDARD_HEAVY_DUTY"),
]
DEVICE = "Press-A-99"


def golden_messages(start: int = 1_700_000_000_000, pause: bool = False) -> list[dict]:
    """Thirteen steps on one device: 15 readings and 10 events (and a PAUSE on request)."""
    out: list[dict] = []
    clock = start

    def send(kind: str, **extra) -> None:
        nonlocal clock
        clock += 300 if kind == "reading" else 2000
        fields = {"run_id": None, "part_no": None, "recipe_name": None, "vibration": None}
        out.append({"device_id": DEVICE, "timestamp": clock, "seq": len(out), "kind": kind, **fields, **extra})

    def readings(count: int, vibration: float = 3.0) -> None:
        for _ in range(count):
            send("reading", vibration=vibration)

    def opens(number: int, recipe: str = "RECIPE_STD") -> None:
        send("TRACK_IN", run_id=f"RUN-{number}", part_no=f"PART-TEST-{number:04d}", recipe_name=recipe)

    readings(3)
    opens(1)
    readings(3)
    if pause:
        send("PAUSE")
    send("TRACK_OUT")
    readings(2)
    opens(2)
    send("TRACK_OUT")
    opens(3)
    readings(2)
    opens(4)
    readings(2)
    send("TRACK_OUT")
    send("TRACK_OUT")
    readings(2)
    opens(5, "RECIPE_HP")
    readings(1, 7.0)
    send("TRACK_OUT")
    return out


def random_messages(seed: int, count: int, devices: int) -> list[dict]:
    """Readings and events in random order; one device holds about a third of all rows."""
    rng = random.Random(seed)
    out = []
    for seq in range(count):
        device = 0 if rng.random() < 0.34 else rng.randrange(devices)
        kind = rng.choices(["reading", "TRACK_IN", "TRACK_OUT", "PAUSE"], [12, 2, 2, 1])[0]
        message = {"device_id": f"Press-{'AB'[device % 2]}-{device:02d}", "timestamp": 1_700_000_000_000 + seq * 7,
                   "seq": seq, "kind": kind, "run_id": None, "part_no": None, "recipe_name": None, "vibration": None}
        if kind == "reading":
            message["vibration"] = round(rng.gauss(4, 1.5), 2)
        elif kind == "TRACK_IN":
            message.update(run_id=f"RUN-{seq}", part_no=f"PART-{seq}", recipe_name="RECIPE_STD")
        out.append(message)
    return out


def reading_frame(spark, messages):
    rows = [(m["device_id"], m["timestamp"], m["seq"], m["vibration"], 80.0, 65.0, "RUNNING")
            for m in messages if m["kind"] == "reading"]
    return spark.createDataFrame(rows, READINGS)


def event_frame(spark, messages):
    rows = [(m["device_id"], m["kind"], m["timestamp"], m["seq"], m["run_id"], m["part_no"], m["recipe_name"])
            for m in messages if m["kind"] != "reading"]
    return spark.createDataFrame(rows, EVENTS)


def rule_frame(spark, rows=None):
    return spark.createDataFrame(PRESS_RULES if rows is None else rows, RULES)
