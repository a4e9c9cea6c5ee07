"""The semantics restated in plain Python, row by row, to check the window expressions against."""

from __future__ import annotations

from dataclasses import dataclass, field
from fractions import Fraction


@dataclass
class Cycle:
    run: str | None
    part: str | None
    recipe: str | None
    since: int
    count: int = 0


@dataclass
class Device:
    cycle: Cycle | None = None
    last_out: int | None = None
    rows: list = field(default_factory=list)


def replay(messages):
    """messages: dicts in arrival order. Returns (rows, incomplete) as lists of dicts."""
    devices: dict[str, Device] = {}
    rows, incomplete = [], []
    for m in messages:
        device = devices.setdefault(m["device_id"], Device())
        cycle = device.cycle
        base = {"device_id": m["device_id"], "timestamp": m["timestamp"], "seq": m["seq"]}
        if m["kind"] == "reading":
            row = dict(base, vibration=m["vibration"], context_event=None, track_out=None)
            if cycle:
                cycle.count += 1
                row.update(context_complete=True, run_id=cycle.run, part_no=cycle.part, recipe_name=cycle.recipe,
                           track_in=cycle.since, data_point_count=cycle.count, last_track_out=None)
            else:
                row.update(context_complete=False, run_id=None, part_no=None, recipe_name=None, track_in=None,
                           data_point_count=None, last_track_out=device.last_out)
                known = device.last_out is not None
                incomplete.append(dict(
                    base, reason="between_cycles" if known else "never_tracked_since_job_start",
                    last_track_out=device.last_out, gap=m["timestamp"] - device.last_out if known else None,
                    run=None, count=None))
            rows.append(row)
            continue
        marker = dict(base, vibration=None, context_complete=True, last_track_out=None, track_out=None)
        if m["kind"] == "TRACK_IN":
            if cycle:
                incomplete.append(dict(base, reason="abandoned_cycle", last_track_out=None, gap=None, run=cycle.run,
                                       count=cycle.count))
            device.cycle = Cycle(m["run_id"], m["part_no"], m["recipe_name"], m["timestamp"])
            rows.append(dict(marker, context_event="TRACK_IN", run_id=m["run_id"], part_no=m["part_no"],
                             recipe_name=m["recipe_name"], track_in=m["timestamp"], data_point_count=0))
        elif m["kind"] == "TRACK_OUT":
            if cycle:
                rows.append(dict(marker, context_event="TRACK_OUT_CLOSE", run_id=cycle.run, part_no=cycle.part,
                                 recipe_name=cycle.recipe, track_in=cycle.since, track_out=m["timestamp"],
                                 data_point_count=cycle.count))
            else:
                rows.append(dict(marker, context_event="TRACK_OUT_ORPHANED", run_id=None, part_no=None,
                                 recipe_name=None, track_in=None, track_out=m["timestamp"], data_point_count=None))
                incomplete.append(dict(base, reason="orphaned_track_out", last_track_out=None, gap=None, run=None,
                                       count=None))
            device.last_out, device.cycle = m["timestamp"], None
    return rows, incomplete


def zone_rules(series: list[float]) -> list[set[int]]:
    """The rules that fire at each value of one series, in exact fractions of the values as they are written."""
    fired = []
    written = [Fraction(str(v)) for v in series]
    for end in range(1, len(series) + 1):
        window = written[max(0, end - 25):end]
        found: set[int] = set()
        if len(window) >= 15 and max(window) > min(window):
            mean = sum(window) / len(window)
            variance = sum((v - mean) ** 2 for v in window) / (len(window) - 1)

            def z(v, k):  # side of a zone
                return ((v > mean) - (v < mean)) * ((v - mean) ** 2 > k * k * variance)  # noqa: B023

            sides = [(v > mean) - (v < mean) for v in window]
            steps = [(b > a) - (b < a) for a, b in zip(window, window[1:])]
            if z(window[-1], 3):
                found.add(1)
            if abs(sum(sides[-9:])) == 9:
                found.add(2)
            if abs(sum(steps[-5:])) == 5:
                found.add(3)
            if all(a * b == -1 for a, b in zip(steps[-13:], steps[-12:])):
                found.add(4)
            for rule, points, needed, k in ((5, 3, 2, 2), (6, 5, 4, 1)):
                zones = [z(v, k) for v in window[-points:]]
                if max(zones.count(1), zones.count(-1)) >= needed:
                    found.add(rule)
            inside = [z(v, 1) == 0 for v in window]
            if all(inside[-15:]):
                found.add(7)
            if not any(inside[-8:]):
                found.add(8)
        fired.append(found)
    return fired
