from __future__ import annotations

import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from restated import zone_rules
from trackline.operators import spc
from trackline.operators.slices import plan_slices

VALUES = "device_id string, measurement string, timestamp long, seq long, value double"


def frame(spark, series: dict[str, list[float]]):
    return spark.createDataFrame(
        [(name, "m", i * 10, i, float(v)) for name, values in series.items() for i, v in enumerate(values)], VALUES)


def fired(evaluated):
    out = {}
    for r in evaluated.collect():
        out[r.device_id, r.seq] = {n for n in spc.RULES if r[f"rule_{n}"]}
    return out


def hand_series() -> dict[str, list[float]]:
    rng = random.Random(1)
    noise = [round(rng.gauss(10, 1), 2) for _ in range(40)]
    return {
        "warm-up": noise[:14],
        "flat": [0.1] * 25,
        "rising": noise[:9] + [1, 2, 3, 4, 5, 6],
        "equal step": noise[:9] + [1, 2, 3, 3, 4, 5],
        "alternating": noise[:3] + [9, 11] * 7 + [11],
        "one side": noise[:10] + [30] * 9 + noise[10:20],
        "calm": [8, 12] * 8 + [10] * 15,
        "avoids the middle": [10] * 10 + [0, 20] * 4,
        "long": noise + [40] + noise,
        "two far": noise[:20] + [30, 30, 10],
        "tie": [0, 2] * 13,
    }


def test_hand_series(spark):
    series = hand_series()
    got = fired(spc.evaluate(frame(spark, series)))
    for name, values in series.items():
        for i, rules in enumerate(zone_rules(values)):
            assert got[name, i] == rules, (name, i)
    assert not any(got["flat", i] for i in range(25))
    assert 3 in got["rising", 14] and 3 not in got["equal step", 14]
    assert 4 in got["alternating", 16] and 4 not in got["alternating", 17]


@pytest.mark.parametrize("max_rows", [None, 5, 30, 100])
def test_random_series(spark, max_rows):
    rng = random.Random(2)

    def mixed(n: int) -> list[float]:
        """Stretches of noise, drift and calm, with whole numbers for ties and a few far values."""
        out: list[float] = []
        while len(out) < n:
            level, spread = rng.randint(-3, 3), rng.choice([0.2, 1.0, 3.0])
            for _ in range(rng.randint(5, 20)):
                value = rng.choice([rng.gauss(level, spread), float(rng.randint(-2, 2))])
                out.append(value * 8 if rng.random() < 0.04 else value)
        return out[:n]

    series = {f"d{k}": mixed(n) for k, n in enumerate((600, 80, 26, 15, 3))}
    values = frame(spark, series)
    plan = plan_slices(values, max_rows) if max_rows else None
    got = fired(spc.evaluate(plan.assign(values) if plan else values, plan))
    assert got == {(d, i): r for d, v in series.items() for i, r in enumerate(zone_rules(v))}
    assert {n for rules in got.values() for n in rules} >= {1, 2, 5, 6, 7}


def tied_series() -> dict[str, list[float]]:
    """Series whose values fall on the mean and on sigma lines all the time."""
    rng = random.Random(7)
    return {
        "cents": [rng.randint(0, 10) / 100 for _ in range(300)],
        "one in the middle": ([0.1, -0.1] * 12 + [0.0]) * 6,
        "far from zero": [1e6 + rng.randint(0, 8) / 100 for _ in range(300)],
        "negative": [-rng.randint(0, 3) / 10 for _ in range(200)],
        "mixed sizes": [rng.choice([1e-9, 2e-9, 123456.75, 0.3]) for _ in range(200)],
        "large": [rng.randint(0, 4) * 1e18 for _ in range(120)],
        "small": [rng.randint(0, 4) * 1e-30 for _ in range(120)],
    }


@pytest.mark.parametrize("max_rows", [None, 7, 60])
def test_values_on_a_line_are_on_neither_side(spark, max_rows):
    series = tied_series()
    values = frame(spark, series)
    plan = plan_slices(values, max_rows) if max_rows else None
    got = fired(spc.evaluate(plan.assign(values) if plan else values, plan))
    assert got == {(d, i): r for d, v in series.items() for i, r in enumerate(zone_rules(v))}


def test_moments_are_the_same_to_the_last_bit(spark):
    """Sliced or not, and whatever the order of equal sums, the mean is the exact one rounded."""
    rng = random.Random(8)
    series = {"d": [rng.gauss(1e3, 1) * 10 ** rng.randint(-6, 6) for _ in range(400)], **tied_series()}
    values = frame(spark, series)
    columns = ("device_id", "seq", "n", "mean", "sd")
    whole = {tuple(r[:2]): r for r in spc.evaluate(values).select(*columns).collect()}
    for max_rows in (7, 100):
        plan = plan_slices(values, max_rows)
        assert {tuple(r[:2]): r for r in spc.evaluate(plan.assign(values), plan).select(*columns).collect()} == whole
    for (device, at), row in whole.items():
        window = [Fraction(v) for v in series[device][max(0, at - 24):at + 1]]
        mean = sum(window) / len(window)
        rounded = 30 if device in ("large", "small") else 3  # beyond the grids sums are plain
        assert abs(Fraction(row.mean) - mean) <= abs(mean) * Fraction(rounded, 2 ** 53), (device, at)


@pytest.mark.parametrize("level", [float("inf"), float("-inf")])
def test_windows_of_infinite_values_only(spark, level):
    """Their spread is no number, so they are not flat: no point lies inside and rule 8 alone fires."""
    got = fired(spc.evaluate(frame(spark, {"d": [level] * 30})))
    assert got == {("d", i): {8} if i >= 14 else set() for i in range(30)}


def test_tails_continue_a_series(spark):
    rng = random.Random(3)
    series = [rng.gauss(5, 2) for _ in range(120)]
    expected = zone_rules(series)
    carry, got = None, {}
    for start in range(0, 120, 30):
        part = spark.createDataFrame(
            [("d", "m", i, i, series[i]) for i in range(start, start + 30)], VALUES)
        got.update(fired(spc.evaluate(part, None, carry)))
        tail = spc.pack_tails(spc.closing_tail(part, carry)).collect()
        assert tail[0].tail == series[max(0, start + 6):start + 30]
        carry = spc.unpack_tails(spark.createDataFrame(tail))
    assert [got["d", i] for i in range(120)] == expected


@pytest.mark.parametrize("max_rows", [None, 7, 60])
def test_fields_of_readings_as_their_values(spark, max_rows):
    """Fields scored side by side give what each gives by itself, wherever Arrow batches and slices end."""
    series = {name: values[:120] for name, values in tied_series().items()}
    rows = [(name, i * 10, i, float(v), float(-i % 7)) for name, values in series.items() for i, v in enumerate(values)]
    readings = spark.createDataFrame(rows, "device_id string, timestamp long, seq long, a double, b double")
    plan = plan_slices(readings, max_rows) if max_rows else None
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "13")
    try:
        found = spc.evaluate_fields(plan.assign(readings) if plan else readings, ["a", "b"], plan).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    got = {(r.device_id, r.measurement, r.seq): (r.value, {n for n in spc.RULES if r[f"rule_{n}"]}) for r in found}
    expected = {}
    for name, values in series.items():
        for field, own in (("a", values), ("b", [-i % 7 for i in range(len(values))])):
            expected.update({(name, field, i): (float(own[i]), rules) for i, rules in enumerate(zone_rules(own)) if rules})
    assert got == expected and len(found) == len(expected)


def test_readings_are_sorted_once_and_no_frame_moves(spark, sf_dir):
    """A moving frame reads 25 rows per value and aggregate, and a sort per measurement costs a multiple of one per reading."""
    from trackline.plans.catalogue import catalogue

    for name in ("spc_ties", "spc_lathes"):
        plan = catalogue()[name].build(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
        assert "RowFrame, -24" not in plan
        below = plan[plan.index("Window ["):]
        assert "Generate" not in below


def test_violations_have_texts(spark):
    rows = spc.violations(spc.evaluate(frame(spark, {"d": [10.0, 10.1] * 10 + [50.0]}))).filter("seq = 20").collect()
    assert (1, "Point beyond 3-sigma control limit") in {(r.rule_number, r.rule_description) for r in rows}


def test_generated_code_stays_compilable(spark):
    """Methods above 8000 bytes of bytecode are not compiled by the JVM and run many times slower."""
    values = spark.range(100).select(F.lit("d").alias("device_id"), F.lit("m").alias("measurement"),
                                     F.col("id").alias("timestamp"), F.col("id").alias("seq"),
                                     F.rand(1).alias("value"))
    import re

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = str(spc.violations(spc.evaluate(values))._jdf.queryExecution().debug().codegenToSeq().toString())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(s) for s in re.findall(r"ByteCodeStats\((\d+),", text)]
    assert sizes and max(sizes) < 8000
