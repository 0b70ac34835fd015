"""State histories against the state of every day."""

from datetime import date, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from statuta.operators import temporal

SCHEMA = "unit string, action string, date date, applied boolean"
DAYS = [date(2020, 1, 1) + timedelta(days=i) for i in range(8)]


def on(effects, day):
    """unit to (state, since, action) on a day, effect by effect."""
    out = {}
    for unit in {e[0] for e in effects if e[0] is not None}:
        own = [e for e in effects if e[0] == unit and e[3] is not False]
        done = [e for e in own if e[2] is not None and e[2] <= day]
        repeals = [e[2] for e in done if e[1] == "repeal"]
        texts = [e[2] for e in done if e[1] in ("substitution", "insertion")]
        others = sorted((e[2], e[1]) for e in done if e[1] not in ("repeal", "substitution", "insertion", "commencement", None))
        forces = [e[2] for e in own if e[1] == "commencement"]
        live = [d for d in forces if d is not None and d <= day]
        if repeals:
            out[unit] = "repealed", max(repeals), None
        elif forces and not live:
            out[unit] = "not_yet_in_force", min((d for d in forces if d is not None), default=None), None
        elif texts:
            out[unit] = "text_unapplied", max(texts), None
        elif others:
            out[unit] = "affected", *others[0]
        elif live:
            out[unit] = "in_force", max(live), None
    return out


EFFECTS = st.lists(st.tuples(st.sampled_from(["u", "v", "w", None]), st.sampled_from(["repeal", "substitution", "insertion", "commencement", "renumbering", "extension", None]), st.sampled_from([*DAYS[1:7], None]), st.sampled_from([True, True, False, None])), max_size=14)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(EFFECTS)
def test_every_day(spark, effects):
    frame = spark.createDataFrame(effects, SCHEMA)
    spans = temporal.state_history(frame).collect()
    for day in DAYS:
        held = [r for r in spans if (r["start"] is None or r["start"] <= day) and (r["until"] is None or day < r["until"])]
        assert len(held) == len({r["unit"] for r in held})
        assert {r["unit"]: (r["state"], r["since"], r["action"]) for r in held} == on(effects, day)
    states = {r["unit"]: r["state"] for r in temporal.state_at(frame.where("action is not null"), F.lit(DAYS[4])).collect()}
    assert states == {u: s for u, (s, *_) in on(effects, DAYS[4]).items()}
    keys = [(r["unit"], r["start"]) for r in spans]
    assert len(keys) == len(set(keys))


def test_no_effects(spark):
    assert temporal.state_history(spark.createDataFrame([], SCHEMA)).count() == 0
