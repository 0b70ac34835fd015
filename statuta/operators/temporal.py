"""As-at states of units from dated effects, change dates, eras and folded mirrors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

FORCE, REPEAL, TEXT = "commencement", "repeal", ["substitution", "insertion"]


def state_at(effects: DataFrame, as_at: Column) -> DataFrame:
    """unit and state at a date from effects (unit, action, date, applied).

    Repeal outranks all; then an open commencement, texts changed, and other effects. Future and
    undated effects don't count, except that a unit with only future commencements isn't in force.
    """
    due = F.col("date") <= as_at
    applied = F.coalesce(F.col("applied"), F.lit(True))
    each = effects.where(F.col("unit").isNotNull()).groupBy("unit").agg(
        F.count_if((F.col("action") == REPEAL) & due & applied).alias("repeals"),
        F.count_if(F.col("action").isin(*TEXT) & due & applied).alias("texts"),
        F.count_if(~F.col("action").isin(FORCE, REPEAL, *TEXT) & due & applied).alias("others"),
        F.count_if((F.col("action") == FORCE) & applied).alias("forces"),
        F.count_if((F.col("action") == FORCE) & due & applied).alias("open"),
    )
    state = F.when(F.col("repeals") > 0, "repealed").when((F.col("forces") > 0) & (F.col("open") == 0), "not_yet_in_force").when(F.col("texts") > 0, "text_unapplied").when(F.col("others") > 0, "affected").when(F.col("open") > 0, "in_force")
    return each.select("unit", state.alias("state")).where("state is not null")


def state_history(effects: DataFrame) -> DataFrame:
    """unit, state, since, action, start and until: the states of each unit from effects (unit, action, date, applied), as `state_at` tells them for any day.

    A state holds from `start` (null: always before) to the day before `until` (null: still). `since` is
    the date of the effect that it stems from: the latest repeal, text change or commencement, the first
    of other effects, the next commencement of a unit not in force (null if all are undated). `action`
    names that other effect where the state is affected, the least of several of one day. Effects that
    aren't applied, or of no unit, don't count. Repeated effects change nothing. Each unit's effects of
    a day are one row before they are walked in order of date.
    """
    own = effects.where(F.col("unit").isNotNull() & F.coalesce(F.col("applied"), F.lit(True)))
    kind = F.col("action")
    # A row of no date stands for the time before a unit's first one.
    every = own.select("unit", "date", "action").unionByName(own.select("unit", F.lit(None).cast(own.schema["date"].dataType).alias("date"), F.lit(None).cast("string").alias("action")).distinct())
    days = every.groupBy("unit", "date").agg(
        F.max(kind == REPEAL).alias("repeal"), F.max(kind.isin(*TEXT)).alias("text"), F.max(kind == FORCE).alias("force"), F.min(F.when(~kind.isin(FORCE, REPEAL, *TEXT), kind)).alias("other")
    )
    by = Window.partitionBy("unit")
    order = by.orderBy(F.col("date").asc_nulls_first())
    so_far, later = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(1, Window.unboundedFollowing)
    of = lambda name: F.when(F.col(name), F.col("date"))
    seen = days.select(
        "unit", "date", F.max("force").over(by).alias("forces"), *[F.max(of(name)).over(so_far).alias(name) for name in ("repeal", "text", "force")],
        F.min(F.when(F.col("other").isNotNull() & F.col("date").isNotNull(), F.struct("date", "other"))).over(so_far).alias("other"), F.min(of("force")).over(later).alias("next"),
    )
    dormant = F.coalesce("forces", F.lit(False)) & F.col("force").isNull()
    ways = [(F.col("repeal").isNotNull(), "repealed", F.col("repeal")), (dormant, "not_yet_in_force", F.col("next")), (F.col("text").isNotNull(), "text_unapplied", F.col("text")), (F.col("other").isNotNull(), "affected", F.col("other.date")), (F.col("force").isNotNull(), "in_force", F.col("force"))]
    now = F.coalesce(*[F.when(holds, F.struct(F.lit(name).alias("state"), since.alias("since"), F.when(F.lit(name) == "affected", F.col("other.other")).alias("action"))) for holds, name, since in ways])
    told = seen.select("unit", "date", now.alias("now"))
    changed = told.withColumns({"before": F.lag("now").over(order), "first": F.row_number().over(order) == 1}).where(F.col("first") | ~F.col("now").eqNullSafe(F.col("before")))
    spans = changed.select("unit", "now", F.col("date").alias("start"), F.lead("date").over(order).alias("until")).where("now is not null")
    return spans.select("unit", "now.state", "now.since", "now.action", "start", "until")


def holes(effects: DataFrame, as_at: Column) -> DataFrame:
    """One row of counts: effects that can't be placed, by cause."""
    due = F.col("date").isNull() | (F.col("date") <= as_at)
    undated, unapplied = F.col("date").isNull(), F.coalesce(F.col("applied"), F.lit(True)) == F.lit(False)
    # A commencement that is both counts as unapplied, any other effect as undated.
    force = F.col("action") == FORCE
    counted = {"undated": undated & ~(F.coalesce(force, F.lit(False)) & unapplied), "unapplied": unapplied & (~undated | F.coalesce(force, F.lit(False)))}
    return effects.where(due).agg(F.count_if(F.col("unit").isNull()).alias("no_target"), *[F.count_if(F.col("unit").isNotNull() & c).alias(name) for name, c in counted.items()])


def change_dates(effects: DataFrame) -> DataFrame:
    return effects.groupBy("unit").agg(F.sort_array(F.collect_set("date")).alias("dates"))


def fold_mirrors(effects: DataFrame, key: list[str], supplier: str) -> DataFrame:
    """For each key the multiplicity of the supplier that has most rows (the least supplier of several)."""
    counted = effects.groupBy(*key, supplier).agg(F.count("*").alias("n"))
    first = Window.partitionBy(*key).orderBy(F.desc("n"), supplier)
    return counted.withColumn("__rn", F.row_number().over(first)).where("__rn = 1").drop("__rn")


def era_of(year: Column, eras: list[tuple[str, int, int]]) -> Column:
    """The first era (name, from, to) that holds a year."""
    out = F.lit(None).cast("string")
    for name, low, high in reversed(eras):
        out = F.when(year.between(low, high), F.lit(name)).otherwise(out)
    return out
