"""Scoring and decision tables as expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from docgraph.functions import fixed

CLASSES = "ABCD"


def importance(d1: Column, d2: Column, d3: Column) -> Column:
    """Weighted mean of three scores, rounded; in whole tenths, so no floating error."""
    tenths = d1 * fixed.WEIGHTS["D1"] + d2 * fixed.WEIGHTS["D2"] + d3 * fixed.WEIGHTS["D3"]
    return F.floor((tenths + 5) / 10).cast("int")


def action_class(d4: Column, d5: Column, d6: Column, urgent: int = fixed.URGENT_FROM,
                 practical: int = fixed.PRACTICAL_FROM) -> Column:
    """Urgency by practicability gives A to D; the window score moves it one step."""
    cell = F.when(d4 >= urgent, F.when(d5 >= practical, 1).otherwise(2)).otherwise(
        F.when(d5 >= practical, 3).otherwise(4))
    step = F.when(d6 >= fixed.STEP_UP_FROM, -1).when(d6 <= fixed.STEP_DOWN_TO, 1).otherwise(0)
    index = F.greatest(F.lit(1), F.least(F.lit(4), cell + step))
    return F.substring(F.lit(CLASSES), index, F.lit(1))


def archive_flag(score: Column) -> Column:
    return F.when(score < fixed.ARCHIVE_BELOW, "low_score")


def display_class(score: Column, hit: Column) -> Column:
    """The report's class; shares its letters with ``action_class`` but not its meaning."""
    return (F.when((score >= 5) & hit, "A").when((score == 4) & hit, "B")
            .when((score == 3) & hit, "C").otherwise("D"))


def triage(hit: Column, mandatory: Column, deadline: Column) -> Column:
    """The quick decision tree."""
    return (F.when(~hit, "note").when(mandatory, "act now").when(deadline, "study first")
            .otherwise("assess"))


def high_low(score: Column, cut: int = 4) -> Column:
    return F.when(score >= cut, "high").otherwise("low")


def confidence_bucket(c: Column) -> Column:
    return (F.when(c >= fixed.CONFIDENCE_HIGH, "high").when(c >= fixed.CONFIDENCE_MID, "mid")
            .otherwise("low"))
