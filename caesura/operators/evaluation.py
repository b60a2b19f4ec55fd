"""Segmentation metrics over arrays of boundary positions, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from caesura.functions.text import let


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b == 0, 0.0).otherwise(a / b)


def matched(gold: Column, predicted: Column, tolerance: int = 0) -> Column:
    """How many predictions, ascending, find a gold boundary of their own within the tolerance: the nearest left, of equals the smaller."""
    gold, predicted = F.array_sort(F.array_distinct(gold)), F.array_sort(F.array_distinct(predicted))
    if tolerance == 0:
        return F.size(F.array_intersect(gold, predicted))

    def step(state: Column, p: Column) -> Column:
        near = F.filter(state["left"], lambda g: F.abs(g - p) <= tolerance)
        least = F.array_min(F.transform(near, lambda g: F.abs(g - p)))
        chosen = F.array_min(F.filter(near, lambda g: F.abs(g - p) == least))
        return F.struct(F.when(chosen.isNull(), state["left"]).otherwise(F.filter(state["left"], lambda g: g != chosen)).alias("left"), (state["tp"] + F.when(chosen.isNull(), 0).otherwise(1)).alias("tp"))

    return F.aggregate(predicted, F.struct(gold.alias("left"), F.lit(0).alias("tp")), step, lambda s: s["tp"])


def boundary_f1(gold: Column, predicted: Column, tolerance: int = 0) -> Column:
    """struct of tp, fp, fn, precision, recall, f1; both empty is perfect."""

    def rates(x: Column) -> Column:
        empty = (x["g"] == 0) & (x["p"] == 0)
        precision = F.when(empty, 1.0).otherwise(_ratio(x["tp"], x["p"]))
        recall = F.when(empty, 1.0).otherwise(_ratio(x["tp"], x["g"]))
        f1 = F.when(empty, 1.0).otherwise(_ratio(2 * x["tp"], x["g"] + x["p"]))
        return F.struct(x["tp"].alias("tp"), (x["p"] - x["tp"]).alias("fp"), (x["g"] - x["tp"]).alias("fn"), precision.alias("precision"), recall.alias("recall"), f1.alias("f1"))

    sets = F.struct(F.array_distinct(gold).alias("g"), F.array_distinct(predicted).alias("p"))
    counts = lambda s: F.struct(matched(s["g"], s["p"], tolerance).alias("tp"), F.size(s["g"]).alias("g"), F.size(s["p"]).alias("p"))
    return let(sets, lambda s: let(counts(s), rates))


def window_size(n: Column, gold: Column) -> Column:
    """Half the mean gold segment, to the nearest even on ties, within 1 and n - 1."""
    segments = F.size(F.array_distinct(F.filter(gold, lambda b: (b >= 1) & (b < n)))) + 1
    return F.greatest(F.lit(1), F.least(n - 1, F.bround(n / segments / 2, 0).cast("int")))


def _disagreement(n: Column, gold: Column, predicted: Column, differ) -> Column:
    """The share of windows of k places in which gold and predicted differ. Numbers of boundaries before each place are counted once."""

    def before(places: Column) -> Column:
        """Element i is how many places are below i + 1."""
        marks = F.transform(F.sequence(F.lit(1), n), lambda i: F.array_contains(places, i).cast("int"))
        sums = F.aggregate(marks, F.array(F.lit(0)), lambda s, m: F.concat(s, F.array(F.element_at(s, -1) + m)))
        return sums

    def share(x: Column) -> Column:
        inside = lambda c, i: F.get(x[c], i + x["k"] - 1) - F.get(x[c], i - 1)
        return F.size(F.filter(F.sequence(F.lit(1), n - x["k"]), lambda i: differ(inside("g", i), inside("p", i)))) / (n - x["k"])

    some = lambda c: F.coalesce(c, F.array().cast("array<int>"))
    both = F.struct(window_size(n, gold).alias("k"), before(some(gold)).alias("g"), before(some(predicted)).alias("p"))
    return F.when(n <= 1, 0.0).otherwise(let(both, lambda x: F.when(n - x["k"] < 1, 0.0).otherwise(share(x))))


def pk(n: Column, gold: Column, predicted: Column) -> Column:
    return _disagreement(n, gold, predicted, lambda g, p: (g == 0) != (p == 0))


def window_diff(n: Column, gold: Column, predicted: Column) -> Column:
    return _disagreement(n, gold, predicted, lambda g, p: g != p)
