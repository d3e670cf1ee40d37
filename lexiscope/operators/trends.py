"""Trends over weeks: periods, top lists, grids, shares, ranks, movements.

Facts are long tables: counts (week_start date, language, count), totals (week_start, papers,
flagged). Ties are broken by name everywhere, so results don't depend on row order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiscope.functions.labels import name_order, period_key


def with_period(facts: DataFrame, granularity: str) -> DataFrame:
    return facts.withColumn("period", period_key(F.col("week_start"), granularity))


def trend_periods(counts: DataFrame, totals: DataFrame, granularity: str) -> DataFrame:
    """(period, sort_key, papers, flagged, unique_languages)."""
    t = with_period(totals, granularity).groupBy("period").agg(F.min("week_start").alias("sort_key"), F.sum("papers").alias("papers"), F.sum("flagged").alias("flagged"))
    u = with_period(counts, granularity).groupBy("period").agg(F.count_distinct("language").alias("unique_languages"))
    return t.join(u, "period", "left").withColumn("unique_languages", F.coalesce("unique_languages", F.lit(0)))


def period_counts(counts: DataFrame, granularity: str, by: str = "language") -> DataFrame:
    """(period, language or class, count)."""
    return with_period(counts, granularity).groupBy("period", by).agg(F.sum("count").alias("count"))


def language_totals(counts: DataFrame) -> DataFrame:
    return counts.groupBy("language").agg(F.sum("count").alias("count"))


def top_languages(counts: DataFrame, n: int = 10) -> DataFrame:
    return language_totals(counts).orderBy(F.desc("count"), name_order(F.col("language")), "language").limit(n)


def overall_totals(totals: DataFrame, counts: DataFrame) -> DataFrame:
    a = totals.agg(F.sum("papers").alias("papers"), F.sum("flagged").alias("flagged"))
    return a.crossJoin(counts.agg(F.count_distinct("language").alias("unique_languages")))  # one row each


def dense_grid(period_counts_: DataFrame, keys: DataFrame, key: str = "language") -> DataFrame:
    """(period, key, count) of all periods and the given keys; 0 where there is none. keys is a short list (a top ten, the classes)."""
    grid = period_counts_.select("period").distinct().crossJoin(keys.select(key).distinct())
    return grid.join(period_counts_, ["period", key], "left").withColumn("count", F.coalesce("count", F.lit(0)))


def class_shares(class_grid: DataFrame) -> DataFrame:
    """With share of the period's total and offset, the shares of smaller classes before."""
    by = Window.partitionBy("period")
    share = F.col("count") / F.greatest(F.sum("count").over(by), F.lit(1))
    before = by.orderBy("class").rowsBetween(Window.unboundedPreceding, -1)
    return class_grid.withColumn("share", share).withColumn("offset", F.coalesce(F.sum("share").over(before), F.lit(0.0)))


def ranks(period_counts_: DataFrame, limit: int | None = 10) -> DataFrame:
    """With rank in the period: by count downward, then name."""
    r = period_counts_.withColumn("rank", F.row_number().over(Window.partitionBy("period").orderBy(F.desc("count"), name_order(F.col("language")), "language")))
    return r if limit is None else r.where(F.col("rank") <= limit)


def segments(ranked: DataFrame, periods: DataFrame) -> DataFrame:
    """Links of a language's rank to the period just before; an absence breaks them. (language, period_from, period_to, rank_from, rank_to)."""
    # periods are weeks, months or years: few rows
    index = periods.select("period").distinct().withColumn("idx", F.row_number().over(Window.orderBy("period")))
    by = Window.partitionBy("language").orderBy("idx")
    r = ranked.join(index, "period").select(
        "language", F.lag("period").over(by).alias("period_from"), F.col("period").alias("period_to"),
        F.lag("rank").over(by).alias("rank_from"), F.col("rank").alias("rank_to"), (F.col("idx") - F.lag("idx").over(by)).alias("gap"),
    )
    return r.where("gap = 1").drop("gap")


def first_last(ranked: DataFrame) -> DataFrame:
    return ranked.groupBy("language").agg(
        F.min("period").alias("first_period"), F.min_by("rank", "period").alias("first_rank"),
        F.max("period").alias("last_period"), F.max_by("rank", "period").alias("last_rank"),
    )


def previous_period(periods: DataFrame, reference: bool = True, current: str | None = None) -> Column | str:
    """The second-to-last of all periods, or (reference False) the one before ``current``."""
    p = periods.select("period").distinct()
    if not reference:
        p = p.where(F.col("period") < current)
    rows = p.orderBy(F.desc("period")).limit(2).collect()
    k = 1 if reference else 0
    return rows[k].period if len(rows) > k else None


def movements(period_counts_: DataFrame, before: str, now: str, n: int = 10) -> DataFrame:
    """(language, status, rank_before, rank_now) of the top lists of two periods: matched, dropped or new; ranks are those of the full lists."""
    r = ranks(period_counts_.where(F.col("period").isin(before, now)), None)
    a = r.where(F.col("period") == before).select("language", F.col("rank").alias("rank_before"))
    b = r.where(F.col("period") == now).select("language", F.col("rank").alias("rank_now"))
    was, is_ = F.coalesce(F.col("rank_before") <= n, F.lit(False)), F.coalesce(F.col("rank_now") <= n, F.lit(False))
    status = F.when(was & is_, "matched").when(was, "dropped").when(is_, "new")
    return a.join(b, "language", "full").select("language", status.alias("status"), "rank_before", "rank_now").where("status IS NOT NULL")


def latest_movements(period_counts_: DataFrame, n: int = 10) -> DataFrame:
    """movements() between the last two periods, found by the plan itself; with one period all its top names are new."""
    last = period_counts_.select("period").distinct().orderBy(F.desc("period")).limit(2)
    which = F.broadcast(last.withColumn("k", F.row_number().over(Window.orderBy(F.desc("period")))))  # two rows
    r = ranks(period_counts_.join(which.select("period"), "period"), None).join(which, "period")
    both = r.groupBy("language").agg(F.max(F.when(F.col("k") == 2, F.col("rank"))).alias("rank_before"), F.max(F.when(F.col("k") == 1, F.col("rank"))).alias("rank_now"))
    was, is_ = F.coalesce(F.col("rank_before") <= n, F.lit(False)), F.coalesce(F.col("rank_now") <= n, F.lit(False))
    status = F.when(was & is_, "matched").when(was, "dropped").when(is_, "new")
    return both.select("language", status.alias("status"), "rank_before", "rank_now").where("status IS NOT NULL")


def class_flow(totals_by_language: DataFrame) -> DataFrame:
    """(class, count, grand_total) from (language, class, count); classes with nothing go."""
    c = totals_by_language.groupBy("class").agg(F.sum("count").alias("count")).where("count > 0")
    return c.crossJoin(c.agg(F.sum("count").alias("grand_total")))  # one row


def top_and_other(totals_by_language: DataFrame, n: int = 10) -> DataFrame:
    """(class, label, count, n_languages): each class's first n languages, and the others as one row."""
    by = Window.partitionBy("class").orderBy(F.desc("count"), name_order(F.col("language")), "language")
    r = totals_by_language.withColumn("rn", F.row_number().over(by))
    g = r.groupBy("class", F.when(F.col("rn") <= n, F.col("language")).alias("top")).agg(F.sum("count").alias("count"), F.count("*").alias("n_languages"))
    return g.select("class", F.coalesce("top", F.format_string("%d more languages not shown", "n_languages")).alias("label"), "count", "n_languages")


def fill_week(daily: DataFrame, week_starts: DataFrame) -> DataFrame:
    """(week_start, day, papers, flagged) of Monday to Sunday of each week; 0 where there is none. A Sunday start moves forward a day."""
    start = F.col("week_start")
    monday = F.when(F.dayofweek(start) == 1, F.date_add(start, 1)).otherwise(F.date_trunc("week", start).cast("date"))
    days = week_starts.select("week_start", F.explode(F.sequence(monday, F.date_add(monday, 6))).alias("day"))
    return days.join(daily, "day", "left").select("week_start", "day", F.coalesce("papers", F.lit(0)).alias("papers"), F.coalesce("flagged", F.lit(0)).alias("flagged"))


def pie_slices(class_totals: DataFrame) -> DataFrame:
    """With sweep and start angle in degrees; values of 0 and below go. class_totals has a row for each class."""
    c = class_totals.where("count > 0")
    whole = Window.orderBy(F.desc("count"), "class")  # a handful of classes
    total = F.sum("count").over(Window.partitionBy(F.lit(1)))
    sweep = 360.0 * F.col("count") / total
    return c.withColumn("sweep", sweep).withColumn("start_angle", F.coalesce(F.sum("sweep").over(whole.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))


def settled(labels: DataFrame, y: str = "y", gap: float = 16, by: str = "side", order: tuple[str, ...] = ()) -> DataFrame:
    """labels with ``label_y``: y moved down as far as it takes to be ``gap`` below the label before, by side; ``order`` starts with y, and ends ties.

    label_y[i] = max(y[i], label_y[i - 1] + gap) is a running maximum of y[i] - i * gap, with i * gap added again.
    """
    order = Window.partitionBy(by).orderBy(*(order or (y,)))
    place = F.row_number().over(order) * F.lit(float(gap))
    top = F.max(F.col(y) - F.col("_place")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return labels.withColumn("_place", place).withColumn("label_y", top + F.col("_place")).drop("_place")
