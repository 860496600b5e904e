"""The elasticity study for every start week at once: one pass over the store-weeks, whatever the number of windows.

A store-week lies in the windows of `weeks` weeks that start between `weeks - 1` weeks before it and its own week. So instead
of being copied into each of them it adds its amounts where the first of these windows starts and takes them back after the
last; running sums over the start weeks then hold every window's amounts. A store's weeks are summed so first, which gives the
runs of start weeks in which the store is kept, and each store-week is cut to those runs. Running sums are taken over at most one
row per start week, per store, price bin or pair, so no task holds more of a hot product than the calendar is long.

Amounts are decimals and counts, so what is added and taken back cancels exactly.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salescube.functions.dates import week_range
from salescube.functions.measures import KILOGRAMS
from salescube.functions.text import range_label
from salescube.plans.elasticity import ACTIVE_SHARE, BIN_WIDTH, COVERAGE_SHARE, PAIR, STORE, active_limit, covered, fits, placed
from salescube.sources.scratch import stage

START = "window_start"
KEYS = [START, *PAIR]


def _changes(rows: DataFrame, keys: Sequence[str], first: Column, final: Column, amounts: dict[str, Column], last: int) -> DataFrame:
    """Amounts added at start week `first` and taken back after `final`, as far as the start weeks go."""
    came = F.struct(first.alias("start"), *[a.alias(n) for n, a in amounts.items()])
    went = F.struct((final + 1).alias("start"), *[(-a).alias(n) for n, a in amounts.items()])
    edges = rows.select(*keys, F.inline(F.array(came, went)))
    return edges.where(F.col("start") <= last)


def _held(changes: DataFrame, keys: Sequence[str], amounts: Sequence[str], last: int) -> DataFrame:
    """The amounts that hold from start week `lo` to `hi`, between two changes."""
    summed = changes.groupBy(*keys, "start").agg(*[F.sum(a).alias(a) for a in amounts])
    order = Window.partitionBy(*keys).orderBy("start")
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return summed.select(
        *keys,
        F.col("start").alias("lo"),
        (F.lead("start", 1, last + 1).over(order) - 1).alias("hi"),
        *[F.sum(a).over(running).alias(a) for a in amounts],
    )


def _each_start(held: DataFrame, first: date) -> DataFrame:
    """One row per window, named by the Monday it starts on."""
    week = F.explode(F.sequence("lo", "hi"))
    return held.select(week.alias("start"), *held.columns).select(
        F.date_add(F.lit(first), F.col("start") * 7).alias(START), *[c for c in held.columns if c not in ("lo", "hi")]
    )


class Windows:
    """All windows of `weeks` whole weeks inside `span` weeks from `start`; none if the span is shorter.

    `weekly` are the store-weeks of the span (`elasticity.store_weeks`). They are staged, narrowed to what the windows need.
    """

    def __init__(self, weekly: DataFrame, start: date, span: int, weeks: int, active_share: float = ACTIVE_SHARE):
        self.first, _ = week_range(start, span)
        week_range(start, weeks)
        self.weeks, self.last, self.share = weeks, span - weeks, active_share
        number = F.floor(F.datediff("week_start_date", F.lit(self.first)) / 7).cast("int")
        rows = weekly.select(
            *STORE, number.alias("week"), "price_bin", F.coalesce("kg", F.lit(0)).cast(KILOGRAMS).alias("kg")
        ).where((F.lit(self.last) >= 0) & F.col("week").between(0, span - 1))
        self.rows = stage(rows, "window-weeks")
        self.opens = F.greatest(F.col("week") - (weeks - 1), F.lit(0))
        self.closes = F.least(F.col("week"), F.lit(self.last))

    def _turns(self) -> DataFrame:
        """Where a store enters (1) or leaves (-1) the listed and the kept stores."""
        sold = _changes(self.rows, STORE, self.opens, self.closes, {"wks": F.lit(1).cast("long")}, self.last)
        order = Window.partitionBy(*STORE).orderBy("lo")
        flags = _held(sold, STORE, ["wks"], self.last).select(
            *STORE, "lo",
            (F.col("wks") > 0).cast("long").alias("listed"),
            (F.col("wks") > active_limit(self.weeks, self.share)).cast("long").alias("kept"),
        )
        return flags.select(
            *STORE, F.col("lo").alias("start"),
            *[(F.col(c) - F.lag(c, 1, 0).over(order)).alias(c) for c in ("listed", "kept")],
        )

    def kept_runs(self) -> DataFrame:
        """Per product and store: runs of start weeks, by number from `lo` to `hi`, in whose windows the store is kept."""
        order = Window.partitionBy(*STORE).orderBy("start")
        turns = self._turns().where(F.col("kept") != 0)
        runs = turns.select(*STORE, "kept", F.col("start").alias("lo"), (F.lead("start", 1, self.last + 1).over(order) - 1).alias("hi"))
        return runs.where(F.col("kept") == 1).drop("kept")

    def kept_spans(self) -> DataFrame:
        """The runs by the Mondays of their first and last window."""
        days = [F.date_add(F.lit(self.first), F.col(c) * 7).alias(n) for c, n in (("lo", "first_start"), ("hi", "last_start"))]
        return self.kept_runs().select(*STORE, *days)

    def _kept_changes(self) -> DataFrame:
        """What kept store-weeks add to and take from a price bin."""
        meets = (F.col("lo") <= self.closes) & (F.col("hi") >= self.opens)
        kept = self.rows.join(self.kept_runs(), STORE).where(meets)
        first, final = F.greatest("lo", self.opens), F.least("hi", self.closes)
        return _changes(kept, [*PAIR, "price_bin"], first, final, {"kg": F.col("kg"), "akb": F.lit(1).cast("long")}, self.last)

    def levels(self, width: float = BIN_WIDTH, coverage_share: float = COVERAGE_SHARE, base: str = "all") -> DataFrame:
        """Price bins of kept stores by window and pair, as `elasticity.price_levels` has them for one window.

        A pair that sold in a window but kept no store there has one row without a bin.
        """
        bins = stage(self._kept_changes().groupBy(*PAIR, "price_bin", "start").agg(F.sum("kg").alias("kg"), F.sum("akb").alias("akb")), "bins")
        zero = F.lit(0).cast("long")
        weighed = _changes(self.rows, PAIR, self.opens, self.closes, {"listed_kg": F.col("kg")}, self.last)
        totals = ["listed_kg", "listed_stores", "kept_stores", "kept_rows"]
        parts = [
            weighed.select(*PAIR, "start", "listed_kg", zero.alias("listed_stores"), zero.alias("kept_stores"), zero.alias("kept_rows")),
            self._turns().select(*PAIR, "start", F.lit(0).cast(KILOGRAMS).alias("listed_kg"), F.col("listed").alias("listed_stores"),
                                 F.col("kept").alias("kept_stores"), zero.alias("kept_rows")),
            bins.select(*PAIR, "start", F.lit(0).cast(KILOGRAMS).alias("listed_kg"), zero.alias("listed_stores"),
                        zero.alias("kept_stores"), F.col("akb").alias("kept_rows")),
        ]
        of_pair = _held(parts[0].unionByName(parts[1]).unionByName(parts[2]), PAIR, totals, self.last).where(F.col("listed_stores") > 0)
        of_bin = _held(bins, [*PAIR, "price_bin"], ["kg", "akb"], self.last).where(F.col("akb") > 0)
        joined = _each_start(of_pair, self.first).join(_each_start(of_bin, self.first), KEYS, "left")
        counted = joined.select(
            *KEYS, "price_bin", range_label(F.col("price_bin"), width).alias("price_bin_range"), "kg",
            F.coalesce("akb", zero).alias("akb"), *totals,
        )
        return covered(counted, self.weeks, coverage_share, base)

    def fits(self, width: float = BIN_WIDTH, coverage_share: float = COVERAGE_SHARE, base: str = "all") -> DataFrame:
        """The fit of every pair in every window in which it sold."""
        return fits(placed(self.levels(width, coverage_share, base), width), KEYS)
