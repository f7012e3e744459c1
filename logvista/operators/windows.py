"""Longitudinal operators over each actor's sequence of events.

The order is actor, time, then the tie-breakers. All windows of an actor share one hash exchange: those over (actor, value)
are satisfied by it too. Two rules keep ties right. A trailing count ends at the current row in that order, not at its time, so
that later events of the same instant are left out. A trailing distinct count works on hours and likewise ends at the
current row within its hour.

No trailing number is made of a sliding frame, which costs a window's rows for each row. ``Sequence.sweep`` puts the moments
at which events and values leave their windows between the events, and all numbers are running sums over both: each event
costs the same however many others its window holds.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.scalar import haversine

HOUR_US = 3_600_000_000
DAY_US = 24 * HOUR_US


@dataclass(frozen=True)
class Sequence:
    """The columns that order events; ``time`` is a timestamp (cast zone-less ones first)."""

    actor: str = "actor_pseudo_id"
    time: str = "event_time"
    ties: tuple[str, ...] = ("event_id",)

    @property
    def us(self) -> Column:
        return F.unix_micros(F.col(self.time))

    @property
    def hour(self) -> Column:
        return F.floor(self.us / HOUR_US)

    @property
    def order(self) -> list[Column]:
        return [F.col(self.time), *(F.col(t) for t in self.ties)]

    def rows(self, *more: str) -> WindowSpec:
        return Window.partitionBy(self.actor, *more).orderBy(*self.order)

    def so_far(self) -> WindowSpec:
        return self.rows().rowsBetween(Window.unboundedPreceding, 0)

    # --- history

    def seq_no(self) -> Column:
        return F.row_number().over(self.rows()).cast("long")

    def prior_count(self) -> Column:
        return self.seq_no() - 1

    def us_since_last(self) -> Column:
        return self.us - F.lag(self.us).over(self.rows())

    def hours_since_last(self) -> Column:
        return F.bround(self.us_since_last() / HOUR_US, 4)

    def hours_since_first(self) -> Column:
        return F.bround((self.us - F.min(self.us).over(Window.partitionBy(self.actor))) / HOUR_US, 4)

    def calendar_days(self, most: int = 30) -> Column:
        day = F.to_date(F.col(self.time))
        return F.least(F.lit(most), F.datediff(day, F.min(day).over(Window.partitionBy(self.actor))) + 1)

    # --- values

    def is_first(self, value: str) -> Column:
        """1 at a value's first occurrence, 0 later, null for null."""
        return F.when(F.col(value).isNotNull(), (F.row_number().over(self.rows(value)) == 1).cast("int"))

    def _changed(self, now: Column, null_as_zero: bool) -> Column:
        before = F.lag(now).over(self.rows())
        differs = (now != before).cast("int")
        first = F.row_number().over(self.rows()) == 1
        return F.when(first, 0).otherwise(F.coalesce(differs, F.lit(0)) if null_as_zero else differs)

    def changed(self, value: str, null_as_zero: bool = False) -> Column:
        """Whether a value differs from the previous event's; 0 at the first event, null (or 0) if either is null."""
        return self._changed(F.col(value), null_as_zero)

    def to_date(self, value: str, first: str | None = None) -> Column:
        """Distinct known values so far; ``first`` names a column that holds ``is_first(value)`` already."""
        return F.sum(F.coalesce(F.col(first) if first else self.is_first(value), F.lit(0))).over(self.so_far())

    def set_changed(self, tokens: str, null_as_zero: bool = False) -> Column:
        return self._changed(F.array_join(F.array_sort(F.array_distinct(tokens)), "|"), null_as_zero)

    # --- trailing numbers

    def _gaps(self, value: str, hours: int) -> tuple[Column, Column]:
        """For rows with ``hour_``: whether a known value enters the window here, and when it leaves unless it comes again before."""
        w, known, hour = self.rows(value), F.col(value).isNotNull(), F.col("hour_")
        before, after = F.lag(hour).over(w), F.lead(hour).over(w)
        enters = known & (before.isNull() | (hour - before > hours))
        leaves = F.when(known & (after.isNull() | (after - hour > hours)), (hour + hours + 1) * HOUR_US)
        return F.coalesce(enters, F.lit(False)).cast("int"), leaves

    def _with_tokens(self, df: DataFrame, column: str, hours: int, new: str) -> DataFrame:
        """Adds ``new`` (whether a set holds a token that the actor never had, null for null), tokens_in_ and tokens_out_."""
        each = df.withColumn("row_", F.monotonically_increasing_id())
        each = each.select(self.actor, "row_", F.struct(*df.columns).alias("doc_"), "hour_", *dict.fromkeys(c for c in (self.time, *self.ties)), F.explode_outer(F.array_distinct(column)).alias("token_"))
        enters, leaves = self._gaps("token_", hours)
        each = each.select(self.actor, "row_", "doc_", self.is_first("token_").alias("f_"), enters.alias("in_"), leaves.alias("out_"))
        marked = each.groupBy(self.actor, "row_").agg(F.first("doc_").alias("doc_"), F.max("f_").alias("f_"), F.sum("in_").alias("tokens_in_"), F.collect_list("out_").alias("tokens_out_"))
        some = F.when(F.col(f"doc_.{column}").isNotNull(), F.coalesce("f_", F.lit(0)))
        return marked.select("doc_.*", some.alias(new), "tokens_in_", "tokens_out_")

    def sweep(
        self, df: DataFrame, logins: dict[str, float] | None = None, distinct: dict[str, tuple[str, int]] | None = None, active: dict[str, int] | None = None,
        tokens: tuple[str, int, str, str] | None = None, running: dict[str, str] | None = None, more: dict[str, Column] | None = None, number: str = "seq_no_",
    ) -> DataFrame:
        """``df`` with ``number`` (the row's number in its sequence, from 1) and

        - logins: events in [t - days, this row], by name and days;
        - distinct: known values in the hours [h - hours, h], this hour up to this row, by name, value and hours;
        - active: distinct UTC dates among this one and the days - 1 before;
        - tokens (column, hours, new, out): the same of arrays of tokens, and whether the actor never had one of them;
        - running: sums so far of 0/1 columns (null as 0), of ``df`` or ``more``;
        - more: any other columns over windows, made before.
        """
        logins, distinct, active, running = logins or {}, distinct or {}, active or {}, running or {}
        d = df.repartition(F.col(self.actor)).withColumns({"us_": self.us, "hour_": self.hour})  # the one exchange, which all windows share
        if tokens:
            d = self._with_tokens(d, tokens[0], tokens[1], tokens[2])
        made: dict[str, Column] = dict(more or {})
        for i, (value, hours) in enumerate(distinct.values()):
            made[f"in{i}_"], made[f"out{i}_"] = self._gaps(value, hours)
        day = F.unix_date(F.to_date(F.col(self.time)))
        if active:
            made["day_"] = F.when(F.coalesce(F.lag(day).over(self.rows()) != day, F.lit(True)), day)
        keep = [*dict.fromkeys([*df.columns, *([tokens[2]] if tokens else []), *(more or {})])]
        d = d.withColumns(made) if made else d
        mark = lambda t, kind, which, row=None: F.struct(
            t.cast("long").alias("t_"), F.lit(kind).alias("kind_"), F.lit(which).alias("which_"), (F.lit(None).cast(shape) if row is None else row).alias("row_")
        )
        row = F.struct(*d.columns)
        shape = d.select(row.alias("r")).schema["r"].dataType
        # What leaves at a row's time has left before it (kind 0), but for events, which stay to the end of their window (kind 2).
        marks = [mark(F.col("us_"), 1, 0, row)]
        code, left = 0, {}
        for out, days in logins.items():
            left[out] = code = code + 1
            marks.append(mark(F.col("us_") + int(days * DAY_US), 2, code))
        for i, out in enumerate(distinct):
            left[out] = code = code + 1
            marks.append(mark(F.col(f"out{i}_"), 0, code))
        for out, days in active.items():
            left[out] = code = code + 1
            marks.append(mark((F.col("day_") + days).cast("long") * DAY_US, 0, code))
        marks = F.filter(F.array(*marks), lambda m: m["t_"].isNotNull())
        if tokens:
            left[tokens[3]] = code = code + 1
            marks = F.concat(marks, F.transform("tokens_out_", lambda t: mark(t, 0, code)))
        swept = d.select(self.actor, F.explode(marks).alias("m_")).select(self.actor, "m_.*")
        w = Window.partitionBy(self.actor).orderBy("t_", "kind_", *(F.col(f"row_.{c}") for c in self.ties)).rowsBetween(Window.unboundedPreceding, 0)
        so_far = lambda c: F.sum(c).over(w)
        gone = lambda out: so_far((F.col("which_") == left[out]).cast("int"))
        is_row = (F.col("which_") == 0).cast("int")
        entered = {out: F.coalesce(F.col(f"row_.in{i}_"), F.lit(0)) for i, out in enumerate(distinct)}
        entered |= {out: F.col("row_.day_").isNotNull().cast("int") for out in active} | ({tokens[3]: F.coalesce("row_.tokens_in_", F.lit(0))} if tokens else {})
        out = {number: so_far(is_row)} | {c: so_far(is_row) - gone(c) for c in logins} | {c: (so_far(x) - gone(c)).cast("int") for c, x in entered.items()}
        out |= {c: so_far(F.coalesce(F.col(f"row_.{f}"), F.lit(0))) for c, f in running.items()}
        swept = swept.select(self.actor, "which_", "row_", *(x.alias(f"n{i}_") for i, x in enumerate(out.values()))).where("which_ = 0")
        return swept.select(*(F.col(f"row_.`{c}`").alias(c) for c in keep if c not in out), *(F.col(f"n{i}_").alias(c) for i, c in enumerate(out)))

    # --- travel

    def distance(self, lat: str = "latitude", lon: str = "longitude") -> Column:
        """Unrounded kilometres from the previous event."""
        w = self.rows()
        return haversine(F.lag(lat).over(w), F.lag(lon).over(w), F.col(lat), F.col(lon))

    def backwards(self, hour: str) -> Column:
        """Whether a published hour lies before the previous event's."""
        return F.col(hour) < F.lag(hour).over(self.rows())


def speed(distance: Column, hours: Column) -> Column:
    """Unrounded km/h; null without a positive interval."""
    return F.when(hours > 0, distance / hours)
