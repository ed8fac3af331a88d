"""Conversation and survey numbers that outlive the lookback.

Inside a lookback alone, numbers restart at its first day, so the n-th conversation of a
user meets another survey than in a run over everything. The ledger stores what the days
before the lookback leave behind:

* per user id and side, how many rows there were (added to the numbers of the rows since);
* the rows still without a partner, with their numbers: a conversation that waits for
  its survey, a survey that waits for its conversation.

Before a run, ``advance`` takes the days that have left the lookback since the last run
into the state; they are read once, in that run. ``pairs`` then numbers and pairs the
rows of the lookback with the waiting ones, and gives the same pairs as a run over all
days. Overlapping lookbacks are fine: only closed days are in the state. Ids of any size
are numbered by ranges (``ordered_numbers``), never in one task.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cxlake.operators.dashboard import FIFO_GROUP, FIFO_ORDER, fifo_rows, pair_numbered
from cxlake.operators.ranking import ordered_numbers
from cxlake.operators.sessions import JOIN_KEY
from cxlake.plans.tabledef import TableDef
from cxlake.session import use_checkpoint_dir
from cxlake.sinks.tables import TableStore

def _day() -> Column:
    return F.coalesce("message_date", "fecha_encuesta")


@dataclass(frozen=True)
class FifoLedger:
    store: TableStore
    name: str = "fifo_ledger"
    database: str | None = None
    survey_tie_breaker: str | None = "event_id"

    def tdef(self) -> TableDef:
        return TableDef(self.name, "python", python_source=self.name, database=self.database, fail_if_empty=False)

    def _state(self) -> DataFrame | None:
        return self.store.spark.table(self.tdef().full_name) if self.store.exists(self.tdef()) else None

    def closed_before(self) -> dt.date | None:
        """The first day that is not in the state (None: nothing is)."""
        state = self._state()
        return None if state is None else state.agg(F.max("closed_before")).first()[0]

    def _numbered(self, ends: DataFrame, clean: DataFrame, until: dt.date | None) -> tuple[DataFrame, DataFrame | None]:
        """Rows from the state's day on (to ``until``), numbered over all time, and the state's waiting rows."""
        rows, since = fifo_rows(ends, clean, self.survey_tie_breaker), self.closed_before()
        if since is not None:
            rows = rows.where(_day() >= F.lit(since))
        if until is not None:
            rows = rows.where(_day() < F.lit(until))
        numbered = ordered_numbers(rows, FIFO_GROUP, FIFO_ORDER, "_n").withColumn("_n", F.col("_n").cast("long"))
        state = self._state()
        if state is None:
            return numbered, None
        seen = state.where("kind = 'seen'").select(F.col("id").alias("_id"), F.col("_side").alias("_s"), F.col("_n").alias("_before"))
        same = numbered["id"].eqNullSafe(seen["_id"]) & (numbered["_side"] == seen["_s"])
        offset = numbered.join(seen, same, "left").withColumn("_n", F.col("_n") + F.coalesce("_before", F.lit(0)))
        return offset.select(*numbered.columns), state.where("kind = 'waiting'").select(*numbered.columns)

    def advance(self, ends: DataFrame, clean: DataFrame, until: dt.date) -> None:
        """Take the days before ``until`` into the state; days that are in it already are not counted again."""
        since = self.closed_before()
        if since is not None and until <= since:
            return
        use_checkpoint_dir(ends.sparkSession)
        numbered, waiting = self._numbered(ends, clean, until)
        numbered = numbered.checkpoint()
        counts = numbered.groupBy(*FIFO_GROUP).agg(F.count(F.lit(1)).alias("_n"))
        named = numbered.where("id is not null")
        if waiting is not None:
            named = named.unionByName(waiting)
            counts = counts.unionByName(self._state().where("kind = 'seen'").select("id", "_side", "_n"))
            counts = counts.groupBy(*FIFO_GROUP).agg(F.sum("_n").alias("_n"))
        partners = named.groupBy("id", "_n").agg(F.count(F.lit(1)).alias("sides")).where("sides = 1").drop("sides")
        alone = named.join(partners, ["id", "_n"], "left_semi").select(F.lit("waiting").alias("kind"), *numbered.columns)
        seen = counts.select(F.lit("seen").alias("kind"), *[F.col(c) if c in counts.columns else F.lit(None).cast(numbered.schema[c].dataType).alias(c) for c in numbered.columns])
        self.store.save(alone.unionByName(seen).withColumn("closed_before", F.lit(until)), self.tdef())

    def pairs(self, ends: DataFrame, clean: DataFrame, survey_tie_breaker: str | None = None) -> DataFrame:
        """As ``dashboard.fifo_pairs``, with the numbers of all time, for the conversations since the state's day.

        Conversations of earlier days that now have a survey come as well, since their stored rows are out of date.
        The state's own tie breaker counts (the argument only serves the dashboard's signature)."""
        numbered, waiting = self._numbered(ends, clean, None)
        since = self.closed_before()
        both = numbered if waiting is None else numbered.unionByName(waiting)
        paired = pair_numbered(both)
        if since is not None:
            paired = paired.where((F.col("message_date") >= F.lit(since)) | F.col("orden_enc").isNotNull())
        return paired.select(*JOIN_KEY, *[F.col(c).cast("int").alias(c) if c.startswith("orden") else F.col(c) for c in paired.columns if c not in JOIN_KEY])

    def drop(self) -> None:
        self.store.drop(self.tdef())
