"""Rollups kept up to date: stored partial states that each load is merged into.

A load is any set of new rows (usage logs, messages); rows may come in any order,
and a later load may hold earlier records. Nothing loaded before is read again but
the states of the keys that the load touches.

Claims. The state of an OT is its first record (a minimum over records, so it merges)
and its number of records. A rollup row holds a count and an exact decimal sum. A load
that changes an OT's first record takes the old one out of its month and class and puts
the new one in: differences of exact sums, so the rollup always equals the
batch result.

Conversations. The state of a distinct message is its number of copies, under a hash of
the message. A session-day's row holds counts, sums, minima and maxima; new messages add
to all of them, further copies to the sums of their marks alone.

Every row names the load that changed it last, and a load leaves rows alone that it has
changed already. Rollups are published before the states that they follow from. So a load
that broke off is repeated under its name, with the same rows and before the next one, and counts once. Loads
of one ledger run one after the other; the store refuses a table that changed meanwhile.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cxlake.functions.casts import money
from cxlake.functions.text import MessagePatterns
from cxlake.operators import claims, sessions
from cxlake.operators.messages import DEDUP_KEY, dedup_messages
from cxlake.plans.tabledef import TableDef
from cxlake.session import use_checkpoint_dir
from cxlake.sinks.tables import TableStore

LOAD = "last_load"
SUM, LOW, HIGH = "sum", "min", "max"
COMBINE: dict[str, Callable] = {SUM: F.sum, LOW: F.min, HIGH: F.max}


@dataclass(frozen=True)
class StateTable:
    """A stored table of partial states: key columns and how each other column merges."""

    name: str
    key: tuple[str, ...]
    merges: dict[str, str]
    database: str | None = None
    buckets: int | None = None

    def tdef(self) -> TableDef:
        return TableDef(
            self.name, "python", primary_key=self.key, mode="merge", python_source=self.name, database=self.database, buckets=self.buckets, fail_if_empty=False
        )

    def schema(self, delta: DataFrame) -> T.StructType:
        return T.StructType([*[delta.schema[c] for c in (*self.key, *self.merges)], T.StructField(LOAD, T.StringType())])

    def rows(self, store: TableStore) -> DataFrame | None:
        return store.spark.table(self.tdef().full_name) if store.exists(self.tdef()) else None

    def before(self, store: TableStore, delta: DataFrame) -> DataFrame:
        """Stored states of the keys that ``delta`` has."""
        store.create(self.tdef(), self.schema(delta))
        return store.spark.table(self.tdef().full_name).join(delta.select(*self.key).distinct(), list(self.key), "left_semi")

    def merge(self, store: TableStore, delta: DataFrame, load: str) -> None:
        """Merge ``delta`` (one row a key) into the stored states; rows that ``load`` has changed already stay."""
        before = self.before(store, delta)
        done = before.where(F.col(LOAD) == load).select(*self.key)
        both = before.where(F.col(LOAD) != load).drop(LOAD).unionByName(delta.select(*self.key, *self.merges).join(done, list(self.key), "left_anti"))
        merged = both.groupBy(*self.key).agg(*[COMBINE[how](c).cast(delta.schema[c].dataType.simpleString()).alias(c) for c, how in self.merges.items()])
        store.save(merged.withColumn(LOAD, F.lit(load)), self.tdef())


def _kept(df: DataFrame) -> DataFrame:
    use_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


@dataclass
class ClaimLedger:
    """Claim detail and its rollups over all loads so far."""

    store: TableStore
    name: str = "claim_ledger"
    database: str | None = None
    buckets: int | None = None
    tie_breaker: str = "_id"
    excluded_users: Sequence[str] = ()
    excluded_classes: Sequence[str] = claims.EXCLUDED_CLASSES
    states: StateTable = field(init=False)
    rollup: StateTable = field(init=False)

    def __post_init__(self) -> None:
        self.states = StateTable(f"{self.name}_ot", ("ot",), {"first": LOW, "records": SUM}, self.database, self.buckets)
        self.rollup = StateTable(f"{self.name}_rollup", ("Mes", "Clasificacion"), {"n": SUM, "total": SUM}, self.database)

    def load(self, logs: DataFrame, load: str) -> None:
        """Merge new usage logs into the states, under a name that no other load has."""
        found = claims.claim_candidates(logs, excluded_users=self.excluded_users, excluded_classes=self.excluded_classes, tie_breaker=self.tie_breaker)
        record = F.struct("event_ts", F.col(self.tie_breaker).alias("tie"), "clasificacion", "valor", "usuario")
        new = _kept(found.groupBy("ot").agg(F.min(record).alias("first"), F.count(F.lit(1)).alias("records")))
        # firsts that this load has changed already (a repeated load) make no difference: the rollup has them
        old = self.states.before(self.store, new).select("ot", F.col("first").alias("old"))
        both = new.join(old, "ot", "left").where(F.col("old").isNull() | (F.col("first") < F.col("old")))
        added = both.select("ot", F.lit(1).cast("long").alias("sign"), F.col("first.*"))
        gone = both.where("old is not null").select("ot", F.lit(-1).cast("long").alias("sign"), F.col("old.*"))
        detail = claims.to_detail(added.unionByName(gone), "sign")
        amount = money(F.col("Valor_Declarado_CLP")) * F.col("sign")
        change = detail.groupBy("Mes", "Clasificacion").agg(F.sum("sign").alias("n"), F.sum(amount.cast("decimal(38,3)")).cast("decimal(38,3)").alias("total"))
        self.rollup.merge(self.store, _kept(change), load)
        self.states.merge(self.store, new, load)

    def detail(self) -> DataFrame:
        return claims.to_detail(self.states.rows(self.store).select("ot", F.col("first.*")))

    def monthly(self) -> DataFrame:
        """Count and exact sum per month and class (those that have any record)."""
        return self.rollup.rows(self.store).where("n > 0").select("Mes", "Clasificacion", "n", "total")

    def summary(self) -> DataFrame:
        return claims.summary_of(self.monthly())

    def evolution(self) -> DataFrame:
        return claims.evolution_of(self.monthly())

    def top(self) -> DataFrame:
        return claims.top_of(self.monthly().groupBy("Clasificacion").agg(F.sum("n").alias("n"), F.sum("total").cast("decimal(38,3)").alias("total")))

    def drop(self) -> None:
        for t in (self.states, self.rollup):
            self.store.drop(t.tdef())


MESSAGE_KEY = "message_key"


def message_key() -> F.Column:
    """SHA-256 of the eight columns that make a message, NULLs told from empty texts."""
    parts = [F.coalesce(F.concat(F.octet_length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("-")) for c in DEDUP_KEY]
    return F.sha2(F.concat_ws(";", *parts), 256)


@dataclass
class SessionLedger:
    """Session-days with metrics and claim status over all loads so far."""

    store: TableStore
    name: str = "session_ledger"
    database: str | None = None
    buckets: int | None = None
    patterns: MessagePatterns = MessagePatterns()
    sent: StateTable = field(init=False)
    days: StateTable = field(init=False)

    def __post_init__(self) -> None:
        self.sent = StateTable(f"{self.name}_message", (MESSAGE_KEY,), {"copies": SUM}, self.database, self.buckets)
        self.days = StateTable(f"{self.name}_day", sessions.JOIN_KEY, dict(sessions.STATE_MERGES), self.database, self.buckets)

    def load(self, dated: DataFrame, load: str) -> None:
        """Merge new messages (with ``message_date``) into the states, under a name that no other load has."""
        marked = dedup_messages(sessions.with_join_key(dated), self.patterns, extra_keys=("_sk", "_sn"), count_col="copies")
        new = _kept(marked.withColumn(MESSAGE_KEY, message_key()))
        old = self.sent.before(self.store, new.select(MESSAGE_KEY, "copies"))
        known = old.where(F.col(LOAD) != load).select(MESSAGE_KEY, F.lit(True).alias("known"))
        first = new.join(known, MESSAGE_KEY, "left").withColumn("fresh", F.col("known").isNull().cast("long"))
        self.days.merge(self.store, _kept(sessions.session_states(first, fresh="fresh")), load)
        self.sent.merge(self.store, new.select(MESSAGE_KEY, "copies"), load)

    def session_days(self) -> DataFrame:
        return sessions.metrics_of_states(self.days.rows(self.store))

    def drop(self) -> None:
        for t in (self.sent, self.days):
            self.store.drop(t.tdef())
