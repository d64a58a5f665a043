"""Outcomes of work on keys: of each key one outcome is active, a success or a failure, all others are
history. As a batch over all outcomes, or as a stream with keyed state.

The newest outcome is active, by time and then by a digest of the record, whatever the order in which
outcomes come. A record that comes again changes nothing. Batch and stream agree.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

OUTCOMES = ("success", "failure")
STATE = "at timestamp, digest string, outcome string, record string"


def digests(rows: DataFrame, key: str, at: str, outcome: str, record: str) -> DataFrame:
    """(key, at, digest, outcome, record) of what can be an outcome: key, time and outcome are known."""
    own = F.sha2(F.concat_ws("\x00", F.col(outcome), F.coalesce(F.col(record), F.lit("\x01"))), 256)
    known = F.col(key).isNotNull() & F.col(at).isNotNull() & F.col(outcome).isin(*OUTCOMES)
    return rows.filter(known).select(F.col(key).cast("string").alias("key"), F.col(at).alias("at"), own.alias("digest"), F.col(outcome).alias("outcome"), F.col(record).alias("record"))


def settled(rows: DataFrame) -> DataFrame:
    """``rows`` of :func:`digests`, each once, with ``active``. The newest one per key is found by an
    aggregate that is joined back, so that no task sorts a busy key."""
    newest = rows.groupBy("key").agg(F.max(F.struct("at", "digest")).alias("newest"))
    once = rows.groupBy("key", "at", "digest").agg(F.first("outcome").alias("outcome"), F.first("record").alias("record"))
    return once.join(newest, "key").withColumn("active", F.struct("at", "digest") == F.col("newest")).drop("newest")


class Outcomes(StatefulProcessor):
    """State of a key: the active outcome and the digests of all that came. A newer outcome makes the one
    before history; a late one is history at once."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.active = handle.getValueState("active", STATE)
        self.seen = handle.getMapState("seen", "digest string, at timestamp", "known boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        now = tuple(self.active.get()) if self.active.exists() else None
        first, out = now, []
        for batch in rows:
            for row in batch.itertuples(index=False):
                new = (row.at.to_pydatetime(), row.digest, row.outcome, None if pd.isna(row.record) else row.record)
                if self.seen.containsKey((new[1], new[0])):
                    continue
                self.seen.updateValue((new[1], new[0]), (True,))
                older, now = (new, now) if now is not None and new[:2] < now[:2] else (now, new)
                if older is not None:
                    out.append((key[0], *older, False))
        if now is not None and now != first:
            self.active.update(now)
            out.append((key[0], *now, True))
        yield pd.DataFrame(out, columns=["key", "at", "digest", "outcome", "record", "active"])

    def close(self) -> None:
        pass


def settled_stream(rows: DataFrame) -> DataFrame:
    """Of a stream of :func:`digests`: a row per outcome that becomes history, and one per key and
    micro-batch whose active outcome is another one than before."""
    schema = f"key string, {STATE}, active boolean"
    return rows.groupBy("key").transformWithStateInPandas(statefulProcessor=Outcomes(), outputStructType=schema, outputMode="update", timeMode="none")


def from_stream(written: DataFrame) -> DataFrame:
    """What :func:`settled` gives, from all rows that the stream has written: history as it is, and of
    the rows that were active once, those that nothing made history."""
    history = written.filter("not active").select("key", "at", "digest", "outcome", "record").dropDuplicates(["key", "at", "digest"])
    active = written.filter("active").join(history, ["key", "at", "digest"], "left_anti").dropDuplicates(["key", "at", "digest"])
    return history.withColumn("active", F.lit(False)).unionByName(active.select("key", "at", "digest", "outcome", "record", "active"))


def pending(work: DataFrame, id_col: str, text: str, active: DataFrame, settings: dict[str, str], defaults: dict[str, str] | None = None, retry_failures: bool = False) -> DataFrame:
    """``work`` with ``verdict``: missing_id, empty_text, done, failed or pending.

    ``active`` is :func:`settled` with the active rows' records as JSON. A document is done if its
    success was made with the same ``settings`` (model, version, ...), failed if a failure was, unless
    failures are tried again. ``defaults`` stand for settings that a record does not name.
    """
    same: Column = F.lit(True)
    for name, value in settings.items():
        held = F.coalesce(F.get_json_object("record", f"$.{name}"), F.lit((defaults or {}).get(name)))
        same = same & held.eqNullSafe(F.lit(value))
    held = active.filter("active").filter(same).select(F.col("key").alias("__key"), F.col("outcome").alias("__outcome"))
    found = work.join(held, F.col(id_col).cast("string") == F.col("__key"), "left")
    body = F.trim(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[ \t\n\r\f\x0B]+", " "))
    verdict = F.when(F.col(id_col).isNull() | (F.col(id_col).cast("string") == ""), "missing_id").when(body == "", "empty_text")
    verdict = verdict.when(F.col("__outcome") == "success", "done")
    if not retry_failures:
        verdict = verdict.when(F.col("__outcome") == "failure", "failed")
    return found.withColumn("verdict", verdict.otherwise("pending")).drop("__key", "__outcome")


def history_counts(rows: DataFrame) -> DataFrame:
    """(key, successes, failures, active): how often each key had which outcome."""
    once = settled(rows)
    count = lambda name: F.count_if(F.col("outcome") == name)
    return once.groupBy("key").agg(count("success").alias("successes"), count("failure").alias("failures"), F.max(F.when(F.col("active"), F.col("outcome"))).alias("active"))
