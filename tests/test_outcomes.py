"""Active outcomes and history: batch, stream and a fold over records."""

from __future__ import annotations

import datetime as dt
import json
import random

import pytest

from lorekiln.streaming import outcomes

SCHEMA = "id string, at timestamp, outcome string, record string"


def fold(rows):
    """key -> (active, history), in order of time; records that come again count once."""
    out = {}
    for key in {r[0] for r in rows}:
        own = sorted({(at, outcome, record) for k, at, outcome, record in rows if k == key}, key=lambda r: (r[0], digest(*r[1:])))
        out[key] = (own[-1], sorted(own[:-1], key=repr))
    return out


def digest(outcome, record):
    import hashlib

    return hashlib.sha256(f"{outcome}\x00{chr(1) if record is None else record}".encode()).hexdigest()


def drawn(n=150):
    rng = random.Random(9)
    begin = dt.datetime(2024, 1, 1)
    rows = [(f"k{rng.randint(0, 12)}", begin + dt.timedelta(minutes=rng.randint(0, 30)), rng.choice(outcomes.OUTCOMES), rng.choice([None, '{"a": 1}', "x"])) for _ in range(n)]
    return rows + rng.sample(rows, 40)


def as_fold(frame):
    out: dict = {}
    for r in frame.collect():
        active, history = out.setdefault(r.key, ([], []))
        (active if r.active else history).append((r.at, r.outcome, r.record))
    return {k: (a[0], sorted(h, key=repr)) for k, (a, h) in out.items() if len(a) == 1}


def test_batch_is_a_fold(spark):
    rows = drawn()
    bad = [(None, rows[0][1], "success", "x"), ("k1", None, "success", "x"), ("k1", rows[0][1], "maybe", "x"), ("k1", rows[0][1], None, "x")]
    frame = outcomes.digests(spark.createDataFrame(rows + bad, SCHEMA), "id", "at", "outcome", "record")
    assert as_fold(outcomes.settled(frame)) == fold(rows)
    assert outcomes.settled(frame.limit(0)).count() == 0


def test_stream_with_late_and_repeated_records_agrees_with_the_batch(spark, tmp_path):
    rows = drawn()
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        source = tmp_path / "in"
        for k in range(3):  # three runs: each goes on from the state of the one before, and times are mixed
            spark.createDataFrame(rows[k::3], SCHEMA).coalesce(1).write.mode("append").parquet(str(source))
            stream = outcomes.digests(spark.readStream.schema(SCHEMA).parquet(str(source)), "id", "at", "outcome", "record")
            write = outcomes.settled_stream(stream).writeStream.outputMode("update")

            def kept(batch, number, k=k):
                batch.write.mode("overwrite").parquet(f"{tmp_path}/out/run={k}/batch={number}")

            write.foreachBatch(kept).option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start().awaitTermination(120)
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    written = spark.read.parquet(str(tmp_path / "out"))
    assert as_fold(outcomes.from_stream(written)) == fold(rows)
    assert written.filter("not active").count() == sum(len(h) for _, h in fold(rows).values())


@pytest.mark.parametrize("retry", [False, True])
def test_resume_by_settings(spark, retry):
    at = dt.datetime(2024, 1, 1)
    record = lambda **x: json.dumps({"model": "m", "version": "2"} | x)
    done = [
        ("a", at, "success", record()), ("b", at, "failure", record()), ("c", at, "success", record(model="old")), ("d", at, "success", record(provider="other")),
        ("e", at, "success", record()), ("e", at + dt.timedelta(1), "failure", record()), ("f", at, "success", None),
    ]
    active = outcomes.settled(outcomes.digests(spark.createDataFrame(done, SCHEMA), "id", "at", "outcome", "record"))
    work = spark.createDataFrame([(k, " \n" if k == "g" else "text") for k in "abcdefgh"] + [(None, "x"), ("", "x")], "id string, text string")
    found = outcomes.pending(work, "id", "text", active, {"model": "m", "version": "2", "provider": "p"}, {"provider": "p"}, retry)
    wanted = dict.fromkeys("abcdefgh", "pending") | {"a": "done", "b": "failed", "e": "failed", "g": "empty_text", None: "missing_id", "": "missing_id"}
    if retry:
        wanted |= {"b": "pending", "e": "pending"}
    assert {r.id: r.verdict for r in found.collect()} == wanted
