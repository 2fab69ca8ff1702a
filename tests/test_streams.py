"""The queue as keyed state against the batch queue."""

import datetime as dt
import json
import random
import time

import pytest
from pyspark.sql import functions as F

from brindle.operators import state
from brindle.streaming import stateful

SCHEMA = "id string, state string, ts timestamp, data string"
FIELDS = {"k": "long", "tags": "array<string>", "title": "string"}


def rows(seed, ids=60):
    draw = random.Random(seed)
    out = []
    for i in range(ids):
        for s in draw.sample(["a", "b", "c", "z", "other"], draw.randint(1, 5)):
            data = None if draw.random() < 0.1 else json.dumps({"k": draw.randint(0, 3), "title": draw.choice(["", "x", "é\"y"]), "tags": draw.choice([[], ["p", "q"]])})
            out.append((f"id{i}", s, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=draw.randint(0, 5000)), data))
    return out


@pytest.fixture
def feed(spark, tmp_path):
    def write(part, name):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.parquet(str(tmp_path / "in" / name))

    def read():
        return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "*"))

    return write, read, str(tmp_path / "out"), str(tmp_path / "mark")


def test_late_repeated_and_reordered_rows(spark, feed):
    write, read, out, mark = feed
    everything = rows(1, 200)
    draw = random.Random(2)
    dealt = everything + draw.sample(everything, 200)  # some come twice
    draw.shuffle(dealt)
    # a later write of a state is ignored, whichever comes first
    dealt = [("id1", "a", dt.datetime(2025, 1, 1), '{"k": 9}'), *dealt, (None, "a", dt.datetime(2024, 1, 1), "{}"), ("id2", None, dt.datetime(2024, 1, 1), "{}"), ("id3", "other", dt.datetime(2024, 1, 1), "{}")]
    if not any(r[:2] == ("id1", "a") for r in everything):
        everything.append(dealt[0])
    batch = spark.createDataFrame(everything, SCHEMA)
    want = {r.id: (r.ts, r.k, r.tags, r.title) for r in state.get_many(batch, ["a", "b"], ["z"], fields=FIELDS).collect()}
    assert len(want) > 5
    half = len(dealt) // 2
    write(dealt[:half], "1")
    write(dealt[half : half + 60], "2")
    stateful.start(read(), out, mark, ["a", "b"], ["z"]).awaitTermination()
    write(dealt[half + 60 :], "3")  # after a restart
    for _ in range(2):  # the second finds nothing new
        stateful.start(read(), out, mark, ["a", "b"], ["z"]).awaitTermination()
    told = stateful.read(spark, out)
    got = {r.id: (r.ts, r.k, r.tags, r.title) for r in stateful.merged(stateful.current(told), FIELDS).collect()}
    assert got == want
    versions = told.groupBy("id").agg(F.sort_array(F.collect_list("version")).alias("v")).collect()
    assert all(r.v == list(range(1, len(r.v) + 1)) for r in versions)  # nothing is told twice
    assert any(len(r.v) > 1 for r in versions)  # and some were ready for a while


def test_rows_leave_the_window(spark, feed):
    """A timer takes an id out of the queue when its oldest row is too old, and old rows never enter."""
    write, read, out, mark = feed
    now = dt.datetime.now()
    window = 12.0
    write([("young", "a", now, "{}"), ("old", "a", now - dt.timedelta(seconds=60), "{}"), ("done", "a", now, "{}"), ("done", "z", now - dt.timedelta(days=9), None)], "1")
    query = stateful.start(read(), out, mark, ["a"], ["z"], window_days=window / 86400, every="1 second")
    try:
        seen = []
        for _ in range(80):
            time.sleep(0.5)
            try:
                told = {(r.id, r.version, r.ready) for r in stateful.read(spark, out).collect()}
            except Exception:  # noqa: BLE001 - nothing is there yet
                continue
            if not seen and told:
                seen = sorted(told)
            if ("young", 2, False) in told:
                break
        assert seen == [("young", 1, True)] and told == {("young", 1, True), ("young", 2, False)}
    finally:
        query.stop()
    assert stateful.current(stateful.read(spark, out)).count() == 0
