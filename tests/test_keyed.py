"""Timelines from keyed states: late and repeated documents, restarts, work of a batch, compaction."""

import os
import random

import pytest

from tempolith.operators.timeline import resolve
from tempolith.streaming import keyed, timelines


def links(rng, patients, n):
    kind = ("BEGINS-ON", "ENDS-ON", "contains-1", "Begins-On", None)
    return [(rng.choice(patients), rng.choice(["d1", "d2", "d3", None]), rng.randint(0, 9), rng.choice(["Taxol", "taxol", "aspirin"]), rng.choice(kind), f"2024-01-0{rng.randint(1, 4)}") for _ in range(n)]


def feed(spark, batches, folder):
    """A file for each batch, read one by one in the order of their times."""
    os.makedirs(folder)
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, timelines.LINKS).coalesce(1).write.json(f"{folder}.tmp{i}", ignoreNullFields=False)
        part = next(f for f in os.listdir(f"{folder}.tmp{i}") if f.startswith("part-"))
        os.rename(f"{folder}.tmp{i}/{part}", f"{folder}/{i:04d}.json")
        os.utime(f"{folder}/{i:04d}.json", (1_700_000_000 + i, 1_700_000_000 + i))
    return lambda: spark.readStream.schema(timelines.LINKS).option("maxFilesPerTrigger", 1).json(folder)


def table(df):
    return {tuple(r) for r in df.collect()}


def test_any_order_and_repeats_give_the_batch_result(spark, tmp_path):
    rng = random.Random(1)
    batches = [links(rng, ["p1", "p2", "p3", None], 12) for _ in range(4)]
    batches[3] += batches[0]  # documents that come again
    stream = feed(spark, batches, str(tmp_path / "in"))
    store, state = str(tmp_path / "store"), str(tmp_path / "state")
    timelines.start(stream(), store, state, keep_timelines=True).awaitTermination()
    every = spark.createDataFrame([r for b in batches for r in b], timelines.LINKS)
    want = table(resolve(every.where("patient_id is not null")))
    assert {r for r in table(timelines.current(spark, store)) if r[0] is not None} == want
    # the last batch was written, but not marked as done
    last = max(int(x) for x in os.listdir(f"{state}/commits") if x.isdigit())
    os.remove(f"{state}/commits/{last}")
    os.remove(f"{state}/commits/.{last}.crc")
    timelines.start(stream(), store, state, keep_timelines=True).awaitTermination()
    assert {r for r in table(timelines.current(spark, store)) if r[0] is not None} == want
    # readers start from the compaction, later batches count on top of it
    upto = timelines.compact(spark, store)
    assert upto == last and {r for r in table(timelines.current(spark, store)) if r[0] is not None} == want
    more = spark.createDataFrame([("p1", "d0", 0, "new", "BEGINS-ON", "2025")], timelines.LINKS)
    timelines.add(more, store, upto + 1)
    timelines.refresh(more, store, upto + 1)
    assert ("p1", "new", "BEGINS-ON", "2025") in table(timelines.current(spark, store))


@pytest.mark.parametrize("n", [3, 6])
def test_work_of_a_batch_follows_its_own_patients(spark, tmp_path, monkeypatch, n):
    """Rows that a batch resolves are the links of its own patients, however many batches came before."""
    rng = random.Random(n)
    batches = [links(rng, [f"p{i}"], 30) for i in range(n)]
    seen = []

    def counted(rows):
        seen.append(rows.count())
        return resolve(rows)

    monkeypatch.setattr(keyed, "resolve", counted)
    store = str(tmp_path / "store")
    timelines.start(feed(spark, batches, str(tmp_path / "in"))(), store, str(tmp_path / "state"), keep_timelines=True).awaitTermination()
    own = [len({tuple(str(x).lower() for x in r[3:]) for r in b}) for b in batches]
    assert seen == own
    assert table(timelines.current(spark, store)) == table(resolve(spark.createDataFrame([r for b in batches for r in b], timelines.LINKS)))


def test_states_need_no_python(spark, tmp_path):
    """Patients cost no call each: the states are an aggregate of Spark's own; new links go to the store once."""
    first = [(f"p{i}", "d2", 1, "Taxol", "CONTAINS-1", "2024") for i in range(300)]
    later = [(f"p{i}", "d1", 1, "taxol", "contains-1", "2024") for i in range(300)] + [("p0", "d3", 1, "new", "CONTAINS-1", "2024")]
    stream = feed(spark, [first, later], str(tmp_path / "in"))
    plan = keyed.merged(stream())._jdf.queryExecution().logical().toString()
    assert "Aggregate" in plan and "Pandas" not in plan and "Python" not in plan
    store = str(tmp_path / "store")
    timelines.start(stream(), store, str(tmp_path / "state"), keep_timelines=True).awaitTermination()
    want = {(f"p{i}", "taxol", "contains-1", "2024") for i in range(300)} | {("p0", "new", "CONTAINS-1", "2024")}
    assert table(timelines.current(spark, store)) == want
    assert table(timelines.stored(spark, store).drop("bucket")) == {(*r, 0) for r in first} | {(*later[-1], 1)}


def test_buckets_are_written_by_few_tasks(spark, tmp_path):
    rows = spark.createDataFrame([(f"p{i}", "d", 0, "med", "BEGINS-ON", "2024") for i in range(640)], timelines.LINKS).repartition(8)
    timelines.add(rows, str(tmp_path), 0)
    written = [f for _, _, names in os.walk(tmp_path / "links") for f in names if f.endswith(".parquet")]
    assert len(written) <= timelines.BUCKETS and timelines.stored(spark, str(tmp_path)).count() == 640
