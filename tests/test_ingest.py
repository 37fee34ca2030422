"""The stored upsert, the streaming ingest and streamed sessions: replays, untouched files, state that is written."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from voltfleet.operators import events
from voltfleet.plans import incremental
from voltfleet.sources import fixtures as fx
from voltfleet.sources import store as st
from voltfleet.streaming import ingest, live

T0 = dt.datetime(2024, 1, 1)
COLUMNS = "vin long, t timestamp, load int, soc double"


def rows(spark, data):
    return spark.createDataFrame([(v, T0 + dt.timedelta(days=d), n, float(s)) for v, d, n, s in data], COLUMNS)


def held(store):
    return sorted((r["vin"], (r["t"] - T0).days, r["load"], r["soc"]) for r in store.read().collect())


def files(store):
    return {str(p): (p.stat().st_mtime_ns, p.stat().st_size) for p in Path(store.table).rglob("*.parquet")}


def test_merge_rewrites_only_affected_months(spark, tmp_path):
    store = st.MonthStore(spark, str(tmp_path), ("vin", "t"), "load")
    st.merge(store, 1, rows(spark, [(1, 0, 1, 10), (1, 40, 1, 20), (2, 70, 1, 30), (2, 71, 1, 31), (2, 71, 1, 31)]))
    before = files(store)
    st.merge(store, 2, rows(spark, [(1, 40, 2, 21), (3, 41, 1, 40), (1, 40, 0, 99)]))
    after = files(store)
    untouched = {p for p in before if "month=2024-02-01" not in p}
    assert untouched and all(after.get(p) == before[p] for p in untouched)
    assert {p for p in after if p not in before} and not {p for p in before if "month=2024-02-01" in p} & set(after)
    assert held(store) == [(1, 0, 1, 10.0), (1, 40, 2, 21.0), (2, 70, 1, 30.0), (2, 71, 1, 31.0), (3, 41, 1, 40.0)]


def test_merge_of_nothing_and_of_incomplete_rows(spark, tmp_path):
    store = st.MonthStore(spark, str(tmp_path), ("vin", "t"), "load")
    st.merge(store, 1, rows(spark, [(1, 0, 1, 10)]))
    st.merge(store, 2, rows(spark, []))
    st.merge(store, 3, spark.createDataFrame([(None, T0, 1, 1.0), (5, None, 1, 1.0)], COLUMNS))
    assert held(store) == [(1, 0, 1, 10.0)]


def test_merge_that_died_while_replacing_is_finished_from_what_it_staged(spark, tmp_path, monkeypatch):
    store = st.MonthStore(spark, str(tmp_path), ("vin", "t"), "load")
    st.merge(store, 1, rows(spark, [(1, 0, 1, 10), (1, 1, 1, 11)]))
    mark = st._mark

    def dies(session, path, batch):
        if "/merged/" in path:
            for p in Path(store.table).rglob("*.parquet"):  # the old files are gone, the new ones not all there
                p.unlink()
            raise RuntimeError("lost")
        mark(session, path, batch)

    monkeypatch.setattr(st, "_mark", dies)
    with pytest.raises(RuntimeError):
        st.merge(store, 2, rows(spark, [(1, 1, 2, 12)]))
    monkeypatch.setattr(st, "_mark", mark)
    st.merge(store, 2, rows(spark, [(1, 1, 2, 12)]))
    assert held(store) == [(1, 0, 1, 10.0), (1, 1, 2, 12.0)]
    st.merge(store, 2, rows(spark, [(9, 9, 9, 9)]))  # done already
    assert held(store) == [(1, 0, 1, 10.0), (1, 1, 2, 12.0)]


@pytest.mark.parametrize("dies_at", ["late", "merge", "commit"])
def test_replayed_batch_gives_no_row_twice(spark, tmp_path, monkeypatch, dies_at):
    """A batch that dies after the late rows, after the merge, or before its commit is run again by the stream's next start."""
    store = st.MonthStore(spark, f"{tmp_path}/store", ("vin", "t"), "load")
    batches = [[(1, 0, 1, 1), (1, 10, 1, 2)], [(1, 10, 2, 3), (2, 2, 1, 4), (2, 9, 1, 5), (2, 9, 1, 5)], [(3, 8, 1, 6), (3, 1, 1, 7)]]
    start = lambda: ingest.start(spark.readStream.schema(COLUMNS).parquet(f"{tmp_path}/in"), store, "3 days")
    real_merge, real_count = ingest.merge, F.count_if
    for k, batch in enumerate(batches):
        rows(spark, batch).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        if k == 1:
            def dying_merge(*args):
                if dies_at != "late":
                    real_merge(*args)
                raise RuntimeError("lost")

            if dies_at == "commit":
                monkeypatch.setattr(ingest.F, "count_if", lambda *_: 1 / 0)
            else:
                monkeypatch.setattr(ingest, "merge", dying_merge)
            with pytest.raises(Exception):  # noqa: B017
                start().awaitTermination()
            monkeypatch.setattr(ingest, "merge", real_merge)
            monkeypatch.setattr(ingest.F, "count_if", real_count)
        start().awaitTermination()
    assert held(store) == [(1, 0, 1, 1.0), (1, 10, 2, 3.0), (2, 9, 1, 5.0), (3, 8, 1, 6.0)]
    late = sorted((r["batch"], r["vin"], (r["t"] - T0).days, (r["missed"] - T0).days) for r in ingest.late_rows(store).collect())
    assert late == [(1, 2, 2, 10), (2, 3, 1, 10)]
    assert sorted((r["batch"], r["merged"], r["late"]) for r in ingest.commits(spark, store.folder).collect()) == [(0, 2, 0), (1, 3, 1), (2, 1, 1)]


def test_state_written_does_not_grow_with_what_waits(spark, tmp_path):
    """Each batch brings five rows in an hour of their own, and nothing leaves: what a batch writes stays the same."""
    schema = "vin long, t timestamp, id long, amps double, soc double"
    written = []
    for k in range(6):
        spark.createDataFrame([(1, T0 + dt.timedelta(hours=k, minutes=i), 10 * k + i, 5.0, 50.0) for i in range(5)], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        query = live.ordered_sessions(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), 300, "100 days").writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start()
        query.awaitTermination()
        done = [p for p in query.recentProgress if p["numInputRows"]]
        written.append(done[0]["stateOperators"][0]["numRowsUpdated"])
    assert len(set(written[1:])) == 1


def test_streamed_sessions_cut_at_equal_times_and_keep_a_step_of_the_gap(spark, tmp_path):
    """Steps of the gap, of a microsecond more and of nothing; rows of one session come in two batches, the later ones first."""
    schema, gap = "vin long, t timestamp, id long, amps double, soc double", 300
    step = dt.timedelta(seconds=gap)
    times = [T0, T0 + step, T0 + step, T0 + 2 * step, T0 + 3 * step + dt.timedelta(microseconds=1)]
    data = [(1, t, i, 2.0 * i, 50.0 + i) for i, t in enumerate(times)]
    for part in (data[2:], data[:2], [(None, T0 + dt.timedelta(days=400), None, None, None)]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        query = live.ordered_sessions(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), gap, "2 days").writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start()
        query.awaitTermination()
        assert not [o for p in query.recentProgress for o in p["stateOperators"] if "transformWithState" in o["operatorName"]]  # no call into Python for each vehicle
    got = sorted(tuple(r[c] for c in ("t0", "soc0", "soc1", "n")) + (round(r["ah"], 9),) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert got == [(times[0], 50.0, 51.0, 2, round(1 * gap / 3600, 9)), (times[2], 52.0, 53.0, 2, round(5 * gap / 3600, 9)), (times[4], 54.0, 54.0, 1, 0.0)]


def test_merge_splits_a_large_month_by_its_rows(spark, tmp_path):
    """A month is staged by more tasks as its rows grow, those of earlier batches included."""
    store = st.MonthStore(spark, str(tmp_path), ("vin", "t"), "load", parts=1, file_rows=100)
    days = lambda low, high, day: spark.range(low, high).select(F.col("id").alias("vin"), F.lit(T0 + dt.timedelta(days=day)).alias("t"), F.lit(1).alias("load"), F.lit(1.0).alias("soc"))
    st.merge(store, 1, days(0, 300, 0).unionByName(days(0, 50, 40)))
    st.merge(store, 2, days(200, 700, 1))
    staged = [spark.read.parquet(str(p)).count() for p in Path(f"{tmp_path}/staged/2/month=2024-01-01").glob("*.parquet")]
    assert sum(staged) == 800 and max(staged) < 400
    assert store.read().count() == 850


def test_stream_steps_compute_their_samples_once(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    samples = fx.telemetry(spark, "/root/testdata/sf0.001").select("vin", "t", "id").mapInArrow(counted, "vin long, t timestamp, id long")
    out = incremental._run(spark, samples, lambda x: live.deduplicated(x, "40 days"))
    assert out.count() == read.value > 0
