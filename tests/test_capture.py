"""From landed payloads to the day store, batch and streaming."""

from __future__ import annotations

import datetime as dt
import json
import os

import pytest
from fixtures import TEN, at, raw, snap
from pyspark.sql import functions as F

from fleetstate import schema
from fleetstate.functions.numeric import to_whole
from fleetstate.operators.dedupe import keep_last, merge_captures
from fleetstate.plans import audit
from fleetstate.session import path_exists
from fleetstate.sources import daystore, payloads
from fleetstate.sources.snapshots import read_snapshots
from fleetstate.streaming.captures import land_captures

GOOD = {
    "rides": [
        {"id": 1, "name": "Top", "is_open": True, "wait_time": 35, "last_updated": "2024-01-03T10:00:00Z"},
        {"id": 2, "name": "No status", "wait_time": None},
    ],
    "lands": [
        {"name": "Land A", "rides": [{"id": 3, "name": "Nested", "is_open": False, "wait_time": "n/a"}]},
        {"rides": [{"id": 4, "name": "No land", "is_open": None, "wait_time": 2.5}]},
        {"name": "Empty", "rides": []},
        {"name": "Missing"},
    ],
}


def landed(spark, *texts, when=TEN):
    rows = [(when, i, f"Park {i}", text) for i, text in enumerate(texts)]
    return spark.createDataFrame(rows, schema.LANDED)


def captures(spark, rows):
    rows = [(*r[:7], None if r[7] is None else float(r[7]), *r[8:]) for r in rows]
    return spark.createDataFrame(rows, schema.CAPTURE)


def test_flatten(spark):
    rows = payloads.flatten_rides(landed(spark, json.dumps(GOOD))).orderBy("payload_pos").collect()
    assert [(r.ride_id, r.land_name, r.is_open, r.wait_time_minutes) for r in rows] == [
        (1, "Uncategorized", True, 35.0),
        (2, "Uncategorized", False, None),
        (3, "Land A", False, None),
        (4, "Uncategorized", False, 2.5),
    ]
    assert rows[0].source_last_updated == "2024-01-03T10:00:00Z"
    assert {(r.captured_at, r.park_name, r.data_source) for r in rows} == {(TEN, "Park 0", "queue-times-api")}


def test_bad_payloads_cost_only_themselves(spark):
    answers = landed(spark, "{not json", json.dumps(GOOD), "{}", json.dumps({"rides": [], "lands": []}), None)
    assert payloads.flatten_rides(answers).select("park_name").distinct().collect()[0].park_name == "Park 1"
    assert sorted(r.park_name for r in payloads.bad_payloads(answers).collect()) == ["Park 0", "Park 4"]
    timeless = answers.withColumn("captured_at", F.lit(None).cast("timestamp_ntz"))
    assert payloads.flatten_rides(timeless).isEmpty() and payloads.bad_payloads(timeless).count() == 5


def test_capture_times_are_kept_to_the_second(spark):
    answer = landed(spark, json.dumps(GOOD), when=TEN.replace(microsecond=999_999))
    assert {r.captured_at for r in payloads.flatten_rides(answer).collect()} == {TEN}


def test_capture_summary(spark):
    summary = audit.capture_summary(payloads.flatten_rides(landed(spark, json.dumps(GOOD), json.dumps(GOOD))))
    assert sorted(tuple(r) for r in summary.collect()) == [(TEN, "Park 0", 4, 1), (TEN, "Park 1", 4, 1)]


def catalogue(spark, *groups):
    return spark.createDataFrame([(i, json.dumps(g)) for i, g in enumerate(groups)], "seq int, payload string")


def test_resolve_parks_trims_and_takes_the_last_of_a_name(spark):
    parks = catalogue(
        spark,
        [{"parks": [{"id": 1, "name": " A \t"}, {"id": 9, "name": "Other"}]}, {"name": "no parks here"}],
        [{"parks": [{"id": 2, "name": "A"}, {"id": 3, "name": " B"}]}],
    )
    assert {tuple(r) for r in payloads.resolve_parks(parks, ["A", "B", "C"]).collect()} == {("A", 2), ("B", 3)}
    assert [r.park_name for r in payloads.unresolved_parks(parks, ["A", "B", "C"]).collect()] == ["C"]
    assert list(payloads.require_parks(parks, ["B", "C", "A"]).items()) == [("B", 3), ("A", 2)]
    with pytest.raises(RuntimeError):
        payloads.require_parks(parks)


def test_keep_last_treats_missing_keys_as_equal(spark):
    df = spark.createDataFrame([(None, 1, "a"), (None, 2, "b"), (7, 1, "c"), (7, None, "d")], "k int, o int, v string")
    assert sorted(r.v for r in keep_last(df, ["k"], ["o"]).collect()) == ["b", "c"]


def test_merge_twice_is_merge_once(spark):
    stored = captures(spark, [snap(TEN, True, 1, 5), snap(TEN, True, 2, 5)])
    incoming = captures(spark, [snap(TEN, False, 1, 9), snap(TEN, True, 3, 5)])
    once = merge_captures(stored, incoming)
    twice = merge_captures(once, incoming)
    assert {(r.ride_id, r.is_open, r.wait_time_minutes) for r in once.collect()} == {
        (1, False, 9.0),
        (2, True, 5.0),
        (3, True, 5.0),
    }
    assert once.exceptAll(twice).isEmpty() and twice.exceptAll(once).isEmpty()


def stored(spark, path):
    rows = read_snapshots(spark, str(path)).orderBy("captured_at", "ride_id").collect()
    return [(r.captured_at, r.ride_id, r.is_open, r.wait_time_minutes) for r in rows]


def versions(path):
    return sorted(p.name for p in path.glob("version=*"))


def test_day_store(spark, tmp_path):
    path, folder = str(tmp_path / "raw"), tmp_path / "raw"
    next_day = TEN + dt.timedelta(days=1)
    assert daystore.merge_days(captures(spark, [snap(TEN, True, 1, 5), snap(next_day, True, 1, 6)]), path) == 2
    assert versions(folder) == ["version=0000000001-add"]
    again = [snap(next_day, False, 1, 7), snap(next_day, True, 2, None)]
    everything = [(TEN, 1, True, 5), (next_day, 1, False, 7), (next_day, 2, True, None)]
    for _ in range(2):
        daystore.merge_days(captures(spark, again), path)
        assert stored(spark, path) == everything
    # Only what was captured was written, and nothing is left aside.
    assert [p.name for p in folder.glob("version=0000000003-add/captured_date=*")] == ["captured_date=2024-01-04"]
    assert not (folder / "_staged").exists()
    # One day lay in several versions. A reader who began before finds its files, and they go with the next compaction.
    reader = read_snapshots(spark, path)
    assert daystore.compact(spark, path) == 1 and stored(spark, path) == everything
    assert versions(folder)[-1] == "version=0000000004-days" and reader.count() == 3
    assert daystore.compact(spark, path) == 0 and stored(spark, path) == everything
    left = sorted(p.relative_to(folder).as_posix() for p in folder.glob("version=*/captured_date=*"))
    assert left == ["version=0000000001-add/captured_date=2024-01-03", "version=0000000004-days/captured_date=2024-01-04"]
    daystore.merge_days(captures(spark, [snap(next_day, True, 1, 9)]), path)
    assert stored(spark, path) == [(TEN, 1, True, 5), (next_day, 1, True, 9), (next_day, 2, True, None)]


def size(folder):
    return sum(p.stat().st_size for p in folder.rglob("*.parquet"))


def test_a_capture_writes_no_more_on_a_big_day(spark, tmp_path):
    path, folder = str(tmp_path / "raw"), tmp_path / "raw"
    daystore.merge_days(captures(spark, [snap(TEN, True, 10_000, 1)]), path)
    small = size(folder)
    day = spark.range(50_000).select(*[F.lit(v).alias(f.name) for v, f in zip(snap(TEN, True, 1, 5.0), schema.CAPTURE)], "id")
    day = day.withColumn("ride_id", F.col("id").cast("int")).drop("id")
    daystore.merge_days(day.select([F.col(f.name).cast(f.dataType) for f in schema.CAPTURE]), path)
    before = size(folder)
    daystore.merge_days(captures(spark, [snap(TEN, True, 10_000, 2)]), path)
    assert before > 20 * small and size(folder) - before < 2 * small
    assert read_snapshots(spark, path).count() == 50_000


def test_days_of_before_there_were_versions(spark, tmp_path):
    path = str(tmp_path / "raw")
    old = captures(spark, [snap(TEN, True, 1, 5), snap(TEN, True, 2, 5)]).withColumn("captured_date", F.to_date("captured_at"))
    old.write.partitionBy("captured_date").parquet(path)
    assert [r[1] for r in stored(spark, path)] == [1, 2]
    daystore.merge_days(captures(spark, [snap(TEN, False, 1, 9)]), path)
    assert stored(spark, path) == [(TEN, 1, False, 9), (TEN, 2, True, 5)]
    for _ in range(2):
        daystore.compact(spark, path)
        assert stored(spark, path) == [(TEN, 1, False, 9), (TEN, 2, True, 5)]
    assert not list((tmp_path / "raw").glob("captured_date=*"))


def test_nothing_captured_writes_nothing(spark, tmp_path):
    path = str(tmp_path / "raw")
    assert daystore.merge_days(captures(spark, []), path) == 0
    assert not path_exists(spark, path)
    assert read_snapshots(spark, path).collect() == []


@pytest.mark.parametrize("next_capture", [[snap(TEN, False, 1, 9)], [snap(TEN, True, 3, 1)], []])
@pytest.mark.parametrize("write", [daystore.merge_days, daystore.write_days, lambda df, path: daystore.compact(df.sparkSession, path)])
def test_a_write_that_dies_leaves_the_store(spark, tmp_path, monkeypatch, next_capture, write):
    path = str(tmp_path / "raw")
    for ride in (1, 2):
        daystore.merge_days(captures(spark, [snap(TEN, True, ride, 5)]), path)
    before = stored(spark, path)

    def dies(spark, staged, version):
        raise RuntimeError("lost driver")

    with monkeypatch.context() as patch:
        patch.setattr(daystore, "_move_in", dies)
        with pytest.raises(RuntimeError, match="lost driver"):
            write(captures(spark, [snap(TEN, False, 1, 9)]), path)
    # All was written aside, nothing moved in: a reader sees the old store, and the next write starts anew.
    assert (tmp_path / "raw" / "_staged").exists() and stored(spark, path) == before
    daystore.merge_days(captures(spark, next_capture), path)
    assert not (tmp_path / "raw" / "_staged").exists()
    assert stored(spark, path) == sorted({r[1]: r for r in [*before, *((r[0], r[4], r[6], r[7]) for r in next_capture)]}.values())


def test_write_days_clears_the_store(spark, tmp_path):
    path = str(tmp_path / "seed")
    daystore.write_days(captures(spark, [snap(TEN, True, 1, 5)]), path)
    daystore.write_days(captures(spark, [snap(at("2024-01-05 10:00"), True, 1, 5)]), path)
    assert [r[0] for r in stored(spark, path)] == [at("2024-01-05 10:00")]


def land(folder, name, when, payload):
    folder.mkdir(parents=True, exist_ok=True)
    record = {"captured_at": when.isoformat(), "park_id": 6, "park_name": "Park A", "payload": json.dumps(payload)}
    (folder / f"{name}.json").write_text(json.dumps(record) + "\n")


def test_stream_replays_and_late_captures(spark, tmp_path):
    landing, store, checkpoint = tmp_path / "landing", str(tmp_path / "raw"), str(tmp_path / "checkpoint")

    def run(checkpoint=checkpoint, **options):
        land_captures(spark, str(landing), store, checkpoint, **options).awaitTermination()
        return stored(spark, store)

    def one_ride(is_open, wait):
        return {"rides": [{"id": 1, "name": "R", "is_open": is_open, "wait_time": wait}]}

    land(landing, "a", TEN, one_ride(True, 10))
    assert run() == [(TEN, 1, True, 10)]
    assert run() == [(TEN, 1, True, 10)]

    late = TEN - dt.timedelta(days=2)
    land(landing, "b", TEN + dt.timedelta(minutes=15), one_ride(False, 0))
    land(landing, "c", late, one_ride(True, 20))
    everything = [(late, 1, True, 20), (TEN, 1, True, 10), (TEN + dt.timedelta(minutes=15), 1, False, 0)]
    assert run() == everything
    # A stream that has lost its checkpoint lands everything again, to the same end.
    assert run(str(tmp_path / "other"), files_per_batch=1) == everything


def test_ride_listed_twice_keeps_its_last_place(spark, tmp_path):
    payload = {"rides": [{"id": 1, "is_open": True}], "lands": [{"name": "L", "rides": [{"id": 1, "is_open": False}]}]}
    rides = payloads.flatten_rides(landed(spark, json.dumps(payload)))
    daystore.merge_days(rides, str(tmp_path / "raw"), order=("payload_pos",))
    (row,) = read_snapshots(spark, str(tmp_path / "raw")).collect()
    assert (row.land_name, row.is_open) == ("L", False)


def test_reads_zoned_and_nanosecond_captures(spark, tmp_path):
    """Files as pandas writes them: nanoseconds, zoned or not, fractional waits."""
    import pandas as pd
    import pyarrow as pa
    import pyarrow.parquet as pq

    frame = pd.DataFrame(
        {
            "captured_at": pd.to_datetime(["2024-01-03T10:00:00", "2024-01-03T10:15:00"]).astype("datetime64[ns]"),
            "park_id": [6, 6],
            "park_name": ["A", "A"],
            "land_name": ["L", "L"],
            "ride_id": [1, 1],
            "ride_name": ["R", "R"],
            "is_open": [True, False],
            "wait_time_minutes": [2.5, None],
            "source_last_updated": ["x", None],
            "data_source": ["synthetic", "synthetic"],
        }
    )
    zoned = frame.assign(captured_at=frame["captured_at"].dt.tz_localize("UTC"))
    micros = pa.Table.from_pandas(zoned, preserve_index=False)
    micros = micros.set_column(0, "captured_at", micros["captured_at"].cast(pa.timestamp("us", "UTC")))
    for name, table in {
        "nanos": pa.Table.from_pandas(frame, preserve_index=False),
        "zoned_nanos": pa.Table.from_pandas(zoned, preserve_index=False),
        "zoned_micros": micros,
    }.items():
        (tmp_path / name).mkdir()
        pq.write_table(table, tmp_path / name / "snapshots_2024-01-03.parquet", version="2.6")
        got = read_snapshots(spark, f"{tmp_path}/{name}/snapshots_*.parquet").orderBy("captured_at").collect()
        assert [r.captured_at for r in got] == [TEN, TEN + dt.timedelta(minutes=15)]
        assert [r.wait_time_minutes for r in got] == [2, None]


def test_day_files_may_differ_in_type(spark, tmp_path):
    """Waits are integers on a day that has them all, and floats on a day that misses one."""
    whole = raw(spark, [snap(TEN, True, 1, 5)]).withColumn("wait_time_minutes", F.col("wait_time_minutes").cast("long"))
    gaps = captures(spark, [snap(TEN + dt.timedelta(days=i), True, 1, 2.5) for i in (1, 2)])
    paths = []
    for i, df in enumerate([whole, gaps.limit(1), gaps.filter("captured_at > '2024-01-05'")]):
        df.coalesce(1).write.parquet(str(tmp_path / f"w{i}"))
        (file,) = (tmp_path / f"w{i}").glob("*.parquet")
        paths.append(tmp_path / "raw" / f"snapshots_2024-01-0{3 + i}.parquet")
        paths[0].parent.mkdir(exist_ok=True)
        paths[-1].write_bytes(file.read_bytes())
    folder = str(tmp_path / "raw")
    for path in (folder, folder + "/snap*.parquet"):
        assert [r[3] for r in stored(spark, path)] == [5, 2, 2]


def test_merge_reads_its_input_once(spark, tmp_path):
    reads = spark.sparkContext.accumulator(0)

    def seen(wait):
        reads.add(1)
        return wait

    waits = F.udf(seen, "double")
    incoming = captures(spark, [snap(TEN + i * dt.timedelta(days=i), True, i, i) for i in range(5)])
    daystore.merge_days(incoming.withColumn("wait_time_minutes", waits("wait_time_minutes")), str(tmp_path / "raw"))
    assert reads.value == 5


def test_rows_without_a_time_are_merged_too(spark, tmp_path):
    path = str(tmp_path / "raw")
    for ride in (1, 2, 1):
        daystore.merge_days(captures(spark, [snap(None, True, ride, ride)]), path)
    assert sorted((r.captured_at, r.ride_id) for r in read_snapshots(spark, path).collect()) == [(None, 1), (None, 2)]


def test_both_layouts_of_a_folder_are_read(spark, tmp_path):
    path = str(tmp_path / "raw")
    daystore.write_days(captures(spark, [snap(TEN, True, 1, 5)]), path)
    raw(spark, [snap(TEN, True, 2, 5)]).toPandas().to_parquet(path + "/snapshots_2024-01-03.parquet")
    assert [r[1] for r in stored(spark, path)] == [1, 2]
    assert [r[1] for r in stored(spark, path + "/snapshots_2024-01-0[1-3].parquet")] == [2]
    assert stored(spark, path + "/snapshots_2025-?.parquet") == []


def test_odd_waits_and_ids_cost_only_themselves(spark):
    waits = ["35", " 7.5 ", "NaN", "Infinity", "35d", "1e999", "n/a", None]
    rides = [{"id": str(i), "name": "r", "wait_time": w} for i, w in enumerate(waits)]
    rides += [{"id": "x1", "name": "r"}, {"id": 99, "name": "r"}, {"name": "none"}]
    answers = landed(spark, json.dumps({"rides": rides}))
    found = {r.ride_id: r.wait_time_minutes for r in payloads.flatten_rides(answers).collect()}
    assert found == {0: 35.0, 1: 7.5, **{i: None for i in range(2, 8)}, 99: None, None: None}
    assert [r.ride_id for r in payloads.bad_rides(answers).collect()] == ["x1"]
    assert payloads.bad_payloads(answers).collect() == []
    stored_waits = spark.createDataFrame([(w,) for w in (float("nan"), float("inf"), 2.5, None)], "w double")
    assert [r[0] for r in stored_waits.select(to_whole(F.col("w"))).collect()] == [None, None, 2, None]


def test_last_answer_to_arrive_wins(spark, tmp_path):
    """Two answers of one batch, of the same time, with the same ride in the same place."""
    folder = tmp_path / "landing"
    for order in (("a", "b"), ("b", "a")):
        target = tmp_path / "".join(order)
        for i, name in enumerate(order):
            ride = {"id": 1, "name": name, "is_open": True, "wait_time": i}
            land(folder / target.name, name, TEN, {"rides": [ride]})
            os.utime(folder / target.name / f"{name}.json", (1_700_000_000 + i,) * 2)
        land_captures(spark, str(folder / target.name), str(target), str(tmp_path / ("check" + target.name))).awaitTermination()
        (row,) = read_snapshots(spark, str(target)).collect()
        assert (row.ride_name, row.wait_time_minutes) == (order[1], 1)


def test_stream_keeps_to_the_parks_and_reports_what_it_cannot_use(spark, tmp_path):
    folder = tmp_path / "landing"
    rides = [{"id": 1, "name": "r", "is_open": True}, {"id": "x", "name": "bad"}]
    land(folder, "good", TEN, {"rides": rides})
    foreign = {"captured_at": TEN.isoformat(), "park_id": 7, "park_name": "Park B", "payload": json.dumps({"rides": rides})}
    (folder / "foreign.json").write_text(json.dumps(foreign) + "\n")
    broken = {"captured_at": TEN.isoformat(), "park_id": 6, "park_name": "Park A", "payload": "{broken"}
    (folder / "broken.json").write_text(json.dumps(broken) + "\n")
    rejects = str(tmp_path / "rejects")
    for _ in range(2):
        land_captures(spark, str(folder), str(tmp_path / "raw"), str(tmp_path / "check"), parks=[6], rejects=rejects).awaitTermination()
    rows = read_snapshots(spark, str(tmp_path / "raw")).collect()
    assert [(r.park_id, r.ride_id) for r in rows] == [(6, 1)]
    assert [r.payload for r in spark.read.json(rejects + "/answers").collect()] == ["{broken"]
    assert [r.ride_id for r in spark.read.json(rejects + "/rides").collect()] == ["x"]
    (batch,) = spark.read.json(rejects + "/batches").collect()
    assert (batch.answers, batch.unusable, batch.captures) == (2, 1, 1)


def test_what_cannot_be_used_is_said(spark, tmp_path, caplog):
    parks = catalogue(spark, [{"parks": [{"id": 1, "name": "A"}]}])
    payloads.require_parks(parks, ["A", "Nowhere"])
    assert "'Nowhere' is not in the catalogue" in caplog.text
    folder = tmp_path / "landing"
    folder.mkdir()
    (folder / "broken.json").write_text(json.dumps({"captured_at": TEN.isoformat(), "park_id": 6, "park_name": "A", "payload": "{"}) + "\n")
    land_captures(spark, str(folder), str(tmp_path / "raw"), str(tmp_path / "check")).awaitTermination()
    assert "no usable row" in caplog.text and not (tmp_path / "raw").exists()


def test_landed_stream_on_a_cluster_uses_the_shared_folder_that_is_set(spark, tmp_path, monkeypatch):
    from fleetstate import session
    from workload.registry import REGISTRY

    rows = [(i, TEN + dt.timedelta(minutes=20 * i), i % 3, "click", float(i)) for i in range(12)]
    events = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double")
    events.write.parquet(str(tmp_path / "events.parquet"))
    base = session.shared_base
    monkeypatch.setattr(session, "shared_base", lambda master, *rest: base("spark://host:7077", *rest))
    found = REGISTRY["landed_stream"](spark, str(tmp_path)).collect()
    hours = {(r[1].replace(minute=0), r[2]) for r in rows}
    assert len(found) == len(hours) and {(r.captured_at, r.ride_id) for r in found} == hours
