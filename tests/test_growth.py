"""What is shuffled, sorted and held per task must not grow faster than the tables."""

from __future__ import annotations

import io
import time

import pyarrow as pa

from ontime import config
from ontime.config import LAKE_PARTITIONS, SELECTED_FIELDS
from ontime.operators import dealing
from ontime.plans.ingest import ingest
from ontime.plans.pipeline import by_period
from ontime.plans.resume import _spread
from ontime.sinks.lake import _pack_lines, write_lake, write_lines
from ontime.sinks.replay import lake_with_positions
from ontime.sources import archives
from ontime.sources.archives import write_archives
from ontime.sources.lake import read_lake
from ontime.sources.testdata import flights

SF = "/root/testdata/sf0.001"


def _record(day: int, number: int) -> tuple[str, ...]:
    values = dict.fromkeys(SELECTED_FIELDS, "") | {"Year": "2008", "Month": "1", "DayofMonth": str(day), "FlightNum": str(number)}
    return tuple(values[c] for c in SELECTED_FIELDS)


def _records(spark, days: int, each: int = 3):
    rows = [_record(d, i) for i in range(each) for d in range(1, days + 1)]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in SELECTED_FIELDS)).coalesce(1)


def test_replay_keeps_rows_in_place(spark, tmp_path):
    write_lake(_records(spark, 4), str(tmp_path / "lake"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as a lake over the threshold
    try:
        plan = lake_with_positions(spark, str(tmp_path / "lake"))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_partitions_beyond_the_open_writers(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(config, "open_writers", lambda spark: 2)
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    write_lake(_records(spark, 9, 5), str(tmp_path / "lake"), shuffle=False)
    assert spark.conf.get(key) == before
    days = read_lake(spark, str(tmp_path / "lake")).groupBy(*LAKE_PARTITIONS).count().collect()
    assert sorted((int(r["Dayd"]), r["count"]) for r in days) == [(d, 5) for d in range(1, 10)]
    assert all(len(list(p.glob("*.parquet"))) == 1 for p in (tmp_path / "lake").glob("Yeard=*/Monthd=*/Dayd=*"))


def test_ingest_without_broadcast_threshold(spark, tmp_path):
    write_archives(_records(spark, 3), str(tmp_path / "RAW")).count()
    out = ingest(spark, str(tmp_path / "RAW"), *(str(tmp_path / x) for x in ("lake", "quarantine", "stage")))
    assert [tuple(r) for r in out.manifest.select("read", "written", "status").collect()] == [(9, 9, "OK")]


def test_archives_get_a_task_each(spark):
    files = spark.createDataFrame([(f"/{i}.zip",) for i in range(5)], "path string").coalesce(1)
    spread = _spread(files)
    assert spread.rdd.getNumPartitions() == 5
    assert sorted(r["path"] for r in spread.collect()) == [f"/{i}.zip" for i in range(5)]


def test_lines_travel_packed(spark, tmp_path):
    paths = [f"{tmp_path}/{k % 3}.csv" for k in range(3000)]
    lines = [f"line {k}, ä" for k in range(3000)]
    batch = pa.RecordBatch.from_pydict({"path": paths, "line": lines})
    packed = pa.Table.from_batches(list(_pack_lines([batch, batch.slice(0, 0)])))
    assert packed.num_rows < 10 and sum(packed.column("rows").to_pylist()) == 3000
    written = write_lines(spark.createDataFrame(list(zip(paths, lines)), "path string, line string"), "head").collect()
    assert sorted((r["path"], r["rows"]) for r in written) == [(f"{tmp_path}/{k}.csv", 1000) for k in range(3)]
    for k in range(3):
        head, *rest = (tmp_path / f"{k}.csv").read_text().splitlines()
        assert head == "head" and sorted(rest) == sorted(lines[k::3])


def test_few_blocks_are_read_ahead(monkeypatch):
    monkeypatch.setattr(archives, "CSV_BLOCK_BYTES", 1 << 16)
    monkeypatch.setattr(archives, "AHEAD_WAIT_S", 20)
    line = ",".join(["7"] * len(SELECTED_FIELDS)) + "\n"
    n = 64 * (1 << 16) // len(line)
    data = io.BytesIO((",".join(SELECTED_FIELDS) + "\n" + line * n).encode())
    records = archives._member_records("a", None, data)
    first = next(records)
    time.sleep(0.5)
    assert data.tell() <= 6 * (1 << 16)
    rest = list(records)
    assert first.num_rows + sum(b.num_rows for b in rest[:-1]) == n
    assert rest[-1].column("record").to_pylist() == [n] and rest[-1].column("reason").to_pylist() == [None]


def test_blocks_without_a_record_do_not_slow_the_rest(monkeypatch):
    monkeypatch.setattr(archives, "CSV_BLOCK_BYTES", 1 << 16)
    line = ",".join(["7"] * len(SELECTED_FIELDS)) + "\n"
    n = 40 * (1 << 16) // len(line)
    data = (",".join(SELECTED_FIELDS) + "\n" + line * 10 + "a,b\n" * (10 << 14) + line * n).encode()
    began = time.time()
    *out, member = archives._member_records("a", None, io.BytesIO(data))
    assert sum(b.num_rows for b in out if b.column("kind")[0].as_py() == "row") == n + 10
    assert member.column("record").to_pylist() == [n + 10 + (10 << 14)]
    assert time.time() - began < 8  # forty blocks would wait ten seconds


def test_months_are_brought_together_before_mapping(spark):
    table = flights(spark, SF, by_month=True)
    plan = table._jdf.queryExecution().optimizedPlan().toString()
    assert "FlightDate" in plan and "FlightDate" not in plan[plan.index("RebalancePartitions"):]
    assert table.exceptAll(flights(spark, SF)).count() == 0 and table.count() == flights(spark, SF).count()


def test_periods_travel_packed(spark, monkeypatch):
    monkeypatch.setattr(dealing, "PIECE_BYTES", 4000)
    raw = _records(spark, 28, 40).union(spark.createDataFrame([(None,) * len(SELECTED_FIELDS)], _records(spark, 1).schema))
    dealt = by_period(spark, raw)
    assert sorted(dealt.collect(), key=str) == sorted(raw.collect(), key=str) and dealt.schema == raw.schema
    plan = dealt._jdf.queryExecution().optimizedPlan().toString()
    packed = plan[plan.index("Repartition"):].splitlines()[1]
    assert "MapInArrow" in packed and "[part#" in packed and " piece#" in packed
    days = [[int(r["DayofMonth"] or 0) for r in part] for part in dealt.rdd.glom().collect()]
    held = [(min(p), max(p)) for p in days if p]
    assert len(held) > 4 and all(a[1] <= b[0] for a, b in zip(held, held[1:]))
    # a day with many rows spans several partitions, and no rows are no error
    sizes = [len(p) for p in by_period(spark, _records(spark, 1, 800)).rdd.glom().collect()]
    assert sum(sizes) == 800 and max(sizes) < 400
    assert by_period(spark, raw.where("false")).count() == 0


def test_lines_of_archives_are_those_of_pandas():
    plain = pa.RecordBatch.from_pydict({"a": ["1", "", None, "ä\x01"], "b": ["x y", None, "", "\x02"], "c": ["", "", "", "z"]})
    for text in (None, 'a "b"', "a,b", "a\nb", "a\rb"):
        rows = pa.RecordBatch.from_pydict({c: [*plain.column(c).to_pylist(), text] for c in "abc"}) if text else plain
        assert archives._csv_lines(rows) == rows.to_pandas().to_csv(index=False, header=False, lineterminator="\n").encode()
    assert archives._csv_lines(plain.select(["a"])) == b'1\n""\n""\n\xc3\xa4\x01\n'


def test_nations_are_looked_up_last(spark):
    plan = flights(spark, SF, by_month=True)._jdf.queryExecution().optimizedPlan().toString()
    moved = plan[plan.index("RebalancePartitions"):].splitlines()[1]
    assert "s_nationkey" in moved and "c_nationkey" in moved
    assert not any(c in moved for c in ("Origin", "Dest", "n_name", "l_shipdate", "l_orderkey"))


def test_shuffle_files_go_with_the_write(spark, tmp_path):
    def files() -> set[str]:
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {name for i in range(found.size()) if (name := found.apply(i).getName()).startswith("shuffle_")}

    before = files()
    write_lake(_records(spark, 4).repartition(3, "DayofMonth"), str(tmp_path / "lake"))
    until = time.time() + 10
    while files() - before and time.time() < until:
        time.sleep(0.2)
    assert not files() - before
    assert read_lake(spark, str(tmp_path / "lake")).count() == 12
