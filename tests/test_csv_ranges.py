"""Byte ranges of CSV files against reading the file whole."""

import csv
import io
import random

import pytest

from ontime.config import SELECTED_FIELDS
from ontime.sources import ranges
from ontime.sources.archives import csv_bad, csv_rows, list_files
from ontime.sources.ranges import RangeStream, count_range, csv_ranges, header_of


def csv_text(seed, rows=60, end="\n"):
    rng = random.Random(seed)
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=end)
    writer.writerow(SELECTED_FIELDS)
    for k in range(rows):
        row = [f"{c}{k}" for c in SELECTED_FIELDS]
        row[rng.randrange(18)] = rng.choice(['a "quoted" word', "two\nlines", "x,y", '"', "\n\n", "é\r\n,", ""])
        writer.writerow(row)
        if rng.random() < 0.2:
            out.write(end)
    return out.getvalue()


@pytest.mark.parametrize("seed,end,last", [(1, "\n", True), (2, "\r\n", True), (3, "\n", False)])
def test_every_cut_of_a_file_gives_its_records_once(tmp_path, monkeypatch, seed, end, last):
    monkeypatch.setattr(ranges, "BLOCK", 37)
    text = csv_text(seed, 12, end)
    data = (text if last else text.rstrip(end)).encode()
    path = str(tmp_path / "f.csv")
    (tmp_path / "f.csv").write_bytes(data)
    whole = [r for r in csv.reader(io.StringIO(data.decode(), newline="")) if r]
    with open(path, "rb") as stream:
        header = header_of(stream)
    for size in [*range(1, 60), 100, 1000, len(data)]:
        quotes, found, counted = 0, [], 1
        for start in range(0, len(data), size):
            stop = min(start + size, len(data))
            stream = RangeStream(path, start, stop, quotes & 1, header if start else None)
            part = b"".join(iter(lambda: stream.read(11), b""))
            rows = [r for r in csv.reader(io.StringIO(part.decode(), newline="")) if r][1:]
            with open(path, "rb") as raw:
                q, records, stray = count_range(raw, start, stop)
            assert stray[quotes & 1] == 0
            assert len(rows) == records[quotes & 1]
            quotes, found, counted = quotes + q, found + rows, counted + len(rows)
        assert found == whole[1:]


def test_split_files_read_as_whole_files(spark, tmp_path):
    for k in range(3):
        (tmp_path / f"f{k}.csv").write_text(csv_text(k, 200), newline="")
    short = csv_text(9, 50).split("\n")
    short.insert(1, "too,few")
    (tmp_path / "bad.csv").write_text("\n".join(short), newline="")
    (tmp_path / "stray.csv").write_text(csv_text(5, 0) + "\n".join(",".join(f'5" {c}' for c in SELECTED_FIELDS) for _ in range(40)))
    (tmp_path / "empty.csv").write_text("")
    files = list_files(spark, str(tmp_path), "*.csv")
    split = csv_ranges(files, 500)
    per_file = {r.path.rsplit("/", 1)[1]: r["count"] for r in split.groupBy("path").count().collect()}
    assert per_file["f0.csv"] > 20 and per_file["stray.csv"] == 1
    whole, parts = csv_rows(files, 1 << 30), csv_rows(files, 500)
    assert parts.rdd.getNumPartitions() > 60 > whole.rdd.getNumPartitions()
    # A malformed record takes a number of its own; where it does depends on the blocks read.
    good = "path not like '%/bad.csv'"
    expected = sorted(map(tuple, whole.where(good).collect()))
    assert len(expected) == 3 * 200 + 40 and sorted(map(tuple, parts.where(good).collect())) == expected
    assert sorted(map(tuple, whole.drop("record").collect())) == sorted(map(tuple, parts.drop("record").collect()))
    bad = [(r.path.rsplit("/", 1)[1], r.reason) for r in csv_bad(files, 500).collect()]
    assert bad == [("bad.csv", "malformed record")] == [(r.path.rsplit("/", 1)[1], r.reason) for r in csv_bad(files, 1 << 30).collect()]


def test_day_files_in_month_folders(spark, tmp_path):
    """The day comes from the file's name, positions restart with each file, damaged records are counted."""
    from ontime.config import TABLE_FIELDS
    from ontime.plans.load import load
    from ontime.sinks.lake import lake_rows, write_day_files
    from ontime.sinks.replay import replay
    from ontime.sources.lake import lake_bad_records, read_lake

    from helpers import flights_df

    rows = [{"FlightDate": f"2008-10-0{d}", "FlightNum": str(n), "UniqueCarrier": 'a "b", c'} for d in (3, 4) for n in range(3)]
    files = write_day_files(lake_rows(flights_df(spark, rows)), str(tmp_path / "lake")).collect()
    assert sorted((r.path[-21:], r.rows) for r in files) == [("2008/10/2008_10_03.csv"[-21:], 3), ("2008/10/2008_10_04.csv"[-21:], 3)]
    with open(tmp_path / "lake/2008/10/2008_10_04.csv", "a") as out:
        out.write("cut,short\n")
    lake = str(tmp_path / "lake")
    assert {(r.Yeard, r.Monthd, r.Dayd, r.UniqueCarrier) for r in read_lake(spark, lake, "csv").collect()} == {
        ("2008", "10", "03", 'a "b", c'), ("2008", "10", "04", 'a "b", c')}
    table = load(spark, lake, str(tmp_path / "table"), fmt="csv", shuffle=True)
    assert table.where("Yeard = 2008 and Monthd = 10").count() == 6 and set(TABLE_FIELDS) <= set(table.columns)
    bad = lake_bad_records(spark, lake).collect()
    assert [(r.Yeard, r.Monthd, r.Dayd, r.reason) for r in bad] == [("2008", "10", "04", "malformed record")]
    sent = replay(spark, lake, ["t1", "t2"], out_path=str(tmp_path / "sent"), fmt="csv")
    assert sorted(map(tuple, sent.collect())) == [("t1", 4), ("t2", 2)]


def test_month_folders_without_days_fall_back_to_the_record(spark, tmp_path):
    from ontime.sources.lake import read_lake

    folder = tmp_path / "2008" / "1"
    folder.mkdir(parents=True)
    row = dict.fromkeys(SELECTED_FIELDS, "x") | {"Year": "2008", "Month": "1", "DayofMonth": "7"}
    (folder / "part.csv").write_text(",".join(SELECTED_FIELDS) + "\n" + ",".join(row.values()) + "\n")
    (tmp_path / "loose.csv").write_text(",".join(SELECTED_FIELDS) + "\n" + ",".join(row.values()) + "\n")
    found = read_lake(spark, str(tmp_path), "csv").select("Yeard", "Monthd", "Dayd").collect()
    assert list(map(tuple, found)) == [("2008", "01", "07")] * 2
