"""Ingest: archives with mixed headers, bad records, missing members, repeated days."""

import csv
import io
import os
import zipfile

from pyspark.sql import functions as F

from ontime.config import SELECTED_FIELDS
from ontime.plans.ingest import ingest, lake_day_summary
from ontime.plans.load import load, profile
from ontime.sources.lake import read_lake


def record(day, carrier="AA", delay="-14.00", origin="ORD", dest="LAX", cancelled="0.00"):
    return {"Year": "2008", "Month": "3", "DayofMonth": str(day), "DayOfWeek": "2",
            "FlightDate": f"2008-03-{day:02d}", "UniqueCarrier": carrier, "FlightNum": "17",
            "Origin": origin, "Dest": dest, "CRSDepTime": "0900", "DepTime": "905",
            "DepDelay": "5.00", "DepDelayMinutes": "5.00", "CRSArrTime": "1100",
            "ArrTime": "1046", "ArrDelay": delay, "ArrDelayMinutes": "0.00",
            "Cancelled": cancelled}


def csv_text(rows, order, extra=("TailNum",)):
    buf = io.StringIO()
    w = csv.writer(buf, lineterminator="\n")
    w.writerow(list(order) + list(extra))
    for r in rows:
        w.writerow([r[c] for c in order] + ["N1" for _ in extra])
    return buf.getvalue()


def make_zip(path, members):
    with zipfile.ZipFile(path, "w") as zf:
        for name, text in members.items():
            zf.writestr(name, text)


def test_ingest_end_to_end(spark, workdir):
    raw = os.path.join(workdir, "RAW", "2008")
    os.makedirs(raw)
    order_a = SELECTED_FIELDS
    order_b = list(reversed(SELECTED_FIELDS))
    # archive 1: two members with different column orders, a quoted comma, a short row
    m1 = csv_text([record(4), record(5, carrier="A,B")], order_a)
    m2 = csv_text([record(4, carrier="UA")], order_b) + "\n2008,3\n"
    make_zip(os.path.join(raw, "a_1.zip"), {"a1.csv": m1, "a2.csv": m2, "readme.txt": "x"})
    # archive 2: same day 4 again (both kept), a record with a bad day
    bad_day = record(4)
    bad_day["DayofMonth"] = "31x"
    m3 = csv_text([record(4, carrier="DL", delay=""), bad_day], order_a)
    make_zip(os.path.join(raw, "b_2.zip"), {"b.csv": m3})
    # archive 3: no CSV at all
    make_zip(os.path.join(raw, "c_3.zip"), {"notes.txt": "nothing"})
    # not an archive: ignored
    with open(os.path.join(raw, "ignore.csv"), "w") as fh:
        fh.write("x\n")

    lake = os.path.join(workdir, "lake")
    res = ingest(spark, os.path.join(workdir, "RAW"), lake, os.path.join(workdir, "q"),
                 os.path.join(workdir, "stage"))

    days = {(r.year, r.month, r.day): (r.n_flights, r.arr_delay_sum)
            for r in lake_day_summary(spark, lake).collect()}
    assert days == {(2008, 3, 4): (3, -28.0), (2008, 3, 5): (1, -14.0)}

    got = read_lake(spark, lake).where("Dayd = '05'").collect()[0]
    assert got["UniqueCarrier"] == "A,B" and got["ArrDelay"] == "-14.00" and got["DepTime"] == "905"
    assert set(read_lake(spark, lake).where("Dayd = '04'")
               .select("UniqueCarrier").toPandas().UniqueCarrier) == {"AA", "UA", "DL"}

    m = {(os.path.basename(r.archive), r.member): r for r in res.manifest.collect()}
    a1 = m[("a_1.zip", "a1.csv")]
    assert (a1.read, a1.kept, a1.skipped, a1.written, a1.status) == (2, 2, 0, 2, "OK")
    a2 = m[("a_1.zip", "a2.csv")]
    assert (a2.read, a2.kept, a2.skipped, a2.written, a2.status) == (2, 1, 1, 1, "OK")
    assert (a1.lines, a2.lines) == (2, 3)   # a2 has a blank line: 3 lines, 2 records
    b = m[("b_2.zip", "b.csv")]
    assert (b.read, b.kept, b.skipped, b.written, b.status) == (2, 1, 1, 1, "OK")
    c = m[("c_3.zip", None)]
    assert c.status == "ERROR" and c.error == "no csv member"
    runs = dict((r.status, r.archives) for r in res.runs.collect())
    assert runs == {"OK": 2, "ERROR": 1}
    reasons = sorted(r.reason for r in res.quarantine.collect())
    assert reasons == ["DayofMonth is not a number", "malformed record"]

    # typed load: '-14.00' -> -14, '905' -> '0905', '' delay -> NULL, '' string kept
    table = load(spark, lake, os.path.join(workdir, "table"))
    typed = table.where(F.col("UniqueCarrier") == "DL").collect()[0]
    assert typed["ArrDelay"] is None and typed["DepTime"] == "0905" and typed["Yeard"] == 2008
    assert table.where(F.col("UniqueCarrier") == "AA").collect()[0]["ArrDelay"] == -14
    prof = {r.column: r for r in profile(table).collect()}
    assert prof["ArrDelay"].n_nulls == 1 and prof["ArrDelay"].min_value == "-14"


def test_rerun_replaces_only_written_days(spark, workdir):
    raw1 = os.path.join(workdir, "r1")
    raw2 = os.path.join(workdir, "r2")
    os.makedirs(raw1)
    os.makedirs(raw2)
    make_zip(os.path.join(raw1, "x.zip"), {"x.csv": csv_text([record(4), record(5)], SELECTED_FIELDS)})
    make_zip(os.path.join(raw2, "y.zip"), {"y.csv": csv_text([record(5, carrier="ZZ")], SELECTED_FIELDS)})
    lake = os.path.join(workdir, "lake")
    ingest(spark, raw1, lake, os.path.join(workdir, "q1"), os.path.join(workdir, "s1"))
    ingest(spark, raw2, lake, os.path.join(workdir, "q2"), os.path.join(workdir, "s2"))
    got = sorted((r.Dayd, r.UniqueCarrier) for r in read_lake(spark, lake).collect())
    assert got == [("04", "AA"), ("05", "ZZ")]


def test_bad_bytes_cost_single_records(spark, workdir):
    raw = os.path.join(workdir, "RAW")
    os.makedirs(raw)
    text = csv_text([record(4, carrier=f"C{i}") for i in range(70_000)], SELECTED_FIELDS).encode()
    lake, work = os.path.join(workdir, "lake"), os.path.join(workdir, "w")
    make_zip(os.path.join(raw, "a.zip"), {"a.csv": text})
    ingest(spark, raw, lake, f"{work}/q", f"{work}/s")
    make_zip(os.path.join(raw, "a.zip"), {"a.csv": text.replace(b"C69999", b"C\xff9999")})
    res = ingest(spark, raw, lake, f"{work}/q", f"{work}/s")
    assert read_lake(spark, lake).where("Dayd = '04'").count() == 69_999
    assert [r.reason for r in res.quarantine.collect()] == ["undecodable text"]
    m = res.manifest.collect()[0]
    assert (m.read, m.kept, m.skipped, m.written, m.status) == (70_000, 69_999, 1, 69_999, "OK")


def test_damaged_files_are_reported_and_replace_nothing(spark, workdir):
    raw = os.path.join(workdir, "RAW")
    os.makedirs(raw)
    lake, work = os.path.join(workdir, "lake"), os.path.join(workdir, "w")
    good = csv_text([record(4), record(5)], SELECTED_FIELDS)
    make_zip(os.path.join(raw, "good.zip"), {"g.csv": good})
    ingest(spark, raw, lake, f"{work}/q", f"{work}/s")
    with open(os.path.join(raw, "broken.zip"), "wb") as fh:
        fh.write(b"PK nothing")
    big = csv_text([record(5, carrier=f"X{i}") for i in range(60_000)], SELECTED_FIELDS)
    make_zip(os.path.join(raw, "good.zip"), {"g.csv": csv_text([record(4, carrier="NEW")], SELECTED_FIELDS)})
    path = os.path.join(raw, "half.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_STORED) as zf:
        zf.writestr("h.csv", big)
    data = bytearray(open(path, "rb").read())
    data[len(data) // 2] ^= 0x55   # the member's checksum is wrong
    open(path, "wb").write(data)
    res = ingest(spark, raw, lake, f"{work}/q", f"{work}/s")
    status = {os.path.basename(r.archive): r.status for r in res.manifest.collect()}
    assert status == {"good.zip": "OK", "broken.zip": "ERROR", "half.zip": "ERROR"}
    rows = sorted((r.Dayd, r.UniqueCarrier) for r in read_lake(spark, lake).collect())
    assert rows == [("04", "NEW"), ("05", "AA")]
