"""Hand-made flights rows for edge-case tests."""

from ontime.config import TABLE_FIELDS
from ontime.schema import FLIGHTS_SCHEMA

DEFAULTS = {
    "DayOfWeek": 2, "Origin": "AAA", "UniqueCarrier": "C1", "FlightNum": "100", "Dest": "BBB",
    "ArrDelayMinutes": 0, "FlightDate": "2008-03-04", "ArrDelay": 0, "Month": 3,
    "DepDelayMinutes": 0, "DepDelay": 0, "CRSArrTime": "1000", "Year": 2008, "Cancelled": 0,
    "ArrTime": "1000", "DepTime": "0900", "CRSDepTime": "0900", "DayofMonth": 4,
}


def flights_df(spark, rows):
    out = []
    for r in rows:
        d = dict(DEFAULTS)
        d.update(r)
        if "FlightDate" in r and ("Year" not in r or "Month" not in r or "DayofMonth" not in r):
            y, m, day = (int(x) for x in r["FlightDate"].split("-"))
            d.setdefault("Year", y)
            d["Year"], d["Month"], d["DayofMonth"] = r.get("Year", y), r.get("Month", m), r.get("DayofMonth", day)
        d["Yeard"], d["Monthd"] = d["Year"], d["Month"]
        out.append(tuple(d[c] for c in TABLE_FIELDS + ["Yeard", "Monthd"]))
    return spark.createDataFrame(out, FLIGHTS_SCHEMA)
