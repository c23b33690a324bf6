"""DuckDB SQL equivalents of the registered jobs, used as the correctness oracle.

Each statement reads the driver's pre-registered views (lineitem, orders, ...). The
flights mapping is the same as ``sources.testdata.flights``. Means use exact integer
arithmetic for ``round(avg(x), 2)`` half-up (DuckDB and Spark round binary doubles
differently on ties); ranks sort NULLs first, as Spark's ascending order does.
"""

from __future__ import annotations

from ..sources.testdata import flights_sql

ITINERARY_YEAR = 2000


def flights_cte() -> str:
    return f"WITH flights AS ({flights_sql()})\n"


def r2(x: str) -> str:
    """Exact ``round(avg(x), 2)`` half away from zero, for integer-valued ``x``."""
    return (f"(CASE WHEN count({x}) = 0 THEN NULL ELSE "
            f"CAST((CASE WHEN sum({x}) < 0 THEN -1 ELSE 1 END) * "
            f"((200 * abs(sum({x})) + count({x})) // (2 * count({x}))) AS DOUBLE) / 100 END)")


def traffic_sql(where: str = "") -> str:
    return f"""
SELECT o.origin AS airport, o.dep + d.arr AS total_flights
FROM (SELECT Origin AS origin, count(FlightNum) AS dep FROM flights {where} GROUP BY Origin) o
JOIN (SELECT Dest AS dest, count(FlightNum) AS arr FROM flights {where} GROUP BY Dest) d
  ON o.origin = d.dest"""


def q2_1_sql(source: str = "flights") -> str:
    return f"""
SELECT airport, airline, avg_delay, "rank" FROM (
  SELECT *, rank() OVER (PARTITION BY airport ORDER BY avg_delay NULLS FIRST, airline NULLS FIRST) AS "rank"
  FROM (SELECT Origin AS airport, UniqueCarrier AS airline, {r2('DepDelay')} AS avg_delay
        FROM {source} f WHERE Cancelled = 0 GROUP BY Origin, UniqueCarrier) u
) r WHERE "rank" <= 10"""


def q2_2_sql() -> str:
    return f"""
SELECT origin, dest, avg_delay, "rank" FROM (
  SELECT *, rank() OVER (PARTITION BY origin ORDER BY avg_delay NULLS FIRST, dest NULLS FIRST) AS "rank"
  FROM (SELECT Origin AS origin, Dest AS dest, {r2('DepDelay')} AS avg_delay
        FROM flights WHERE Cancelled = 0 GROUP BY Origin, Dest) u
) r WHERE "rank" <= 10"""


def q2_3_sql() -> str:
    return f"""
SELECT x || '-' || y AS flight, airline, avg_delay, "rank" FROM (
  SELECT *, rank() OVER (PARTITION BY x, y ORDER BY avg_delay NULLS FIRST, airline NULLS FIRST) AS "rank"
  FROM (SELECT Origin AS x, Dest AS y, UniqueCarrier AS airline, {r2('ArrDelay')} AS avg_delay
        FROM flights WHERE Cancelled = 0 AND ArrDelay IS NOT NULL
        GROUP BY Origin, Dest, UniqueCarrier) u
) r WHERE "rank" <= 10"""


def q2_4_sql() -> str:
    return f"""
SELECT Origin || '-' || Dest AS flight, {r2('ArrDelay')} AS avg_delay
FROM flights WHERE Cancelled = 0 AND ArrDelay IS NOT NULL GROUP BY Origin, Dest"""


def q3_2_sql(year: int = ITINERARY_YEAR) -> str:
    """Best flights as the minimum per route, day and half-day; a missing delay is best."""
    return f"""
SELECT a.Origin AS x, a.Dest AS y, a.UniqueCarrier AS airline1, a.FlightNum AS flightnum1, a.FlightDate AS flightdate1,
  a.DepTime AS departure1, CAST(a.ArrDelay AS DOUBLE) AS delay1, b.Dest AS z, b.UniqueCarrier AS airline2,
  b.FlightNum AS flightnum2, b.FlightDate AS flightdate2, b.DepTime AS departure2, CAST(b.ArrDelay AS DOUBLE) AS delay2,
  CAST(a.ArrDelay + b.ArrDelay AS DOUBLE) AS total_delay, concat(a.Origin, '-', a.Dest, '-', b.Dest) AS itinerary
FROM ({_best_sql("<", year)}) a JOIN ({_best_sql(">", year)}) b
  ON a.Dest = b.Origin AND try_cast(b.FlightDate AS DATE) - try_cast(a.FlightDate AS DATE) = 2"""


def _best_sql(half: str, year: int) -> str:
    flown = f"SELECT * FROM flights WHERE Yeard = {year} AND Cancelled = 0 AND DepTime {half} '1200'"
    return f"""SELECT f.* FROM ({flown}) f JOIN (
    SELECT Origin, Dest, Monthd, DayofMonth, min(ArrDelay) AS least, bool_or(ArrDelay IS NULL) AS unknown
    FROM ({flown}) g GROUP BY Origin, Dest, Monthd, DayofMonth) m
  USING (Origin, Dest, Monthd, DayofMonth) WHERE CASE WHEN unknown THEN ArrDelay IS NULL ELSE ArrDelay = least END"""


def batch_oracles() -> dict[str, str]:
    f = flights_cte()
    return {
        "q1_1": f + traffic_sql() + "\nORDER BY total_flights DESC, airport LIMIT 10",
        "q1_2": f + f"""
SELECT UniqueCarrier AS airline, {r2('ArrDelay')} AS avg_delay
FROM flights WHERE Cancelled = 0 GROUP BY UniqueCarrier
ORDER BY avg_delay NULLS FIRST, airline LIMIT 10""",
        "q1_3": f + f"""
SELECT DayOfWeek AS Weekday, {r2('ArrDelay')} AS avg_delay
FROM flights WHERE Cancelled = 0 GROUP BY DayOfWeek ORDER BY avg_delay NULLS FIRST, Weekday""",
        "q2_1": f + q2_1_sql(),
        "q2_2": f + q2_2_sql(),
        "q2_3": f + q2_3_sql(),
        "q2_4": f + q2_4_sql(),
        "q3_1": f + f"""
SELECT airport, total_flights, rank() OVER (ORDER BY total_flights DESC) AS rnk
FROM ({traffic_sql('WHERE Cancelled = 0')}) t ORDER BY rnk, airport""",
        "q3_2": f + q3_2_sql(),
        "upsert": f + f"""
, n AS ({q2_1_sql(f"(SELECT * FROM flights WHERE Yeard = {ITINERARY_YEAR})")}), o AS ({q2_1_sql()})
SELECT * FROM n UNION ALL SELECT * FROM o WHERE NOT EXISTS (
  SELECT 1 FROM n WHERE n.airport = o.airport AND n.airline = o.airline)""",
    }


def _in_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def lookup_oracles(airports, routes, pairs) -> dict[str, str]:
    f = flights_cte()
    cond = " OR ".join(f"(itinerary = '{i}' AND flightdate1 = '{d}')" for i, d in pairs)
    return {
        "q_l1": f + f"SELECT * FROM ({q2_1_sql()}) t WHERE airport IN ({_in_list(airports)})",
        "q_l2": f + f"SELECT * FROM ({q2_2_sql()}) t WHERE origin IN ({_in_list(airports)})",
        "q_l3": f + f"SELECT * FROM ({q2_3_sql()}) t WHERE flight IN ({_in_list(routes)})",
        "q_l4": f + f"SELECT * FROM ({q2_4_sql()}) t WHERE flight IN ({_in_list(routes)})",
        "q_l5": f + f"SELECT * FROM ({q3_2_sql()}) t WHERE {cond} ORDER BY itinerary",
    }
