"""Random small fixtures checked against plain-Python brute force."""

import random
from collections import defaultdict
from datetime import date, timedelta

import pytest

from helpers import flights_df
from ontime.operators.itinerary import best_flights
from ontime.operators.traffic import airport_traffic
from ontime.plans import batch

AIRPORTS = ["A", "B", "C", "D"]
CARRIERS = ["X", "Y", "Z"]


def random_rows(seed, n=60):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        d = date(2008, 1, 1) + timedelta(days=rnd.randrange(5))
        rows.append({
            "Origin": rnd.choice(AIRPORTS + [None]), "Dest": rnd.choice(AIRPORTS),
            "UniqueCarrier": rnd.choice(CARRIERS), "FlightNum": str(i),
            "ArrDelay": rnd.choice([None, -2, 0, 0, 1, 3]), "DepDelay": rnd.choice([None, 1, 2]),
            "Cancelled": rnd.choice([0, 0, 0, 1]), "FlightDate": d.isoformat(),
            "DepTime": rnd.choice(["0700", "1100", "1200", "1300", "1700", ""]),
        })
    return rows


def mean2(values):
    vals = [v for v in values if v is not None]
    if not vals:
        return None
    s, n = sum(vals), len(vals)
    q = (200 * abs(s) + n) // (2 * n)
    return (q if s >= 0 else -q) / 100


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_traffic_and_carrier_ranks(spark, seed):
    rows = random_rows(seed)
    f = flights_df(spark, rows)
    dep, arr = defaultdict(int), defaultdict(int)
    seen_dep, seen_arr = set(), set()
    for r in rows:
        if r["Origin"] is not None:
            seen_dep.add(r["Origin"])
            dep[r["Origin"]] += 1
        seen_arr.add(r["Dest"])
        arr[r["Dest"]] += 1
    expect = {a: dep[a] + arr[a] for a in seen_dep & seen_arr}
    got = {r.airport: r.total_flights for r in airport_traffic(f).collect()}
    assert got == expect

    groups = defaultdict(list)
    for r in rows:
        if r["Cancelled"] == 0:
            groups[(r["Origin"], r["UniqueCarrier"])].append(r["DepDelay"])
    per_airport = defaultdict(list)
    for (o, c), v in groups.items():
        per_airport[o].append((mean2(v), c))
    expect_rank = {}
    for o, items in per_airport.items():
        key = sorted(items, key=lambda t: (t[0] is not None, t[0] if t[0] is not None else 0, t[1]))
        for item in key:
            rank = 1 + sum(1 for other in key
                           if (other[0] is None and item[0] is not None)
                           or (other[0] is not None and item[0] is not None and other[0] < item[0])
                           or (other[0] == item[0] and other[1] < item[1]))
            if rank <= 10:
                expect_rank[(o, item[1])] = (item[0], rank)
    got_rank = {(r.airport, r.airline): (r.avg_delay, r.rank)
                for r in batch.carriers_per_airport(f).collect()}
    assert got_rank == expect_rank


@pytest.mark.parametrize("seed", [4, 5, 6])
def test_best_flights_and_itineraries(spark, seed):
    rows = random_rows(seed, 80)
    f = flights_df(spark, rows)
    # rank() = 1 by ArrDelay per (Origin, Dest, day), NULLs first, ties kept
    groups = defaultdict(list)
    for r in rows:
        groups[(r["Origin"], r["Dest"], r["FlightDate"])].append(r)
    expect = set()
    for g in groups.values():
        nulls = [r for r in g if r["ArrDelay"] is None]
        best = nulls or [r for r in g if r["ArrDelay"] == min(x["ArrDelay"] for x in g)]
        expect |= {r["FlightNum"] for r in best}
    got = {r.FlightNum for r in best_flights(f).collect()}
    assert got == expect

    def legs(cmp):
        g = defaultdict(list)
        for r in rows:
            if r["Cancelled"] == 0 and cmp(r["DepTime"]):
                g[(r["Origin"], r["Dest"], r["FlightDate"])].append(r)
        out = []
        for items in g.values():
            nulls = [r for r in items if r["ArrDelay"] is None]
            out += nulls or [r for r in items if r["ArrDelay"] == min(x["ArrDelay"] for x in items)]
        return out

    am, pm = legs(lambda t: t < "1200"), legs(lambda t: t > "1200")
    expect_pairs = set()
    for a in am:
        for b in pm:
            if a["Dest"] == b["Origin"] and \
                    date.fromisoformat(a["FlightDate"]) + timedelta(days=2) == date.fromisoformat(b["FlightDate"]):
                expect_pairs.add((a["FlightNum"], b["FlightNum"]))
    got_pairs = {(r.flightnum1, r.flightnum2) for r in batch.two_leg_itineraries(f, 2008).collect()}
    assert got_pairs == expect_pairs
