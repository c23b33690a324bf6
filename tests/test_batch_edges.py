"""Edge rows through the batch questions (NULL delays, ties, noon, dates, one-sided airports)."""

from helpers import flights_df

from ontime.operators.traffic import airport_activity
from ontime.plans import batch


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_null_mean_ranks_first(spark):
    f = flights_df(spark, [
        {"Origin": "X", "UniqueCarrier": "A", "DepDelay": 5},
        {"Origin": "X", "UniqueCarrier": "B", "DepDelay": None},
        {"Origin": "X", "UniqueCarrier": "C", "DepDelay": -3},
    ])
    out = rows(batch.carriers_per_airport(f).orderBy("rank"))
    assert out == [("X", "B", None, 1), ("X", "C", -3.0, 2), ("X", "A", 5.0, 3)]


def test_round_half_away_from_zero(spark):
    # means 0.125 and -0.125 (1/8): half-up gives 0.13 and -0.13
    base = [{"UniqueCarrier": "P", "ArrDelay": 0}] * 7 + [{"UniqueCarrier": "P", "ArrDelay": 1}]
    neg = [{"UniqueCarrier": "N", "ArrDelay": 0}] * 7 + [{"UniqueCarrier": "N", "ArrDelay": -1}]
    out = dict(rows(batch.best_carriers(flights_df(spark, base + neg))))
    assert out == {"P": 0.13, "N": -0.13}


def test_cancelled_flights_are_left_out_of_means(spark):
    f = flights_df(spark, [{"UniqueCarrier": "A", "ArrDelay": 10},
                           {"UniqueCarrier": "A", "ArrDelay": 1000, "Cancelled": 1}])
    assert rows(batch.best_carriers(f)) == [("A", 10.0)]


def test_top_k_has_stable_tie_break(spark):
    f = flights_df(spark, [{"UniqueCarrier": f"C{i:02d}", "ArrDelay": 1} for i in range(12)])
    out = rows(batch.best_carriers(f))
    assert [r[0] for r in out] == [f"C{i:02d}" for i in range(10)]


def test_traffic_needs_both_sides_and_counts_flightnum(spark):
    f = flights_df(spark, [
        {"Origin": "A", "Dest": "B"},
        {"Origin": "B", "Dest": "A", "FlightNum": ""},     # '' is a value: counted
        {"Origin": "B", "Dest": "A", "FlightNum": None},   # NULL: not counted
        {"Origin": "D", "Dest": "A"},                      # D departs only
    ])
    out = dict(rows(batch.busiest_airports(f)))
    # A: 1 departure + 2 counted arrivals; B: 1 counted departure + 1 arrival; D dropped
    assert out == {"A": 3, "B": 2}
    stream = dict(rows(airport_activity(f)))
    assert stream == {"A": 4, "B": 3, "D": 1}


def test_popularity_rank_keeps_ties(spark):
    f = flights_df(spark, [{"Origin": "A", "Dest": "B"}, {"Origin": "B", "Dest": "A"},
                           {"Origin": "C", "Dest": "A"}, {"Origin": "A", "Dest": "C"}])
    out = rows(batch.airport_popularity(f))
    assert out == [("A", 4, 1), ("B", 2, 2), ("C", 2, 2)]


def test_itinerary_noon_ties_and_dates(spark):
    f = flights_df(spark, [
        # X->Y morning on 2008-02-28, two flights tied for best, one worse
        {"Origin": "X", "Dest": "Y", "FlightDate": "2008-02-28", "DepTime": "0005", "ArrDelay": 1, "FlightNum": "1"},
        {"Origin": "X", "Dest": "Y", "FlightDate": "2008-02-28", "DepTime": "1100", "ArrDelay": 1, "FlightNum": "2"},
        {"Origin": "X", "Dest": "Y", "FlightDate": "2008-02-28", "DepTime": "0700", "ArrDelay": 9, "FlightNum": "3"},
        # exactly noon is in neither leg
        {"Origin": "X", "Dest": "Y", "FlightDate": "2008-02-28", "DepTime": "1200", "ArrDelay": -50, "FlightNum": "4"},
        # Y->Z afternoon two days later (leap year: 03-01)
        {"Origin": "Y", "Dest": "Z", "FlightDate": "2008-03-01", "DepTime": "1300", "ArrDelay": 2, "FlightNum": "5"},
        # afternoon on the wrong day
        {"Origin": "Y", "Dest": "Z", "FlightDate": "2008-02-29", "DepTime": "1300", "ArrDelay": 0, "FlightNum": "6"},
        # first leg on 12-30: the second leg would be in the next year
        {"Origin": "X", "Dest": "Y", "FlightDate": "2008-12-30", "DepTime": "0800", "ArrDelay": 0, "FlightNum": "7"},
        {"Origin": "Y", "Dest": "Z", "FlightDate": "2009-01-01", "DepTime": "1500", "ArrDelay": 0, "FlightNum": "8"},
        # cancelled flights never count
        {"Origin": "Y", "Dest": "Z", "FlightDate": "2008-03-01", "DepTime": "1400", "ArrDelay": -9,
         "FlightNum": "9", "Cancelled": 1},
    ])
    out = batch.two_leg_itineraries(f, 2008)
    got = sorted((r["flightnum1"], r["flightnum2"], r["total_delay"], r["itinerary"]) for r in out.collect())
    assert got == [("1", "5", 3.0, "X-Y-Z"), ("2", "5", 3.0, "X-Y-Z")]


def test_itinerary_null_delay_takes_rank_one(spark):
    f = flights_df(spark, [
        {"Origin": "X", "Dest": "Y", "FlightDate": "2008-05-01", "DepTime": "0800", "ArrDelay": None, "FlightNum": "1"},
        {"Origin": "X", "Dest": "Y", "FlightDate": "2008-05-01", "DepTime": "0900", "ArrDelay": -5, "FlightNum": "2"},
        {"Origin": "Y", "Dest": "Z", "FlightDate": "2008-05-03", "DepTime": "1300", "ArrDelay": 4, "FlightNum": "3"},
    ])
    got = [(r["flightnum1"], r["total_delay"]) for r in batch.two_leg_itineraries(f, 2008).collect()]
    assert got == [("1", None)]
    strict = [(r["flightnum1"], r["total_delay"])
              for r in batch.two_leg_itineraries(f, 2008, require_delay=True).collect()]
    assert strict == [("2", -1.0)]


def test_itinerary_bad_date_never_matches(spark):
    f = flights_df(spark, [
        {"Origin": "X", "Dest": "Y", "FlightDate": "2008-05-01", "DepTime": "", "ArrDelay": 1, "FlightNum": "1"},
        {"Origin": "X", "Dest": "Y", "FlightDate": "2008-13-45", "Year": 2008, "Month": 5, "DayofMonth": 2,
         "DepTime": "0800", "ArrDelay": 0, "FlightNum": "2"},
        {"Origin": "Y", "Dest": "Z", "FlightDate": "2008-05-03", "DepTime": "1300", "ArrDelay": 4, "FlightNum": "3"},
        {"Origin": "Y", "Dest": "Z", "FlightDate": "not a date", "Year": 2008, "Month": 5, "DayofMonth": 4,
         "DepTime": "1300", "ArrDelay": 0, "FlightNum": "4"},
    ])
    got = sorted((r.flightnum1, r.flightnum2) for r in batch.two_leg_itineraries(f, 2008).collect())
    # '' sorts before '1200' (a morning leg); bad dates raise nothing and match nothing
    assert got == [("1", "3")]
