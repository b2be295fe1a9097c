import datetime as dt

from casaflow.operators import panel as P

FACT = "geo_key long, {m} double, metric_date date, year int"


def _facts(spark):
    d1, d2 = dt.date(2020, 1, 31), dt.date(2020, 2, 29)
    hv = spark.createDataFrame([(1, 300000.0, d1, 2020), (1, 0.0, d2, 2020),
                                (2, 200000.0, d1, 2020)], FACT.format(m="avg_house_value"))
    ri = spark.createDataFrame([(1, 2000.0, d1, 2020), (1, 1500.0, d2, 2020),
                                (3, 900.0, d1, 2020)], FACT.format(m="rental_income"))
    mp = spark.createDataFrame([(1, 1500.0, d1, 2020), (3, 0.0, d1, 2020)],
                               FACT.format(m="monthly_payment"))
    dim = spark.createDataFrame([(1, "A", "WA"), (2, "B", "WA"), (3, "C", "WA"), (4, "D", "OR")],
                                "geo_key long, metro string, state string")
    return {"house_value": hv, "rental_income": ri, "monthly_payment": mp}, dim


def test_panel_outer_semantics_and_zero_ratios(spark):
    facts, dim = _facts(spark)
    rows = {(r.metro, str(r.metric_month)): r for r in
            P.combined_panel(facts, dim, "WA").collect()}
    assert set(rows) == {("A", "2020-01-01"), ("A", "2020-02-01"), ("B", "2020-01-01"),
                         ("C", "2020-01-01")}
    a1 = rows[("A", "2020-01-01")]
    assert (a1.gross_yield, a1.cash_flow, a1.price_to_rent_ratio) == (0.08, 500.0, 12.5)
    a2 = rows[("A", "2020-02-01")]          # zero value: ratios null, not infinite
    assert a2.gross_yield is None and a2.price_to_rent_ratio == 0.0 and a2.cash_flow is None
    b = rows[("B", "2020-01-01")]           # value only: two metrics missing
    assert b.rental_income is None and b.monthly_payment is None and b.gross_yield is None
    c = rows[("C", "2020-01-01")]           # no value; zero payment
    assert c.avg_house_value is None and c.cash_flow == 900.0 and c.gross_yield is None
    cov = {r.metro: r for r in P.coverage_report(P.combined_panel(facts, dim, None)).collect()}
    assert (cov["B"].has_house_value, cov["B"].has_rental_income) == (True, False)
    assert "D" not in cov                   # a dimension row without facts has no panel rows


def test_feeds_drop_only_their_columns(spark):
    facts, dim = _facts(spark)
    panel = P.combined_panel(facts, dim, "WA")
    assert {r.metro for r in P.feed_trend(panel, "avg_house_value").collect()} == {"A", "B"}
    assert {r.metro for r in P.feed_trend(panel, "rental_income").collect()} == {"A", "C"}
    vr = P.feed_value_vs_rent(panel).collect()
    assert {(r.metro, str(r.metric_month)) for r in vr} == {("A", "2020-01-01"),
                                                             ("A", "2020-02-01")}
    assert {r.metric for r in vr} == {"House Value", "Monthly Rent"}
    cf = {(r.metro, r.cash_flow, r.above_break_even) for r in P.feed_cash_flow(panel).collect()}
    assert cf == {("A", 500.0, True), ("C", 900.0, True)}
    rm = P.feed_rent_vs_mortgage(panel).collect()
    assert sorted((r.metro, r.metric, r.amount) for r in rm) == [
        ("A", "Mortgage Payment", 1500.0), ("A", "Rent Income", 2000.0),
        ("C", "Mortgage Payment", 0.0), ("C", "Rent Income", 900.0)]


def test_default_metros(spark):
    panel = spark.createDataFrame([("Tacoma",), ("Aberdeen",), ("Bellingham",), ("Yakima",)],
                                  "metro string")
    assert [r.metro for r in P.default_metros(panel).collect()] == ["Tacoma"]
    none_pref = panel.where("metro <> 'Tacoma'")
    assert sorted(r.metro for r in P.default_metros(none_pref).collect()) == [
        "Aberdeen", "Bellingham", "Yakima"]


def test_default_metros_keeps_every_preferred_one(spark):
    panel = spark.createDataFrame([(m,) for m in "ABCDEXYZ"] + [(None,)], "metro string")
    pick = lambda preferred, n: sorted(r.metro for r in P.default_metros(panel, preferred, n).collect())
    assert pick(list("EDCBA"), 3) == list("ABCDE")
    assert pick(["Q"], 3) == list("ABC")


def test_roi_is_safe_over_gaps(spark):
    from casaflow.operators.analytics import roi_5y
    rows = [("a", "2010-01-01", 100.0), ("a", "2015-01-01", 150.0), ("a", "2015-02-01", 9.0), ("b", "2010-01-01", None), ("b", "2015-01-01", 5.0), ("b", "2016-01-01", 5.0)]
    df = spark.createDataFrame(rows, "metro string, d string, avg_house_value double").selectExpr("metro", "cast(d as date) metric_month", "avg_house_value")
    got = {(r.metro, str(r.metric_month)): (r.value_5y_ago, r.roi_5y) for r in roi_5y(df).collect()}
    assert got == {("a", "2015-01-01"): (100.0, 0.5), ("b", "2015-01-01"): (None, None)}
