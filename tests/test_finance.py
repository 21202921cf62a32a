"""Schedules and projections against plain month-by-month loops."""

from datetime import date

import pytest
from pyspark.sql import functions as F
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException

from ledgerlens import config as C
from ledgerlens import schemas as S
from ledgerlens.operators import finance as N
from ledgerlens.operators import joins as J


def loop_schedule(amount, rate, years):
    if amount <= 0 or years <= 0:
        return [0.0] * C.DEBT_MONTHS
    r, n = rate / 1200, max(1, int(years * 12))
    pay = amount / n if r == 0 else amount * r / (1 - (1 + r) ** -n)
    out, balance = [], amount
    for k in range(C.DEBT_MONTHS):
        if k >= n or balance <= C.REPAID_BELOW:
            out.append(0.0)
            continue
        out.append(balance * r)
        balance -= pay - balance * r
    return out


def loop_projection(s, loans):
    n = int(s["horizon_years"] * 12)
    existing = [sum(col) for col in zip(*[loop_schedule(*loan) for loan in loans])] if loans else []
    x, a, debt = s["perf_start"], s["npa_start"], s["new_debt_amount"]
    r = s["new_debt_rate"] / 1200
    pay = 0.0
    if debt > 0 and s["new_debt_type"] == C.AMORTISED:
        pay = debt / n if r == 0 else debt * r / (1 - (1 + r) ** -n)
    rec = 1 - (1 - s["rec_npa_rate"] / 100) ** (1 / 12)
    amount, out = debt, []
    for i in range(n):
        rev = x * s["rev_rate"] / 1200
        gross = rev - (x + a) * s["prov_rate"] / 1200 - x * s["cof_rate"] / 1200 - s["cogs"] / 12
        ebitda = gross - rev * s["opex_pct"] / 100
        paid = debt * r + (existing[i] if i < len(existing) else 0.0)
        ebt = ebitda - s["dep_amort"] / 12 + s["fx_impact"] / 12 + s["non_op"] / 12 - paid
        net = ebt - max(0.0, ebt * s["tax_rate"] / 100)
        repaid = 0.0
        if amount > 0:
            if s["new_debt_type"] == C.AMORTISED:
                repaid = pay - debt * r
            elif s["new_debt_type"] == C.BULLET and i == n - 1:
                repaid = debt
        x, a, debt = x + net + s["dep_amort"] / 12 + a * rec - repaid, a - a * rec, debt - repaid
        out.append((x, a, net, -paid))
    return out


LOANS = [(100.0, 12.0, 3.0), (50.0, 0.0, 2.0), (80.0, -6.0, 1.5), (0.5, 10.0, 0.05), (-3.0, 9.0, 2.0), (10.0, 9.0, 0.0),
         (9.0, 30.0, 15.0), (0.009, 5.0, 4.0)]


def test_schedule_equals_loop(spark):
    loans = spark.createDataFrame([(i, *loan) for i, loan in enumerate(LOANS)], "id int, amount double, rate double, term_years double")
    got = {(r.id, r.month): r.interest for r in N.debt_schedule(loans).collect()}
    for i, loan in enumerate(LOANS):
        for k, expected in enumerate(loop_schedule(*loan)):
            assert got[i, k] == pytest.approx(expected, abs=1e-9)


def test_missing_term_is_three_years(spark):
    loans = spark.createDataFrame([(1, 10.0, 12.0, None), (2, 10.0, 12.0, 3.0)], "id int, amount double, rate double, term_years double")
    out = N.debt_schedule(loans)
    assert out.filter("id = 1 and interest > 0").count() == 36
    assert out.filter("id = 2 and interest > 0").count() == 36


def scenario(i, **changes):
    base = {"scenario_id": str(i), "start_date": date(2025, 1, 31), "perf_start": 86.17, "npa_start": 21.28,
            **C.SCENARIO_DEFAULTS, **changes}
    return {n: base[n] for n in S.SCENARIO.names}


def check(spark, scenarios, loans):
    table = spark.createDataFrame([tuple(s.values()) for s in scenarios], S.SCENARIO)
    book = spark.createDataFrame([(s, *loan) for s, loan in loans], S.LOANS) if loans else None
    got = {(r.scenario_id, r.month): r for r in N.project_pnl(table, book).collect()}
    expected_rows = 0
    for s in scenarios:
        expected = loop_projection(s, [loan for owner, loan in loans if owner == s["scenario_id"]])
        expected_rows += len(expected)
        for k, (x, a, net, paid) in enumerate(expected):
            r = got[s["scenario_id"], k]
            assert (r.fiu_performing, r.fiu_npa, r.earnings, r.financial_expenses) == pytest.approx((x, a, net, paid), rel=1e-9, abs=1e-9)
    assert len(got) == expected_rows


def test_projection_equals_loop(spark):
    scenarios = [
        scenario(1), scenario(2, new_debt_amount=20.0), scenario(3, new_debt_amount=20.0, new_debt_type=C.BULLET),
        scenario(4, new_debt_amount=20.0, new_debt_rate=0.0), scenario(5, rev_rate=5.0, opex_pct=90.0),
        scenario(6, rec_npa_rate=100.0), scenario(7, horizon_years=0.0), scenario(8, horizon_years=12.0),
    ]
    check(spark, scenarios, [("1", LOANS[0]), ("1", LOANS[6]), ("8", LOANS[0]), ("5", LOANS[2])])
    check(spark, scenarios[:2], [])


_percent = st.floats(-50, 90).map(lambda v: round(v, 2))


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(_percent, _percent, st.floats(0, 60), st.booleans(), st.floats(0, 100)), min_size=1, max_size=5))
def test_projection_equals_loop_for_any_rates(spark, drawn):
    scenarios = [
        scenario(i, rev_rate=rev, opex_pct=opex, new_debt_amount=debt, rec_npa_rate=rec,
                 new_debt_type=C.AMORTISED if level else C.BULLET, horizon_years=2.0)
        for i, (rev, opex, debt, level, rec) in enumerate(drawn)
    ]
    check(spark, scenarios, [])


def test_recovery_above_hundred_percent_is_rejected(spark):
    table = spark.createDataFrame([tuple(scenario(1, rec_npa_rate=120.0).values())], S.SCENARIO)
    with pytest.raises(PySparkException, match="rec_npa_rate above 100 in scenario 1"):
        N.project_pnl(table).collect()


def test_annual_statement_and_kpis(spark):
    table = spark.createDataFrame([tuple(scenario(1, start_date=date(2025, 6, 15)).values())], S.SCENARIO)
    monthly = N.project_pnl(table).persist()
    assert monthly.agg({"month_end": "min"}).first()[0] == date(2025, 6, 30)
    annual = N.annualize(monthly)
    years = {r.year: r for r in annual.collect()}
    assert sorted(years) == list(range(2025, 2031))
    last = monthly.filter("month_end = '2025-12-31'").first()
    assert years[2025].fiu_performing == last.fiu_performing
    statement = N.pnl_statement(annual)
    assert statement.count() == 20 * 6
    shown = N.pnl_display(statement, [str(y) for y in years]).collect()
    assert [r.line for r in shown][:3] == ["FIU Performing", "FIU NPA", "Total FIU"]
    assert shown[2]["2025"] == pytest.approx(shown[0]["2025"] + shown[1]["2025"])
    assert N.pnl_statement(monthly).filter("period = 'Jun-25'").count() == 20
    kpis = N.projection_kpis(annual).first()
    assert kpis.total_earnings == pytest.approx(sum(y.earnings for y in years.values()))
    assert kpis.final_portfolio == pytest.approx(years[2030].fiu_performing + years[2030].fiu_npa)
    margins = N.margin_shift(annual).first()
    assert margins.first_margin == pytest.approx(years[2025].earnings / years[2025].revenues * 100)


def test_margin_of_no_revenue_is_zero(spark):
    table = spark.createDataFrame([tuple(scenario(1, rev_rate=0.0).values())], S.SCENARIO)
    assert tuple(N.margin_shift(N.project_pnl(table)).first())[1:] == (0.0, 0.0)


def test_debt_book_is_shared_out(spark):
    book = spark.createDataFrame(C.DEBT_BOOK, S.DEBT_BOOK)
    totals = {r.vista: r.total for r in N.debt_total(J.debt_allocation(book)).collect()}
    whole = sum(d[2] for d in C.DEBT_BOOK) / 1e6
    abroad = sum(d[2] for d in C.DEBT_BOOK if d[0] == C.SHARED_DEBT_COUNTRY) / 1e6
    assert totals["Regional"] == pytest.approx(whole)
    assert totals["Brasil"] == pytest.approx(abroad * (9.32 + 18.44) / (531.41 + 71.30))
    labels = {r.type for r in J.debt_allocation(book).filter("vista = 'Perú'").collect()}
    assert labels == {"B-Notes", "NATF (Perú share)", "Senior Note (Perú share)", "Sp Mbr C (Perú share)"}


def test_country_views_take_portfolio_and_debt(spark):
    from ledgerlens.plans.projection import country_scenarios, project_countries
    from ledgerlens.sources.literals import debt_book, portfolio

    assert portfolio(spark).count() == 5
    scenarios = [r.asDict() for r in country_scenarios(spark, date(2025, 1, 31)).collect()]
    assert {s["scenario_id"] for s in scenarios} == {p[0] for p in C.PORTFOLIO}
    assert all(s["opex_pct"] == 44.0 and s["new_debt_type"] == C.AMORTISED for s in scenarios)
    loans = [
        (r.vista, (r.balance, r.rate, r.term_years)) for r in J.debt_allocation(debt_book(spark)).collect()
    ]
    got = {(r.scenario_id, r.month): r for r in project_countries(debt_book(spark), date(2025, 1, 31)).collect()}
    assert len(got) == 5 * 60
    for s in scenarios:
        expected = loop_projection(s, [loan for view, loan in loans if view == s["scenario_id"]])
        assert got[s["scenario_id"], 59].fiu_performing == pytest.approx(expected[59][0], rel=1e-9)


def test_interest_of_scenarios_equals_the_sum_over_schedules(spark):
    """A hot scenario, one without interest, missing and odd values, a scenario without a name, equal loans."""
    loans = [("hot", float(100 + i), i % 7 * 1.5, i % 5) for i in range(60)] + [
        ("one", 1000.0, 0.0, 3), ("one", 1000.0, 0.0, 3), (None, 50.0, 12.0, 1), ("none", -5.0, 10.0, 2), ("odd", None, 9.0, 2), ("odd", 70.0, None, 2), ("odd", 70.0, 9.0, None)]
    table = spark.createDataFrame(loans, "scenario_id string, amount double, rate double, term_years int").coalesce(1)
    want = {(r[0], r[1]): r[2] for r in N.debt_schedule(table, 40).groupBy("scenario_id", "month").agg(F.sum("interest")).collect()}
    got = {(r.scenario_id, r.month): r.interest for r in N.debt_interest_total(table, 40).collect()}
    assert got == pytest.approx(want, rel=1e-9, abs=1e-9) and len(got) == 5 * 40
    assert N.debt_interest_total(table.limit(0)).count() == 0


def test_one_vector_travels_per_scenario_and_task(spark):
    table = spark.createDataFrame([("a", 1.0, 2.0, 3)], "scenario_id string, amount double, rate double, term_years int")
    plan = N.interest_vectors(table)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "Generate" not in plan
    assert plan.index("ObjectHashAggregate") < plan.index("Exchange hashpartitioning") < plan.rindex("ObjectHashAggregate")


def test_months_after_a_loan_has_ended_are_not_evaluated(spark):
    rows = [("a", 100.0, 12.0, 1), ("b", 100.0, 0.0, 40), ("c", 100.0, 5.0, 0), ("d", 100.0, 5.0, 10), ("e", -1.0, 5.0, 2)]
    table = spark.createDataFrame(rows, "scenario_id string, amount double, rate double, term_years int")
    vectors = N.interest_vectors(table)
    assert "array_repeat(0.0, (120 - " in vectors._jdf.queryExecution().optimizedPlan().toString()
    got = {r.scenario_id: r.interest for r in vectors.collect()}
    assert all(len(v) == 120 for v in got.values()) and got["a"][11] > 0 and set(got["a"][12:]) == {0.0}
    assert got["d"][119] > 0 and not any(got["b"] + got["c"] + got["e"])
