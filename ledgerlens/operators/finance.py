"""Loan schedules and profit-and-loss projections over tables of loans and scenarios."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens import config as C
from ledgerlens.functions import columns as X

# Result columns of a projection: end-of-month balances, then the flows of the month.
BALANCES = ("fiu_performing", "fiu_npa")
FLOWS = (
    "revenues", "provisions", "cof", "cogs", "gross_income", "opex", "ebitda", "dep_amort",
    "exchange_rates", "non_operating", "financial_expenses", "ebt", "taxes", "earnings",
)


def _months(years: Column) -> Column:
    """Whole months of a term in years."""
    return F.floor(years * 12).cast("int")


def _monthly(percent: Column) -> Column:
    return percent / 100 / 12


def _level_balance(principal: Column, rate: Column, n: Column, k: Column) -> Column:
    """Balance of a level-payment loan after ``k`` of ``n`` payments."""
    log = F.log1p(rate)
    growing = principal * F.exp(log * k) * F.expm1(log * (n - k)) / F.expm1(log * n)
    return F.when(rate == 0, principal * (1 - k / n)).otherwise(growing)


def _level_payment(principal: Column, rate: Column, n: Column) -> Column:
    return F.when(rate == 0, principal / n).otherwise(principal * rate / -F.expm1(-F.log1p(rate) * n))


def _terms(loans: DataFrame) -> DataFrame:
    """Loans with what does not change over the months, computed once per loan."""
    term = F.coalesce("term_years", F.lit(C.DEFAULT_TERM_YEARS))
    terms = loans.withColumns({
        "_rate": _monthly(F.col("rate")),
        "_n": F.when((F.col("amount") > 0) & (term > 0), F.greatest(F.lit(1), _months(term))).otherwise(F.lit(0)),
    })
    growing = (F.col("_n") > 0) & (F.col("_rate") != 0)
    return terms.withColumn("_log", F.log1p("_rate")).withColumn(
        "_scale", F.when(growing, F.col("amount") / F.expm1(F.col("_log") * F.col("_n")))
    )


def _owed(k: Column) -> Column:
    """Balance of a loan of :func:`_terms` in month ``k``, null once it has ended."""
    n, log = F.col("_n"), F.col("_log")
    return F.when(
        k < n,
        F.when(F.col("_rate") == 0, F.col("amount") * (1 - k / n))
        .otherwise(F.col("_scale") * F.exp(log * k) * F.expm1(log * (n - k))),
    )


def _interest_on(balance: Column) -> Column:
    return F.when(balance > C.REPAID_BELOW, balance * F.col("_rate")).otherwise(F.lit(0.0))


def debt_schedule(loans: DataFrame, months: int = C.DEBT_MONTHS) -> DataFrame:
    """Monthly interest of each loan; loans have amount, rate (yearly %) and term_years.

    One row per loan and month 0, 1, …; all zero without a positive amount and term.
    """
    return (
        _terms(loans).withColumn("month", F.explode(F.sequence(F.lit(0), F.lit(months - 1))))
        .withColumn("_balance", _owed(F.col("month")))
        .withColumn("interest", _interest_on(F.col("_balance")))
        .drop("_rate", "_n", "_log", "_scale", "_balance")
    )


def interest_vectors(loans: DataFrame, months: int = C.DEBT_MONTHS, key: str = "scenario_id") -> DataFrame:
    """Interest of all loans of a scenario as an array ``interest`` over the months from 0 on.

    Each loan is one vector, and vectors are added up before they travel: one per scenario and task. Loans are dealt by all their columns
    first, while they are small, so neither a table of one file nor a scenario with a third of all loans is one task.
    """
    dealt = _terms(loans.repartition(*loans.columns))
    # The months of a loan's term are evaluated, the others are zero.
    owing = F.least("_n", F.lit(months))
    of_term = F.when(owing > 0, F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), owing - 1)), lambda k: _interest_on(_owed(k))))
    of_month = F.concat(F.coalesce(of_term, F.array().cast("array<double>")), F.array_repeat(F.lit(0.0), F.lit(months) - owing))
    sums = dealt.select(key, array_to_vector(of_month).alias("_vector")).groupBy(key).agg(Summarizer.sum(F.col("_vector")).alias("_sum"))
    return sums.select(key, vector_to_array("_sum").alias("interest"))


def debt_interest_total(loans: DataFrame, months: int = C.DEBT_MONTHS, key: str = "scenario_id") -> DataFrame:
    """Interest of all loans of a scenario per month."""
    return interest_vectors(loans, months, key).select(key, F.posexplode("interest").alias("month", "interest"))


def debt_total(allocated: DataFrame) -> DataFrame:
    """Allocated debt per view."""
    return allocated.groupBy("vista").agg(F.sum("balance").alias("total"))


def _new_debt(k: Column) -> tuple[Column, Column, Column]:
    """Opening balance, interest and principal of the new debt in month ``k``."""
    amount, rate = F.col("new_debt_amount"), _monthly(F.col("new_debt_rate"))
    n = _months(F.col("horizon_years"))
    amortised = (amount > 0) & (F.col("new_debt_type") == C.AMORTISED)
    bullet = (amount > 0) & (F.col("new_debt_type") == C.BULLET)
    level = _level_balance(amount, rate, n, k)
    balance = F.when(amortised, level).otherwise(amount)
    principal = (
        F.when(amortised, level - _level_balance(amount, rate, n, k + 1))
        .when(bullet & (k == n - 1), amount)
        .otherwise(F.lit(0.0))
    )
    return balance, balance * rate, principal


def _npa(k: Column) -> Column:
    return F.col("npa_start") * F.pow(1 - _recovery(), k)


def _recovery() -> Column:
    """Monthly part of the non-performing portfolio recovered."""
    return 1 - F.pow(1 - F.col("rec_npa_rate") / 100, F.lit(1 / 12))


def _by_month(scenarios: DataFrame) -> DataFrame:
    last = _months(F.col("horizon_years")) - 1
    return scenarios.filter(last >= 0).withColumn("month", F.explode(F.sequence(F.lit(0), last)))


def new_debt_schedule(scenarios: DataFrame) -> DataFrame:
    """Opening balance, interest and principal of the new debt per scenario and month."""
    balance, interest, principal = _new_debt(F.col("month"))
    return _by_month(scenarios).select(
        "scenario_id", "month",
        balance.alias("balance"), interest.alias("interest"), principal.alias("principal"),
    )


def npa_runoff(scenarios: DataFrame) -> DataFrame:
    """Opening non-performing balance and its recovery per scenario and month."""
    balance = _npa(F.col("month"))
    return _by_month(scenarios).select(
        "scenario_id", "month", balance.alias("npa"), (balance * _recovery()).alias("recovery")
    )


def check_scenarios(scenarios: DataFrame) -> DataFrame:
    """Scenarios, failing on a recovery above 100 %, which has no real monthly rate."""
    return scenarios.withColumn(
        "rec_npa_rate",
        F.when(
            F.col("rec_npa_rate") > 100,
            F.raise_error(F.concat(F.lit("rec_npa_rate above 100 in scenario "), F.col("scenario_id").cast("string"))),
        ).otherwise(F.col("rec_npa_rate")),
    )


def project_pnl(scenarios: DataFrame, loans: DataFrame | None = None, interest_months: int = C.DEBT_MONTHS) -> DataFrame:
    """Monthly profit and loss of every scenario; see ``schemas.SCENARIO``.

    Existing debt bears interest for ``interest_months``, and none in later months of a longer horizon. ``loans`` hold the existing debt: scenario_id, amount, rate, term_years. A month's balances
    depend on the month before through the tax floor, so they are folded over the months inside the
    scenario's own row; the result columns follow per month. But for the join with the existing
    interest nothing is shuffled.
    """
    base = check_scenarios(scenarios).filter(F.col("horizon_years") * 12 >= 1)
    if loans is None:
        base = base.withColumn("_interest", F.array().cast("array<double>"))
    else:
        # The arrays are far larger than the loans they come from, which misleads size estimates:
        # they are never broadcast.
        base = base.join(interest_vectors(loans, interest_months).withColumnRenamed("interest", "_interest").hint("merge"), "scenario_id", "left")
    amount = F.col("new_debt_amount")
    rate = _monthly(F.col("new_debt_rate"))
    n = _months(F.col("horizon_years"))
    kind = F.when(amount > 0, F.col("new_debt_type"))
    scalars = base.select(
        *scenarios.columns,
        "_interest",
        n.alias("_n"),
        rate.alias("_rate"),
        _recovery().alias("_recovery"),
        F.when(kind == C.AMORTISED, _level_payment(amount, rate, n)).alias("_payment"),
        F.coalesce(kind == C.BULLET, F.lit(False)).alias("_bullet"),
        # Earnings before tax are linear in the opening performing balance x: slope * x + fixed.
        (
            _monthly(F.col("rev_rate")) * (1 - F.col("opex_pct") / 100)
            - _monthly(F.col("cof_rate")) - _monthly(F.col("prov_rate"))
        ).alias("_slope"),
        ((F.col("fx_impact") + F.col("non_op") - F.col("cogs") - F.col("dep_amort")) / 12).alias("_fixed"),
        _monthly(F.col("prov_rate")).alias("_provision"),
        (F.col("tax_rate") / 100).alias("_tax"),
        (F.col("dep_amort") / 12).alias("_dep"),
    )
    c = F.col

    def month(state: Column, k: Column) -> Column:
        """Opening balances of a month and what it pays, appended to the state."""
        x, npa, debt = state["x"], state["npa"], state["debt"]
        owed = debt * c("_rate")
        paid = owed + F.coalesce(F.get("_interest", k), F.lit(0.0))
        recovered = npa * c("_recovery")
        principal = (
            F.when(c("_payment").isNotNull(), c("_payment") - owed)
            .when(c("_bullet") & (k == c("_n") - 1), debt)
            .otherwise(F.lit(0.0))
        )
        ebt = x * c("_slope") + c("_fixed") - npa * c("_provision") - paid
        # A negative result pays no tax.
        net = F.least(ebt, ebt * (1 - c("_tax")))
        closing = x + net + c("_dep") + recovered - principal
        row = F.struct(
            k.alias("month"), x.alias("x"), npa.alias("npa"), paid.alias("paid"), closing.alias("closing")
        )
        return F.struct(
            closing.alias("x"), (npa - recovered).alias("npa"), (debt - principal).alias("debt"),
            F.concat(state["rows"], F.array(row)).alias("rows"),
        )

    empty = F.array().cast("array<struct<month:int,x:double,npa:double,paid:double,closing:double>>")
    start = F.struct(
        c("perf_start").alias("x"), c("npa_start").alias("npa"), amount.alias("debt"), empty.alias("rows")
    )
    run = F.aggregate(F.sequence(F.lit(0), c("_n") - 1), start, month, lambda state: state["rows"])
    drivers = [d for d in scenarios.columns if d not in ("perf_start", "npa_start")]
    return _statement(scalars.select(*drivers, "_recovery", F.inline(run)))


def _statement(months: DataFrame) -> DataFrame:
    """Result columns from scenario drivers and, per month, the opening balances ``x`` and ``npa``,
    the ``closing`` performing balance and the interest ``paid``."""
    c = F.col
    lines = months.withColumns({
        "revenues": c("x") * _monthly(c("rev_rate")),
        "_cof": c("x") * _monthly(c("cof_rate")),
        "_provisions": (c("x") + c("npa")) * _monthly(c("prov_rate")),
        "_cogs": c("cogs") / 12,
        "_dep": c("dep_amort") / 12,
        "exchange_rates": c("fx_impact") / 12,
        "non_operating": c("non_op") / 12,
    }).withColumns({
        "gross_income": c("revenues") - c("_provisions") - c("_cof") - c("_cogs"),
        "_opex": c("revenues") * (c("opex_pct") / 100),
    }).withColumn("ebitda", c("gross_income") - c("_opex")).withColumn(
        "ebt", c("ebitda") - c("_dep") + c("exchange_rates") + c("non_operating") - c("paid")
    ).withColumn(
        "_taxes", F.greatest(F.lit(0.0), c("ebt") * (c("tax_rate") / 100))
    )
    return lines.select(
        "scenario_id",
        "month",
        F.last_day(F.add_months("start_date", c("month"))).alias("month_end"),
        c("closing").alias("fiu_performing"),
        (c("npa") * (1 - c("_recovery"))).alias("fiu_npa"),
        "revenues",
        (-c("_provisions")).alias("provisions"),
        (-c("_cof")).alias("cof"),
        (-c("_cogs")).alias("cogs"),
        "gross_income",
        (-c("_opex")).alias("opex"),
        "ebitda",
        (-c("_dep")).alias("dep_amort"),
        "exchange_rates",
        "non_operating",
        (-c("paid")).alias("financial_expenses"),
        "ebt",
        (-c("_taxes")).alias("taxes"),
        (c("ebt") - c("_taxes")).alias("earnings"),
    )


def annualize(monthly: DataFrame) -> DataFrame:
    """Calendar years: flows added up, balances of the last month."""
    return monthly.groupBy("scenario_id", F.year("month_end").alias("year")).agg(
        *[F.max_by(c, "month").alias(c) for c in BALANCES],
        *[F.sum(c).alias(c) for c in FLOWS],
    )


def _lines() -> list[tuple[str, Column]]:
    s = F.col
    # Lines of the vertical statement, in order.
    return [
        ("FIU Performing", s("fiu_performing")),
        ("FIU NPA", s("fiu_npa")),
        ("Total FIU", s("fiu_performing") + s("fiu_npa")),
        ("Revenues", s("revenues")),
        ("Provisions & Writes off", s("provisions")),
        ("COF", s("cof")),
        ("COGS", s("cogs")),
        ("Gross Income", s("gross_income")),
        ("OPEX", s("opex")),
        ("Op. Income / EBITDA", s("ebitda")),
        ("Depreciation & Amortization", s("dep_amort")),
        ("Exchange rates", s("exchange_rates")),
        ("Non operating rev/expenses", s("non_operating")),
        ("Financial Expenses", s("financial_expenses")),
        ("Earnings before tax (EBT)", s("ebt")),
        ("Taxes", s("taxes")),
        ("Earnings (Net Income)", s("earnings")),
        ("Gross Margin %", X.percent_of("gross_income", "revenues")),
        ("Operating Margin %", X.percent_of("ebitda", "revenues")),
        ("Net Margin %", X.percent_of("earnings", "revenues")),
    ]


def pnl_statement(projection: DataFrame) -> DataFrame:
    """Vertical statement of a monthly or annual projection: one row per scenario, line and period."""
    period = (
        F.col("year").cast("string") if "year" in projection.columns
        else F.date_format("month_end", "MMM-yy")
    )
    order = F.col("year") if "year" in projection.columns else F.col("month")
    entries = [
        F.struct(F.lit(i).alias("line_no"), F.lit(name).alias("line"), value.alias("value"))
        for i, (name, value) in enumerate(_lines(), 1)
    ]
    return projection.select(
        "scenario_id", period.alias("period"), order.cast("int").alias("period_no"), F.inline(F.array(*entries))
    )


def pnl_display(statement: DataFrame, periods: Sequence[str]) -> DataFrame:
    """The statement with one column per named period."""
    return (
        statement.groupBy("scenario_id", "line_no", "line")
        .pivot("period", list(periods))
        .agg(F.first("value"))
        .orderBy("scenario_id", "line_no")
    )


def projection_kpis(annual: DataFrame) -> DataFrame:
    """Total earnings, mean yearly EBITDA and last total portfolio per scenario."""
    return annual.groupBy("scenario_id").agg(
        F.sum("earnings").alias("total_earnings"),
        F.avg("ebitda").alias("avg_ebitda"),
        F.max_by(F.col("fiu_performing") + F.col("fiu_npa"), "year").alias("final_portfolio"),
    )


def margin_shift(projection: DataFrame) -> DataFrame:
    """Net margin of the first and of the last period per scenario."""
    order = "year" if "year" in projection.columns else "month"
    margin = X.percent_of("earnings", "revenues")
    return projection.groupBy("scenario_id").agg(
        F.min_by(margin, order).alias("first_margin"), F.max_by(margin, order).alias("last_margin")
    )
