"""The same queries as DuckDB SQL over the same tables.

They are written from the definitions, by other means than the operators where
there is a choice: gaps are filled by joining a calendar, duplicates are numbered,
and Holt-Winters is a recursive query.
"""

from __future__ import annotations

import datetime as dt

# Written out here, not taken from the code that they check.
LAGS = [1, 7, 14, 21, 28]
ROLLING_WINDOWS, ROLLING_MAX_WINDOW = [7, 14, 30], 7
WEEKDAY_FACTORS = [0.85, 0.88, 0.92, 0.95, 1.20, 1.35, 0.85]
MONTH_FACTORS = [0.90, 0.85, 0.95, 0.98, 1.00, 1.05, 1.10, 0.80, 1.00, 1.05, 1.20, 1.40]
HOLIDAY_FACTOR, BLACK_FRIDAY_FACTOR, YEARLY_GROWTH = 0.30, 2.5, 0.02
YEARLY_HOLIDAYS = [(1, 1), (1, 6), (5, 1), (8, 15), (10, 12), (11, 1), (12, 6), (12, 8), (12, 25)]
ALPHAS, BETAS, GAMMAS = [0.05, 0.1, 0.2, 0.4], [0.0, 0.01, 0.05], [0.02, 0.1, 0.3]
FIXED_SMOOTHING = [(0.1, 0.01, 0.1)]
HORIZON, LOOKBACK = 14, 30
ONE_STORE, ONE_PRODUCT = "ASIA", "PROMO"
ORIGIN, FEATURES_FROM = dt.date(1995, 1, 1), dt.date(2000, 1, 1)

SERIES = "partition by store, product order by sale_date"

JOINS = """
    from lineitem
    join supplier on l_suppkey = s_suppkey
    join nation on s_nationkey = n_nationkey
    join region on n_regionkey = r_regionkey
    join part on l_partkey = p_partkey
"""


def is_holiday(day: str) -> str:
    dates = ", ".join(str(pair) for pair in YEARLY_HOLIDAYS)
    return f"cast((month({day}), day({day})) in ({dates}) as int)"


def is_black_friday(day: str) -> str:
    return f"(month({day}) = 11 and isodow({day}) = 5 and day({day}) >= 23)"


CALENDAR = f"""
    cast(isodow(sale_date) - 1 as int) as dow,
    cast(month(sale_date) as int) as month,
    cast(weekofyear(sale_date) as int) as iso_week,
    cast(quarter(sale_date) as int) as quarter,
    cast(isodow(sale_date) >= 6 as int) as is_weekend,
    cast(day(sale_date) <= 5 as int) as is_month_start,
    cast(day(sale_date) >= 25 as int) as is_month_end,
    {is_holiday("sale_date")} as is_holiday,
    {is_holiday("(sale_date - 1)")} as is_day_after_holiday,
    cast({is_black_friday("sale_date")} as int) as is_black_friday
"""


def rolling_sql() -> str:
    parts = []
    for size in ROLLING_WINDOWS:
        frame = f"({SERIES} rows between {size} preceding and 1 preceding)"
        kinds = {"mean": "avg", "std": "stddev_samp"}
        if size == ROLLING_MAX_WINDOW:
            kinds["max"] = "max"
        for kind, function in kinds.items():
            parts.append(
                f"case when count(units) over {frame} = {size} "
                f"then round({function}(units) over {frame}, 6) end as rolling_{kind}_{size}"
            )
    return ",\n    ".join(parts)


LAG_SQL = ", ".join(f"lag(units, {k}) over ({SERIES}) as lag_{k}" for k in LAGS)

(ALPHA, BETA, GAMMA), = FIXED_SMOOTHING
GRID = ", ".join(f"({a}, {b}, {g})" for a in ALPHAS for b in BETAS for g in GAMMAS)

ALERTS = f"""select *, case when stock < mean * 0.3 then 'CRITICO' when stock < mean then 'BAJO'
        else 'OK' end as state, round(mean, 6) as units_mean_prev7
    from (select *, avg(units) over ({SERIES} rows between 7 preceding and 1 preceding) as mean
          from {{rows}})"""

# Named subqueries and what each one needs, in an order that satisfies the needs.
PARTS = {
    "lines": (
        [],
        f"""select cast(l_shipdate as date) as sale_date, r_name as store, l_partkey as product,
        p_type as category, l_quantity as units, p_size as stock {JOINS}""",
    ),
    "daily": (
        ["lines"],
        """select sale_date, store, category as product, category, sum(units) as units,
        cast(sum(stock) as bigint) as stock from lines group by all""",
    ),
    "raw": (
        [],
        f"""select case when l_linenumber < 6 then cast(l_shipdate as date) end as sale_date,
        case when l_linenumber = 6 then strftime(l_shipdate, '%d.%m.%Y') when l_linenumber = 7 then 'soon' end as unread,
        r_name as store, p_type as product, p_type as category,
        case when l_returnflag = 'R' then '-' || cast(l_quantity as int)
             when l_discount = 0 then 'n/a' else cast(cast(l_quantity as int) as varchar) end as units,
        case when l_tax = 0 then '' else cast(p_size as varchar) end as stock,
        l_orderkey, l_linenumber, l_partkey, l_suppkey {JOINS}""",
    ),
    "dense": (
        ["daily"],
        """select days.store, days.product, days.sale_date, coalesce(daily.units, 0.0) as units
        from (select store, product,
                unnest(generate_series(min(sale_date), max(sale_date), interval 1 day))::date as sale_date
              from daily group by store, product) days
        left join daily using (store, product, sale_date)""",
    ),
    "numbered": (
        ["dense"],
        f"""select *, row_number() over ({SERIES}) as row_no,
        cast(floor(count(*) over (partition by store, product) * (1 - 0.2::double)) as bigint) as n_train
        from dense""",
    ),
    "split": (
        ["numbered"],
        """select store, product, sale_date, units,
        case when row_no <= n_train then 'train' else 'test' end as part from numbered""",
    ),
    "scaled": (
        ["split"],
        """select *, (units - scale_min) / nullif(scale_max - scale_min, 0) as scaled from (
            select *, min(units) filter (where part = 'train') over (partition by store, product) as scale_min,
                max(units) filter (where part = 'train') over (partition by store, product) as scale_max
            from split)""",
    ),
    "sequences": (
        ["scaled"],
        f"""select * from (select *, list(scaled) over ({SERIES}
            rows between {LOOKBACK} preceding and 1 preceding) as lookback from scaled)
        where len(lookback) = {LOOKBACK}""",
    ),
    "featured": (
        ["dense"],
        f"""select * from (select store, product, sale_date, units, {CALENDAR},
            cast(sale_date - min(sale_date) over (partition by store, product) as int) as days_since_start,
            {LAG_SQL}, {rolling_sql()} from dense)
        where lag_{max(LAGS)} is not null and rolling_std_{max(ROLLING_WINDOWS)} is not null""",
    ),
    "alerts": (["daily"], ALERTS.format(rows="daily")),
    "part_daily": (
        ["lines"],
        """select sale_date, store, product, category, sum(units) as units,
        cast(sum(stock) as bigint) as stock from lines group by all""",
    ),
    "report": (
        ["alerts"],
        """select sale_date, store, product, stock, units_mean_prev7, state
        from alerts where state in ('CRITICO', 'BAJO')""",
    ),
    "ma": (
        ["numbered"],
        """select store, product, 'moving_average_7d' as model, 'multi_step' as mode, sale_date,
            units as actual, level as predicted
        from numbered join (select store, product, avg(units) as level from numbered
            where row_no <= n_train and row_no > n_train - 7 group by all) using (store, product)
        where row_no > n_train""",
    ),
    "sets": ([], f"select * from (values {GRID}) as sets(alpha, beta, gamma)"),
    "fixed": ([], f"select * from (values ({ALPHA}, {BETA}, {GAMMA})) as fixed(alpha, beta, gamma)"),
    "start": (
        ["numbered"],
        """select store, product, any_value(n_train) as n_train,
            avg(units) filter (where row_no <= 7) as level,
            (avg(units) filter (where row_no between 8 and 14) - avg(units) filter (where row_no <= 7)) / 7
                as trend,
            list(units order by row_no) filter (where row_no <= 7) as ys
        from numbered group by store, product""",
    ),
}


def smoothing(sets: str, name: str) -> str:
    """Recursive Holt-Winters states for every series and every row of ``sets``."""
    return f"""{name}_steps as (
        select store, product, n_train, cast(alpha as double) as alpha, cast(beta as double) as beta,
            cast(gamma as double) as gamma, cast(0 as bigint) as row_no, level, trend,
            list_transform(ys, lambda y: y - level) as season, cast(0 as double) as sse
        from start, {sets} where n_train >= 14
        union all
        select s.store, s.product, s.n_train, alpha, beta, gamma, n.row_no,
            alpha * (units - season[1]) + (1 - alpha) * (level + trend),
            beta * (alpha * (units - season[1]) + (1 - alpha) * (level + trend) - level) + (1 - beta) * trend,
            list_append(season[2:7], gamma * (units - (level + trend)) + (1 - gamma) * season[1]),
            sse + pow(units - (level + trend) - season[1], 2)
        from {name}_steps s join numbered n
            on n.store = s.store and n.product = s.product and n.row_no = s.row_no + 1
        where n.row_no <= s.n_train
    ), {name} as (
        select * from (select *, row_number() over (partition by store, product
            order by sse, alpha, beta, gamma) as choice from {name}_steps where row_no = n_train)
        where choice = 1
    ), {name}_forecast as (
        select store, product, 'holt_winters' as model, 'multi_step' as mode, sale_date, units as actual,
            greatest(level + (n.row_no - n.n_train) * trend + season[(n.row_no - n.n_train - 1) % 7 + 1], 0)
                as predicted
        from numbered n join {name} using (store, product) where n.row_no > n.n_train
    )"""


def sql(body: str, *needs: str, smooth: str | None = None) -> str:
    """``body`` with the named subqueries it needs; ``smooth`` adds a Holt-Winters recursion."""
    wanted: set[str] = set()

    def want(name: str) -> None:
        wanted.add(name)
        for other in PARTS[name][0]:
            want(other)

    for name in [*needs, *(["start", smooth] if smooth else [])]:
        want(name)
    parts = [f"{name} as ({text})" for name, (_, text) in PARTS.items() if name in wanted]
    if smooth:
        parts.append(smoothing(smooth, "hw"))
    return f"with recursive {', '.join(parts)} {body}"


SHOWN_FIT = """select store, product, cast(n_train as int) as n_train, train_end, alpha, beta, gamma,
    round(level, 6) as level, round(trend, 6) as trend, round(sse, 4) as sse,
    round(n_train * ln(sse / n_train) + 24, 6) as aic, """ + ", ".join(
    f"round(season[{i}], 6) as season_{i}" for i in range(1, 8)
) + """ from hw join (select store, product, max(sale_date) as train_end from numbered
    where row_no <= n_train group by all) using (store, product)"""

BOTH = "(select * from ma union all select * from hw_forecast)"

ERRORS = """select store, product, model, mode,
    round(avg(case when abs(actual) > 1e-8 then abs((actual - predicted) / actual) end) * 100, 2) as mape,
    round(avg(abs(actual - predicted)), 2) as mae,
    round(sqrt(avg(pow(actual - predicted, 2))), 2) as rmse, count(*) as days
    from {forecasts} group by all"""

ALL_ERRORS = ERRORS.format(forecasts=BOTH)

HORIZON_ERRORS = ERRORS.format(
    forecasts=f"""(select * from {BOTH} join (select store, product, max(sale_date) as train_end
        from numbered where row_no <= n_train group by all) using (store, product)
        where sale_date <= train_end + {HORIZON})"""
)

COMPARED = """select *, cast(row_number() over (partition by store, product
        order by mape nulls last, model) as int) as rank, """ + ", ".join(
    f"{m} = min({m}) over (partition by store, product) as {m}_is_best, "
    f"{m} = max({m}) over (partition by store, product) as {m}_is_worst"
    for m in ("mape", "mae", "rmse")
) + " from ({errors})"
COMPARED_FOUR = COMPARED
COMPARED = COMPARED.format(errors=ALL_ERRORS)

DAILY_STORE = f"""select sale_date, store, sum(units) as units_total,
    count(distinct product) as distinct_products, round(avg(units), 6) as units_mean,
    cast(sum(stock) as bigint) as stock_total, max({is_holiday("sale_date")}) as is_holiday"""

WEEKLY = """cast(weekofyear(sale_date) as int) as week, category, sum(units) as units_week,
    round(avg(units), 6) as units_mean, round(stddev_samp(units), 6) as units_std,
    count(*) as row_count from daily group by 1, 2, 3"""

TOP = """select * from (select store, product, category, sum(units) as total_units,
    cast(rank() over (partition by store order by sum(units) desc) as int) as rank
    from {rows} group by store, product, category) where rank <= 5"""

SEASONAL = f"""(1.0 + {YEARLY_GROWTH}::double * ((sale_date - date '{ORIGIN}') / 365.0::double))
    * ({WEEKDAY_FACTORS}::double[])[isodow(sale_date)]
    * ({MONTH_FACTORS}::double[])[month(sale_date)]
    * case when {is_holiday("sale_date")} = 1 then {HOLIDAY_FACTOR} else 1 end
    * case when {is_black_friday("sale_date")} then {BLACK_FRIDAY_FACTOR} else 1 end"""

RECURSIVE = f"""select store, product, train_end + cast(step as int) as sale_date,
        round(greatest(vals[len(vals)] * (scale_max - scale_min) + scale_min, 0), 6) as predicted
    from ahead where step > 0"""

AHEAD = f"""ahead as (
        select store, product, scale_min, scale_max, max(sale_date) as train_end, cast(0 as bigint) as step,
            list(scaled order by sale_date)[-{LOOKBACK}:] as vals
        from scaled where part = 'train' group by store, product, scale_min, scale_max
            having count(*) >= {LOOKBACK}
        union all
        select store, product, scale_min, scale_max, train_end, step + 1,
            list_append(vals[2:], list_sum(list_transform(vals, lambda x, i: x * i / 465.0::double)))
        from ahead where step < {HORIZON}
    )"""

FITTED_ON = f"""(select *, case when row_number() over ({SERIES}) <= count(*) over (partition by store, product)
        - greatest(1, floor(count(*) over (partition by store, product) * 0.15::double))
        then 'fit' else 'validation' end as role from sequences where part = 'train')"""
DOT = "list_sum(list_transform(lookback, lambda x, i: x * i / 465.0::double))"

# A ring of three units over each window, from rest; the read-out's weights are given.
UNITS = f"""units_steps as (
        select store, product, sale_date, units, scale_min, scale_max, lookback, cast(0 as bigint) as step,
            0::double as a, 0::double as b, 0::double as c from sequences where part = 'test'
        union all
        select store, product, sale_date, units, scale_min, scale_max, lookback, step + 1,
            tanh(0.5 * c + 0.6 * lookback[step + 1] + 0.1), tanh(0.5 * a - 0.4 * lookback[step + 1]),
            tanh(0.5 * b + 0.8 * lookback[step + 1] - 0.2)
        from units_steps where step < {LOOKBACK}
    )"""
READ_OUT = f"""select store, product, 'reservoir' as model, 'one_step' as mode, sale_date, units as actual,
        round(greatest((0.02 + 0.8 * {DOT} + 0.1 * a - 0.2 * b + 0.05 * c) * (scale_max - scale_min) + scale_min, 0), 6) as predicted
    from units_steps where step = {LOOKBACK}"""

LINEAR_GIVEN = f"""select store, product, 'lookback_rounds' as model, 'one_step' as mode, sale_date, units as actual,
        round(greatest({DOT} * (scale_max - scale_min) + scale_min, 0), 6) as predicted
    from sequences where part = 'test'"""

STANDARDISED = ["dow", "month", "iso_week", "quarter", "is_weekend", "is_month_start", "is_month_end", "is_holiday",
    "is_day_after_holiday", "is_black_friday", "days_since_start", *[f"lag_{k}" for k in LAGS],
    *[f"rolling_{kind}_{size}" for size in ROLLING_WINDOWS for kind in ("mean", "std")], f"rolling_max_{ROLLING_MAX_WINDOW}"]


def exchanged_sql() -> str:
    """Mean errors of a linear model, plain and with each feature's values moved on within the day."""
    names = [*STANDARDISED[:11 + len(LAGS)], *[f"rolling_{kind}_{size}" for size in ROLLING_WINDOWS
        for kind in (("mean", "std", "max") if size == ROLLING_MAX_WINDOW else ("mean", "std"))]]
    weights = {name: ((7 * k) % 5 - 2) / 10 for k, name in enumerate(names)}
    predicted = " + ".join(f"{w}::double * {n}" for n, w in weights.items())
    window = "over (partition by sale_date order by md5(store || '|' || product || '|{n}'))"
    others = ", ".join(f"coalesce(lead({n}) {window.format(n=n)}, first_value({n}) {window.format(n=n)}) as other_{n}" for n in names)
    errors = ", ".join(f"avg(abs(miss - {w}::double * (other_{n} - {n}))) as {n}" for n, w in weights.items())
    return f"""select feature, round(mae, 6) as mae, round(found, 6) as mae_exchanged, round(round(found, 6) - round(mae, 6), 6) as importance
    from (unpivot (select avg(abs(miss)) as mae, {errors}
        from (select *, units - (1 + {predicted}) as miss, {others} from (select *, row_number() over ({SERIES}) as row_no,
                floor(count(*) over (partition by store, product) * (1 - 0.2::double)) as n_train from featured)
            where row_no > n_train)) on {", ".join(names)} into name feature value found)"""


SCALED_FEATURES = ", ".join(
    f"round(({n} - avg({n}) filter (where part = 'train') over ())"
    f" / stddev_pop({n}) filter (where part = 'train') over (), 4) as {n}"
    for n in STANDARDISED
)

ORACLE: dict[str, str] = {
    "load_sales": sql(
        f"""select sale_date, store, product, category, units, cast(stock as int) as stock,
        {is_holiday("sale_date")} as is_holiday, cast(isodow(sale_date) - 1 as int) as dow,
        cast(month(sale_date) as int) as month, cast(weekofyear(sale_date) as int) as iso_week,
        cast(quarter(sale_date) as int) as quarter from daily""",
        "daily",
    ),
    "clean_sales": sql(
        """select sale_date, store, product, category,
        greatest(coalesce(try_cast(units as double), 0), 0) as units,
        greatest(coalesce(try_cast(stock as double), 0), 0) as stock
        from (select *, row_number() over (partition by sale_date, unread, store, product order by l_orderkey,
            l_linenumber, l_partkey, l_suppkey, category, units, stock) as copy from raw) where copy = 1""",
        "raw",
    ),
    "duplicate_count": sql(
        """select rows_before, rows_after, rows_before - rows_after as duplicates from (
        select count(*) as rows_before, count(distinct (sale_date, unread, store, product)) as rows_after from raw)""",
        "raw",
    ),
    "feed_counts": sql(
        """select case when sale_date is null then 'reject' else 'fact' end as verdict, reason, count(*) as rows
        from (select sale_date, unnest([null, case when sale_date is null then 'date unreadable' end,
            case when sale_date is not null then case when try_cast(units as double) is null then 'units no number'
                when try_cast(units as double) < 0 then 'units below zero' end end,
            case when sale_date is not null then case when try_cast(stock as double) is null then 'stock no number'
                when try_cast(stock as double) < 0 then 'stock below zero' end end]) as reason,
            unnest([1, 2, 3, 4]) as slot from raw)
        where slot = 1 or reason is not null group by all""",
        "raw",
    ),
    "feed_rejects": sql(
        """select unread as sale_date, store, product, 'date unreadable' as reason, l_orderkey, l_linenumber, l_partkey, l_suppkey
        from raw where sale_date is null""",
        "raw",
    ),
    "product_codes": "select printf('PROD_%03d', p_partkey) as product, p_partkey as number from part",
    "category_lookup": sql(
        f"""select sale_date, store, product, units, coalesce(p_type, 'Otros') as category
        from lines left join part on product = p_partkey""",
        "lines",
    ),
    "dense_series": sql("select store, product, sale_date, units from dense", "dense"),
    "series_one": sql(
        f"""select store, product, sale_date, units from dense
        where store = '{ONE_STORE}' and product = '{ONE_PRODUCT}'""",
        "dense",
    ),
    "daily_store_aggregates": sql(f"{DAILY_STORE} from daily group by sale_date, store", "daily"),
    "daily_store_aggregates_lines": sql(
        f"{DAILY_STORE} from (select * replace (category as product) from lines) group by sale_date, store",
        "lines",
    ),
    "weekly_category_stats": sql(f"select cast(year(sale_date) as int) as year, {WEEKLY}", "daily"),
    "weekly_category_stats_iso": sql(f"select cast(isoyear(sale_date) as int) as year, {WEEKLY}", "daily"),
    "top_products_by_store": sql(TOP.format(rows="lines"), "lines"),
    "rolling_mean_range": sql(
        f"""select *, round(avg(units) over ({SERIES}
        range between interval 7 days preceding and current row), 6) as rolling_mean_7d from daily""",
        "daily",
    ),
    "rolling_mean_range_lines": sql(
        f"""select sale_date, store, product, units, round(avg(units) over ({SERIES}
        range between interval 7 days preceding and current row), 6) as rolling_mean_7d
        from (select * replace (category as product) from lines)""",
        "lines",
    ),
    "stock_alerts": sql("select * exclude (mean) from alerts", "alerts"),
    "stock_alerts_parts": sql(
        f"select * exclude (mean) from ({ALERTS.format(rows='part_daily')})", "part_daily"
    ),
    "stock_alerts_report": sql("select * from report", "report"),
    "latest_alerts": sql(
        "select * from report order by sale_date desc, store, product limit 100", "report"
    ),
    "alert_counts": sql("select state, count(*) as rows from alerts group by state", "alerts"),
    "incremental_alerts": sql("select * from report", "report"),
    "incremental_counts": sql(
        """select count(*) as lines, cast(0 as bigint) as rejected, cast(0 as bigint) as copies,
        count(*) filter (where sale_date < date '2000-01-01') as seen_before,
        count(*) filter (where sale_date >= date '2000-01-01') as added,
        count(distinct strftime(sale_date, '%Y-%m')) filter (where sale_date >= date '2000-01-01') as months
        from daily where sale_date >= date '1999-07-01'""",
        "daily",
    ),
    "output_row_counts": sql(
        f"""select 'daily_store_aggregates' as output, count(distinct (sale_date, store)) as rows from daily
        union all select 'weekly_category_stats',
            count(distinct (year(sale_date), weekofyear(sale_date), category)) from daily
        union all select 'top_products_by_store', count(*) from ({TOP.format(rows="daily")})
        union all select 'stock_alerts', count(*) from report""",
        "daily",
        "report",
    ),
    "store_kpis": sql(
        """select store, sum(units) as units_total, round(any_value(per_day), 6) as units_per_day,
        count(distinct product) as distinct_products, round(avg(stock), 6) as stock_mean
        from daily join (select store, avg(total) as per_day from (
            select store, sale_date, sum(units) as total from daily group by all) group by all)
        using (store) group by store""",
        "daily",
    ),
    "daily_total_ma7": sql(
        """select *, case when count(*) over w = 7 then round(avg(units) over w, 6) end as moving_average_7
        from (select store, sale_date, sum(units) as units from daily group by all)
        window w as (partition by store order by sale_date rows between 6 preceding and current row)""",
        "daily",
    ),
    "category_sales": sql("select store, category, sum(units) as units from daily group by all", "daily"),
    "dow_seasonality": sql(
        """select store, cast(isodow(sale_date) - 1 as int) as dow, round(avg(units), 6) as units_mean,
        ['Lun', 'Mar', 'Mié', 'Jue', 'Vie', 'Sáb', 'Dom'][any_value(isodow(sale_date))] as day_name
        from daily group by 1, 2""",
        "daily",
    ),
    "dataset_profile": sql(
        """select count(*) as rows, count(distinct store) as stores, count(distinct product) as products,
        min(sale_date) as first_day, max(sale_date) as last_day, round(avg(units), 6) as units_mean
        from daily""",
        "daily",
    ),
    "distinct_stores": sql("select distinct store from daily", "daily"),
    "distinct_products": sql("select distinct product from lines", "lines"),
    "calendar_features": sql(f"select sale_date, store, product, {CALENDAR} from daily", "daily"),
    "lag_features": sql(f"select *, {LAG_SQL} from dense", "dense"),
    "rolling_features": sql(f"select *, {rolling_sql()} from dense", "dense"),
    "feature_matrix": sql("select * from featured", "featured"),
    "feature_matrix_from": sql(
        f"select * from featured where sale_date >= date '{FEATURES_FROM}'", "featured"
    ),
    "temporal_split": sql("select * from split", "split"),
    "minmax_scale": sql("select * replace (round(scaled, 6) as scaled) from scaled", "scaled"),
    "lookback_sequences": sql(
        """select store, product, sale_date, part, round(lookback[1], 6) as oldest,
        round(lookback[-1], 6) as newest, round(list_avg(lookback), 6) as mean,
        round(list_sum(list_transform(lookback, lambda x, i: x * i)), 6) as weighted,
        round(scaled, 6) as target from sequences""",
        "sequences",
    ),
    "validation_split": sql(
        f"""select store, product, sale_date, round(scaled, 6) as target,
        case when row_number() over ({SERIES}) <= count(*) over (partition by store, product)
            - greatest(1, floor(count(*) over (partition by store, product) * 0.15::double))
            then 'fit' else 'validation' end as role
        from sequences where part = 'train'""",
        "sequences",
    ),
    "deseasonalised_sales": sql(
        f"""select sale_date, store, product, units, round(index, 6) as seasonal_index,
        round(units / index, 6) as units_deseasonalised
        from (select *, {SEASONAL} as index from daily)""",
        "daily",
    ),
    "ma_forecast": sql("select * replace (round(predicted, 6) as predicted) from ma", "ma"),
    "ma_horizon": sql(
        f"""select store, product, 'moving_average_7d' as model, 'multi_step' as mode,
        train_end + step as sale_date, level as predicted from (
        select store, product, max(sale_date) as train_end,
            round(avg(units) filter (where row_no > n_train - 7), 6) as level,
            unnest(range(1, {HORIZON} + 1))::int as step
        from numbered where row_no <= n_train group by store, product)""",
        "numbered",
    ),
    "hw_fit_fixed": sql(SHOWN_FIT, smooth="fixed"),
    "hw_grid_best": sql(SHOWN_FIT, smooth="sets"),
    "hw_forecast": sql("select * replace (round(predicted, 6) as predicted) from hw_forecast", smooth="sets"),
    "hw_horizon": sql(
        f"""select store, product, 'holt_winters' as model, 'multi_step' as mode,
        train_end + step as sale_date, round(greatest(level + step * trend + season[(step - 1) % 7 + 1], 0), 6) as predicted
        from (select *, unnest(range(1, {HORIZON} + 1))::int as step from hw) join (
            select store, product, max(sale_date) as train_end from numbered
            where row_no <= n_train group by all) using (store, product)""",
        smooth="fixed",
    ),
    "hw_optimised_fit": sql(
        """select store, product, cast(n_train as int) as n_train, round(sse, 4) as grid_sse,
        true as no_worse, true as confirmed from hw""",
        smooth="sets",
    ),
    "hw_optimised_coverage": sql(
        """select store, product, 'holt_winters' as model, 'multi_step' as mode, count(*) as days, count(*) as usable_days,
        min(sale_date) as first_day, max(sale_date) as last_day, sum(units) as actual_units
        from numbered where row_no > n_train and n_train >= 14 group by store, product""",
        "numbered",
    ),
    "forecast_errors": sql(ALL_ERRORS, "ma", smooth="sets"),
    "horizon_errors": sql(HORIZON_ERRORS, "ma", smooth="sets"),
    "compare_models": sql(COMPARED, "ma", smooth="sets"),
    "best_model": sql(
        f"""select store, product, model, mape, coalesce(mape < 15, false) as meets_target
        from ({COMPARED}) where rank = 1""",
        "ma",
        smooth="sets",
    ),
    "run_metrics": sql(
        " union all ".join(
            f"select store || '_' || product as run_name, model, '{m}' as metric, {m} as value from ({ALL_ERRORS})"
            for m in ("mape", "mae", "rmse")
        ),
        "ma",
        smooth="sets",
    ),
    "forecast_curves": sql(
        f"""select store, product, sale_date, part, 'actual' as curve, units as value from split
        union all select store, product, sale_date, 'test', model, round(predicted, 6) from {BOTH}""",
        "split",
        "ma",
        smooth="sets",
    ),
    "validation_loss_fixed": sql(
        f"""select role, round(avg(case when miss <= 0.1 then 0.5 * miss * miss else 0.1 * (miss - 0.05) end), 9) as loss,
        count(*) as rows from (select role, abs(scaled - {DOT}) as miss from {FITTED_ON}) group by role""",
        "sequences",
    ),
    "lookback_forecast_fixed": sql(LINEAR_GIVEN, "sequences"),
    "reservoir_forecast_fixed": sql("", "sequences").rstrip() + f", {UNITS} {READ_OUT}",
    "sequence_coverage": sql(
        """select store, product, model, 'one_step' as mode, count(*) as days, count(*) as usable_days,
        min(sale_date) as first_day, max(sale_date) as last_day, sum(units) as actual_units
        from (select *, unnest(['lookback_rounds', 'reservoir']) as model from sequences where part = 'test')
        group by store, product, model""",
        "sequences",
    ),
    "standardised_features": sql(
        f"""select sale_date, store, product, part, {SCALED_FEATURES} from (
        select *, case when row_number() over ({SERIES}) <= floor(count(*) over (partition by store, product) * (1 - 0.2::double))
            then 'train' else 'test' end as part from featured)""",
        "featured",
    ),
    "permutation_importance_fixed": sql(exchanged_sql(), "featured"),
    "rf_multi_step_coverage": sql(
        f"""select store, product, 'random_forest' as model, 'multi_step' as mode, count(*) as days, count(*) as usable_days,
        min(sale_date) as first_day, max(sale_date) as last_day, sum(units) as actual_units
        from (select *, row_number() over ({SERIES}) as row_no,
                floor(count(*) over (partition by store, product) * (1 - 0.2::double)) as n_train from featured)
        where row_no > n_train and n_train >= 30 group by store, product""",
        "featured",
    ),
    "series_levels": sql(
        f"""select store, product, sale_date, units, round((own_total + 20 * store_level) / (own_days + 20), 6) as series_level,
            round(store_level, 6) as store_level
        from (select store, product, sale_date, units, coalesce(sum(units) over before_row, 0) as own_total,
                count(*) over before_row as own_days
              from dense window before_row as ({SERIES} rows between unbounded preceding and 1 preceding))
        join (select store, sale_date, (coalesce(sum(total) over w, 0) + 20 * coalesce(level, 0))
                / (coalesce(sum(n) over w, 0) + 20) as store_level
              from (select store, sale_date, sum(units) as total, count(*) as n from dense group by all)
              join (select sale_date, sum(total) over v / sum(n) over v as level
                    from (select sale_date, sum(units) as total, count(*) as n from dense group by all)
                    window v as (order by sale_date rows between unbounded preceding and 1 preceding)) using (sale_date)
              window w as (partition by store order by sale_date rows between unbounded preceding and 1 preceding))
        using (store, sale_date)""",
        "dense",
    ),
    "compare_four_models": sql("", "ma", "sequences", smooth="sets").rstrip() + f""", {UNITS}, four as (
        select * from {BOTH} union all {READ_OUT} union all {LINEAR_GIVEN}
    ), common as (
        select * exclude (here, models) from (select *, max(here) over (partition by store, product) as models
            from (select *, count(*) over (partition by store, product, sale_date) as here from four)) where here = models
    ) """ + COMPARED_FOUR.format(errors=ERRORS.format(forecasts="common")),
    "forecast_coverage": sql(
        """select store, product, model, 'one_step' as mode, count(*) as days, count(*) as usable_days,
        min(sale_date) as first_day, max(sale_date) as last_day, sum(units) as actual_units
        from (
            select store, product, sale_date, units, unnest(['random_forest', 'gradient_boosting']) as model
            from (select *, row_number() over (partition by store, product order by sale_date) as row_no,
                    floor(count(*) over (partition by store, product) * (1 - 0.2::double)) as n_train
                  from featured) where row_no > n_train
            union all select store, product, sale_date, units, 'lookback' from sequences where part = 'test'
        ) group by store, product, model""",
        "featured",
        "sequences",
    ),
    "recursive_forecast_fixed": sql("", "scaled").rstrip() + f", {AHEAD} {RECURSIVE}",
}

# The queries whose results hold no date, and the names that date columns have elsewhere.
UNDATED = {
    "duplicate_count", "product_codes", "weekly_category_stats", "weekly_category_stats_iso",
    "top_products_by_store", "alert_counts", "output_row_counts", "store_kpis", "category_sales",
    "dow_seasonality", "distinct_stores", "distinct_products", "forecast_errors", "horizon_errors",
    "compare_models", "best_model", "run_metrics", "hw_optimised_fit",
    "validation_loss_fixed", "compare_four_models", "feed_counts", "incremental_counts",
    "permutation_importance_fixed",
}
DATES = ("sale_date", "first_day", "last_day", "train_end")


def sql_with_text_dates(name: str) -> str:
    """The SQL of a query with its dates as ISO text."""
    if name in UNDATED:
        return ORACLE[name]
    return (
        f"select columns(lambda c: c not in {DATES}), "
        f"cast(columns(lambda c: c in {DATES}) as varchar) from ({ORACLE[name]})"
    )
