"""Reference SQL for the registered queries, written for DuckDB over the same tables."""

from __future__ import annotations

_CTES = {
    "tx": """
select cast(o_orderkey as varchar) as transaction_id, cast(o_orderdate as date) as transaction_date,
  case o_custkey % 3 when 0 then 'Male' when 1 then 'Female' else 'Unknown' end as gender,
  cast(18 + o_custkey % 63 as int) as age,
  case o_custkey % 2 when 0 then 'Married' else 'Single' end as marital_status,
  n_name as state_names, c_mktsegment as segment,
  case o_custkey % 4 when 0 then 'Employed' when 1 then 'Self-employed' when 2 then 'Unemployed'
    else 'Unknown' end as employees_status,
  o_orderpriority as payment_method,
  case when o_orderkey % 4 = 0 then 'Yes' else 'No' end as referral,
  cast(o_totalprice as decimal(10,2)) as amount_spent, o_custkey as customer_key, o_orderkey as seq
from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey""",
    "first_text": """
select seq, transaction_id,
  case when seq % 97 = 0 then 'not-a-date' else cast(transaction_date as varchar) end as transaction_date,
  case when seq % 17 = 0 then null when seq % 101 = 0 then '17' when seq % 103 = 0 then '121'
    else cast(age as varchar) end as age,
  case when seq % 13 = 0 then null else state_names end as state_names,
  case when seq % 19 = 0 then null else segment end as segment,
  case when seq % 29 = 0 then 'abc' when seq % 31 = 0 then '-5.00' when seq % 37 = 0 then null
    else cast(amount_spent as varchar) end as amount_spent,
  gender, marital_status, employees_status, payment_method, referral
from tx""",
    "dirty": """
select * from first_text union all
select seq + 1000000000, transaction_id, transaction_date, age, state_names, segment, '1.00',
  gender, marital_status, employees_status, payment_method, referral
from first_text where seq % 10 = 0""",
    "parsed": """
select seq, transaction_id, try_cast(transaction_date as date) as transaction_date, gender,
  try_cast(age as double) as age, marital_status, state_names, segment, employees_status,
  payment_method, referral, try_cast(amount_spent as decimal(18,2)) as amount_spent
from dirty""",
    "median_age": "select trunc(median(age)) as m from parsed",
    "filled": """
select seq, transaction_id, transaction_date, gender,
  cast(trunc(coalesce(age, (select m from median_age))) as int) as age, marital_status,
  coalesce(state_names, 'Unknown') as state_names, coalesce(segment, 'Regular') as segment,
  employees_status, payment_method, referral, cast(coalesce(amount_spent, 0) as decimal(18,2)) as amount_spent
from parsed""",
    "first_copies": """
select * exclude (rn) from (
  select *, row_number() over (partition by transaction_id order by seq) as rn from filled) where rn = 1""",
    "kept": "select * from first_copies where age between 18 and 120 and amount_spent >= 0",
    "f1": """
select segment, state_names, count(transaction_id) as total_transactions,
  cast(sum(amount_spent) as decimal(28,2)) as total_amount_spent,
  cast(sum(amount_spent) as double) / count(amount_spent) as avg_transaction_amount,
  min(amount_spent) as min_transaction_amount, max(amount_spent) as max_transaction_amount,
  round(stddev_samp(cast(amount_spent as double)), 4) as std_transaction_amount,
  min(transaction_date) as first_transaction_date, max(transaction_date) as last_transaction_date,
  cast(sum(age) as double) / count(age) as avg_age,
  cast(count(*) filter (where referral = 'Yes') as double) / count(*) as referral_rate,
  cast(date_diff('day', min(transaction_date), max(transaction_date)) as int) as days_active,
  cast(date_diff('day', min(transaction_date), max(transaction_date)) as double)
    / nullif(count(transaction_id), 0) as avg_days_between_transactions,
  'v1' as feature_version
from tx group by segment, state_names""",
    "q0": """
select cast(year(transaction_date) as int) as year, cast(quarter(transaction_date) as int) as quarter,
  segment, state_names, count(transaction_id) as quarterly_transactions,
  cast(sum(amount_spent) as decimal(28,2)) as quarterly_revenue,
  cast(sum(amount_spent) as double) / count(amount_spent) as avg_quarterly_transaction,
  count(distinct transaction_id) as unique_customers
from {source} group by all""",
    "q1": """
select *, lag(quarterly_revenue) over w as prev_revenue, lag(quarterly_transactions) over w as prev_transactions
from q0 window w as (partition by segment, state_names order by year, quarter)""",
    "f2": """
select year, quarter, segment, state_names, quarterly_transactions, quarterly_revenue,
  avg_quarterly_transaction, unique_customers,
  case when prev_revenue is null then 0.0::double
    else cast(quarterly_revenue - prev_revenue as double) / nullif(cast(prev_revenue as double), 0)
    end as revenue_growth_rate,
  'v1' as feature_version
from q1""",
    "f3": """
select payment_method, segment, count(transaction_id) as total_transactions,
  cast(sum(amount_spent) as decimal(28,2)) as total_amount,
  cast(sum(amount_spent) as double) / count(amount_spent) as avg_transaction_amount,
  cast(count(transaction_id) as double) / (select count(*) from tx) as usage_percentage,
  'v1' as feature_version
from tx group by payment_method, segment""",
    "top_segment": """
select state_names, segment as top_segment, transaction_count from (
  select state_names, segment, count(transaction_id) as transaction_count,
    row_number() over (partition by state_names order by count(transaction_id) desc, segment) as rk
  from tx group by state_names, segment) where rk = 1""",
    "top_payment": """
select state_names, payment_method as top_payment_method, payment_count from (
  select state_names, payment_method, count(transaction_id) as payment_count,
    row_number() over (partition by state_names order by count(transaction_id) desc, payment_method) as rk
  from tx group by state_names, payment_method) where rk = 1""",
    "s0": """
select state_names, count(distinct transaction_id) as total_customers,
  count(transaction_id) as total_transactions, cast(sum(amount_spent) as decimal(28,2)) as total_revenue,
  cast(sum(amount_spent) as double) / count(amount_spent) as avg_transaction_size,
  cast(sum(age) as double) / count(age) as avg_customer_age,
  cast(sum(amount_spent) as double) / nullif(count(distinct transaction_id), 0) as avg_customer_value
from tx group by state_names""",
    "f4": """
select s0.*, top_segment, top_payment_method, 'v1' as feature_version
from s0 left join top_segment using (state_names) left join top_payment using (state_names)""",
    "active": """
select distinct segment, state_names, customer_key,
  cast(year(transaction_date) as int) as year, cast(quarter(transaction_date) as int) as quarter,
  cast(year(transaction_date) * 4 + quarter(transaction_date) as int) as yq
from tx""",
    "first_seen": "select segment, state_names, customer_key, min(yq) as first_yq from active group by all",
    "cohorts": """
select year, quarter, segment, state_names, count(*) as unique_customers,
  count(*) filter (where yq = first_yq) as new_customers,
  count(*) filter (where yq > first_yq) as returning_customers
from active join first_seen using (segment, state_names, customer_key) group by all""",
    "present": """
select segment, state_names, year, quarter, yq, count(*) as customers,
  lag(yq) over (partition by segment, state_names order by yq) as prev_yq,
  lag(count(*)) over (partition by segment, state_names order by yq) as prev_customers
from active group by segment, state_names, year, quarter, yq""",
    "retention": """
select p.year, p.quarter, p.segment, p.state_names, p.customers as unique_customers,
  count(b.customer_key) as retained_customers,
  cast(count(b.customer_key) as double) / p.prev_customers as customer_retention_rate
from present p
join active a on a.segment = p.segment and a.state_names = p.state_names and a.yq = p.yq
left join active b on b.segment = a.segment and b.state_names = a.state_names
  and b.customer_key = a.customer_key and b.yq = p.prev_yq
group by p.year, p.quarter, p.segment, p.state_names, p.customers, p.prev_customers""",
    "written": """
select cast(seq % 3 as int) as part, case when seq % 3 = 1 or (seq % 3 = 2 and seq % 2 = 0)
  then coalesce(strftime(try_cast(transaction_date as date), '%d/%m/%Y'), transaction_date) else transaction_date end as d
from dirty""",
    "readable": " union all ".join(
        f"select part, '{name}' as date_format, {place} as place, count(d) as given, count(try_strptime(d, '{pattern}')) as readable "
        "from written group by part"
        for place, (name, pattern) in enumerate(
            {
                "yyyy-MM-dd": "%Y-%m-%d", "dd/MM/yyyy": "%d/%m/%Y", "MM/dd/yyyy": "%m/%d/%Y", "yyyy/MM/dd": "%Y/%m/%d",
                "dd.MM.yyyy": "%d.%m.%Y", "yyyyMMdd": "%Y%m%d", "yyyy-MM-dd HH:mm:ss": "%Y-%m-%d %H:%M:%S",
            }.items()
        )
    ),
    "ml_parts": """
select f1.segment as customer_segment, f1.state_names, f1.total_transactions, f1.total_amount_spent,
  f1.avg_transaction_amount, f1.std_transaction_amount, f1.days_active, f1.avg_days_between_transactions,
  f1.avg_age, f1.referral_rate, f4.total_revenue as state_total_revenue,
  f4.avg_customer_value as state_avg_customer_value, f2.revenue_growth_rate as quarterly_growth_rate,
  r.customer_retention_rate as retention_rate, f2.year, f2.quarter
from f1 left join f4 on f1.state_names = f4.state_names
left join f2 on f1.segment = f2.segment and f1.state_names = f2.state_names
left join retention r on r.year = f2.year and r.quarter = f2.quarter
  and r.segment = f2.segment and r.state_names = f2.state_names
where f1.feature_version = 'v1'""",
    "log": """
select 'monthly_data_ingestion' as pipeline_name, 'completed' as status, (select count(*) from dirty) as records_processed,
  count(*) filter (where good) as records_inserted, cast(0 as bigint) as records_updated,
  count(*) filter (where not good) as records_failed from judged
union all
select 'quarterly_feature_refresh', 'completed', count(*) filter (where good), null, 0, null from judged""",
    "judged": """
select *, reject_reason is null as good from (
  select *, case when not age between 18 and 120 then 'age_out_of_range' when amount_spent < 0 then 'negative_amount'
    when transaction_date is null then 'bad_date' end as reject_reason from first_copies)""",
}


def _with(names: str, body: str, source: str = "tx") -> str:
    """`body` after the named common table expressions, in order."""
    parts = ", ".join(f"{n} as ({_CTES[n].replace('{source}', source)})" for n in names.split())
    return f"with {parts} {body}"


_DIRTY = "tx first_text dirty"
_CLEAN = f"{_DIRTY} parsed median_age filled first_copies"
_SETS = "tx f1 q0 q1 f2 f3 top_segment top_payment s0 f4"
_ML = f"{_SETS} active present retention ml_parts"

_TEXT = (
    "transaction_date transaction_id gender age marital_status state_names segment employees_status "
    "payment_method referral amount_spent"
).split()
_VARCHARS = {
    "transaction_id": 50,
    "gender": 10,
    "marital_status": 20,
    "state_names": 50,
    "segment": 50,
    "employees_status": 50,
    "payment_method": 50,
    "referral": 10,
}
_TYPES = {
    "transaction_date": "timestamp_ntz",
    "transaction_id": "string",
    "gender": "string",
    "age": "int",
    "marital_status": "string",
    "state_names": "string",
    "segment": "string",
    "employees_status": "string",
    "payment_method": "string",
    "referral": "string",
    "amount_spent": "decimal(18,2)",
}


def _union(parts: list[str]) -> str:
    return " union all ".join(parts)


def _nulls(columns: list[str], source: str) -> str:
    return _union(
        [
            f"select '{c}' as column_name, count(*) - count({c}) as null_rows, count(*) as total_rows from {source}"
            for c in columns
        ]
    )


def _unreadable(column: str) -> str:
    cast = {"transaction_date": "date", "age": "double", "amount_spent": "decimal(18,2)"}.get(column)
    if cast is None:
        return "cast(0 as bigint)"
    return f"(select count(*) from dirty where {column} is not null and try_cast({column} as {cast}) is null)"


def _schema() -> str:
    return _union(
        [
            f"select '{c}' as column_name, '{t}' as expected_type, true as present, {_unreadable(c)} as unreadable_rows"
            for c, t in _TYPES.items()
        ]
    )


def _json(column: str, source: str = "tx") -> str:
    return (
        f"(select '{{' || string_agg('\"' || {column} || '\":' || n, ',' order by {column}) || '}}' "
        f"from (select {column}, count(*) as n from {source} group by {column}))"
    )


def _distribution(column: str) -> str:
    return _with(
        "tx",
        f"select segment, state_names, {column} as value, count(*) as transactions from tx "
        f"group by segment, state_names, {column}",
    )


def _map(column: str, name: str) -> str:
    return (
        f"(select segment, state_names, '{{' || string_agg('\"' || {column} || '\":' || n, ',' order by {column}) "
        f"|| '}}' as {name} from (select segment, state_names, {column}, count(*) as n from tx "
        f"group by segment, state_names, {column}) group by segment, state_names)"
    )


_DISTRIBUTION_MAPS = (
    f"select * from {_map('gender', 'gender_distribution')} "
    f"join {_map('marital_status', 'marital_status_distribution')} using (segment, state_names) "
    f"join {_map('payment_method', 'payment_method_distribution')} using (segment, state_names) "
    f"join {_map('employees_status', 'employment_status_distribution')} using (segment, state_names)"
)

_COUNTS = "customer_features f1, quarterly_features f2, payment_features f3, state_features f4"
_NAMED = [pair.split() for pair in _COUNTS.split(", ")]

_REJECTS = {
    "rejected_age_out_of_range": "not age between 18 and 120",
    "rejected_negative_amount": "age between 18 and 120 and amount_spent < 0",
    "rejected_bad_date": "age between 18 and 120 and amount_spent >= 0 and transaction_date is null",
    "rejected_amount_out_of_range": "false",
    "rows_kept": "age between 18 and 120 and amount_spent >= 0 and transaction_date is not null",
}
_MISSING = (
    "gender marital_status state_names segment employees_status payment_method referral "
    "transaction_id transaction_date age"
).split()
_CLEANING_REPORT = _union(
    [
        'select \'rows_in\' as "check", count(*) as rows from parsed',
        *[f"select 'missing_{c}', count(*) - count({c}) from parsed" for c in _MISSING],
        "select 'missing_amount_value', count(*) - count(amount_spent) from parsed",
        "select 'distinct_rows', count(*) from first_copies",
        *[f"select '{name}', count(*) filter (where {test}) from first_copies" for name, test in _REJECTS.items()],
    ]
)

_INVARIANTS = {
    "ages_in_range": "(select min(age) >= 18 and max(age) <= 120 from tx)",
    "amounts_not_negative": "(select min(amount_spent) >= 0 from tx)",
    "ids_add_up_customer": "(select sum(total_transactions) from f1) = (select count(transaction_id) from tx)",
    "ids_add_up_payment": "(select sum(total_transactions) from f3) = (select count(transaction_id) from tx)",
    "ids_add_up_quarterly": "(select sum(quarterly_transactions) from f2) = (select count(transaction_id) from tx)",
    "ids_add_up_state": "(select sum(total_transactions) from f4) = (select count(transaction_id) from tx)",
    "amounts_add_up_customer": "(select sum(total_amount_spent) from f1) = (select sum(amount_spent) from tx)",
    "amounts_add_up_payment": "(select sum(total_amount) from f3) = (select sum(amount_spent) from tx)",
    "amounts_add_up_quarterly": "(select sum(quarterly_revenue) from f2) = (select sum(amount_spent) from tx)",
    "amounts_add_up_state": "(select sum(total_revenue) from f4) = (select sum(amount_spent) from tx)",
    "average_between_extremes": "(select bool_and(min_transaction_amount <= avg_transaction_amount + 1e-9 "
    "and avg_transaction_amount <= max_transaction_amount + 1e-9) from f1)",
    "days_active_not_negative": "(select min(days_active) >= 0 from f1)",
    "referral_rate_is_a_share": "(select min(referral_rate) >= 0 and max(referral_rate) <= 1 from f1)",
    "first_quarter_growth_zero": "(select max(abs(g)) = 0 from (select arg_min(revenue_growth_rate, year * 4 + quarter) "
    "as g from f2 group by segment, state_names))",
    "usage_adds_up": "(select abs(sum(usage_percentage) - 1) < 1e-6 from f3)",
}

_CLEAN_COLUMNS = (
    "seq, transaction_date, transaction_id, gender, age, marital_status, state_names, segment, "
    "employees_status, payment_method, referral, amount_spent"
)
_FRESHNESS = """
select max(transaction_date) as latest_date,
  cast(date_diff('day', max(transaction_date), date '2001-08-08') as int) as days_behind,
  count(*) filter (where transaction_date > date '2001-08-01') as recent_rows,
  count(*) filter (where transaction_date > date '2001-08-01') > 0 as fresh
from tx"""

ORACLE: dict[str, str] = {
    "src_csv_roundtrip": _with(_DIRTY, f"select {', '.join(_TEXT)} from dirty"),
    "scan_parquet": _with("tx", "select * from tx"),
    "monthly_partition_counts": _with(
        "tx",
        "select cast(year(transaction_date) as int) as year, cast(month(transaction_date) as int) as month, "
        "count(*) as row_count from tx group by all",
    ),
    "raw_transactions": _with(
        "tx",
        "select transaction_id, transaction_date, gender, age, marital_status, state_names, segment, "
        "employees_status, payment_method, referral, cast(amount_spent as decimal(18,2)) as amount_spent from tx",
    ),
    "raw_count": _with("tx", "select count(*) as row_count from tx"),
    "raw_inventory": "select cast(year(o_orderdate) as int) as year, cast(month(o_orderdate) as int) as month, "
    "cast(1 as bigint) as files, count(*) as row_count from orders group by all",
    "clean_transactions": _with(f"{_CLEAN} kept", f"select {_CLEAN_COLUMNS} from kept"),
    "age_median_fill": _with(
        f"{_DIRTY} parsed",
        "select count(*) as rows_in, count(*) - count(age) as missing_age, "
        "cast(trunc(median(age)) as int) as median_age from parsed",
    ),
    "amount_coerce": _with(
        f"{_DIRTY} parsed",
        "select seq, cast(coalesce(amount_spent, 0) as decimal(18,2)) as amount_spent from parsed",
    ),
    "dedup_keep_first": _with(
        _DIRTY,
        "select seq, transaction_id, amount_spent from (select *, row_number() over "
        "(partition by transaction_id order by seq) as rn from dirty) where rn = 1",
    ),
    "dedup_report": _with(
        _DIRTY,
        "select count(*) as rows_in, count(distinct transaction_id) as rows_out, "
        "count(*) - count(distinct transaction_id) as duplicates_removed from dirty",
    ),
    "filter_valid": _with(
        f"{_DIRTY} parsed median_age filled",
        "select seq, age, amount_spent from filled where age between 18 and 120 and amount_spent >= 0",
    ),
    "quarantine_bad_dates": _with(
        f"{_CLEAN} kept",
        "select seq, transaction_id, age, state_names, segment, amount_spent, 'bad_date' as reject_reason "
        "from kept where transaction_date is null",
    ),
    "derive_calendar": _with(
        "tx",
        "select transaction_id, cast(year(transaction_date) as int) as year, "
        "cast(month(transaction_date) as int) as month, strftime(transaction_date, '%Y-%m') as year_month, "
        "cast(quarter(transaction_date) as int) as quarter from tx",
    ),
    "cleaning_report": _with(_CLEAN, _CLEANING_REPORT),
    "customer_features": _with("tx f1", "select * from f1"),
    "quarterly_features": _with("tx q0 q1 f2", "select * from f2"),
    "payment_features": _with("tx f3", "select * from f3"),
    "state_features": _with("tx top_segment top_payment s0 f4", "select * from f4"),
    "top_segment_per_state": _with("tx top_segment", "select * from top_segment"),
    "top_payment_per_state": _with("tx top_payment", "select * from top_payment"),
    "ml_training_features": _with(
        _ML,
        "select * exclude (year, quarter) from ml_parts "
        "order by total_amount_spent desc nulls first, customer_segment, state_names",
    ),
    "ml_training_latest": _with(
        _ML,
        "select * exclude (year, quarter, rn) from (select *, row_number() over (partition by customer_segment, "
        "state_names order by year desc, quarter desc) as rn from ml_parts) where rn = 1",
    ),
    "ml_training_features_alt": _with(
        _SETS,
        "select sha256(coalesce(length(f1.segment) || ':' || f1.segment, 'N') || coalesce(length(f1.state_names) || ':' || f1.state_names, 'N')) as feature_id, f1.segment as customer_segment, "
        "f1.state_names, f1.total_transactions, f1.total_amount_spent, f1.avg_transaction_amount, f1.days_active, "
        "f1.avg_age, f1.referral_rate, f2.revenue_growth_rate as qoq_revenue_growth, "
        "f3.usage_percentage as payment_method_diversity, f4.total_revenue as state_revenue "
        "from f1 left join f2 on f1.state_names = f2.state_names left join f3 on f1.segment = f3.segment "
        "left join f4 on f1.state_names = f4.state_names",
    ),
    "revenue_by_state": _with(
        "tx", "select state_names, cast(sum(amount_spent) as decimal(28,2)) as total_revenue from tx group by state_names"
    ),
    "revenue_by_segment": _with(
        "tx",
        "select segment as customer_segment, cast(sum(amount_spent) as decimal(28,2)) as revenue from tx group by segment",
    ),
    "top_customer_groups": _with(
        "tx f1", "select * from f1 order by total_amount_spent desc, segment, state_names limit 10"
    ),
    "store_counts": _with(
        _SETS,
        _union([f"select '{name}' as table_name, count(*) as record_count from {f}" for name, f in _NAMED])
        + " order by table_name",
    ),
    "feature_snapshot": _with("tx f1", "select *, date '2001-10-01' as snapshot_date from f1"),
    "ingestion_stats": _with(
        "tx",
        "select count(*) as total_records, strftime(min(transaction_date), '%Y-%m-%d') as min_date, "
        "strftime(max(transaction_date), '%Y-%m-%d') as max_date, "
        "cast(sum(amount_spent) as decimal(28,2)) as total_revenue, "
        "cast(sum(amount_spent) as double) / count(amount_spent) as avg_transaction, "
        "count(distinct transaction_id) as unique_customers, count(distinct state_names) as states_count, "
        f"{_json('segment')} as segments, {_json('payment_method')} as payment_methods from tx",
    ),
    "segment_histogram": _with(
        "tx", "select segment, count(*) as row_count from tx group by segment order by row_count desc, segment"
    ),
    "payment_histogram": _with(
        "tx",
        "select payment_method, count(*) as row_count from tx group by payment_method "
        "order by row_count desc, payment_method",
    ),
    "approx_customers": _with(
        "tx",
        "select segment, state_names, count(distinct customer_key) as customers, true as within_bounds "
        "from tx group by segment, state_names",
    ),
    "month_intake": _with(
        f"{_CLEAN} judged",
        "select cast(date_trunc('month', transaction_date) as date) as month_start, count(*) as records, "
        "count(*) filter (where good) as records_kept, count(*) filter (where not good) as records_rejected "
        "from judged where transaction_date is not null group by date_trunc('month', transaction_date)",
    ),
    "run_all_features": _with(
        f"{_CLEAN} judged",
        "select segment, state_names, count(transaction_id) as total_transactions, "
        "cast(sum(amount_spent) as decimal(28,2)) as total_amount_spent "
        "from judged where good group by segment, state_names",
    ),
    "ml_training_nested": _with(
        f"{_SETS}",
        "select f1.segment as customer_segment, f1.state_names, total_transactions, total_amount_spent, "
        "(select total_revenue from f4 where f4.state_names = f1.state_names) as state_revenue, "
        "q.n as n_quarters, p.n as n_payments, q.n * p.n as flat_rows, round(q.g * p.n, 4) as flat_growth, round(p.u * q.n, 4) as flat_shares "
        "from f1 left join (select state_names, count(*) as n, sum(revenue_growth_rate) as g from f2 group by all) q using (state_names) "
        "left join (select segment, count(*) as n, sum(usage_percentage) as u from f3 group by all) p using (segment)",
    ),
    "sketched_customers": _with(
        "tx active",
        _union(
            [
                f"select '{grain}' as grain, {', '.join(f'{c} as {n}' for n, c in columns.items())}, "
                "count(distinct customer_key) as customers, true as within_bounds from active group by all"
                for grain, columns in (
                    ("quarter", {"segment": "segment", "state_names": "state_names", "quarter_no": "cast(yq - 1 as int)"}),
                    ("group", {"segment": "segment", "state_names": "state_names", "quarter_no": "null"}),
                    ("state", {"segment": "null", "state_names": "state_names", "quarter_no": "null"}),
                    ("all", {"segment": "null", "state_names": "null", "quarter_no": "null"}),
                )
            ]
        ),
    ),
    "sketched_cohorts": _with(
        "tx active first_seen cohorts present retention",
        "select c.*, r.retained_customers, true as within_bounds "
        "from cohorts c join retention r using (year, quarter, segment, state_names)",
    ),
    "bitmap_cohorts": _with(
        "tx active first_seen cohorts present retention",
        "select c.*, r.retained_customers from cohorts c join retention r using (year, quarter, segment, state_names)",
    ),
    "exact_medians": _with(
        "tx",
        _union(
            [
                f"select '{c}' as column_name, count({c}) as row_count, round(median(cast({c} as double)), 4) as median from {t}"
                for c, t in (("amount_spent", "tx"), ("l_extendedprice", "lineitem"), ("l_quantity", "lineitem"))
            ]
        ),
    ),
    "frequent_customers": _with(
        "tx",
        "select case when often then value end as value, cast(sum(n) as bigint) as row_count, not often as other from ("
        "select cast(customer_key as varchar) as value, count(*) as n, count(*) >= 0.001::double * (select count(*) from tx) as often "
        "from tx group by customer_key) group by case when often then value end, often",
    ),
    "date_formats": _with(
        f"{_DIRTY} written readable",
        "select part, date_format, given, readable, readable > 0 and place = first_value(place) over (partition by part "
        "order by readable desc, place) as chosen, readable > 0 and place = first_value(place) over (partition by part "
        "order by readable desc, place) and count(*) over (partition by part, readable) > 1 as tied from readable",
    ),
    "metadata_documents": _union(
        [
            "select * from ("
            + _with(
                f"{_CLEAN} judged",
                "select count(*) as total_records, cast(min(transaction_date) as varchar) as min_date, "
                "cast(max(transaction_date) as varchar) as max_date, cast(sum(amount_spent) as decimal(28,2)) as total_revenue, "
                "count(distinct state_names) as states_count from judged where good",
            ).replace("from first_text where seq % 10 = 0", f"from first_text where seq % 10 = 0 and seq % 2 = {part}").replace(
                "select * from first_text union all", f"select * from first_text where seq % 2 = {part} union all"
            )
            + ")"
            for part in (0, 1)
        ]
    ),
    "stored_views": _with(
        f"{_CLEAN} judged",
        "select segment as customer_segment, state_names, count(distinct year(transaction_date) * 4 + quarter(transaction_date)) as quarters, "
        "count(transaction_id) as total_transactions, cast(sum(amount_spent) as decimal(28,2)) as total_amount_spent "
        "from judged where good group by segment, state_names",
    ),
    "stored_snapshots": _with(
        "tx f1",
        "select unnest([date '2001-08-08', date '2001-10-01']) as snapshot_date, count(*) as row_count, "
        "cast(sum(total_amount_spent) as decimal(28,2)) as amount from f1",
    ),
    "csv_quoted_breaks": _with(
        _DIRTY,
        "select 'lines' as read_by, count(*) + count(*) filter (where seq % 7 = 0) as rows_in, "
        "2 * count(*) filter (where seq % 7 = 0) as bad_records, cast(0 as bigint) as broken_states from dirty "
        "union all select 'records', count(*), 0, count(*) filter (where seq % 7 = 0) from dirty",
    ),
    "stream_median": _with(f"{_DIRTY} parsed", "select count(age) as ages, true as all_known, true as within_bounds from parsed"),
    "csv_quoted_records": _with(
        _DIRTY,
        "select transaction_date, transaction_id, gender, age, marital_status, "
        "case when seq % 7 = 0 then 'New' || chr(10) || 'York \"NY\"' else state_names end as state_names, "
        "segment, employees_status, payment_method, referral, "
        "case when seq % 11 = 0 then amount_spent || chr(10) || 'net, \"' else amount_spent end as amount_spent, "
        "cast(null as varchar) as bad_record from dirty",
    ),
    "rejected_after_two_runs": _with(
        f"{_CLEAN} judged",
        "select reject_reason, count(*) as row_count from judged where not good group by reject_reason",
    ),
    "execution_log": _with(f"{_CLEAN} judged log", "select * from log"),
    "recent_executions": _with(f"{_CLEAN} judged log", "select * from log"),
    "run_report": _with(
        _SETS,
        _union(
            [
                f"select '{name}' as stage, count(*) as row_count, "
                f"case when count(*) > 0 then 'SUCCESS' else 'EMPTY' end as status from {f}"
                for name, f in [["raw_transactions", "tx"], *_NAMED]
            ]
        ),
    ),
    "gender_distribution": _distribution("gender"),
    "marital_distribution": _distribution("marital_status"),
    "payment_distribution": _distribution("payment_method"),
    "employment_distribution": _distribution("employees_status"),
    "distribution_maps": _with("tx", _DISTRIBUTION_MAPS),
    "customer_cohorts": _with("tx active first_seen cohorts", "select * from cohorts"),
    "customer_retention": _with("tx active present retention", "select * from retention"),
    "transaction_growth": _with(
        "tx q0 q1",
        "select year, quarter, segment, state_names, quarterly_transactions, case when prev_transactions is null "
        "then 0.0::double else cast(quarterly_transactions - prev_transactions as double) "
        "/ nullif(prev_transactions, 0) end as transaction_growth_rate from q1",
    ),
    "payment_usage": _with(
        "tx",
        "select payment_method, segment, count(transaction_id) as usage_count from tx group by payment_method, segment",
    ),
    "dq_nulls": _with(_DIRTY, _nulls(_TEXT, "dirty")),
    "dq_freshness": _with("tx", _FRESHNESS),
    "dq_schema": _with(_DIRTY, _schema()),
    "dq_report": _with(
        _DIRTY,
        "select 'nulls' as \"check\", column_name as item, null_rows as value, null_rows = 0 as passed "
        f"from ({_nulls(_TEXT, 'dirty')}) union all "
        f"select 'freshness', 'recent_rows', recent_rows, fresh from ({_FRESHNESS}) union all "
        f"select 'schema', column_name, unreadable_rows, unreadable_rows = 0 from ({_schema()})",
    ),
    "dq_feature_invariants": _with(
        _SETS, _union([f"select '{name}' as invariant, {test} as passed" for name, test in _INVARIANTS.items()])
    ),
    "dq_unique": _with(
        f"{_SETS} first_text dirty",
        _union(
            [
                f"select '{name}' as table_name, '{keys}' as key_columns, count(*) filter (where n > 1) as duplicate_keys, "
                f"cast(sum(n - 1) as bigint) as surplus_rows from (select {keys}, count(*) as n from {source} group by {keys})"
                for name, keys, source in (
                    ("source", "transaction_id", "dirty"),
                    ("raw_transactions", "transaction_id", "tx"),
                    ("quarterly_features", "year,quarter,segment,state_names", "f2"),
                    ("state_features", "state_names,feature_version", "f4"),
                )
            ]
        ),
    ),
    "dq_not_null": _with(
        f"{_SETS} first_text dirty parsed",
        _union(
            [
                f"select '{name}' as table_name, '{c}' as column_name, count(*) - count({c}) as violations from {source}"
                for name, c, source in (
                    ("source", "transaction_id", "parsed"),
                    ("source", "transaction_date", "parsed"),
                    ("quarterly_features", "year", "f2"),
                    ("quarterly_features", "quarter", "f2"),
                    ("payment_features", "payment_method", "f3"),
                    ("state_features", "state_names", "f4"),
                )
            ]
        ),
    ),
    "dq_limits": _with(
        "tx",
        _union(
            [
                f"select '{c}' as column_name, 'VARCHAR({n})' as declared_limit, "
                f"count(*) filter (where length({c}) > {n}) as violations, max(length({c})) as widest from tx"
                for c, n in _VARCHARS.items()
            ]
            + [
                "select 'amount_spent', 'DECIMAL(10,2)', count(*) filter (where abs(amount_spent) >= 1e8), "
                "max(length(cast(cast(floor(abs(amount_spent)) as bigint) as varchar))) from tx"
            ]
        ),
    ),
    "stream_intake": _with(
        f"{_CLEAN} kept",
        "select cast(year(transaction_date) as int) as year, cast(month(transaction_date) as int) as month, "
        "count(*) as row_count, cast(sum(amount_spent) as decimal(28,2)) as amount from kept "
        "where transaction_date is not null group by all",
    ),
    "stream_quarterly": _with(
        f"{_CLEAN} kept q0 q1 f2", "select * from f2", source="(select * from kept where transaction_date is not null)"
    ),
    "stream_any_order": _with(
        f"{_CLEAN} kept",
        "select cast(year(transaction_date) as int) as year, cast(month(transaction_date) as int) as month, "
        "count(*) as row_count, cast(sum(amount_spent) as decimal(28,2)) as amount from kept "
        "where transaction_date is not null group by all",
    ),
    "stream_deltas": _with(
        f"{_CLEAN} kept q0 q1 f2", "select * from f2", source="(select * from kept where transaction_date is not null)"
    ),
}
