"""DuckDB SQL for the test-data shapes (mirror of ``daybook.sources.testdata``) and shared CTEs.

``compose(final_sql, *ctes)`` emits ``WITH`` clauses for the named CTEs and their dependencies in
dependency order. Tables are the driver's pre-registered views.
"""

from __future__ import annotations

import re

BASE_DAY, NEWER_DAY, BACKFILL_DAY = "2024-01-01", "2024-01-02", "2023-12-31"
BASE_TS, NEWER_TS, BACKFILL_TS = "2024-01-01 03:00:00", "2024-01-02 03:00:00", "2024-01-03 03:00:00"

CTES: dict[str, str] = {}


def cte(name: str, sql: str) -> None:
    CTES[name] = sql.strip()


def _deps(sql: str) -> list[str]:
    return [n for n in CTES if re.search(rf"\b{n}\b", sql)]


def compose(final_sql: str, *names: str) -> str:
    order: list[str] = []

    def visit(n: str, stack: tuple = ()):
        if n in order:
            return
        for d in _deps(CTES[n]):
            if d != n and d not in stack:
                visit(d, stack + (n,))
        order.append(n)

    for n in list(names) + [d for d in _deps(final_sql)]:
        visit(n)
    if not order:
        return final_sql.strip()
    if final_sql.lstrip().lower().startswith("with "):
        final_sql = f"select * from ({final_sql.strip()})"
    return "WITH " + ",\n".join(f"{n} AS (\n{CTES[n]}\n)" for n in order) + "\n" + final_sql.strip()


def year_batch(c: str, add: int = 0) -> str:
    return f"cast(year({c}) + {add} as varchar) || '-12-31'"


def unit_price_cents(ext: str, qty: str) -> str:
    return f"cast(floor(cast(floor({ext} * 100 + 0.5) as bigint) / cast({qty} as bigint)) as bigint)"


def cents_text(c: str) -> str:
    return f"(cast(cast(floor(({c}) / 100) as bigint) as varchar) || '.' || lpad(cast(({c}) % 100 as varchar), 2, '0'))"


# ---------------------------------------------------------------- curated masters ----------

cte("geo", """
select n.n_nationkey, n.n_name, r.r_name
from nation n left join region r on n.n_regionkey = r.r_regionkey
""")

_CUST_COLS = """
    c.c_custkey as customerNumber, {name} as customerName, c.c_mktsegment as contactLastName,
    ' Contact ' || cast(c.c_custkey as varchar) || ' ' as contactFirstName,
    cast(c.c_nationkey + 10 as varchar) || '-' || lpad(cast(c.c_custkey as varchar), 7, '0') as phone,
    g.n_name || ' CITY' as city, g.r_name as state, g.n_name as country,
    cast(c.c_nationkey as varchar) as salesRepEmployeeNumber, {credit} as creditLimit,
    timestamp '{ts}' as ingest_ts, '{day}' as processing_date, 'landing_rds' as source
from customer c left join geo g on c.c_nationkey = g.n_nationkey
"""

cte("customers_c", f"""
select {_CUST_COLS.format(name='c.c_name', credit='c.c_acctbal', ts=BASE_TS, day=BASE_DAY)}
union all
select {_CUST_COLS.format(name='c.c_name', credit='c.c_acctbal + 500.0', ts=NEWER_TS, day=NEWER_DAY)}
where c.c_mktsegment = 'BUILDING'
union all
select {_CUST_COLS.format(name="upper(c.c_name) || ' (OLD)'", credit='c.c_acctbal - 250.0', ts=BACKFILL_TS,
                          day=BACKFILL_DAY)}
where c.c_mktsegment = 'MACHINERY'
""")

_PROD_COLS = """
    cast(p_partkey as varchar) as productCode, {name} as productName, p_brand as productLine,
    '1:' || cast(p_size as varchar) as productScale, p_type as productVendor,
    p_name || ' by ' || p_brand as productDescription, {stock} as quantityInStock,
    p_retailprice * 0.6 as buyPrice, {msrp} as MSRP,
    timestamp '{ts}' as ingest_ts, '{day}' as processing_date, 'landing_rds' as source
from part
"""

cte("products_c", f"""
select {_PROD_COLS.format(name='p_name', stock='p_size', msrp='p_retailprice', ts=BASE_TS, day=BASE_DAY)}
union all
select {_PROD_COLS.format(name='p_name', stock='p_size + 5', msrp='p_retailprice + 10.0', ts=NEWER_TS,
                          day=NEWER_DAY)}
where p_type = 'ECONOMY'
union all
select {_PROD_COLS.format(name='upper(p_name)', stock='p_size', msrp='p_retailprice', ts=BACKFILL_TS,
                          day=BACKFILL_DAY)}
where p_type = 'STANDARD'
""")

_ORD_COLS = """
    o_orderkey as orderNumber, cast(o_orderdate as date) as orderDate,
    cast(cast(o_orderdate as date) + 7 as varchar) as requiredDate,
    case when o_orderstatus = 'F' then cast(cast(o_orderdate as date) + 2 as varchar) end as shippedDate,
    {status} as status, o_orderpriority as comments, o_custkey as customerNumber,
    {ts} as ingest_ts, {batch} as processing_date, 'landing_rds' as source
from orders
"""

cte("orders_c", f"""
select {_ORD_COLS.format(
    status="case o_orderstatus when 'F' then 'Shipped' when 'O' then 'In Process' when 'P' then 'On Hold' end",
    ts='cast(o_orderdate as timestamp)', batch=year_batch('o_orderdate'))}
union all
select {_ORD_COLS.format(status="'Complete'", ts="cast(o_orderdate as timestamp) + interval 30 day",
                         batch=year_batch('o_orderdate'))}
where o_orderstatus = 'O'
""")

cte("orderdetails_c", f"""
select l_orderkey as orderNumber, cast(l_partkey as varchar) as productCode,
       cast(l_quantity as integer) as quantityOrdered,
       {unit_price_cents('l_extendedprice', 'l_quantity')} / 100.0::double as priceEach,
       l_linenumber as orderLineNumber, cast(l_shipdate as timestamp) as ingest_ts,
       {year_batch('l_shipdate')} as processing_date, 'landing_rds' as source
from lineitem
""")

cte("payments_c", f"""
select o_custkey as customerNumber, 'CHK-' || cast(o_orderkey as varchar) as checkNumber,
       cast(o_orderdate as date) as paymentDate, o_totalprice as amount,
       cast(o_orderdate as timestamp) as ingest_ts, {year_batch('o_orderdate')} as processing_date,
       'landing_rds' as source
from orders
""")

# ---------------------------------------------------------------- landed text ---------------

_OD_CODE = "((l_orderkey * 7 + l_linenumber) % 100)"
cte("landed_orderdetails", f"""
select case when {_OD_CODE} in (0, 11) then null else cast(l_orderkey as varchar) end as orderNumber,
       cast(l_partkey as varchar) as productCode,
       case when {_OD_CODE} = 2 then 'abc' when {_OD_CODE} in (3, 8) then '0'
            when {_OD_CODE} in (4, 11) then '-1' when {_OD_CODE} = 5 then ' 12 '
            when {_OD_CODE} = 10 then '99999999999'
            else cast(cast(l_quantity as integer) as varchar) end as quantityOrdered,
       case when {_OD_CODE} = 6 then '-0.01' when {_OD_CODE} = 7 then '' when {_OD_CODE} = 8 then '-5.00'
            when {_OD_CODE} = 9 then '0'
            else {cents_text(unit_price_cents('l_extendedprice', 'l_quantity'))} end as priceEach,
       case when {_OD_CODE} = 1 then null else cast(l_linenumber as varchar) end as orderLineNumber,
       cast(cast(l_shipdate as timestamp) as varchar) as ingest_ts,
       'mysql_rds' as source,
       {year_batch('l_shipdate')} as processing_date
from lineitem
""")

_P_CODE = "(p_partkey % 50)"
_P_CENTS = "cast(floor(p_retailprice * 100 + 0.5) as bigint)"
cte("landed_products", f"""
select case when {_P_CODE} = 0 then null else cast(p_partkey as varchar) end as productCode,
       p_name as productName, p_brand as productLine, p_type as productVendor,
       case when {_P_CODE} = 1 then '' when {_P_CODE} = 2 then '-3' when {_P_CODE} in (6, 7) then '-1'
            else cast(p_size as varchar) end as quantityInStock,
       case when {_P_CODE} = 3 then 'n/a' when {_P_CODE} in (4, 7) then '-1.50'
            else {cents_text(f'cast(floor({_P_CENTS} * 6 / 10) as bigint)')} end as buyPrice,
       case when {_P_CODE} = 5 then null when {_P_CODE} in (6, 7) then '-10'
            else {cents_text(_P_CENTS)} end as MSRP,
       '{BASE_TS}' as ingest_ts, 'mysql_rds' as source, '{BASE_DAY}' as processing_date
from part
""")

_PAY_CODE = "(o_orderkey % 40)"
cte("landed_payments", f"""
select case when {_PAY_CODE} = 0 then null else cast(o_custkey as varchar) end as customerNumber,
       case when {_PAY_CODE} = 1 then null else 'CHK-' || cast(o_orderkey as varchar) end as checkNumber,
       cast(cast(o_orderdate as date) as varchar) as paymentDate,
       case when {_PAY_CODE} = 2 then 'x' when {_PAY_CODE} = 3 then '-5.00' when {_PAY_CODE} = 4 then null
            else {cents_text('cast(floor(o_totalprice * 100 + 0.5) as bigint)')} end as amount,
       cast(cast(o_orderdate as timestamp) as varchar) as ingest_ts, 'mysql_rds' as source,
       {year_batch('o_orderdate')} as processing_date
from orders
""")

cte("landed_ratings", """
select case when event_id % 89 = 0 then null when event_id % 101 = 0 then user_id + 1000000
            else user_id end as customerNumber,
       case when k >= 95 then 'X' || cast(k as varchar) when k = 90 then ' '
            else cast(k % 10 as varchar) end as productCode,
       case when event_id % 97 = 0 then null
            else cast(cast(floor(value) as bigint) % 7 as varchar)
                 || case when event_id % 53 = 0 then '.0' when event_id % 59 = 0 then '.5' else '' end end as productRating,
       case when event_id % 83 = 0 then null else date_trunc('day', cast(ts as timestamp)) end as ratingTimestamp,
       cast(ts as timestamp) as ingest_ts,
       'ratings/' || event_type || '.json' as source,
       cast(cast(ts as date) as varchar) as processing_date
from (select *, cast(json_extract_string(props, '$.k') as integer) as k from events) e
""")
