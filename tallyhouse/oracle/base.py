"""The warehouse written once more, as SQL common table expressions.

Independent of the Spark code: plain windows and joins over the given tables,
in the dialect of the engine the results are checked with.
"""

from __future__ import annotations

import re

from tallyhouse import fixed_values as fixed
from tallyhouse.adapters.tpch import FIRST_DAY, LAST_DAY, METHOD_OF, NATION_STATES, STATUS_OF


def r(expression: str, digits: int) -> str:
    """Round half up on the printed number, as Spark rounds doubles."""
    return (
        f"cast(round(cast(cast({expression} as varchar) as decimal(38, 16)), {digits}) as double)"
    )


def mean(value: str, digits: int) -> str:
    return r(f"(cast(sum({value}) as double) / nullif(count({value}), 0))", digits)


def money(value: str) -> str:
    return f"cast({value} as double)"


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def buckets(value: str, cuts, labels, sign: str = "<", head: str | None = None) -> str:
    parts = []
    for i, (cut, label) in enumerate(zip(cuts, labels)):
        op = head if head and i == 0 else sign
        parts.append(f"when {value} {op} {cut} then {text(label)}")
    return f"case {' '.join(parts)} else {text(labels[-1])} end"


def choose(value: str, labels: dict, otherwise: str) -> str:
    parts = [
        f"when {value} = {text(k)} then {text(v) if isinstance(v, str) else v}"
        for k, v in labels.items()
    ]
    return f"case {' '.join(parts)} else {otherwise} end"


_STATES = "[" + ", ".join(text(s) for s in NATION_STATES) + "]"
_REGION = (
    "case "
    + " ".join(
        f"when state in ({', '.join(text(s) for s in states)}) then {text(region)}"
        for region, states in fixed.REGION_STATES.items()
    )
    + " else 'Unknown' end"
)


def _state(nation: str) -> str:
    return f"{_STATES}[{nation} + 1]"


def _zip(nation: str, number: str) -> str:
    return f"{nation} * 100 + {number} % 20"


def _cents(value: str) -> str:
    return f"cast({value} as decimal(18, 2))"


def _date_key(moment: str) -> str:
    day = f"cast({moment} as date)"
    return (
        f"cast(case when {day} between date '{FIRST_DAY}' and date '{LAST_DAY}' "
        f"then strftime({day}, '%Y%m%d') else '-1' end as integer)"
    )


def _category(kind: str, size: str) -> str:
    return f"lower({kind}) || '_' || cast({size} % 5 as varchar)"


_LINE_ID = "concat_ws('|', " + ", ".join(
    [
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        *[
            f"cast(floor({c} * 100 + 0.5) as bigint)"
            for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
        ],
        "l_returnflag",
        "l_linestatus",
        "date_diff('day', date '1970-01-01', cast(l_shipdate as date))",
    ]
) + ")"

_PRICE = _cents("cast(l_extendedprice as decimal(18, 2)) * cast(0.005 as decimal(9, 4))")

CTES: dict[str, str] = {
    # --- the nine raw tables ------------------------------------------------
    "raw_customers": f"""
        select cast(c_custkey as varchar) as customer_id,
               cast(c_custkey // 2 as varchar) as person,
               cast({_zip('c_nationkey', 'c_custkey')} as integer) as zip,
               lower(c_mktsegment) as city, {_state('c_nationkey')} as state
        from customer""",
    "raw_orders": f"""
        select o_orderkey as order_id, cast(o_custkey as varchar) as customer_id,
               {choose('o_orderstatus', STATUS_OF,
                       "case when o_orderkey % 5 = 0 then 'unavailable' else 'canceled' end")} as status,
               o_orderdate + to_hours((o_orderkey * 7 + o_custkey) % 24) as purchased,
               o_orderdate + to_days(cast(o_orderkey % 3 as integer)) as approved,
               o_orderdate + to_days(cast(o_orderkey % 3 + o_orderkey % 7 + 1 as integer)) as carrier,
               case when o_orderstatus <> 'P' then o_orderdate + to_hours(12) + to_days(cast(
                   o_orderkey % 3 + o_orderkey % 7 + 1 + o_custkey % 25 as integer)) end as delivered,
               o_orderdate + to_days(21) as promised
        from orders""",
    "raw_items": f"""
        select l_orderkey as order_id, {_LINE_ID} as order_item_id,
               cast(l_partkey as varchar) as product_id, cast(l_suppkey as varchar) as seller_id,
               {_PRICE} as price,
               {_cents(f"{_PRICE} * cast(l_tax as decimal(6, 2)) * 5")} as freight_value
        from lineitem""",
    "raw_payments": f"""
        select o_orderkey as order_id, seq as payment_sequential,
               case when seq = 2 then 'voucher'
                    else {choose('o_orderpriority', METHOD_OF, "'debit_card'")} end as payment_type,
               cast(o_orderkey % 16 as integer) as payment_installments,
               {_cents("cast(o_totalprice as decimal(18, 2)) * case when seq = 2 "
                       "then cast(0.001 as decimal(9, 4)) else cast(0.005 as decimal(9, 4)) end")}
                   as payment_value
        from orders join (values (1), (2)) as s(seq) on seq = 1 or o_orderkey % 7 = 0""",
    "raw_reviews": """
        select cast(event_id as varchar) as review_id,
               case when event_id % 10 = 9 then event_id - 1 else event_id end as order_id,
               cast(floor(value) as integer) % 5 + 1 as review_score,
               case when event_type <> 'error' then props end as comment,
               date_trunc('day', ts) as created, ts as answered
        from events""",
    "raw_products": f"""
        select cast(p_partkey as varchar) as product_id,
               case when p_partkey % 50 <> 0 then {_category('p_type', 'p_size')} end as word,
               case when p_partkey % 37 <> 0 then p_size % 9 end as photos_qty,
               length(p_name) as name_length, length(p_name) * 10 as description_length,
               case when p_partkey % 33 <> 0 then p_size * 250 end as weight_g,
               case when p_partkey % 40 <> 0 then p_size + 5 end as length_cm,
               p_partkey % 30 + 10 as height_cm, p_partkey % 20 + 5 as width_cm
        from part""",
    "raw_words": f"""
        select distinct {_category('p_type', 'p_size')} as word,
               'en_' || {_category('p_type', 'p_size')} as english
        from part where p_size % 5 <> 4""",
    "raw_sellers": f"""
        select cast(s_suppkey as varchar) as seller_id,
               cast({_zip('s_nationkey', 's_suppkey')} as integer) as zip,
               'city ' || cast(s_nationkey as varchar) as city, {_state('s_nationkey')} as state
        from supplier""",
    "raw_points": f"""
        select cast({_zip('c_nationkey', 'c_custkey')} as integer) as zip,
               -30.0 + c_nationkey * 1.5 + (c_custkey % 8) * 0.125 as lat,
               -70.0 + c_nationkey * 1.25 + (c_custkey % 16) * 0.0625 as lng,
               lower(c_mktsegment) as city,
               case when c_custkey % 11 = 0 then {_state('((c_nationkey + 1) % 25)')}
                    else {_state('c_nationkey')} end as state
        from customer""",
    # --- dimensions ----------------------------------------------------------
    "dim_date": f"""
        select cast(strftime(d, '%Y%m%d') as integer) as date_key, cast(d as date) as full_date,
               cast(year(d) as integer) as year, cast(quarter(d) as integer) as quarter,
               year(d) || '-Q' || quarter(d) as year_quarter,
               cast(month(d) as integer) as month, monthname(d) as month_name,
               strftime(d, '%Y-%m') as year_month, cast(day(d) as integer) as day_of_month,
               cast(dayofweek(d) as integer) as day_of_week, dayname(d) as day_name,
               dayofweek(d) in (0, 6) as is_weekend, cast(weekofyear(d) as integer) as week_of_year
        from generate_series(timestamp '{FIRST_DAY}', timestamp '{LAST_DAY}', interval 1 day) as t(d)
        union all by name
        select -1 as date_key, 'Unknown' as year_quarter, 'Unknown' as month_name,
               'Unknown' as year_month, 'Unknown' as day_name""",
    "zip_names": """
        select zip,
               (select city from raw_points p where p.zip = z.zip
                group by city order by count(*) desc, city limit 1) as city,
               (select state from raw_points p where p.zip = z.zip
                group by state order by count(*) desc, state limit 1) as state,
               lat, lng
        from (select zip, avg(lat) as lat, avg(lng) as lng from raw_points group by zip) z""",
    "dim_geography": f"""
        select row_number() over (order by zip) as geography_key, zip as zip_code_prefix,
               city, state, {_REGION} as region, lat as latitude, lng as longitude
        from zip_names
        union all select -1, -1, 'unknown', 'XX', 'Unknown', null, null""",
    "dim_customers": """
        select row_number() over (order by customer_id) as customer_key, customer_id,
               person as customer_unique_id, zip as zip_code_prefix,
               coalesce(g.geography_key, -1) as geography_key, c.city, c.state
        from raw_customers c left join dim_geography g on g.zip_code_prefix = c.zip
        union all select -1, 'unknown', 'unknown', null, -1, 'unknown', 'XX'""",
    "dim_sellers": """
        select row_number() over (order by seller_id) as seller_key, seller_id,
               zip as zip_code_prefix, coalesce(g.geography_key, -1) as geography_key, s.city, s.state
        from raw_sellers s left join dim_geography g on g.zip_code_prefix = s.zip
        union all select -1, 'unknown', null, -1, 'unknown', 'XX'""",
    "dim_products": """
        select row_number() over (order by product_id) as product_key, product_id,
               coalesce(english, word, 'unknown') as category, coalesce(word, 'unknown') as category_pt,
               cast(photos_qty as integer) as photos_qty, cast(name_length as integer) as name_length,
               cast(description_length as integer) as description_length,
               cast(weight_g as integer) as weight_g, cast(length_cm as integer) as length_cm,
               cast(height_cm as integer) as height_cm, cast(width_cm as integer) as width_cm,
               cast(length_cm * height_cm * width_cm as bigint) as volume_cm3,
               case when length_cm is null then 'Unknown'
                    when length_cm * height_cm * width_cm < 5000 then 'Small'
                    when length_cm * height_cm * width_cm < 20000 then 'Medium'
                    else 'Large' end as size_band
        from raw_products left join raw_words using (word)
        union all
        select -1, 'unknown', 'unknown', 'unknown', null, null, null, null, null, null, null, null, 'Unknown'""",
    "dim_order_status": f"""
        select row_number() over (order by status) as order_status_key,
               status as order_status, {choose('status', fixed.STATUS_LABELS, 'status')} as status_label,
               status = 'delivered' as is_delivered,
               status = 'canceled' or status = 'unavailable' as is_cancelled,
               {choose('status', fixed.STATUS_STEPS, '9')} as lifecycle_step
        from (select distinct status from raw_orders)
        union all select -1, 'unknown', 'Unknown', false, false, 9""",
    "dim_payment_type": f"""
        select row_number() over (order by payment_type) as payment_type_key,
               payment_type,
               {choose('payment_type', fixed.PAYMENT_LABELS, "replace(payment_type, '_', ' ')")}
                   as payment_label,
               payment_type = 'credit_card' as supports_instalments,
               payment_type <> 'not_defined' as is_valid_method
        from (select distinct payment_type from raw_payments)
        union all select -1, 'unknown', 'Unknown', false, false""",
    # --- facts ---------------------------------------------------------------
    "header": f"""
        select o.order_id, {_date_key('purchased')} as purchase_date_key,
               {_date_key('approved')} as approved_date_key, {_date_key('carrier')} as carrier_date_key,
               {_date_key('delivered')} as delivered_date_key,
               {_date_key('promised')} as estimated_date_key,
               coalesce(c.customer_key, -1) as customer_key,
               coalesce(c.geography_key, -1) as customer_geography_key,
               coalesce(s.order_status_key, -1) as order_status_key,
               cast(date_diff('day', cast(purchased as date), cast(delivered as date)) as integer)
                   as delivery_days,
               cast(date_diff('day', cast(approved as date), cast(carrier as date)) as integer)
                   as seller_processing_days,
               cast(date_diff('day', cast(carrier as date), cast(delivered as date)) as integer)
                   as carrier_transit_days,
               cast(date_diff('day', cast(promised as date), cast(delivered as date)) as integer)
                   as delivery_delay_days,
               case when delivered > promised then 1 when delivered <= promised then 0 end
                   as is_late_delivery,
               cast(hour(purchased) as integer) as purchase_hour,
               g.latitude as lat, g.longitude as lng
        from raw_orders o
        left join dim_customers c on c.customer_id = o.customer_id
        left join dim_order_status s on s.order_status = o.status
        left join dim_geography g on g.geography_key = c.geography_key""",
    "fact_order_items": f"""
        select i.order_id, i.order_item_id,
               h.* exclude (order_id, lat, lng),
               coalesce(p.product_key, -1) as product_key, coalesce(s.seller_key, -1) as seller_key,
               coalesce(s.geography_key, -1) as seller_geography_key,
               i.price, i.freight_value,
               {_cents('i.price + i.freight_value')} as total_item_value,
               case when h.lat is null or g.latitude is null then null
                    else {fixed.EARTH_RADIUS_KM} * acos(greatest(-1.0, least(1.0,
                         sin(radians(h.lat)) * sin(radians(g.latitude))
                         + cos(radians(h.lat)) * cos(radians(g.latitude))
                           * cos(radians(g.longitude - h.lng))))) end as buyer_seller_distance_km
        from raw_items i
        left join header h on h.order_id = i.order_id
        left join dim_products p on p.product_id = i.product_id
        left join dim_sellers s on s.seller_id = i.seller_id
        left join dim_geography g on g.geography_key = s.geography_key""",
    "fact_order_payments": """
        select p.order_id, p.payment_sequential, coalesce(h.purchase_date_key, -1) as purchase_date_key,
               coalesce(h.customer_key, -1) as customer_key,
               coalesce(h.customer_geography_key, -1) as customer_geography_key,
               coalesce(t.payment_type_key, -1) as payment_type_key,
               coalesce(h.order_status_key, -1) as order_status_key,
               p.payment_value, p.payment_installments,
               case when payment_installments > 0 then
                   (2 * cast(payment_value * 100 as bigint) + payment_installments)
                   // (2 * payment_installments) / 100.0 end as instalment_amount,
               payment_sequential > 1 as is_split_payment, payment_installments > 1 as is_instalment_plan
        from raw_payments p left join header h on h.order_id = p.order_id
        left join dim_payment_type t on t.payment_type = p.payment_type""",
    "fact_order_reviews": f"""
        select r.review_id, r.order_id, coalesce(h.purchase_date_key, -1) as purchase_date_key,
               {_date_key('created')} as review_created_date_key,
               {_date_key('answered')} as review_answered_date_key,
               coalesce(h.customer_key, -1) as customer_key,
               coalesce(h.customer_geography_key, -1) as customer_geography_key,
               coalesce(h.order_status_key, -1) as order_status_key,
               review_score, date_diff('hour', created, answered) as response_hours,
               case when comment is null then 0 else 1 end as has_comment,
               cast(coalesce(length(comment), 0) as integer) as comment_length,
               case when review_score > 3 then 1 else 0 end as is_positive,
               case when review_score < 3 then 1 else 0 end as is_negative
        from raw_reviews r left join header h on h.order_id = r.order_id""",
    # --- shared steps ----------------------------------------------------------
    "sold": """
        select f.*, d.full_date, d.year, d.quarter, d.month, d.month_name, d.year_month,
               p.category, p.size_band, p.photos_qty, p.weight_g
        from fact_order_items f
        join dim_date d on d.date_key = f.purchase_date_key
        join dim_products p on p.product_key = f.product_key""",
    "viewed": """
        select f.*, c.customer_unique_id, c.state as customer_state, g.region as customer_region,
               s.status_label, s.order_status as status_code, s.lifecycle_step
        from sold f
        join dim_customers c on c.customer_key = f.customer_key
        join dim_geography g on g.geography_key = f.customer_geography_key
        join dim_order_status s on s.order_status_key = f.order_status_key""",
    "paid": """
        select f.*, d.year, d.quarter, d.month, d.month_name, t.payment_label
        from fact_order_payments f
        join dim_date d on d.date_key = f.purchase_date_key
        join dim_payment_type t on t.payment_type_key = f.payment_type_key
        where t.is_valid_method""",
    "scored": """
        select order_id, avg(review_score) as score from fact_order_reviews group by order_id""",
    "main_category": """
        select order_id, category from (
            select order_id, category,
                   row_number() over (partition by order_id order by count(*) desc, category) as k
            from sold where category <> 'unknown' group by order_id, category)
        where k = 1""",
    "category_means": f"""
        select category, count(*) as orders, {mean('score', 2)} as avg_review_score
        from main_category join scored using (order_id) group by category having count(*) >= 10""",
    "people": """
        select c.customer_unique_id as person, count(distinct f.order_id) as frequency,
               sum(f.price) as monetary, max(f.purchase_date_key) as last_day
        from fact_order_items f join dim_customers c on c.customer_key = f.customer_key
        where c.customer_unique_id <> 'unknown' group by 1""",
    "by_seller": """
        select seller_key, sum(price) as revenue,
               row_number() over (order by sum(price) desc, seller_key) as k,
               count(*) over () as sellers
        from fact_order_items where seller_key >= 0 group by seller_key""",
}


def _needed(body: str, extra: dict[str, str]) -> list[str]:
    known = {**CTES, **extra}
    seen: list[str] = []

    def visit(sql: str) -> None:
        for name in known:
            if name not in seen and re.search(rf"\b(from|join)\s+{name}\b", sql):
                visit(known[name])
                if name not in seen:
                    seen.append(name)

    visit(body)
    return seen


def statement(body: str, extra: dict[str, str] | None = None) -> str:
    """The body with the common table expressions it needs in front of it."""
    extra = extra or {}
    known = {**CTES, **extra}
    names = _needed(body, extra)
    if not names:
        return body.strip()
    parts = ",\n".join(f"{name} as ({known[name]})" for name in names)
    return f"with {parts}\n{body.strip()}"
