"""One SQL statement per query name, with the same columns and types."""

from __future__ import annotations

from tallyhouse import fixed_values as fixed
from tallyhouse import registry
from tallyhouse.adapters.tpch import METHOD_OF
from tallyhouse.oracle.base import buckets, choose, mean, money, r, statement, text
from tallyhouse.plans import quality
from tallyhouse.plans.filters import Filters


def _in(column: str, values) -> str:
    return f"{column} in ({', '.join(text(v) for v in values)})" if values else "false"


def _where(f: Filters) -> str:
    """The filters as a condition on the ``viewed`` rows."""
    parts = ["true"]
    if f.start:
        parts.append(f"full_date >= date '{f.start}'")
    if f.end:
        parts.append(f"full_date <= date '{f.end}'")
    if f.regions is not None:
        parts.append(_in("customer_region", f.regions))
    if f.customer_states is not None:
        parts.append(_in("customer_state", f.customer_states))
    if f.categories is not None:
        parts.append(_in("category", f.categories))
    return " and ".join(parts)


def _filtered(f: Filters) -> dict[str, str]:
    """Rows that pass themselves, and all rows of the orders that are kept."""
    inside = "where order_id in (select order_id from passing)"
    methods = "" if f.payment_labels is None else f" and {_in('payment_label', f.payment_labels)}"
    return {
        "passing": f"select * from viewed where {_where(f)}",
        "kept_sold": f"select * from sold {inside}",
        "kept_viewed": f"select * from viewed {inside}",
        "kept_paid": f"select * from paid {inside}{methods}",
        "kept_payments": f"select * from fact_order_payments {inside}",
        "kept_scored": f"select * from scored {inside}",
        "kept_main": f"""
            select order_id, category from (
                select order_id, category,
                       row_number() over (partition by order_id order by count(*) desc, category) as k
                from kept_sold where category <> 'unknown' group by order_id, category)
            where k = 1""",
    }


ITEM = _filtered(registry.BY_ITEM)
ORDER = _filtered(registry.BY_ORDER)


# --- questions, over either all rows or the kept ones --------------------------
def _best_category(rows: str, measure: str, name: str, columns: str, shown: str) -> str:
    return f"""
        select {columns}, category as top_category, {shown} as {name}
        from (select {columns}, category, {measure} as {name},
                     row_number() over (partition by year, month
                                        order by {measure} desc, category) as k
              from {rows} where category <> 'unknown' group by {columns}, category)
        where k = 1"""


def _best_month(rows: str, columns: str) -> str:
    return f"""
        select {columns}, {money('revenue')} as revenue
        from (select {columns}, sum(price) as revenue,
                     row_number() over (partition by year order by sum(price) desc, month) as k
              from {rows} group by {columns})
        where k = 1"""


def _top8(rows: str) -> str:
    return f"""
        select year, category, {money('sum(price)')} as revenue
        from {rows}
        where category in (select category from {rows} where category <> 'unknown'
                           group by category order by sum(price) desc, category limit 8)
        group by year, category"""


def _top8_ordered(rows: str) -> str:
    return f"""
        select t.year, t.category, t.revenue, o.category_order
        from ({_top8(rows)}) t
        join (select category,
                     cast(row_number() over (order by sum(price) desc, category) as integer)
                         as category_order
              from {rows} where category <> 'unknown' group by category) o
        using (category)"""


def _cancelled(rows: str, limit: int) -> str:
    return f"""
        select category, count(*) as cancelled_items from {rows}
        where status_code = 'canceled' and category <> 'unknown'
        group by category order by 2 desc, 1 limit {limit}"""


def _score_by(joined: str, bucket: str, name: str) -> str:
    return f"""
        select {bucket} as {name}, count(*) as orders, {mean('score', 2)} as avg_review_score
        from {joined} group by 1"""


def _delivery(rows: str, scores: str, labels) -> str:
    return _score_by(
        f"""(select order_id, avg(delivery_days) as days from {rows}
             where delivery_days is not null group by order_id) d join {scores} using (order_id)""",
        buckets("days", fixed.DELIVERY_DAY_CUTS, labels),
        "delivery_bucket",
    )


def _freight_share(rows: str, scores: str, labels) -> str:
    cases = " ".join(
        f"when freight * 100 < basket * {cut} then {text(label)}"
        for cut, label in zip(fixed.FREIGHT_PCT_CUTS, labels)
    )
    return _score_by(
        f"""(select order_id, sum(freight_value) as freight, sum(price) as basket from {rows}
             group by order_id having sum(price) > 0) d join {scores} using (order_id)""",
        f"case {cases} else {text(labels[-1])} end",
        "freight_pct_bucket",
    )


def _price_freight(rows: str) -> str:
    return f"""
        select {buckets('price', fixed.PRICE_CUTS, fixed.PRICE_LABELS)} as price_bucket,
               count(*) as items, {mean('freight_value', 2)} as avg_freight
        from {rows} group by 1"""


def _size_freight(rows: str) -> str:
    return f"""
        select size_band, count(*) as items, {mean('freight_value', 2)} as avg_freight
        from {rows} where size_band <> 'Unknown' group by 1"""


def _weight_freight(rows: str, labels) -> str:
    return f"""
        select {buckets('weight_g', fixed.WEIGHT_CUTS, labels)} as weight_bucket,
               count(*) as items, {mean('freight_value', 2)} as avg_freight
        from {rows} where weight_g is not null group by 1"""


def _photos(rows: str, labels, revenue: bool) -> str:
    extra = f", {money('sum(price)')} as revenue" if revenue else ""
    return f"""
        select {buckets('photos_qty', fixed.PHOTO_CUTS, labels, '<=', '=')} as photo_bucket,
               min(photos_qty) as sort_key, count(distinct order_id) as orders{extra}
        from {rows} where photos_qty is not null group by 1"""


def _hours(rows: str) -> str:
    return f"""
        select purchase_hour, count(distinct order_id) as orders
        from {rows} where purchase_hour is not null group by 1"""


def _late_by_size(rows: str, days: bool) -> str:
    late = "case when is_late_delivery = 1 then delivery_delay_days end"
    extra = f", {mean(late, 1)} as avg_days_late" if days else ""
    return f"""
        select size_band, count(*) as items,
               {r('100.0 * sum(is_late_delivery) / count(*)', 1)} as late_rate_pct{extra}
        from {rows} where size_band <> 'Unknown' and is_late_delivery is not null group by 1"""


def _instalments(main: str, payments: str, limit: int, percent: bool) -> str:
    flag = "case when parts > 1 then 100 else 0 end"
    extra = f", {mean(flag, 1)} as pct_installment_orders" if percent else ""
    return f"""
        select category, count(*) as orders, {mean('parts', 2)} as avg_installments{extra}
        from {main} join (select order_id, max(payment_installments) as parts
                          from {payments} group by order_id) using (order_id)
        group by category having count(*) >= 50
        order by {mean('parts', 2)} desc, category limit {limit}"""


def _methods(rows: str, period: str) -> str:
    return f"""
        select {period}, payment_label, count(distinct order_id) as orders
        from {rows} group by {period}, payment_label"""


def _winner(rows: str) -> str:
    return f"""
        select year, month, payment_label, orders
        from (select *, row_number() over (partition by year, month
                                           order by orders desc, payment_label) as k
              from ({_methods(rows, 'year, month')}))
        where k = 1"""


def _mix(rows: str) -> str:
    return f"""
        select year, quarter, 'Q' || quarter || '/' || year as quarter_label,
               year * 10 + quarter as quarter_sort, payment_label, orders,
               {r('share', 6)} as share,
               case when share >= {fixed.MIN_LABELLED_SHARE} then format('{{:,}}', orders)
                    else '' end as label
        from (select *, cast(orders as double) / sum(orders) over (partition by year, quarter) as share
              from ({_methods(rows, 'year, quarter')}))"""


def _with_month_sort(sql: str) -> str:
    return f"select *, year * 100 + month as month_sort from ({sql})"


def _kpis(rows: str) -> str:
    return f"""
        select {money('coalesce(sum(price), 0)')} as revenue, count(distinct order_id) as orders,
               coalesce({r('cast(sum(price) as double) / nullif(count(distinct order_id), 0)', 2)}, 0.0)
                   as aov
        from {rows}"""


def _view(rows: str) -> str:
    return f"""
        select order_id, {money('price')} as price, {money('freight_value')} as freight_value,
               {money('total_item_value')} as total_item_value, delivery_days,
               seller_processing_days, carrier_transit_days, delivery_delay_days,
               {r('buyer_seller_distance_km', 2)} as buyer_seller_distance_km, is_late_delivery,
               purchase_hour, full_date as purchase_date, year as purchase_year,
               year_month as purchase_year_month, category as product_category,
               size_band as product_size_band, customer_unique_id, customer_state, customer_region,
               status_label as order_status, lifecycle_step as status_step
        from {rows}"""


DATED = "(select * from sold where year is not null)"

_PLAIN: dict[str, str] = {
    # sources and sinks
    "a01_csv_scan": f"""
        select order_id, order_item_id, product_id, seller_id, l_shipdate as shipping_limit_date,
               {money('price')} as price, {money('freight_value')} as freight_value
        from (select *, cast(date '1970-01-01' + cast(split_part(order_item_id, '|', 10) as integer)
                             as timestamp) as l_shipdate
              from raw_items)""",
    "a01q_quoted_lines": "select * from documents",
    "a01r_rejected_cells": """
        select order_id, case when reasons = '' then day end as ordered_on,
               case when reasons = '' then total end as total, nullif(reasons, '') as reasons
        from (select o_orderkey as order_id, cast(o_orderdate as date) as day,
                     round(cast(cast(o_totalprice as decimal(18,2)) as double), 2) as total,
                     concat_ws('; ', case when o_orderkey % 97 = 5 then 'ordered_on is no date: soon' end,
                               case when o_orderkey % 89 = 3 then 'total is no decimal(18,2): 1,5' end)
                         as reasons
              from orders)""",
    "a02_marked_lookup": """
        select category as product_category_name, 'en_' || category as product_category_name_english
        from (select distinct lower(p_type) || '_' || cast(p_size % 5 as varchar) as category
              from part where p_size % 5 <> 4)""",
    "a04_staged_view": "select status as order_status, count(*) as orders from raw_orders group by 1",
    "a12_preview": "select * from dim_customers order by customer_key limit 50",
    "a03_staged_orders": f"""
        select order_id, customer_id, status as order_status, purchased as order_purchase_timestamp,
               approved as order_approved_at, carrier as order_delivered_carrier_date,
               delivered as order_delivered_customer_date, promised as order_estimated_delivery_date,
               timestamp '{fixed.SNAPSHOT_TIME}' as ingestion_timestamp
        from raw_orders""",
    "a10_row_counts": " union all ".join(
        f"select '{t}' as table_name, count(*) as row_count from {t}"
        for t in [*quality.UNIQUE, *quality.GRAINS]
    ) + " union all select '(all tables)', " + " + ".join(
        f"(select count(*) from {t})" for t in [*quality.UNIQUE, *quality.GRAINS]
    ),
    "a13_export_csv": "select * from dim_products",
    # operators
    "b04_bucketize": f"""
        select {buckets('o_totalprice', [1000, 50000, 200000], list('abcd'), '<=')} as bucket,
               count(*) as orders from orders group by 1""",
    "b05_label_map": f"""
        select {choose('o_orderpriority', METHOD_OF, "replace(lower(o_orderpriority), '_', ' ')")}
                   as label, count(*) as orders from orders group by 1""",
    "b07_three_valued_flag": """
        select case when shipped > promise then 1 when shipped <= promise then 0 end as is_late,
               count(*) as items,
               cast(sum(date_diff('day', cast(promise as date), cast(shipped as date))) as bigint)
                   as delay_days
        from (select o_orderdate + to_days(21) as promise,
                     case when o_orderstatus <> 'P' then l_shipdate end as shipped
              from lineitem left join orders on o_orderkey = l_orderkey)
        group by 1""",
    "c01_left_enrichment": """
        select coalesce(o_orderstatus, 'none') as status, count(*) as events
        from events left join orders on o_orderkey = user_id * 40 group by 1""",
    "c03_resolve_key": """
        select coalesce(c_nationkey, -1) as c_nationkey, count(*) as orders
        from orders left join (select * from customer where c_nationkey < 12) on c_custkey = o_custkey
        group by 1""",
    "c04_date_roles": """
        select a.year_quarter as purchased_in, b.year_quarter as delivered_in, count(*) as items
        from fact_order_items f join dim_date a on a.date_key = f.purchase_date_key
        join dim_date b on b.date_key = f.delivered_date_key group by 1, 2""",
    "c06_semi_join": """
        select l_returnflag, count(*) as items, count(distinct l_orderkey) as orders
        from lineitem
        where l_orderkey in (select o_orderkey from orders where o_orderpriority = '1-URGENT')
        group by 1""",
    "c11_orphans": """
        select 'lineitem' as "table", 'l_partkey' as "column", l_partkey as "value", count(*) as "rows" from lineitem
        where l_partkey not in (select p_partkey from part where p_size < 25) group by 3
        union all
        select 'lineitem', 'l_suppkey', l_suppkey, count(*) from lineitem
        where l_suppkey not in (select s_suppkey from supplier where s_nationkey < 20) group by 3""",
    "c11d_orphans_by_range": """
        select 'events' as "table", 'user_id' as "column", user_id as "value", count(*) as "rows" from events
        where user_id not in (select s_suppkey from supplier) group by 3
        union all
        select 'lineitem', 'l_suppkey', l_suppkey, count(*) from lineitem
        where l_suppkey not in (select s_suppkey from supplier where s_nationkey < 20) group by 3""",
    "d06_most_frequent": """
        select user_id, event_type
        from (select user_id, event_type,
                     row_number() over (partition by user_id order by count(*) desc, event_type) as k
              from events where event_type is not null group by 1, 2)
        where k = 1""",
    "d07_ratios": f"""
        select l_linestatus,
               {mean("case when l_returnflag = 'R' then 100 else 0 end", 4)} as returned_pct,
               {r('cast(sum(charge * tax) * 100 as double) / cast(sum(charge) as double)', 4)} as tax_pct,
               {mean("case when l_returnflag = 'R' then charge end", 2)} as avg_returned
        from (select *, cast(l_extendedprice as decimal(18, 2)) as charge,
                     cast(l_tax as decimal(6, 2)) as tax from lineitem)
        group by 1""",
    "e01_dedup": """
        select * exclude (k)
        from (select *, row_number() over (
                  partition by l_orderkey, l_linenumber
                  order by l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
                           l_returnflag, l_linestatus, l_shipdate) as k
              from lineitem)
        where k = 1""",
    "e02_dense_key": """
        select row_number() over (order by cast(o_orderkey as varchar)) as order_key,
               cast(o_orderkey as varchar) as order_id from orders""",
    "e05_share_of_group": f"""
        select o_orderpriority, o_orderstatus, orders, {r('share', 6)} as share
        from (select *, cast(orders as double) / sum(orders) over (partition by o_orderpriority) as share
              from (select o_orderpriority, o_orderstatus, count(*) as orders from orders group by 1, 2))""",
    "e06_tiles": """
        select c_custkey, row_number() over (order by c_acctbal, c_custkey) as place,
               cast(ntile(7) over (order by c_acctbal, c_custkey) as integer) as tile
        from customer""",
    "e07_running_total": """
        select o_orderkey, cast(sum(cast(o_totalprice as decimal(18, 2)))
               over (order by o_orderdate, o_orderkey) as double) as running_total
        from orders""",
    "h16_hour_boundaries": """
        select date_diff('hour', ts - to_minutes(event_id % 300), ts) as hours, count(*) as events
        from events group by 1""",
    # dimensions and facts
    "i01_dim_date": """
        select d.*, coalesce(items, 0) as items
        from dim_date d left join (select purchase_date_key as date_key, count(*) as items
                                   from fact_order_items group by 1) using (date_key)""",
    "i02_dim_geography": f"""
        select * replace ({r('latitude', 6)} as latitude, {r('longitude', 6)} as longitude)
        from dim_geography""",
    "i03_dim_customers": "select * from dim_customers",
    "i04_dim_sellers": "select * from dim_sellers",
    "i05_dim_products": "select * from dim_products",
    "i06_dim_order_status": "select * from dim_order_status",
    "i07_dim_payment_type": "select * from dim_payment_type",
    "i08_fact_order_items": f"""
        select * replace ({money('price')} as price, {money('freight_value')} as freight_value,
                          {money('total_item_value')} as total_item_value,
                          {r('buyer_seller_distance_km', 2)} as buyer_seller_distance_km)
        from fact_order_items""",
    "i10_date_keys": """
        select coalesce(d.date_key, -1) as date_key, count(*) as items
        from lineitem left join (select * from dim_date where year between 1996 and 1998) d
        on d.full_date = cast(l_shipdate as date) group by 1""",
    "i11_fact_order_payments": f"""
        select * replace ({money('payment_value')} as payment_value,
                          {money('instalment_amount')} as instalment_amount)
        from fact_order_payments""",
    "i12_fact_order_reviews": "select * from fact_order_reviews",
    # business questions
    "q01_top_category_by_month": _best_category(
        "sold", "sum(price)", "revenue", "year, month, month_name", money("revenue")
    ),
    "q02_top_month_by_year": _best_month("sold", "year, month, month_name"),
    "q03_yearly_revenue_top8": _top8("sold"),
    "q04_cancelled_by_category": _cancelled("viewed", 15),
    "q05_delivery_vs_review": _delivery("sold", "scored", fixed.DELIVERY_DAY_LABELS),
    "q06_price_vs_freight": _price_freight("sold"),
    "q07_size_vs_freight": _size_freight("sold"),
    "q08_weight_vs_freight": _weight_freight("sold", fixed.WEIGHT_LABELS),
    "q09_freight_pct_vs_review": _freight_share("sold", "scored", fixed.FREIGHT_PCT_LABELS),
    "q10_payment_methods_by_month": _methods("paid", "year, month, month_name"),
    "q11_photos_vs_orders": _photos("sold", fixed.PHOTO_LABELS, True),
    "q12_orders_by_hour": _hours("sold"),
    "q13_top_units_by_month": _best_category(
        "sold", "count(*)", "units_sold", "year, month, month_name", "units_sold"
    ),
    "q14_late_rate_by_size": _late_by_size("sold", True),
    "q15_instalments_by_category": _instalments("main_category", "fact_order_payments", 15, True),
    # filters
    "k01_kpi_sales": _kpis("viewed"),
    "k01e_kpi_sales_nothing_chosen": _kpis("(select * from viewed where false)"),
    "k02_filter_options": """
        select distinct 'regions' as filter, region as option from dim_geography where region <> 'Unknown'
        union all select distinct 'customer_states', state from dim_customers where state <> 'XX'
        union all select distinct 'categories', category from dim_products where category <> 'unknown'
        union all select distinct 'payment_labels', payment_label from dim_payment_type
                  where is_valid_method""",
    "k03_date_bounds": """
        select min(full_date) as first_day, max(full_date) as last_day from sold
        where purchase_date_key <> -1""",
    "k04_item_view": _view("viewed"),
    "k07_relabel": """
        select case status_code when 'canceled' then 'Cancelled' when 'unavailable' then 'Unavailable'
                    else replace(status_code, '_', ' ') end as order_status, count(*) as items
        from viewed group by 1""",
    "k06_range_presets": " union all ".join(
        f"""select '{name}' as preset, count(*) as items
            from fact_order_items f join dim_date d on f.purchase_date_key = d.date_key
            where d.full_date between date '{start}' and date '{end}'"""
        for name, start, end in [
            ("all", "1995-01-01", "2001-12-31"),
            ("1997", "1997-01-01", "1997-12-31"),
            ("2001", "2001-01-01", "2001-12-31"),
            ("custom", "1998-02-01", "1998-06-30"),
        ]
    ),
    # further analytics
    "p01_monthly_revenue": f"""
        select year_month, {money('revenue')} as revenue,
               {r('cast((revenue - before) * 100 as double) / nullif(cast(before as double), 0)', 2)}
                   as growth_pct
        from (select *, lag(revenue) over (order by year_month) as before
              from (select d.year_month, coalesce(sum(s.price), 0) as revenue
                    from dim_date d left join sold s on s.purchase_date_key = d.date_key
                    where d.full_date between
                          (select date_trunc('month', min(full_date)) from sold) and
                          (select last_day(max(full_date)) from sold)
                    group by 1))""",
    "p02_top_categories": f"""
        select category, {money('sum(price)')} as revenue, count(*) as items from sold
        group by 1 order by sum(price) desc, category limit 10""",
    "p03_revenue_by_region": f"""
        select region, {money('revenue')} as revenue,
               {r('cast(revenue as double) / cast(sum(revenue) over () as double) * 100', 2)} as share_pct
        from (select customer_region as region, sum(price) as revenue from viewed group by 1)""",
    "p04_avg_price_by_category": f"""
        select category, count(*) as items, {mean('price', 2)} as avg_price from sold
        group by 1 having count(*) >= 30 order by 3 desc, 1 limit 12""",
    "p05_repeat_customers": f"""
        select case when frequency >= {registry.REPEAT_FROM} then 'repeat' else 'one-time' end
                   as customer_type, count(*) as people, {money('sum(monetary)')} as revenue
        from people group by 1""",
    "p05t_repeat_customers_from_two": f"""
        select case when frequency >= 2 then 'repeat' else 'one-time' end as customer_type,
               count(*) as people, {money('sum(monetary)')} as revenue
        from people group by 1""",
    "p05u_unattributed_revenue": f"""
        select count(*) filter (customer_key < 0) as lines_without_customer,
               {money('coalesce(sum(price) filter (customer_key < 0), 0)')} as revenue_without_customer,
               count(*) filter (seller_key < 0) as lines_without_seller,
               {money('coalesce(sum(price) filter (seller_key < 0), 0)')} as revenue_without_seller
        from fact_order_items""",
    "p06_rfm_segments": f"""
        select tile as monetary_tile, count(*) as people, max(last_day) as last_purchase_key,
               {mean('frequency', 2)} as avg_frequency, {money('sum(monetary)')} as revenue,
               {r('cast(sum(monetary) as double) / (select cast(sum(monetary) as double) from people) * 100', 2)}
                   as share_pct
        from (select *, cast(ntile(5) over (order by monetary, person) as integer) as tile from people)
        group by 1""",
    "p07_delivery_kpis": f"""
        select {mean('delivery_days', 2)} as avg_delivery_days,
               {mean('seller_processing_days', 2)} as avg_seller_processing_days,
               {mean('carrier_transit_days', 2)} as avg_carrier_transit_days,
               {mean('is_late_delivery * 100', 2)} as late_rate_pct
        from fact_order_items""",
    "p08_processing_by_seller_state": f"""
        select state as seller_state, count(*) as items,
               {mean('seller_processing_days', 2)} as avg_processing_days
        from fact_order_items join dim_sellers using (seller_key) group by 1 having count(*) >= 50""",
    "p09_late_rate_by_region": f"""
        select customer_region as region, count(*) as items,
               {mean('is_late_delivery * 100', 2)} as late_rate_pct
        from viewed where is_late_delivery is not null group by 1""",
    "p10_lateness_vs_review": _score_by(
        """(select order_id, max(delivery_delay_days) as late from fact_order_items
            where delivery_delay_days is not null group by 1) d join scored using (order_id)""",
        buckets("late", fixed.LATENESS_CUTS, fixed.LATENESS_LABELS),
        "lateness",
    ),
    "p11_payment_method_summary": f"""
        select payment_label, count(distinct order_id) as orders,
               {mean('payment_value', 2)} as avg_payment_value
        from paid group by 1""",
    "p12_instalment_bands": f"""
        select {buckets('payment_installments', fixed.INSTALMENT_CUTS, fixed.INSTALMENT_LABELS, '<=')}
                   as instalments, min(payment_installments) as sort_key, count(*) as payments,
               {mean('payment_value', 2)} as avg_payment_value
        from fact_order_payments where payment_installments >= 1 group by 1""",
    "p13_basket_vs_paid": f"""
        select {buckets('n', fixed.INSTALMENT_CUTS, fixed.INSTALMENT_LABELS, '<=')} as instalments,
               min(n) as sort_key, count(*) as orders, {money('sum(basket)')} as basket_value,
               {money('sum(paid_value)')} as paid_value
        from (select order_id, sum(total_item_value) as basket from fact_order_items group by 1)
        join (select order_id, sum(payment_value) as paid_value, max(payment_installments) as n
              from fact_order_payments group by 1) using (order_id)
        where n >= 1 group by 1""",
    "p14_score_distribution": """
        select review_score, count(*) as reviews from fact_order_reviews group by 1""",
    "p15_review_by_category": """
        (select 'best' as side, * from category_means order by avg_review_score desc, category limit 8)
        union all
        (select 'worst' as side, * from category_means order by avg_review_score, category limit 8)""",
    "p15t_review_by_category_of_fifty": """
        (select 'best' as side, * from category_means where orders >= 50
         order by avg_review_score desc, category limit 8)
        union all
        (select 'worst' as side, * from category_means where orders >= 50
         order by avg_review_score, category limit 8)""",
    "p16_distance_vs_review": _score_by(
        """(select order_id, max(buyer_seller_distance_km) as km from fact_order_items
            where buyer_seller_distance_km is not null group by 1) d join scored using (order_id)""",
        buckets("km", fixed.DISTANCE_CUTS_KM, fixed.DISTANCE_LABELS),
        "distance",
    ),
    "p17_freight_pct_by_category": f"""
        select category, count(*) as items,
               {r('cast(sum(freight_value) * 100 as double) / cast(sum(price) as double)', 2)}
                   as freight_pct
        from sold group by 1 having count(*) >= 50 order by 3 desc, 1 limit 12""",
    "p18_seller_pareto": f"""
        select cast(p as integer) as top_pct, count(*) as sellers, {money('sum(revenue)')} as revenue,
               {r('cast(sum(revenue) * 100 as double) / (select cast(sum(revenue) as double) from by_seller)', 2)}
                   as revenue_share_pct
        from by_seller join (values (1), (5), (10), (20)) as c(p) on k <= ceil(sellers * p / 100.0)
        group by 1""",
    "p18r_seller_running_share": f"""
        select seller_key, k as seller_rank, {money('revenue')} as revenue,
               {money('running')} as running_revenue,
               {r('cast(running * 100 as double) / cast(whole as double)', 4)} as running_share_pct
        from (select *, sum(revenue) over (order by k) as running, sum(revenue) over () as whole
              from by_seller)""",
    "p19_category_pairs": """
        select a.category as category_a, b.category as category_b, count(*) as pairs
        from sold a join sold b on a.order_id = b.order_id and a.category < b.category
        group by 1, 2 order by 3 desc, 1, 2 limit 12""",
    "p19o_category_pairs_in_orders": """
        select a.category as category_a, b.category as category_b,
               count(distinct a.order_id) as pairs
        from sold a join sold b on a.order_id = b.order_id and a.category < b.category
        group by 1, 2 order by 3 desc, 1, 2 limit 12""",
    "p20_split_payment_rate": f"""
        select count(*) as payments, {mean('case when is_split_payment then 100 else 0 end', 4)} as split_pct
        from fact_order_payments""",
    "p21_avg_transaction_value": f"""
        select count(*) as payments, {mean('payment_value', 4)} as avg_payment_value
        from fact_order_payments""",
    "p22_comment_rate": f"""
        select count(*) as reviews, {mean('has_comment * 100', 4)} as comment_pct
        from fact_order_reviews""",
    "p23_avg_review_score": f"""
        select count(*) as reviews, {mean('review_score', 4)} as avg_review_score
        from fact_order_reviews""",
    "p24_item_ratios": f"""
        select {r('cast(sum(freight_value) * 100 as double) / cast(sum(price) as double)', 4)}
                   as freight_pct_of_price, {mean('price', 2)} as avg_price_per_item
        from fact_order_items""",
    # data quality
    "l01_unique": " union all ".join(
        f"""select '{t}' as "table", '{c}' as "column", cast({c} as varchar) as "value", count(*) as n
            from {t} where {c} is not null group by {c} having count(*) > 1"""
        for t, cs in quality.UNIQUE.items()
        for c in cs
    ),
    "l02_not_null": " union all ".join(
        f"""select '{t}' as "table", '{c}' as "column", count(*) as nulls
            from {t} where {c} is null having count(*) > 0"""
        for t, cs in quality.NOT_NULL.items()
        for c in cs
    ),
    "l03_relationships": " union all ".join(
        f"""select '{t}' as "table", '{c}' as "column", cast({c} as bigint) as "value", count(*) as "rows"
            from {t} where {c} is not null and {c} not in (select {key} from {parent}) group by {c}"""
        for t, links in quality.PARENTS.items()
        for c, (parent, key) in links.items()
    ),
    "l04_accepted_values": " union all ".join(
        f"""select '{t}' as "table", '{c}' as "column", cast({c} as varchar) as "value", count(*) as n
            from {t} where {c} not in ({', '.join(text(str(v)) if isinstance(v, str) else str(v) for v in vs)})
            group by {c}"""
        for (t, c), vs in quality.ACCEPTED.items()
    ),
    "l05_grain": " union all ".join(
        f"""select '{t}' as "table", concat_ws(' / ', {a}, {b}) as grain, count(*) as n
            from {t} group by {a}, {b} having count(*) > 1"""
        for t, (a, b) in quality.GRAINS.items()
    ),
    "l06a_accounts": " union all ".join(
        f"""select '{t}' as table_name, records, cast(0 as bigint) as rejected_records, kept as warehouse_rows,
                   records - kept as unaccounted
            from (select (select count(*) from {t}) as kept,
                         (select count(*) from raw_{s.removeprefix('order_')}) as records)"""
        for t, s in quality.STAGED_OF.items()
    ),
    "l06c_row_counts": " union all ".join(
        f"""select '{t}' as table_name, (select count(*) from {t}) as warehouse_rows,
                   (select count(*) from raw_{s.removeprefix('order_')}) as source_rows"""
        for t, s in quality.STAGED_OF.items()
    ),
    "l07t_revenue_totals": f"""
        select {money('(select sum(total_item_value) from fact_order_items)')} as warehouse_total,
               {money('(select sum(price + freight_value) from raw_items)')} as source_total""",
    "l09_negative_durations": " union all ".join(
        f"""select '{c}' as "column", count(*) as "rows" from fact_order_items where {c} < 0
            having count(*) > 0"""
        for c in quality.DURATIONS
    ),
    "l09n_early_deliveries": " union all ".join(
        f"""select '{c}' as "column", count(*) as "rows" from fact_order_items where {c} < 0
            having count(*) > 0"""
        for c in ["delivery_days", "delivery_delay_days"]
    ),
    "l01d_duplicate_lines": """
        select l_orderkey, l_linenumber, count(*) as n from lineitem
        group by 1, 2 having count(*) > 1""",
    "l02n_null_counts": " union all ".join(
        f"""select '{c}' as "column", count(*) as nulls from fact_order_items where {c} is null
            having count(*) > 0"""
        for c in ["price", "delivery_days", "buyer_seller_distance_km", "is_late_delivery"]
    ),
    "l04o_outside_values": """
        select event_type as "value", count(*) as n from events
        where event_type not in ('click', 'view') group by 1""",
}

_PLAIN["q10h_methods_by_month_sketched"] = (
    "select year, month, month_name, payment_label, orders, true as close from "
    f"({_PLAIN['q10_payment_methods_by_month']})"
)
_PLAIN["q12h_orders_by_hour_sketched"] = (
    "select purchase_hour, orders, true as close from ("
    + _hours("(select * from sold where full_date between date '1996-03-01' and date '1999-06-30')")
    + ")"
)
_PLAIN["l06_lost_rows"] = (
    f"select * from ({_PLAIN['l06c_row_counts']}) where warehouse_rows <> source_rows"
)
_PLAIN["l07_revenue_mismatch"] = (
    f"select * from ({_PLAIN['l07t_revenue_totals']}) where warehouse_total <> source_total"
)


def _report() -> str:
    def found(check: str, name: str, pairs, column: bool = True, count: str = "count(*)") -> list[str]:
        rows = []
        for table, col in pairs:
            same = f""" and "column" = '{col}'""" if column else ""
            rows.append(
                f"""select '{check}' as "check", '{table}' as "table", '{col}' as "column",
                    (select cast(coalesce({count}, 0) as bigint) from ({_PLAIN[name]})
                     where "table" = '{table}'{same}) as violations"""
            )
        return rows

    parts = [
        *found("unique", "l01_unique", [(t, c) for t, cs in quality.UNIQUE.items() for c in cs]),
        *found("not_null", "l02_not_null", [(t, c) for t, cs in quality.NOT_NULL.items() for c in cs],
               count="sum(nulls)"),
        *found(
            "relationships",
            "l03_relationships",
            [(t, c) for t, cs in quality.PARENTS.items() for c in cs],
            count='sum("rows")',
        ),
        *found("accepted_values", "l04_accepted_values", list(quality.ACCEPTED)),
        *found("grain", "l05_grain", [(t, "") for t in quality.GRAINS], column=False),
        *[
            f"""select 'rows_kept' as "check", '{t}' as "table", '' as "column",
                (select count(*) from ({_PLAIN['l06_lost_rows']}) where table_name = '{t}')
                    as violations"""
            for t in quality.STAGED_OF
        ],
        f"""select 'revenue' as "check", 'fact_order_items' as "table", '' as "column",
            (select count(*) from ({_PLAIN['l07_revenue_mismatch']})) as violations""",
    ]
    return " union all ".join(parts)


_FILTERED: dict[str, tuple[str, dict[str, str]]] = {
    "k01f_kpi_sales_filtered": (_kpis("passing"), ITEM),
    "k04f_item_view_filtered": (_view("passing"), ITEM),
    "k05_kept_orders": ("select distinct order_id from passing", ITEM),
    "d01_top_category_by_month": (
        _with_month_sort(
            _best_category("kept_sold", "sum(price)", "revenue", "year, month", money("revenue"))
        ),
        ITEM,
    ),
    "d01o_top_category_by_month": (
        _with_month_sort(
            _best_category("kept_sold", "sum(price)", "revenue", "year, month", money("revenue"))
        ),
        ORDER,
    ),
    "d02_top_month_by_year": (_best_month("kept_sold", "year, month"), ITEM),
    "d03_yearly_revenue_top8": (_top8_ordered("kept_sold"), ITEM),
    "d03o_yearly_revenue_top8": (_top8_ordered("kept_sold"), ORDER),
    "d04_cancelled_by_category": (_cancelled("kept_viewed", 10), ITEM),
    "d05_delivery_vs_review": (_delivery("kept_sold", "kept_scored", fixed.DELIVERY_DAY_SHORT), ITEM),
    "d06_price_vs_freight": (_price_freight("passing"), ITEM),
    "d07_size_vs_freight": (_size_freight("passing"), ITEM),
    "d08_weight_vs_freight": (_weight_freight("kept_sold", fixed.WEIGHT_SHORT), ITEM),
    "d09_freight_pct_vs_review": (
        _freight_share("kept_sold", "kept_scored", fixed.FREIGHT_PCT_SHORT),
        ITEM,
    ),
    "d10w_winner_by_month": (_with_month_sort(_winner("kept_paid")), ITEM),
    "d10wo_winner_by_month": (_with_month_sort(_winner("kept_paid")), ORDER),
    "d10s_quarter_mix": (_mix("kept_paid"), ITEM),
    "d10a_quarter_axis": (
        f"select distinct quarter_label, quarter_sort from ({_mix('kept_paid')})",
        ITEM,
    ),
    "d11_photos_vs_orders": (_photos("kept_sold", fixed.PHOTO_SHORT, False), ITEM),
    "d12_orders_by_hour": (_hours("passing"), ITEM),
    "d12p_peak_hour": (f"{_hours('passing')} order by orders desc, purchase_hour limit 1", ITEM),
    "d13_top_units_by_month": (
        _with_month_sort(
            _best_category("kept_sold", "count(*)", "units_sold", "year, month", "units_sold")
        ),
        ITEM,
    ),
    "d14_late_rate_by_size": (_late_by_size("passing", False), ITEM),
    "d15_instalments_by_category": (_instalments("kept_main", "kept_payments", 10, False), ITEM),
}


def statements() -> dict[str, str]:
    out = {name: statement(body) for name, body in _PLAIN.items()}
    out["l08_report"] = statement(_report())
    out |= {name: statement(body, extra) for name, (body, extra) in _FILTERED.items()}
    return {name: out[name] for name in registry.QUERIES if name in out}
