"""Shared CTEs of the oracle statements and the helper that assembles them."""

from __future__ import annotations

import re

CTES: dict[str, str] = {}


def cte(name: str, body: str) -> None:
    CTES[name] = body.strip()


def _uses(text: str) -> list[str]:
    words = set(re.findall(r"[a-z_0-9]+", text))
    return [name for name in CTES if name in words]


def sql(body: str) -> str:
    """``body`` with every CTE it needs, directly or through others, in front."""
    ordered: list[str] = []

    def add(text: str, self_name: str | None = None) -> None:
        for name in _uses(text):
            if name != self_name and name not in ordered:
                add(CTES[name], name)
                if name not in ordered:
                    ordered.append(name)

    add(body)
    if not ordered:
        return body.strip()
    parts = ",\n".join(f"{name} as (\n{CTES[name]}\n)" for name in ordered)
    body = body.strip()
    if body.lower().startswith("with "):
        return f"with {parts},\n{body[5:]}"
    return f"with {parts}\n{body}"


def s_sum(x: str) -> str:
    """Order-independent sum of a double expression (digits below 1e-12 dropped)."""
    f1 = f"((({x}) - floor({x})) * 1e6)"
    f2 = f"(({f1} - floor({f1})) * 1e6)"
    return f"(sum(floor({x})) + (sum(floor({f1})) + sum(floor({f2})) / 1e6) / 1e6)"


def s_total(x: str) -> str:
    return f"coalesce({s_sum(x)}, 0.0)"


def s_avg(x: str) -> str:
    return f"({s_sum(x)} / count({x}))"


def share(condition: str) -> str:
    return f"avg(case when {condition} then 1 else 0 end)"


def days(a: str, b: str) -> str:
    return f"((epoch_us({b}) - epoch_us({a})) / 86400000000.0::double)"


def pseudonym(c: str, prefix: str) -> str:
    return f"'{prefix}_' || substr(sha256('{prefix}:' || cast({c} as varchar)), 1, 16)"


def first_by(table: str, keys: str, order: str) -> str:
    return f"select * from {table} qualify row_number() over (partition by {keys} order by {order}) = 1"


# ---- raw commerce tables -------------------------------------------------

cte(
    "raw_orders",
    """
select o_orderkey as order_id, o_custkey as customer_id,
  case when o_orderkey % 97 = 13 then null when o_orderstatus = 'F' then 'delivered'
       when o_orderstatus = 'O' then 'shipped' when o_orderpriority = '1-URGENT' then 'canceled'
       else 'processing' end as order_status,
  case when o_orderkey % 199 <> 7 then o_orderdate + to_hours(o_orderkey % 24) end as order_purchase_timestamp,
  case when o_orderkey % 50 <> 7
       then o_orderdate + to_hours(o_orderkey % 24) + to_hours((o_custkey % 9) * 5 - 1) end as order_approved_at,
  case when o_orderstatus in ('F', 'O')
       then o_orderdate + to_hours(o_orderkey % 24) + to_hours((1 + o_orderkey % 9) * 24 + 7) end
    as order_delivered_carrier_date,
  case when o_orderstatus = 'F'
       then o_orderdate + to_hours(o_orderkey % 24) + to_hours((o_orderkey % 83 - 2) * 24 + o_custkey % 13) end
    as order_delivered_customer_date,
  o_orderdate + to_hours(60 * 24) as order_estimated_delivery_date
from orders
""",
)
cte(
    "raw_items",
    """
select l_orderkey as order_id, l_linenumber as order_item_id,
  case when not (l_orderkey % 499 = 0 and l_linenumber = 3) then l_partkey end as product_id,
  l_suppkey as seller_id, l_shipdate as shipping_limit_date,
  case when (l_orderkey + l_linenumber) % 211 = 0 then null
       when (l_orderkey * 7 + l_linenumber) % 307 = 0 then -l_extendedprice else l_extendedprice end as price,
  l_extendedprice * l_tax as freight_value
from lineitem
""",
)
cte(
    "raw_customers",
    """
select c_custkey as customer_id, c_custkey // 2 as customer_unique_id,
  cast(c_nationkey * 1000 + c_custkey % 1000 as integer) as customer_zip_code_prefix,
  lower(c_mktsegment || ' ' || cast(c_custkey % 7 as varchar)) as customer_city, n_name as customer_state
from customer left join nation on c_nationkey = n_nationkey
where c_custkey % 60 <> 59
""",
)
cte(
    "raw_sellers",
    """
select s_suppkey as seller_id, cast(s_nationkey * 1000 + s_suppkey % 1000 as integer) as seller_zip_code_prefix,
  'city ' || cast(s_suppkey % 11 as varchar) as seller_city, n_name as seller_state
from supplier left join nation on s_nationkey = n_nationkey
where s_suppkey % 50 <> 49
""",
)
cte(
    "raw_products",
    """
select p_partkey as product_id,
  case when p_partkey % 40 <> 0 then lower(p_type || '_' || substring(p_brand, 7, 2)) end as product_category_name,
  cast(length(p_name) as integer) as product_name_lenght, cast(p_size * 10 as integer) as product_description_lenght,
  cast(p_size % 6 as integer) as product_photos_qty, p_retailprice / 2 as product_weight_g,
  cast(p_size as double) as product_length_cm, cast(p_size % 13 as double) as product_height_cm,
  cast(p_size % 17 as double) as product_width_cm
from part
""",
)
cte(
    "raw_translation",
    """
select product_category_name, 'en_' || product_category_name as product_category_name_english
from (select p_type, case when p_partkey % 40 <> 0
             then lower(p_type || '_' || substring(p_brand, 7, 2)) end as product_category_name from part)
where p_type <> 'PROMO'
""",
)
cte(
    "raw_payments",
    """
select event_id // 3 as order_id, cast(event_id % 3 + 1 as integer) as payment_sequential,
  case user_id % 5 when 0 then 'credit_card' when 1 then 'boleto' when 2 then 'voucher'
       when 3 then 'debit_card' else null end as payment_type,
  cast(user_id % 10 + 1 as integer) as payment_installments,
  case when event_id % 89 <> 0 then value * 100 end as payment_value
from events where event_type in ('purchase', 'click')
""",
)
cte(
    "raw_reviews",
    """
select event_id // 2 as review_id, event_id // 3 as order_id, cast(event_id % 5 + 1 as integer) as review_score,
  case user_id % 3 when 0 then '  ' when 1 then null else props end as review_comment_message,
  ts as review_creation_date, ts + to_hours(48 + user_id % 24) as review_answer_timestamp
from events where event_type in ('view', 'signup')
""",
)

# ---- cleaned tables ------------------------------------------------------

cte(
    "orders_clean",
    """
select * from raw_orders where order_id is not null and customer_id is not null
qualify row_number() over (partition by order_id order by order_purchase_timestamp nulls first) = 1
""",
)
cte(
    "items_clean",
    """
select distinct * from raw_items
where order_id is not null and order_item_id is not null and product_id is not null and seller_id is not null
  and coalesce(price, 0) >= 0 and coalesce(freight_value, 0) >= 0
""",
)
cte(
    "customers_clean",
    """
select * from raw_customers where customer_id is not null
qualify row_number() over (partition by customer_id order by customer_unique_id nulls first) = 1
""",
)
cte(
    "products_clean",
    """
select * from raw_products where product_id is not null
qualify row_number() over (partition by product_id order by product_category_name nulls first) = 1
""",
)
cte(
    "sellers_clean",
    """
select * from raw_sellers where seller_id is not null
qualify row_number() over (partition by seller_id order by seller_state nulls first) = 1
""",
)
cte(
    "translation_clean",
    """
select * from raw_translation where product_category_name is not null
qualify row_number() over (partition by product_category_name order by product_category_name_english) = 1
""",
)

# most frequent value, smallest on a tie: rank by (count desc, value)
cte(
    "payment_modes",
    """
select order_id, payment_type as payment_type_mode
from (select order_id, payment_type, count(*) as n from raw_payments
      where payment_type is not null group by all)
qualify row_number() over (partition by order_id order by n desc, payment_type) = 1
""",
)
cte(
    "payments_agg",
    f"""
select p.*, m.payment_type_mode from (
  select order_id, count(payment_sequential) as payment_count,
    {s_total("payment_value")} as total_payment_value,
    max(payment_installments) as max_payment_installments
  from (select distinct * from raw_payments) group by order_id) p
left join payment_modes m on p.order_id is not distinct from m.order_id
""",
)
cte(
    "reviews_agg",
    """
select order_id, count(review_id) as review_count, avg(review_score) as review_score_mean,
  max(review_score) as review_score_max, min(review_score) as review_score_min,
  max(review_creation_date) as latest_review_creation_date,
  max(review_answer_timestamp) as latest_review_answer_timestamp,
  max(case when trim(coalesce(review_comment_message, '')) <> '' then 1 else 0 end) as has_review_comment
from (select distinct * from raw_reviews) group by order_id
""",
)

# ---- fact ----------------------------------------------------------------

cte(
    "joined",
    f"""
select i.*, o.* exclude (order_id), c.* exclude (customer_id), p.* exclude (product_id),
  t.product_category_name_english, s.* exclude (seller_id), pay.* exclude (order_id), rev.* exclude (order_id),
  {days("o.order_purchase_timestamp", "o.order_delivered_customer_date")} as delivery_time_days,
  coalesce(o.order_delivered_customer_date > o.order_estimated_delivery_date, false) as is_delayed
from items_clean i
left join orders_clean o on i.order_id = o.order_id
left join customers_clean c on o.customer_id = c.customer_id
left join products_clean p on i.product_id = p.product_id
left join sellers_clean s on i.seller_id = s.seller_id
left join payments_agg pay on i.order_id = pay.order_id
left join reviews_agg rev on i.order_id = rev.order_id
left join translation_clean t on p.product_category_name = t.product_category_name
""",
)
cte(
    "seller_feats",
    f"""
select seller_id, count(distinct order_id) as seller_order_count,
  {s_avg("delivery_time_days")} as seller_avg_delivery_days,
  avg(case when is_delayed then 1 else 0 end) as seller_delay_rate
from joined group by seller_id
""",
)
cte(
    "first_feats",
    """
select customer_unique_id, min(order_purchase_timestamp) as customer_first_purchase_timestamp
from joined where customer_unique_id is not null group by 1
""",
)
cte(
    "order_seq",
    """
select order_id, dense_rank() over (partition by customer_unique_id order by ts) as customer_order_sequence
from (select customer_unique_id, order_id, min(order_purchase_timestamp) as ts
      from joined where order_purchase_timestamp is not null group by 1, 2)
""",
)
cte(
    "fact",
    f"""
select j.order_id, j.order_item_id, j.customer_id, j.customer_unique_id, j.product_id, j.seller_id, j.order_status,
  j.order_purchase_timestamp, j.order_approved_at, j.shipping_limit_date, j.order_delivered_carrier_date,
  j.order_delivered_customer_date, j.order_estimated_delivery_date,
  cast(j.order_purchase_timestamp as date) as order_date,
  cast(year(j.order_purchase_timestamp) as integer) as order_year,
  cast(month(j.order_purchase_timestamp) as integer) as order_month,
  strftime(j.order_purchase_timestamp, '%Y-%m') as purchase_cohort_month,
  f.customer_first_purchase_timestamp,
  cast((year(j.order_purchase_timestamp) - year(f.customer_first_purchase_timestamp)) * 12
    + month(j.order_purchase_timestamp) - month(f.customer_first_purchase_timestamp) as integer)
    as cohort_order_month_number,
  q.customer_order_sequence, q.customer_order_sequence = 1 as is_first_order, j.delivery_time_days,
  {days("j.order_approved_at", "j.order_delivered_carrier_date")} as seller_dispatch_time_days,
  {days("j.order_delivered_carrier_date", "j.order_delivered_customer_date")} as carrier_delivery_time_days,
  {days("j.order_estimated_delivery_date", "j.order_delivered_customer_date")} as estimated_delay_days,
  j.is_delayed, j.price, j.freight_value,
  case when j.price > 0 then j.freight_value / j.price end as freight_to_price_ratio,
  coalesce(j.price, 0) + coalesce(j.freight_value, 0) as total_item_value,
  j.payment_count, j.total_payment_value, j.max_payment_installments, j.payment_type_mode,
  j.review_count, j.review_score_mean, j.review_score_max, j.review_score_min, j.has_review_comment,
  j.latest_review_creation_date, j.latest_review_answer_timestamp,
  j.product_category_name, j.product_category_name_english, j.product_name_lenght, j.product_description_lenght,
  j.product_photos_qty, j.product_weight_g, j.product_length_cm, j.product_height_cm, j.product_width_cm,
  j.customer_zip_code_prefix, j.customer_city, j.customer_state,
  j.seller_zip_code_prefix, j.seller_city, j.seller_state,
  s.seller_order_count, s.seller_avg_delivery_days, s.seller_delay_rate,
  case when s.seller_order_count <= 490 then 'long_tail' when s.seller_order_count <= 560 then 'scaled'
       when s.seller_order_count <= 610 then 'core' else 'strategic' end as seller_volume_tier
from joined j
left join first_feats f on j.customer_unique_id = f.customer_unique_id
left join order_seq q on j.order_id = q.order_id
left join seller_feats s on j.seller_id = s.seller_id
where j.order_purchase_timestamp is not null and (j.delivery_time_days is null or j.delivery_time_days >= 0)
qualify row_number() over (partition by j.order_id, j.order_item_id, j.product_id, j.seller_id
  order by j.shipping_limit_date nulls first, j.price nulls first, j.freight_value nulls first) = 1
""",
)


# ---- registry ------------------------------------------------------------

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
TIERS = (490, 560, 610)


def query(name: str, statement: str | None = None):
    """Register ``fn(spark, root)`` under ``name``, with its SQL where there is one."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if statement is not None:
            ORACLE[name] = statement
        return fn

    return register
