"""Cleaning, joins, fact features (ids B, C, D1-D6, E1-E5, H)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradeledger.functions import scalars as sc
from tradeledger.operators import aggregates as agg
from tradeledger.operators import cleaning as cl
from tradeledger.operators import cohorts, joins
from tradeledger.plans.fact import build_fact_whole_days
from tradeledger.plans.published import publish, publish_md5
from tradeledger.plans.star import normalise_for_bi
from tradeledger.sources.commerce import commerce, table
from workload.base import TIERS, cte, days, first_by, pseudonym, query, s_avg, s_sum
from workload.inputs import fact, published


# ---- B -------------------------------------------------------------------


@query(
    "coerce_datetime_columns",
    """
select order_id, try_cast(case when order_id % 7 = 0 then 'not a date'
    else strftime(order_purchase_timestamp, '%Y-%m-%d %H:%M:%S') end as timestamp) as order_purchase_timestamp,
  try_cast(strftime(order_approved_at, '%Y-%m-%d %H:%M:%S') as timestamp) as order_approved_at, order_status
from raw_orders
""",
)
def _(spark, root):
    texts = commerce(spark, root).orders.select(
        "order_id",
        F.when(F.col("order_id") % 7 == 0, "not a date")
        .otherwise(F.date_format("order_purchase_timestamp", "yyyy-MM-dd HH:mm:ss"))
        .alias("order_purchase_timestamp"),
        F.date_format("order_approved_at", "yyyy-MM-dd HH:mm:ss").alias("order_approved_at"),
        "order_status",
    )
    parsed = cl.parse_date_columns(texts)
    return parsed.withColumns({c: F.col(c).cast("timestamp_ntz") for c in parsed.columns if cl.date_like(c)})


@query("full_row_dedup", "select distinct l_orderkey, l_linenumber, l_returnflag, l_linestatus from lineitem")
def _(spark, root):
    lines = table(spark, root, "lineitem")
    return cl.distinct_rows(lines.select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus"))


@query(
    "subset_dedup_keep_first",
    first_by(
        "raw_items",
        "order_id, order_item_id",
        "shipping_limit_date nulls first, product_id nulls first, seller_id nulls first, price nulls first, "
        "freight_value nulls first",
    ),
)
def _(spark, root):
    return cl.keep_one(commerce(spark, root).items, ["order_id", "order_item_id"], ["shipping_limit_date"])


query("clean_orders", "select * from orders_clean")(lambda s, r: cl.clean_orders(commerce(s, r).orders))
query("clean_order_items", "select * from items_clean")(lambda s, r: cl.clean_items(commerce(s, r).items))
query("clean_customers", "select * from customers_clean")(lambda s, r: cl.clean_customers(commerce(s, r).customers))
query("clean_products", "select * from products_clean")(lambda s, r: cl.clean_products(commerce(s, r).products))
query("clean_sellers", "select * from sellers_clean")(lambda s, r: cl.clean_sellers(commerce(s, r).sellers))
query("clean_translation", "select * from translation_clean")(
    lambda s, r: cl.clean_translation(commerce(s, r).translation)
)

cte(
    "items_staged",
    first_by(
        "(select * from raw_items where order_id is not null and product_id is not null and seller_id is not null "
        "and price >= 0 and freight_value >= 0)",
        "order_id, order_item_id, product_id, seller_id",
        "shipping_limit_date nulls first, price, freight_value",
    ),
)
cte(
    "reviews_staged",
    first_by(
        "(select * from raw_reviews where order_id is not null)",
        "review_id",
        "review_creation_date nulls first, order_id, review_score, review_comment_message nulls first, "
        "review_answer_timestamp",
    ),
)
query("staging_order_items", "select * from items_staged")(lambda s, r: cl.stage_items(commerce(s, r).items))
query("staging_payments", "select * from raw_payments where order_id is not null")(
    lambda s, r: cl.stage_payments(commerce(s, r).payments)
)
query("staging_reviews", "select * from reviews_staged")(lambda s, r: cl.stage_reviews(commerce(s, r).reviews))


@query(
    "post_join_sanity_filter",
    """
select order_id, order_item_id, product_id, seller_id, price, freight_value, delivery_time_days from fact
""",
)
def _(spark, root):
    return fact(spark, root).select(
        "order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value", "delivery_time_days"
    )


@query(
    "rejected_rows_with_reason",
    """
select *, concat_ws('|',
  case when order_id is null then 'missing_order_id' end,
  case when order_item_id is null then 'missing_order_item_id' end,
  case when product_id is null then 'missing_product_id' end,
  case when seller_id is null then 'missing_seller_id' end,
  case when coalesce(price, 0) < 0 then 'negative_price' end,
  case when coalesce(freight_value, 0) < 0 then 'negative_freight' end) as rejection_reason
from raw_items
where order_id is null or order_item_id is null or product_id is null or seller_id is null
  or coalesce(price, 0) < 0 or coalesce(freight_value, 0) < 0
""",
)
def _(spark, root):
    return cl.split_rejected(commerce(spark, root).items, cl.item_rejections())[1]


cte(
    "published",
    f"""
select {pseudonym("order_id", "order_id")} as order_id, order_item_id,
  {pseudonym("customer_unique_id", "customer_unique_id")} as customer_unique_id,
  coalesce(order_status, 'unknown') as order_status, order_purchase_timestamp, order_delivered_customer_date,
  order_estimated_delivery_date, order_date, order_year, order_month, purchase_cohort_month,
  cohort_order_month_number, customer_order_sequence, is_first_order,
  {pseudonym("seller_id", "seller_id")} as seller_key, coalesce(seller_volume_tier, 'long_tail') as seller_volume_tier,
  seller_order_count, seller_avg_delivery_days, seller_delay_rate, delivery_time_days, seller_dispatch_time_days,
  carrier_delivery_time_days, estimated_delay_days, is_delayed, price, freight_value, freight_to_price_ratio,
  total_item_value, coalesce(payment_type_mode, 'unknown') as payment_type_mode, review_score_mean,
  product_category_name, product_category_name_english, coalesce(customer_state, 'NA') as customer_state,
  coalesce(seller_state, 'NA') as seller_state
from fact
""",
)
query("published_projection", "select * from published")(published)


@query(
    "published_projection_md5",
    """
select order_id, order_item_id, customer_unique_id, order_status, order_purchase_timestamp,
  order_delivered_customer_date, order_estimated_delivery_date, order_date, order_year, order_month,
  purchase_cohort_month, cohort_order_month_number, customer_order_sequence, is_first_order,
  md5(cast(seller_id as varchar)) as seller_key, seller_volume_tier, seller_order_count, seller_avg_delivery_days,
  seller_delay_rate, delivery_time_days, seller_dispatch_time_days, carrier_delivery_time_days,
  estimated_delay_days, is_delayed, price, freight_value, freight_to_price_ratio, total_item_value,
  coalesce(payment_type_mode, 'unknown') as payment_type_mode, review_score_mean, product_category_name,
  product_category_name_english, customer_state, seller_state
from fact_whole_days
""",
)
def _(spark, root):
    return publish_md5(build_fact_whole_days(commerce(spark, root), TIERS))


cte(
    "bi_input",
    """
select * exclude (payment_type_mode, order_status, customer_state, seller_state, is_delayed),
  trim(coalesce(product_category_name_english, product_category_name, 'unknown')) as category_label,
  trim(coalesce(payment_type_mode, 'unknown')) as payment_type_mode,
  trim(coalesce(order_status, 'unknown')) as order_status, trim(coalesce(customer_state, 'NA')) as customer_state,
  trim(coalesce(seller_state, 'NA')) as seller_state, coalesce(is_delayed, false) as is_delayed
from fact
""",
)
query("bi_input_normalisation", "select * from bi_input")(lambda s, r: normalise_for_bi(fact(s, r)))

# ---- C -------------------------------------------------------------------

query("fact_orders_enriched", "select * from fact")(fact)

cte(
    "cohort_all_orders",
    """
select order_id, customer_first_purchase_timestamp,
  cast((year(ts) - year(customer_first_purchase_timestamp)) * 12
    + month(ts) - month(customer_first_purchase_timestamp) as integer) as cohort_order_month_number,
  case when ts is not null then dense_rank() over (partition by customer_unique_id order by ts) end
    as customer_order_sequence
from (select o.order_id, o.order_purchase_timestamp as ts, c.customer_unique_id,
        min(o.order_purchase_timestamp) over (partition by c.customer_unique_id) as customer_first_purchase_timestamp
      from orders_clean o join customers_clean c on o.customer_id = c.customer_id
      where c.customer_unique_id is not null)
""",
)
cte(
    "seller_whole_days",
    """
select seller_id, count(distinct order_id) as seller_order_count, avg(d) as seller_avg_delivery_days,
  avg(late) as seller_delay_rate
from (select i.seller_id, i.order_id,
        datediff('day', o.order_purchase_timestamp, o.order_delivered_customer_date) as d,
        case when o.order_delivered_customer_date > o.order_estimated_delivery_date then 1 else 0 end as late
      from items_staged i left join orders_clean o on i.order_id = o.order_id)
group by seller_id
""",
)
cte(
    "payments_staged_agg",
    f"""
select p.*, m.payment_type_mode from (
  select order_id, count(payment_sequential) as payment_count, {s_sum("payment_value")} as total_payment_value,
    max(payment_installments) as max_payment_installments from raw_payments group by order_id) p
left join payment_modes m on p.order_id is not distinct from m.order_id
""",
)
cte(
    "reviews_staged_agg",
    """
select order_id, count(review_id) as review_count, avg(review_score) as review_score_mean,
  max(review_score) as review_score_max, min(review_score) as review_score_min,
  max(review_creation_date) as latest_review_creation_date,
  max(review_answer_timestamp) as latest_review_answer_timestamp,
  max(case when trim(coalesce(review_comment_message, '')) <> '' then 1 else 0 end) as has_review_comment
from reviews_staged group by order_id
""",
)


def _whole(a: str, b: str) -> str:
    return f"cast(datediff('day', {a}, {b}) as integer)"


cte(
    "fact_whole_days",
    f"""
select i.order_id, i.order_item_id, o.customer_id, c.customer_unique_id, i.product_id, i.seller_id, o.order_status,
  o.order_purchase_timestamp, o.order_approved_at, i.shipping_limit_date, o.order_delivered_carrier_date,
  o.order_delivered_customer_date, o.order_estimated_delivery_date,
  cast(o.order_purchase_timestamp as date) as order_date,
  cast(year(o.order_purchase_timestamp) as integer) as order_year,
  cast(month(o.order_purchase_timestamp) as integer) as order_month,
  strftime(o.order_purchase_timestamp, '%Y-%m') as purchase_cohort_month,
  h.customer_first_purchase_timestamp, h.cohort_order_month_number, h.customer_order_sequence,
  h.customer_order_sequence = 1 as is_first_order,
  {_whole("o.order_purchase_timestamp", "o.order_delivered_customer_date")} as delivery_time_days,
  {_whole("o.order_approved_at", "o.order_delivered_carrier_date")} as seller_dispatch_time_days,
  {_whole("o.order_delivered_carrier_date", "o.order_delivered_customer_date")} as carrier_delivery_time_days,
  {_whole("o.order_estimated_delivery_date", "o.order_delivered_customer_date")} as estimated_delay_days,
  coalesce(o.order_delivered_customer_date > o.order_estimated_delivery_date, false) as is_delayed,
  i.price, i.freight_value, case when i.price > 0 then i.freight_value / i.price end as freight_to_price_ratio,
  i.price + i.freight_value as total_item_value,
  pay.* exclude (order_id), rev.* exclude (order_id), p.* exclude (product_id), t.product_category_name_english,
  c.customer_zip_code_prefix, c.customer_city, c.customer_state, s.* exclude (seller_id), m.* exclude (seller_id),
  case when m.seller_order_count <= 490 then 'long_tail' when m.seller_order_count <= 560 then 'scaled'
       when m.seller_order_count <= 610 then 'core' else 'strategic' end as seller_volume_tier
from items_staged i
left join orders_clean o on i.order_id = o.order_id
left join customers_clean c on o.customer_id = c.customer_id
left join products_clean p on i.product_id = p.product_id
left join sellers_clean s on i.seller_id = s.seller_id
left join payments_staged_agg pay on i.order_id = pay.order_id
left join reviews_staged_agg rev on i.order_id = rev.order_id
left join translation_clean t on p.product_category_name = t.product_category_name
left join seller_whole_days m on i.seller_id = m.seller_id
left join cohort_all_orders h on i.order_id = h.order_id
where o.order_purchase_timestamp is not null
  and (datediff('day', o.order_purchase_timestamp, o.order_delivered_customer_date) is null
       or datediff('day', o.order_purchase_timestamp, o.order_delivered_customer_date) >= 0)
""",
)
query("fact_orders_enriched_whole_days", "select * from fact_whole_days")(
    lambda s, r: build_fact_whole_days(commerce(s, r), TIERS)
)


@query(
    "many_to_one_cardinality_assertion",
    """
select i.order_id, i.order_item_id, s.seller_state
from raw_items i left join sellers_clean s on i.seller_id = s.seller_id
""",
)
def _(spark, root):
    t = commerce(spark, root)
    joined = joins.left_join_m1(t.items, t.sellers.select("seller_id", "seller_state"), ["seller_id"])
    return joined.select("order_id", "order_item_id", "seller_state")


@query(
    "orders_with_known_customer",
    """
select o.order_id, o.order_purchase_timestamp, c.customer_unique_id
from orders_clean o join customers_clean c on o.customer_id = c.customer_id where c.customer_unique_id is not null
""",
)
def _(spark, root):
    t = commerce(spark, root)
    orders = joins.left_join_m1(
        cl.clean_orders(t.orders), cl.clean_customers(t.customers), ["customer_id"], keyed=True
    )
    return orders.filter("customer_unique_id is not null").select(
        "order_id", "order_purchase_timestamp", "customer_unique_id"
    )


def _seller_metrics(spark, root, duration, items):
    return agg.seller_metrics(
        items,
        cl.clean_orders(commerce(spark, root).orders),
        duration("order_purchase_timestamp", "order_delivered_customer_date"),
        sc.later_than("order_delivered_customer_date", "order_estimated_delivery_date"),
        TIERS,
    )


TIER_SQL = """case when seller_order_count <= 490 then 'long_tail' when seller_order_count <= 560 then 'scaled'
  when seller_order_count <= 610 then 'core' else 'strategic' end as seller_volume_tier"""


@query("seller_metrics_whole_days", f"select *, {TIER_SQL} from seller_whole_days")
def _(spark, root):
    return _seller_metrics(spark, root, sc.whole_days_between, cl.stage_items(commerce(spark, root).items))


@query("seller_features", f"select *, {TIER_SQL} from seller_feats")
def _(spark, root):
    return _seller_metrics(spark, root, sc.days_between, cl.clean_items(commerce(spark, root).items))


@query(
    "natural_to_surrogate_key_lookup",
    """
select f.order_id, f.order_item_id, f.product_id, f.seller_id, d.payment_key
from bi_input f join (select payment_type_mode as p, row_number() over (order by payment_type_mode) as payment_key
  from (select distinct payment_type_mode from bi_input)) d on f.payment_type_mode = d.p
""",
)
def _(spark, root):
    from tradeledger.plans.star import dim_payment, lookup

    rows = normalise_for_bi(fact(spark, root))
    keyed = lookup(rows, dim_payment(rows), "payment_type_mode", "payment_type", "payment_key")
    return keyed.select("order_id", "order_item_id", "product_id", "seller_id", "payment_key")


@query(
    "referential_integrity_missing_keys",
    """
select distinct seller_id from raw_items
where seller_id is not null and seller_id not in (select seller_id from raw_sellers)
""",
)
def _(spark, root):
    t = commerce(spark, root)
    return joins.missing_keys(t.items, "seller_id", t.sellers, "seller_id")


# ---- D1-D6 ---------------------------------------------------------------

query("payments_per_order", "select * from payments_agg")(
    lambda s, r: agg.payments_by_order(cl.distinct_rows(commerce(s, r).payments))
)
query("payments_per_order_staged", "select * from payments_staged_agg")(
    lambda s, r: agg.payments_by_order(cl.stage_payments(commerce(s, r).payments), null_total_as_zero=False)
)
query("reviews_per_order", "select * from reviews_agg")(
    lambda s, r: agg.reviews_by_order(cl.distinct_rows(commerce(s, r).reviews))
)
query("reviews_per_order_staged", "select * from reviews_staged_agg")(
    lambda s, r: agg.reviews_by_order(cl.stage_reviews(commerce(s, r).reviews))
)


@query(
    "mode_smallest_on_tie",
    """
select l_suppkey, any_value(flag) as modal_flag from (
  select l_suppkey, l_returnflag || l_linestatus as flag,
    row_number() over (partition by l_suppkey order by count(*) desc, l_returnflag || l_linestatus) as rn
  from lineitem group by 1, 2) where rn = 1 group by 1
""",
)
def _(spark, root):
    lines = table(spark, root, "lineitem")
    flag = F.concat("l_returnflag", "l_linestatus")
    return lines.groupBy("l_suppkey").agg(F.mode(flag, deterministic=True).alias("modal_flag"))


# ---- E1-E5, H ------------------------------------------------------------


def _active_orders(spark, root):
    t = commerce(spark, root)
    items = cl.clean_items(t.items).select("order_id").distinct()
    orders = cl.clean_orders(t.orders).join(items, "order_id", "left_semi")
    return joins.left_join_m1(orders, cl.clean_customers(t.customers), ["customer_id"], keyed=True)


query("customer_first_purchase", "select * from first_feats")(
    lambda s, r: cohorts.first_purchase(_active_orders(s, r))
)


@query(
    "customer_order_sequence",
    """
select distinct j.customer_unique_id, j.order_purchase_timestamp, q.customer_order_sequence
from joined j join order_seq q on j.order_id = q.order_id
""",
)
def _(spark, root):
    ranked = cohorts.purchase_sequence(_active_orders(spark, root))
    return ranked.select("customer_group.customer_unique_id", "order_purchase_timestamp", "customer_order_sequence")


@query(
    "cohort_month_offset",
    """
select o.order_id, cast((year(o.order_purchase_timestamp) - year(f.customer_first_purchase_timestamp)) * 12
  + month(o.order_purchase_timestamp) - month(f.customer_first_purchase_timestamp) as integer) as month_offset
from orders_clean o join customers_clean c on o.customer_id = c.customer_id
join first_feats f on c.customer_unique_id = f.customer_unique_id
where o.order_id in (select order_id from items_clean)
""",
)
def _(spark, root):
    orders = _active_orders(spark, root)
    first = cohorts.first_purchase(orders)
    return orders.join(first, "customer_unique_id").select(
        "order_id", sc.month_offset("customer_first_purchase_timestamp", "order_purchase_timestamp").alias("month_offset")
    )


@query(
    "seller_volume_tier_binning",
    """
select s_suppkey, case when s_acctbal <= 25 then 'long_tail' when s_acctbal <= 100 then 'scaled'
  when s_acctbal <= 500 then 'core' else 'strategic' end as tier from supplier
""",
)
def _(spark, root):
    supplier = table(spark, root, "supplier")
    return supplier.select("s_suppkey", sc.bins("s_acctbal", agg.TIER_BOUNDS, agg.TIER_LABELS).alias("tier"))


@query(
    "date_functions",
    f"""
select order_id, cast(year(order_purchase_timestamp) as integer) as y,
  cast(month(order_purchase_timestamp) as integer) as m, cast(order_purchase_timestamp as date) as d,
  strftime(order_purchase_timestamp, '%Y-%m') as ym,
  {days("order_purchase_timestamp", "order_delivered_customer_date")} as frac_days,
  cast(datediff('day', order_purchase_timestamp, order_delivered_customer_date) as integer) as whole_days,
  coalesce(order_delivered_customer_date > order_estimated_delivery_date, false) as late,
  cast(strftime(order_purchase_timestamp, '%Y%m%d') as integer) as date_key,
  'Q' || cast(quarter(order_purchase_timestamp) as varchar) as quarter,
  strftime(order_purchase_timestamp, '%b') as month_name, strftime(order_purchase_timestamp, '%A') as weekday_name,
  cast(weekofyear(order_purchase_timestamp) as integer) as iso_week,
  cast(year(order_estimated_delivery_date) as varchar) || '-' ||
    lpad(cast(month(order_estimated_delivery_date) as varchar), 2, '0') as padded_month
from raw_orders
""",
)
def _(spark, root):
    ts = "order_purchase_timestamp"
    return commerce(spark, root).orders.select(
        "order_id",
        F.year(ts).alias("y"),
        F.month(ts).alias("m"),
        F.to_date(ts).alias("d"),
        sc.month_key(ts).alias("ym"),
        sc.days_between(ts, "order_delivered_customer_date").alias("frac_days"),
        sc.whole_days_between(ts, "order_delivered_customer_date").alias("whole_days"),
        sc.later_than("order_delivered_customer_date", "order_estimated_delivery_date").alias("late"),
        sc.date_key(ts).alias("date_key"),
        F.concat(F.lit("Q"), F.quarter(ts).cast("string")).alias("quarter"),
        F.date_format(ts, "MMM").alias("month_name"),
        F.date_format(ts, "EEEE").alias("weekday_name"),
        F.weekofyear(ts).alias("iso_week"),
        sc.month_key_from_parts(
            F.year("order_estimated_delivery_date"), F.month("order_estimated_delivery_date")
        ).alias("padded_month"),
    )


@query(
    "string_and_hash_functions",
    f"""
select p_partkey, {pseudonym("p_partkey", "product_id")} as token, md5(cast(p_partkey as varchar)) as md5_key,
  case when p_size = 7 then sha256('') else sha256(p_name) end as hashed,
  case p_type when 'ECONOMY' then 'Low' when 'SMALL' then 'Low' when 'PROMO' then 'Campaign' else 'Other' end as grouped,
  try_cast(case when p_size % 3 = 0 then 'x' || p_size else cast(p_retailprice as varchar) end as double) as number_or_null,
  concat_ws('_', p_brand, cast(p_size as varchar)) as joined_key,
  upper(substr(p_type, 1, 1)) || lower(substr(p_type, 2)) as display,
  case when p_retailprice > 1000 then p_size / p_retailprice end as guarded_ratio
from part
""",
)
def _(spark, root):
    part = table(spark, root, "part")
    maybe = F.when(F.col("p_size") % 3 == 0, F.concat(F.lit("x"), F.col("p_size").cast("string")))
    return part.select(
        "p_partkey",
        sc.pseudonym("p_partkey", "product_id").alias("token"),
        sc.md5_key("p_partkey").alias("md5_key"),
        sc.hashed(F.when(F.col("p_size") != 7, F.col("p_name"))).alias("hashed"),
        sc.mapped("p_type", {"ECONOMY": "Low", "SMALL": "Low", "PROMO": "Campaign"}).alias("grouped"),
        sc.try_number(maybe.otherwise(F.col("p_retailprice").cast("string"))).alias("number_or_null"),
        F.concat_ws("_", "p_brand", F.col("p_size").cast("string")).alias("joined_key"),
        sc.display_label("p_type").alias("display"),
        sc.ratio_if_positive("p_size", F.when(F.col("p_retailprice") > 1000, F.col("p_retailprice"))).alias(
            "guarded_ratio"
        ),
    )


@query(
    "masking_functions",
    r"""
select doc_id,
  case when strpos(text, '@') = 0 then '***' else
    case when strpos(text, '@') > 1 then substr(text, 1, 1) || '***' else '***' end
    || '@' || substr(text, strpos(text, '@') + 1) end as email,
  case when length(d) >= 11 then '***.***.***-' || right(d, 2) else '***.***.***-**' end as cpf,
  case when length(d) >= 14 then '**.***.***/****-' || right(d, 2) else '**.***.***/****-**' end as cnpj,
  case when length(d) >= 4 then repeat('*', length(d) - 4) || right(d, 4) else '****' end as phone,
  coalesce(cast(year(try_cast(case when doc_id % 5 = 0 then source
    else cast(2000 + doc_id % 30 as varchar) || '-05-01' end as date)) as varchar), 'unknown_year') as year_only
from (select *, regexp_replace(text, '\D', '', 'g') as d from documents)
""",
)
def _(spark, root):
    docs = table(spark, root, "documents")
    dated = F.when(F.col("doc_id") % 5 == 0, F.col("source")).otherwise(
        F.concat((2000 + F.col("doc_id") % 30).cast("string"), F.lit("-05-01"))
    )
    return docs.select(
        "doc_id",
        sc.mask_email("text").alias("email"),
        sc.mask_cpf("text").alias("cpf"),
        sc.mask_cnpj("text").alias("cnpj"),
        sc.mask_phone("text").alias("phone"),
        sc.year_only(dated).alias("year_only"),
    )


@query(
    "regex_extraction_from_details",
    """
select check_id, regexp_extract(details, 'Esperado=([^|]+)\\|', 1) as expected,
  regexp_extract(details, 'atual=(.+)$', 1) as actual
from (select p_partkey as check_id, 'Esperado=' || p_type || '| atual=' || p_brand as details from part)
""",
)
def _(spark, root):
    from tradeledger.operators.contracts import expected_and_actual

    part = table(spark, root, "part")
    details = part.select(
        F.col("p_partkey").alias("check_id"),
        F.concat(F.lit("Esperado="), "p_type", F.lit("| atual="), "p_brand").alias("details"),
    )
    return expected_and_actual(details).select("check_id", "expected", "actual")
