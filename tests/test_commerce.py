"""Cleaning, joins and the fact on small inline frames."""

import re
from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tradeledger.operators import aggregates as agg
from tradeledger.operators import cleaning as cl
from tradeledger.operators import cohorts, joins
from tradeledger.plans.fact import FACT_COLUMNS, build_fact, build_fact_whole_days, require_rows
from tradeledger.sources.commerce import Commerce, commerce


def d(text):
    return None if text is None else datetime.fromisoformat(text)


ORDERS = (
    "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz, "
    "order_approved_at timestamp_ntz, order_delivered_carrier_date timestamp_ntz, "
    "order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz"
)
ITEMS = (
    "order_id string, order_item_id int, product_id string, seller_id string, shipping_limit_date timestamp_ntz, "
    "price double, freight_value double"
)
PAYMENTS = "order_id string, payment_sequential int, payment_type string, payment_installments int, payment_value double"
REVIEWS = (
    "review_id string, order_id string, review_score int, review_comment_message string, "
    "review_creation_date timestamp_ntz, review_answer_timestamp timestamp_ntz"
)
PRODUCTS = (
    "product_id string, product_category_name string, product_name_lenght int, product_description_lenght int, "
    "product_photos_qty int, product_weight_g double, product_length_cm double, product_height_cm double, "
    "product_width_cm double"
)


@pytest.fixture
def small(spark):
    def order(o, c, bought, delivered=None, estimated="2018-02-01"):
        return (o, c, "delivered", d(bought), d(bought), d(bought), d(delivered), d(estimated))

    make = spark.createDataFrame
    return Commerce(
        orders=make(
            [
                order("o1", "c1", "2018-01-05T00:00:00", "2018-01-15T12:00:00"),
                order("o1", "c9", "2018-01-06T00:00:00"),  # repeated order id, later purchase
                order("o2", "c2", "2018-03-05T00:00:00", "2018-03-20", "2018-03-10"),
                order("o3", "c1", "2018-03-05T00:00:00", "2018-03-04"),  # delivered before purchase
                order(None, "c1", "2018-01-05"),
                order("o4", "c7", "2018-04-01"),  # customer unknown
                order("o5", "c1", "2017-01-01"),  # no items
            ],
            ORDERS,
        ),
        items=make(
            [
                ("o1", 1, "p1", "s1", d("2018-01-09"), 100.0, 15.0),
                ("o1", 1, "p1", "s1", d("2018-01-09"), 100.0, 15.0),  # exact copy
                ("o1", 1, "p1", "s1", d("2018-01-10"), 70.0, 15.0),  # same grain, later limit
                ("o1", 2, "p2", "s1", d("2018-01-09"), None, None),
                ("o2", 1, "p1", "s2", d("2018-03-09"), 50.0, 5.0),
                ("o3", 1, "p1", "s1", d("2018-03-09"), 10.0, 1.0),
                ("o4", 1, "p9", "s9", d("2018-04-09"), 0.0, 3.0),
                ("o2", 2, "p1", "s2", d("2018-03-09"), -5.0, 5.0),
                ("o2", 3, None, "s2", d("2018-03-09"), 5.0, 5.0),
                ("o8", 1, "p1", "s2", d("2018-03-09"), 5.0, 5.0),  # order unknown
            ],
            ITEMS,
        ),
        customers=make(
            [("c1", "u1", 1, "town", "SP"), ("c2", "u1", 2, "town", "RJ"), ("c2", "u2", 2, "town", "RJ"), (None, "u", 0, "", "")],
            "customer_id string, customer_unique_id string, customer_zip_code_prefix int, customer_city string, customer_state string",
        ),
        products=make([("p1", "casa", 4, 5, 1, 2.0, 3.0, 4.0, 5.0), ("p2", None, 4, 5, 1, 2.0, 3.0, 4.0, 5.0)], PRODUCTS),
        sellers=make([("s1", 1, "x", "SP"), ("s2", 2, "y", None)], "seller_id string, seller_zip_code_prefix int, seller_city string, seller_state string"),
        translation=make([("casa", "home"), ("casa", "house")], "product_category_name string, product_category_name_english string"),
        payments=make(
            [
                ("o1", 1, "card", 2, 100.0),
                ("o1", 2, "boleto", 1, 20.0),
                ("o1", 2, "boleto", 1, 20.0),  # copy
                ("o2", 1, None, 1, None),
            ],
            PAYMENTS,
        ),
        reviews=make(
            [("r1", "o1", 5, None, d("2018-01-20"), d("2018-01-21")), ("r2", "o1", 2, " ok ", d("2018-01-19"), d("2018-01-25"))],
            REVIEWS,
        ),
    )


def test_fact_rows_and_features(small, rows):
    fact = build_fact(small)
    assert fact.columns == FACT_COLUMNS and len(FACT_COLUMNS) == 60
    got = {(r["order_id"], r["order_item_id"]): r for r in rows(fact)}
    # o3 is delivered before purchase, o8 has no order, the bad items of o2 are rejected
    assert sorted(got) == [("o1", 1), ("o1", 2), ("o2", 1), ("o4", 1)]
    first = got["o1", 1]
    assert first["price"] == 100.0 and first["total_item_value"] == 115.0
    assert first["freight_to_price_ratio"] == pytest.approx(0.15)
    assert first["delivery_time_days"] == 10.5 and first["is_delayed"] is False
    assert first["purchase_cohort_month"] == "2018-01" and first["cohort_order_month_number"] == 0
    assert first["customer_order_sequence"] == 1 and first["is_first_order"] is True
    assert (first["payment_count"], first["total_payment_value"], first["payment_type_mode"]) == (2, 120.0, "boleto")
    assert (first["review_count"], first["review_score_mean"], first["has_review_comment"]) == (2, 3.5, 1)
    assert first["product_category_name_english"] == "home"
    # three distinct item rows of o1 and one of o3 count for the seller, copies once
    assert first["seller_order_count"] == 2
    assert first["seller_avg_delivery_days"] == pytest.approx((3 * 10.5 + 1 * -1.0) / 4)
    assert got["o1", 2]["total_item_value"] == 0.0 and got["o1", 2]["freight_to_price_ratio"] is None
    second = got["o2", 1]
    assert second["is_delayed"] is True and second["estimated_delay_days"] == 10.0
    # u1 bought o1 and o3 before/at the same time; o5 has no items and does not count
    assert (second["cohort_order_month_number"], second["customer_order_sequence"]) == (2, 2)
    assert second["total_payment_value"] == 0.0 and second["payment_type_mode"] is None
    unknown = got["o4", 1]
    assert unknown["customer_unique_id"] is None and unknown["customer_order_sequence"] == 1
    assert unknown["customer_first_purchase_timestamp"] is None and unknown["delivery_time_days"] is None
    assert unknown["freight_to_price_ratio"] is None and unknown["seller_volume_tier"] == "long_tail"


def test_staged_build_gives_the_same_fact(spark, root, rows):
    source = commerce(spark, root)
    lazy, staged = build_fact(source), build_fact(source, staged=True)
    assert lazy.exceptAll(staged).count() == 0 and staged.exceptAll(lazy).count() == 0


@pytest.mark.parametrize("build", [build_fact, build_fact_whole_days])
def test_wide_rows_are_not_shuffled_for_products_or_sellers(spark, root, small, monkeypatch, build):
    def shuffled_joins(fact):
        plan = fact._jdf.queryExecution().optimizedPlan().toString()
        return [line for line in plan.splitlines() if " Join " in line or ":- Join " in line or "+- Join " in line]

    few = build(small)
    kept = [line for line in shuffled_joins(few) if "broadcast" not in line]
    assert "order_id" in kept[0], kept[0]  # the topmost join that may shuffle brings the order columns
    rows = few.collect()
    monkeypatch.setattr("tradeledger.plans.fact.BROADCAST_SELLERS", 1)
    many = build(small)
    assert not [line for line in shuffled_joins(many) if "broadcast" in line]
    assert "order_id" in shuffled_joins(many)[0]
    assert sorted(map(str, many.collect())) == sorted(map(str, rows))


def written_shuffles(df):
    """Column lists of the shuffles that were written, reused ones once; ``df`` has run."""
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = df._jdf.queryExecution().explainString(mode)
    numbers = re.findall(r" Exchange \((\d+)\)", text.split("== Initial Plan ==")[0])
    nodes = dict(re.findall(r"\n\((\d+)\) Exchange\nInput \[\d+\]: \[(.*?)\]\n", text))
    return [re.sub(r"#\d+L?", "", nodes[n]).split(", ") for n in numbers]


@pytest.mark.parametrize("build", [build_fact, build_fact_whole_days])
def test_item_rows_are_shuffled_once(spark, root, build):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        fact = build(commerce(spark, root))
        fact.collect()
        shuffles = written_shuffles(fact)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    # for copies, repeated grains, the sellers' orders and the orders' columns alike; products take pairs
    assert len([c for c in shuffles if "order_item_id" in c]) == 1
    assert len([c for c in shuffles if "product_photos_qty" in c and "order_id" in c]) == 1
    # the orders' customers and days are dealt out once for ranks and totals
    assert len([c for c in shuffles if "_day" in c and "order_id" in c]) == 1


@pytest.mark.parametrize("build", [build_fact, build_fact_whole_days])
@pytest.mark.parametrize("bound", ["BROADCAST_CATEGORIES", "BROADCAST_SELLERS"])
def test_many_names_or_sellers_give_the_same_fact(spark, small, monkeypatch, build, bound):
    rest = [("o1", i, p, s, d("2018-01-09"), 1.0, 1.0) for i, p, s in ((4, "p1", "s1"), (5, "p1", "s2"), (6, "p2", "s2"), (7, "p9", "s1"))]
    source = replace(small, items=small.items.union(spark.createDataFrame(rest, ITEMS)))
    few = sorted(map(str, build(source).collect()))
    monkeypatch.setattr(f"tradeledger.plans.fact.{bound}", 0)
    spark.conf.set("spark.sql.shuffle.partitions", "40")  # merged again by adaptive execution
    try:
        many = build(source)
        assert sorted(map(str, many.collect())) == few and len(few) >= 7
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    kinds = {(r.product_id, r.seller_id): (r.product_category_name_english, r.product_photos_qty, r.seller_city) for r in many.filter("order_id = 'o1'").collect()}
    assert kinds["p1", "s1"] == ("home", 1, "x") and kinds["p1", "s2"] == ("home", 1, "y")
    assert kinds["p2", "s2"] == (None, 1, "y") and kinds["p9", "s1"] == (None, None, "x")


@pytest.mark.parametrize("number_unknown", [True, False])
def test_history_of_orders_against_its_parts(spark, rows, number_unknown):
    bought = [
        ("a", "u1", "2018-01-05T10:00:00"), ("b", "u1", "2018-01-05T10:00:00"), ("c", "u1", "2018-01-05T11:00:00"),
        ("d", "u1", "2018-02-01T00:00:00"), ("e", "u2", "2018-01-05T10:00:00"), ("f", None, "2018-01-05T09:00:00"),
        ("g", None, "2018-01-06T09:00:00"), ("h", None, "2018-01-06T09:00:00"), ("i", "u1", "2017-12-31T23:00:00"),
    ]
    orders = spark.createDataFrame(
        [(o, u, o.upper(), d(t)) for o, u, t in bought],
        "order_id string, customer_unique_id string, customer_city string, order_purchase_timestamp timestamp_ntz",
    )
    got = {r["order_id"]: r for r in rows(cohorts.with_purchase_history(orders, number_unknown))}
    assert len(got) == len(bought) and all(r["customer_city"] == o.upper() for o, r in got.items())
    sequence = {(r["customer_group"]["customer_unique_id"], r["order_purchase_timestamp"]): r["customer_order_sequence"] for r in rows(cohorts.purchase_sequence(orders))}
    first = {r["customer_unique_id"]: r["customer_first_purchase_timestamp"] for r in rows(cohorts.first_purchase(orders))}
    for o, u, t in bought:
        assert got[o]["customer_order_sequence"] == (sequence[u, d(t)] if u or number_unknown else None)
        assert got[o]["customer_first_purchase_timestamp"] == first.get(u)
    assert [got[o]["customer_order_sequence"] for o in "iabcd"] == [1, 2, 2, 3, 4]


def test_whole_day_variant(small, rows):
    got = {(r["order_id"], r["order_item_id"]): r for r in rows(build_fact_whole_days(small))}
    assert sorted(got) == [("o1", 1), ("o2", 1), ("o4", 1)]  # the item without price is dropped
    assert got["o1", 1]["delivery_time_days"] == 10
    # all orders count here: o5 of 2017 is the first purchase of u1
    assert got["o1", 1]["customer_order_sequence"] == 2 and got["o1", 1]["cohort_order_month_number"] == 12


def test_minimum_row_guard(small):
    with pytest.raises(ValueError, match="at least"):
        require_rows(build_fact(small))


def test_unused_joins_leave_the_plan(small):
    fact = build_fact(small)
    plan = fact.select("order_id", "price")._jdf.queryExecution().optimizedPlan().toString()
    assert "payment_value" not in plan and "seller_city" not in plan and "customer_city" not in plan


def test_many_to_one_join_raises_on_duplicate_right_keys(spark):
    left = spark.createDataFrame([("a", 1)], "k string, v int")
    right = spark.createDataFrame([("a", 1), ("a", 2)], "k string, w int")
    with pytest.raises(PySparkException, match="duplicate right key"):
        joins.left_join_m1(left, right, ["k"]).collect()
    assert joins.left_join_m1(left, right.limit(1), ["k"]).count() == 1


def test_missing_keys(spark, rows):
    fact = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "fk string")
    dim = spark.createDataFrame([("a",)], "pk string")
    assert rows(joins.missing_keys(fact, "fk", dim, "pk")) == [{"fk": "b"}]


@pytest.mark.parametrize(
    ("name", "expected"), [("Order ID", "order_id"), ("CustomerID", "customer_id"), ("order_id", "order_id"), ("total%Value", "total_value")]
)
def test_snake_case(name, expected):
    assert cl.snake_case(name) == expected


def test_date_columns_are_coerced(spark, rows):
    df = spark.createDataFrame([("2020-01-02 03:04:05", "x", "y"), ("bad", "x", "y")], "order_date string, approved_at string, note string")
    got = rows(cl.parse_date_columns(df))
    assert got[0]["order_date"].year == 2020 and got[1]["order_date"] is None
    assert got[0]["approved_at"] is None and got[0]["note"] == "y"


def test_rejected_rows_keep_every_reason(small, rows):
    accepted, rejected = cl.split_rejected(small.items, cl.item_rejections())
    reasons = {(r["order_id"], r["order_item_id"]): r["rejection_reason"] for r in rows(rejected)}
    assert reasons == {("o2", 2): "negative_price", ("o2", 3): "missing_product_id"}
    assert accepted.count() + rejected.count() == small.items.count()


def test_keep_one_with_a_hot_key(spark, rows):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), (3000 - F.col("id")).alias("o")
    )
    got = cl.keep_one(df, ["k"], ["o"])
    assert got.count() == 2001
    assert rows(got.filter("k = 0")) == [{"k": 0, "o": 3}]


def test_staging_of_reviews_and_payments(small, rows):
    twice = small.reviews.unionByName(small.reviews.withColumn("review_creation_date", F.lit(d("2019-01-01"))))
    assert cl.stage_reviews(twice).count() == 2
    got = rows(agg.payments_by_order(cl.stage_payments(small.payments), null_total_as_zero=False), "order_id")
    assert got[0]["total_payment_value"] == 140.0 and got[1]["total_payment_value"] is None
