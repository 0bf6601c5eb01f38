import hashlib

import pytest
from pyspark.sql import functions as F

from tradeledger.functions import scalars as sc
from tradeledger.operators import privacy


def one(spark, value, fn):
    return spark.createDataFrame([(value,)], "v string").select(fn("v").alias("r")).first()["r"]


@pytest.mark.parametrize(
    ("fn", "value", "expected"),
    [
        (sc.mask_email, "alice@example.com", "a***@example.com"),
        (sc.mask_email, "@x.com", "***@x.com"),
        (sc.mask_email, "nobody", "***"),
        (sc.mask_email, None, "***"),
        (sc.mask_cpf, "123.456.789-09", "***.***.***-09"),
        (sc.mask_cpf, "12", "***.***.***-**"),
        (sc.mask_cnpj, "12.345.678/0001-99", "**.***.***/****-99"),
        (sc.mask_cnpj, None, "**.***.***/****-**"),
        (sc.mask_phone, "+55 11 99999-0000", "*********0000"),
        (sc.mask_phone, "12", "****"),
        (sc.hashed, None, hashlib.sha256(b"").hexdigest()),
        (sc.hashed, "x", hashlib.sha256(b"x").hexdigest()),
        (sc.year_only, "2024-05-01", "2024"),
        (sc.year_only, "soon", "unknown_year"),
        (sc.year_only, None, "unknown_year"),
    ],
)
def test_masks(spark, fn, value, expected):
    assert one(spark, value, fn) == expected


def test_pseudonym(spark):
    token = "order_id_" + hashlib.sha256(b"order_id:o1").hexdigest()[:16]
    assert one(spark, "o1", lambda c: sc.pseudonym(c, "order_id")) == token
    assert one(spark, None, lambda c: sc.pseudonym(c, "order_id")) is None


@pytest.fixture
def people(spark):
    return spark.createDataFrame(
        [
            ("alice@example.com", "123.456.789-09", "high", 10.5, None, "call 11 99999-0000", 12345678901, True),
            ("b@example.com", "123.456.789-09", None, 20.0, None, "10.0.0.1", 5, False),
        ],
        "email string, cpf string, health_score string, revenue double, city string, note string, code long, flag boolean",
    )


def test_classification(people):
    got = {r["column_name"]: r for r in (x.asDict() for x in privacy.classify_columns(people).collect())}
    assert list(got) == people.columns
    kinds = {c: (r["lgpd_classification"], r["recommended_action"]) for c, r in got.items()}
    assert kinds == {
        "email": ("personal_data", "mask"),
        "cpf": ("personal_data", "remove"),
        "health_score": ("sensitive_personal_data", "anonymize"),
        "revenue": ("non_personal", "keep"),
        "city": ("indirect_identifier", "review"),
        "note": ("personal_data", "mask"),
        "code": ("personal_data", "mask"),
        "flag": ("non_personal", "keep"),
    }
    assert "only null values" in got["city"]["reason"] and "phone" in got["note"]["reason"]


def test_declared_rules_win_and_empty_tables_work(people):
    rules = {
        "exact": {"Email": {"lgpd_classification": "odd", "risk_level": "LOW", "recommended_action": "Keep", "reason": "r"}},
        "contains": [{"token": "rev", "lgpd_classification": "personal_data", "risk_level": "high", "recommended_action": "mask", "reason": "r"}],
        "regex": [{"pattern": "^co", "lgpd_classification": "indirect_identifier", "risk_level": "x", "recommended_action": "x", "reason": "r"}],
    }
    got = {r["column_name"]: r for r in privacy.classify_columns(people.limit(0), rules).collect()}
    assert got["email"]["lgpd_classification"] == "non_personal" and got["email"]["recommended_action"] == "keep"
    assert got["revenue"]["recommended_action"] == "mask"
    assert (got["code"]["risk_level"], got["code"]["recommended_action"]) == ("medium", "review")
    assert len(got) == len(people.columns)


def test_token_matching_is_less_eager():
    assert privacy.class_from_name("shipping_limit_date")[0] == "personal_data"  # contains "ip"
    assert privacy.class_from_name("shipping_limit_date", match="token")[0] == "non_personal"
    assert privacy.class_from_name("customer_name", match="token")[0] == "personal_data"


def test_cheap_tests_never_change_a_pattern(spark):
    texts = ["a@b.co", "@", "12345678909", "1234567890", "12.345.678/0001-99", "1234-5678", "1234567", "1.1.1.1", "1.1.1", ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    from tradeledger.functions.patterns import VALUE_PATTERNS

    for name, pattern in VALUE_PATTERNS.items():
        differs = df.filter(privacy.matches(F.col("t"), name) != F.regexp_like("t", F.lit(pattern)))
        assert differs.count() == 0, name


def test_actions(people):
    actions = {r["column_name"]: r["recommended_action"] for r in privacy.classify_columns(people).collect()}
    masked, log = privacy.apply_actions(people.withColumn("birth_date", F.lit("1990-02-03")), {**actions, "birth_date": "anonymize"})
    row = masked.first().asDict()
    assert "cpf" not in row and row["email"] == "a***@example.com" and row["birth_date"] == "1990"
    assert row["health_score"] == hashlib.sha256(b"high").hexdigest() and row["revenue"] == 10.5
    notes = {r["column_name"]: r["action"] for r in log.collect()}
    assert notes["cpf"] == "remove" and notes["city"] == "review" and notes["birth_date"] == "anonymize"


@pytest.mark.parametrize(
    ("columns", "total", "score", "level"),
    [
        ([("revenue", "non_personal")], 10, 0, "low"),
        ([("email", "personal_data"), ("cpf", "personal_data"), ("health", "sensitive_personal_data")], 200_000, 59, "medium"),
        ([(f"email{i}", "personal_data") for i in range(12)], 5_000, 100, "high"),
        ([("city", "indirect_identifier")], 20_000, 14, "low"),
    ],
)
def test_risk_score(spark, columns, total, score, level):
    df = spark.createDataFrame([(n, c, total) for n, c in columns], "column_name string, lgpd_classification string, total_rows long")
    row = privacy.risk_scores(df).first()
    assert (row["score"], row["risk_level"]) == (score, level)


def test_null_penalty_rounds_half_to_even(spark):
    df = spark.createDataFrame([("x", "personal_data", 10, 12.5), ("y", "non_personal", 10, 90.0)], "column_name string, lgpd_classification string, total_rows long, null_pct double")
    assert privacy.risk_scores(df).first()["critical_null_penalty"] == 2  # 2.5 -> 2


def test_text_redaction(spark):
    text = "mail a@b.com, cpf 123.456.789-09, cnpj 12.345.678/0001-99, ip 10.0.0.1, tel 11 99999-0000"
    df = spark.createDataFrame([(1, text), (2, "clean")], "id int, text string")
    got = {r["id"]: r for r in privacy.redact_text(df, "id", "text").collect()}
    assert got[1]["text"] == "mail [email], cpf [cpf], cnpj [cnpj], ip [ip], tel [phone]"
    assert got[2]["redacted"] is False
    hits = privacy.pii_counts(df, "id", "text").filter("id = 1").first()
    assert (hits["email_hits"], hits["cpf_hits"], hits["cnpj_hits"], hits["ip_hits"]) == (1, 1, 1, 1)
