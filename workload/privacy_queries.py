"""Personal-data detection, masking, risk and redaction (id L), extracted features (N12, N13)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradeledger.functions.patterns import VALUE_PATTERNS
from tradeledger.operators import catalog, privacy
from workload.base import cte, query
from workload.profile_queries import load

cte(
    "people",
    """
select c_custkey as customer_id, c_name as customer_name, c_mktsegment as segment,
  '+55 11 9' || lpad(cast(c_custkey % 10000 as varchar), 4, '0') || '-' || lpad(cast(c_nationkey as varchar), 4, '0')
    as contact_phone,
  lower(c_mktsegment) || '.' || cast(c_custkey as varchar) || '@example.com' as login,
  lpad(cast(c_custkey as varchar), 11, '7') as cpf, c_nationkey as state_code, c_acctbal as balance,
  case when c_custkey % 3 = 0 then 'high' end as health_score,
  case when c_custkey % 4 = 0 then 'unknown' else cast(1950 + c_custkey % 50 as varchar) || '-03-09' end as birth_date
from customer
""",
)


def people(spark, root):
    customer = load(spark, root, "customer")
    key = F.col("c_custkey").cast("string")
    return customer.select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("segment"),
        F.concat(
            F.lit("+55 11 9"),
            F.lpad((F.col("c_custkey") % 10000).cast("string"), 4, "0"),
            F.lit("-"),
            F.lpad(F.col("c_nationkey").cast("string"), 4, "0"),
        ).alias("contact_phone"),
        F.concat(F.lower("c_mktsegment"), F.lit("."), key, F.lit("@example.com")).alias("login"),
        F.lpad(key, 11, "7").alias("cpf"),
        F.col("c_nationkey").alias("state_code"),
        F.col("c_acctbal").alias("balance"),
        F.when(F.col("c_custkey") % 3 == 0, "high").alias("health_score"),
        F.when(F.col("c_custkey") % 4 == 0, "unknown")
        .otherwise(F.concat((1950 + F.col("c_custkey") % 50).cast("string"), F.lit("-03-09")))
        .alias("birth_date"),
    )


RE2 = {name: pattern.replace("'", "''") for name, pattern in VALUE_PATTERNS.items()}


def _signals_sql(table: str, columns: list[str]) -> str:
    def one(c: str) -> str:
        hits = ", ".join(
            f"coalesce(bool_or(regexp_matches(cast({c} as varchar), '{p}')), false) as {n}" for n, p in RE2.items()
        )
        return f"select '{c}' as column_name, count({c}) as non_null, {hits} from {table}"

    return "\nunion all\n".join(one(c) for c in columns)


PEOPLE = (
    "customer_id customer_name segment contact_phone login cpf state_code balance health_score birth_date".split()
)
query("value_detection_people", _signals_sql("people", [c for c in PEOPLE if c != "balance"]))(
    lambda s, r: privacy.value_signals(people(s, r).drop("balance"))
)
query("value_detection_documents", _signals_sql("documents", ["doc_id", "text", "lang", "source"]))(
    lambda s, r: privacy.value_signals(load(s, r, "documents"), ["doc_id", "text", "lang", "source"])
)


def classified(spark, root):
    return privacy.classify_columns(people(spark, root), RULES)


RULES = {
    "exact": {
        "segment": {
            "lgpd_classification": "non_personal",
            "risk_level": "low",
            "recommended_action": "keep",
            "reason": "Declared.",
        }
    },
    "contains": [
        {
            "token": "state",
            "lgpd_classification": "indirect_identifier",
            "risk_level": "medium",
            "recommended_action": "review",
            "reason": "Declared token.",
        }
    ],
}
NAMED = {
    "customer_id": ("bigint", "personal_data", "Column name indicates personal data."),
    "customer_name": ("string", "personal_data", "Column name indicates personal data."),
    "contact_phone": ("string", "personal_data", "Column name indicates personal data."),
    "login": ("string", "non_personal", "No personal-data indicators found in column name."),
    "cpf": ("string", "personal_data", "Column name indicates personal data."),
    "balance": ("double", "non_personal", "No personal-data indicators found in column name."),
    "health_score": ("string", "sensitive_personal_data", "Column name indicates sensitive data."),
    "birth_date": ("string", "personal_data", "Column name indicates personal data."),
}


def _classification_sql(table: str, named: dict[str, tuple[str, str, str]]) -> str:
    parts = []
    for c, (dtype, kind, reason) in named.items():
        label = "case " + " ".join(f"when bool_or(regexp_matches(cast({c} as varchar), '{p}')) then '{n}'" for n, p in RE2.items())
        parts.append(
            f"select '{c}' as column_name, '{dtype}' as dtype, '{kind}' as k, '{reason}' as why, "
            f"{label} end as label from {table}"
        )
    return (
        "select column_name, dtype, cls as lgpd_classification, "
        "case when cls in ('sensitive_personal_data', 'personal_data') then 'high' "
        "when cls = 'indirect_identifier' then 'medium' else 'low' end as risk_level, "
        "case when cls = 'sensitive_personal_data' then 'anonymize' when column_name = 'cpf' then 'remove' "
        "when cls = 'personal_data' then 'mask' when cls = 'indirect_identifier' then 'review' else 'keep' end "
        "as recommended_action, why || ' ' || case label when 'email' then 'Regex matched email pattern in sampled values.' "
        "when 'cpf' then 'Regex matched CPF pattern in sampled values.' "
        "when 'cnpj' then 'Regex matched CNPJ pattern in sampled values.' "
        "when 'phone' then 'Regex matched phone pattern in sampled values.' "
        "when 'ip' then 'Regex matched IP pattern in sampled values.' "
        "else 'No personal-data regex pattern matched sampled values.' end as reason from (select *, case "
        "when k = 'sensitive_personal_data' then k when k = 'personal_data' or label in ('email', 'cpf', 'cnpj', 'phone') "
        "then 'personal_data' when label = 'ip' then 'indirect_identifier' else k end as cls from ("
        + "\nunion all\n".join(parts)
        + "))"
    )


cte(
    "people_classes",
    _classification_sql("people", NAMED)
    + " union all select 'segment', 'string', 'non_personal', 'low', 'keep', 'Declared.' "
    "union all select 'state_code', 'int', 'indirect_identifier', 'medium', 'review', 'Declared token.'",
)
query("classification_table", "select * from people_classes")(classified)


PLAIN = "No personal-data indicators found in column name."
DOCUMENTS = {
    c: (dtype, "non_personal", PLAIN)
    for c, dtype in (("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"), ("n_chars", "bigint"))
}


@query("classification_documents", _classification_sql("documents", DOCUMENTS))
def _(spark, root):
    return privacy.classify_columns(load(spark, root, "documents"))


CUSTOMER = {
    c: (dtype, "personal_data", "Column name indicates personal data.") if c == "c_name" else (dtype, "non_personal", PLAIN)
    for c, dtype in (
        ("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"), ("c_acctbal", "double"), ("c_mktsegment", "string"),
    )
}
COUNTED = "\nunion all\n".join(
    f"select '{c}' as column_name, count(*) filter ({c} is null) / count(*) * 100 as null_pct, "
    f"count(distinct {c}) + max(case when {c} is null then 1 else 0 end) as distinct_count from customer"
    for c in CUSTOMER
)


@query(
    "column_catalog",
    f"select column_name, dtype, round(null_pct, 2) as null_pct, cast(distinct_count as bigint) as distinct_count, lgpd_classification, "
    f"risk_level, recommended_action, reason from ({COUNTED}) join ({_classification_sql('customer', CUSTOMER)}) using (column_name)",
)
def _(spark, root):
    customers = load(spark, root, "customer")
    return catalog.column_catalog(customers, privacy.classify_columns(customers))


@query(
    "privacy_actions_applied",
    r"""
select sha256(cast(customer_id as varchar)) as customer_id, sha256(customer_name) as customer_name, segment,
  repeat('*', length(regexp_replace(contact_phone, '\D', '', 'g')) - 4) ||
    right(regexp_replace(contact_phone, '\D', '', 'g'), 4) as contact_phone,
  sha256(login) as login, state_code, balance, sha256(coalesce(health_score, '')) as health_score,
  coalesce(cast(year(try_cast(birth_date as date)) as varchar), 'unknown_year') as birth_date
from people
""",
)
def _(spark, root):
    actions = {r.column_name: r.recommended_action for r in classified(spark, root).collect()}
    actions["birth_date"] = "anonymize"
    return privacy.apply_actions(people(spark, root), actions)[0]


@query(
    "privacy_action_log",
    "select column_name, recommended_action as action, case recommended_action when 'keep' then 'Column preserved.' "
    "when 'mask' then 'Masked direct identifier.' when 'anonymize' then 'Anonymized values.' "
    "when 'remove' then 'Column removed from dataset.' else 'Column preserved and flagged for review.' end as note "
    "from people_classes",
)
def _(spark, root):
    return privacy.apply_classification(people(spark, root), classified(spark, root))[1]


RISK_SQL = """
select *, case when score <= 30 then 'low' when score <= 70 then 'medium' else 'high' end as risk_level,
  case when score <= 30 then 'approved' when score <= 70 then 'needs_review' else 'blocked' end
    as publication_recommendation
from (select *, greatest(0, least(100, personal_data_exposure + sensitive_data_exposure + indirect_identifier_exposure
    + critical_null_penalty + direct_identifier_bonus + volume_penalty)) as score
  from (select seller, 7 * count(*) filter (cls = 'personal_data') as personal_data_exposure,
      15 * count(*) filter (cls = 'sensitive_personal_data') as sensitive_data_exposure,
      4 * count(*) filter (cls = 'indirect_identifier') as indirect_identifier_exposure,
      cast(least(15, coalesce(round_even(avg(null_pct) filter (cls in ('personal_data', 'sensitive_personal_data')) * 0.2, 0), 0))
        as bigint) as critical_null_penalty,
      case when bool_or(regexp_matches(lower(column_name), 'cpf|email|phone|telefone|document|nome|name|cnpj'))
        then 15::bigint else 0::bigint end as direct_identifier_bonus,
      case when max(total_rows) >= 100000 then 15::bigint when max(total_rows) >= 10000 then 10::bigint
        when max(total_rows) >= 1000 then 5::bigint else 0::bigint end as volume_penalty
    from class_rows group by seller))
"""
cte(
    "class_rows",
    """
select l_suppkey as seller, 'f' || l_linenumber || case when l_linenumber = 3 then '_email' else '' end as column_name,
  case (l_suppkey + l_linenumber) % 5 when 0 then 'personal_data' when 1 then 'sensitive_personal_data'
    when 2 then 'indirect_identifier' else 'non_personal' end as cls,
  cast(count(*) filter (l_discount > 0.08) * 100 / count(*) as double) as null_pct, 40 * count(*) as total_rows
from lineitem where (l_suppkey + l_linenumber) % 3 <> 0 group by l_suppkey, l_linenumber
""",
)


@query("privacy_risk_score_by_dataset", RISK_SQL)
def _(spark, root):
    lines = load(spark, root, "lineitem").filter("(l_suppkey + l_linenumber) % 3 <> 0")
    code = (F.col("l_suppkey") + F.col("l_linenumber")) % 5
    high = F.count(F.when(F.col("l_discount") > 0.08, 1))
    per_column = lines.groupBy("l_suppkey", "l_linenumber").agg(
        (high * 100 / F.count(F.lit(1))).alias("null_pct"), (40 * F.count(F.lit(1))).alias("total_rows")
    )
    name = F.concat(
        F.lit("f"), F.col("l_linenumber").cast("string"), F.when(F.col("l_linenumber") == 3, "_email").otherwise("")
    )
    kind = (
        F.when(code == 0, "personal_data")
        .when(code == 1, "sensitive_personal_data")
        .when(code == 2, "indirect_identifier")
        .otherwise("non_personal")
    )
    classes = per_column.select(
        F.col("l_suppkey").alias("seller"),
        name.alias("column_name"),
        kind.alias("lgpd_classification"),
        "null_pct",
        "total_rows",
    )
    return privacy.risk_scores(classes, ["seller"])


@query(
    "pii_counts_in_text",
    "select doc_id, "
    + ", ".join(f"cast(length(regexp_extract_all(text, '{p}')) as bigint) as {n}_hits" for n, p in RE2.items())
    + " from documents",
)
def _(spark, root):
    return privacy.pii_counts(load(spark, root, "documents"), "doc_id", "text")


def _redact_sql() -> str:
    out = "text"
    for name, pattern in RE2.items():
        out = f"regexp_replace({out}, '{pattern}', '[{name}]', 'g')"
    return f"select doc_id, clean as text, clean <> text as redacted from (select doc_id, text, {out} as clean from documents)"


@query("pii_redaction_in_text", _redact_sql())
def _(spark, root):
    return privacy.redact_text(load(spark, root, "documents"), "doc_id", "text")


# ---- extracted features --------------------------------------------------


def feature_payloads(spark, root):
    part = load(spark, root, "part")
    words = F.split("p_name", " ")
    payload = F.to_json(
        F.struct(
            F.lower("p_type").alias("category"),
            F.when(F.col("p_size") % 2 == 0, F.col("p_brand")).alias("material"),
            words.alias("compatibility"),
            F.array("p_type", "p_brand").alias("quality_signals"),
            F.col("p_name").alias("summary"),
        )
    )
    return part.select(
        F.col("p_partkey").alias("source_id"),
        F.col("p_name").alias("title"),
        payload.alias("payload"),
        F.when(F.col("p_size") % 3 == 0, "reference").otherwise("service").alias("extraction_mode"),
        F.concat(F.lit("model-"), (F.col("p_size") % 2).cast("string")).alias("model_name"),
    )


def features(spark, root):
    return catalog.flatten_features(catalog.parse_features(feature_payloads(spark, root)))


cte(
    "flat_features",
    """
select p_partkey as source_id, p_name as title,
  case when p_size % 3 = 0 then 'reference' else 'service' end as extraction_mode, 'model-' || (p_size % 2) as model_name,
  lower(p_type) as category, case when p_size % 2 = 0 then p_brand end as material,
  replace(p_name, ' ', ' | ') as compatibility, p_type || ' | ' || p_brand as quality_signals,
  '' as functional_features, '' as security_features, '' as aesthetic_signals, '' as target_use_cases,
  p_name as summary
from part
""",
)
query("feature_flattening", "select * from flat_features")(features)


@query(
    "feature_summary",
    """
select count(distinct source_id) as items, count(distinct category) as categories,
  (select extraction_mode from flat_features group by 1 order by count(*) desc, 1 limit 1) as extraction_mode,
  (select model_name from flat_features group by 1 order by count(*) desc, 1 limit 1) as model_name
from flat_features
""",
)
def _(spark, root):
    return catalog.feature_summary(catalog.clean_feature_rows(features(spark, root), ["title", "category"]))
