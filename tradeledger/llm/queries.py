"""Registered queries of the corpus operators and their SQL."""

from __future__ import annotations

import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeledger.llm import conversation_repair, cross_polytope, decontamination, license_scan, line_crf, mixing, pseudonyms, quality_rules, simhash, substring_dedup, token_alignment, token_counts, url_filter
from tradeledger.llm.common import bounded_rows, held_out, labelled_sample, table, usable_labels

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

#: Public vocabulary of the token counts; any ranks file will do.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The two public tokenizers of the alignment; any byte-level BPE file and any sentence-piece model will do.
TOKENIZER_A, TOKENIZER_B = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"
#: Bounded samples that the learners are fitted on, in labelled documents.
RULE_SAMPLE = 20_000
CRF_SAMPLE, CRF_BYTES = 4_000, 24 << 20


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return register


LOWER_SQL = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS_SQL = rf"regexp_extract_all(coalesce({LOWER_SQL}, ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query("op1_license_scan", license_scan.oracle(word_sql=WORDS_SQL))
def licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and templates in every document."""
    return license_scan.scan(table(spark, sf_dir, "documents"), text="text", keep=["doc_id"])


#: Documents at or over this score are predicted good.
GOOD_SCORE = 0.7
#: Demonstration key of the registered query; a production run passes its own secret.
DEMO_KEY = "demonstration key"
#: Setting of the session that holds the secret of a production run.
KEY_SETTING = "spark.tradeledger.pseudonymKey"


def pseudonym_key(spark: SparkSession) -> str:
    """The session's secret. Without one the registered queries fall back to the public demonstration key, and say so."""
    key = spark.conf.get(KEY_SETTING, None)
    if not key:
        warnings.warn(f"{KEY_SETTING} is not set: pseudonyms of the demonstration key can be turned back by anyone", stacklevel=2)
    return key or DEMO_KEY


def require_both(sample: list, docs: DataFrame, labels: DataFrame, what: str) -> None:
    """A learner would judge all documents alike if its sample lacked a label that training documents have."""
    if len({r["label"] for r in sample}) < 2 and usable_labels(docs, labels, "quality").select("label").distinct().count() > 1:
        raise ValueError(f"{what}, {len(sample)} documents, lacks one of the labels")


def trained_crf(spark: SparkSession, sf_dir: str, rows: int = CRF_SAMPLE) -> line_crf.Crf:
    """Fitted on labelled documents outside the held-out fold."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    sample = labelled_sample(docs, labels, "quality", rows)
    # whole documents in the order of a hash, as far as the bound on bytes goes; one that is too
    # long for what is left takes nothing from the others
    sizes = sample.select("doc_id", F.octet_length("text").alias("size")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).collect()
    by_id: dict[int, int] = {}
    for r in sizes:
        by_id[r["doc_id"]] = by_id.get(r["doc_id"], 0) + (r["size"] or 0)
    total, ids = 0, []
    for i, size in by_id.items():
        if total + size <= CRF_BYTES:
            total += size
            ids.append(i)
    got = bounded_rows(sample.filter(F.col("doc_id").isin(ids)), rows)
    require_both(got, docs, labels, f"the classifier's sample (at most {CRF_BYTES} bytes)")
    return line_crf.train([(r["text"] or "").encode() for r in got], [r["label"] for r in got])


@query("op2_quality_classifier")
def classified_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    scored = line_crf.classify(table(spark, sf_dir, "documents"), trained_crf(spark, sf_dir), "text", ["doc_id"])
    return scored.select(
        "doc_id", held_out("doc_id").alias("held_out"), "score",
        F.when(F.col("score") >= GOOD_SCORE, 1).otherwise(0).alias("predicted"), "n_lines", "n_bad_lines",
    )


LEAK_SQL = rf"""
with d as (select row_number() over () as r, doc_id, {WORDS_SQL} as w from documents),
b as (select cast(item_id as varchar) as item, {WORDS_SQL} as w from benchmark),
win as (
  select distinct item, least(10, len(w)) as n,
    array_to_string(w[i:i + least(10, len(w)) - 1], ' ') as k
  from b, unnest(range(1, len(w) - least(10, len(w)) + 2)) t(i) where len(w) > 0),
lengths as (select distinct n from win),
places as (
  select r, i, n, array_to_string(w[i:i + n - 1], ' ') as k
  from d, lengths, unnest(range(1, len(w) - n + 2)) t(i) where len(w) >= n),
hits as (select r, i, p.n, item from places p join win on p.n = win.n and p.k = win.k),
hit_words as (select r, count(distinct j) as n_hit from (select r, unnest(range(i, i + n)) as j from hits) group by r),
hit_items as (
  select r, count(*) as n_items, string_agg(item, ',' order by item) as ids from (select distinct r, item from hits) group by r)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join hit_words using (r) left join hit_items using (r)
"""


@query("op3_benchmark_decontamination", LEAK_SQL)
def benchmark_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark words and items in every document."""
    found = decontamination.find_benchmark(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), "text", ["doc_id"])
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (hit > 0).alias("contaminated"),
    )


@query("op4_pii")
def pseudonymised_documents(spark: SparkSession, sf_dir: str, key: str | None = None) -> DataFrame:
    """Every document with its personal numbers, dates and addresses replaced."""
    return pseudonyms.pseudonymise(table(spark, sf_dir, "documents"), key or pseudonym_key(spark), "text", ["doc_id", "text"])


@query("op5_url_filters")
def url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict for every page url."""
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), "url", keep=["page_id"])


URL_RULE_SQL = rf"""
with u as (
  select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest from pages),
h as (
  select page_id, translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1), '{url_filter.UPPER}', '{url_filter.LOWER}') as host,
    regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) as path from u)
select page_id, host, path, case {" ".join(
    f"when (host = '{r.host}' or ends_with(host, '.{r.host}')) and starts_with(path, '{r.path}') then '{r.name}'"
    for r in sorted(url_filter.RULES, key=lambda r: (-len(r.name), r.name)))} end as rule from h
"""


@query("url_host_rules", URL_RULE_SQL)
def url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path and fitting rule of every page url, before any model."""
    host, path = url_filter.host_and_path(F.col("url").cast("string"))
    rows = table(spark, sf_dir, "pages").select("page_id", host.alias("host"), path.alias("path"))
    return rows.withColumn("rule", url_filter.matched_rule(F.col("host"), F.col("path"), url_filter.RULES)[0])


REPEAT_SQL = """
with d as (
  select row_number() over () as r, doc_id, encode(coalesce(text, '')) as t, hex(encode(coalesce(text, ''))) as h from documents),
places as (
  select r, doc_id, unnest(list_transform(range(0, length(h) // 2 - 49), lambda i: {'i': i, 's': md5_number(array_slice(t, i + 1, i + 50))})) as p
  from d where length(h) >= 100),
windows as (select r, doc_id, p.i as i, p.s as s from places),
shared as (select s, min(doc_id) as least from windows group by s having min(doc_id) < max(doc_id)),
repeated as (select r, i from windows join shared using (s) where doc_id > least),
opened as (select r, i, coalesce(i > lag(i) over (partition by r order by i) + 50, true) as fresh from repeated),
numbered as (select r, i, sum(cast(fresh as int)) over (partition by r order by i) as span from opened),
spans as (select r, min(i) as a, max(i) + 50 as b from numbered group by r, span),
gaps as (select *, coalesce(lag(b) over (partition by r order by a), 0) as before from spans),
cuts as (
  select r, count(*) as n_spans, sum(b - a) as n_removed, max(b) as last,
    string_agg(substring(h, 2 * before + 1, 2 * (a - before)), '' order by a) as front
  from gaps join d using (r) group by r)
select doc_id, cast(length(h) // 2 as bigint) as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed,
  cast(coalesce(n_spans, 0) as bigint) as n_spans,
  sha256(unhex(coalesce(front, '') || substring(h, 2 * coalesce(last, 0) + 1))) as kept_sha256
from d left join cuts using (r)
"""


@query("op6_suffix_dedup", REPEAT_SQL)
def repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that an earlier one has in strings of 50."""
    found = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id", "n_bytes", gone.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


def learned_rules(spark: SparkSession, sf_dir: str, rows: int = RULE_SAMPLE) -> list[quality_rules.Rule]:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    sample = labelled_sample(docs, labels, "quality", rows)
    measured = bounded_rows(quality_rules.with_statistics(sample, "text", ["doc_id", "label"]), rows)
    require_both(measured, docs, labels, "the rules' sample")
    bad = [r["label"] == 0 for r in measured]
    return quality_rules.learn(quality_rules.feature_matrix(measured), quality_rules.np.array(bad, bool))


@query("op7_quality_rules")
def quality_rule_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base statistics and verdicts of every document."""
    rules = learned_rules(spark, sf_dir)
    measured = quality_rules.with_statistics(table(spark, sf_dir, "documents"), "text", ["doc_id"])
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    kept, number = quality_rules.verdict_columns(rules)
    names = F.get(F.array(*[F.lit(str(r)) for r in rules]), number) if rules else F.lit(None).cast("string")
    return measured.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & kept).alias("kept"), number.alias("rule_number"), names.alias("rule"),
    )


STATISTICS_SQL = r"""
with d as (
  select row_number() over () as r, doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
lines as (select r, unnest(string_split(t, chr(10))) as line from d),
dups as (select r, count(*) - count(distinct line) as n_dup_lines from lines where regexp_matches(line, '[^\x20\x09-\x0D]') group by r),
places as (select r, i, array_to_string(w[i:i + 2], ' ') as k from d, unnest(range(1, len(w) - 1)) t(i)),
often as (select r, k from places group by r, k having count(*) > 1),
repeats as (select r, count(distinct j) as n_repeat_words from (select r, unnest(range(i, i + 3)) as j from places join often using (r, k)) group by r),
counted as (
  select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) as bigint) as word_chars,
    cast(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols, coalesce(n_dup_lines, 0) as n_dup_lines,
    coalesce(n_repeat_words, 0) as n_repeat_words
  from d left join dups using (r) left join repeats using (r))
select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from counted
"""


@query("document_quality_statistics", STATISTICS_SQL)
def quality_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts that the quality rules test, and the base check, of every document."""
    measured = quality_rules.with_statistics(table(spark, sf_dir, "documents"), "text", ["doc_id"])
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return measured.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"))


MIX_SQL = r"""
with sized as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size,
    md5('42:' || coalesce(cast(doc_id as varchar), '') || ':' || coalesce(text, '')) as k
  from documents),
per_source as (select source, cast(sum(size) as bigint) as source_size from sized group by source),
weighted as (select *, 1 + (row_number() over (order by source nulls last) - 1) % 3 as weight from per_source),
filled as (
  select *, cast(sum(source_size) over () as bigint) as budget,
    coalesce(sum(3 * source_size) over (order by source_size / weight, source nulls last
      rows between unbounded preceding and 1 preceding), 0) as below,
    sum(weight) over (order by source_size / weight, source nulls last rows between current row and unbounded following) as open
  from weighted),
capped as (select *, (budget - below) * weight >= 3 * source_size * open as is_capped from filled),
levels as (
  select *, budget - sum(case when is_capped then 3 * source_size else 0 end) over () as rest,
    sum(case when is_capped then 0 else weight end) over () as weights from capped),
plan as (
  select source, source_size,
    case when is_capped then cast(3 * source_size as double)
      else cast(rest * weight as double) / cast(weights as double) end as target
  from levels),
parts as (
  select *, case when source_size > 0 then cast(floor(target / source_size) as bigint) else 0 end as whole from plan),
keyed as (select source, k, sum(size) as s, count(*) as n from sized where size > 0 group by source, k),
running as (select *, sum(s) over (partition by source order by k) as upto from keyed),
drawn as (
  select r.source, k, floor((target - whole * source_size - (upto - s)) * n / s + 0.5) as take
  from running r join parts p on r.source is not distinct from p.source),
last as (select source, max({'k': k, 'take': take}) as l from drawn where take >= 1 group by source),
placed as (select *, row_number() over (partition by source, k) as place from sized),
mixed as (
  select doc_id, cast(size as bigint) as size, source_size, target,
    case when size > 0 then whole + case when k < l.k or k = l.k and place <= l.take then 1 else 0 end else 0 end as copies
  from placed d join parts p on d.source is not distinct from p.source
  left join last t on d.source is not distinct from t.source)
select doc_id, size, source_size, target, cast(copies as bigint) as copies, cast(copies * size as bigint) as taken from mixed
"""


@query("op8_mixing", MIX_SQL)
def mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mixing.mix(table(spark, sf_dir, "documents"), keep=["doc_id"])


@query("op9_simhash")
def simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and group of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op10_token_counts")
def counted_tokens(spark: SparkSession, sf_dir: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """Longest-match tokens of every document."""
    automaton = token_counts.Automaton(*token_counts.byte_vocabulary(vocabulary))
    return token_counts.token_counts(table(spark, sf_dir, "documents"), automaton, "text", ["doc_id"])


@query("op11_nearest_neighbours")
def nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of every vector whose id is divisible by 100."""
    return cross_polytope.neighbours(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 100 == 0)


@query("op12_conversation_repair", conversation_repair.oracle())
def repaired_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and the cheapest repair of every conversation, after damage."""
    return conversation_repair.repair(conversation_repair.damage(table(spark, sf_dir, "conversations")))


@query("op13_token_alignment")
def aligned_tokens(spark: SparkSession, sf_dir: str, a_path: str = TOKENIZER_A, b_path: str = TOKENIZER_B) -> DataFrame:
    """Groups and links of two tokenizers in every document."""
    found = token_alignment.align(table(spark, sf_dir, "documents"), a_path, b_path, "text", ["doc_id"], digest=True)
    counted = token_alignment.with_counts(found, token_alignment.pair_counts(found, a_path, b_path), a_path, b_path)
    return counted.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256"))
