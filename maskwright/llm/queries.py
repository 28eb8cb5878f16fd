"""One query per operator, over whole tables with production parameters, and its SQL.

A query that has no SQL here (tokenizers, hashed draws, byte strings of documents,
language models) is tested against a brute-force version in ``tests/llm``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from maskwright.llm import (
    centroid_clusters, decontaminate, exact_dedup, html_text, importance, oracle, jaccard_join, language_model, license_scan, line_dedup, mixing, quality_rules, suffix_dedup, token_counts,
)
from maskwright.llm.common import table


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licenses named in every document."""
    found = license_scan.scanned(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_licenses", "licenses")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document."""
    import public_tokenizers

    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.with_counts(documents, public_tokenizers.path("byte_bpe_50k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix of sources takes of every document."""
    return mixing.plan(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "copies"
    )


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of the benchmark stands in every document."""
    found = decontaminate.matched(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document."""
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_text.main_text(table(spark, sf_dir, "pages"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that stand on many sources."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return line_dedup.without_boilerplate(documents).select("doc_id", "n_lines", "n_removed", "text")


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What repeated strings of 400 bytes take from every document."""
    found = suffix_dedup.removed(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "text")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality ledger of every document."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.ledger(documents).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "n_lines", "fail_bits", "base_failed", "kept",
    )


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language model's score of every document."""
    return language_model.scored(table(spark, sf_dir, "documents"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weight of every document against the benchmark's distribution, and the rank of those drawn."""
    found = importance.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_features", "weight", "score", "rank")


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cluster of every vector."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return centroid_clusters.clustered(vectors).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which of equal texts stays, for every document."""
    return exact_dedup.owners(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "n_bytes", "text_sha256"
    )


_OP1 = r"""
with t(license, t) as (values {templates}),
tw as (select row_number() over () as k, license, regexp_extract_all(lower(t), '[0-9a-z]+') as w from t),
ts as (select distinct k, license, array_to_string(w[i : i + 4], ' ') as s
  from (select *, unnest(range(1, len(w) - 3)) as i from tw)),
n as (select k, count(*) as n from ts group by k),
w as (select doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{{L}}\p{{N}}]+') as w from documents),
s as (select distinct doc_id, array_to_string(w[i : i + 4], ' ') as s
  from (select *, unnest(range(1, greatest(len(w) - 3, 1))) as i from w)),
c as (select doc_id, ts.k, license, count(*) as c from s join ts on ts.s = s.s group by 1, 2, 3),
f as (select distinct doc_id, license from c join n on n.k = c.k where 100 * c >= 80 * n),
g as (select doc_id, count(*) as n, string_agg(license, ',' order by license) as ids from f group by doc_id)
select w.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(g.n, 0) as bigint) as n_licenses,
  coalesce(ids, '') as licenses from w left join g on g.doc_id = w.doc_id
""".format(templates=", ".join("('{}', '{}')".format(i, t.replace("'", "''")) for i, t in license_scan.TEMPLATES))

_OP4 = r"""
with d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') as w from documents),
b as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') as w from benchmark),
bs as (select item_id, w, least(len(w), 13) as n,
  unnest(range(1, len(w) - least(len(w), 13) + 2)) as i from b where len(w) > 0),
bw as (select distinct item_id, n, array_to_string(w[i : i + n - 1], ' ') as t from bs),
ds as (select doc_id, w, n, unnest(range(1, greatest(len(w) - n + 2, 1))) as i
  from d, (select distinct n from bw)),
dw as (select doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') as t from ds),
h as (select doc_id, dw.n, i, item_id from dw join bw on bw.n = dw.n and bw.t = dw.t),
c as (select doc_id, count(distinct j) as n_hit from (
  select doc_id, unnest(range(i, i + n)) as j from (select distinct doc_id, n, i from h)) group by doc_id),
s as (select doc_id, count(*) as n_items, string_agg(id, ',' order by id) as ids from (
  select distinct doc_id, cast(item_id as varchar) as id from h) group by doc_id),
r as (select d.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
  cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(ids, '')) as items_sha256
  from d left join c on c.doc_id = d.doc_id left join s on s.doc_id = d.doc_id)
select *, n_hit > 0 and 20 * n_hit >= n_words as contaminated from r
"""

_OP5 = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
i as (select doc_id, w, least(len(w), 5) as n,
  unnest(range(1, len(w) - least(len(w), 5) + 2)) as i from w where len(w) > 0),
s as (select distinct doc_id, array_to_string(w[i : i + n - 1], ' ') as t from i),
n as (select doc_id, count(*) as n from s group by doc_id),
p as (select a.doc_id as a, b.doc_id as b, count(*) as c
  from s a join s b on a.t = b.t and a.doc_id <> b.doc_id group by 1, 2),
l as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b
  where 100 * c >= 80 * (x.n + y.n - c)),
r(a, b) as (select a, b from l union select r.a, l.b from r join l on l.a = r.b),
m as (select a as doc_id, min(b) as least from r group by a)
select w.doc_id, cast(coalesce(n.n, 0) as bigint) as n_shingles,
  least(w.doc_id, coalesce(m.least, w.doc_id)) as component_id
from w left join n on n.doc_id = w.doc_id left join m on m.doc_id = w.doc_id
"""

_OP7 = r"""
with l as (select doc_id, source, text, string_split(text, chr(10)) as ls from documents),
e as (select doc_id, source, ls, unnest(range(1, len(ls) + 1)) as i from l),
t as (select *, trim(ls[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as line from e),
b as (select line, min(doc_id) as first from t where length(line) >= {chars}
  group by line having count(distinct coalesce('s' || source, '')) >= {sites}),
m as (select t.doc_id, t.i, ls[i] as raw, b.line is not null and first <> t.doc_id as gone
  from t left join b on b.line = t.line),
r as (select doc_id, count(*) as n, sum(case when gone then 1 else 0 end) as gone,
  string_agg(case when gone then null else raw end, chr(10) order by i) as text from m group by doc_id)
select l.doc_id, cast(coalesce(r.n, 0) as bigint) as n_lines, cast(coalesce(r.gone, 0) as bigint) as n_removed,
  case when l.text is null then null else coalesce(r.text, '') end as text
from l left join r on r.doc_id = l.doc_id
""".format(chars=line_dedup.MIN_CHARS, sites=line_dedup.MIN_SITES)

_OP9 = r"""
with w as (
  select doc_id, coalesce(text, '') as text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws,
    [x for x in string_split(coalesce(text, ''), chr(10))
      if regexp_matches(x, '[^\x20\x09-\x0D]')] as ls
  from documents),
g as (select doc_id, ws, unnest(range(1, len(ws) - 1)) as i from w where len(ws) >= 4),
t as (select doc_id, i, count(*) over (partition by doc_id,
    ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) as n from g),
p as (select doc_id, unnest([i, i + 1, i + 2]) as i from t where n > 1),
r as (select doc_id, count(distinct i) as n from p group by doc_id),
m as (
  select w.doc_id, cast(len(ws) as bigint) as n_words,
    cast(length(array_to_string(ws, '')) as bigint) as word_chars,
    cast(len(regexp_extract_all(text, '[#*$%&|<>]')) as bigint) as n_symbols,
    cast(len(ls) as bigint) as n_lines,
    cast(len(ls) - len(list_distinct(ls)) as bigint) as n_dup_lines,
    cast(coalesce(r.n, 0) as bigint) as n_repeat_words
  from w left join r on r.doc_id = w.doc_id),
f as (select *, {bits} as fail_bits from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, fail_bits,
  fail_bits & {base} <> 0 as base_failed, fail_bits & {policy} = 0 as kept from f
""".format(
    bits=" | ".join(
        f"cast(case when {rule} then {quality_rules.bit(name)} else 0 end as bigint)"
        for name, rule in quality_rules.RULES.items()
    ),
    base=quality_rules.policy_bits("base"),
    policy=quality_rules.policy_bits(quality_rules.CURRENT),
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": op1_license_scan,
    "op2_token_counts": op2_token_counts,
    "op3_mixing": op3_mixing,
    "op4_decontamination": op4_decontamination,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_html_extraction": op6_html_extraction,
    "op7_line_dedup": op7_line_dedup,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_quality_rules": op9_quality_rules,
    "op10_lm_scoring": op10_lm_scoring,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_centroid_clustering": op12_centroid_clustering,
    "op13_exact_dedup": op13_exact_dedup,
}

ORACLE: dict[str, str] = {
    "op1_license_scan": _OP1,
    "op4_decontamination": _OP4,
    "op5_jaccard_join": _OP5,
    "op7_line_dedup": _OP7,
    "op9_quality_rules": _OP9,
    "op11_importance_resampling": oracle.OP11,
    "op12_centroid_clustering": oracle.op12(),
    "op13_exact_dedup": oracle.OP13,
}
