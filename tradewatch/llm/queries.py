"""The registered queries of the corpus operators, with DuckDB statements where
SQL can state them. Each applies its operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewatch.llm.block_names import exact_groups
from tradewatch.llm.common import table
from tradewatch.llm.edit_counts import edit_counts
from tradewatch.llm.fragment_align import aligned
from tradewatch.llm.gbt_quality import scored
from tradewatch.llm.hyperminhash import near_groups
from tradewatch.llm.licenses import licensed
from tradewatch.llm.line_quality import BOILERPLATE, ENDED, judged
from tradewatch.llm.mix import mixed
from tradewatch.llm.positional_index import contamination
from tradewatch.llm.secret_tests import digest_columns, secrets
from tradewatch.llm.slot_negatives import hard_negatives
from tradewatch.llm.template_lines import line_verdicts
from tradewatch.llm.trie_bpe import encoded

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn
    return deco


LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query("op6_block_names", f"""
WITH d AS (SELECT doc_id, {LOWERED} AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
FROM d JOIN g USING (t)""")
def op6_block_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents")).drop("rid")


@query("op8_hyperminhash")
def op8_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents")).drop("rid")


WORD = r"[^\x20\x09-\x0D]+"


@query("op3_line_quality", rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, doc_id, t, regexp_extract_all(t, '{WORD}') AS w FROM d),
win AS (SELECT rid, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM w, UNNEST(range(1, len(w) - 1)) AS u(i)),
rep AS (SELECT rid, count(DISTINCT p) AS rep FROM (
  SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM (SELECT *, count(*) OVER (PARTITION BY rid, a, b, c) AS k FROM win) WHERE k > 1) GROUP BY rid),
ls AS (SELECT rid, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS ls FROM w),
line AS (SELECT rid, l, i, len(regexp_extract_all(l, '{WORD}')) AS n FROM (SELECT rid, unnest(ls) AS l, generate_subscripts(ls, 1) AS i FROM ls)
  QUALIFY row_number() OVER (PARTITION BY rid, l ORDER BY i) = 1),
kept AS (SELECT rid, sum(n) AS kept_words, string_agg(l, chr(10) ORDER BY i) AS cleaned FROM line WHERE NOT (
  len(regexp_extract_all(l, ' [|>»] ')) >= greatest(3, n * 0.2::DOUBLE) OR len(regexp_extract_all(l, '[#*$%&|<>]')) > n * 0.5::DOUBLE
  OR len(regexp_extract_all(l, '!')) > n * 0.5::DOUBLE OR n <= 4 AND NOT regexp_matches(l, '{ENDED.replace("'", "''")}')
  OR n <= 20 AND regexp_matches(l, '{BOILERPLATE}')) GROUP BY rid),
m AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(list_aggregate(list_concat([''], w), 'string_agg', ''))::BIGINT AS word_chars,
  len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
  coalesce(rep, 0)::BIGINT AS n_repeat_words, coalesce(kept_words, 0)::BIGINT AS kept_words, sha256(coalesce(cleaned, '')) AS cleaned_sha256
  FROM w JOIN ls USING (rid) LEFT JOIN rep USING (rid) LEFT JOIN kept USING (rid)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT * EXCLUDE (cleaned_sha256), NOT base_failed AND 100 * (n_words - kept_words) <= 50 * n_words AS kept, cleaned_sha256 FROM b""")
def op3_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents"))


@query("op2_budget_mix")
def op2_budget_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents")).drop("rid", "copies")


@query("op5_trie_bpe")
def op5_trie_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op9_secret_tests")
def op9_secret_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_columns(secrets(table(spark, sf_dir, "documents")))


@query("op4_gbt_quality")
def op4_gbt_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op1_template_lines")
def op1_template_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_verdicts(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_recurring", F.size("dropped").cast("long").alias("n_dropped"), F.array_join("dropped", ",").alias("dropped_lines"))


@query("op7_edit_counts")
def op7_edit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document before and after its personal data is replaced."""
    return edit_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op10_licenses")
def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table has no paths: source, language and hundreds of the id stand for directories."""
    path = F.concat_ws("/", "source", "lang", F.floor(F.col("doc_id") / 100).cast("string"), F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    return licensed(table(spark, sf_dir, "documents"), path)


@query("op11_fragment_groups")
def op11_fragment_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aligned(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


ITEM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@query("op12_positional_index", rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({LOWERED}, '{ITEM_WORD}') AS w FROM documents),
i AS (SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all({LOWERED}, '{ITEM_WORD}') AS w FROM benchmark),
held AS (SELECT DISTINCT item, w[s : s + 9] AS terms FROM (
  SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM i WHERE len(w) > 0)),
win AS (SELECT row_number() OVER () AS wid, terms, len(terms) AS k FROM (SELECT DISTINCT terms FROM held)),
post AS (SELECT rid, pos, w[pos] AS t FROM (SELECT rid, w, unnest(range(1, len(w) + 1)) AS pos FROM d)),
f AS (SELECT t, count(*) AS f FROM post GROUP BY t),
seed AS (SELECT wid, terms, k, off, terms[off] AS t FROM (SELECT wid, terms, k, unnest(range(1, k + 1)) AS off FROM win) JOIN f ON f.t = terms[off]
  QUALIFY row_number() OVER (PARTITION BY wid ORDER BY f.f, off) = 1),
cand AS (SELECT wid, terms, k, rid, pos - off AS s, w FROM seed JOIN post USING (t) JOIN d USING (rid)),
m AS (SELECT wid, terms, k, rid, s, s >= 0 AND w[greatest(s, 0) + 1 : s + k] = terms AS exact FROM cand
  WHERE list_bool_and(list_transform(range(1, k + 1), lambda j: list_contains(w[greatest(s + j - 2, 1) : greatest(s + j + 2, 0)], terms[j])))),
hit AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(s, s + k)) AS p FROM m WHERE exact) GROUP BY rid),
seen AS (SELECT rid, item, bool_or(exact) AS exact FROM m JOIN held USING (terms) GROUP BY rid, item),
named AS (SELECT rid, count_if(exact) AS n_items, string_agg(item, ',' ORDER BY item) FILTER (WHERE exact) AS names, count_if(NOT exact) AS n_near FROM seen GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near, 0)::BIGINT AS n_near
FROM d LEFT JOIN hit USING (rid) LEFT JOIN named USING (rid)""")
def op12_positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op13_slot_negatives", """
WITH r AS (SELECT row_number() OVER () AS rid, vec_id, (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END)::BIGINT AS label,
  list_transform(embedding, lambda x: floor(x::DOUBLE * 256)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.rid AS ar, a.vec_id AS anchor_id, b.rid AS br, b.vec_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS s
  FROM r a, r b WHERE a.vec_id % 100 = 0 AND a.rid <> b.rid),
p AS (SELECT ar, anchor_id, br, vec_id AS positive_id, s AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY ar ORDER BY s DESC, vec_id, br) <= 5),
n AS (SELECT p.anchor_id, p.positive_id, row_number() OVER (PARTITION BY p.ar, p.br ORDER BY s.s DESC, s.vec_id, s.br) AS rank,
  s.vec_id AS negative_id, p.positive_score, s.s AS negative_score
  FROM p JOIN s ON p.ar = s.ar AND NOT s.same AND 30 * p.positive_score <= 100 * s.s AND 100 * s.s <= 90 * p.positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10""")
def op13_slot_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(table(spark, sf_dir, "embeddings"))
