"""The operators as queries over the whole tables, and SQL for those that it can express."""

import public_tokenizers

from subscope.llm import decontamination, near_dedup, nearest, packing, quality_rules, secret_scan, sharding, substring_dedup, token_alignment, token_counts, toxicity, url_filters, whitening
from subscope.llm.shared import documents, embeddings


def op1_decontamination(spark, sf_dir):
    return decontamination.contained_items(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op2_token_counts(spark, sf_dir):
    return token_counts.token_counts(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op3_url_filters(spark, sf_dir):
    rules = spark.createDataFrame(url_filters.RULES, "verdict string, host string, path string")
    return url_filters.judged_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"), rules)


def op4_minhash_near_dedup(spark, sf_dir):
    return near_dedup.near_duplicates(documents(spark, sf_dir))


def op5_sharding(spark, sf_dir):
    return sharding.sharded(documents(spark, sf_dir))


def op6_quality_rules(spark, sf_dir):
    return quality_rules.judged(documents(spark, sf_dir))


def op7_substring_dedup(spark, sf_dir):
    return substring_dedup.repeated_passages(documents(spark, sf_dir))


def op8_best_fit_packing(spark, sf_dir):
    return packing.packed(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op9_toxicity(spark, sf_dir):
    return toxicity.scored(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op10_secret_scan(spark, sf_dir):
    return secret_scan.secrets(documents(spark, sf_dir))


def op11_token_alignment(spark, sf_dir):
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return token_alignment.aligned(documents(spark, sf_dir), *paths).drop("groups")


def op12_embedding_whitening(spark, sf_dir):
    return whitening.whitened(embeddings(spark, sf_dir))


def op13_nearest_neighbours(spark, sf_dir):
    return nearest.nearest(embeddings(spark, sf_dir))


def queries():
    found = (
        op1_decontamination,
        op2_token_counts,
        op3_url_filters,
        op4_minhash_near_dedup,
        op5_sharding,
        op6_quality_rules,
        op7_substring_dedup,
        op8_best_fit_packing,
        op9_toxicity,
        op10_secret_scan,
        op11_token_alignment,
        op12_embedding_whitening,
        op13_nearest_neighbours,
    )
    return {f.__name__: f for f in found}


OP3_SQL = r"""
WITH parts AS (
    SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
    FROM pages),
rules(verdict, rule_host, rule_path) AS (VALUES
    ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
fits AS (
    SELECT page_id, arg_max(struct_pack(r := rule_host || rule_path, v := verdict), length(rule_host || rule_path)) AS best
    FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    GROUP BY page_id)
SELECT page_id, host, path, best.r AS rule, coalesce(best.v, 'allow') AS verdict FROM parts LEFT JOIN fits USING (page_id)"""

#: Words of documents in lower case (A-Z), and their distinct five-word shingles.
_SHINGLES = r"""
words AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE
        WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)] END) AS s
    FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id)"""

OP1_SQL = r"""
WITH texts AS (
    SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'i', item_id, text FROM benchmark),
words AS (
    SELECT kind, id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM texts),
shingles AS (
    SELECT DISTINCT kind, id, unnest([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) AS s
    FROM words WHERE len(w) >= 5),
items AS (SELECT id, s, count(*) OVER (PARTITION BY id) AS q FROM shingles WHERE kind = 'i')
SELECT d.id AS doc_id, i.id AS item_id, q AS n_item, count(*) AS n_shared, count(*) / q AS containment
FROM shingles d JOIN items i ON d.s = i.s WHERE d.kind = 'd'
GROUP BY d.id, i.id, q HAVING 100 * count(*) >= 75 * q"""

OP4_SQL = f"""
WITH RECURSIVE {_SHINGLES},
shared AS (
    SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
    SELECT u, v FROM shared JOIN sizes x ON x.doc_id = u JOIN sizes y ON y.doc_id = v
    WHERE 100 * c >= 75 * (x.n + y.n - c)),
both_ways AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
reach AS (SELECT u, v FROM both_ways UNION SELECT r.u, b.v FROM reach r JOIN both_ways b ON b.u = r.v),
lowest AS (SELECT u AS doc_id, least(u, min(v)) AS root FROM reach GROUP BY u)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(root, d.doc_id) AS component_id,
    coalesce(root, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN lowest USING (doc_id)"""

OP6_SQL = r"""
WITH split AS (
    SELECT doc_id, coalesce(text, '') AS txt, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
        [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines
    FROM documents),
windows AS (
    SELECT doc_id, unnest(range(1, len(w) - 6)) AS i, unnest([w[j:j + 7] FOR j IN range(1, len(w) - 6)]) AS k
    FROM split WHERE len(w) >= 8),
twice AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, k) > 1),
covered AS (
    SELECT doc_id, count(DISTINCT p) AS n
    FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY doc_id),
counted AS (
    SELECT s.doc_id, txt, len(w)::BIGINT AS n_words, coalesce(list_sum([length(x) FOR x IN w]), 0)::BIGINT AS word_chars,
        length(regexp_replace(txt, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
        len(lines) AS n_lines, length(regexp_replace(txt, '[^A-Z]', '', 'g')) AS capitals
    FROM split s LEFT JOIN covered c ON c.doc_id = s.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR 10 * n_symbols > 3 * n_words OR 2 * capitals > word_chars
        OR 2 * n_dup_lines > n_lines OR word_chars NOT BETWEEN 2 * n_words AND 20 * n_words) AS kept
FROM counted"""


def oracle_sql():
    return {"op1_decontamination": OP1_SQL, "op3_url_filters": OP3_SQL, "op4_minhash_near_dedup": OP4_SQL, "op6_quality_rules": OP6_SQL}
