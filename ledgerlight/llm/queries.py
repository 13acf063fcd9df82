"""Each operator as a query over the whole test tables, and its result in DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlight.llm import (
    align_tokens,
    binary_records,
    decontaminate,
    html_extract,
    lexical_search,
    license_scan,
    line_dedup,
    multi_index,
    near_dedup,
    packing,
    quality_rules,
    substring_dedup,
    url_filters,
)

Query = Callable[[SparkSession, str], DataFrame]


def op1_binary_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    records = binary_records.read_records(binary_records.write_records(docs, "byte_bpe_50k.json", end_id=0))
    return records.select(
        F.col("id").alias("doc_id"),
        F.col("position").alias("start"),
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return packing.pieces(packing.pack(docs, "word_bpe_49k.json", end_id=2))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.find_contamination(docs, benchmark, window=13, one_in=20)
    names = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(names, 256).alias("items_sha256"), "contaminated")


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = license_scan.scan_licenses(docs)
    labels = F.array_sort(F.array_union("base_labels", F.transform("spans", lambda s: s["label"])))
    return found.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["score"])), F.lit(0.0)).alias("score"),
    )


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_dedup.near_duplicates(docs, size=5, percent=85)


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    rules = spark.createDataFrame(
        [
            ("org", "/", "allow"),
            ("example.org", "/es/", "block"),
            ("example.org", "/en/1", "block"),
            ("com", "/fr/", "allow"),
            ("com", "/de/", "block"),
        ],
        url_filters.RULES,
    )
    return url_filters.judge_urls(pages, rules)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    kept = line_dedup.dedup_lines(docs, percent=80, shingle=5, least_chars=1)
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    return kept.select("doc_id", F.col("_lines").alias("n_lines"), F.col("_removed").alias("n_removed"), digest.alias("kept_sha256"))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return html_extract.extract_text(pages).withColumn("n_chars", F.char_length("text").cast("long"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = substring_dedup.remove_repeats(docs, window=35)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    judged = quality_rules.judge(docs, labels, rejected=0.01, risk=0.05)
    return judged.select([F.col(c).alias(c.removeprefix("_quality_")) for c in judged.columns])


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return lexical_search.rank_documents(docs, benchmark, k=10, b=90)


def op12_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return multi_index.nearest_neighbours(table, F.col("vec_id") % 100 == 0, k=10, recall=0.95)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    aligned = align_tokens.align_tokens(docs, "byte_bpe_50k.json", "piece_bpe_32k.model")
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return aligned.withColumn("groups_sha256", digest).drop("groups")


OP3_SQL = r"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents),
item_words AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, k, array_to_string(words[i : i + k - 1], ' ') AS win
  FROM (SELECT item_id, words, least(13, len(words)) AS k, unnest(range(1, len(words) - least(13, len(words)) + 2)) AS i
        FROM item_words WHERE len(words) > 0)),
doc_windows AS (
  SELECT doc_id, i, k, array_to_string(words[i : i + k - 1], ' ') AS win
  FROM (SELECT doc_id, words, k, unnest(range(1, len(words) - k + 2)) AS i
        FROM doc_words, (SELECT DISTINCT k FROM item_windows) WHERE len(words) >= k)),
found AS (SELECT DISTINCT d.doc_id, d.i, d.k, w.item_id FROM doc_windows d JOIN item_windows w USING (k, win)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM found) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS names
  FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id)
SELECT d.doc_id, len(d.words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(d.words), false) AS contaminated
FROM doc_words d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""


# All pairs of documents that share a shingle, and a closure over the links: for small tables.
OP5_SQL = r"""
WITH RECURSIVE doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+') AS words
  FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(words) = 0 THEN []::VARCHAR[] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
         ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i : i + 4], ' ')) END) AS shingles
  FROM doc_words),
members AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM sets),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, any_value(a.n) AS x_n, any_value(b.n) AS y_n, count(*) AS common
  FROM members a JOIN members b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (SELECT x, y FROM shared WHERE 100 * common >= 85 * (x_n + y_n - common)),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM sets
  UNION SELECT r.doc_id, l.y FROM reached r JOIN both_ways l ON r.other = l.x)
SELECT s.doc_id, len(s.shingles)::BIGINT AS n_shingles, min(r.other) AS component_id, s.doc_id = min(r.other) AS kept
FROM sets s JOIN reached r USING (doc_id) GROUP BY s.doc_id, s.shingles
"""


# No page of the tables names an alias, so the rules alone decide here; tests cover aliases by brute force.
OP6_SQL = r"""
WITH addresses AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages),
rules(rule_host, rule_path, verdict) AS (VALUES
  ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
  ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
fitting AS (
  SELECT page_id, host, path, rule_host || rule_path AS rule, verdict,
         row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC NULLS LAST) AS rank
  FROM addresses LEFT JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fitting WHERE rank = 1
"""


OP9_SQL = r"""
WITH doc_words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
windows AS (
  SELECT doc_id, i, md5_number(array_to_string(words[i : i + 34], ' ')) AS win
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 33)) AS i FROM doc_words WHERE len(words) >= 35)),
repeated AS (SELECT doc_id, i FROM windows WHERE win IN (SELECT win FROM windows GROUP BY win HAVING count(*) > 1)),
gone AS (SELECT doc_id, list(DISTINCT p) AS places FROM (SELECT doc_id, unnest(range(i, i + 35)) AS p FROM repeated) GROUP BY doc_id),
kept AS (
  SELECT d.doc_id, len(words)::BIGINT AS n_words, coalesce(len(places), 0)::BIGINT AS n_removed,
         CASE WHEN places IS NULL THEN words
              WHEN len(places) = len(words) THEN []::VARCHAR[]
              ELSE list_transform(list_sort(list_filter(range(1, len(words) + 1), lambda p: NOT list_contains(places, p))), lambda p: words[p]) END AS rest
  FROM doc_words d LEFT JOIN gone USING (doc_id))
SELECT doc_id, n_words, n_removed, sha256(array_to_string(rest, ' ')) AS kept_sha256 FROM kept
"""


OP11_SQL = r"""
WITH doc_terms AS (
  SELECT row_number() OVER () AS place, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
held AS (SELECT place, doc_id, len(terms)::BIGINT AS n, terms FROM doc_terms WHERE len(terms) > 0),
corpus AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS length FROM held),
item_terms AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
postings AS (
  SELECT place, doc_id, n, term, count(*)::BIGINT AS tf
  FROM (SELECT place, doc_id, n, unnest(terms) AS term FROM held)
  WHERE term IN (SELECT term FROM item_terms) GROUP BY ALL),
weights AS (
  SELECT term, floor(1000.0::DOUBLE * ln((2.0::DOUBLE * docs + 2) / (2.0::DOUBLE * count(*) + 1)))::BIGINT AS w
  FROM postings, corpus GROUP BY term, docs),
scores AS (
  SELECT item_id, place, doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // length))))::BIGINT AS score
  FROM item_terms JOIN postings USING (term) JOIN weights USING (term), corpus GROUP BY ALL),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score
  FROM scores WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 10
"""


# Exact neighbours. An index that sees all rows of a table, as it does up to 2,000 of them, finds just these.
OP12_SQL = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         sqrt(list_reduce(list_transform(list_zip(c.v, q.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])), lambda a, b: a + b)) AS score
  FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id)::INTEGER AS rank, vec_id, score FROM pairs)
SELECT * FROM ranked WHERE rank <= 10
"""


def queries() -> dict[str, Query]:
    return {
        "op1_binary_records": op1_binary_records,
        "op2_packing": op2_packing,
        "op3_decontamination": op3_decontamination,
        "op4_license_scan": op4_license_scan,
        "op5_near_dedup": op5_near_dedup,
        "op6_url_filters": op6_url_filters,
        "op7_line_dedup": op7_line_dedup,
        "op8_html_extraction": op8_html_extraction,
        "op9_substring_dedup": op9_substring_dedup,
        "op10_quality_rules": op10_quality_rules,
        "op11_lexical_search": op11_lexical_search,
        "op12_nearest_neighbours": op12_nearest_neighbours,
        "op13_token_alignment": op13_token_alignment,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_decontamination": OP3_SQL,
        "op5_near_dedup": OP5_SQL,
        "op6_url_filters": OP6_SQL,
        "op9_substring_dedup": OP9_SQL,
        "op11_lexical_search": OP11_SQL,
        "op12_nearest_neighbours": OP12_SQL,
    }
