"""One query per training-data operator over the whole test tables, and the same results as SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline
from cinerank.llm import language, quality, token_counts, toxicity
from cinerank.llm.conversation_trie import paths, prefix_trie
from cinerank.llm.decontaminate import contaminations
from cinerank.llm.exact_duplicates import exact_duplicates
from cinerank.llm.labelled import remainder
from cinerank.llm.mixing import mix, word_count
from cinerank.llm.near_duplicates import near_duplicates
from cinerank.llm.ngram_join import similar_groups
from cinerank.llm.sharding import shard
from cinerank.llm.url_filter import judge
from cinerank.llm.vector_codes import ENTRIES, PARTS, ROUNDS, compress

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLES: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    LLM_QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight shards of near-equal bytes."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    sized = docs.select("doc_id", (F.octet_length("text") + 1).cast("long").alias("size"),
                        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
                        F.xxhash64("text").alias("k1"), F.xxhash64("doc_id", "text", F.lit(1)).alias("k2"))
    return shard(sized, size=F.col("size"), order=(F.col("k1"), F.col("k2"))).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@query
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken of every document when sources weigh 5, 2, 1 and share 150 % of all words."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", word_count().alias("size"))
    return mix(docs, size=F.col("size")).select("doc_id", "size", "source_size", "target", "taken")


LLM_ORACLES["op2_mixing"] = r"""
WITH docs AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), weighed AS (
    SELECT source, source_size, source_size * 2 AS lim,
           [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
    FROM (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source)
), levels AS (
    SELECT *, (sum(source_size) OVER ()) * 1.5::DOUBLE AS goal,
           sum(lim) OVER by_limit - lim AS limited,
           sum(weight) OVER () - sum(weight) OVER by_limit + weight AS open_weight
    FROM weighed WINDOW by_limit AS (ORDER BY source_size / weight, source NULLS LAST)
), common AS (
    SELECT arg_min((goal - limited) / open_weight, limited) AS level FROM levels
    WHERE (goal - limited) / open_weight * weight < lim
), rates AS (
    SELECT source, source_size,
           CASE WHEN level * weight < lim THEN level * weight ELSE lim::DOUBLE END AS target,
           (('0x' || substr(md5('0|' || CASE WHEN source IS NULL THEN '-' ELSE '+' END || '|' || coalesce(source, '')), 1, 8))
            ::BIGINT % 1000000000 * 1000)::HUGEINT AS first
    FROM levels, common
), placed AS (
    SELECT doc_id, size, source_size, target, first,
           coalesce(floor(target / nullif(source_size, 0) * 1e12), 0)::HUGEINT AS rate,
           row_number() OVER (PARTITION BY source ORDER BY size, ('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT % 1024, doc_id) AS n
    FROM docs JOIN rates USING (source)
)
SELECT doc_id, size, source_size, target,
       (((n * rate + first) // 1000000000000 - ((n - 1) * rate + first) // 1000000000000) * size)::BIGINT AS taken
FROM placed
"""


@query
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of all documents."""
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), *token_counts.load_vocabulary())


@query
def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all pages, with text models learnt from the documents' languages."""
    model = language.fit(table(spark, sf_dir, "documents"))
    return language.identify(table(spark, sf_dir, "pages"), model)


@query
def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near duplicates of all documents by 4-word shingles."""
    return near_duplicates(table(spark, sf_dir, "documents"))


def _similar_sql(width: int, columns: str) -> str:
    """Links between all sets that share a shingle, and the least id reachable through them."""
    return rf"""
WITH RECURSIVE worded AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^ 	-
]+') AS w FROM documents
), shingled AS MATERIALIZED (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_sort(list_distinct(list_transform(
        range(1, greatest(len(w) - {width - 1}, 1) + 1), lambda k: array_to_string(w[k:k + {width - 1}], ' ')))) END AS tokens FROM worded
), named AS MATERIALIZED (
    SELECT doc_id, len(tokens) AS n, CASE WHEN len(tokens) = 0 THEN doc_id ELSE min(doc_id) OVER (PARTITION BY tokens) END AS s FROM shingled
), tokens AS MATERIALIZED (
    SELECT s, n, unnest(tokens) AS token FROM shingled JOIN named USING (doc_id) WHERE s = doc_id
), links AS MATERIALIZED (
    SELECT a.s AS a, b.s AS b FROM tokens a JOIN tokens b USING (token) WHERE a.s < b.s
    GROUP BY a.s, b.s, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), edges AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached(s, r) AS (SELECT s, s FROM named UNION SELECT x.s, e.b FROM reached x JOIN edges e ON e.a = x.r)
SELECT {columns} FROM named JOIN (SELECT s, min(r) AS component_id FROM reached GROUP BY s) USING (s)
"""


LLM_ORACLES["op5_near_duplicates"] = _similar_sql(4, "doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept")


@query
def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on the URLs of all pages."""
    return judge(table(spark, sf_dir, "pages"))


LLM_ORACLES["op6_url_filter"] = r"""
WITH rules(verdict, rule_host, rule_path) AS (
    VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
), parts AS (
    SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
    FROM pages
), judged AS (
    SELECT *, (SELECT arg_max({'verdict': verdict, 'rule': rule_host || rule_path}, length(rule_host || rule_path)) FROM rules
               WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)) AS fit
    FROM parts
)  -- no page of the tables has a canonical link or a refresh, so nothing is inherited
SELECT page_id, host, path, fit.rule AS rule, coalesce(fit.verdict, 'allow') AS verdict FROM judged
"""


@query
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that documents hold."""
    return contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op8_exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts, up to white space."""
    return exact_duplicates(table(spark, sf_dir, "documents"))


LLM_ORACLES["op8_exact_duplicates"] = r"""
WITH texts AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS text FROM documents
), grouped AS (
    SELECT doc_id, text, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           row_number() OVER (PARTITION BY text, doc_id) AS again
    FROM texts WINDOW same AS (PARTITION BY text)
)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AND again = 1 AS kept, sha256(text) AS text_sha256
FROM grouped
"""


def _held_out(scored: DataFrame, divisor: int, at: int) -> DataFrame:
    return scored.select("doc_id", F.coalesce(remainder(divisor) == at, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents; labels of ids with remainder 1 modulo 3 are not learnt from."""
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"), remainder(3) != 1)
    return _held_out(quality.score(docs, model), 3, 1)


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents; labels of ids with remainder 0 modulo 5 are not learnt from."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), remainder(5) != 0)
    return _held_out(toxicity.score(docs, model), 5, 0)


@query
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all embeddings."""
    codes, books = compress(table(spark, sf_dir, "embeddings"))
    return codes.select("vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))


def _vector_codes_sql() -> str:
    """The rounds as common table expressions, with dot products of doubles, which hold the tables' small integers exactly."""
    def assigned(k: int) -> str:
        return f"""near{k} AS MATERIALIZED (
    SELECT vec_id, p.part, arg_min(entry, (d, entry)) AS entry, min(d) AS d, any_value(p.x) AS x
    FROM (SELECT vec_id, part, p.x, entry, list_inner_product(p.x, p.x) - 2 * list_inner_product(p.x, b.x) + list_inner_product(b.x, b.x) AS d
          FROM parts p JOIN book{k} b USING (part)) p
    GROUP BY vec_id, p.part)"""

    def moved(k: int) -> str:
        return f"""book{k + 1} AS MATERIALIZED (
    SELECT b.part, b.entry, coalesce(m.x, b.x) AS x
    FROM book{k} b LEFT JOIN (
        SELECT part, entry, list(mean ORDER BY place) AS x
        FROM (SELECT part, entry, place, floor(sum(x[place]) / count(*)) AS mean FROM near{k}, LATERAL (SELECT unnest(range(1, len(x) + 1)) AS place)
              GROUP BY part, entry, place) GROUP BY part, entry) m ON m.part = b.part AND m.entry = b.entry)"""

    rounds = ",\n".join(f"{assigned(k)},\n{moved(k)}" for k in range(ROUNDS))
    return f"""
WITH kept AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: floor(x::DOUBLE * 1024)) AS v,
           row_number() OVER (ORDER BY vec_id) - 1 AS place
    FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
    SELECT vec_id, place, part, list_slice(v, part * len(v) // {PARTS} + 1, (part + 1) * len(v) // {PARTS}) AS x
    FROM kept, (SELECT unnest(range({PARTS})) AS part)
), book0 AS MATERIALIZED (SELECT part, place AS entry, x FROM parts WHERE place < {ENTRIES}),
{rounds},
{assigned(ROUNDS)},
codes AS (
    SELECT vec_id, string_agg(printf('%02x', entry::INT), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM near{ROUNDS} GROUP BY vec_id
), books AS (
    SELECT sha256(string_agg(array_to_string(list_transform(x, lambda c: c::BIGINT), ','), ',' ORDER BY part, entry)) AS codebooks_sha256
    FROM book{ROUNDS}
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM codes JOIN kept USING (vec_id), books
"""


LLM_ORACLES["op11_vector_codes"] = _vector_codes_sql()


@query
def op12_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents with similar sets of 5-word shingles."""
    return similar_groups(table(spark, sf_dir, "documents"))


LLM_ORACLES["op12_ngram_join"] = _similar_sql(5, "doc_id, n AS n_shingles, component_id")


@query
def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all conversations."""
    return prefix_trie(paths(table(spark, sf_dir, "conversations")))


LLM_ORACLES["op13_conversation_trie"] = """
WITH crc AS (  -- the usual table of CRC-32, polynomial 0xEDB88320
    SELECT list_transform(range(256), lambda i: list_reduce(
        [i::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: xor(c >> 1, 3988292384 * (c & 1)))) AS steps
), own AS (
    SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS turns
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), hashed AS (
    SELECT conv_id, turns, conv_id - conv_id % 100 AS base,
           xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ord(x)::BIGINT),
                           lambda c, b: xor(steps[(xor(c, b) & 255) + 1], c >> 8)), 4294967295::BIGINT) % 6 AS h
    FROM own, crc
), whole AS MATERIALIZED (
    SELECT o.conv_id, list_concat(coalesce(b.turns, [])[1:o.h], o.turns[o.h + 1:]) AS turns FROM hashed o LEFT JOIN own b ON b.conv_id = o.base
), prefixes AS MATERIALIZED (
    SELECT conv_id, depth, len(turns) AS whole_depth, md5(turns[1:depth]::JSON::VARCHAR) AS node,
           CASE WHEN depth > 0 THEN md5(turns[1:depth - 1]::JSON::VARCHAR) END AS parent,
           CASE WHEN depth > 0 THEN length(turns[depth].text) ELSE 0 END AS size
    FROM whole, LATERAL (SELECT unnest(range(len(turns) + 1)) AS depth)
), nodes AS MATERIALIZED (
    SELECT node, depth, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(size) AS size,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (whole_depth = depth), '')) AS ends_sha256
    FROM prefixes GROUP BY node, depth
), below AS MATERIALIZED (SELECT parent, count(*) AS n FROM nodes GROUP BY parent),
sums AS (  -- a node lies below every prefix of its smallest member that is not deeper
    SELECT a.node, a.depth, count(*) FILTER (b.n IS NULL) AS n_leaves, sum((u.n_convs - 1) * u.size) AS saved_tokens
    FROM nodes u JOIN prefixes a ON a.conv_id = u.conv_id AND a.depth <= u.depth LEFT JOIN below b ON b.parent = u.node
    GROUP BY a.node, a.depth
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(b.n, 0) AS n_children, s.n_leaves,
       s.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN sums s ON s.node = n.node LEFT JOIN nodes p ON p.node = n.parent LEFT JOIN below b ON b.parent = n.node
"""


LLM_QUERIES["pipeline"] = corpus_pipeline.run
