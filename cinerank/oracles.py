"""The same results as plain SQL, written independently of the Spark plans, for DuckDB over the same tables."""

from __future__ import annotations

# Genre words of the test movies, and the genres that get a top list.
GENRES = (
    "Action", "Adventure", "Animation", "Comedy", "Crime", "Documentary", "Drama", "Family", "Fantasy", "Foreign",
    "History", "Horror", "Musical", "Mystery", "Romance", "Science Fiction", "TV Movie", "Thriller", "War", "Western",
)
TOP_GENRES = (
    "Action", "Adventure", "Animation", "Comedy", "Crime", "Documentary", "Drama", "Family", "Fantasy", "Foreign",
    "History", "Horror", "Music", "Mystery", "Romance", "Science", "Tv", "Thriller", "War", "Western",
)

# The bucket, of 50, that Spark's HashingTF gives each genre word.
_BUCKETS = {
    "action": 33, "adventure": 33, "animation": 3, "comedy": 32, "crime": 31, "documentary": 12, "drama": 44,
    "family": 47, "fantasy": 9, "foreign": 6, "history": 43, "horror": 16, "musical": 6, "mystery": 9, "romance": 26,
    "science": 13, "fiction": 14, "tv": 47, "movie": 39, "thriller": 36, "war": 19, "western": 24,
}


def _strings(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


_RATINGS = """ratings AS (
  SELECT o_custkey::INT AS uid, l_partkey::INT AS mid, ceil(l_quantity / 5) / 2 AS score,
         (epoch_us(l_shipdate) // 1000000)::INT AS "timestamp"
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

_MOVIES = f"""movies AS (
  SELECT p_partkey::INT AS mid, p_name AS name, p_brand AS descri, p_size || ' min' AS timelong, '' AS issue,
         '' AS shoot, 'en' AS language,
         g[p_partkey % 20 + 1] || '|' || g[p_size % 20 + 1]
           || CASE WHEN p_partkey % 3 = 0 THEN '|' || g[(p_partkey // 20) % 20 + 1] ELSE '' END AS genres,
         '' AS actors, '' AS directors
  FROM (SELECT *, {_strings(GENRES)} AS g FROM part))"""

_TAGS = """tags AS (
  SELECT user_id::INT AS uid, json_extract(props, '$.k')::INT AS mid, event_type AS tag,
         (epoch_us(ts) // 1000000)::INT AS "timestamp"
  FROM events)"""

_PAYLOADS = """payloads AS (
  SELECT user_id || '|' || json_extract(props, '$.k') || '|' || (((event_id % 10) + 1) / 2.0)::DOUBLE || '|'
         || (epoch_us(ts) // 1000000) AS value
  FROM events WHERE event_id % 2 = 0)"""

_AVERAGES = "averages AS (SELECT mid, avg(score) AS avg FROM ratings GROUP BY mid)"

_TOP = f"""top AS (
  SELECT genre AS genres, row_number() OVER (PARTITION BY genre ORDER BY avg DESC, mid)::INT AS rank, mid, avg AS score
  FROM movies JOIN averages USING (mid)
  JOIN (SELECT unnest({_strings(TOP_GENRES)}) AS genre) ON contains(lower(genres), lower(genre)))"""

_WORDS = """words AS (
  SELECT mid, unnest(string_split(lower(replace(genres, '|', ' ')), ' ')) AS word FROM movies)"""

_HASHED = "hashed AS (SELECT mid, bucket AS term FROM words JOIN (VALUES {}) b(w, bucket) ON w = word)".format(
    ", ".join(f"('{w}', {b})" for w, b in _BUCKETS.items()))


def _vectors(terms: str) -> str:
    return f"""tf AS (SELECT mid, term, count(*)::DOUBLE AS tf FROM ({terms}) GROUP BY mid, term),
idf AS (
  SELECT term, count(*) AS df, ln(((SELECT count(*) FROM movies) + 1.0::DOUBLE) / (count(*) + 1.0::DOUBLE)) AS idf
  FROM tf GROUP BY term),
vectors AS (SELECT mid, term, tf, tf * idf AS weight FROM tf JOIN idf USING (term))"""


_COSINES = """norms AS (SELECT mid, sqrt(sum(weight * weight)) AS norm FROM vectors GROUP BY mid),
cosines AS (
  SELECT a.mid, b.mid AS rec_mid, round(sum(a.weight / na.norm * (b.weight / nb.norm)), 9) AS score
  FROM vectors a JOIN vectors b ON a.term = b.term AND a.mid <> b.mid
  JOIN norms na ON na.mid = a.mid AND na.norm > 0 JOIN norms nb ON nb.mid = b.mid AND nb.norm > 0
  GROUP BY a.mid, b.mid),
recs AS MATERIALIZED (
  SELECT mid, row_number() OVER (PARTITION BY mid ORDER BY score DESC, rec_mid)::INT AS rank, rec_mid, score
  FROM cosines WHERE score > 0.6)"""

_HASHED_RECS = f"{_MOVIES}, {_WORDS}, {_HASHED}, {_vectors('SELECT mid, term FROM hashed')}, {_COSINES}"
_WORD_RECS = f"{_MOVIES}, {_WORDS}, {_vectors('SELECT mid, word AS term FROM words')}, {_COSINES}"

_RECENT = """recent AS MATERIALIZED (
  SELECT uid, row_number() OVER (PARTITION BY uid ORDER BY "timestamp" DESC, mid DESC, score DESC)::INT AS rank,
         mid, score, "timestamp"
  FROM ratings QUALIFY row_number() OVER (PARTITION BY uid ORDER BY "timestamp" DESC, mid DESC, score DESC) <= 20)"""

_CANDIDATES = """candidates AS (
  SELECT t.uid, row_number() OVER (PARTITION BY t.uid ORDER BY r.score DESC, r.rec_mid)::INT AS rank, r.rec_mid AS mid
  FROM recent t JOIN recs r ON r.mid = t.mid
  WHERE t.rank = 1
    AND NOT EXISTS (SELECT 1 FROM ratings x WHERE x.uid = t.uid AND x.mid = r.rec_mid)
  QUALIFY row_number() OVER (PARTITION BY t.uid ORDER BY r.score DESC, r.rec_mid) <= 20)"""

_STREAM = """scored AS (
  SELECT c.uid, c.mid,
         sum((s.score * r.score)::DECIMAL(20, 12))::DOUBLE / count(*)
           + log10(greatest(count(*) FILTER (r.score > 3), 1)) - log10(greatest(count(*) FILTER (r.score <= 3), 1)) AS score
  FROM candidates c JOIN recent r ON r.uid = c.uid JOIN recs s ON s.mid = c.mid AND s.rec_mid = r.mid
  WHERE s.score > 0.7
  GROUP BY c.uid, c.mid)"""

_REALTIME = f"{_RATINGS}, {_HASHED_RECS}, {_RECENT}"

_STREAM_RECS = f"""WITH {_REALTIME}, {_CANDIDATES}, {_STREAM}
SELECT uid, row_number() OVER (PARTITION BY uid ORDER BY score DESC, mid)::INT AS rank, mid, round(score, 6) AS score
FROM scored"""

_SPLIT = """split AS (
  SELECT *, CASE WHEN ('0x' || substr(md5('42|' || uid || '|' || mid || '|' || score::DECIMAL(18, 6) || '|' || "timestamp"), 1, 8))
                      ::BIGINT % 10000 < 8000 THEN 'training' ELSE 'test' END AS side
  FROM ratings)"""

_RECENT_RATINGS = f'WITH {_RATINGS}, {_RECENT} SELECT uid, rank, mid, score, "timestamp" FROM recent'
_TOP_LISTS = f"""WITH {_RATINGS}, {_MOVIES}, {_AVERAGES}, {_TOP}
SELECT genres, rank, mid, round(score, 6) AS score FROM top WHERE rank <= 10"""
_DOCUMENT = f"""{_MOVIES}, {_TAGS},
merged AS (SELECT mid, string_agg(tag, '|' ORDER BY tag) AS tags FROM (SELECT DISTINCT mid, tag FROM tags) GROUP BY mid)"""

_LATENT_RECS = """latent AS MATERIALIZED (SELECT vec_id::INT AS id, embedding::DOUBLE[] AS e FROM embeddings),
recs AS MATERIALIZED (
  SELECT mid, row_number() OVER (PARTITION BY mid ORDER BY score DESC, rec_mid)::INT AS rank, rec_mid, score
  FROM (SELECT a.id AS mid, b.id AS rec_mid, round(list_cosine_similarity(a.e, b.e), 9) AS score
        FROM latent a JOIN latent b ON a.id <> b.id)
  WHERE score > 0.3)"""

ORACLES: dict[str, str] = {
    "ratings_from_files": f"WITH {_RATINGS} SELECT * FROM ratings",
    "rejected_tag_files": f"""WITH {_TAGS}, lines AS (
  SELECT (uid % 4)::INT AS part, CASE WHEN tag = 'error' THEN 'u' ELSE '' END || uid || ',' || mid || ',' || tag || ',' || "timestamp" AS value,
         tag = 'error' AS bad
  FROM tags), numbered AS (SELECT *, row_number() OVER (PARTITION BY part ORDER BY value) AS line FROM lines)
SELECT part, line, value FROM numbered WHERE bad""",
    "newest_month_movies": f"""WITH {_RATINGS}, monthly AS (
  SELECT mid, count(mid) AS count, strftime(make_timestamp("timestamp"::BIGINT * 1000000), '%Y%m')::INT AS yearmonth
  FROM ratings GROUP BY mid, yearmonth)
SELECT row_number() OVER (ORDER BY count DESC, mid)::INT AS rank, mid, count, yearmonth
FROM monthly WHERE yearmonth = (SELECT max(yearmonth) FROM monthly) ORDER BY count DESC, mid LIMIT 100""",
    "rate_more_movies_sql": f"WITH {_RATINGS} SELECT mid, count(mid) AS count FROM ratings GROUP BY mid",
    "rate_more_recently_movies_sql": f"""WITH {_RATINGS}
SELECT mid, count(mid) AS count, strftime(make_timestamp("timestamp"::BIGINT * 1000000), '%Y%m')::INT AS yearmonth
FROM ratings GROUP BY mid, yearmonth HAVING yearmonth >= 199601""",
    "genre_top_movies_sql": f"""WITH {_RATINGS}, {_MOVIES}, {_AVERAGES}
SELECT mid, round(avg, 6) AS score FROM movies JOIN averages USING (mid) WHERE contains(lower(genres), 'science')
ORDER BY avg DESC, mid LIMIT 25""",
    "movie_recs_stored": f"WITH {_LATENT_RECS} SELECT mid, rank, rec_mid, score FROM recs",
    "stream_recs_movie_recs": f"""WITH {_RATINGS}, {_LATENT_RECS}, {_RECENT}, {_CANDIDATES}, {_STREAM.replace("s.score > 0.7", "s.score > 0.3")}
SELECT uid, row_number() OVER (PARTITION BY uid ORDER BY score DESC, mid)::INT AS rank, mid, round(score, 6) AS score
FROM scored""",
    "parse_movies": f"WITH {_MOVIES} SELECT * FROM movies",
    "parse_ratings": f"WITH {_RATINGS} SELECT * FROM ratings",
    "parse_tags": f"WITH {_TAGS} SELECT * FROM tags",
    "rejected_tag_lines": f"""WITH {_TAGS}
SELECT 'u' || uid || ',' || mid || ',' || tag || ',' || "timestamp" AS value FROM tags WHERE tag = 'error'""",
    "stored_ratings": f"WITH {_RATINGS} SELECT * FROM ratings",
    "movie_tags_document": f"WITH {_DOCUMENT} SELECT movies.*, tags FROM movies LEFT JOIN merged USING (mid)",
    "stored_search_documents": f"WITH {_DOCUMENT} SELECT mid, name, tags FROM movies LEFT JOIN merged USING (mid)",
    "rate_more_movies": f"WITH {_RATINGS} SELECT mid, count(mid) AS count FROM ratings GROUP BY mid",
    "rate_more_recently_movies": f"""WITH {_RATINGS}
SELECT mid, count(mid) AS count, strftime(make_timestamp("timestamp"::BIGINT * 1000000), '%Y%m')::INT AS yearmonth
FROM ratings GROUP BY mid, yearmonth""",
    "average_movies": f"WITH {_RATINGS}, {_AVERAGES} SELECT mid, round(avg, 6) AS avg FROM averages",
    "movie_average_join": f"""WITH {_RATINGS}, {_MOVIES}, {_AVERAGES}
SELECT mid, name, genres, round(avg, 6) AS avg FROM movies JOIN averages USING (mid)""",
    "genres_top_movies": _TOP_LISTS,
    "genres_top_movies_packed": _TOP_LISTS,
    "distinct_users": f"WITH {_RATINGS} SELECT DISTINCT uid FROM ratings",
    "distinct_rated_movies": f"WITH {_RATINGS} SELECT DISTINCT mid FROM ratings",
    "genre_document_frequencies": f"WITH {_HASHED_RECS} SELECT term, df, round(idf, 9) AS idf FROM idf",
    "genre_tfidf": f"WITH {_HASHED_RECS} SELECT mid, term, tf, round(weight, 9) AS weight FROM vectors",
    "genre_tfidf_exact": f"WITH {_WORD_RECS} SELECT mid, term, tf, round(weight, 9) AS weight FROM vectors",
    "content_movie_recs": f"WITH {_HASHED_RECS} SELECT mid, rank, rec_mid, score FROM recs",
    "content_movie_recs_exact": f"WITH {_WORD_RECS} SELECT mid, rank, rec_mid, score FROM recs",
    "embedding_similarity": """WITH v AS (SELECT vec_id::INT AS id, embedding::DOUBLE[] AS e FROM embeddings),
pairs AS (
  SELECT a.id AS mid, b.id AS rec_mid, list_cosine_similarity(a.e, b.e) AS score
  FROM v a JOIN v b ON a.id <> b.id)
SELECT mid, rec_mid, round(score, 9) AS score FROM pairs WHERE round(score, 9) > 0.3""",
    "log_filter": f"WITH {_PAYLOADS} SELECT value FROM payloads",
    "log_copy_streaming": f"WITH {_PAYLOADS} SELECT value FROM payloads",
    "rejected_events": """SELECT user_id || '|' || json_extract(props, '$.k') || '|'
       || ['1e9', 'Infinity', 'NaN', '', '-0.5', 'good'][(epoch_us(ts) // 1000000 % 6)::INT + 1] || '|' || (epoch_us(ts) // 1000000) AS value
FROM events WHERE event_id % 2 = 0 AND epoch_us(ts) // 1000000 % 6 < 5""",
    "rating_event_parse": """SELECT user_id::INT AS uid, json_extract(props, '$.k')::INT AS mid,
       ((event_id % 10) + 1) / 2.0::DOUBLE AS score, (epoch_us(ts) // 1000000)::INT AS "timestamp"
FROM events WHERE event_id % 2 = 0""",
    "user_recent_ratings": _RECENT_RATINGS,
    "stream_recent_ratings": _RECENT_RATINGS,
    "unrated_candidates": f"WITH {_REALTIME}, {_CANDIDATES} SELECT uid, rank, mid FROM candidates",
    "recent_similarity": f"""WITH {_REALTIME}
SELECT n.uid, o.rank, n.mid, o.mid AS other, coalesce(s.score, 0.0::DOUBLE) AS sim
FROM recent n JOIN recent o ON o.uid = n.uid AND n.rank = 1 AND o.rank > 1
LEFT JOIN recs s ON s.mid = n.mid AND s.rec_mid = o.mid""",
    "stream_recs_replay": _STREAM_RECS,
    "stream_recs_streaming": _STREAM_RECS,
    "user_rec_list_sizes": f"""WITH {_REALTIME}, {_CANDIDATES}, {_STREAM}
SELECT u.uid, count(s.mid)::INT AS n_recs
FROM (SELECT DISTINCT uid FROM ratings) u LEFT JOIN scored s ON s.uid = u.uid GROUP BY u.uid""",
    "train_test_split": f"WITH {_RATINGS}, {_SPLIT} SELECT uid, mid, score, \"timestamp\", side FROM split",
    "als_user_recs": f"""WITH {_RATINGS}
SELECT DISTINCT uid, 0::BIGINT AS wrong_places, 0::BIGINT AS repeated, 0::BIGINT AS listed_seen FROM ratings""",
    "als_user_recs_unseen": f"""WITH {_RATINGS}
SELECT DISTINCT uid, 0::BIGINT AS wrong_places, 0::BIGINT AS repeated, 0::BIGINT AS listed_seen FROM ratings""",
    "als_movie_recs": f"""WITH {_RATINGS}
SELECT DISTINCT mid, 0::BIGINT AS missing, 0::BIGINT AS extra, 0::BIGINT AS rank_gaps FROM ratings""",
    "als_grid_search": f"""WITH {_RATINGS}, {_SPLIT}
SELECT rank, "lambda", (SELECT count(*) FROM split WHERE side = 'training') AS training_rows,
       (SELECT count(*) FROM split WHERE side = 'test') AS test_rows, true AS has_error, true AS best_is_lowest
FROM (SELECT unnest([20, 50, 100, 200, 300])::INT AS rank), (SELECT unnest([0.01, 0.1, 1.0])::DOUBLE AS "lambda")""",
    "als_best_parameters": f"""WITH {_RATINGS}
SELECT 1::BIGINT AS best_rows, 0::INT AS lower_rows WHERE EXISTS (SELECT 1 FROM ratings)""",
    "rmse_exact": f"""WITH {_RATINGS}, {_AVERAGES}
SELECT round(sqrt(avg((score - avg) * (score - avg))), 6) AS rmse FROM ratings JOIN averages USING (mid)""",
}
