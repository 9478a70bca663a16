"""DuckDB oracle statements, one per registered query with a SQL form.

Each statement runs on the driver's tables (pre-registered views) after the
``PRELUDE`` of derived views; results are compared order-insensitively.
"""

PRELUDE = """WITH ratings_1 AS (SELECT o_custkey AS user_id, l_partkey AS movie_id, l_quantity AS rating, l_shipdate AS ts
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linenumber <= 3),
ratings_2 AS (SELECT o_custkey AS user_id, l_partkey AS movie_id, l_quantity AS rating, l_shipdate AS ts
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linenumber > 3),
ratings AS (SELECT * FROM ratings_1 UNION ALL SELECT * FROM ratings_2),
movies AS (SELECT p_partkey AS movie_id, p_name AS title FROM part),
users AS (SELECT c_custkey AS user_id,
    CASE c_mktsegment WHEN 'BUILDING' THEN 'M' WHEN 'FURNITURE' THEN 'F' ELSE 'U' END AS gender,
    10 + 2 * c_nationkey + c_custkey % 2 AS age, c_nationkey AS occ_id FROM customer),
occupations AS (SELECT n_nationkey AS occ_id, n_name AS occupation FROM nation),
reviews AS (SELECT o_orderkey AS order_id,
    CASE WHEN o_orderkey % 10 = 0 THEN o_orderstatus ELSE substr(o_orderpriority, 1, 1) END AS review_score FROM orders
    UNION ALL SELECT o_orderkey, substr(o_orderpriority, 1, 1) FROM orders WHERE o_orderkey % 7 = 0),
mask8 AS (SELECT vec_id AS frame_id, (i - 1) // 8 AS y, (i - 1) % 8 AS x,
    CASE WHEN CAST(embedding[i] AS DOUBLE) > CAST(0.1 AS DOUBLE) THEN 255 ELSE 0 END AS v
    FROM embeddings, range(1, 65) AS t(i)),
maskq AS (SELECT vec_id AS frame_id, i // 8 AS y, i % 8 AS x,
    CASE WHEN CAST(embedding[i + 1] AS DOUBLE) + CASE WHEN embedding[(i // 32) * 2 + (i % 8) // 4 + 1] > 0 THEN 0.6e0 ELSE -0.6e0 END > 0.1e0
    THEN 255 ELSE 0 END AS v FROM embeddings, range(0, 64) AS t(i)),
frame8 AS (SELECT vec_id AS frame_id, i // 8 AS y, i % 8 AS x,
    greatest(0, least(255, CAST(floor((CAST(embedding[(i + 21) % 64 + 1] AS DOUBLE) + 0.5e0) * 256) AS INTEGER))) AS b,
    greatest(0, least(255, CAST(floor((CAST(embedding[i + 1] AS DOUBLE) + 0.5e0) * 256) AS INTEGER)
      + CASE WHEN embedding[(i // 32) * 2 + (i % 8) // 4 + 1] > 0 THEN 80 ELSE -80 END)) AS g,
    greatest(0, least(255, CAST(floor((CAST(embedding[(i + 42) % 64 + 1] AS DOUBLE) + 0.5e0) * 256) AS INTEGER))) AS r
    FROM embeddings, range(0, 64) AS t(i)),
text_ratings AS (SELECT user_id, movie_id, rating FROM ratings
    UNION ALL SELECT 1, p_partkey, 3.0 FROM part WHERE p_partkey % 70 = 0)"""

STATEMENTS: dict[str, str] = {
    "movie_stats": """SELECT m.movie_id, m.title, round(avg(rating), 2) AS avg_rating, count(*) AS total_ratings
FROM ratings r JOIN movies m ON r.movie_id = m.movie_id GROUP BY m.movie_id, m.title""",
    "movies_min_count": """SELECT m.movie_id, count(*) AS total_ratings FROM ratings r JOIN movies m ON r.movie_id = m.movie_id
GROUP BY m.movie_id HAVING count(*) >= 30""",
    "top_rated_movie": """SELECT m.movie_id, m.title, round(sum(rating) / count(*), 2) AS avg_rating, count(*) AS total_ratings
FROM ratings r JOIN movies m ON r.movie_id = m.movie_id GROUP BY m.movie_id, m.title
HAVING count(*) >= 5 ORDER BY sum(rating) / count(*) DESC, m.movie_id LIMIT 1""",
    "movie_report": """SELECT m.movie_id, m.title || ' AverageRating: ' || printf('%.2f', avg(rating)) || ' (TotalRatings: ' || count(*) || ')' AS report_line
FROM ratings r JOIN movies m ON r.movie_id = m.movie_id GROUP BY m.movie_id, m.title""",
    "genre_explode": """SELECT movie_id, unnest(string_split(title, ' ')) AS genre FROM movies""",
    "genre_stats": """SELECT genre, round(avg(rating), 2) AS avg_rating, count(*) AS total_ratings FROM
(SELECT rating, unnest(string_split(title, ' ')) AS genre FROM ratings r JOIN movies m ON r.movie_id = m.movie_id) GROUP BY genre""",
    "gender_avg_long": """SELECT movie_id, gender, round(avg(rating), 2) AS avg_rating FROM ratings r JOIN users u ON r.user_id = u.user_id GROUP BY movie_id, gender""",
    "gender_list": """SELECT movie_id, string_agg(gender, ',' ORDER BY gender) AS genders FROM
(SELECT DISTINCT movie_id, gender FROM ratings r JOIN users u ON r.user_id = u.user_id) GROUP BY movie_id""",
    "gender_pivot": """SELECT m.movie_id, m.title, round(avg(CASE WHEN gender = 'M' THEN rating END), 2) AS male_avg, round(avg(CASE WHEN gender = 'F' THEN rating END), 2) AS female_avg
FROM ratings r JOIN users u ON r.user_id = u.user_id JOIN movies m ON r.movie_id = m.movie_id GROUP BY m.movie_id, m.title""",
    "gender_report": """SELECT m.movie_id, m.title || ' - Male_Avg: ' || coalesce(printf('%.2f', avg(CASE WHEN gender = 'M' THEN rating END)), 'NA') ||
  ', Female_Avg: ' || coalesce(printf('%.2f', avg(CASE WHEN gender = 'F' THEN rating END)), 'NA') AS report_line
FROM ratings r JOIN users u ON r.user_id = u.user_id JOIN movies m ON r.movie_id = m.movie_id GROUP BY m.movie_id, m.title""",
    "age_bucket": """SELECT user_id, CASE WHEN age <= 18 THEN '0-18' WHEN age <= 35 THEN '18-35' WHEN age <= 50 THEN '35-50' ELSE '50+' END AS age_group FROM users""",
    "age_avg_long": """SELECT movie_id, CASE WHEN age <= 18 THEN '0-18' WHEN age <= 35 THEN '18-35' WHEN age <= 50 THEN '35-50' ELSE '50+' END AS age_group, round(avg(rating), 2) AS avg_rating
FROM ratings r JOIN users u ON r.user_id = u.user_id GROUP BY 1, 2""",
    "age_pivot": """SELECT m.movie_id, m.title, round(avg(CASE WHEN age <= 18 THEN rating END), 2) AS age_0_18,
  round(avg(CASE WHEN age > 18 AND age <= 35 THEN rating END), 2) AS age_18_35,
  round(avg(CASE WHEN age > 35 AND age <= 50 THEN rating END), 2) AS age_35_50, round(avg(CASE WHEN age > 50 THEN rating END), 2) AS age_50_plus
FROM ratings r JOIN users u ON r.user_id = u.user_id JOIN movies m ON r.movie_id = m.movie_id GROUP BY m.movie_id, m.title""",
    "occupation_stats": """SELECT occupation, round(avg(rating), 2) AS avg_rating, count(*) AS total_ratings
FROM ratings r JOIN users u ON r.user_id = u.user_id JOIN occupations o ON u.occ_id = o.occ_id GROUP BY o.occ_id, occupation""",
    "year_stats": """SELECT CAST(year(ts) AS BIGINT) AS year, count(*) AS total_ratings, round(avg(rating), 2) AS avg_rating FROM ratings GROUP BY 1""",
    "ratings_union": """SELECT user_id, movie_id, rating, count(*) AS n FROM ratings GROUP BY user_id, movie_id, rating""",
    "entity_counts": """SELECT (SELECT count(*) FROM orders) AS total_orders,
  (SELECT count(*) FROM (SELECT DISTINCT c_custkey FROM customer)) AS total_customers,
  (SELECT count(*) FROM (SELECT DISTINCT l_suppkey FROM lineitem)) AS total_sellers""",
    "orders_by_country": """SELECT n_name AS country, count(*) AS cnt FROM customer JOIN orders ON c_custkey = o_custkey
JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name ORDER BY cnt DESC, country""",
    "orders_by_month": """SELECT CAST(year(o_orderdate) AS BIGINT) AS order_year, CAST(month(o_orderdate) AS BIGINT) AS order_month, count(*) AS cnt
FROM orders GROUP BY 1, 2 ORDER BY 1, 2 DESC""",
    "score_hist_raw": """SELECT review_score, count(*) AS cnt FROM reviews GROUP BY review_score""",
    "score_clean": """SELECT order_id, review_score FROM reviews WHERE review_score IN ('1','2','3','4','5')""",
    "score_distinct": """SELECT DISTINCT review_score FROM reviews WHERE review_score IN ('1','2','3','4','5')""",
    "score_hist_clean": """SELECT review_score, count(*) AS cnt FROM reviews WHERE review_score IN ('1','2','3','4','5') GROUP BY review_score ORDER BY 1""",
    "score_avg": """SELECT avg(CAST(review_score AS INT)) AS avg_score, count(*) AS n FROM reviews WHERE review_score IN ('1','2','3','4','5')""",
    "item_total_value": """SELECT l_orderkey, l_linenumber, l_partkey, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) + CAST(l_tax AS DECIMAL(18,2)) AS DOUBLE) AS total_value FROM lineitem""",
    "product_order_join": """SELECT p_partkey, p_type, l_orderkey, l_linenumber, o_custkey FROM part
JOIN lineitem ON p_partkey = l_partkey JOIN orders ON l_orderkey = o_orderkey""",
    "revenue_by_category": """SELECT p_type AS category, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) + CAST(l_tax AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue
FROM part JOIN lineitem ON p_partkey = l_partkey JOIN orders ON l_orderkey = o_orderkey
WHERE o_orderdate >= DATE '2000-01-01' AND o_orderdate < DATE '2001-01-01' GROUP BY p_type ORDER BY total_revenue DESC, category""",
    "product_sales_score": """SELECT l_partkey AS product_id, count(l_partkey) AS total_sold, round(avg(CAST(review_score AS INT)), 2) AS avg_score
FROM lineitem JOIN (SELECT * FROM reviews WHERE review_score IN ('1','2','3','4','5')) ON l_orderkey = order_id
JOIN orders ON l_orderkey = o_orderkey GROUP BY l_partkey""",
    "top_products": """SELECT l_partkey AS product_id, count(l_partkey) AS total_sold, round(avg(CAST(review_score AS INT)), 2) AS avg_score
FROM lineitem JOIN (SELECT * FROM reviews WHERE review_score IN ('1','2','3','4','5')) ON l_orderkey = order_id
JOIN orders ON l_orderkey = o_orderkey GROUP BY l_partkey ORDER BY total_sold DESC, product_id LIMIT 10""",
    "packet_encode": """SELECT event_type AS key, CAST(json_object('camera_id', event_type, 'timestamp_ms', epoch_us(ts) // 1000, 'frame_number', event_id) AS VARCHAR) AS value FROM events""",
    "packet_decode": """SELECT event_id, event_type AS camera_id, CAST(json_extract(props, '$.k') AS INT) AS k FROM events""",
    "stream_ingest": """SELECT event_id, event_type AS camera_id, CAST(json_extract(props, '$.k') AS INT) AS k FROM events""",
    "stream_resume": """SELECT event_id, event_type AS camera_id, CAST(json_extract(props, '$.k') AS INT) AS k FROM events""",
    "stream_batch_counts": """SELECT event_id % 5 AS part, CAST(1 AS BIGINT) AS batches, count(*) AS processed FROM events GROUP BY 1""",
    "payload_base64": """SELECT doc_id, to_base64(encode(text)) AS frame_data FROM documents""",
    "payload_roundtrip": """SELECT doc_id, octet_length(from_base64(to_base64(encode(text)))) AS n_bytes FROM documents""",
    "frame_filename": """SELECT event_id, event_type || '_' || printf('%06d', event_id) || '.png' AS filename FROM events""",
    "frame_dedup_last": """SELECT event_type AS camera_id, user_id AS frame_number, arg_max(event_id, (ts, event_id)) AS event_id FROM events GROUP BY 1, 2""",
    "packet_validity": """SELECT doc_id, CASE WHEN camera_id IS NULL THEN 'Missing field: camera_id' WHEN quality NOT BETWEEN 0 AND 100 THEN 'quality must be 0-100'
  WHEN width <= 0 OR height <= 0 THEN 'Invalid frame dimensions' WHEN length(frame_data) % 4 <> 0 THEN 'frame_data is not valid base64'
  ELSE 'Valid packet' END AS message FROM (SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN NULL ELSE source END AS camera_id, CASE WHEN doc_id % 13 = 0 THEN 101 ELSE 85 END AS quality, CASE WHEN doc_id % 17 = 0 THEN 0 ELSE 640 END AS width, 480 AS height, CASE WHEN doc_id % 19 = 0 THEN 'abc' ELSE 'aGVsbG8=' END AS frame_data FROM documents)""",
    "missing_outputs": """SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderdate >= DATE '2001-01-01')""",
    "frame_count_check": """SELECT event_type AS camera_id, count(*) AS frames, count(*) = 2000 AS ok FROM events GROUP BY 1""",
    "camera_throughput": """SELECT event_type AS camera_id, count(*) AS frames,
  round(count(*) * CAST(1000 AS DOUBLE) / (epoch_us(max(ts)) // 1000 - epoch_us(min(ts)) // 1000), 6) AS fps FROM events GROUP BY 1""",
    "stage_latency": """SELECT event_type AS stage, min(value) AS min_ms, max(value) AS max_ms, round(CAST(sum(CAST(value AS DECIMAL(28,10))) AS DOUBLE) / count(*), 4) AS avg_ms FROM events GROUP BY 1""",
    "frame_total_latency": """SELECT round(CAST(sum(t) AS DOUBLE) / count(*), 4) AS avg_total_ms FROM (SELECT user_id, sum(CAST(value AS DECIMAL(28,10))) AS t FROM events GROUP BY user_id)""",
    "latency_histogram": """SELECT event_type AS stage, count(CASE WHEN value <= 1 THEN 1 END) AS le_1, count(CASE WHEN value <= 10 THEN 1 END) AS le_10, count(CASE WHEN value <= 50 THEN 1 END) AS le_50, count(CASE WHEN value <= 100 THEN 1 END) AS le_100, count(*) AS le_inf FROM events GROUP BY 1""",
    "message_volume": """SELECT count(*) AS total_messages, round(CAST(sum(octet_length(encode(text))) AS DOUBLE) / 1048576, 6) AS total_mb FROM documents""",
    "alpha_threshold": """SELECT frame_id, y, x, 255 - v AS alpha FROM mask8""",
    "mask_dilate": """SELECT a.frame_id, a.y, a.x, max(b.v) AS v FROM maskq a CROSS JOIN (VALUES (-2,0),(-1,-2),(-1,-1),(-1,0),(-1,1),(-1,2),(0,-2),(0,-1),(0,0),(0,1),(0,2),(1,-2),(1,-1),(1,0),(1,1),(1,2),(2,0)) AS se(dy, dx)
JOIN maskq b ON b.frame_id = a.frame_id AND b.y = a.y + dy AND b.x = a.x + dx GROUP BY 1, 2, 3""",
    "mask_erode": """SELECT a.frame_id, a.y, a.x, min(b.v) AS v FROM maskq a CROSS JOIN (VALUES (-2,0),(-1,-2),(-1,-1),(-1,0),(-1,1),(-1,2),(0,-2),(0,-1),(0,0),(0,1),(0,2),(1,-2),(1,-1),(1,0),(1,1),(1,2),(2,0)) AS se(dy, dx)
JOIN maskq b ON b.frame_id = a.frame_id AND b.y = a.y + dy AND b.x = a.x + dx GROUP BY 1, 2, 3""",
    "chroma_mask": """SELECT frame_id, y, x, CASE WHEN h BETWEEN 35 AND 90 AND s BETWEEN 40 AND 255 AND mx BETWEEN 40 AND 255 THEN 255 ELSE 0 END AS v FROM (
  SELECT *, CASE WHEN h0 < 0 THEN h0 + 180 ELSE h0 END AS h FROM (
  SELECT *, CASE WHEN mx = 0 THEN 0 ELSE floor((d * round(1044480.0 / mx) + 2048) / 4096) END AS s,
    CASE WHEN d = 0 THEN 0 ELSE floor(((CASE WHEN mx = r THEN g - b WHEN mx = g THEN b - r + 2 * d ELSE r - g + 4 * d END) * round(122880.0 / d) + 2048) / 4096) END AS h0 FROM (
  SELECT *, greatest(b, g, r) AS mx, greatest(b, g, r) - least(b, g, r) AS d FROM frame8)))""",
    "movie_stats_text": """SELECT m.movie_id, m.title, round(avg(rating), 2) AS avg_rating, count(*) AS total_ratings
FROM ratings r JOIN movies m ON r.movie_id = m.movie_id GROUP BY m.movie_id, m.title""",
    "orders_by_country_csv": """SELECT n_name AS country, count(*) AS cnt FROM customer JOIN orders ON c_custkey = o_custkey
JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name ORDER BY cnt DESC, country""",
    "chroma_key_alpha": """SELECT frame_id, y, x, CAST(255 - v AS INTEGER) AS alpha FROM (
WITH m0 AS (SELECT frame_id, y, x, CASE WHEN h BETWEEN 35 AND 90 AND s BETWEEN 40 AND 255 AND mx BETWEEN 40 AND 255 THEN 255 ELSE 0 END AS v FROM (
  SELECT *, CASE WHEN h0 < 0 THEN h0 + 180 ELSE h0 END AS h FROM (
  SELECT *, CASE WHEN mx = 0 THEN 0 ELSE floor((d * round(1044480.0 / mx) + 2048) / 4096) END AS s,
    CASE WHEN d = 0 THEN 0 ELSE floor(((CASE WHEN mx = r THEN g - b WHEN mx = g THEN b - r + 2 * d ELSE r - g + 4 * d END) * round(122880.0 / d) + 2048) / 4096) END AS h0 FROM (
  SELECT *, greatest(b, g, r) AS mx, greatest(b, g, r) - least(b, g, r) AS d FROM frame8)))),
se AS (SELECT * FROM (VALUES (-2,0),(-1,-2),(-1,-1),(-1,0),(-1,1),(-1,2),(0,-2),(0,-1),(0,0),(0,1),(0,2),(1,-2),(1,-1),(1,0),(1,1),(1,2),(2,0)) AS t(dy, dx)),
c1 AS (SELECT a.frame_id, a.y, a.x, max(b.v) AS v FROM m0 a CROSS JOIN se JOIN m0 b ON b.frame_id = a.frame_id AND b.y = a.y + se.dy AND b.x = a.x + se.dx GROUP BY 1, 2, 3),
c2 AS (SELECT a.frame_id, a.y, a.x, min(b.v) AS v FROM c1 a CROSS JOIN se JOIN c1 b ON b.frame_id = a.frame_id AND b.y = a.y + se.dy AND b.x = a.x + se.dx GROUP BY 1, 2, 3),
o1 AS (SELECT a.frame_id, a.y, a.x, min(b.v) AS v FROM c2 a CROSS JOIN se JOIN c2 b ON b.frame_id = a.frame_id AND b.y = a.y + se.dy AND b.x = a.x + se.dx GROUP BY 1, 2, 3),
o2 AS (SELECT a.frame_id, a.y, a.x, max(b.v) AS v FROM o1 a CROSS JOIN se JOIN o1 b ON b.frame_id = a.frame_id AND b.y = a.y + se.dy AND b.x = a.x + se.dx GROUP BY 1, 2, 3),
k AS (SELECT * FROM (VALUES (-2,1),(-1,4),(0,6),(1,4),(2,1)) AS t(o, w)),
bl AS (SELECT a.frame_id, a.y, a.x, (sum(ky.w * kx.w * b.v) + 128) // 256 AS v FROM o2 a CROSS JOIN k ky CROSS JOIN k kx JOIN o2 b ON b.frame_id = a.frame_id AND b.y = (CASE WHEN a.y + ky.o < 0 THEN -(a.y + ky.o) WHEN a.y + ky.o > 7 THEN 14 - (a.y + ky.o) ELSE a.y + ky.o END) AND b.x = (CASE WHEN a.x + kx.o < 0 THEN -(a.x + kx.o) WHEN a.x + kx.o > 7 THEN 14 - (a.x + kx.o) ELSE a.x + kx.o END) GROUP BY 1, 2, 3)
SELECT * FROM bl)""",
    "segment_alpha": """SELECT frame_id, y, x, CASE WHEN (5 * r + 3 * g + 2 * b) / 2550e0 - 0.45e0 > 0.1e0 THEN 0 ELSE 255 END AS alpha FROM frame8""",
    "gender_avg_long_hot_split": """SELECT movie_id, gender, round(avg(rating), 2) AS avg_rating FROM ratings r JOIN users u ON r.user_id = u.user_id GROUP BY movie_id, gender""",
    "age_report": """SELECT m.movie_id, m.title || ' - [0-18: ' || coalesce(printf('%.2f', avg(CASE WHEN age <= 18 THEN rating END)), 'NA') ||
  ', 18-35: ' || coalesce(printf('%.2f', avg(CASE WHEN age > 18 AND age <= 35 THEN rating END)), 'NA') ||
  ', 35-50: ' || coalesce(printf('%.2f', avg(CASE WHEN age > 35 AND age <= 50 THEN rating END)), 'NA') ||
  ', 50+: ' || coalesce(printf('%.2f', avg(CASE WHEN age > 50 THEN rating END)), 'NA') || ']' AS report_line
FROM ratings r JOIN users u ON r.user_id = u.user_id JOIN movies m ON r.movie_id = m.movie_id GROUP BY m.movie_id, m.title""",
    "genre_report": """SELECT genre, genre || ' - AverageRating: ' || printf('%.2f', avg(rating)) || ' (TotalRatings: ' || count(*) || ')' AS report_line FROM
(SELECT rating, unnest(string_split(title, ' ')) AS genre FROM ratings r JOIN movies m ON r.movie_id = m.movie_id) GROUP BY genre""",
    "occupation_report": """SELECT occupation, occupation || ' - AverageRating: ' || printf('%.2f', avg(rating)) || ' (TotalRatings: ' || count(*) || ')' AS report_line
FROM ratings r JOIN users u ON r.user_id = u.user_id JOIN occupations o ON u.occ_id = o.occ_id GROUP BY o.occ_id, occupation""",
    "year_report": """SELECT CAST(year(ts) AS BIGINT) AS year, year(ts) || ' - TotalRatings: ' || count(*) || ', AverageRating: ' || printf('%.2f', avg(rating)) AS report_line
FROM ratings GROUP BY year(ts)""",
    "best_movie_report": """SELECT m.movie_id, m.title || ' is the highest rated movie with an average rating of ' || printf('%.2f', avg(rating)) ||
  ' among movies with at least 5 ratings.' AS report_line FROM ratings r JOIN movies m ON r.movie_id = m.movie_id GROUP BY m.movie_id, m.title
HAVING count(*) >= 5 ORDER BY avg(rating) DESC, m.movie_id LIMIT 1""",
    "gender_avg_list": """SELECT movie_id, string_agg(gender || ':' || printf('%.2f', a), ',' ORDER BY gender) AS genders FROM
(SELECT movie_id, gender, avg(rating) AS a FROM ratings r JOIN users u ON r.user_id = u.user_id GROUP BY movie_id, gender) GROUP BY movie_id""",
    "genre_stats_text": """SELECT genre, round(avg(rating), 2) AS avg_rating, count(*) AS total_ratings FROM
(SELECT rating, unnest(string_split(title, ' ')) AS genre FROM text_ratings r JOIN movies m ON r.movie_id = m.movie_id) GROUP BY genre""",
    "age_pivot_text": """SELECT m.movie_id, m.title, round(avg(CASE WHEN age <= 18 THEN rating END), 2) AS age_0_18,
  round(avg(CASE WHEN age > 18 AND age <= 35 THEN rating END), 2) AS age_18_35,
  round(avg(CASE WHEN age > 35 AND age <= 50 THEN rating END), 2) AS age_35_50, round(avg(CASE WHEN age > 50 THEN rating END), 2) AS age_50_plus
FROM text_ratings r JOIN users u ON r.user_id = u.user_id JOIN movies m ON r.movie_id = m.movie_id GROUP BY m.movie_id, m.title""",
    "occupation_stats_text": """SELECT occupation, round(avg(rating), 2) AS avg_rating, count(*) AS total_ratings
FROM text_ratings r JOIN users u ON r.user_id = u.user_id JOIN occupations o ON u.occ_id = o.occ_id GROUP BY o.occ_id, occupation""",
    "year_stats_text": """SELECT CAST(year(ts) AS BIGINT) AS year, count(*) AS total_ratings, round(avg(rating), 2) AS avg_rating FROM ratings GROUP BY 1""",
    "ratings_quarantine": """SELECT 'ratings' AS source, '1,' || p_partkey || ',many,0' AS value, 'bad or missing field: rating' AS reason FROM part WHERE p_partkey % 50 = 0
UNION ALL SELECT 'ratings', '1,' || p_partkey || ',3.0,noon', 'bad or missing field: ts' FROM part WHERE p_partkey % 70 = 0
UNION ALL SELECT 'users', 'u' || c_custkey || ',M,old,0', 'bad or missing field: age' FROM customer WHERE c_custkey % 40 = 0""",
    "orders_by_month_csv": """SELECT CAST(year(t) AS BIGINT) AS order_year, CAST(month(t) AS BIGINT) AS order_month, count(*) AS cnt
FROM (SELECT CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE o_orderdate END AS t FROM orders) GROUP BY 1, 2""",
    "revenue_by_category_csv": """SELECT p_type AS category, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) + CAST(l_tax AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue
FROM part JOIN lineitem ON p_partkey = l_partkey JOIN orders ON l_orderkey = o_orderkey
WHERE o_orderkey % 23 <> 0 AND o_orderdate >= DATE '2000-01-01' AND o_orderdate < DATE '2001-01-01' GROUP BY p_type""",
    "packet_encode_full": """SELECT event_type AS key, CAST(json_object('camera_id', event_type, 'timestamp_ms', epoch_us(ts) // 1000, 'frame_number', event_id,
  'width', 640, 'height', 480, 'encoding', 'RAW', 'frame_data', to_base64(encode(props)), 'quality', 85,
  'metadata', json_object('source', 'camera_simulation', 'created_at', strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'))) AS VARCHAR) AS value FROM events""",
    "frame_stream_faults": """SELECT CASE WHEN vec_id % 7 IN (3, 4) THEN NULL ELSE 'cam' || CAST(label AS VARCHAR) END AS camera_id,
  CASE WHEN vec_id % 7 IN (3, 4) THEN NULL ELSE vec_id END AS frame_number,
  CASE WHEN vec_id % 7 IN (3, 4) THEN 'dead' WHEN vec_id % 7 IN (1, 2) THEN 'undecodable' ELSE 'ok' END AS status,
  CASE vec_id % 7 WHEN 3 THEN 'not an object' WHEN 4 THEN 'no value' END AS reason FROM embeddings""",
    "frame_resend": """SELECT 'cam' || CAST(label AS VARCHAR) AS camera_id, 'cam' || CAST(label AS VARCHAR) || '_' || printf('%06d', vec_id) || '.png' AS filename,
  CASE WHEN vec_id % 3 = 0 THEN vec_id + 1000 ELSE vec_id END AS timestamp_ms, CAST(CASE WHEN vec_id % 3 = 0 THEN 1 ELSE 0 END AS BIGINT) AS batch_id FROM embeddings""",
}

# Whole-frame results from the per-pixel statements.
_SUMS = """CAST(sum(f.b) AS BIGINT) AS sum_b, CAST(sum(f.g) AS BIGINT) AS sum_g, CAST(sum(f.r) AS BIGINT) AS sum_r, CAST(sum(a.alpha) AS BIGINT) AS sum_a"""
_BY_FRAME = """SELECT f.frame_id, 8 AS height, 8 AS width, 4 AS "nChannels", '{status}' AS status, {sums}
FROM frame8 f JOIN ({alpha}) a ON f.frame_id = a.frame_id AND f.y = a.y AND f.x = a.x GROUP BY f.frame_id"""
STATEMENTS["chroma_key_frames"] = _BY_FRAME.format(status="ok", sums=_SUMS, alpha=STATEMENTS["chroma_key_alpha"])
STATEMENTS["segment_frames"] = _BY_FRAME.format(status="segmented", sums=_SUMS, alpha=STATEMENTS["segment_alpha"])
STATEMENTS["frame_stream"] = f"""SELECT 'cam' || CAST(label AS VARCHAR) AS camera_id, CAST(vec_id AS INTEGER) AS frame_number,
  'cam' || CAST(label AS VARCHAR) || '_' || printf('%06d', vec_id) || '.png' AS filename, 'ok' AS status, s.alpha_sum
FROM embeddings JOIN (SELECT frame_id, CAST(sum(alpha) AS BIGINT) AS alpha_sum FROM ({STATEMENTS["chroma_key_alpha"]}) GROUP BY frame_id) s
ON vec_id = s.frame_id"""

# The same questions answered through a message log, kept tables or files.
for _kept, _plain in (("stream_ingest_log", "stream_ingest"), ("stream_throughput", "camera_throughput"), ("stream_histogram", "latency_histogram"),
                      ("frame_latest_state", "frame_resend"), ("movie_stats_maintained", "movie_stats"), ("genre_stats_maintained", "genre_stats"),
                      ("occupation_stats_maintained", "occupation_stats"), ("entity_counts_maintained", "entity_counts"),
                      ("product_sales_score_dealt", "product_sales_score"), ("product_order_join_dealt", "product_order_join")):
    STATEMENTS[_kept] = STATEMENTS[_plain]
STATEMENTS["stream_log_latest"] = STATEMENTS["stream_ingest"] + " WHERE event_id % 5 > 2"
STATEMENTS["stream_log_batches"] = """SELECT b AS batch_id, least(cap, n - b * cap) AS processed
FROM (SELECT count(*) AS n, (count(*) + 7) // 8 AS cap FROM events), range(8) AS t(b) WHERE b * cap < n"""
STATEMENTS["stream_silent_cameras"] = """SELECT camera_id, last_ms, now_ms - last_ms AS idle_ms FROM
(SELECT event_type AS camera_id, max(epoch_us(ts) // 1000) AS last_ms, max(max(epoch_us(ts) // 1000)) OVER () AS now_ms FROM events GROUP BY 1) WHERE now_ms - last_ms > 60000"""
_FILE = "'cam' || CAST(label AS VARCHAR) || '_' || printf('%06d', vec_id) || '.png'"
STATEMENTS["frame_files"] = f"""SELECT {_FILE} AS filename, 8 AS width, 8 AS height, 4 AS channels FROM embeddings"""
STATEMENTS["output_check"] = f"""SELECT filename, message, message LIKE 'Valid image%' AS is_valid FROM (SELECT {_FILE} AS filename,
  CASE vec_id % 5 WHEN 0 THEN 'File not found: ' || {_FILE} WHEN 1 THEN 'Expected BGRA (4 channels), got 3' ELSE 'Valid image: (8, 8, 4)' END AS message FROM embeddings)"""
STATEMENTS["frame_gaps"] = """SELECT camera_id, before + 1 AS first_missing, event_id - 1 AS last_missing, event_id - 1 - before AS length FROM
(SELECT event_type AS camera_id, event_id, coalesce(lag(event_id) OVER (PARTITION BY event_type ORDER BY event_id), -1) AS before FROM (SELECT DISTINCT event_type, event_id FROM events))
WHERE event_id - before > 1"""
STATEMENTS["frames_in_order"] = """SELECT event_type AS camera_id, event_id AS frame_number,
  row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS position FROM events"""


def oracle_sql() -> dict[str, str]:
    return {name: PRELUDE + "\n" + sql for name, sql in STATEMENTS.items()}
