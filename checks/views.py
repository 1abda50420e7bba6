"""Domain views over the given tables, in SQL that Spark and DuckDB both run, and oracle CTEs on top."""

from __future__ import annotations

VIEWS: dict[str, str] = {}

VIEWS["businesses"] = """
SELECT p_partkey AS business_id, p_name AS name, n_name AS city, r_name AS state,
       1 + (p_size % 9) * CAST(0.5 AS DOUBLE) AS stars,
       CAST(p_size * 7 + p_partkey % 13 AS DOUBLE) AS review_count,
       CAST(CASE WHEN p_partkey % 5 = 0 THEN 0 ELSE 1 END AS DOUBLE) AS is_open,
       CASE WHEN p_partkey % 11 = 0 THEN NULL
            WHEN p_partkey % 4 = 0 THEN concat('Shopping, ', p_brand)
            WHEN p_partkey % 4 = 1 THEN concat('Restaurants, ', p_type)
            WHEN p_partkey % 4 = 2 THEN concat('Food, Restaurants, ', p_type, ', ', p_brand)
            ELSE concat(p_type, ', Fast Food') END AS categories,
       CASE p_partkey % 7 WHEN 0 THEN NULL WHEN 1 THEN '1' WHEN 2 THEN concat(chr(39), '2', chr(39))
            WHEN 3 THEN '3.0' WHEN 4 THEN 'None' WHEN 5 THEN '4' ELSE concat('u', chr(39), '2', chr(39)) END AS attr_price,
       CASE p_partkey % 3 WHEN 0 THEN 'True' WHEN 1 THEN 'False' ELSE NULL END AS attr_takeout,
       CASE p_partkey % 4 WHEN 0 THEN ' true ' WHEN 1 THEN 'None' ELSE 'False' END AS attr_delivery,
       CASE p_partkey % 6 WHEN 0 THEN 'TRUE' WHEN 1 THEN NULL ELSE 'no' END AS attr_groups,
       CASE p_partkey % 10 WHEN 3 THEN 'True' ELSE 'False' END AS attr_reservations,
       CASE WHEN p_partkey % 3 < 2 THEN 'true' ELSE '' END AS attr_cards,
       CASE WHEN p_partkey % 19 = 0 THEN NULL ELSE CAST(25 + p_partkey % 200 AS DOUBLE) / 8 END AS latitude,
       CAST(0 - 70 - p_partkey % 300 AS DOUBLE) / 8 AS longitude
FROM part JOIN nation ON n_nationkey = p_partkey % 25 JOIN region ON r_regionkey = n_regionkey
"""

VIEWS["interactions"] = """
SELECT o_custkey AS user_id, l_partkey AS business_id,
       CAST(1 + floor((l_quantity - 1) / 10) AS DOUBLE) AS stars, l_shipdate AS date,
       CAST(floor(l_extendedprice) AS BIGINT) % 1500 AS review_len,
       CAST(l_linenumber - 1 AS BIGINT) AS useful
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""

VIEWS["event_interactions"] = """
SELECT user_id, event_id % 50 AS business_id,
       CAST(1 + CAST(floor(value) AS BIGINT) % 5 AS DOUBLE) AS stars, ts AS date,
       event_id % 700 AS review_len, event_id % 4 AS useful
FROM events
"""

VIEWS["users"] = """
SELECT c_custkey AS user_id, c_name AS name, CAST(c_custkey % 600 AS DOUBLE) AS review_count,
       CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE first_order END AS signup_date,
       CASE c_mktsegment WHEN 'BUILDING' THEN '2019,2020' WHEN 'HOUSEHOLD' THEN '' WHEN 'MACHINERY' THEN ' ' ELSE NULL END AS elite,
       CAST(c_nationkey AS DOUBLE) AS fans, 1 + (c_custkey % 9) * CAST(0.5 AS DOUBLE) AS average_stars,
       CAST(c_custkey % 5 AS DOUBLE) AS compliment_hot, CAST(c_custkey % 3 AS DOUBLE) AS compliment_cool
FROM customer LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS first_order FROM orders GROUP BY o_custkey) o ON o_custkey = c_custkey
"""

VIEWS["reviews"] = """
SELECT doc_id AS review_id, doc_id % 30 AS user_id, source AS business_id,
       CAST(1 + doc_id % 5 AS DOUBLE) AS stars, CAST(n_chars % 7 AS DOUBLE) AS useful,
       CAST(n_chars % 5 AS DOUBLE) AS funny, CAST(n_chars % 3 AS DOUBLE) AS cool, text
FROM documents
"""

# review vectors of businesses 0..49, with the text of the document that has the same id where there is one
VIEWS["review_vectors"] = """
SELECT vec_id AS review_id, vec_id % 50 AS business_id, CAST(1 + vec_id % 5 AS DOUBLE) AS stars,
       coalesce(text, '') AS text, embedding
FROM embeddings LEFT JOIN documents ON doc_id = vec_id
"""

VIEWS["tips"] = """
SELECT user_id, event_id % 50 AS business_id, ts AS date FROM events WHERE event_type = 'click'
"""

# one check-in line per business: a joined list of none to three stamps, the last not always the latest
VIEWS["checkins"] = """
SELECT p_partkey AS business_id,
       CASE p_size % 5
            WHEN 0 THEN NULL WHEN 1 THEN ''
            WHEN 2 THEN concat('2020-01-1', CAST(p_partkey % 10 AS VARCHAR(1)), ' 10:00:00')
            WHEN 3 THEN concat('2020-03-1', CAST(p_partkey % 10 AS VARCHAR(1)), ' 23:30:00, 2019-07-02 01:02:03')
            ELSE concat('2018-01-01 00:00:00, 2020-02-1', CAST(p_partkey % 10 AS VARCHAR(1)), ' 08:00:00, 2021-05-05 05:05:05') END AS date
FROM part
"""

# reviews with text over the order lines
VIEWS["order_reviews"] = """
SELECT o_custkey AS user_id, l_partkey AS business_id,
       CAST(1 + floor((l_quantity - 1) / 10) AS DOUBLE) AS stars, l_shipdate AS date,
       concat(p_name, ' ', p_type, ' ', p_brand, ' ', o_orderpriority) AS text,
       CAST(l_linenumber - 1 AS BIGINT) AS useful
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey
"""

# rows as a careless exporter writes them: numbers and dates as text, some unusable
VIEWS["raw_businesses"] = """
SELECT CAST(p_partkey AS VARCHAR(20)) AS business_id, p_name AS name, n_name AS city, n_name AS state,
       CASE WHEN p_partkey % 9 = 0 THEN 'n/a' ELSE concat(CAST(p_size % 5 AS VARCHAR(1)), '.5') END AS stars,
       CASE WHEN p_partkey % 8 = 0 THEN '' ELSE CAST(p_size * 7 AS VARCHAR(9)) END AS review_count,
       CAST(p_partkey % 2 AS VARCHAR(1)) AS is_open, p_type AS categories,
       CASE WHEN p_partkey % 6 = 0 THEN 'north' ELSE concat(CAST(p_partkey % 90 AS VARCHAR(3)), '.25') END AS latitude,
       concat('-', CAST(p_partkey % 180 AS VARCHAR(3)), '.75') AS longitude
FROM part JOIN nation ON n_nationkey = p_partkey % 25
"""

VIEWS["raw_reviews"] = """
SELECT CAST(doc_id AS VARCHAR(20)) AS review_id, CAST(doc_id % 30 AS VARCHAR(20)) AS user_id, source AS business_id,
       CASE WHEN doc_id % 10 = 0 THEN 'five' ELSE concat(CAST(1 + doc_id % 5 AS VARCHAR(1)), '.0') END AS stars,
       CASE WHEN doc_id % 7 = 0 THEN 'last week'
            ELSE concat('2021-03-1', CAST(doc_id % 10 AS VARCHAR(1)), ' 12:34:56') END AS date,
       text, CAST(n_chars % 7 AS VARCHAR(2)) AS useful,
       CASE WHEN doc_id % 6 = 0 THEN NULL ELSE CAST(n_chars % 5 AS VARCHAR(2)) END AS funny,
       CASE WHEN doc_id % 4 = 0 THEN '-' ELSE CAST(n_chars % 3 AS VARCHAR(2)) END AS cool
FROM documents
"""

VIEWS["raw_users"] = """
SELECT CAST(c_custkey AS VARCHAR(20)) AS user_id, c_name AS name,
       CASE WHEN c_custkey % 12 = 0 THEN 'many' ELSE CAST(c_custkey % 600 AS VARCHAR(9)) END AS review_count,
       CASE WHEN c_custkey % 5 = 0 THEN 'unknown'
            ELSE concat('201', CAST(c_custkey % 10 AS VARCHAR(1)), '-06-15 08:00:00') END AS signup_date,
       CASE c_mktsegment WHEN 'BUILDING' THEN '2019,2020' WHEN 'HOUSEHOLD' THEN '' WHEN 'MACHINERY' THEN ' nan '
            ELSE NULL END AS elite,
       CASE WHEN c_custkey % 7 = 0 THEN 'some' ELSE CAST(c_custkey % 11 AS VARCHAR(2)) END AS compliment_hot,
       CAST(c_custkey % 4 AS VARCHAR(1)) AS compliment_photos,
       CAST(c_nationkey AS VARCHAR(3)) AS fans, concat(CAST(1 + c_custkey % 5 AS VARCHAR(1)), '.5') AS average_stars
FROM customer
"""

VIEWS["raw_tips"] = """
SELECT CAST(user_id AS VARCHAR(20)) AS user_id, CAST(event_id % 50 AS VARCHAR(20)) AS business_id, props AS text,
       CASE WHEN event_id % 9 = 0 THEN 'someday' ELSE concat('2022-11-2', CAST(event_id % 10 AS VARCHAR(1)), ' 07:00:00') END AS date,
       CASE WHEN event_id % 4 = 0 THEN 'x' ELSE CAST(event_id % 3 AS VARCHAR(1)) END AS compliment_count
FROM events WHERE event_type = 'click'
"""

# name -> (CTEs it builds on, SQL); only DuckDB runs these
CTES: dict[str, tuple[tuple[str, ...], str]] = {name: ((), sql) for name, sql in VIEWS.items()}
