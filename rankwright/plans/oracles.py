"""The same questions as ANSI SQL over the raw test tables, for DuckDB."""

from __future__ import annotations

import re

_VIEWS = {
    "fx_events": """
        SELECT CASE WHEN event_id % 307 <> 0 THEN user_id * 100 + day(ts) END AS session_id,
               CASE WHEN event_id % 401 <> 0 THEN user_id END AS user_id,
               CASE event_type WHEN 'click' THEN 'cart' WHEN 'view' THEN 'product' WHEN 'signup' THEN 'home'
                               WHEN 'error' THEN 'cancel' WHEN 'purchase' THEN 'purchase' END AS event_type,
               CASE WHEN event_id % 211 = 0 THEN NULL WHEN event_id % 223 = 0 THEN -1
                    ELSE (event_id * 100 + CAST(props::json->>'k' AS BIGINT)) % (SELECT count(*) FROM part)
               END AS product_id,
               ts AS created_at
        FROM events""",
    "fx_order_items": """
        SELECT CAST(l_orderkey * 10 + l_linenumber AS BIGINT) AS id, l_orderkey AS order_id, o_custkey AS user_id,
               l_partkey AS product_id, l_extendedprice AS sale_price, l_returnflag AS status,
               timestamp '2024-01-01' + to_hours(CAST(
                   (date_diff('day', date '1995-01-01', CAST(l_shipdate AS DATE)) % 30) * 24 + l_orderkey % 24 AS INTEGER))
                   AS created_at
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "fx_order_items_dirty": """
        SELECT id, order_id,
               CASE WHEN id % 997 = 0 THEN NULL WHEN id % 499 = 0 THEN -user_id - 1 ELSE user_id END AS user_id,
               CASE WHEN id % 991 = 0 THEN NULL WHEN id % 503 = 0 THEN product_id + 1000000 ELSE product_id END
                   AS product_id,
               CASE WHEN id % 983 = 0 THEN NULL WHEN id % 509 = 0 THEN -sale_price ELSE sale_price END AS sale_price,
               status, created_at
        FROM fx_order_items""",
    "fx_users": """
        SELECT c_custkey AS id, CAST(floor(c_acctbal / 90) AS INTEGER) AS age,
               nullif(c_mktsegment, 'MACHINERY') AS gender, n_name AS country
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "fx_products": """
        SELECT p_partkey AS id, p_name AS name, p_brand AS brand, p_type AS category,
               p_retailprice AS retail_price, p_retailprice * 6e-1 AS cost
        FROM part""",
    "fx_products_dirty": """
        SELECT id, CASE WHEN id % 50 = 0 THEN '  ' WHEN id % 50 = 1 THEN NULL ELSE name END AS name, brand, category,
               CASE WHEN id % 97 = 0 THEN 0e0 ELSE retail_price END AS retail_price,
               CASE WHEN id % 89 = 0 THEN -1e0 ELSE cost END AS cost
        FROM fx_products""",
    "fx_orders": "SELECT o_orderkey AS order_id, o_orderdate AS created_at FROM orders",
    "weighted_events": """
        SELECT *, CAST(CASE event_type WHEN 'purchase' THEN 5 WHEN 'cart' THEN 3 WHEN 'product' THEN 1 WHEN 'department' THEN 0.5
                       WHEN 'home' THEN 0.1 WHEN 'cancel' THEN -1 ELSE 0 END AS DECIMAL(10,2)) AS weight
        FROM fx_events WHERE user_id IS NOT NULL AND created_at IS NOT NULL""",
    "active_days": """
        SELECT user_id, CAST(created_at AS DATE) AS day, count(*) AS n, sum(weight) AS weight
        FROM weighted_events GROUP BY 1, 2""",
    "fx_order_items_repaired": """
        SELECT *, CASE WHEN status = 'R' THEN created_at + INTERVAL 14 DAY END AS returned_at, created_at + INTERVAL 1 DAY AS shipped_at,
               created_at + INTERVAL 3 DAY AS delivered_at, id AS inventory_item_id
        FROM (SELECT id, order_id + 1000000000 * (row_number() OVER (PARTITION BY order_id, product_id, user_id
                                                                     ORDER BY id, sale_price, status, created_at) - 1) AS order_id,
                     user_id, product_id, sale_price, status, created_at
              FROM fx_order_items
              UNION ALL
              SELECT -o_orderkey - 1, o_orderkey, o_custkey, p_partkey, p_retailprice, 'O',
                     timestamp '2024-01-01' + to_hours(CAST(o_orderkey % 720 AS INTEGER))
              FROM orders JOIN part ON p_partkey = o_orderkey % (SELECT count(*) FROM part)
              WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem))""",
    "judged": """
        SELECT i.*,
               (i.user_id IS NULL) AS missing_user, (i.product_id IS NULL) AS missing_product, (sale_price IS NULL) AS missing_price,
               coalesce(sale_price < 0, false) AS negative_price,
               (i.product_id IS NOT NULL AND i.product_id NOT IN (SELECT id FROM fx_products_dirty)) AS unknown_product,
               (i.user_id IS NOT NULL AND i.user_id NOT IN (SELECT id FROM fx_users)) AS unknown_user,
               count(*) OVER (PARTITION BY order_id, i.product_id, i.user_id) > 1 AS duplicate_key
        FROM fx_order_items_dirty i""",
    # Validation
    "broken_products": """
        SELECT oi.product_id, count(*) AS items FROM fx_order_items_dirty oi
        LEFT JOIN fx_products_dirty p ON oi.product_id = p.id WHERE p.id IS NULL GROUP BY oi.product_id""",
    "broken_users": """
        SELECT oi.user_id, count(*) AS items FROM fx_order_items_dirty oi
        LEFT JOIN fx_users u ON oi.user_id = u.id WHERE u.id IS NULL GROUP BY oi.user_id""",
    "duplicates": """
        SELECT order_id, product_id, user_id, count(*) AS duplicates FROM fx_order_items_dirty
        GROUP BY order_id, product_id, user_id HAVING count(*) > 1""",
    "lonely_orders": """
        SELECT o.order_id FROM fx_orders o LEFT JOIN fx_order_items_dirty oi ON o.order_id = oi.order_id
        WHERE oi.order_id IS NULL""",
    "schema_errors": """
        SELECT column_name, expected_type, NULL::VARCHAR AS actual_type,
               (SELECT count(*) FROM fx_order_items_dirty) AS affected_rows
        FROM (VALUES ('returned_at', 'timestamp'), ('shipped_at', 'timestamp'), ('delivered_at', 'timestamp'),
                     ('inventory_item_id', 'bigint')) AS v(column_name, expected_type)""",
    "item_counts": """
        SELECT count(*) AS order_items,
               count(*) FILTER (WHERE user_id IS NULL) AS missing_users,
               count(*) FILTER (WHERE product_id IS NULL) AS missing_products,
               count(*) FILTER (WHERE sale_price IS NULL) AS missing_prices,
               count(*) FILTER (WHERE sale_price < 0) AS negative_prices,
               count(*) FILTER (WHERE user_id IS NOT NULL AND product_id IS NOT NULL AND sale_price >= 0)
                   AS validated_records
        FROM fx_order_items_dirty""",
    "stats": """
        SELECT i.*,
               (SELECT count(*) FROM duplicates) AS duplicate_records,
               (SELECT count(*) FROM fx_users WHERE age < 0 OR age > 100) AS invalid_ages,
               (SELECT count(*) FROM broken_products) AS broken_product_relations,
               (SELECT CAST(coalesce(sum(items), 0) AS BIGINT) FROM broken_products) AS broken_product_relations_items,
               (SELECT count(*) FROM broken_users) AS broken_user_relations,
               (SELECT CAST(coalesce(sum(items), 0) AS BIGINT) FROM broken_users) AS broken_user_relations_items,
               (SELECT count(*) FROM fx_orders WHERE created_at > timestamp '2001-01-01') AS data_leakage,
               (SELECT count(*) FROM fx_products_dirty WHERE name IS NULL OR trim(name) = '') AS empty_product_names,
               (SELECT count(*) FROM fx_products_dirty WHERE retail_price <= 0 OR cost < 0) AS invalid_product_prices,
               (SELECT count(*) FROM lonely_orders) AS orders_without_items,
               missing_users + missing_products + missing_prices AS total_missing,
               CASE WHEN order_items > 0
                    THEN (missing_users + missing_products + missing_prices) / CAST(3 * order_items AS DOUBLE)
                    ELSE 0e0 END AS missing_rate,
               (SELECT count(*) FROM schema_errors) AS schema_validation
        FROM item_counts i""",
    "checks": """
        SELECT v.* FROM stats, LATERAL (VALUES
            (1, 'missing_values', total_missing, CAST(100 AS BIGINT)),
            (2, 'duplicate_records', duplicate_records, 0),
            (3, 'negative_prices', negative_prices, 0),
            (4, 'invalid_ages', invalid_ages, 0),
            (5, 'broken_product_relations', broken_product_relations, 0),
            (6, 'broken_user_relations', broken_user_relations, 0),
            (7, 'data_leakage', data_leakage, 0),
            (8, 'empty_product_names', empty_product_names, 0),
            (9, 'invalid_product_prices', invalid_product_prices, 0),
            (10, 'orders_without_items', orders_without_items, 0),
            (11, 'schema_validation', schema_validation, 0)) AS v(check_no, check_name, violations, allowed)""",
    # Sessions, popularity, candidates
    "session_context": """
        SELECT e.session_id, e.user_id, e.created_at AS session_start_time, p.category AS current_session_category,
               e.product_id AS interacted_product_id,
               CASE WHEN e.event_type IN ('cart', 'purchase') THEN 1 ELSE 0 END AS is_positive
        FROM fx_events e JOIN fx_products p ON e.product_id = p.id WHERE e.session_id IS NOT NULL""",
    "session_start": """
        SELECT session_id, min(session_start_time) AS session_start_time FROM session_context GROUP BY session_id""",
    "positive_samples": """
        SELECT DISTINCT session_id, user_id, current_session_category, interacted_product_id AS product_id, 1 AS label
        FROM session_context WHERE is_positive = 1""",
    "moments": """
        SELECT DISTINCT current_session_category AS category, session_start_time
        FROM positive_samples JOIN session_start USING (session_id)""",
    "asof_sales": """
        SELECT m.category, m.session_start_time, p.id AS product_id, count(oi.id) AS sales_count
        FROM moments m JOIN fx_products p ON p.category = m.category
        LEFT JOIN fx_order_items oi ON oi.product_id = p.id AND oi.created_at < m.session_start_time
        GROUP BY m.category, m.session_start_time, p.id""",
    "top_products": """
        SELECT * FROM (
            SELECT *, CAST(row_number() OVER (PARTITION BY category, session_start_time
                                              ORDER BY sales_count DESC, product_id) AS INTEGER) AS product_rank
            FROM asof_sales) WHERE product_rank <= 20""",
    "candidate_generation": """
        SELECT s.session_id, s.user_id, s.current_session_category, t.product_id, 0 AS label
        FROM positive_samples s JOIN session_start st USING (session_id)
        JOIN top_products t ON t.category = s.current_session_category
                           AND t.session_start_time = st.session_start_time""",
    "combined_candidates": """
        SELECT * FROM positive_samples UNION SELECT * FROM candidate_generation""",
    "final_deduped": """
        SELECT session_id, user_id, product_id, max(label) AS target_label
        FROM combined_candidates GROUP BY session_id, user_id, product_id""",
    "training": """
        SELECT c.session_id AS qid, c.user_id, c.product_id, u.age AS user_age, u.gender AS user_gender,
               u.country AS user_country, p.retail_price, p.cost, p.retail_price - p.cost AS profit_margin, p.brand,
               c.target_label, st.session_start_time
        FROM final_deduped c JOIN fx_users u ON c.user_id = u.id JOIN fx_products p ON c.product_id = p.id
        LEFT JOIN session_start st USING (session_id)""",
    "filled": """
        SELECT * REPLACE (coalesce(user_gender, 'Unknown') AS user_gender,
                          coalesce(user_country, 'Unknown') AS user_country, coalesce(brand, 'Unknown') AS brand)
        FROM training""",
    "codes": """
        SELECT "column", value, dense_rank() OVER (PARTITION BY "column" ORDER BY value) - 1 AS code
        FROM (SELECT DISTINCT 'user_gender' AS "column", user_gender AS value FROM filled
              UNION SELECT DISTINCT 'user_country', user_country FROM filled
              UNION SELECT DISTINCT 'brand', brand FROM filled)""",
    # Split and evaluation
    "sessions": """
        SELECT qid, row_number() OVER (ORDER BY min(session_start_time), qid) AS n, count(*) OVER () AS total
        FROM training GROUP BY qid""",
    "split": """
        SELECT t.*, s.n <= floor(s.total * 8e-1) AS is_train FROM training t JOIN sessions s USING (qid)""",
    "scored": "SELECT *, floor(retail_price / 50) AS score FROM training",
    "ranked": """
        SELECT qid, target_label,
               row_number() OVER (PARTITION BY qid ORDER BY score DESC) AS position,
               avg(target_label) OVER (PARTITION BY qid, score) AS gain,
               row_number() OVER (PARTITION BY qid ORDER BY target_label DESC) AS ideal_position
        FROM scored""",
    "per_session": """
        SELECT qid, count(*) AS n_rows, CAST(sum(target_label) AS BIGINT) AS positives,
               CASE WHEN sum(target_label) > 0 AND count(*) > 1 THEN
                   sum(CASE WHEN position <= 5 THEN gain / log2(1 + position) ELSE 0e0 END)
                   / sum(CASE WHEN ideal_position <= 5 THEN target_label / log2(1 + ideal_position) ELSE 0e0 END)
               END AS ndcg_5,
               CASE WHEN sum(target_label) > 0 AND count(*) > 1 THEN
                   sum(CASE WHEN position <= 10 THEN gain / log2(1 + position) ELSE 0e0 END)
                   / sum(CASE WHEN ideal_position <= 10 THEN target_label / log2(1 + ideal_position) ELSE 0e0 END)
               END AS ndcg_10
        FROM ranked GROUP BY qid""",
    "summary": """
        SELECT count(*) AS total_sessions, count(*) FILTER (WHERE positives > 0) AS sessions_with_positive,
               count(*) FILTER (WHERE positives > 0 AND n_rows > 1) AS sessions_scored,
               round(coalesce(avg(ndcg_5), 0e0), 6) AS mean_ndcg_5
        FROM per_session""",
}
_KEYS = "qid, user_id, product_id, target_label, session_start_time"
_TRAINING = "SELECT * FROM training"
_FILLED = "SELECT * FROM filled"
_SPLIT = f"SELECT {_KEYS} FROM split WHERE "

_ANSWERS = {
    "scan_order_items": "SELECT * FROM fx_order_items",
    "v01_missing_values": """
        SELECT missing_users, missing_products, missing_prices AS missing_price FROM item_counts""",
    "v02_duplicates": "SELECT * FROM duplicates",
    "v03_negative_prices": "SELECT * FROM fx_order_items_dirty WHERE sale_price < 0",
    "v04_invalid_ages": "SELECT * FROM fx_users WHERE age < 0 OR age > 100",
    "v05_broken_products": "SELECT * FROM broken_products",
    "v06_broken_users": "SELECT * FROM broken_users",
    "v07_future_orders": "SELECT * FROM fx_orders WHERE created_at > timestamp '2001-01-01'",
    "v08_empty_names": "SELECT * FROM fx_products_dirty WHERE name IS NULL OR trim(name) = ''",
    "v09_invalid_product_prices": "SELECT * FROM fx_products_dirty WHERE retail_price <= 0 OR cost < 0",
    "v10_orders_without_items": "SELECT * FROM lonely_orders",
    "v11_schema": "SELECT * FROM schema_errors",
    "validated_order_items": """
        SELECT * FROM fx_order_items_dirty
        WHERE user_id IS NOT NULL AND product_id IS NOT NULL AND sale_price >= 0""",
    "validation_stats": "SELECT * FROM stats",
    "validation_checks": "SELECT *, violations <= allowed AS passed FROM checks",
    "validation_report": """
        SELECT CAST(to_json({
            'passed': (SELECT bool_and(violations <= allowed) FROM checks),
            'checks': {
                'missing_values': total_missing <= 100, 'duplicate_records': duplicate_records = 0,
                'negative_prices': negative_prices = 0, 'invalid_ages': invalid_ages = 0,
                'broken_product_relations': broken_product_relations = 0,
                'broken_user_relations': broken_user_relations = 0, 'data_leakage': data_leakage = 0,
                'empty_product_names': empty_product_names = 0, 'invalid_product_prices': invalid_product_prices = 0,
                'orders_without_items': orders_without_items = 0, 'schema_validation': schema_validation = 0},
            'errors': (
                SELECT list(concat('[', check_name, '] ', violations, ' ', text) ORDER BY check_no)
                FROM checks JOIN (VALUES
                    ('missing_values', 'critical values are missing'),
                    ('duplicate_records', 'order item keys occur more than once'),
                    ('negative_prices', 'order items have a negative sale price'),
                    ('invalid_ages', 'users have an age below 0 or above 100'),
                    ('broken_product_relations', 'product ids in order items have no product'),
                    ('broken_user_relations', 'user ids in order items have no user'),
                    ('data_leakage', 'orders are dated in the future'),
                    ('empty_product_names', 'products have a blank or missing name'),
                    ('invalid_product_prices',
                     'products have a retail price of 0 or less or a negative cost'),
                    ('orders_without_items', 'orders have no items'),
                    ('schema_validation', 'expected columns are missing or have another type')
                ) AS m(check_name, text) USING (check_name) WHERE violations > allowed),
            'warnings': ['the gate is closed: no validated rows were written'],
            'stats': {
                'missing_users': missing_users, 'missing_products': missing_products,
                'missing_prices': missing_prices, 'duplicate_records': duplicate_records,
                'negative_prices': negative_prices, 'invalid_ages': invalid_ages,
                'broken_product_relations': broken_product_relations,
                'broken_user_relations': broken_user_relations, 'data_leakage': data_leakage,
                'empty_product_names': empty_product_names, 'invalid_product_prices': invalid_product_prices,
                'orders_without_items': orders_without_items, 'schema_validation': schema_validation,
                'broken_product_relations_items': broken_product_relations_items,
                'broken_user_relations_items': broken_user_relations_items}
        }) AS VARCHAR) AS report FROM stats""",
    "metrics_validation": """
        SELECT 'validation' AS stage, m.* FROM stats, LATERAL (VALUES
            ('total_missing_values', CAST(total_missing AS DOUBLE)),
            ('duplicate_records', CAST(duplicate_records AS DOUBLE)),
            ('broken_relations_total', CAST(broken_product_relations + broken_user_relations AS DOUBLE)),
            ('validation_status', (SELECT CAST(bool_and(violations <= allowed) AS DOUBLE) FROM checks))
        ) AS m(metric, value)""",
    "sink_validated_roundtrip": """
        SELECT * FROM fx_order_items_dirty
        WHERE user_id IS NOT NULL AND product_id IS NOT NULL AND sale_price >= 0""",
    "validation_report_open": """
        SELECT CAST(to_json({
            'passed': true,
            'checks': {
                'missing_values': true, 'duplicate_records': n_duplicates = 0, 'negative_prices': n_negative = 0,
                'invalid_ages': true, 'broken_product_relations': n_products = 0, 'broken_user_relations': n_users = 0,
                'data_leakage': n_future = 0, 'empty_product_names': n_names = 0, 'invalid_product_prices': n_prices = 0,
                'orders_without_items': n_lonely = 0, 'schema_validation': true},
            'errors': CAST([] AS VARCHAR[]), 'warnings': CAST([] AS VARCHAR[]),
            'stats': {
                'missing_users': 0, 'missing_products': 0, 'missing_prices': 0, 'duplicate_records': n_duplicates,
                'negative_prices': n_negative, 'invalid_ages': 0, 'broken_product_relations': n_products,
                'broken_user_relations': n_users, 'data_leakage': n_future, 'empty_product_names': n_names,
                'invalid_product_prices': n_prices, 'orders_without_items': n_lonely, 'schema_validation': 0,
                'broken_product_relations_items': n_products, 'broken_user_relations_items': n_users,
                'final_validated_records': n_items}
        }) AS VARCHAR) AS report FROM (SELECT
            (SELECT count(*) FROM (SELECT 1 FROM fx_order_items_repaired GROUP BY order_id, product_id, user_id HAVING count(*) > 1)) AS n_duplicates,
            (SELECT count(*) FROM fx_order_items_repaired WHERE sale_price < 0) AS n_negative,
            (SELECT count(*) FROM fx_order_items_repaired WHERE product_id NOT IN (SELECT id FROM fx_products)) AS n_products,
            (SELECT count(*) FROM fx_order_items_repaired WHERE user_id NOT IN (SELECT id FROM fx_users)) AS n_users,
            (SELECT count(*) FROM fx_orders WHERE created_at > timestamp '2002-01-01') AS n_future,
            (SELECT count(*) FROM fx_products WHERE name IS NULL OR trim(name) = '') AS n_names,
            (SELECT count(*) FROM fx_products WHERE retail_price <= 0 OR cost < 0) AS n_prices,
            (SELECT count(*) FROM fx_orders WHERE order_id NOT IN (SELECT order_id FROM fx_order_items_repaired)) AS n_lonely,
            (SELECT count(*) FROM fx_order_items_repaired WHERE user_id IS NOT NULL AND product_id IS NOT NULL AND sale_price >= 0) AS n_items)""",
    "quarantined_items": """
        SELECT id, order_id, user_id, product_id, sale_price, status, created_at,
               CAST(missing_user AS INTEGER) + 2 * CAST(missing_product AS INTEGER) + 4 * CAST(missing_price AS INTEGER)
               + 8 * CAST(negative_price AS INTEGER) + 16 * CAST(unknown_product AS INTEGER) + 32 * CAST(unknown_user AS INTEGER)
               + 64 * CAST(duplicate_key AS INTEGER) AS broken,
               concat_ws(',', CASE WHEN missing_user THEN 'missing_user' END, CASE WHEN missing_product THEN 'missing_product' END,
                         CASE WHEN missing_price THEN 'missing_price' END, CASE WHEN negative_price THEN 'negative_price' END,
                         CASE WHEN unknown_product THEN 'unknown_product' END, CASE WHEN unknown_user THEN 'unknown_user' END,
                         CASE WHEN duplicate_key THEN 'duplicate_key' END) AS rules
        FROM judged WHERE missing_user OR missing_product OR missing_price OR negative_price""",
    "quarantine_counts": """
        SELECT r.* FROM (SELECT count(*) AS n, count(*) FILTER (missing_user OR missing_product OR missing_price OR negative_price) AS q,
                count(*) FILTER (missing_user) AS a, count(*) FILTER (missing_product) AS b, count(*) FILTER (missing_price) AS c,
                count(*) FILTER (negative_price) AS d, count(*) FILTER (unknown_product) AS e, count(*) FILTER (unknown_user) AS f,
                count(*) FILTER (duplicate_key) AS g FROM judged), LATERAL (VALUES
            ('order_items', n), ('quarantined', q), ('missing_user', a), ('missing_product', b), ('missing_price', c),
            ('negative_price', d), ('unknown_product', e), ('unknown_user', f), ('duplicate_key', g)) AS r(rule, items)""",
    "training_set_validated": "repaired: SELECT * FROM training",
    "session_context": "SELECT * FROM session_context",
    "session_start": "SELECT * FROM session_start",
    "positive_samples": "SELECT * FROM positive_samples",
    "popularity_global": """
        SELECT p.id, p.category, count(oi.id) AS sales_count
        FROM fx_products p LEFT JOIN fx_order_items oi ON p.id = oi.product_id GROUP BY p.id, p.category""",
    "popularity_asof": """
        SELECT a.product_id, a.session_start_time, count(oi.id) AS sales_count
        FROM (SELECT DISTINCT c.interacted_product_id AS product_id, st.session_start_time
              FROM session_context c JOIN session_start st USING (session_id)) a
        LEFT JOIN fx_order_items oi ON oi.product_id = a.product_id AND oi.created_at < a.session_start_time
        GROUP BY a.product_id, a.session_start_time""",
    "top_products_per_category": "SELECT * FROM top_products",
    "candidate_generation": "SELECT * FROM candidate_generation",
    "combined_candidates": "SELECT * FROM combined_candidates",
    "final_deduped": "SELECT * FROM final_deduped",
    "feature_attachment": _TRAINING,
    "training_set": _TRAINING,
    "feature_sorted": """
        SELECT *, row_number() OVER (ORDER BY session_start_time, qid, product_id, user_id) - 1 AS position
        FROM training""",
    "categorical_fill": _FILLED,
    "categorical_codes": "SELECT * FROM codes",
    "categorical_encode": """
        SELECT qid, user_id, product_id, g.code AS user_gender_code, c.code AS user_country_code, b.code AS brand_code
        FROM filled
        JOIN codes g ON g."column" = 'user_gender' AND g.value = user_gender
        JOIN codes c ON c."column" = 'user_country' AND c.value = user_country
        JOIN codes b ON b."column" = 'brand' AND b.value = brand""",
    "feature_matrix": """
        SELECT target_label, user_age, user_gender, user_country, retail_price, cost, profit_margin, brand
        FROM filled""",
    "metrics_features": """
        SELECT 'features' AS stage, m.* FROM
            (SELECT count(*) AS n, sum(target_label) AS positives FROM training), LATERAL (VALUES
            ('total_training_samples', CAST(n AS DOUBLE)), ('total_features', 7e0),
            ('positive_samples', CAST(positives AS DOUBLE)), ('negative_samples', CAST(n - positives AS DOUBLE))
        ) AS m(metric, value)""",
    "sink_features_roundtrip": "SELECT *, CAST(session_start_time AS DATE) AS session_day FROM filled",
    "store_truncate": _FILLED,
    "store_append": "SELECT * FROM filled UNION ALL SELECT * FROM filled",
    "feature_table_read": _FILLED,
    "feature_catalog": """
        SELECT f.feature, 'training_dataset' AS feature_group,
               'Feature ' || f.feature || ' of group training_dataset' AS description,
               'user_id,product_id' AS entity_keys, 1 AS schema_version, n AS table_rows
        FROM (SELECT count(*) AS n FROM training), (VALUES ('user_age'), ('user_gender'), ('user_country'),
             ('retail_price'), ('cost'), ('profit_margin'), ('brand'), ('session_start_time')) AS f(feature)""",
    "split_train": _SPLIT + "is_train",
    "split_val": _SPLIT + "NOT is_train",
    "group_sizes": "SELECT qid, count(*) AS group_size FROM training GROUP BY qid",
    "stored_group_sizes": "SELECT qid, count(*) AS group_size FROM training GROUP BY qid",
    "ndcg_at_5": "SELECT qid, n_rows, positives, round(ndcg_5, 6) AS ndcg_5 FROM per_session",
    "ndcg_at_10": "SELECT qid, n_rows, positives, round(ndcg_10, 6) AS ndcg_10 FROM per_session",
    "recommend_top_k": """
        SELECT * FROM (
            SELECT qid, user_id, product_id, score, target_label, CAST(row_number() OVER (
                PARTITION BY qid ORDER BY score DESC, product_id, user_id) AS INTEGER) AS rank
            FROM scored) WHERE rank <= 5""",
    "eval_session_counts": """
        SELECT total_sessions, sessions_with_positive, sessions_scored FROM summary""",
    "eval_summary": "SELECT * FROM summary",
    "deploy_decision": """
        SELECT mean_ndcg_5, 65e-2 AS threshold,
               CASE WHEN mean_ndcg_5 >= 65e-2 THEN 'approve' ELSE 'reject' END AS decision FROM summary""",
    "ranker_lambdas": """
        SELECT * FROM (WITH ranked AS (
            SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, product_id, user_id) AS rank,
                   sum(target_label) OVER (PARTITION BY qid) AS positives FROM scored),
        own AS (SELECT *, CASE WHEN rank <= 10 THEN 1 / log2(1e0 + rank) ELSE 0 END AS discount,
                       list_sum(list_transform(range(1, CAST(least(positives, 10) AS BIGINT) + 1), lambda p: 1 / log2(1e0 + p))) AS ideal
                FROM ranked WHERE positives > 0),
        pairs AS (
            SELECT h.qid, h.user_id AS hu, h.product_id AS hp, l.user_id AS lu, l.product_id AS lp,
                   1 / (1 + exp(h.score - l.score)) AS rho, abs(h.discount - l.discount) / h.ideal AS weight
            FROM own h JOIN own l ON h.qid = l.qid AND h.target_label = 1 AND l.target_label = 0),
        sides AS (
            SELECT qid, hu AS user_id, hp AS product_id, rho * weight AS pull, rho * (1 - rho) * weight AS hessian FROM pairs
            UNION ALL SELECT qid, lu, lp, -rho * weight, rho * (1 - rho) * weight FROM pairs)
        SELECT o.qid, o.user_id, o.product_id, round(coalesce(sum(pull), 0), 6) AS pull, round(coalesce(sum(hessian), 0), 6) AS hessian
        FROM own o LEFT JOIN sides s ON o.qid = s.qid AND o.user_id = s.user_id AND o.product_id = s.product_id
        GROUP BY o.qid, o.user_id, o.product_id)""",
    "early_stop": """
        SELECT * FROM (WITH days AS (SELECT CAST(created_at AS DATE) AS day, count(*) AS value FROM fx_events
                                     WHERE created_at IS NOT NULL GROUP BY 1),
        curve AS (SELECT date_diff('day', (SELECT min(day) FROM days), day) + 1 AS round, value FROM days),
        marked AS (SELECT round, CASE WHEN value > coalesce(max(value) OVER (ORDER BY round ROWS BETWEEN UNBOUNDED PRECEDING
                       AND 1 PRECEDING), -1) THEN round END AS own FROM curve),
        best AS (SELECT round, max(own) OVER (ORDER BY round) AS best FROM marked),
        last AS (SELECT coalesce(min(round) FILTER (round - best >= 15), max(round)) AS stop FROM best)
        SELECT CAST(stop AS BIGINT) AS stop_round, CAST(best AS BIGINT) AS best_round FROM last JOIN best ON round = stop)""",
    "ranker_histogram": """
        SELECT * FROM (WITH valued AS (SELECT target_label, retail_price AS price, coalesce(user_age, -1) AS age,
                              [coalesce(CAST(user_age AS DOUBLE), -1), coalesce(retail_price, -1), coalesce(cost, -1),
                               coalesce(profit_margin, -1)] AS x FROM training),
        placed AS (SELECT target_label, x, CASE WHEN x[2] >= 950 THEN 2 WHEN x[1] < 45 THEN 3 ELSE 4 END AS node FROM valued),
        bounds AS (SELECT * FROM (VALUES (0, [18, 30, 45, 60, 75]), (1, [925, 950, 1000, 1100]), (2, [555, 600, 660]),
                                         (3, [370, 400])) AS b(feature, cuts))
        SELECT node, feature, CAST(len(list_filter(cuts, lambda c: c <= x[feature + 1])) AS INTEGER) AS bin,
               CAST(sum(4 * target_label - 2) AS BIGINT) AS pull, count(*) AS hessian
        FROM placed, bounds GROUP BY 1, 2, 3)""",
    "ranker_planted_scores": """
        SELECT * FROM (WITH RECURSIVE cells AS (
            SELECT 'user_gender' AS c, user_gender AS value, target_label FROM filled
            UNION ALL SELECT 'user_country', user_country, target_label FROM filled
            UNION ALL SELECT 'brand', brand, target_label FROM filled),
        mean AS (SELECT avg(target_label) AS m FROM training),
        rates AS (SELECT c, value, (sum(target_label) + 20 * any_value(m)) / (count(*) + 20) AS rate FROM cells, mean GROUP BY 1, 2),
        trees(round, node, feature, bound, l, r, value) AS (VALUES
            (1, 0, 'retail_price', 950e0, 1, 2, 0e0), (1, 1, 'user_age', 45, 3, 4, 0), (1, 2, 'brand_rate', 5e-2, 5, 6, 0),
            (1, 3, NULL, NULL, 3, 3, 5e-1), (1, 4, NULL, NULL, 4, 4, -25e-2), (1, 5, NULL, NULL, 5, 5, 125e-3),
            (1, 6, NULL, NULL, 6, 6, 1), (2, 0, 'profit_margin', 400, 1, 2, 0), (2, 1, NULL, NULL, 1, 1, -15e-1),
            (2, 2, 'user_gender_rate', 515e-4, 3, 4, 0), (2, 3, NULL, NULL, 3, 3, 75e-2), (2, 4, NULL, NULL, 4, 4, -2)),
        valued AS (
            SELECT qid, user_id, product_id, MAP {
                'user_age': coalesce(CAST(user_age AS DOUBLE), -1), 'retail_price': coalesce(retail_price, -1),
                'profit_margin': coalesce(profit_margin, -1), 'brand_rate': b.rate, 'user_gender_rate': g.rate} AS x
            FROM filled JOIN rates b ON b.c = 'brand' AND b.value = brand JOIN rates g ON g.c = 'user_gender' AND g.value = user_gender),
        walk AS (
            SELECT v.*, t.round, 0 AS node FROM valued v, (SELECT DISTINCT round FROM trees) t
            UNION ALL
            SELECT w.qid, w.user_id, w.product_id, w.x, w.round, CASE WHEN w.x[t.feature] < t.bound THEN t.l ELSE t.r END
            FROM walk w JOIN trees t ON t.round = w.round AND t.node = w.node AND t.feature IS NOT NULL)
        SELECT qid, user_id, product_id, sum(5e-1 * t.value) AS score
        FROM walk w JOIN trees t ON t.round = w.round AND t.node = w.node AND t.feature IS NULL GROUP BY qid, user_id, product_id)""",
    "category_rates": """
        SELECT * FROM (WITH cells AS (
            SELECT c, value, target_label, CAST(('0x' || substr(sha256(CAST(qid AS VARCHAR)), 1, 8)) AS BIGINT) % 5 AS own FROM (
                SELECT 'user_gender' AS c, user_gender AS value, target_label, qid FROM filled
                UNION ALL SELECT 'user_country', user_country, target_label, qid FROM filled
                UNION ALL SELECT 'brand', brand, target_label, qid FROM filled)),
        kept AS (SELECT c, value, target_label, fold FROM cells, (SELECT unnest([NULL, 0, 1, 2, 3, 4]) AS fold)
                 WHERE fold IS NULL OR fold <> own),
        means AS (SELECT c, fold, avg(target_label) AS m FROM kept GROUP BY 1, 2)
        SELECT k.c AS "column", value, CAST(k.fold AS INTEGER) AS fold,
               round((sum(target_label) + 20 * any_value(m)) / (count(*) + 20), 9) AS rate
        FROM kept k JOIN means ON k.c = means.c AND k.fold IS NOT DISTINCT FROM means.fold GROUP BY k.c, value, k.fold
        UNION ALL SELECT c, NULL, CAST(fold AS INTEGER), round(m, 9) FROM means)""",
    "metrics_evaluation": """
        SELECT 'evaluation' AS stage, m.* FROM summary, LATERAL (VALUES
            ('test_mean_ndcg_5', mean_ndcg_5), ('target_threshold', 65e-2)) AS m(metric, value)""",
    "ranker_check": """
        SELECT count(*) AS rows_scored, count(DISTINCT qid) AS sessions, CAST(0 AS BIGINT) AS null_scores,
               true AS better_than_constant, true AS same_after_reload FROM training""",
    "end_to_end_check": """
        SELECT count(*) AS stored_rows, CAST(11 AS BIGINT) AS metric_rows, CAST(8 AS BIGINT) AS catalog_rows, false AS gate_passed,
               true AS model_kept_iff_approved FROM training""",
    # Feature tables
    "interaction_scores": """
        SELECT user_id, product_id, count(*) AS n_events, CAST(sum(weight) AS DOUBLE) AS score
        FROM weighted_events WHERE product_id IN (SELECT id FROM fx_products) GROUP BY user_id, product_id""",
    "user_item_matrix": """
        SELECT * FROM (SELECT user_id, product_id, CAST(sum(weight) AS DOUBLE) AS weight FROM (
            SELECT user_id, product_id, weight FROM weighted_events
            UNION ALL SELECT user_id, product_id, CAST(5 AS DECIMAL(10,2)) FROM fx_order_items WHERE user_id IS NOT NULL)
        WHERE product_id IN (SELECT id FROM fx_products) GROUP BY user_id, product_id) WHERE weight <> 0""",
    "rolling_user_activity": """
        SELECT a.user_id, a.day, """
    + ", ".join(
        f"CAST(sum(b.n) FILTER (b.day > a.day - {n}) AS BIGINT) AS events_{n}d, "
        f"CAST(sum(b.weight) FILTER (b.day > a.day - {n}) AS DOUBLE) AS score_{n}d"
        for n in (7, 30, 90, 365)
    )
    + """
        FROM active_days a JOIN active_days b ON a.user_id = b.user_id AND b.day <= a.day GROUP BY a.user_id, a.day""",
    "user_features": """
        SELECT u.id AS user_id, coalesce(n_events, 0) AS n_events, coalesce(n_sessions, 0) AS n_sessions,
               coalesce(n_purchases, 0) AS n_purchases, coalesce(n_items, 0) AS n_items, coalesce(n_orders, 0) AS n_orders,
               coalesce(spend, 0) AS spend, last_event_at, last_item_at
        FROM fx_users u
        LEFT JOIN (SELECT user_id, count(*) AS n_events, count(DISTINCT session_id) AS n_sessions,
                          count(*) FILTER (event_type = 'purchase') AS n_purchases, max(created_at) AS last_event_at
                   FROM fx_events GROUP BY user_id) e ON e.user_id = u.id
        LEFT JOIN (SELECT user_id, count(*) AS n_items, count(DISTINCT order_id) AS n_orders,
                          CAST(sum(CAST(sale_price AS DECIMAL(20,4))) AS DOUBLE) AS spend, max(created_at) AS last_item_at
                   FROM fx_order_items GROUP BY user_id) i ON i.user_id = u.id""",
    "product_features": """
        SELECT p.id AS product_id, category, coalesce(n_views, 0) AS n_views, coalesce(n_carts, 0) AS n_carts,
               coalesce(n_purchases, 0) AS n_purchases, coalesce(n_items, 0) AS n_items, coalesce(n_buyers, 0) AS n_buyers,
               coalesce(revenue, 0) AS revenue,
               CASE WHEN n_views > 0 THEN CAST(n_purchases AS DOUBLE) / n_views END AS conversion
        FROM fx_products p
        LEFT JOIN (SELECT product_id, count(*) FILTER (event_type = 'product') AS n_views,
                          count(*) FILTER (event_type = 'cart') AS n_carts,
                          count(*) FILTER (event_type = 'purchase') AS n_purchases
                   FROM fx_events GROUP BY product_id) e ON e.product_id = p.id
        LEFT JOIN (SELECT product_id, count(*) AS n_items, count(DISTINCT user_id) AS n_buyers,
                          CAST(sum(CAST(sale_price AS DECIMAL(20,4))) AS DOUBLE) AS revenue
                   FROM fx_order_items GROUP BY product_id) i ON i.product_id = p.id""",
    "interaction_features": """
        SELECT user_id, product_id, count(*) FILTER (event_type = 'product') AS n_views,
               count(*) FILTER (event_type = 'cart') AS n_carts, count(*) FILTER (event_type = 'purchase') AS n_purchases,
               CAST(sum(item) AS BIGINT) AS n_items, coalesce(CAST(sum(price) AS DOUBLE), 0) AS spend,
               min(created_at) AS first_at, max(created_at) AS last_at
        FROM (SELECT user_id, product_id, event_type, created_at, 0 AS item, CAST(NULL AS DECIMAL(20,4)) AS price FROM fx_events
              UNION ALL SELECT user_id, product_id, NULL, created_at, 1, CAST(sale_price AS DECIMAL(20,4)) FROM fx_order_items)
        WHERE user_id IS NOT NULL AND product_id IN (SELECT id FROM fx_products) GROUP BY user_id, product_id""",
    "temporal_features": """
        SELECT user_id, session_id, event_type, product_id, created_at, CAST(hour(created_at) AS INTEGER) AS hour,
               CAST(isodow(created_at) AS INTEGER) AS day_of_week, isodow(created_at) >= 6 AS is_weekend,
               CAST(trunc(epoch_us(created_at) / 1000000e0 - epoch_us(lag(created_at) OVER (PARTITION BY user_id
                   ORDER BY created_at, event_type, product_id NULLS FIRST, session_id NULLS FIRST)) / 1000000e0) AS BIGINT)
                   AS gap_seconds
        FROM fx_events WHERE user_id IS NOT NULL AND created_at IS NOT NULL""",
}


def _over_repaired(answer: str) -> str:
    """An answer over the repaired items and users: the views that read them, named anew."""
    read = {"fx_order_items": "fx_order_items_repaired", "fx_users": "repaired_users"}
    changed: dict[str, str] = {}
    for name, body in _VIEWS.items():
        for old, new in {**read, **{n: f"{n}_open" for n in changed}}.items():
            body = re.sub(rf"\b{old}\b", new, body)
        if body != _VIEWS[name] and name not in ("fx_order_items_dirty", "fx_order_items_repaired"):
            changed[name] = body
    for name in changed:
        answer = re.sub(rf"\b{name}\b", f"{name}_open", answer)
    views = {"repaired_users": "SELECT * REPLACE (greatest(0, least(100, age)) AS age) FROM fx_users"}
    views |= {f"{name}_open": body for name, body in changed.items()}
    return f"SELECT * FROM (WITH {', '.join(f'{name} AS ({body})' for name, body in views.items())} {answer})"


def oracle_sql() -> dict[str, str]:
    """One SQL text per query; every text carries the views it may use."""
    views = ",\n".join(f"{name} AS ({body})" for name, body in _VIEWS.items())
    answers = {name: _over_repaired(a.split(":", 1)[1]) if a.startswith("repaired:") else a for name, a in _ANSWERS.items()}
    return {name: f"WITH {views}\n{answer}" for name, answer in answers.items()}
