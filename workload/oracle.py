"""DuckDB SQL for every query with a deterministic result.

Written from the tables' definitions in their plain form (two-pass, self-joined,
counted distinct), not from the rewritten Spark plans.
"""

from __future__ import annotations

PRODUCT_KEYS = "product_id, product_name, product_description, brand, price_usd, image_url"

# Common table expressions by name, each after the ones it uses.
CTES: dict[str, str] = {
    "items": """
        SELECT CASE WHEN o_orderkey % 211 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS "reviewerID",
            CAST(l_partkey AS VARCHAR) AS asin,
            CASE WHEN o_orderkey % 5 <> 0
                THEN c_name || '-' || CAST(o_orderkey % 3 AS VARCHAR) END AS "reviewerName",
            CASE WHEN l_linenumber % 7 = 0 THEN CAST([] AS BIGINT[])
                ELSE [CAST(l_quantity AS BIGINT) % 5,
                      CAST(l_quantity AS BIGINT) % 5 + l_linenumber % 4 - 1] END AS helpful,
            CASE WHEN l_linenumber % 6 = 0 THEN NULL WHEN o_orderkey % 89 = 0 THEN ''
                ELSE repeat(l_returnflag, CAST(l_quantity AS BIGINT)) END AS "reviewText",
            CAST(1 + l_linenumber % 5 AS DOUBLE) AS overall,
            l_returnflag || l_linestatus AS summary,
            CASE WHEN o_orderkey % 97 <> 0
                THEN CAST(epoch(o_orderdate) AS BIGINT) END AS "unixReviewTime",
            strftime(o_orderdate, '%m %-d, %Y') AS "reviewTime"
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
            JOIN customer ON o_custkey = c_custkey""",
    "product_rows": """
        SELECT p_partkey, false AS is_copy, CAST(p_partkey AS VARCHAR) AS asin, p_name AS title,
            CASE WHEN p_partkey % 4 <> 0 THEN p_name || ' ' || p_type END AS description,
            CASE WHEN p_partkey % 9 = 0 THEN NULL WHEN p_partkey % 53 = 0 THEN '-1'
                WHEN p_partkey % 59 = 0 THEN '20000'
                ELSE CAST(p_retailprice AS VARCHAR) END AS price,
            CASE WHEN p_partkey % 11 = 0 THEN '  '
                WHEN p_partkey % 13 <> 0 THEN p_brand END AS brand,
            'http://img/' || CAST(p_partkey AS VARCHAR) AS "imUrl",
            CASE WHEN p_partkey % 17 <> 0
                THEN '[["' || p_type || '","' || p_name || '"]]' END AS categories,
            '{"' || p_type || '":' || CAST(p_size AS VARCHAR) || '}' AS "salesRank",
            '{"also_bought":[]}' AS related
        FROM part
        UNION ALL
        SELECT p_partkey, true, CAST(p_partkey AS VARCHAR), p_name || ' dup',
            NULL, NULL, NULL, NULL, NULL, NULL, NULL
        FROM part WHERE p_partkey % 10 = 0""",
    "metadata": "SELECT * EXCLUDE (p_partkey, is_copy) FROM product_rows",
    "line_texts": """
        SELECT *, '{"asin":"' || asin || '","title":"' || title || '"'
            || coalesce(',"description":"' || description || '"', '')
            || coalesce(',"price":"' || price || '"', '')
            || coalesce(',"brand":"' || brand || '"', '')
            || coalesce(',"imUrl":"' || "imUrl" || '"', '')
            || coalesce(',"categories":' || categories, '')
            || coalesce(',"salesRank":' || "salesRank", '')
            || coalesce(',"related":' || related, '') || '}' AS sparse,
            replace('{"asin":"' || asin || '","title":"' || title || '"'
            || ',"description":' || coalesce('"' || description || '"', ' None')
            || ',"price":' || coalesce('"' || price || '"', ' None')
            || ',"brand":' || coalesce('"' || brand || '"', ' None')
            || ',"imUrl":' || coalesce('"' || "imUrl" || '"', ' None')
            || ',"categories":' || coalesce(categories, ' None')
            || ',"salesRank":' || coalesce("salesRank", ' None')
            || ',"related":' || coalesce(related, ' None') || '}', '"', '''') AS with_none
        FROM product_rows""",
    "record_lines": """
        SELECT CASE p_partkey % 8
                WHEN 2 THEN replace(sparse, '"', '''')
                WHEN 3 THEN with_none
                WHEN 6 THEN replace(replace(sparse, '"', ''''), '''title''', 'u''title''')
                WHEN 7 THEN replace(sparse, '"', '''')
                ELSE sparse END AS value,
            p_partkey % 8 IN (0, 1, 4, 5) AS is_json
        FROM line_texts
        UNION ALL
        SELECT '{''asin'': ' || asin || ' oops', false FROM product_rows
        WHERE p_partkey % 25 = 0 AND NOT is_copy""",
    "bronze_products": """
        SELECT asin AS product_id, title AS product_name, description AS product_description,
            brand, CAST(price AS DOUBLE) AS price_usd, "imUrl" AS image_url,
            categories AS categories_json, "salesRank" AS sales_rank_json,
            related AS related_products_json
        FROM metadata""",
    "bronze_reviews": """
        SELECT "reviewerID" AS reviewer_id, asin AS product_id, "reviewerName" AS reviewer_name,
            "reviewText" AS reviewer_text, summary AS review_summary, overall AS rating,
            helpful AS helpful_array, "unixReviewTime" AS unix_review_time,
            "reviewTime" AS review_time_raw
        FROM items""",
    "bounds": """
        SELECT CAST(make_timestamp(min(unix_review_time) * 1000000) AS DATE) AS start_date,
            CAST(make_timestamp(max(unix_review_time) * 1000000) AS DATE) AS end_date
        FROM bronze_reviews WHERE unix_review_time IS NOT NULL""",
    "spine": """
        SELECT CAST(unnest(generate_series(start_date, end_date, INTERVAL 1 DAY)) AS DATE)
            AS date_day
        FROM bounds""",
    "dates": """
        SELECT CAST(strftime(date_day, '%Y%m%d') AS BIGINT) AS date_id, date_day,
            year(date_day) AS year, month(date_day) AS month, day(date_day) AS day,
            CAST(date_trunc('month', date_day) AS DATE) AS year_month,
            dayofweek(date_day) + 1 AS day_of_week,
            dayofweek(date_day) + 1 IN (1, 7) AS is_weekend
        FROM spine""",
    # A product's row with the fewest gaps, in the order of importance of its columns.
    "deduped": """
        SELECT DISTINCT ON (product_id) product_id, product_name, brand, price_usd,
            product_description, image_url, categories_json
        FROM bronze_products WHERE coalesce(price_usd, 0) >= 0
        ORDER BY product_id, categories_json IS NULL, product_description IS NULL, brand IS NULL,
            price_usd IS NULL, image_url IS NULL, product_name NULLS LAST""",
    "products": """
        SELECT product_id, product_name, product_description, brand, price_usd, image_url,
            json_extract_string(categories_json, '$[0][0]') AS primary_category,
            categories_json AS detailed_categorization
        FROM deduped""",
    # All that is kept of a reviewer in one aggregate; the name is the last one given.
    "people": """
        SELECT reviewer_id, min(unix_review_time) AS first_review_timestamp,
            arg_min(reviewer_name, {'age': -coalesce(unix_review_time, -9e18), 'name': reviewer_name})
                FILTER (reviewer_name IS NOT NULL) AS reviewer_name
        FROM bronze_reviews GROUP BY ALL""",
    "names": "SELECT reviewer_id, reviewer_name FROM people",
    "first_times": """
        SELECT reviewer_id, min(unix_review_time) AS first_review_timestamp
        FROM bronze_reviews GROUP BY reviewer_id""",
    "reviewers": """
        SELECT reviewer_id, reviewer_name, first_review_timestamp FROM people
        WHERE reviewer_id IS NOT NULL""",
    "fact": """
        SELECT md5(reviewer_id || '-' || product_id || '-' || CAST(unix_review_time AS VARCHAR))
                AS review_sk,
            reviewer_id, product_id,
            CAST(strftime(make_timestamp(unix_review_time * 1000000), '%Y%m%d') AS BIGINT)
                AS date_id,
            CAST(make_timestamp(unix_review_time * 1000000) AS DATE) AS review_date, rating,
            helpful_array[1] AS helpful_votes, helpful_array[2] AS total_votes, review_summary,
            reviewer_text AS review_text,
            make_timestamp(unix_review_time * 1000000) AS review_timestamp
        FROM bronze_reviews
        WHERE unix_review_time IS NOT NULL AND reviewer_id IS NOT NULL
            AND product_id IS NOT NULL""",
    "fact_unique": """
        SELECT * EXCLUDE (n) FROM (
            SELECT *, row_number() OVER (PARTITION BY review_sk ORDER BY
                reviewer_id, product_id, date_id, review_date, rating NULLS LAST,
                helpful_votes NULLS LAST, total_votes NULLS LAST, review_summary NULLS LAST,
                review_text NULLS LAST, review_timestamp) AS n
            FROM fact)
        WHERE n = 1""",
    # Two levels: reviews of each reviewer per brand, then of the brand.
    "brand_fans": """
        SELECT brand, reviewer_id, count(*) AS n FROM products JOIN fact USING (product_id)
        WHERE trim(brand) <> '' GROUP BY ALL""",
    "brand_counts": """
        SELECT brand, CAST(sum(n) AS BIGINT) AS total_reviews, count(*) AS unique_reviewers,
            round(avg(n), 2) AS avg_reviews_per_reviewer
        FROM brand_fans GROUP BY ALL""",
    # Product ids are unique, so those with a review are only counted.
    "category_counts": """
        SELECT primary_category, count(*) AS product_count
        FROM products SEMI JOIN fact USING (product_id)
        GROUP BY ALL HAVING primary_category IS NOT NULL""",
    "top_five": """
        SELECT * FROM category_counts ORDER BY product_count DESC, primary_category LIMIT 5""",
    "user_counts": """
        SELECT reviewer_id, count(review_sk) AS review_count FROM fact GROUP BY reviewer_id""",
    # The least number of reviews of each label.
    "steps": """
        SELECT * FROM (VALUES (1, '1 review', 1), (2, '2-5 reviews', 2), (6, '6-10 reviews', 3),
            (11, '11-20 reviews', 4), (21, '21-50 reviews', 5), (51, '51-100 reviews', 6),
            (101, '101-500 reviews', 7), (501, '500+ reviews', 8)) AS v(least_count, label, place)""",
    "buckets": """
        SELECT reviewer_id, review_count, label AS review_bucket, CAST(place AS BIGINT) AS bucket_order
        FROM user_counts ASOF JOIN steps ON review_count >= least_count""",
    # Sums of each day, from which longer spans are added up.
    "daily": """
        SELECT date_id, count(*) AS n, sum(helpful_votes) AS votes, count(helpful_votes) AS voted
        FROM fact GROUP BY ALL""",
    "monthly": """
        SELECT year, month, CAST(sum(n) AS BIGINT) AS monthly_review_count,
            sum(votes) / nullif(sum(voted), 0) AS monthly_avg_helpful_votes
        FROM daily JOIN dates USING (date_id) GROUP BY ALL""",
    "merged_fact": """
        SELECT * FROM fact_unique WHERE review_date < DATE '2001-06-28'
        UNION ALL
        SELECT * REPLACE (6 - rating AS rating,
            CASE WHEN rating > 1 THEN helpful_votes + 1 END AS helpful_votes)
        FROM fact_unique WHERE review_date >= DATE '2001-06-28'""",
}

ITEMS_TEXT = "SELECT * REPLACE (CAST(helpful AS VARCHAR) AS helpful) FROM items"
PRODUCT_LANDING = "SELECT * FROM metadata"
RECORD_COUNTS = """SELECT (SELECT count(*) FROM product_rows) AS valid_records,
    (SELECT count(*) FROM part WHERE p_partkey % 25 = 0) AS parse_errors"""


def _relationship(column: str, parent: str) -> str:
    return f"""SELECT c.{column}, count(*) AS n_records
        FROM fact c LEFT JOIN {parent} p ON c.{column} = p.{column}
        WHERE c.{column} IS NOT NULL AND p.{column} IS NULL GROUP BY c.{column}"""


def _duplicates(column: str, table: str) -> str:
    return f"""SELECT {column}, count(*) AS n_records FROM {table}
        WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1"""


def _check_row(name: str, severity: str, count: str) -> str:
    return f"""SELECT '{name}' AS check_name, '{severity}' AS severity,
        CAST(coalesce(({count}), 0) AS BIGINT) AS n_failed"""


def _count(table: str, condition: str) -> str:
    return f"SELECT count(*) FROM {table} WHERE {condition}"


# Tables with a column emptied in some rows.
HOLES = {
    "dates": "(SELECT * REPLACE (CASE WHEN day <> 1 THEN month END AS month) FROM dates)",
    "products": "(SELECT * REPLACE (CASE WHEN brand IS NOT NULL THEN product_id END AS product_id) FROM products)",
    "reviewers": """(SELECT * REPLACE (CASE WHEN reviewer_name IS NOT NULL THEN reviewer_id END AS reviewer_id)
        FROM reviewers)""",
    "fact": """(SELECT * REPLACE (CASE WHEN helpful_votes > total_votes THEN NULL ELSE rating END AS rating)
        FROM fact)""",
}


def _not_null_rows(tables: dict[str, str] | None = None) -> list[str]:
    columns = {
        "dates": ("date_id", "year", "month", "year_month"),
        "products": ("product_id",),
        "reviewers": ("reviewer_id",),
        "fact": ("review_sk", "reviewer_id", "product_id", "date_id", "rating", "review_date"),
    }
    return [
        _check_row(f"{t}_{c}_not_null", "error", _count((tables or {}).get(t, t), f"{c} IS NULL"))
        for t, names in columns.items()
        for c in names
    ]


def _summary() -> str:
    def uniques(table, column):
        return f"SELECT count(*) FROM ({_duplicates(column, table)})"

    def orphans(column, parent):
        return f"SELECT sum(n_records) FROM ({_relationship(column, parent)})"

    rows = [
        _check_row("items_reviewerID_not_null", "error", _count("items", '"reviewerID" IS NULL')),
        _check_row("items_asin_not_null", "error", _count("items", "asin IS NULL")),
        _check_row("metadata_asin_not_null", "error", _count("metadata", "asin IS NULL")),
        _check_row("metadata_asin_unique", "warn", uniques("metadata", "asin")),
        *_not_null_rows(),
        _check_row(
            "dates_month_accepted",
            "error",
            "SELECT count(DISTINCT month) FROM dates WHERE month NOT BETWEEN 1 AND 12",
        ),
        _check_row(
            "products_price_usd_range",
            "warn",
            _count("products", "price_usd < 0 OR price_usd > 10000"),
        ),
        _check_row(
            "fact_rating_accepted",
            "error",
            "SELECT count(DISTINCT rating) FROM fact WHERE rating NOT IN (1, 2, 3, 4, 5)",
        ),
        _check_row(
            "fact_review_text_length",
            "warn",
            _count("fact", "length(review_text) NOT BETWEEN 1 AND 50000"),
        ),
        _check_row(
            "fact_helpful_votes_valid", "warn", _count("fact", "helpful_votes > total_votes")
        ),
        _check_row(
            "fact_no_future_reviews", "error", _count("fact", "review_date > DATE '2001-07-01'")
        ),
        _check_row("dates_date_id_unique", "error", uniques("dates", "date_id")),
        _check_row("products_product_id_unique", "error", uniques("products", "product_id")),
        _check_row("reviewers_reviewer_id_unique", "error", uniques("reviewers", "reviewer_id")),
        _check_row("fact_review_sk_unique", "error", uniques("fact", "review_sk")),
        _check_row(
            "fact_reviewer_id_relationship", "error", orphans("reviewer_id", "reviewers")
        ),
        _check_row("fact_product_id_relationship", "error", orphans("product_id", "products")),
        _check_row("fact_date_id_relationship", "error", orphans("date_id", "dates")),
    ]
    return " UNION ALL ".join(rows)


# Keys sorted, nulls kept where the line spelled them out (key modulo 8 = 3).
CANONICAL = """
    SELECT '{' || concat_ws(', ', '"asin": "' || asin || '"', '"title": "' || title || '"',
        coalesce('"description": "' || description || '"', '"description": ' || empty),
        coalesce('"price": "' || price || '"', '"price": ' || empty),
        coalesce('"brand": "' || brand || '"', '"brand": ' || empty),
        coalesce('"imUrl": "' || "imUrl" || '"', '"imUrl": ' || empty),
        coalesce('"categories": ' || replace(categories, '","', '", "'), '"categories": ' || empty),
        coalesce('"salesRank": ' || replace("salesRank", '":', '": '), '"salesRank": ' || empty),
        coalesce('"related": ' || replace(related, '":', '": '), '"related": ' || empty)) || '}' AS record
    FROM (SELECT *, CASE WHEN p_partkey % 8 = 3 THEN 'null' END AS empty FROM product_rows)
    UNION ALL
    SELECT '{"z": ' || CAST(p_retailprice AS VARCHAR) || ', "b": {"y": 1e+22, "a": [1.5, -0.0, 12, 9.9]}, "asin": "'
        || CAST(p_partkey AS VARCHAR) || '", "\u00fc": "\u00e9"}' FROM part WHERE p_partkey % 3 = 0"""

REJECTED_LINES = """
    SELECT '{''asin'': ' || CAST(p_partkey AS VARCHAR) || ' oops' AS line FROM part WHERE p_partkey % 25 = 0
    UNION ALL
    SELECT CAST(least(count(*), 10) AS VARCHAR) || ' quoted' FROM part WHERE p_partkey % 25 = 0"""

SPOILT = """
    SELECT CASE asin WHEN '1' THEN replace(sparse, '"asin"', '"ASIN_"') WHEN '2' THEN sparse || ' trailing'
            WHEN '3' THEN '[' || sparse || ']' WHEN '4' THEN replace(sparse, '"asin"', '"unknown":1,"asin"')
            WHEN '5' THEN left(sparse, length(sparse) - 1) ELSE sparse END AS line,
        CASE asin WHEN '1' THEN 'missing:asin' WHEN '2' THEN 'not_one_object' WHEN '3' THEN 'not_one_object'
            WHEN '5' THEN 'not_one_object' END AS reason
    FROM (SELECT asin, '{' || concat_ws(',', '"asin":"' || asin || '"', '"title":"' || title || '"',
            '"description":"' || description || '"', '"price":"' || price || '"', '"brand":"' || brand || '"',
            '"imUrl":"' || "imUrl" || '"', '"categories":"' || replace(categories, '"', '\\"') || '"',
            '"salesRank":"' || replace("salesRank", '"', '\\"') || '"',
            '"related":"' || replace(related, '"', '\\"') || '"') || '}' AS sparse FROM product_rows)"""

ITEM_BYTES = """
    SELECT CAST(sum(2 + 1 + strlen(concat_ws(',', '"reviewerID":"' || "reviewerID" || '"', '"asin":"' || asin || '"',
        '"reviewerName":"' || "reviewerName" || '"',
        '"helpful":' || replace(CAST(helpful AS VARCHAR), ', ', ','), '"reviewText":"' || "reviewText" || '"',
        '"overall":' || CAST(overall AS VARCHAR), '"summary":"' || summary || '"',
        '"unixReviewTime":' || CAST("unixReviewTime" AS VARCHAR), '"reviewTime":"' || "reviewTime" || '"'))) AS BIGINT)
    FROM items"""

SELECTS: dict[str, str] = {
    "scan_gzip_lines": """
        SELECT unnest(string_split(
            replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)), chr(10)))
            AS value
        FROM documents""",
    "gzip_to_ndjson": ITEMS_TEXT,
    "utf8_check": "SELECT doc_id FROM documents WHERE source = 'src0'",
    "normalize_lines": "SELECT value FROM record_lines",
    "parse_json_lines": "SELECT value, is_json FROM record_lines",
    "repair_literal_records": """
        SELECT * EXCLUDE (p_partkey, is_copy) FROM product_rows
        WHERE p_partkey % 8 IN (2, 3, 6, 7)""",
    "bad_record_report": RECORD_COUNTS,
    "canonical_ndjson": CANONICAL,
    "rejected_lines": REJECTED_LINES,
    "rejected_records": f"SELECT * FROM ({SPOILT}) WHERE reason IS NOT NULL",
    "ingest_metrics": f"SELECT 'success' AS status, * FROM ({RECORD_COUNTS})",
    "load_metadata": PRODUCT_LANDING,
    "load_inferred": ITEMS_TEXT,
    "bad_record_budget": "SELECT * FROM metadata WHERE asin NOT IN ('1', '2', '3', '5')",
    "bronze_products": "SELECT * FROM bronze_products",
    "bronze_reviews": """
        SELECT * REPLACE (CAST(helpful_array AS VARCHAR) AS helpful_array) FROM bronze_reviews""",
    "cast_price": "SELECT asin, price, CAST(price AS DOUBLE) AS price_usd FROM metadata",
    "filter_not_null_keys": """
        SELECT reviewer_id, product_id, unix_review_time FROM bronze_reviews
        WHERE unix_review_time IS NOT NULL AND reviewer_id IS NOT NULL
            AND product_id IS NOT NULL""",
    "filter_negative_price": """
        SELECT product_id, product_name, price_usd FROM bronze_products
        WHERE price_usd >= 0 OR price_usd IS NULL""",
    "filter_blank_brand": """
        SELECT product_id, brand FROM bronze_products
        WHERE brand IS NOT NULL AND trim(brand) <> ''""",
    "having_min_reviewers": "SELECT * FROM brand_counts WHERE unique_reviewers >= 10",
    "semi_join_top_categories": """
        SELECT product_id, primary_category FROM products
        WHERE primary_category IN (SELECT primary_category FROM top_five)""",
    "incremental_lookback": """
        SELECT * FROM fact WHERE review_date >= DATE '2001-07-01' - INTERVAL 3 DAY""",
    "review_bucket_label": "SELECT reviewer_id, review_bucket FROM buckets",
    "review_bucket_order": "SELECT reviewer_id, bucket_order FROM buckets",
    "join_review_product": """
        SELECT f.product_id, f.review_sk, f.rating, p.brand, p.primary_category
        FROM fact f JOIN products p ON f.product_id = p.product_id""",
    "join_review_date": """
        SELECT f.date_id, f.review_sk, f.rating, d.year_month, d.is_weekend
        FROM fact f JOIN dates d ON f.date_id = d.date_id""",
    "star_join": """
        SELECT f.date_id, f.product_id, f.review_sk, f.rating, p.primary_category, d.year_month
        FROM fact f JOIN products p ON f.product_id = p.product_id
            JOIN dates d ON f.date_id = d.date_id""",
    "dim_reviewer": "SELECT * FROM reviewers",
    "date_spine": "SELECT * FROM spine",
    "check_rel_reviewer": _relationship(
        "reviewer_id", "(FROM reviewers WHERE reviewer_name IS NOT NULL)"
    ),
    "check_rel_product": _relationship("product_id", "products"),
    "check_rel_date": _relationship("date_id", "(FROM dates WHERE NOT is_weekend)"),
    "date_bounds": "SELECT * FROM bounds",
    "first_review_time": """
        SELECT reviewer_id, first_review_timestamp FROM first_times
        WHERE reviewer_id IS NOT NULL""",
    "latest_reviewer_name": """
        SELECT reviewer_id, reviewer_name FROM names WHERE reviewer_id IS NOT NULL""",
    "reviews_per_reviewer_count": "SELECT * FROM user_counts",
    "brand_review_counts": "SELECT * FROM brand_counts",
    "category_product_counts": "SELECT * FROM category_counts",
    "monthly_aggregates": "SELECT * FROM monthly",
    "dedup_products": "SELECT * FROM deduped",
    "top_categories": "SELECT * FROM top_five",
    "merge_fct_review": "SELECT * FROM merged_fact",
    "fct_partitioned_merge": "SELECT * FROM merged_fact",
    "merge_dim_products": """
        SELECT * REPLACE (CASE WHEN primary_category IS NULL THEN image_url
            ELSE 'old ' || image_url END AS image_url)
        FROM products""",
    "merge_dim_reviewer": """
        SELECT r.reviewer_id, r.reviewer_name,
            CASE WHEN e.first_time IS NULL THEN r.first_review_timestamp
                ELSE e.first_time + 86400 END AS first_review_timestamp
        FROM reviewers r LEFT JOIN (
            SELECT reviewer_id, min(unix_review_time) AS first_time FROM bronze_reviews
            WHERE unix_review_time < epoch(TIMESTAMP '1996-01-01 00:00:00')
            GROUP BY reviewer_id) e ON r.reviewer_id = e.reviewer_id""",
    "write_table": "SELECT * REPLACE (upper(product_name) AS product_name) FROM bronze_products",
    "fct_partitioned": """
        SELECT *, CAST(date_trunc('month', review_date) AS DATE) AS review_month FROM fact""",
    "stream_merge_arrivals": "SELECT * FROM fact_unique",
    "run_audit": f"""
        SELECT 'load_items' AS job, 'success' AS status, count(*) AS rows,
            CAST(0 AS BIGINT) AS bad_records, ({ITEM_BYTES}) AS input_bytes, '{{}}' AS reasons FROM items
        UNION ALL
        SELECT 'load_metadata', 'success', count(*) FILTER (reason IS NULL), count(reason),
            CAST(sum(strlen(line) + 1) AS BIGINT), '{{"missing:asin": 1, "not_one_object": 3}}' FROM ({SPOILT})""",
    "check_not_null_source": " UNION ALL ".join(
        [
            _check_row("items_reviewerID_not_null", "error", _count("items", '"reviewerID" IS NULL')),
            _check_row("items_asin_not_null", "error", _count("items", "asin IS NULL")),
            _check_row("metadata_asin_not_null", "error", _count("metadata", "asin IS NULL")),
            _check_row(
                "staging_items_reviewerID_not_null",
                "error",
                _count("items", '"reviewerID" IS NULL AND "unixReviewTime" >= 993945600'),
            ),
            _check_row("staging_metadata_asin_not_null", "error", _count("metadata", "price IS NULL")),
        ]
    ),
    "check_not_null": " UNION ALL ".join(_not_null_rows(HOLES)),
    "check_unique_source": f"""
        SELECT 'landing' AS zone, * FROM ({_duplicates("asin", "metadata")})
        UNION ALL
        SELECT 'staging', * FROM ({_duplicates("asin", "(SELECT * FROM metadata WHERE price IS NOT NULL "
            "UNION ALL SELECT * FROM metadata WHERE brand IS NULL AND price IS NOT NULL)")})""",
    "check_unique_review_sk": _duplicates("review_sk", "fact"),
    "check_unique_product_id": _duplicates("product_id", "(FROM products UNION ALL FROM products WHERE brand IS NULL)"),
    "check_unique_reviewer_id": _duplicates(
        "reviewer_id", "(FROM reviewers UNION ALL FROM reviewers WHERE reviewer_name IS NULL)"
    ),
    "check_unique_date_id": _duplicates("date_id", "(FROM dates UNION ALL FROM dates WHERE is_weekend)"),
    "check_accepted_month": """
        SELECT month + 12 AS month, count(*) AS n_records FROM dates WHERE day = 31 GROUP BY month""",
    "check_accepted_rating": """
        SELECT rating + 0.5 AS rating, count(*) AS n_records FROM fact
        WHERE helpful_votes > total_votes GROUP BY rating""",
    "check_price_range": """
        SELECT product_id, price_usd FROM products WHERE price_usd NOT BETWEEN 0 AND 10000""",
    "check_review_text_length": """
        SELECT review_sk, review_text FROM fact
        WHERE length(review_text) NOT BETWEEN 1 AND 50000""",
    "check_helpful_votes": """
        SELECT review_sk, helpful_votes, total_votes FROM fact
        WHERE helpful_votes > total_votes""",
    "check_no_future_reviews": """
        SELECT review_sk, review_date, DATE '2001-07-01' AS today FROM fact
        WHERE review_date > DATE '2001-07-01'""",
    "check_summary": _summary(),
    "dim_date": "SELECT * FROM dates",
    "dim_products": "SELECT * FROM products",
    "fct_review": "SELECT * FROM fact",
    "sample_reviews": "SELECT * FROM fact WHERE left(review_sk, 8) < '19999999'",
    "gold_category_ratings_monthly": """
        SELECT year_month, primary_category, sum(points) / sum(n) AS avg_rating
        FROM (SELECT product_id, date_id, sum(rating) AS points, count(rating) AS n FROM fact GROUP BY ALL)
            JOIN products USING (product_id) SEMI JOIN top_five USING (primary_category)
            JOIN dates USING (date_id)
        GROUP BY ALL""",
    "gold_brand_repeated_reviewers": """
        SELECT *, rank() OVER (ORDER BY avg_reviews_per_reviewer DESC) AS brand_rank
        FROM brand_counts WHERE unique_reviewers >= 10""",
    "gold_reviews_per_reviewer": "SELECT * FROM buckets",
    "gold_seasonality_and_reviews": """
        SELECT month, any_value(monthname(make_date(year, month, 1))) AS month_name,
            CAST(sum(monthly_review_count) AS BIGINT) AS total_reviews,
            round(sum(monthly_review_count) / count(*), 2) AS avg_reviews_per_month,
            round(avg(monthly_avg_helpful_votes), 2) AS avg_helpful_votes
        FROM monthly GROUP BY month""",
    "gold_weekend_review_behavior": """
        SELECT if(is_weekend, 'Weekend', 'Weekday') AS day_type, CAST(sum(n) AS BIGINT) AS total_reviews,
            count(*) AS total_days, round(avg(n), 2) AS avg_reviews_per_day
        FROM daily JOIN dates USING (date_id) GROUP BY is_weekend""",
}


def _needed(sql: str) -> list[str]:
    """Names of the expressions a statement uses, in order of definition."""
    import re

    used: set[str] = set()
    pending = [sql]
    while pending:
        words = set(re.findall(r"(?:FROM|JOIN)\s+([a-z_]+)", pending.pop()))
        new = (words & CTES.keys()) - used
        used |= new
        pending.extend(CTES[name] for name in new)
    return [name for name in CTES if name in used]


def statements() -> dict[str, str]:
    result = {}
    for name, select in SELECTS.items():
        parts = [f"{cte} AS ({CTES[cte]})" for cte in _needed(select)]
        result[name] = f"WITH {', '.join(parts)} {select}" if parts else select
    return result
