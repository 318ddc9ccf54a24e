"""SQL that states the expected result of each query on the test tables, for DuckDB.

It is written straight from the meaning of the operators: joins build every pair, copies are
ranked and dropped after the join, reviews are grouped by all property columns. Nothing of
the way the Spark side reaches the same rows is used here.
"""

from feedlake import fixed_values as V

_PARTS: dict[str, tuple[tuple[str, ...], str]] = {}


def _part(name: str, needs: tuple[str, ...], body: str) -> None:
    _PARTS[name] = (needs, body)


def _ordered(columns) -> str:
    return ", ".join(f"{column} ASC NULLS FIRST" for column in columns)


def _with_parts(body: str, needs: tuple[str, ...]) -> str:
    """`body` with the parts it needs as common table expressions."""
    chosen: dict[str, str] = {}

    def add(name: str) -> None:
        if name not in chosen:
            inner, text = _PARTS[name]
            for other in inner:
                add(other)
            chosen[name] = text

    for name in needs:
        add(name)
    if not chosen:
        return body
    clauses = ",\n".join(f"{name} AS ({text})" for name, text in chosen.items())
    return f"WITH {clauses}\n{body}"


# --- feeds ---------------------------------------------------------------------------

_part(
    "listed",
    (),
    """
    SELECT CASE WHEN c_acctbal < -900 THEN NULL WHEN c_acctbal < -800 THEN ''
                WHEN c_acctbal < -700 THEN 'x' || c_custkey ELSE c_custkey::VARCHAR END AS id,
           CASE WHEN c_mktsegment = 'HOUSEHOLD' AND c_acctbal > 8000 THEN '  '
                WHEN c_mktsegment <> 'MACHINERY' THEN c_name || ' ' END AS en_us,
           CASE WHEN c_mktsegment = 'MACHINERY' AND c_acctbal > 5000
                THEN 'Kunde Süd_' || c_custkey || '!' END AS de,
           CASE WHEN c_mktsegment = 'MACHINERY' AND c_acctbal > 3000
                THEN 'Cliente ' || c_custkey END AS pt,
           CASE WHEN c_mktsegment = 'MACHINERY' AND c_acctbal > 4000
                THEN 'Clienti ' || c_custkey END AS it,
           CASE WHEN c_acctbal < 0 THEN NULL
                WHEN c_mktsegment = 'HOUSEHOLD' AND n_regionkey = 2 THEN n_name
                WHEN n_regionkey = 4 THEN ' ' || chr(97 + n_nationkey) || 'b '
                ELSE chr(97 + n_nationkey) || 'b' END AS country,
           n_name AS city,
           CASE c_mktsegment WHEN 'FURNITURE' THEN NULL WHEN 'BUILDING' THEN ' '
                ELSE 'EUR' END AS currency,
           CASE WHEN c_mktsegment <> 'AUTOMOBILE' THEN n_regionkey::DOUBLE END AS stars,
           CASE WHEN c_acctbal >= -500 THEN c_acctbal / 1000 END AS review_score,
           c_mktsegment AS accommodation_type, n_nationkey::BIGINT AS number_of_rooms,
           c_acctbal > 5000 AS is_genius, n_regionkey > 1 AS is_work_friendly,
           'https://listing.example/' || c_custkey AS url, c_acctbal
    FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
_part(
    "details",
    ("listed",),
    """
    SELECT * EXCLUDE (c_acctbal) FROM listed
    UNION ALL
    SELECT * EXCLUDE (c_acctbal) REPLACE ('GBP' AS currency, 5.0::DOUBLE AS stars,
                                          9.5::DOUBLE AS review_score)
    FROM listed WHERE c_acctbal >= 9000""",
)
_part(
    "search",
    (),
    """
    SELECT CASE o_orderstatus WHEN 'F' THEN o_custkey::VARCHAR
                WHEN 'P' THEN 'P-' || o_custkey END AS id,
           'USD' AS currency,
           CASE WHEN o_orderpriority <> '5-LOW' THEN sqrt(o_totalprice) END AS price,
           CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN sqrt(o_totalprice) / 100 END
               AS commission,
           CASE o_orderpriority WHEN '1-URGENT' THEN '[]'
                WHEN '4-NOT SPECIFIED' THEN '[breakfast, dinner]'
                WHEN '5-LOW' THEN '[5-low]' END AS meals,
           CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 0
                WHEN '4-NOT SPECIFIED' THEN 2 WHEN '5-LOW' THEN 1 END::INTEGER AS products,
           'https://search.example/' || o_orderkey AS deep_link_url,
           'https://offer.example/' || o_orderkey AS url
    FROM orders""",
)
_part(
    "records",
    (),
    """
    SELECT *, CASE WHEN event_type = 'view' AND k >= 90 THEN 'v' || user_id
                   ELSE user_id::VARCHAR END AS id,
           CASE WHEN event_type <> 'view' OR k >= 20 THEN sqrt(value) END AS score
    FROM (SELECT *, (props ->> 'k')::INTEGER AS k FROM events)""",
)
_part(
    "record_reviews",
    ("records",),
    """
    SELECT id, event_id AS review_id,
           CASE WHEN event_type = 'error' THEN strftime(ts, '%Y/%m/%d')
                ELSE (2024 - k // 25) || strftime(ts, '-%m-%d') END AS review_date,
           given AS review_individual_score,
           CASE WHEN k < 50 THEN 'en-gb' WHEN k < 80 THEN 'de' END AS review_language,
           event_type || ' ' || k AS review_summary,
           CASE WHEN k >= 50 THEN 'good ' || k END AS review_positive,
           CASE WHEN k < 30 THEN 'bad ' || k END AS review_negative,
           'Guest ' || user_id AS reviewer_name, 'c' || (k // 10) AS reviewer_country,
           CASE WHEN event_type IN ('click', 'purchase') THEN 'leisure'
                WHEN event_type = 'view' THEN 'business' END AS reviewer_travel_purpose,
           CASE WHEN k < 25 THEN 'couple' WHEN k < 50 THEN 'solo_traveller'
                WHEN k < 75 THEN 'family_with_children' WHEN k < 90 THEN 'extended_group' END
               AS reviewer_type
    FROM (SELECT *, score AS given FROM records
          WHERE event_type <> 'signup' AND NOT (event_type = 'error' AND k < 10)
          UNION ALL
          SELECT *, score + 1 AS given FROM records WHERE event_type = 'purchase')""",
)

# --- extraction ----------------------------------------------------------------------

_DETAILS = (
    "source_id",
    "property_name",
    "country_code",
    "currency",
    "star_rating",
    "review_score",
)
_OFFERS = (
    "search_id",
    "usd_price",
    "commission_pct",
    "meal_plan",
    "deep_link_url",
    "search_currency",
)
_part(
    "extracted",
    ("details",),
    """
    SELECT id AS source_id, coalesce(en_us, de, it, pt) AS property_name,
           trim(upper(country), ' ') AS country_code, currency,
           stars AS star_rating, review_score
    FROM details""",
)
_part(
    "offers",
    ("search",),
    """
    SELECT id AS search_id, price AS usd_price, commission AS commission_pct,
           meals AS meal_plan, deep_link_url, currency AS search_currency
    FROM search""",
)
_part(
    "unique_details",
    ("extracted",),
    f"""
    SELECT * FROM extracted WHERE source_id IS NOT NULL AND source_id <> ''
    QUALIFY row_number() OVER (PARTITION BY source_id ORDER BY {_ordered(_DETAILS[1:])}) = 1""",
)
_part(
    "matched",
    ("unique_details", "offers"),
    "SELECT * FROM unique_details JOIN offers ON source_id = search_id",
)


def _rental_rows(matched: str) -> str:
    return f"""
    SELECT concat_ws('-', 'GEN', source_id) AS id, source_id AS feed_provider_id, property_name,
           lower(regexp_replace(trim(property_name, ' '), '[^a-zA-Z0-9]+', '-', 'g'))
               AS property_slug,
           country_code, coalesce(currency, 'USD') AS currency,
           coalesce(usd_price, 0.0::DOUBLE) AS usd_price,
           coalesce(star_rating, 0.0::DOUBLE) AS star_rating,
           coalesce(review_score, 0.0::DOUBLE) AS review_score,
           commission_pct AS commission, meal_plan, true AS published,
           CASE WHEN property_name IS NULL OR length(country_code) <> 2 THEN 'NEEDS_REVIEW'
                ELSE 'GOOD' END AS data_quality_flag
    FROM {matched}"""


_part("rental_property", ("matched",), _rental_rows("matched"))
_part(
    "flat_properties",
    ("details",),
    """
    SELECT *, trim(CASE WHEN raw_name IS NULL OR trim(raw_name, ' ') = '' THEN raw_city
                        ELSE raw_name END, ' ') AS property_name
    FROM (SELECT try_cast(id AS BIGINT) AS source_id, coalesce(en_us, de, it, pt) AS raw_name,
                 city AS raw_city, currency AS raw_currency, country AS raw_country,
                 stars AS star_rating_raw, review_score AS review_score_raw
          FROM details WHERE id IS NOT NULL)""",
)
_part(
    "flat_reviews",
    ("record_reviews", "records"),
    """
    SELECT try_cast(id AS BIGINT) AS source_id_r, * EXCLUDE (id) FROM record_reviews
    UNION ALL
    SELECT try_cast(id AS BIGINT), NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
           NULL
    FROM records WHERE event_type = 'signup' OR (event_type = 'error' AND k < 10)""",
)
_FLAT = (
    "raw_name",
    "raw_city",
    "raw_currency",
    "raw_country",
    "star_rating_raw",
    "review_score_raw",
    "property_name",
)


def _enriched_rows(properties: str) -> str:
    return rf"""
    SELECT *, CASE WHEN property_name IS NULL OR trim(property_name, ' ') = ''
                        OR country_code IS NULL OR review_score = 0 OR star_rating = 0
                   THEN 'NEEDS_REVIEW' ELSE 'GOOD' END AS data_quality_flag
    FROM (SELECT *, 'GEN-' || source_id AS gen_id, source_id::VARCHAR AS feed_provider_id,
                 regexp_replace(regexp_replace(regexp_replace(regexp_replace(
                     trim(lower(property_name), ' '), '[^\w\s-]', '', 'g'),
                     '[\s_]+', '-', 'g'), '-{{2,}}', '-', 'g'), '^-|-$', '', 'g')
                     AS property_slug,
                 upper(raw_country) AS country_code,
                 CASE WHEN raw_currency IS NULL OR trim(raw_currency, ' ') = '' THEN 'USD'
                      ELSE raw_currency END AS currency,
                 coalesce(star_rating_raw, 0.0::DOUBLE) AS star_rating,
                 coalesce(review_score_raw, 0.0::DOUBLE) AS review_score, true AS published
          FROM {properties} LEFT JOIN flat_reviews ON source_id = source_id_r)"""


def _review_rows(enriched: str) -> str:
    return f"""
    SELECT source_id AS property_id, {", ".join(V.REVIEWED_PROPERTY_COLUMNS[1:])},
           review_id, review_date,
           year(try_strptime(review_date, '%Y-%m-%d'))::INTEGER AS review_year,
           {", ".join(V.REVIEW_FIELDS[3:])}
    FROM {enriched}"""


_part("enriched", ("flat_properties", "flat_reviews"), _enriched_rows("flat_properties"))
_part("property_reviews", ("enriched",), _review_rows("enriched"))

# --- the joined tables ---------------------------------------------------------------

# The tables that queries read hold all listings and offers.
_part("rental_table", ("rental_property",), "SELECT * FROM rental_property")
_part("reviews_table", ("property_reviews",), "SELECT * FROM property_reviews")
_part(
    "combined",
    ("rental_table", "reviews_table"),
    f"""
    SELECT {", ".join("r." + c for c in V.RENTAL_COLUMNS)}, v.property_id,
           {", ".join("v." + c for c in V.REVIEW_FIELDS)}
    FROM rental_table r JOIN reviews_table v ON r.id = v.gen_id""",
)
_part(
    "joined",
    ("rental_table", "reviews_table"),
    f"""
    SELECT r.*, v.property_id,
           {", ".join(f"v.{c} AS {V.SHARED_PREFIX}{c}" for c in V.SHARED_COLUMNS)},
           {", ".join("v." + c for c in V.REVIEW_FIELDS)}
    FROM rental_table r JOIN reviews_table v ON r.id = v.gen_id""",
)
_RENAMED = [V.SHARED_PREFIX + c for c in V.SHARED_COLUMNS]
_part(
    "joined_unique",
    ("joined",),
    f"""
    SELECT * FROM joined
    QUALIFY row_number() OVER (
        PARTITION BY id, review_id
        ORDER BY {_ordered([*V.RENTAL_COLUMNS[1:], *V.REVIEW_FIELDS[1:], *_RENAMED])}) = 1""",
)
_NESTED = """sum(count(review_id)) OVER (PARTITION BY {0})::INTEGER AS total_reviews,
           any_value(coalesce(parts, 1))::INTEGER AS parts,
           coalesce(string_agg(review_id::VARCHAR, ',' ORDER BY review_id), '') AS review_ids,
           coalesce(string_agg(concat_ws('|', review_date, review_year, review_summary,
                        review_positive, reviewer_name, reviewer_type), ';' ORDER BY review_id)
                    FILTER (WHERE review_id IS NOT NULL), '') AS review_texts"""
# Rows without an id are one property for each set of its columns.
_OWN = ", ".join(V.REVIEWED_PROPERTY_COLUMNS)
# A property with more than 10,000 reviews has several rows, its reviews dealt by a hash; some
# queries split at 5.
_LOW_LIMIT = ("10000", "5")
_DEALT = """CASE WHEN parts IS NULL THEN 0
           ELSE coalesce(('0x' || substr(md5({}::VARCHAR), 1, 8))::BIGINT % parts, 0)
           END::INTEGER AS part"""
_part(
    "long",
    ("reviews_table",),
    """
    SELECT gen_id AS long_id, ceil(count(*) / 10000.0)::BIGINT AS parts
    FROM (SELECT DISTINCT gen_id, review_id FROM reviews_table WHERE gen_id IS NOT NULL)
    GROUP BY gen_id HAVING count(*) > 10000""",
)
_part(
    "final_documents",
    ("joined_unique", "long"),
    f"""
    SELECT {", ".join(V.RENTAL_COLUMNS)}, part, {_NESTED.format("id")}
    FROM (SELECT *, {_DEALT.format("review_id")} FROM joined_unique
          LEFT JOIN long ON id = long_id)
    GROUP BY {", ".join(V.RENTAL_COLUMNS)}, part""",
)
_BYTES = " + ".join(
    f"coalesce({'strlen(' + c + ')' if c not in V.REVIEW_NUMBERS else f'CASE WHEN {c} IS NOT NULL THEN 8 END'}, 0)"
    for c in V.REVIEW_FIELDS
)
_part(
    "documents_by_bytes",
    ("joined_unique",),
    f"""
    SELECT {", ".join(V.RENTAL_COLUMNS)}, part, (count(*) OVER (PARTITION BY id))::INTEGER AS parts,
           {", ".join(_NESTED.format("id").split(",")[:1])},
           {_NESTED[_NESTED.index("coalesce(string_agg(review_id"):]}
    FROM (SELECT *, floor(coalesce(sum(CASE WHEN review_id IS NOT NULL THEN {_BYTES} END) OVER (
                     PARTITION BY id ORDER BY review_id NULLS FIRST
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / 400)::INTEGER AS part
          FROM joined_unique)
    GROUP BY {", ".join(V.RENTAL_COLUMNS)}, part""",
)
_part(
    "reviews_unique",
    ("reviews_table",),
    f"""
    SELECT * FROM reviews_table
    QUALIFY row_number() OVER (
        PARTITION BY gen_id, review_id
        ORDER BY {_ordered([*V.REVIEWED_PROPERTY_COLUMNS, *V.REVIEW_FIELDS])}) = 1""",
)
_part(
    "review_documents",
    ("reviews_unique", "long"),
    f"""
    SELECT {", ".join(V.REVIEWED_PROPERTY_COLUMNS)}, part, {_NESTED.format(_OWN)}
    FROM (SELECT *, {_DEALT.format("review_id")} FROM reviews_unique
          LEFT JOIN long ON gen_id = long_id)
    GROUP BY {", ".join(V.REVIEWED_PROPERTY_COLUMNS)}, part""",
)

# --- two states of a table -----------------------------------------------------------

_part(
    "monthly",
    (),
    "SELECT *, strftime(l_shipdate, '%Y-%m') AS month, month(l_shipdate) % 5 AS n FROM lineitem",
)
_part(
    "twice",
    ("monthly",),
    "SELECT * FROM monthly UNION ALL SELECT * FROM monthly WHERE l_linenumber = 1",
)
_part("state", ("twice",), "SELECT * FROM twice WHERE n <> 3")
_part(
    "later_state",
    ("twice",),
    """
    SELECT * REPLACE (CASE WHEN n = 0 AND l_partkey % 7 = 0 THEN l_tax + 1 ELSE l_tax END AS l_tax)
    FROM twice WHERE n NOT IN (1, 2)
    UNION ALL SELECT * FROM monthly WHERE n = 1""",
)
_part(
    "month_changes",
    ("state", "later_state"),
    """
    SELECT coalesce(a.month, b.month) AS month, coalesce(a.n, 0)::BIGINT AS rows_before,
           coalesce(b.n, 0)::BIGINT AS rows_after,
           CASE WHEN a.n IS NULL THEN 'new' WHEN b.n IS NULL THEN 'gone'
                WHEN coalesce(a.month, b.month) IN (
                    SELECT month FROM (SELECT * FROM state EXCEPT ALL SELECT * FROM later_state)
                    UNION ALL
                    SELECT month FROM (SELECT * FROM later_state EXCEPT ALL SELECT * FROM state)
                ) THEN 'changed' ELSE 'same' END AS change
    FROM (SELECT month, count(*) AS n FROM state GROUP BY month) AS a
    FULL JOIN (SELECT month, count(*) AS n FROM later_state GROUP BY month) AS b
           ON a.month = b.month""",
)

# --- metadata tables -----------------------------------------------------------------

_CUTOFF = "TIMESTAMP '1998-01-01 00:00:00'"
_part(
    "expired",
    (),
    f"""
    SELECT table_name, snapshot_id, committed_at
    FROM (SELECT o_custkey::VARCHAR AS table_name, o_orderkey AS snapshot_id,
                 o_orderdate AS committed_at,
                 row_number() OVER (PARTITION BY o_custkey
                                    ORDER BY o_orderdate DESC, o_orderkey DESC) AS age
          FROM orders)
    WHERE age > 1 AND committed_at < {_CUTOFF}""",
)
_part(
    "orphans",
    (),
    f"""
    SELECT 'data/' || o_orderkey AS path, o_custkey::VARCHAR AS table_name,
           o_orderdate AS modified_at
    FROM orders
    WHERE o_orderdate < {_CUTOFF}
      AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""",
)


def _slugged(expression: str) -> str:
    return f"SELECT doc_id, {expression} AS slug FROM documents"


_LINEITEM = (
    "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, "
    "l_tax, l_returnflag, l_linestatus, l_shipdate"
)
_SHIPPED = f"SELECT {_LINEITEM}, year(l_shipdate)::INTEGER AS ship_year FROM lineitem"
_BASE = "SELECT DISTINCT {} FROM combined"


def _distinct(*columns: str) -> str:
    return _BASE.format(", ".join(columns))


def expected() -> dict[str, str]:
    """Query name to SQL."""

    def sql(body: str, *needs: str) -> str:
        return _with_parts(body, needs)

    view_order = _ordered(["id", "review_id", *V.RENTAL_COLUMNS, "property_id", *V.REVIEW_FIELDS])
    queries = {
        # sources and sinks
        "scan_feed": sql(
            "SELECT id, coalesce(en_us, de, it, pt) AS name, country, city, currency,"
            " CASE WHEN stars <> 2 THEN stars END AS stars, review_score, accommodation_type, number_of_rooms, is_genius, is_work_friendly,"
            " url FROM details",
            "details",
        ),
        "scan_array_feed": sql(
            "SELECT id, coalesce(en_us, de, it, pt) AS name, country, city, currency, stars,"
            " review_score, accommodation_type, number_of_rooms, is_genius, is_work_friendly,"
            """ url || '?q={"a":["}]},{\\"' AS url FROM details""",
            "details",
        ),
        "scan_feed_search": sql(
            "SELECT id AS search_id, CASE WHEN url NOT LIKE '%7' THEN price END AS usd_price,"
            " commission AS commission_pct, meals AS"
            " meal_plan, deep_link_url, currency AS search_currency FROM search",
            "search",
        ),
        "scan_feed_reviews": sql(
            "SELECT * REPLACE (CASE WHEN review_id % 10 <> 7 THEN review_individual_score END"
            " AS review_individual_score,"
            " CASE WHEN review_id % 100 <> 99 THEN review_id END AS review_id) FROM flat_reviews",
            "flat_reviews",
        ),
        "feed_problems": sql(
            "SELECT 'details' AS feed, count(*) AS records, 0::BIGINT AS missed FROM details"
            " UNION ALL SELECT 'reviews', count(*), 0 FROM records",
            "details",
            "records",
        ),
        "table_scan": sql("SELECT * FROM rental_table", "rental_table"),
        "write_partitioned": f"SELECT {_LINEITEM} FROM lineitem",
        "write_partitioned_2level": _SHIPPED,
        "overwrite_partitions": f"""
            SELECT * FROM (SELECT {_LINEITEM} FROM lineitem)
            WHERE NOT (l_returnflag = 'R' AND l_linestatus = 'O')
            UNION ALL
            SELECT * REPLACE (l_quantity + 1000 AS l_quantity)
            FROM (SELECT {_LINEITEM} FROM lineitem)
            WHERE l_returnflag = 'R' AND l_linestatus = 'O' AND l_discount > 0""",
        "overwrite_full": f"""
            SELECT {_LINEITEM} FROM lineitem WHERE l_returnflag = 'R'""",
        "read_evolved": """
            SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus,
                   CASE WHEN o_orderstatus = 'P'
                        THEN o_orderdate END AS created_time
            FROM orders""",
        "read_discovered": """
            SELECT o_orderkey::BIGINT AS o_orderkey,
                   CASE o_orderkey % 3 WHEN 1 THEN o_totalprice ELSE trunc(o_totalprice) END::DOUBLE
                       AS o_totalprice,
                   CASE o_orderkey % 3 WHEN 2 THEN 'c' ELSE '' END || o_custkey AS o_custkey,
                   CASE o_orderkey % 3 WHEN 1 THEN o_totalprice > 100000 END AS large,
                   o_orderpriority, o_orderstatus
            FROM orders""",
        "discovered_schema": """
            SELECT * FROM (VALUES
                ('o_orderkey', 'bigint', 'bigint,int', false),
                ('o_totalprice', 'double', 'bigint,double,int', false),
                ('o_custkey', 'string', 'bigint,string', true),
                ('o_orderpriority', 'string', 'string', false),
                ('large', 'boolean', 'boolean', false)) AS t(name, type, types, conflict)""",
        "column_profile": " UNION ALL ".join(
            f"""SELECT '{c}' AS name, count(*) AS rows, count(*) - count({c}) AS nulls,
                min({c})::DOUBLE + 0.0 AS least, max({c})::DOUBLE + 0.0 AS most, NULL::VARCHAR AS first,
                NULL::VARCHAR AS last, true AS distinct_near, true AS quartiles_near,
                true AS frequent_near FROM lineitem"""
            for c in _LINEITEM.split(", ")
            if c not in ("l_returnflag", "l_linestatus", "l_shipdate")
        )
        + """ UNION ALL SELECT 'l_shipdate', count(*), 0, NULL, NULL,
                strftime(min(l_shipdate), '%Y-%m-%d %H:%M:%S'),
                strftime(max(l_shipdate), '%Y-%m-%d %H:%M:%S'), true, true, true FROM lineitem""",
        "backup_parquet": sql("SELECT * FROM rental_table", "rental_table"),
        "property_documents": sql("SELECT * FROM final_documents", "final_documents"),
        "nest_by_bytes": sql("SELECT * FROM documents_by_bytes", "documents_by_bytes"),
        "document_index": sql("SELECT * FROM final_documents", "final_documents"),
        "review_documents": sql("SELECT * FROM review_documents", "review_documents"),
        "property_documents_in_parts": sql(
            "SELECT * FROM final_documents", "final_documents"
        ).replace(*_LOW_LIMIT),
        "review_documents_in_parts": sql(
            "SELECT * FROM review_documents", "review_documents"
        ).replace(*_LOW_LIMIT),
        "doc_key": r"SELECT page_id, regexp_replace(url, '[/\\]', '_', 'g') AS doc_key FROM pages",
        "combined_view": sql("SELECT * FROM combined", "combined"),
        "combined_sql": sql(
            "SELECT meal_plan, review_language, count(*) AS rows,"
            " round(avg(review_individual_score), 2) AS avg_score"
            " FROM combined GROUP BY meal_plan, review_language",
            "combined",
        ),
        "changed_partitions": sql("SELECT * FROM month_changes", "month_changes"),
        "rewrite_changed": sql(
            """
            SELECT month, count(*) AS n, sum(l_tax::DECIMAL(12, 2))::DOUBLE AS tax,
                   any_value(change IN ('same', 'gone')) AS untouched
            FROM (SELECT * FROM later_state
                  UNION ALL SELECT * FROM state WHERE month NOT IN (SELECT month FROM later_state))
            JOIN month_changes USING (month) GROUP BY month""",
            "month_changes",
        ),
        "orphan_files_of_table": """
            SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_orderkey)::BIGINT AS orders
            FROM lineitem WHERE l_quantity > 40 AND l_tax > 0.05 GROUP BY ALL""",
        "files_to_expire": sql(
            """
            , gone AS (SELECT table_name, 'manifest/' || snapshot_id AS manifest FROM expired),
            entries AS (
                SELECT 'manifest/' || l_orderkey AS manifest,
                       'data/' || o_custkey || '/' || (l_partkey % 20) AS path
                FROM lineitem JOIN orders ON l_orderkey = o_orderkey
            )
            SELECT table_name, 'manifest' AS kind, manifest AS target FROM gone
            UNION ALL
            SELECT DISTINCT table_name, 'file', path FROM entries JOIN gone USING (manifest)
            WHERE path NOT IN (SELECT path FROM entries WHERE manifest NOT IN (SELECT manifest FROM gone))""",
            "expired",
        ),
        "report_cube": sql(
            """
            SELECT 'reviews_per_country' AS report, country_code AS key, count(review_id) AS total,
                   count(DISTINCT id) AS properties,
                   round(avg(review_individual_score), 2) AS avg_score,
                   round(avg(star_rating), 2) AS avg_stars, NULL::BIGINT AS countries
            FROM combined GROUP BY country_code
            UNION ALL
            SELECT 'reviews_by_year', review_year::VARCHAR, count(*), NULL,
                   round(avg(review_individual_score), 2), NULL, count(DISTINCT country_code)
            FROM combined WHERE review_year IS NOT NULL GROUP BY review_year
            UNION ALL
            SELECT 'quality_distribution', data_quality_flag, count(*), count(DISTINCT id), NULL, NULL, NULL
            FROM combined GROUP BY data_quality_flag
            UNION ALL
            SELECT 'by_purpose', reviewer_travel_purpose, count(*), NULL,
                   round(avg(review_individual_score), 2), NULL, NULL
            FROM combined WHERE reviewer_travel_purpose IS NOT NULL GROUP BY reviewer_travel_purpose
            UNION ALL
            SELECT 'by_type', reviewer_type, count(*), NULL,
                   round(avg(review_individual_score), 2), round(avg(star_rating), 2), NULL
            FROM combined WHERE reviewer_type IS NOT NULL GROUP BY reviewer_type""",
            "combined",
        ),
        "row_count": 'SELECT count(*) AS "rows", 11::INTEGER AS "columns" FROM lineitem',
        # extraction and derivation
        "extract_details": sql("SELECT * FROM extracted", "extracted"),
        "extract_search": sql("SELECT * FROM offers", "offers"),
        "flatten_properties": sql("SELECT * FROM flat_properties", "flat_properties"),
        "explode_reviews_outer": sql("SELECT * FROM flat_reviews", "flat_reviews"),
        "preferred_name": sql(
            "SELECT url, coalesce(en_us, de, it, pt) AS name FROM details", "details"
        ),
        "slug_ascii": _slugged(
            "lower(regexp_replace(trim(text, ' '), '[^a-zA-Z0-9]+', '-', 'g'))"
        ),
        "slug_word": _slugged(
            r"regexp_replace(regexp_replace(regexp_replace(regexp_replace("
            r"trim(lower(text), ' '), '[^\w\s-]', '', 'g'), '[\s_]+', '-', 'g'),"
            r" '-{2,}', '-', 'g'), '^-|-$', '', 'g')"
        ),
        "quality_flag_rental": sql(
            "SELECT source_id, country_code, CASE WHEN property_name IS NULL"
            " OR length(country_code) <> 2 THEN 'NEEDS_REVIEW' ELSE 'GOOD' END AS flag"
            " FROM extracted",
            "extracted",
        ),
        "quality_flag_reviews": sql(
            "SELECT source_id, CASE WHEN property_name IS NULL OR trim(property_name, ' ') = ''"
            " OR raw_country IS NULL OR star_rating_raw = 0 OR review_score_raw = 0"
            " THEN 'NEEDS_REVIEW' ELSE 'GOOD' END AS flag FROM flat_properties",
            "flat_properties",
        ),
        "rental_property": sql("SELECT * FROM rental_property", "rental_property"),
        "enrich_reviews": sql(
            "SELECT source_id, gen_id, feed_provider_id, property_slug, country_code, currency,"
            " star_rating, review_score, published, data_quality_flag, review_id FROM enriched",
            "enriched",
        ),
        "property_reviews": sql("SELECT * FROM property_reviews", "property_reviews"),
        "with_created_time": (
            "SELECT o_orderkey, o_custkey, TIMESTAMP '2024-06-01 12:00:00' AS created_time"
            " FROM orders"
        ),
        "raw_property_view": sql(
            "SELECT id, coalesce(en_us, de) AS name, country, city AS city_id, currency, stars,"
            " review_score, accommodation_type, number_of_rooms, is_genius, is_work_friendly,"
            " url FROM details",
            "details",
        ),
        "raw_reviews_view": sql(
            "SELECT id AS property_id, review_id, review_date,"
            " review_individual_score AS review_score, review_language, reviewer_name,"
            " reviewer_country, review_summary FROM record_reviews",
            "record_reviews",
        ),
        "raw_search_view": sql(
            "SELECT id, currency, price AS price_book, commission AS commission_pct,"
            " deep_link_url, url, products AS products_count FROM search",
            "search",
        ),
        # filters, joins, copies
        "clean_missing_key": sql(
            "SELECT * FROM extracted WHERE source_id IS NOT NULL AND source_id <> ''", "extracted"
        ),
        "rental_matched": sql("SELECT * FROM matched", "matched"),
        "rental_unmatched": sql(
            "SELECT * FROM unique_details WHERE source_id NOT IN"
            " (SELECT search_id FROM offers WHERE search_id IS NOT NULL)",
            "unique_details",
            "offers",
        ),
        "properties_left_reviews": (
            "SELECT o_orderkey AS source_id, o_custkey, l_orderkey AS source_id_r, l_linenumber,"
            " l_quantity FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey"
        ),
        "join_tables": sql("SELECT * FROM joined", "joined"),
        "dedup_key": sql("SELECT * FROM unique_details", "unique_details"),
        "dedup_reviews": f"""
            SELECT {_LINEITEM} FROM lineitem
            QUALIFY row_number() OVER (
                PARTITION BY l_orderkey, l_linenumber
                ORDER BY {_ordered([c.strip() for c in _LINEITEM.split(",")])}) = 1""",
        "dedup_joined": sql("SELECT * FROM joined_unique", "joined_unique"),
        "property_base": sql(
            _distinct(
                "id", "property_name", "country_code", "currency", "usd_price", "commission",
                "meal_plan", "published",
            ),
            "combined",
        ),
        # nesting and counts
        "nest_reviews": sql("SELECT * FROM final_documents", "final_documents"),
        "nest_orders": f"""
            SELECT o_custkey, part, count(*)::INTEGER AS total,
                   string_agg(o_orderkey::VARCHAR, ',' ORDER BY o_orderkey) AS order_keys
            FROM (SELECT o_custkey, o_orderkey, {_DEALT.format("o_orderkey")}
                  FROM orders LEFT JOIN (
                      SELECT o_custkey AS long_id, ceil(count(*) / 10000.0)::BIGINT AS parts
                      FROM orders GROUP BY o_custkey HAVING count(*) > 10000)
                  ON o_custkey = long_id)
            GROUP BY o_custkey, part""",
        "audit_counts": sql(
            """
            SELECT (SELECT count(*) FROM extracted) AS details_rows,
                   (SELECT count(*) FROM extracted WHERE source_id IS NULL OR source_id = '')
                       AS dropped_missing_key,
                   (SELECT count(*) FROM extracted WHERE source_id <> '')
                       - (SELECT count(*) FROM unique_details) AS removed_duplicates,
                   (SELECT count(*) FROM matched) AS matched_rows,
                   (SELECT count(*) FROM unique_details WHERE source_id NOT IN
                       (SELECT search_id FROM offers WHERE search_id IS NOT NULL))
                       AS unmatched_rows,
                   (SELECT count(*) FROM matched WHERE usd_price IS NULL) AS defaulted_prices""",
            "extracted",
            "matched",
        ),
        "build_counts": sql(
            """
            SELECT 'rows' AS name, count(*) AS n FROM rental_property UNION ALL
            SELECT 'needs_review', count(*) FROM rental_property
            WHERE data_quality_flag = 'NEEDS_REVIEW' UNION ALL
            SELECT 'missing_commission', count(*) FROM rental_property
            WHERE commission IS NULL UNION ALL
            SELECT 'details_rows', count(*) FROM extracted UNION ALL
            SELECT 'dropped_missing_key', count(*) FROM extracted
            WHERE coalesce(source_id, '') = '' UNION ALL
            SELECT 'removed_duplicates', count(*) - (SELECT count(*) FROM unique_details)
            FROM extracted WHERE source_id <> '' UNION ALL
            SELECT 'matched_rows', count(*) FROM matched UNION ALL
            SELECT 'unmatched_rows', count(*) FROM unique_details
            WHERE source_id NOT IN (SELECT search_id FROM offers WHERE search_id IS NOT NULL)
            UNION ALL
            SELECT 'defaulted_prices', count(*) FROM matched WHERE usd_price IS NULL""",
            "rental_property",
            "extracted",
        ),
        # reports
        "sample_rows": sql(
            f"SELECT {', '.join(V.SAMPLE_COLUMNS)} FROM combined ORDER BY {view_order} LIMIT 10",
            "combined",
        ),
        "reviews_per_country": sql(
            "SELECT country_code, count(DISTINCT id) AS properties,"
            " count(review_id) AS total_reviews,"
            " round(avg(review_individual_score), 2) AS avg_review_score,"
            " round(avg(star_rating), 2) AS avg_stars FROM combined GROUP BY country_code",
            "combined",
        ),
        "reviews_by_year": sql(
            "SELECT review_year, count(*) AS total_review_rows,"
            " round(avg(review_individual_score), 2) AS avg_score,"
            " count(DISTINCT country_code) AS countries_active"
            " FROM combined WHERE review_year IS NOT NULL GROUP BY review_year",
            "combined",
        ),
        "top_properties": sql(
            "SELECT id, any_value(property_name) AS name, any_value(country_code) AS country,"
            " any_value(star_rating) AS stars, round(avg(review_individual_score), 2) AS"
            " avg_score, count(review_id) AS num_reviews FROM combined"
            " WHERE review_id IS NOT NULL GROUP BY id HAVING count(review_id) >= 2"
            " ORDER BY avg_score DESC NULLS LAST, id LIMIT 10",
            "combined",
        ),
        "quality_distribution": sql(
            'SELECT data_quality_flag, count(DISTINCT id) AS properties, count(*) AS "rows"'
            " FROM combined GROUP BY data_quality_flag",
            "combined",
        ),
        "pricing_by_country": sql(
            "SELECT country_code, currency, count(*) AS properties,"
            " round(avg(usd_price), 2) AS avg_usd_price,"
            " round(min(usd_price), 2) AS min_usd_price,"
            " round(max(usd_price), 2) AS max_usd_price"
            " FROM (SELECT DISTINCT id, property_name, country_code, currency, usd_price,"
            " commission, meal_plan, published FROM combined) GROUP BY country_code, currency",
            "combined",
        ),
        "pricing_by_meal": sql(
            "SELECT meal_plan, count(*) AS properties,"
            " round(avg(usd_price), 2) AS avg_usd_price,"
            " round(avg(commission), 4) AS avg_commission,"
            " count(*) FILTER (WHERE commission IS NULL) AS missing_commission"
            " FROM (SELECT DISTINCT id, usd_price, commission, meal_plan, published"
            " FROM combined) GROUP BY meal_plan",
            "combined",
        ),
        "most_expensive": sql(
            "SELECT DISTINCT id, property_name, usd_price, commission, published FROM combined"
            " ORDER BY usd_price DESC, id, property_name NULLS FIRST, commission NULLS FIRST"
            " LIMIT 10",
            "combined",
        ),
        "by_purpose": sql(
            "SELECT reviewer_travel_purpose, count(*) AS reviews,"
            " round(avg(review_individual_score), 2) AS avg_score FROM combined"
            " WHERE reviewer_travel_purpose IS NOT NULL GROUP BY reviewer_travel_purpose",
            "combined",
        ),
        "join_coverage": sql(
            "SELECT count(DISTINCT id) AS properties_total,"
            " count(DISTINCT CASE WHEN review_id IS NOT NULL THEN id END)"
            " AS properties_with_reviews,"
            " count(DISTINCT CASE WHEN review_id IS NULL THEN id END)"
            " AS properties_without_reviews,"
            " count(review_id) AS total_reviews FROM combined",
            "combined",
        ),
        "review_density": sql(
            "SELECT id, count(review_id) AS reviews_per_property FROM combined GROUP BY id"
            " ORDER BY reviews_per_property DESC, id LIMIT 10",
            "combined",
        ),
        "filtered_reviews": sql(
            "SELECT property_name, reviewer_name, review_date, review_individual_score,"
            " review_summary FROM combined WHERE country_code = 'GB' AND review_year = 2024",
            "combined",
        ),
        "by_type": sql(
            "SELECT reviewer_type, round(avg(star_rating), 2) AS avg_stars,"
            " round(avg(review_individual_score), 2) AS avg_review_score,"
            " count(*) AS total_reviews FROM combined"
            " WHERE reviewer_type IS NOT NULL GROUP BY reviewer_type",
            "combined",
        ),
        # upkeep
        "snapshots_to_expire": sql("SELECT * FROM expired", "expired"),
        "orphan_files": sql("SELECT * FROM orphans", "orphans"),
        "maintenance_plan": sql(
            "SELECT table_name, 'expire_snapshot' AS action, snapshot_id::VARCHAR AS target"
            " FROM expired UNION ALL"
            " SELECT table_name, 'remove_orphan_file', path FROM orphans",
            "expired",
            "orphans",
        ),
        "table_health": """
            SELECT t.table_name,
                   concat_ws(' | ',
                       CASE WHEN location <> expected_location
                            THEN 'metadata location points to ' || location
                                 || ', expected ' || expected_location END,
                       CASE WHEN current_snapshot_id IS NOT NULL AND o_orderkey IS NULL
                            THEN 'current snapshot ' || current_snapshot_id
                                 || ' is missing from metadata' END,
                       CASE WHEN o_orderkey IS NOT NULL
                                 AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
                            THEN 'manifest list is missing: manifest/' || o_orderkey END)
                       AS reasons
            FROM (SELECT c_custkey::VARCHAR AS table_name, c_custkey,
                         'warehouse/' || c_custkey AS expected_location,
                         CASE WHEN c_acctbal < 0 THEN 'old/' || c_custkey
                              ELSE 'warehouse/' || c_custkey END AS location,
                         CASE c_mktsegment WHEN 'MACHINERY' THEN NULL
                              WHEN 'BUILDING' THEN -newest ELSE newest END AS current_snapshot_id
                  FROM customer LEFT JOIN (SELECT o_custkey, max(o_orderkey) AS newest
                                           FROM orders GROUP BY o_custkey)
                       ON c_custkey = o_custkey) t
            LEFT JOIN orders ON o_custkey = c_custkey AND o_orderkey = current_snapshot_id""",
    }
    columns = {
        "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint",
        "l_linenumber": "int", "l_quantity": "double", "l_extendedprice": "double",
        "l_discount": "double", "l_tax": "double", "l_returnflag": "string",
        "l_linestatus": "string", "l_shipdate": "timestamp_ntz",
    }
    queries["schema_table"] = " UNION ALL ".join(
        f"SELECT '{name}' AS \"column\", '{dtype}' AS dtype, count({name}) AS filled FROM lineitem"
        for name, dtype in columns.items()
    )
    return queries
