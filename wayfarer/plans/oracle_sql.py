"""Independent DuckDB SQL for every registered query (the cross-engine correctness oracle).

Written from the job definitions, not generated from the Spark plans. Tables ``part orders
lineitem`` are DuckDB views over the same Parquet files. Output conventions shared with
``wayfarer.plans.registry.canonical``: maps as ``k=v|k=v`` sorted by key ('' when empty), arrays
joined with '|', dates / decimals as text, integers as BIGINT.
"""

from __future__ import annotations

from wayfarer.plans.params import FIXTURE_PARAMS, Params


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# the category rules of the test tables, written out for DuckDB (not taken from the library's patterns)
_CATEGORY = """CASE
              WHEN regexp_matches(label_zh, 'ring|anvil') THEN 'forged'
              WHEN regexp_matches(label_zh, 'red|blue') THEN 'coloured'
              WHEN regexp_matches(label_zh, 'gear|gizmo|widget') THEN 'device'
              WHEN regexp_matches(label_zh, 'hot|cold') THEN 'thermal'
              WHEN regexp_matches(label_zh, 'PROMO') THEN 'promo'
              WHEN label_zh = '无标签' THEN 'unclassified'
              ELSE 'other' END"""


def _map_text(key: str, n: str) -> str:
    return f"string_agg({key} || '=' || CAST({n} AS VARCHAR), '|' ORDER BY {key})"


def _ctes(p: Params) -> str:
    none_flag, yes_flag, no_flag = (_q(x) for x in p.rising_flags)
    churned, active = (_q(x) for x in p.user_status)
    high, mid, low = (_q(x) for x in p.user_levels)
    growth = ("CASE WHEN prev IS NOT NULL AND prev > 0 THEN round((cur - prev) / prev, 4) ELSE 0 END")
    return f"""
ods_poi AS (
  SELECT CAST(p_partkey AS VARCHAR) AS poi_id,
         CASE WHEN p_partkey % 97 = 0 THEN NULL ELSE p_name END AS name_zh,
         p_name AS name_en, CASE WHEN copy_no = 1 THEN p_type ELSE p_brand END AS city_zh,
         CASE WHEN copy_no = 1 THEN p_type ELSE p_brand END AS city_en,
         CAST(p_size AS DECIMAL(10,6)) AS latitude, CAST(p_retailprice AS DECIMAL(10,6)) AS longitude,
         CASE WHEN p_partkey % 13 = 0 THEN '  ' WHEN p_partkey % 17 = 0 THEN NULL
              WHEN copy_no = 1 THEN p_type ELSE replace(p_name, ' ', ';') || ';' || p_type END AS label_zh,
         p_type AS label_en
  FROM part, unnest(CASE WHEN p_partkey % 23 = 0 THEN [0, 1] ELSE [0] END) AS c(copy_no)),
seqs AS (
  SELECT l_orderkey AS sk, string_agg(CAST(l_partkey AS VARCHAR), ';' ORDER BY l_partkey) AS seq
  FROM lineitem GROUP BY l_orderkey),
trip_src AS (
  SELECT *, CASE WHEN o_orderkey % 53 = 0 THEN CAST(o_orderdate AS DATE) - INTERVAL 10 YEAR
                 WHEN o_orderkey % 59 = 0 THEN CAST(o_orderdate AS DATE) + INTERVAL 10 YEAR
                 ELSE CAST(o_orderdate AS DATE) END AS day,
         CASE WHEN copy_no = 1 AND o_orderkey % 100 = 0 THEN (o_orderkey + 1) % 3 ELSE o_orderkey % 3 END AS layout
  FROM orders LEFT JOIN seqs ON sk = o_orderkey,
       unnest(CASE WHEN o_orderkey % 50 = 0 THEN [0, 1] ELSE [0] END) AS c(copy_no)),
ods_trip AS (
  SELECT CAST(o_custkey AS VARCHAR) AS blog_id, strftime(o_orderdate, '%Y-%m-%d') AS retrieval_date,
         CASE WHEN o_orderkey % 101 = 0 THEN 'junk'
              WHEN layout = 0 THEN strftime(day, '%Y/%-m/%-d')
              WHEN layout = 1 THEN strftime(day, '%Y-%m-%d')
              ELSE strftime(day, '%Y%m%d') END AS departure_date,
         CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN copy_no = 1 AND o_orderkey % 150 = 0 THEN '0-OTHER'
              ELSE o_orderpriority END AS travel_partners,
         CASE WHEN o_orderkey % 7 = 0 THEN seq || ';;' ELSE seq END AS visit_sequence
  FROM trip_src),
poi_kept AS (
  SELECT poi_id, name_zh, city_zh,
         coalesce(CASE WHEN trim(label_zh) = '' THEN NULL ELSE label_zh END, {_q(p.label_default)}) AS label_zh
  FROM ods_poi WHERE poi_id IS NOT NULL AND name_zh IS NOT NULL AND city_zh IS NOT NULL),
poi_all AS (
  SELECT poi_id, name_zh AS name, city_zh AS city, string_split(label_zh, ';') AS label,
         {_CATEGORY} AS category, label_zh
  FROM poi_kept),
dwd_poi AS (
  SELECT * FROM poi_all
  QUALIFY row_number() OVER (PARTITION BY poi_id ORDER BY name, city, category, label) = 1),
poi_u AS (
  SELECT poi_id, name, city, category FROM dwd_poi),
trip_kept AS (
  SELECT blog_id, departure_date, coalesce(travel_partners, {_q(p.partner_default)}) AS travel_partners,
         visit_sequence
  FROM ods_trip WHERE blog_id IS NOT NULL AND departure_date IS NOT NULL AND visit_sequence IS NOT NULL),
trip_parsed AS (
  SELECT *, CAST(year(travel_date) AS INTEGER) AS travel_year, CAST(month(travel_date) AS INTEGER) AS travel_month
  FROM (SELECT *, CAST(coalesce(try_strptime(departure_date, '%Y/%m/%d'), try_strptime(departure_date, '%Y-%m-%d'),
                                try_strptime(departure_date, '%Y%m%d')) AS DATE) AS travel_date
        FROM trip_kept)),
trip_in_range AS (
  SELECT * FROM trip_parsed WHERE travel_year >= {p.year_min} AND travel_year < {p.year_max}),
trip_unique AS (
  SELECT * FROM trip_in_range
  QUALIFY row_number() OVER (PARTITION BY blog_id, travel_date, visit_sequence
                             ORDER BY departure_date, travel_partners) = 1),
trip_ided AS (
  SELECT *, blog_id || '_' || departure_date AS trip_id FROM trip_unique),
visits AS (
  SELECT blog_id, trip_id, travel_date, travel_partners, poi_id, travel_year, travel_month
  FROM (SELECT *, unnest(string_split(visit_sequence, ';')) AS poi_id FROM trip_ided)
  WHERE trim(poi_id) <> ''),
vj AS (
  SELECT v.*, d.city, d.category FROM visits v LEFT JOIN poi_u d ON v.poi_id = d.poi_id),
um_base AS (
  SELECT blog_id, travel_year, travel_month, count(DISTINCT trip_id) AS trip_total_cnt,
         count(*) AS total_spot_cnt, min(travel_date) AS first_trip_date, max(travel_date) AS last_trip_date
  FROM vj GROUP BY blog_id, travel_year, travel_month),
um_city_l AS (SELECT blog_id, travel_year, travel_month, city AS k, count(*) AS n FROM vj
              WHERE city IS NOT NULL GROUP BY ALL),
um_cat_l AS (SELECT blog_id, travel_year, travel_month, category AS k, count(*) AS n FROM vj
             WHERE category IS NOT NULL GROUP BY ALL),
um_par_l AS (SELECT blog_id, travel_year, travel_month, travel_partners AS k, count(*) AS n FROM vj
             WHERE travel_partners IS NOT NULL GROUP BY ALL),
um_city AS (SELECT blog_id, travel_year, travel_month, {_map_text('k', 'n')} AS m FROM um_city_l GROUP BY ALL),
um_cat AS (SELECT blog_id, travel_year, travel_month, {_map_text('k', 'n')} AS m FROM um_cat_l GROUP BY ALL),
um_par AS (SELECT blog_id, travel_year, travel_month, {_map_text('k', 'n')} AS m FROM um_par_l GROUP BY ALL),
user_month AS (
  SELECT b.blog_id, b.trip_total_cnt, b.total_spot_cnt,
         coalesce(c.m, '') AS city_visit_map, coalesce(g.m, '') AS category_visit_map,
         coalesce(r.m, '') AS partner_visit_map,
         CAST(b.first_trip_date AS VARCHAR) AS first_trip_date, CAST(b.last_trip_date AS VARCHAR) AS last_trip_date,
         CAST(b.travel_year AS BIGINT) AS travel_year, CAST(b.travel_month AS BIGINT) AS travel_month
  FROM um_base b
  LEFT JOIN um_city c ON b.blog_id = c.blog_id AND b.travel_year = c.travel_year AND b.travel_month = c.travel_month
  LEFT JOIN um_cat g ON b.blog_id = g.blog_id AND b.travel_year = g.travel_year AND b.travel_month = g.travel_month
  LEFT JOIN um_par r ON b.blog_id = r.blog_id AND b.travel_year = r.travel_year AND b.travel_month = r.travel_month),
vq AS (
  SELECT poi_id, trip_id, travel_year, CAST(ceil(travel_month / 3) AS INTEGER) AS travel_quarter, travel_partners
  FROM visits),
aq_j AS (SELECT vq.*, d.name, d.city, d.category FROM vq JOIN poi_u d ON vq.poi_id = d.poi_id),
aq_agg AS (
  SELECT poi_id, name, city, category, travel_year, travel_quarter, count(*) AS visit_total_cnt
  FROM aq_j GROUP BY ALL),
aq_pl AS (SELECT poi_id, travel_year, travel_quarter, travel_partners AS k, count(*) AS n FROM aq_j GROUP BY ALL),
aq_pm AS (SELECT poi_id, travel_year, travel_quarter, {_map_text('k', 'n')} AS partner_map FROM aq_pl GROUP BY ALL),
aq_top AS (
  SELECT poi_id, travel_year, travel_quarter, string_agg(k, '|' ORDER BY k) AS top_partner
  FROM (SELECT *, max(n) OVER (PARTITION BY poi_id, travel_year, travel_quarter) AS mx FROM aq_pl)
  WHERE n = mx GROUP BY ALL),
aq_g AS (
  SELECT *, {growth} AS rate
  FROM (SELECT *, visit_total_cnt AS cur,
               lag(visit_total_cnt) OVER (PARTITION BY poi_id ORDER BY travel_year, travel_quarter) AS prev,
               lag(travel_year * 4 + travel_quarter - 1) OVER (PARTITION BY poi_id ORDER BY travel_year, travel_quarter)
                 AS prev_idx
        FROM aq_agg)),
attraction_quarter AS (
  SELECT a.poi_id, a.name, a.city, a.category, a.visit_total_cnt, m.partner_map,
         a.rate AS visit_cnt_growth_rate,
         CASE WHEN a.prev IS NULL THEN {none_flag} WHEN a.rate > {p.rising_threshold} THEN {yes_flag} ELSE {no_flag} END
           AS is_hot_rising,
         CAST(a.travel_year AS BIGINT) AS travel_year, CAST(a.travel_quarter AS BIGINT) AS travel_quarter,
         t.top_partner
  FROM aq_g a
  JOIN aq_pm m ON a.poi_id = m.poi_id AND a.travel_year = m.travel_year AND a.travel_quarter = m.travel_quarter
  JOIN aq_top t ON a.poi_id = t.poi_id AND a.travel_year = t.travel_year AND a.travel_quarter = t.travel_quarter),
aq_strict AS (
  SELECT *, CASE WHEN sprev IS NOT NULL AND sprev > 0 THEN round((cur - sprev) / sprev, 4) ELSE 0 END AS srate
  FROM (SELECT *, CASE WHEN prev_idx IS NULL THEN NULL
                       WHEN prev_idx = travel_year * 4 + travel_quarter - 2 THEN prev ELSE 0 END AS sprev
        FROM aq_g)),
cq_j AS (SELECT vq.*, d.city FROM vq JOIN poi_u d ON vq.poi_id = d.poi_id),
cq_agg AS (
  SELECT city, travel_year, travel_quarter, count(trip_id) AS visit_trip_cnt,
         count(DISTINCT poi_id) AS unique_attraction_cnt
  FROM cq_j GROUP BY ALL),
cq_pl AS (SELECT city, travel_year, travel_quarter, travel_partners AS k, count(*) AS n FROM cq_j GROUP BY ALL),
cq_pm AS (SELECT city, travel_year, travel_quarter, {_map_text('k', 'n')} AS partner_map FROM cq_pl GROUP BY ALL),
cq_top AS (
  SELECT city, travel_year, travel_quarter, string_agg(k, '|' ORDER BY k) AS top_partner
  FROM (SELECT *, max(n) OVER (PARTITION BY city, travel_year, travel_quarter) AS mx FROM cq_pl)
  WHERE n = mx GROUP BY ALL),
cq_g AS (
  SELECT *, {growth} AS rate
  FROM (SELECT *, visit_trip_cnt AS cur,
               lag(visit_trip_cnt) OVER (PARTITION BY city ORDER BY travel_year, travel_quarter) AS prev,
               lag(travel_year * 4 + travel_quarter - 1) OVER (PARTITION BY city ORDER BY travel_year, travel_quarter)
                 AS prev_idx
        FROM cq_agg)),
cq_strict AS (
  SELECT *, CASE WHEN sprev IS NOT NULL AND sprev > 0 THEN round((cur - sprev) / sprev, 4) ELSE 0 END AS srate
  FROM (SELECT *, CASE WHEN prev_idx IS NULL THEN NULL
                       WHEN prev_idx = travel_year * 4 + travel_quarter - 2 THEN prev ELSE 0 END AS sprev
        FROM cq_g)),
city_quarter AS (
  SELECT a.city, a.visit_trip_cnt, a.unique_attraction_cnt, m.partner_map, a.rate AS visit_cnt_growth_rate,
         CASE WHEN a.prev IS NULL THEN {none_flag} WHEN a.rate > {p.rising_threshold} THEN {yes_flag} ELSE {no_flag} END
           AS is_hot_rising,
         CAST(a.travel_year AS BIGINT) AS travel_year, CAST(a.travel_quarter AS BIGINT) AS travel_quarter,
         t.top_partner
  FROM cq_g a
  JOIN cq_pm m ON a.city = m.city AND a.travel_year = m.travel_year AND a.travel_quarter = m.travel_quarter
  JOIN cq_top t ON a.city = t.city AND a.travel_year = t.travel_year AND a.travel_quarter = t.travel_quarter),
fav_city_l AS (SELECT blog_id, k, sum(n) AS n FROM um_city_l GROUP BY ALL),
fav_cat_l AS (SELECT blog_id, k, sum(n) AS n FROM um_cat_l GROUP BY ALL),
fav_par_l AS (SELECT blog_id, k, sum(n) AS n FROM um_par_l GROUP BY ALL),
fav_city AS (SELECT blog_id, string_agg(k, '|' ORDER BY k) AS fav FROM
             (SELECT *, max(n) OVER (PARTITION BY blog_id) AS mx FROM fav_city_l) WHERE n = mx GROUP BY blog_id),
fav_cat AS (SELECT blog_id, string_agg(k, '|' ORDER BY k) AS fav FROM
            (SELECT *, max(n) OVER (PARTITION BY blog_id) AS mx FROM fav_cat_l) WHERE n = mx GROUP BY blog_id),
fav_par AS (SELECT blog_id, string_agg(k, '|' ORDER BY k) AS fav FROM
            (SELECT *, max(n) OVER (PARTITION BY blog_id) AS mx FROM fav_par_l) WHERE n = mx GROUP BY blog_id),
up_base AS (
  SELECT blog_id, CAST(sum(trip_total_cnt) AS BIGINT) AS total_trips, CAST(sum(total_spot_cnt) AS BIGINT) AS total_spots,
         max(last_trip_date) AS last_trip_date, count(DISTINCT travel_year) AS active_years
  FROM um_base GROUP BY blog_id),
user_status AS (
  SELECT blog_id, CASE WHEN DATE {_q(p.reference_date)} - last_trip_date > {p.churn_days} THEN {churned} ELSE {active} END
           AS user_status
  FROM up_base),
user_level AS (
  SELECT blog_id, CASE WHEN avg_trips >= {p.high_freq} THEN {high} WHEN avg_trips >= {p.mid_freq} THEN {mid} ELSE {low} END
           AS user_level
  FROM (SELECT blog_id, CASE WHEN active_years > 0 THEN total_trips / active_years ELSE 0 END AS avg_trips FROM up_base)),
user_portrait AS (
  SELECT b.blog_id, b.total_trips, b.total_spots, c.fav AS favorite_city, g.fav AS favorite_category,
         r.fav AS favorite_partner, l.user_level, s.user_status
  FROM up_base b
  LEFT JOIN fav_city c ON b.blog_id = c.blog_id
  LEFT JOIN fav_cat g ON b.blog_id = g.blog_id
  LEFT JOIN fav_par r ON b.blog_id = r.blog_id
  LEFT JOIN user_status s ON b.blog_id = s.blog_id
  LEFT JOIN user_level l ON b.blog_id = l.blog_id),
top_attractions AS (
  SELECT CAST(travel_year AS VARCHAR) || 'Q' || CAST(travel_quarter AS VARCHAR) AS year_quarter,
         poi_id, name, city, category, visit_total_cnt, top_partner, CAST(rk AS BIGINT) AS rank,
         is_hot_rising, visit_cnt_growth_rate
  FROM (SELECT *, row_number() OVER (PARTITION BY travel_year, travel_quarter
                                     ORDER BY visit_total_cnt DESC, poi_id, name, city, category) AS rk
        FROM attraction_quarter WHERE travel_year = {p.ranking_year})
  WHERE rk <= {p.top_attractions}),
aqa_j AS (SELECT vq.*, d.name, d.city, d.category FROM vq JOIN poi_all d ON vq.poi_id = d.poi_id),
aqa_pl AS (SELECT poi_id, name, city, category, travel_year, travel_quarter, travel_partners AS k, count(*) AS n
           FROM aqa_j GROUP BY ALL),
aqa AS (
  SELECT *, {growth} AS rate
  FROM (SELECT *, visit_total_cnt AS cur,
               lag(visit_total_cnt) OVER (PARTITION BY poi_id, name, city, category ORDER BY travel_year, travel_quarter) AS prev
        FROM (SELECT poi_id, name, city, category, travel_year, travel_quarter, CAST(sum(n) AS BIGINT) AS visit_total_cnt,
                     {_map_text('k', 'n')} AS partner_map FROM aqa_pl GROUP BY ALL))),
top_cities AS (
  SELECT CAST(travel_year AS VARCHAR) || 'Q' || CAST(travel_quarter AS VARCHAR) AS year_quarter,
         city, visit_trip_cnt, unique_attraction_cnt, top_partner, CAST(rk AS BIGINT) AS rank, is_hot_rising,
         visit_cnt_growth_rate
  FROM (SELECT *, row_number() OVER (PARTITION BY travel_year, travel_quarter ORDER BY visit_trip_cnt DESC, city) AS rk
        FROM city_quarter WHERE travel_year = {p.ranking_year})
  WHERE rk <= {p.top_cities}),
cities_numbered AS (
  SELECT city_zh AS city, TRY_CAST(string_split(city_zh, '#')[-1] AS INTEGER) AS n
  FROM (SELECT DISTINCT city_zh FROM ods_poi WHERE city_zh IS NOT NULL)),
city_map AS (
  SELECT city, CASE WHEN n IS NULL THEN array_to_string(string_split(city, ' ')[1:2], ' ') ELSE 'P' || (n // 5) END AS province,
         CASE WHEN n IS NULL THEN string_split(city, ' ')[1] ELSE 'R' || (n // 10) END AS region
  FROM cities_numbered WHERE n IS NULL OR n % 7 <> 0
  UNION ALL SELECT city, 'A0', 'unmapped' FROM cities_numbered WHERE n % 6 = 0 AND n % 7 <> 0
  UNION ALL SELECT city, 'Z9', 'R9' FROM cities_numbered WHERE n % 11 = 0 AND n % 6 <> 0 AND n % 7 <> 0),
city_placed AS (
  SELECT q.travel_year, q.travel_quarter, q.city, q.visit_trip_cnt, q.unique_attraction_cnt,
         coalesce(m.province, 'unmapped') AS province, coalesce(m.region, 'unmapped') AS region
  FROM city_quarter q LEFT JOIN (
    SELECT * FROM city_map QUALIFY row_number() OVER (PARTITION BY city ORDER BY province, region) = 1) m ON q.city = m.city),
places AS (
  SELECT travel_year, travel_quarter, 'total' AS level, NULL AS region, NULL AS province, NULL AS city, NULL AS wider,
         sum(visit_trip_cnt) AS v, sum(unique_attraction_cnt) AS a, count(*) AS n FROM city_placed GROUP BY ALL
  UNION ALL
  SELECT travel_year, travel_quarter, 'region', region, NULL, NULL, 'total', sum(visit_trip_cnt), sum(unique_attraction_cnt), count(*)
  FROM city_placed GROUP BY ALL
  UNION ALL
  SELECT travel_year, travel_quarter, 'province', region, province, NULL, 'region', sum(visit_trip_cnt), sum(unique_attraction_cnt), count(*)
  FROM city_placed GROUP BY ALL
  UNION ALL
  SELECT travel_year, travel_quarter, 'city', region, province, city, 'province', sum(visit_trip_cnt), sum(unique_attraction_cnt), count(*)
  FROM city_placed GROUP BY ALL),
places_g AS (
  SELECT p.*, p.v AS cur, w.v AS whole,
         lag(p.v) OVER (PARTITION BY p.level, p.region, p.province, p.city ORDER BY p.travel_year, p.travel_quarter) AS prev
  FROM places p LEFT JOIN places w ON w.travel_year = p.travel_year AND w.travel_quarter = p.travel_quarter AND w.level = p.wider
    AND CASE p.level WHEN 'region' THEN true WHEN 'province' THEN w.region = p.region
                     ELSE w.region = p.region AND w.province = p.province END),
places_r AS (SELECT *, {growth} AS rate FROM places_g),
tq AS (
  SELECT *, len(string_split(visit_sequence, ';')) AS n_visits,
         CAST(coalesce(try_strptime(departure_date, '%Y/%m/%d'), try_strptime(departure_date, '%Y-%m-%d'),
                       try_strptime(departure_date, '%Y%m%d')) AS DATE) AS travel_date
  FROM ods_trip)"""


_PROFILE = """
SELECT section, item, value, row_cnt, CAST(row_cnt AS DOUBLE) / (SELECT count(*) FROM ods_trip) AS share, low, high FROM (
  SELECT 'rows' AS section, '' AS item, '' AS value, count(*) AS row_cnt, CAST(NULL AS DOUBLE) AS low, CAST(NULL AS DOUBLE) AS high FROM tq
  UNION ALL
  SELECT 'column', c, CASE WHEN v IS NULL THEN 'null' WHEN trim(v, ' ') = '' THEN 'blank' ELSE 'value' END, count(*), NULL, NULL
  FROM (SELECT unnest(['blog_id', 'departure_date', 'travel_partners', 'visit_sequence']) AS c,
               unnest([blog_id, departure_date, travel_partners, visit_sequence]) AS v FROM tq) GROUP BY ALL
  UNION ALL
  SELECT 'parse', 'departure_date', CASE WHEN departure_date IS NULL THEN 'absent' WHEN travel_date IS NULL THEN 'failed' ELSE 'parsed' END,
         count(*), NULL, NULL FROM tq GROUP BY ALL
  UNION ALL
  SELECT 'histogram', 'travel_year', CAST(year(travel_date) AS VARCHAR), count(*), NULL, NULL FROM tq GROUP BY ALL
  UNION ALL
  SELECT 'range', 'travel_date', '', count(travel_date), CAST(min(travel_date) - DATE '1970-01-01' AS DOUBLE),
         CAST(max(travel_date) - DATE '1970-01-01' AS DOUBLE) FROM tq
  UNION ALL
  SELECT 'range', 'n_visits', '', count(n_visits), CAST(min(n_visits) AS DOUBLE), CAST(max(n_visits) AS DOUBLE) FROM tq
  UNION ALL
  SELECT 'duplicates', 'blog_id,travel_date,visit_sequence', 'surplus',
         (SELECT count(*) FROM tq) - (SELECT count(*) FROM (SELECT DISTINCT blog_id, travel_date, visit_sequence FROM tq)), NULL, NULL)"""

# final SELECT per registered query (column names equal the Spark side)
_FINAL: dict[str, str] = {
    "csv_rename_load_poi": """
SELECT poi_id, name_zh, name_en, city_zh, city_en, CAST(latitude AS VARCHAR) AS latitude,
       CAST(longitude AS VARCHAR) AS longitude, label_zh, label_en FROM ods_poi""",
    "csv_rename_load_trips": "SELECT * FROM ods_trip",
    "drop_null_keys": """
SELECT blog_id, departure_date, travel_partners, visit_sequence FROM ods_trip
WHERE blog_id IS NOT NULL AND departure_date IS NOT NULL AND visit_sequence IS NOT NULL""",
    "fill_default": "SELECT blog_id, departure_date, travel_partners, visit_sequence FROM trip_kept",
    "blank_to_null": "SELECT poi_id, CASE WHEN trim(label_zh) = '' THEN NULL ELSE label_zh END AS label_zh FROM ods_poi",
    "split_tags": "SELECT poi_id, array_to_string(label, '|') AS label FROM dwd_poi",
    "classify_rules": "SELECT poi_id, label_zh, category FROM dwd_poi",
    "parse_date_multi": """
SELECT blog_id, departure_date, travel_partners, visit_sequence, CAST(travel_date AS VARCHAR) AS travel_date
FROM trip_parsed""",
    "year_range": """
SELECT blog_id, departure_date, CAST(travel_date AS VARCHAR) AS travel_date, CAST(travel_year AS BIGINT) AS travel_year
FROM trip_in_range""",
    "dedupe_trips": """
SELECT blog_id, departure_date, travel_partners, visit_sequence, CAST(travel_date AS VARCHAR) AS travel_date,
       CAST(travel_year AS BIGINT) AS travel_year, CAST(travel_month AS BIGINT) AS travel_month FROM trip_unique""",
    "composite_trip_id": "SELECT blog_id, departure_date, trip_id FROM trip_ided",
    "explode_sequence": """
SELECT blog_id, departure_date, poi_id
FROM (SELECT blog_id, departure_date, unnest(string_split(visit_sequence, ';')) AS poi_id FROM trip_kept)
WHERE trim(poi_id) <> ''""",
    "clean_poi": """
SELECT poi_id, name, city, array_to_string(label, '|') AS label, category FROM dwd_poi""",
    "clean_trips": """
SELECT blog_id, trip_id, CAST(travel_date AS VARCHAR) AS travel_date, travel_partners, poi_id,
       CAST(travel_year AS BIGINT) AS travel_year, CAST(travel_month AS BIGINT) AS travel_month FROM visits""",
    "join_dim_left": "SELECT blog_id, trip_id, poi_id, city, category FROM vj",
    "join_dim_inner": """
SELECT v.blog_id, v.trip_id, v.poi_id, d.name, d.city, d.category
FROM visits v JOIN poi_u d ON v.poi_id = d.poi_id""",
    "user_month_base": """
SELECT blog_id, trip_total_cnt, total_spot_cnt, first_trip_date, last_trip_date, travel_year, travel_month
FROM user_month""",
    "user_month_city_map": """
SELECT blog_id, CAST(travel_year AS BIGINT) AS travel_year, CAST(travel_month AS BIGINT) AS travel_month,
       coalesce(m, '') AS city_visit_map
FROM (SELECT b.blog_id, b.travel_year, b.travel_month, c.m FROM um_base b LEFT JOIN um_city c
      ON b.blog_id = c.blog_id AND b.travel_year = c.travel_year AND b.travel_month = c.travel_month)""",
    "user_month_category_map": """
SELECT blog_id, CAST(travel_year AS BIGINT) AS travel_year, CAST(travel_month AS BIGINT) AS travel_month,
       coalesce(m, '') AS category_visit_map
FROM (SELECT b.blog_id, b.travel_year, b.travel_month, c.m FROM um_base b LEFT JOIN um_cat c
      ON b.blog_id = c.blog_id AND b.travel_year = c.travel_year AND b.travel_month = c.travel_month)""",
    "user_month_partner_map": """
SELECT blog_id, CAST(travel_year AS BIGINT) AS travel_year, CAST(travel_month AS BIGINT) AS travel_month,
       coalesce(m, '') AS partner_visit_map
FROM (SELECT b.blog_id, b.travel_year, b.travel_month, c.m FROM um_base b LEFT JOIN um_par c
      ON b.blog_id = c.blog_id AND b.travel_year = c.travel_year AND b.travel_month = c.travel_month)""",
    "user_month": "SELECT * FROM user_month",
    "attraction_quarter": """
SELECT poi_id, name, city, category, visit_total_cnt, partner_map, visit_cnt_growth_rate, is_hot_rising,
       travel_year, travel_quarter FROM attraction_quarter""",
    "attraction_growth_bridge": """
SELECT poi_id, travel_year, travel_quarter, visit_total_cnt, visit_cnt_growth_rate FROM attraction_quarter""",
    "rising_flag": "SELECT city, travel_year, travel_quarter, visit_trip_cnt, is_hot_rising FROM city_quarter",
    "attraction_growth_strict": """
SELECT poi_id, CAST(travel_year AS BIGINT) AS travel_year, CAST(travel_quarter AS BIGINT) AS travel_quarter,
       visit_total_cnt, srate AS visit_cnt_growth_rate,
       CASE WHEN sprev IS NULL THEN {none_flag} WHEN srate > {threshold} THEN {yes_flag} ELSE {no_flag} END
         AS is_hot_rising
FROM aq_strict""",
    "city_quarter": """
SELECT city, visit_trip_cnt, unique_attraction_cnt, partner_map, visit_cnt_growth_rate, is_hot_rising,
       travel_year, travel_quarter FROM city_quarter""",
    "city_quarter_from_attractions": """
SELECT city, visit_trip_cnt, unique_attraction_cnt, partner_map, visit_cnt_growth_rate, is_hot_rising,
       travel_year, travel_quarter FROM city_quarter""",
    "city_growth_strict": """
SELECT city, CAST(travel_year AS BIGINT) AS travel_year, CAST(travel_quarter AS BIGINT) AS travel_quarter,
       visit_trip_cnt, srate AS visit_cnt_growth_rate,
       CASE WHEN sprev IS NULL THEN {none_flag} WHEN srate > {threshold} THEN {yes_flag} ELSE {no_flag} END
         AS is_hot_rising
FROM cq_strict""",
    "top_partner": "SELECT poi_id, travel_year, travel_quarter, top_partner FROM attraction_quarter",
    "favorite_city": "SELECT blog_id, fav AS favorite_city FROM fav_city",
    "favorite_category": "SELECT blog_id, fav AS favorite_category FROM fav_cat",
    "favorite_partner": "SELECT blog_id, fav AS favorite_partner FROM fav_par",
    "user_status": "SELECT * FROM user_status",
    "user_level": "SELECT * FROM user_level",
    "user_portrait": "SELECT * FROM user_portrait",
    "top_attractions": "SELECT * FROM top_attractions",
    "top_cities": "SELECT * EXCLUDE (visit_cnt_growth_rate) FROM top_cities",
    "top_cities_growth": "SELECT * FROM top_cities",
    "attraction_quarter_allow": """
SELECT poi_id, name, city, category, visit_total_cnt, partner_map, rate AS visit_cnt_growth_rate,
       CASE WHEN prev IS NULL THEN {none_flag} WHEN rate > {threshold} THEN {yes_flag} ELSE {no_flag} END AS is_hot_rising,
       CAST(travel_year AS BIGINT) AS travel_year, CAST(travel_quarter AS BIGINT) AS travel_quarter
FROM aqa""",
    "parse_date_optional": """
SELECT blog_id, text AS departure_date,
       CAST(CAST(coalesce(try_strptime(text, '%Y/%m/%d'), try_strptime(text, '%Y-%m-%d %H:%M'),
                          try_strptime(text, '%Y-%m-%d'), try_strptime(text, '%Y%m%d')) AS DATE) AS VARCHAR) AS travel_date
FROM (SELECT blog_id, CASE WHEN departure_date LIKE '%-%' AND CAST(blog_id AS BIGINT) % 2 = 0
                           THEN departure_date || ' 08:30' ELSE departure_date END AS text FROM ods_trip)""",
    "catalog_dynamic_overwrite": """
SELECT city, visit_trip_cnt + CASE WHEN travel_year = {ranking_year} THEN 1000 ELSE 0 END AS visit_trip_cnt,
       unique_attraction_cnt, partner_map, visit_cnt_growth_rate, is_hot_rising, travel_year, travel_quarter
FROM city_quarter""",
    "quality_year_histogram": """
SELECT CAST(travel_year AS BIGINT) AS travel_year, count(*) AS row_cnt FROM trip_parsed GROUP BY travel_year""",
    "quality_category_histogram": "SELECT category, count(*) AS row_cnt FROM dwd_poi GROUP BY category",
    "quality_report_typed": """
SELECT 'longitude' AS column_name, count(*) AS row_cnt, count(*) - count(longitude) AS null_cnt, 0 AS blank_cnt,
       CAST(min(longitude) AS VARCHAR) AS min_value, CAST(max(longitude) AS VARCHAR) AS max_value FROM ods_poi
UNION ALL
SELECT 'latitude', count(*), count(*) - count(latitude), 0, CAST(min(latitude) AS VARCHAR), CAST(max(latitude) AS VARCHAR)
FROM ods_poi""",
    "conform_failures": """
SELECT 'latitude' AS column_name, count(*) AS value_cnt, count(*) FILTER (CAST(poi_id AS BIGINT) % 29 = 0) AS failed_cnt FROM ods_poi
UNION ALL
SELECT 'longitude', count(*), 0 FROM ods_poi""",
    "partition_pruned_year": """
SELECT city, visit_trip_cnt, unique_attraction_cnt, partner_map, visit_cnt_growth_rate, is_hot_rising,
       travel_year, travel_quarter FROM city_quarter WHERE travel_year = {ranking_year}""",
    "layered_top_cities": "SELECT * EXCLUDE (visit_cnt_growth_rate) FROM top_cities",
    "quality_report": """
SELECT column_name, row_cnt, null_cnt, blank_cnt, min_value, max_value FROM (
  SELECT 'blog_id' AS column_name, count(*) AS row_cnt, count(*) - count(blog_id) AS null_cnt,
         count(*) FILTER (WHERE trim(blog_id) = '') AS blank_cnt, min(blog_id) AS min_value, max(blog_id) AS max_value
  FROM ods_trip
  UNION ALL
  SELECT 'departure_date', count(*), count(*) - count(departure_date),
         count(*) FILTER (WHERE trim(departure_date) = ''), min(departure_date), max(departure_date) FROM ods_trip
  UNION ALL
  SELECT 'travel_partners', count(*), count(*) - count(travel_partners),
         count(*) FILTER (WHERE trim(travel_partners) = ''), min(travel_partners), max(travel_partners) FROM ods_trip
  UNION ALL
  SELECT 'visit_sequence', count(*), count(*) - count(visit_sequence),
         count(*) FILTER (WHERE trim(visit_sequence) = ''), min(visit_sequence), max(visit_sequence) FROM ods_trip)""",
    "quality_report_poi": """
SELECT column_name, row_cnt, null_cnt, blank_cnt, min_value, max_value FROM (
  SELECT 'poi_id' AS column_name, count(*) AS row_cnt, count(*) - count(poi_id) AS null_cnt,
         count(*) FILTER (WHERE trim(poi_id) = '') AS blank_cnt, min(poi_id) AS min_value, max(poi_id) AS max_value
  FROM ods_poi
  UNION ALL
  SELECT 'name_zh' AS column_name, count(*) AS row_cnt, count(*) - count(name_zh) AS null_cnt,
         count(*) FILTER (WHERE trim(name_zh) = '') AS blank_cnt, min(name_zh) AS min_value, max(name_zh) AS max_value
  FROM ods_poi
  UNION ALL
  SELECT 'city_zh' AS column_name, count(*) AS row_cnt, count(*) - count(city_zh) AS null_cnt,
         count(*) FILTER (WHERE trim(city_zh) = '') AS blank_cnt, min(city_zh) AS min_value, max(city_zh) AS max_value
  FROM ods_poi
  UNION ALL
  SELECT 'label_zh' AS column_name, count(*) AS row_cnt, count(*) - count(label_zh) AS null_cnt,
         count(*) FILTER (WHERE trim(label_zh) = '') AS blank_cnt, min(label_zh) AS min_value, max(label_zh) AS max_value
  FROM ods_poi)""",
    "date_parse_failures": """
SELECT departure_date, count(*) AS row_cnt FROM trip_parsed WHERE travel_date IS NULL GROUP BY departure_date""",
    "user_month_persisted": "SELECT * FROM user_month",
    "user_portrait_bucketed": "SELECT * FROM user_portrait",
    "user_portrait_updated": "SELECT * FROM user_portrait",
    "top_cities_latest": """
SELECT CAST(travel_year AS VARCHAR) || 'Q' || CAST(travel_quarter AS VARCHAR) AS year_quarter, city, visit_trip_cnt, unique_attraction_cnt,
       top_partner, rk AS rank, is_hot_rising
FROM (SELECT *, row_number() OVER (PARTITION BY travel_quarter ORDER BY visit_trip_cnt DESC, city) AS rk FROM city_quarter
      WHERE travel_year = (SELECT max(travel_year) FROM city_quarter)) WHERE rk <= {top_cities}""",
    "region_quarter": """
SELECT travel_year, travel_quarter, level, region, province, city, CAST(v AS BIGINT) AS visit_trip_cnt,
       CAST(a AS BIGINT) AS unique_attraction_cnt, n AS city_cnt, rate AS visit_cnt_growth_rate,
       CASE WHEN prev IS NULL THEN {none_flag} WHEN rate > {threshold} THEN {yes_flag} ELSE {no_flag} END AS is_hot_rising,
       round(v / whole, 4) AS share_of_parent
FROM places_r""",
    "ddl_text_table": """
SELECT poi_id, name_zh, name_en, city_zh, city_en, CAST(latitude AS VARCHAR) AS latitude,
       CAST(longitude AS VARCHAR) AS longitude, label_zh, label_en FROM ods_poi""",
    "staged_overwrite": """
SELECT city, visit_trip_cnt, unique_attraction_cnt, partner_map, visit_cnt_growth_rate, is_hot_rising,
       travel_year, travel_quarter FROM city_quarter""",
    "step_counts": """
SELECT u.step, u.point_no, u.point, u.row_cnt, u.dropped_cnt FROM (SELECT unnest([
  {{'step': 'ods_poi_dim', 'point_no': 0, 'point': 'written', 'row_cnt': poi, 'dropped_cnt': NULL}},
  {{'step': 'ods_user_travel_sequence', 'point_no': 0, 'point': 'written', 'row_cnt': trip, 'dropped_cnt': NULL}},
  {{'step': 'dwd_poi_info', 'point_no': 0, 'point': 'read', 'row_cnt': poi, 'dropped_cnt': NULL}},
  {{'step': 'dwd_poi_info', 'point_no': 1, 'point': 'with_keys', 'row_cnt': poi_keys, 'dropped_cnt': poi - poi_keys}},
  {{'step': 'dwd_poi_info', 'point_no': 2, 'point': 'unique', 'row_cnt': poi_one, 'dropped_cnt': poi_keys - poi_one}},
  {{'step': 'dwd_poi_info', 'point_no': 3, 'point': 'written', 'row_cnt': poi_one, 'dropped_cnt': NULL}},
  {{'step': 'dwd_user_travel_sequence_info', 'point_no': 0, 'point': 'read', 'row_cnt': trip, 'dropped_cnt': NULL}},
  {{'step': 'dwd_user_travel_sequence_info', 'point_no': 1, 'point': 'with_keys', 'row_cnt': trip_keys, 'dropped_cnt': trip - trip_keys}},
  {{'step': 'dwd_user_travel_sequence_info', 'point_no': 2, 'point': 'in_years', 'row_cnt': trip_years, 'dropped_cnt': trip_keys - trip_years}},
  {{'step': 'dwd_user_travel_sequence_info', 'point_no': 3, 'point': 'unique', 'row_cnt': trip_one, 'dropped_cnt': trip_years - trip_one}},
  {{'step': 'dwd_user_travel_sequence_info', 'point_no': 4, 'point': 'visits', 'row_cnt': visit, 'dropped_cnt': NULL}},
  {{'step': 'dwd_user_travel_sequence_info', 'point_no': 5, 'point': 'written', 'row_cnt': visit, 'dropped_cnt': NULL}},
  {{'step': 'dws_user_travel_month', 'point_no': 0, 'point': 'visits', 'row_cnt': visit, 'dropped_cnt': NULL}},
  {{'step': 'dws_user_travel_month', 'point_no': 1, 'point': 'written', 'row_cnt': months, 'dropped_cnt': NULL}},
  {{'step': 'dws_attraction_travel_quarter', 'point_no': 0, 'point': 'visits', 'row_cnt': visit, 'dropped_cnt': NULL}},
  {{'step': 'dws_attraction_travel_quarter', 'point_no': 1, 'point': 'written', 'row_cnt': attr, 'dropped_cnt': NULL}},
  {{'step': 'dws_city_travel_quarter', 'point_no': 0, 'point': 'written', 'row_cnt': cities, 'dropped_cnt': NULL}},
  {{'step': 'ads_user_portrait', 'point_no': 0, 'point': 'user_months', 'row_cnt': months, 'dropped_cnt': NULL}},
  {{'step': 'ads_user_portrait', 'point_no': 1, 'point': 'written', 'row_cnt': users, 'dropped_cnt': NULL}},
  {{'step': 'ads_top50_attractions_last_year', 'point_no': 0, 'point': 'in_year', 'row_cnt': attr_year, 'dropped_cnt': NULL}},
  {{'step': 'ads_top50_attractions_last_year', 'point_no': 1, 'point': 'written', 'row_cnt': top_a, 'dropped_cnt': attr_year - top_a}},
  {{'step': 'ads_city_top10_last_year', 'point_no': 0, 'point': 'in_year', 'row_cnt': city_year, 'dropped_cnt': NULL}},
  {{'step': 'ads_city_top10_last_year', 'point_no': 1, 'point': 'written', 'row_cnt': top_c, 'dropped_cnt': city_year - top_c}}]) AS u FROM (
  SELECT (SELECT count(*) FROM ods_poi) AS poi, (SELECT count(*) FROM poi_kept) AS poi_keys, (SELECT count(*) FROM dwd_poi) AS poi_one,
         (SELECT count(*) FROM ods_trip) AS trip, (SELECT count(*) FROM trip_kept) AS trip_keys, (SELECT count(*) FROM trip_in_range) AS trip_years,
         (SELECT count(*) FROM trip_unique) AS trip_one, (SELECT count(*) FROM visits) AS visit, (SELECT count(*) FROM user_month) AS months,
         (SELECT count(*) FROM attraction_quarter) AS attr, (SELECT count(*) FROM city_quarter) AS cities,
         (SELECT count(*) FROM attraction_quarter WHERE travel_year = {ranking_year}) AS attr_year,
         (SELECT count(*) FROM city_quarter WHERE travel_year = {ranking_year}) AS city_year,
         (SELECT count(*) FROM user_portrait) AS users, (SELECT count(*) FROM top_attractions) AS top_a, (SELECT count(*) FROM top_cities) AS top_c) AS c)""",
    "quality_one_pass": _PROFILE,
    "quality_merged": _PROFILE,
    "classify_chinese_rules": """
SELECT poi_id, label_zh, CASE
    WHEN regexp_matches(label_zh, '乐园|游乐场|漂流|拓展|骑行|露营|欢乐谷|方特|主题体验') THEN '主题游乐'
    WHEN regexp_matches(label_zh, '博物馆|美术馆|纪念馆|展览馆|科技馆|影视基地|故居|名人故居') THEN '文化场馆'
    WHEN regexp_matches(label_zh, '古镇|古城|古建|古建筑|寺庙|石窟|园林|古村落|城墙|文物古迹|历史遗址|古战场|老城|文庙|道观') THEN '历史人文古迹'
    WHEN regexp_matches(label_zh, '城市地标|地标建筑|城市标志建筑|高楼|摩天轮|网红打卡点') THEN '都市地标'
    WHEN regexp_matches(label_zh, '公园|商圈|步行街|广场|绿地|城市公园') THEN '都市休闲'
    WHEN regexp_matches(label_zh, '乡村|农庄|农家乐|采摘|田园|民俗村') THEN '乡村生态'
    WHEN regexp_matches(label_zh, '山|河|江|湖|海|瀑布|草原|峡谷|海滩|海岛|红树林|温泉|生态|山水|风景|自然景观|湖泊|江河|溪流|湿地|森林|花海|赏花') THEN '自然风光'
    WHEN label_zh = '无标签' THEN '未分类' ELSE '其他景点' END AS category
FROM (SELECT poi_id, CASE WHEN CAST(poi_id AS BIGINT) % 19 = 0 THEN '无标签' ELSE
        replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(name_en,
          'small', '森林'), 'red', '公园'), 'blue', '湖泊'), 'hot', '温泉'), 'cold', '高楼'), 'ring', '博物馆'), 'gear', '古镇'), 'bolt', '乡村'),
          'widget', '漂流'), 'gizmo', '商圈'), ' ', '') END AS label_zh FROM ods_poi)""",
    "duplicate_trips": """
SELECT count(*) AS duplicate_groups, coalesce(CAST(sum(n - 1) AS BIGINT), 0) AS surplus_rows
FROM (SELECT count(*) AS n FROM trip_parsed GROUP BY blog_id, travel_date, visit_sequence HAVING count(*) > 1)""",
}


def oracle_sql(params: Params = FIXTURE_PARAMS) -> dict[str, str]:
    ctes = _ctes(params)
    none_flag, yes_flag, no_flag = (_q(x) for x in params.rising_flags)
    fmt = dict(none_flag=none_flag, yes_flag=yes_flag, no_flag=no_flag, threshold=params.rising_threshold,
               ranking_year=params.ranking_year, top_cities=params.top_cities)
    return {name: f"WITH {ctes}\n{body.format(**fmt)}" for name, body in _FINAL.items()}
