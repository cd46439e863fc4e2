"""DuckDB SQL of the catalogue's queries, where SQL can express them."""

from __future__ import annotations

from ..schema import ADMIN_WORDS, CITY_ALIASES, CITY_WORDS, NAMELESS_ROADS, PREFIX_TOKENS, PROVINCE_WORDS, TERMINATORS


def _list(words: list[str]) -> str:
    return ", ".join(f"'{w}'" for w in words)


def _norm(x: str) -> str:
    return f"trim(regexp_replace(regexp_replace(replace(replace(upper(strip_accents(coalesce({x}, ''))), 'ẞ', 'SS'), '&', ' AND '), '[/,;:()\\-.'']', ' ', 'g'), '\\s+', ' ', 'g'))"


def _drop(x: str, words: list[str]) -> str:
    return f"trim(regexp_replace(regexp_replace({x}, '\\b(?:{'|'.join(sorted(words, key=len, reverse=True))})\\b', ' ', 'g'), '\\s+', ' ', 'g'))"


def _joined(x: str) -> str:
    return f"CASE WHEN regexp_full_match({x}, '\\S( \\S)+') THEN replace({x}, ' ', '') ELSE {x} END"


def _city(x: str) -> str:
    inner = _drop(_drop(_joined(_norm(x)), ADMIN_WORDS), CITY_WORDS)
    return f"CASE WHEN {inner} IN ({_list(list(CITY_ALIASES))}) THEN 'KEPULAUAN SERIBU' ELSE {inner} END"


def _road(x: str) -> str:
    inner = f"trim(regexp_replace({_norm(x)}, '^(?:(?:{'|'.join(PREFIX_TOKENS)})(?: |$))+(?:RAYA(?: |$))?', ''))"
    return f"CASE WHEN {inner} IN ({_list(NAMELESS_ROADS)}) THEN '' ELSE {inner} END"


def _tokens(x: str) -> str:
    return f"list_filter(string_split({x}, ' '), lambda w: w NOT IN ({_list(PREFIX_TOKENS + TERMINATORS)}) AND w <> '' AND (length(w) >= 3 OR regexp_full_match(w, '[0-9]+')))"


def _overlap(a: str, b: str) -> str:
    x, y = f"list_distinct(string_split({a}, ' '))", f"list_distinct(string_split({b}, ' '))"
    return f"len(list_intersect({x}, {y}))::DOUBLE / greatest(len({x}), len({y}))"


NAMES = f"SELECT DISTINCT {_road('p_name')} AS road_name FROM part"
PAIRS = f"SELECT a.road_name AS query, b.road_name FROM ({NAMES}) a, ({NAMES}) b WHERE a.road_name <> b.road_name"
OVERLAPS = f"""SELECT query, road_name, count(*)::BIGINT AS overlap FROM (SELECT query, unnest({_tokens('query')}) AS token FROM (SELECT road_name || ' LARGE BOLT' AS query FROM ({NAMES})))
JOIN (SELECT road_name, unnest(list_distinct({_tokens('road_name')})) AS token FROM ({NAMES})) USING (token) GROUP BY ALL"""


def _best(score: str, margin: str) -> str:
    return f"""SELECT *, score >= {score}::DOUBLE AND NOT (score - runner_up < {margin}::DOUBLE) AS accepted FROM (
SELECT *, lead(score, 1, 0.0::DOUBLE) OVER w AS runner_up, row_number() OVER w AS rn FROM (SELECT *, {_overlap('query', 'road_name')} AS score, length(road_name) AS overlap FROM ({PAIRS}))
WINDOW w AS (PARTITION BY query ORDER BY score DESC, overlap DESC, road_name)) WHERE rn = 1"""


BOXES = """SELECT r_name, n_name, c_mktsegment, c_custkey, (c_custkey % 97)::DOUBLE AS minx, (c_custkey % 89)::DOUBLE AS miny, (c_custkey % 97 + c_custkey % 7)::DOUBLE AS maxx, (c_custkey % 89 + c_custkey % 5)::DOUBLE AS maxy
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""
SEGMENTS = """SELECT *, sqrt(pow(x2 - x1, 2) + pow(y2 - y1, 2)) AS length FROM (
SELECT user_id, x AS x1, y AS y1, lead(x) OVER w AS x2, lead(y) OVER w AS y2 FROM (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id)::DOUBLE AS x, value AS y FROM events)
WINDOW w AS (PARTITION BY user_id ORDER BY x)) WHERE x2 IS NOT NULL"""


def _point(fraction: str) -> str:
    return f"""WITH s AS ({SEGMENTS}), c AS (SELECT *, sum(length) OVER (PARTITION BY user_id ORDER BY x1 ROWS UNBOUNDED PRECEDING) AS reach, sum(length) OVER (PARTITION BY user_id) AS total, {fraction} AS f FROM s),
p AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY (reach >= f * total) DESC, CASE WHEN reach >= f * total THEN x1 ELSE -x1 END) AS rn FROM c)
SELECT user_id, round(x1 + (x2 - x1) * t, 6) AS x, round(y1 + (y2 - y1) * t, 6) AS y, round(total, 6) AS total FROM (SELECT *, least(1.0::DOUBLE, greatest(0.0::DOUBLE, (f * total - (reach - length)) / length)) AS t FROM p WHERE rn = 1)"""


_PHRASES = f"""WITH seg AS (SELECT doc_id, i, list_filter(string_split(string_split_regex(t, '\\|+')[i], ' '), lambda w: w <> '') AS w
  FROM (SELECT doc_id, t, unnest(range(1, len(string_split_regex(t, '\\|+')) + 1)) AS i FROM (SELECT doc_id, {_norm('text')} AS t FROM documents))),
v AS (SELECT doc_id, i, 0 AS v, w FROM seg UNION ALL SELECT doc_id, i, 1, w[2:] FROM seg WHERE w[1] IN ({_list(PREFIX_TOKENS)}, 'RAYA') UNION ALL SELECT doc_id, i, 2, w[3:] FROM seg WHERE w[1] IN ({_list(PREFIX_TOKENS)}) AND w[2] = 'RAYA'),
c AS (SELECT doc_id, i, v, w[1:least(8, CASE WHEN stop > 0 THEN stop - 1 ELSE len(w) END)] AS w FROM (SELECT *, coalesce(list_position(list_transform(w, lambda x: x IN ({_list(TERMINATORS)})), true), 0) AS stop FROM v)),
p AS (SELECT doc_id, array_to_string(w[1:k], ' ') AS phrase, k AS n, min(i * 100 + v * 10 - k) AS pos FROM (SELECT *, unnest(range(1, len(w) + 1)) AS k FROM c) GROUP BY ALL)
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, pos)::INTEGER AS phrase_rank, phrase FROM p"""

_HREF = "(?is)<a\\s[^>]*?href\\s*=\\s*[\"'']([^\"'']*)[\"'']"


def _page(x: str) -> str:
    return f"try_cast(regexp_extract({x}, '[?&]page=([^&#]*)', 1) AS BIGINT)"


ORACLE_SQL: dict[str, str] = {
    "normalize_text": f"SELECT doc_id, {_norm('text')} AS norm FROM documents",
    "normalize_admin": f"""SELECT n_nationkey, {_drop(_joined(_norm("'Kab. ' || n_name")), ADMIN_WORDS)} AS admin, {_city("'Kota Adm. ' || n_name")} AS city, {_drop(_joined(_norm("'Provinsi Daerah Istimewa ' || n_name")), PROVINCE_WORDS)} AS province FROM nation""",
    "detect_kind": "SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN 'city' WHEN 1 THEN 'regency' ELSE 'unknown' END AS kind FROM supplier",
    "parse_level": "SELECT p_partkey, try_cast(regexp_extract(p_brand, '[0-9]+') AS INTEGER) AS brand_level, try_cast(regexp_extract(p_name, '[0-9]+') AS INTEGER) AS name_level FROM part",
    "normalize_road": f"""SELECT p_partkey, {_road("'Jl. Raya ' || p_name")} AS road, {_road("'Gang Komplek ' || p_type")} AS lane FROM part""",
    "index_tokens": f"SELECT doc_id, array_to_string({_tokens(_norm('text'))}, ' ') AS tokens FROM documents",
    "candidate_phrases": _PHRASES,
    "token_index": f"SELECT DISTINCT unnest({_tokens('road_name')}) AS token, road_name FROM ({NAMES})",
    "token_overlap_join": OVERLAPS,
    "overlap_gate": f"""WITH o AS (SELECT *, overlap >= CASE WHEN len({_tokens('query')}) <= 1 THEN 1 ELSE 2 END AS ok FROM ({OVERLAPS})), f AS (SELECT *, bool_or(ok) OVER (PARTITION BY query) AS found, row_number() OVER (PARTITION BY query ORDER BY overlap DESC, road_name) AS rn FROM o)
SELECT query, road_name, overlap FROM f WHERE CASE WHEN found THEN ok ELSE rn <= 100 END""",
    "topn_candidates": f"SELECT query, road_name, overlap FROM ({OVERLAPS}) QUALIFY row_number() OVER (PARTITION BY query ORDER BY overlap DESC, road_name) <= 3",
    "token_similarity": f"SELECT query, road_name, {_overlap('query', 'road_name')} AS score FROM ({PAIRS})",
    "containment_score": f"""SELECT query, road_name, CASE WHEN query = '' OR road_name = '' THEN 0.0::DOUBLE WHEN replace(query, ' ', '') = replace(road_name, ' ', '') THEN 1.0::DOUBLE
WHEN contains(replace(query, ' ', ''), replace(road_name, ' ', '')) OR contains(replace(road_name, ' ', ''), replace(query, ' ', '')) THEN 0.98::DOUBLE END AS score FROM (SELECT CASE WHEN query < road_name THEN query || ' ' || road_name ELSE query END AS query, road_name FROM ({PAIRS}))""",
    "best_with_margin": f"SELECT query, road_name, score, runner_up, accepted FROM ({_best('0.3', '0.05')})",
    "first_acceptable": f"""WITH t AS (SELECT p_brand, p_size, road_name, row_number() OVER w AS rank, sum(p_size) OVER (w ROWS UNBOUNDED PRECEDING) AS upto FROM (SELECT DISTINCT p_brand, p_size, {_road('p_name')} AS road_name FROM part) WINDOW w AS (PARTITION BY p_brand ORDER BY p_size, road_name)),
h AS (SELECT * FROM t WHERE p_size >= 10 QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY rank) = 1)
SELECT a.p_brand, h.rank IS NOT NULL AS matched, h.rank::INTEGER AS rank, 'JL ' || h.road_name AS candidate_phrase, h.road_name, h.p_size / 50.0::DOUBLE AS score, coalesce(h.upto + 2, a.total)::BIGINT AS candidate_count
FROM (SELECT p_brand, sum(p_size) AS total FROM t GROUP BY p_brand) a LEFT JOIN h ON a.p_brand = h.p_brand""",
    "province_routing": "SELECT c_custkey, r_name AS province_key, CASE WHEN r_name IN ('AMERICA', 'EUROPE') THEN 'west' WHEN r_name IN ('ASIA', 'MIDDLE EAST') THEN 'east' ELSE 'other' END AS island FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey",
    "bbox_rollup": f"SELECT r_name, n_name, c_mktsegment, min(minx) AS minx, min(miny) AS miny, max(maxx) AS maxx, max(maxy) AS maxy, (3 - grouping(r_name) - grouping(n_name) - grouping(c_mktsegment))::INTEGER AS level FROM ({BOXES}) GROUP BY ROLLUP (r_name, n_name, c_mktsegment)",
    "key_cascade": f"""WITH b AS ({BOXES}), u AS (SELECT * FROM b WHERE c_mktsegment <> 'BUILDING' AND n_name <> 'NATION_3'), k3 AS (SELECT r_name, n_name, c_mktsegment, max(maxx) AS m FROM u GROUP BY ALL), k2 AS (SELECT r_name, n_name, max(maxx) AS m FROM u GROUP BY ALL), k1 AS (SELECT r_name, max(maxx) AS m FROM u GROUP BY ALL)
SELECT c_custkey, coalesce(k3.m, k2.m, k1.m) AS "right", CASE WHEN k3.m IS NOT NULL THEN 3 WHEN k2.m IS NOT NULL THEN 2 WHEN k1.m IS NOT NULL THEN 1 END AS level_used FROM b LEFT JOIN k3 USING (r_name, n_name, c_mktsegment) LEFT JOIN k2 USING (r_name, n_name) LEFT JOIN k1 USING (r_name)""",
    "name_resolution": """WITH n AS (SELECT n_nationkey, n_regionkey AS parent, replace(n_name, '_', ' NO') AS child FROM nation),
a AS (SELECT n_nationkey, parent, CASE n_nationkey % 4 WHEN 0 THEN child WHEN 1 THEN replace(child, ' ', '') WHEN 2 THEN 'GREATER ' || child ELSE 'ELSEWHERE' END AS wanted FROM n),
q AS (SELECT a.n_nationkey, wanted, max(child) FILTER (child = wanted) AS exact, count(*) FILTER (replace(child, ' ', '') = replace(wanted, ' ', '')) AS n_same, min(child) FILTER (replace(child, ' ', '') = replace(wanted, ' ', '')) AS same,
count(*) FILTER (contains(replace(wanted, ' ', ''), replace(child, ' ', '')) OR contains(replace(child, ' ', ''), replace(wanted, ' ', ''))) AS n_held, min(child) FILTER (contains(replace(wanted, ' ', ''), replace(child, ' ', '')) OR contains(replace(child, ' ', ''), replace(wanted, ' ', ''))) AS held FROM a JOIN n ON a.parent = n.parent GROUP BY ALL)
SELECT n_nationkey, wanted, CASE WHEN exact IS NOT NULL THEN exact WHEN n_same = 1 THEN same WHEN n_held = 1 THEN held END AS found, CASE WHEN exact IS NOT NULL THEN 'exact' WHEN n_same = 1 THEN 'compact' WHEN n_held = 1 THEN 'contained' END AS stage FROM q""",
    "hierarchy_paths": """WITH c AS (SELECT n_regionkey AS id, n_nationkey AS kabkota, n_nationkey * 7 % 11 AS area FROM nation), d AS (SELECT id, kabkota, s_suppkey AS kecamatan FROM c JOIN supplier ON kabkota = s_nationkey WHERE s_suppkey % 3 = 0),
v AS (SELECT id, kecamatan, c_custkey AS kelurahan FROM d JOIN customer ON kabkota = c_nationkey WHERE c_custkey % 40 = 1 AND (c_custkey + kecamatan) % 2 = 0),
p AS (SELECT c.id, c.id AS province, c.kabkota, d.kecamatan, v.kelurahan, area FROM c LEFT JOIN d ON c.id = d.id AND c.kabkota = d.kabkota LEFT JOIN v ON d.id = v.id AND d.kecamatan = v.kecamatan)
SELECT id, province, kabkota, kecamatan, kelurahan, row_number() OVER (PARTITION BY id ORDER BY kelurahan IS NULL, kecamatan IS NULL, area, province, kabkota, kecamatan NULLS LAST, kelurahan NULLS LAST)::INTEGER AS path_rank FROM p""",
    "first_name_per_group": "SELECT c_nationkey, arg_min(c_name, c_custkey) AS c_name FROM customer GROUP BY c_nationkey",
    "bbox_range_join": f"""SELECT c_custkey, s_suppkey FROM ({BOXES}) b JOIN (SELECT s_suppkey, (s_suppkey * 13 % 97)::DOUBLE AS x, (s_suppkey * 17 % 89)::DOUBLE AS y FROM supplier) s ON b.minx <= x + 6 AND b.maxx >= x AND b.miny <= y + 4 AND b.maxy >= y""",
    "polyline_length": f"SELECT user_id, round(sum(length), 6) AS length, count(*)::BIGINT AS n FROM ({SEGMENTS}) GROUP BY user_id",
    "clip_to_box": f"""WITH t AS (SELECT user_id, length, greatest((5.0::DOUBLE - x1) / (x2 - x1), CASE WHEN y2 = y1 THEN CASE WHEN y1 BETWEEN 4 AND 20 THEN 0.0 ELSE 2.0 END ELSE least((4.0::DOUBLE - y1) / (y2 - y1), (20.0::DOUBLE - y1) / (y2 - y1)) END, 0.0) AS t0,
least((60.5::DOUBLE - x1) / (x2 - x1), CASE WHEN y2 = y1 THEN CASE WHEN y1 BETWEEN 4 AND 20 THEN 1.0 ELSE -1.0 END ELSE greatest((4.0::DOUBLE - y1) / (y2 - y1), (20.0::DOUBLE - y1) / (y2 - y1)) END, 1.0) AS t1 FROM ({SEGMENTS}))
SELECT user_id, count(*)::BIGINT AS n, round(sum(length * (t1 - t0)), 6) AS length FROM t WHERE t0 < t1 GROUP BY user_id""",
    "midpoint_on_line": _point("0.5::DOUBLE"),
    "weighted_sample_points": _point("('0x' || substr(sha256('20260507|kelurahan/desa|' || user_id), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE"),
    "fallback_levels": """WITH t AS (SELECT c_custkey, unnest([0, 1, 2])::INTEGER AS level, unnest([CASE WHEN c_custkey % 3 = 0 THEN c_name END, CASE WHEN c_custkey % 2 = 0 THEN n_name END, CASE WHEN c_custkey % 5 > 0 THEN 'REGION' END]) AS place FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT c_custkey, level, place FROM t WHERE place IS NOT NULL QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY level) = 1""",
    "unresolved_split": f"SELECT query AS name, 'unresolved' AS status, road_name AS matched_road_name, score AS match_score FROM ({_best('0.3', '0.05')}) WHERE NOT accepted",
    "resume_antijoin": "SELECT o_orderkey AS source_row, o_orderstatus FROM orders WHERE NOT (o_orderkey % 6 = 0 OR o_orderstatus = 'P')",
    "union_provenance": "SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus <> 'F' THEN o_totalprice END AS o_totalprice, CASE o_orderstatus WHEN 'O' THEN 0 WHEN 'F' THEN 1 ELSE 2 END AS source_rank, CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'filled' ELSE 'pending' END AS source_workbook FROM orders WHERE o_orderstatus IN ('O', 'F', 'P')",
    "relaxed_retry": f"""WITH a AS ({_best('0.4', '0.1')}), b AS ({_best('0.3', '0.0')})
SELECT a.query, CASE WHEN a.accepted OR b.accepted THEN length(a.query)::DOUBLE END AS latitude, CASE WHEN a.accepted OR b.accepted THEN length(a.query)::DOUBLE END AS longitude,
CASE WHEN a.accepted THEN 'already_matched' WHEN b.accepted THEN 'fuzzy_matched' ELSE 'still_unresolved' END AS retry_status, CASE WHEN a.accepted THEN 'existing_output' WHEN b.accepted THEN 'matched' ELSE 'road_candidate_not_matched' END AS retry_reason,
CASE WHEN NOT a.accepted THEN b.query END AS retry_candidate_phrase, CASE WHEN NOT a.accepted THEN b.road_name END AS retry_matched_road_name, CASE WHEN NOT a.accepted THEN b.score END AS retry_match_score FROM a JOIN b ON a.query = b.query""",
    "progress_counts": "SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS matched, count(*) FILTER (o_orderstatus <> 'F') AS unresolved FROM orders GROUP BY o_orderpriority",
    "page_links": f"""SELECT page_id, {_page('url')} AS page_number, len(regexp_extract_all(html, '{_HREF}', 1))::INTEGER AS n_links, coalesce(list_max(list_transform(regexp_extract_all(html, '{_HREF}', 1), lambda h: {_page('h')})), 1)::BIGINT AS last_page FROM pages""",
    "html_table_rows": "SELECT event_id AS page_id, 1::BIGINT AS row, event_id::VARCHAR AS cell_0, user_id::VARCHAR AS cell_1, event_type AS cell_2, props AS cell_4 FROM events",
    "numeric_coerce": "SELECT p_partkey, try_cast(string_split(p_brand, '#')[-1] AS BIGINT) AS brand_number, try_cast(p_name AS BIGINT) AS name_number, p_size::BIGINT AS size_number FROM part",
    "set_ops_tokens": f"WITH d AS (SELECT doc_id, list_distinct({_tokens(_norm('text'))}) AS tokens FROM documents) SELECT a.doc_id, len(list_intersect(a.tokens, b.tokens))::INTEGER AS common FROM d a JOIN d b ON b.doc_id = a.doc_id + 1",
}
