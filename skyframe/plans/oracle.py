"""DuckDB statements that compute the same result as each registered query,
written independently of the Spark code from the operator semantics.

The shared tables are views of the same names.  Float results are rounded
inside both queries; integer sums are cast to BIGINT (DuckDB widens them to
HUGEINT).
"""

from __future__ import annotations

from skyframe.operators.logs import APACHE_LOG_PATTERN as LOG_PATTERN

ORACLE: dict[str, str] = {}

ORIGIN = "NATION_3"
TRANSIT = "NATION_7"
DEST = "NATION_11"

# Flights adapter (see plans/adapters.py), written as SQL.
FLIGHTS = """
flights AS (
  SELECT year(l.l_shipdate) AS year,
         CAST(l.l_shipdate AS DATE) AS flt_date,
         lpad(CAST(((l.l_orderkey*37 + l.l_linenumber*101) % 1440) // 60 * 100
                   + ((l.l_orderkey*37 + l.l_linenumber*101) % 1440) % 60 AS VARCHAR), 4, '0') AS dep_time,
         p.p_brand AS carrier,
         CAST(l.l_partkey AS VARCHAR) AS flt_num,
         ns.n_name AS origin,
         nc.n_name AS dest,
         CAST(l.l_quantity - 25 AS FLOAT) AS dep_delay,
         CAST(CASE WHEN l.l_linenumber = 7 THEN NULL ELSE l.l_quantity - 20.25 END AS FLOAT) AS arr_delay,
         CAST(CASE WHEN l.l_returnflag = 'R' THEN 1.0 ELSE 0.0 END AS FLOAT) AS cancelled
  FROM lineitem l
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation ns ON s.s_nationkey = ns.n_nationkey
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation nc ON c.c_nationkey = nc.n_nationkey
)"""

# delay text -> int cut towards zero, blank -> 0
ARR = "COALESCE(CAST(trunc(arr_delay) AS INTEGER), 0)"
DEP = "COALESCE(CAST(trunc(dep_delay) AS INTEGER), 0)"


def mean(expr: str) -> str:
    return f"CAST(CAST(SUM({expr}) AS DOUBLE) / COUNT(*) AS FLOAT)"


ORACLE["air01_top_airports"] = f"""
WITH {FLIGHTS},
a AS (SELECT origin AS airport FROM flights UNION ALL SELECT dest FROM flights)
SELECT airport, COUNT(*) AS flights FROM a GROUP BY airport
ORDER BY flights DESC, airport LIMIT 10"""

ORACLE["air02_carriers_by_arr_delay"] = f"""
WITH {FLIGHTS}
SELECT carrier, {mean(ARR)} AS mean_arr_delay FROM flights
WHERE COALESCE(cancelled, 0) <> 1
GROUP BY carrier ORDER BY mean_arr_delay, carrier LIMIT 10"""

ORACLE["air02_as_coded"] = f"""
WITH {FLIGHTS}
SELECT carrier, {mean(ARR)} AS mean_arr_delay FROM flights
GROUP BY carrier ORDER BY mean_arr_delay, carrier LIMIT 10"""

ORACLE["air03_dests_by_dep_delay"] = f"""
WITH {FLIGHTS}
SELECT origin, dest, {mean(DEP)} AS mean_dep_delay FROM flights
WHERE origin = '{ORIGIN}'
GROUP BY origin, dest ORDER BY mean_dep_delay, dest LIMIT 10"""

ORACLE["air04_carriers_on_route"] = f"""
WITH {FLIGHTS}
SELECT origin, dest, carrier, {mean(ARR)} AS mean_arr_delay FROM flights
WHERE origin = '{ORIGIN}' AND dest = '{DEST}'
GROUP BY origin, dest, carrier ORDER BY mean_arr_delay, carrier LIMIT 10"""

ORACLE["air05_route_delay"] = f"""
WITH {FLIGHTS}
SELECT origin, dest, {mean(ARR)} AS mean_arr_delay FROM flights
WHERE origin = '{ORIGIN}' AND dest = '{DEST}'
GROUP BY origin, dest"""

ORACLE["air06_itinerary"] = f"""
WITH {FLIGHTS},
legs AS (
  SELECT 1 AS leg, flt_date AS start_date, * FROM flights
  WHERE origin = '{ORIGIN}' AND dest = '{TRANSIT}' AND CAST(dep_time AS INTEGER) < 1200
  UNION ALL
  SELECT 2 AS leg, CAST(flt_date - INTERVAL 2 DAY AS DATE) AS start_date, * FROM flights
  WHERE origin = '{TRANSIT}' AND dest = '{DEST}' AND CAST(dep_time AS INTEGER) > 1200
),
per_flight AS (
  SELECT leg, start_date, origin, dest, flt_date, carrier, flt_num,
         {mean(ARR)} AS mean_arr_delay, MIN(dep_time) AS dep_time
  FROM legs GROUP BY leg, start_date, origin, dest, flt_date, carrier, flt_num
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY leg, start_date
                               ORDER BY mean_arr_delay, carrier, flt_num) AS rn
  FROM per_flight
)
SELECT leg, start_date, mean_arr_delay, carrier, flt_num, origin, dest, flt_date, dep_time
FROM ranked WHERE rn = 1"""

ORACLE["air08_daily_delay"] = f"""
WITH {FLIGHTS}
SELECT flt_date, round(AVG(dep_delay), 6) AS avg_dep_delay, round(AVG(arr_delay), 6) AS avg_arr_delay
FROM flights WHERE dest = '{DEST}' GROUP BY flt_date"""


# ---------------------------------------------------------------- adapters as SQL
DOC_LINES = "doc_lines AS (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)"
DOC_WORDS = (DOC_LINES + ", doc_words AS (SELECT unnest(string_split(line, ' ')) AS word FROM doc_lines)")

PAGE_VIEWS = """page_views AS (
  SELECT event_type AS url, CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status,
         CAST(user_id % 10 AS INTEGER) AS zip, user_id, ts FROM events)"""

LOG_LINES = """log_lines AS (
  SELECT CASE WHEN event_type = 'error' THEN 'malformed ' || CAST(event_id AS VARCHAR) ELSE
    '10.0.' || CAST((user_id // 256) % 256 AS VARCHAR) || '.' || CAST(user_id % 256 AS VARCHAR) || ' - ' ||
    CASE WHEN event_type = 'signup' THEN '-' WHEN event_type = 'view' THEN '"-"'
         ELSE '"u' || CAST(user_id AS VARCHAR) || '"' END ||
    ' [' || strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' +0000] "GET /' || event_type || '?v=' ||
    CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) || ' HTTP/1.1" 200 ' ||
    CASE WHEN value < 1 THEN '-' ELSE CAST(CAST(floor(value * 100) AS BIGINT) AS VARCHAR) END ||
    ' "http://ref.example/" "agent/1.0" extra' END AS line
  FROM events)"""


def _re(i: int) -> str:
    return f"regexp_extract(line, '{LOG_PATTERN}', {i})"


ORACLE["src04_json_props"] = """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events"""
ORACLE["src05_parquet_scan"] = "SELECT COUNT(*) AS row_count, round(SUM(o_totalprice), 2) AS total FROM orders"
ORACLE["src07_sql_on_file"] = "SELECT * FROM region"
ORACLE["src08_generic_load"] = "SELECT n_nationkey, n_name FROM nation"
ORACLE["prj01_project"] = "SELECT c_custkey, c_name FROM customer"
ORACLE["prj02_add_const"] = "SELECT n_nationkey, n_nationkey + 1 AS next_key FROM nation"
ORACLE["prj04_format_rows"] = "SELECT printf('Key: %d, Value: %s', n_nationkey, n_name) AS line FROM nation"
ORACLE["prj05_row_map"] = """
SELECT CAST(json_object('n_name', n_name, 'n_nationkey', n_nationkey) AS VARCHAR) AS values_map FROM nation"""
ORACLE["prj06_unpivot_pair"] = """
SELECT l_partkey AS key FROM lineitem UNION ALL SELECT l_suppkey FROM lineitem"""
ORACLE["prj07_cast"] = """
SELECT CAST(c_custkey AS DOUBLE) AS c_custkey, TRY_CAST(c_name AS INTEGER) AS c_name,
       CAST(c_nationkey AS VARCHAR) AS c_nationkey FROM customer"""
ORACLE["prj08_rename"] = "SELECT r_regionkey, r_name AS name FROM region"
ORACLE["prj09_with_index"] = "SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS row_idx FROM documents"
ORACLE["flt01_filter_gt"] = "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity > 45"
ORACLE["flt02_filter_eq"] = "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'"
ORACLE["flt03_filter_between"] = """
SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal BETWEEN 1000 AND 2000"""
ORACLE["flt04_grep_count"] = f"""
WITH {DOC_LINES} SELECT COUNT(*) AS matches FROM doc_lines WHERE contains(line, 'the')"""
ORACLE["flt05_nonempty"] = f"""
WITH {DOC_WORDS} SELECT COUNT(*) AS tokens FROM doc_words WHERE length(word) > 0"""
ORACLE["flt06_drop_listed"] = f"""
WITH {DOC_WORDS} SELECT word, COUNT(*) AS count FROM doc_words
WHERE length(word) > 0 AND word NOT IN ('a', 'b', 'c') GROUP BY word"""
ORACLE["flt06_dropped_count"] = f"""
WITH {DOC_WORDS} SELECT COUNT(*) AS dropped FROM doc_words WHERE word IN ('a', 'b', 'c')"""
ORACLE["cat01_view_sql"] = "SELECT l_returnflag, COUNT(*) AS n FROM lineitem GROUP BY l_returnflag"
ORACLE["cat06_describe_shape"] = """
SELECT 6 AS column_count, COUNT(*) AS row_count,
       'o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate,o_orderpriority' AS columns FROM orders"""
ORACLE["joi01_join_inner"] = """
SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey"""
ORACLE["joi03_join_left_default"] = """
SELECT c_custkey, COALESCE(n, 0) AS n_orders FROM customer
LEFT JOIN (SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY o_custkey) ON c_custkey = o_custkey"""
ORACLE["joi07_lookup"] = "SELECT s_suppkey, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey"
ORACLE["joi08_two_key_join"] = """
SELECT l_orderkey, l_partkey, SUM(l_quantity) AS qty, round(SUM(l_extendedprice), 2) AS price
FROM lineitem GROUP BY l_orderkey, l_partkey"""
ORACLE["agg01_group_count"] = "SELECT c_mktsegment, COUNT(*) AS count FROM customer GROUP BY c_mktsegment"
ORACLE["agg02_count"] = "SELECT COUNT(*) AS count FROM lineitem"
ORACLE["agg03_group_avg"] = """
SELECT CAST(l_shipdate AS DATE) AS ship_date, round(AVG(l_quantity), 6) AS avg_l_quantity,
       round(AVG(l_discount), 6) AS avg_l_discount FROM lineitem GROUP BY 1"""
ORACLE["agg04_word_count"] = f"""
WITH {DOC_WORDS} SELECT word, COUNT(*) AS count FROM doc_words WHERE length(word) > 0 GROUP BY word"""
ORACLE["agg05_sum_by_key"] = "SELECT l_suppkey, SUM(l_quantity) AS total_qty FROM lineitem GROUP BY l_suppkey"
ORACLE["agg06_distinct_count"] = "SELECT COUNT(DISTINCT o_custkey) AS distinct_count FROM orders"
ORACLE["agg07_salted_group_count"] = "SELECT user_id, COUNT(*) AS count FROM events GROUP BY user_id"
ORACLE["agg09_log_stats"] = f"""
WITH {LOG_LINES},
parsed AS (
  SELECT regexp_matches(line, '{LOG_PATTERN}') AS ok, {_re(1)} AS ip, {_re(3)} AS u, {_re(5)} AS q,
         TRY_CAST({_re(7)} AS INTEGER) AS b FROM log_lines),
keyed AS (
  SELECT CASE WHEN ok AND u NOT IN ('-', '"-"') THEN ip END AS ip,
         CASE WHEN ok AND u NOT IN ('-', '"-"') THEN u END AS "user",
         CASE WHEN ok AND u NOT IN ('-', '"-"') THEN q END AS query,
         CASE WHEN ok THEN COALESCE(b, 0) ELSE 0 END AS bytes FROM parsed)
SELECT ip, "user", query, COUNT(*) AS count, CAST(SUM(bytes) AS BIGINT) AS bytes
FROM keyed GROUP BY ip, "user", query"""
ORACLE["agg12_error_rate"] = f"""
WITH {PAGE_VIEWS},
a AS (SELECT zip, COUNT(*) AS n, CAST(SUM(CASE WHEN status <> 200 THEN 1 ELSE 0 END) AS BIGINT) AS errors
      FROM page_views GROUP BY zip)
SELECT zip, n, errors, errors / n AS error_rate,
       CASE WHEN errors / n > 0.05 THEN printf('**%.4f**', errors / n) ELSE printf('%.4f', errors / n) END AS flag
FROM a"""
ORACLE["agg13_value_counts"] = """
SELECT l_returnflag, COUNT(*) AS count, round(COUNT(*) / (SELECT COUNT(*) FROM lineitem), 6) AS fraction
FROM lineitem GROUP BY l_returnflag"""
ORACLE["agg14_reduce_sum"] = "SELECT round(SUM(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem"
ORACLE["agg16_collect_per_key"] = """
SELECT l_orderkey, list_sort(list(l_partkey)) AS parts FROM lineitem GROUP BY l_orderkey"""
ORACLE["srt01_order"] = "SELECT n_name FROM nation ORDER BY n_name DESC"
ORACLE["srt02_sort_numbers"] = """
SELECT CAST(x AS BIGINT) AS number FROM
  (SELECT unnest(string_split(CAST(o_orderkey AS VARCHAR) || ' ' || CAST(o_custkey AS VARCHAR), ' ')) AS x
   FROM orders) ORDER BY number"""
ORACLE["srt03_top_k"] = """
SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 10"""
ORACLE["srt04_top_k_per"] = """
SELECT * FROM (
  SELECT l_suppkey, l_orderkey, l_linenumber, l_extendedprice,
         CAST(row_number() OVER (PARTITION BY l_suppkey
                                 ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS INTEGER) AS rank
  FROM lineitem) WHERE rank <= 3"""
ORACLE["srt06_head"] = "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 5"
ORACLE["set01_union_all"] = "SELECT r_name AS name FROM region UNION ALL SELECT n_name FROM nation"
ORACLE["set02_distinct"] = "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem"
ORACLE["smp05_by_key_exact"] = """
SELECT o_orderstatus, CAST(ceil(f * COUNT(*)) AS BIGINT) AS sampled, CAST(ceil(f * COUNT(*)) AS BIGINT) AS distinct_keys
FROM (SELECT o_orderstatus, CASE o_orderstatus WHEN 'F' THEN 0.1 WHEN 'O' THEN 0.2 WHEN 'P' THEN 0.5 END AS f
      FROM orders) GROUP BY o_orderstatus, f"""


# ---------------------------------------------------------------- streaming (stream result == batch SQL)
WORD_COUNTS = f"""WITH {DOC_WORDS}
SELECT word, COUNT(*) AS count FROM doc_words WHERE length(word) > 0 GROUP BY word"""


def _windows(src: str, win_min: int = 60, slide_min: int = 15) -> str:
    k = win_min // slide_min
    return f"""(SELECT *, time_bucket(INTERVAL {slide_min} MINUTE, ts) - k * INTERVAL {slide_min} MINUTE AS window_start
  FROM {src}, range(0, {k}) t(k))"""


ORACLE["str01_batch_word_count"] = WORD_COUNTS
ORACLE["str02_running_word_count"] = WORD_COUNTS
ORACLE["str09_sql_per_batch"] = WORD_COUNTS
ORACLE["str03_windowed_count"] = f"""
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, event_type, COUNT(*) AS count
FROM {_windows('events')} GROUP BY window_start, event_type"""
ORACLE["str05_seeded_running_sum"] = f"""WITH {DOC_WORDS}
SELECT word, COUNT(*) + CASE WHEN word IN ('hello', 'world') THEN 1 ELSE 0 END AS total
FROM doc_words WHERE length(word) > 0 GROUP BY word"""
ORACLE["str06_update_state"] = "SELECT user_id, round(SUM(value), 6) AS total FROM events GROUP BY user_id"
ORACLE["str08_sessions"] = """
WITH e AS (
  SELECT user_id, ts,
         CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL
                OR ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) >= INTERVAL 30 MINUTE
              THEN 1 ELSE 0 END AS brk
  FROM events),
s AS (SELECT *, SUM(brk) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM e)
SELECT user_id, MIN(ts) AS start, MAX(ts) + INTERVAL 30 MINUTE AS "end", COUNT(*) AS num_events,
       CAST((epoch_us(MAX(ts) + INTERVAL 30 MINUTE) - epoch_us(MIN(ts))) // 1000 AS BIGINT) AS duration_ms
FROM s GROUP BY user_id, sid"""
ORACLE["str11_page_counts_windowed"] = f"""WITH {PAGE_VIEWS}
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, url, COUNT(*) AS views
FROM {_windows('page_views')} GROUP BY window_start, url"""
ORACLE["str12_error_rate_windowed"] = f"""WITH {PAGE_VIEWS}
SELECT window_start, zip, COUNT(*) AS n, CAST(SUM(CASE WHEN status <> 200 THEN 1 ELSE 0 END) AS BIGINT) AS errors,
       round(SUM(CASE WHEN status <> 200 THEN 1 ELSE 0 END) / COUNT(*), 6) AS error_rate
FROM {_windows('page_views')} GROUP BY window_start, zip"""
ORACLE["str13_active_users_batch"] = f"""WITH {PAGE_VIEWS}
SELECT window_start, COUNT(DISTINCT user_id) AS active_users FROM {_windows('page_views')} GROUP BY window_start"""
ORACLE["str14_users_seen"] = """
SELECT user_id, c_name AS name, COUNT(*) AS events FROM events JOIN customer ON user_id = c_custkey
GROUP BY user_id, c_name ORDER BY user_id LIMIT 10"""
ORACLE["str15_happiest_words"] = f"""WITH {DOC_WORDS},
wc AS (SELECT word, COUNT(*) AS count FROM doc_words WHERE length(word) > 0 GROUP BY word),
bw AS (SELECT unnest(string_split(text, ' ')) AS word FROM benchmark),
sent AS (SELECT word, CAST(COUNT(*) AS DOUBLE) AS score FROM bw WHERE length(word) > 0 GROUP BY word)
SELECT word, score * count AS happiness FROM wc JOIN sent USING (word)
ORDER BY happiness DESC, word LIMIT 5"""
ORACLE["str16_batch_count"] = "SELECT COUNT(*) AS events FROM events"
ORACLE["air07_stream_carriers"] = ORACLE["air02_carriers_by_arr_delay"]
ORACLE["air07_stream_airports"] = ORACLE["air01_top_airports"]


# ---------------------------------------------------------------- graph
PART_CHAIN = """pc AS (
  SELECT a.l_partkey AS src, b.l_partkey AS dst, b.l_quantity AS weight
  FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber + 1 = b.l_linenumber
  WHERE a.l_partkey <> b.l_partkey)"""
NATION_TRADE = """ne AS (
  SELECT DISTINCT CAST(s.s_nationkey AS BIGINT) AS src, CAST(c.c_nationkey AS BIGINT) AS dst
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey)"""


def _pagerank_sql(naive: bool, iters: int = 10) -> str:
    parts = [PART_CHAIN]
    if naive:
        parts.append("lk AS (SELECT DISTINCT src, dst FROM pc)")
    else:
        parts.append("lk AS (SELECT src, dst FROM pc)")
        parts.append("verts AS (SELECT src AS id FROM pc UNION SELECT dst FROM pc)")
    parts.append("deg AS (SELECT src, COUNT(*) AS deg FROM lk GROUP BY src)")
    parts.append("l AS (SELECT lk.src, lk.dst, deg.deg FROM lk JOIN deg USING (src))")
    if naive:
        parts.append("r0 AS (SELECT DISTINCT src AS id, CAST(1.0 AS DOUBLE) AS rank FROM lk)")
    else:
        parts.append("r0 AS (SELECT id, CAST(1.0 AS DOUBLE) AS rank FROM verts)")
    for i in range(1, iters + 1):
        if naive:
            parts.append(f"r{i} AS (SELECT l.dst AS id, 0.15 + 0.85 * SUM(rank / deg) AS rank "
                         f"FROM l JOIN r{i-1} ON l.src = r{i-1}.id GROUP BY l.dst)")
        else:
            parts.append(f"c{i} AS (SELECT l.dst, SUM(rank / deg) AS s FROM l JOIN r{i-1} ON l.src = r{i-1}.id "
                         f"GROUP BY l.dst), r{i} AS (SELECT id, 0.15 + 0.85 * COALESCE(s, 0.0) AS rank "
                         f"FROM verts LEFT JOIN c{i} ON verts.id = c{i}.dst)")
    return "WITH " + ",\n".join(parts) + f"\nSELECT id, round(rank, 6) AS rank FROM r{iters}"


ORACLE["grf01_pagerank_naive"] = _pagerank_sql(True)
ORACLE["grf02_pagerank"] = _pagerank_sql(False)
# min-label propagation with a keyed recursive CTE: each round only the
# vertices whose label dropped send it on
ORACLE["grf04_connected_components"] = f"""
WITH RECURSIVE {PART_CHAIN},
und AS (SELECT DISTINCT src, dst FROM (SELECT src, dst FROM pc UNION ALL SELECT dst, src FROM pc)),
verts AS (SELECT src AS id FROM pc UNION SELECT dst FROM pc),
lab(id, label) USING KEY (id) AS (
  SELECT id, id FROM verts
  UNION
  SELECT u.dst, MIN(l.label) FROM lab l JOIN und u ON l.id = u.src GROUP BY u.dst
  HAVING MIN(l.label) < (SELECT r.label FROM recurring.lab r WHERE r.id = u.dst))
SELECT id, label FROM lab"""
ORACLE["grf05_triangles"] = f"""
WITH {PART_CHAIN},
c AS (SELECT DISTINCT least(src, dst) AS a, greatest(src, dst) AS b FROM pc WHERE src <> dst),
t AS (SELECT x.a, x.b, y.b AS c FROM c x JOIN c y ON x.b = y.a JOIN c z ON z.a = x.a AND z.b = y.b),
verts AS (SELECT a AS id FROM c UNION SELECT b FROM c),
per AS (SELECT id, COUNT(*) AS n FROM (SELECT a AS id FROM t UNION ALL SELECT b FROM t UNION ALL SELECT c FROM t)
        GROUP BY id)
SELECT verts.id, CAST(COALESCE(n, 0) AS BIGINT) AS triangles FROM verts LEFT JOIN per USING (id)"""
ORACLE["grf06_sssp"] = f"""
WITH RECURSIVE {PART_CHAIN},
verts AS (SELECT src AS id FROM pc UNION SELECT dst FROM pc),
dist(id, d) USING KEY (id) AS (
  SELECT MIN(src), CAST(0.0 AS DOUBLE) FROM pc
  UNION
  SELECT e.dst, MIN(x.d + e.weight) FROM dist x JOIN pc e ON x.id = e.src GROUP BY e.dst
  HAVING MIN(x.d + e.weight) < COALESCE((SELECT r.d FROM recurring.dist r WHERE r.id = e.dst),
                                         CAST('inf' AS DOUBLE)))
SELECT verts.id, COALESCE(dist.d, CAST('inf' AS DOUBLE)) AS distance FROM verts LEFT JOIN dist USING (id)"""
ORACLE["grf07_neighbour_mean"] = f"""
WITH {PART_CHAIN}
SELECT pc.dst AS id, COUNT(*) AS senders, round(AVG(a.p_retailprice), 6) AS mean_attr
FROM pc JOIN part a ON pc.src = a.p_partkey JOIN part b ON pc.dst = b.p_partkey
WHERE a.p_retailprice > b.p_retailprice GROUP BY pc.dst"""
ORACLE["grf08_transitive_closure"] = f"""
WITH RECURSIVE {NATION_TRADE},
tc(src, dst) AS (SELECT src, dst FROM ne UNION SELECT tc.src, ne.dst FROM tc JOIN ne ON tc.dst = ne.src)
SELECT src, dst FROM tc"""
ORACLE["grf09_degree_hist"] = f"""
WITH {PART_CHAIN},
ends AS (SELECT src AS id FROM pc UNION ALL SELECT dst FROM pc),
d AS (SELECT p_partkey AS id, COALESCE(n, 0) AS degree FROM part
      LEFT JOIN (SELECT id, COUNT(*) AS n FROM ends GROUP BY id) e ON p_partkey = e.id)
SELECT degree, COUNT(*) AS vertices FROM d GROUP BY degree"""
ORACLE["grf10_subgraph"] = f"""
WITH {PART_CHAIN}
SELECT src, dst, weight FROM pc
WHERE src IN (SELECT p_partkey FROM part WHERE p_size > 25) AND dst IN (SELECT p_partkey FROM part WHERE p_size > 25)"""


# ---------------------------------------------------------------- features
def _token_counts(tokens_sql: str, name: str = "token") -> str:
    return f"""SELECT {name}, COUNT(*) AS count FROM (SELECT unnest(t) AS {name} FROM ({tokens_sql}))
WHERE length({name}) > 0 GROUP BY {name}"""


REGEX_TOKENS = r"SELECT doc_id, regexp_split_to_array(lower(text), '\W') AS t0 FROM documents"
REGEX_TOKENS_NE = f"SELECT doc_id, list_filter(t0, lambda x: length(x) >= 1) AS t FROM ({REGEX_TOKENS})"
STOP = "('the', 'and', 'of', 'a', 'le', 'la', 'de', 'der', 'die', 'und')"


def _li_arr(expr: str) -> str:
    return f"SELECT l_orderkey, l_linenumber, {expr} FROM lineitem"


ORACLE["prj03_sql_transform"] = """
SELECT l_orderkey, l_linenumber, round(l_quantity + l_discount, 6) AS v3, round(l_quantity * l_discount, 6) AS v4
FROM lineitem"""
ORACLE["fea01_tokenize"] = _token_counts(r"SELECT regexp_split_to_array(lower(text), '\s') AS t FROM documents")
ORACLE["fea02_regex_tokenize"] = _token_counts(REGEX_TOKENS_NE)
ORACLE["fea03_remove_stopwords"] = _token_counts(
    f"SELECT list_filter(t, lambda x: x NOT IN {STOP}) AS t FROM ({REGEX_TOKENS_NE})")
ORACLE["fea04_ngrams"] = _token_counts(
    f"SELECT list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]) AS t FROM ({REGEX_TOKENS_NE})",
    "ngram")
ORACLE["fea06_idf_terms"] = f"""
WITH tok AS ({REGEX_TOKENS_NE}),
df AS (SELECT term, COUNT(*) AS doc_freq FROM (SELECT DISTINCT doc_id, unnest(t) AS term FROM tok) GROUP BY term),
n AS (SELECT COUNT(*) AS n FROM documents)
SELECT term, doc_freq, round(CASE WHEN doc_freq >= 2 THEN ln((n + 1) / (doc_freq + 1)) ELSE 0.0 END, 6) AS idf
FROM df, n"""
ORACLE["fea07_count_vectorizer"] = f"""
WITH tok AS ({REGEX_TOKENS_NE})
SELECT term FROM (SELECT DISTINCT doc_id, unnest(t) AS term FROM tok) GROUP BY term HAVING COUNT(*) >= 5"""
ORACLE["fea09_binarize"] = """
SELECT vec_id, i, CAST(CASE WHEN x > 0 THEN 1.0 ELSE 0.0 END AS DOUBLE) AS x_bin
FROM (SELECT vec_id, unnest(embedding) AS x, CAST(unnest(range(0, len(embedding))) AS INTEGER) AS i FROM embeddings)"""
ORACLE["fea10_bucketize"] = """
SELECT l_orderkey, l_linenumber,
       CAST(CASE WHEN l_quantity < 10 THEN 0 WHEN l_quantity < 20 THEN 1 WHEN l_quantity < 30 THEN 2
            WHEN l_quantity < 40 THEN 3 ELSE 4 END AS DOUBLE) AS bucket FROM lineitem"""
ORACLE["fea12_index_strings"] = """
SELECT p_brand, CAST(row_number() OVER (ORDER BY COUNT(*) DESC, p_brand) - 1 AS DOUBLE) AS brand_index
FROM part GROUP BY p_brand"""
ORACLE["fea13_one_hot"] = """
WITH idx AS (SELECT c_mktsegment, row_number() OVER (ORDER BY COUNT(*) DESC, c_mktsegment) - 1 AS seg
             FROM customer GROUP BY c_mktsegment)
SELECT c_custkey, list_transform(range(0, 4), lambda j: CAST(CASE WHEN j = seg THEN 1 ELSE 0 END AS DOUBLE)) AS seg_vec
FROM customer JOIN idx USING (c_mktsegment)"""
ORACLE["fea15_assemble"] = _li_arr("[l_quantity, l_discount, l_tax] AS features")
ORACLE["fea19_scale_by"] = _li_arr("[round(l_quantity, 6), round(2 * l_discount, 6), round(3 * l_tax, 6)] AS scaled")
ORACLE["fea20_normalize"] = """
SELECT l_orderkey, l_linenumber,
       list_transform([l_quantity, l_discount, l_tax],
                      lambda x: round(x / sqrt(l_quantity ^ 2 + l_discount ^ 2 + l_tax ^ 2), 6)) AS normalized
FROM lineitem"""
ORACLE["fea21_standardize"] = """
WITH s AS (SELECT stddev_samp(l_quantity) AS a, stddev_samp(l_discount) AS b, stddev_samp(l_tax) AS c FROM lineitem)
SELECT l_orderkey, l_linenumber,
       [round(CASE WHEN a = 0 THEN 0.0 ELSE l_quantity / a END, 6),
        round(CASE WHEN b = 0 THEN 0.0 ELSE l_discount / b END, 6),
        round(CASE WHEN c = 0 THEN 0.0 ELSE l_tax / c END, 6)] AS scaled
FROM lineitem, s"""
ORACLE["fea22_minmax"] = """
WITH s AS (SELECT min(l_quantity) AS a0, max(l_quantity) AS a1, min(l_discount) AS b0, max(l_discount) AS b1,
                  min(l_tax) AS c0, max(l_tax) AS c1 FROM lineitem)
SELECT l_orderkey, l_linenumber,
       [round(CASE WHEN a1 = a0 THEN 0.5 ELSE (l_quantity - a0) / (a1 - a0) END, 6),
        round(CASE WHEN b1 = b0 THEN 0.5 ELSE (l_discount - b0) / (b1 - b0) END, 6),
        round(CASE WHEN c1 = c0 THEN 0.5 ELSE (l_tax - c0) / (c1 - c0) END, 6)] AS scaled
FROM lineitem, s"""
ORACLE["fea23_maxabs"] = """
WITH s AS (SELECT max(abs(l_quantity)) AS a, max(abs(l_discount)) AS b, max(abs(l_tax)) AS c FROM lineitem)
SELECT l_orderkey, l_linenumber,
       [round(l_quantity / a, 6), round(l_discount / b, 6), round(l_tax / c, 6)] AS scaled
FROM lineitem, s"""
ORACLE["fea24_impute"] = """
WITH x AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 7 THEN NULL ELSE l_discount END AS x FROM lineitem)
SELECT l_orderkey, l_linenumber, round(COALESCE(x, (SELECT AVG(x) FROM x)), 6) AS x FROM x"""


# ---------------------------------------------------------------- statistics
_LI_NUM = ["l_quantity", "l_discount", "l_tax", "l_extendedprice"]

ORACLE["agg10_summarize"] = """
WITH x AS (SELECT CAST(unnest(embedding) AS DOUBLE) AS x, unnest(range(0, len(embedding))) AS component
           FROM embeddings)
SELECT CAST(component AS INTEGER) AS component, COUNT(x) AS count, round(AVG(x), 6) AS mean,
       round(var_samp(x), 6) AS variance, round(MIN(x), 6) AS min, round(MAX(x), 6) AS max,
       round(SUM(abs(x)), 6) AS norm_l1, round(sqrt(SUM(x * x)), 6) AS norm_l2,
       CAST(SUM(CASE WHEN x <> 0 THEN 1 ELSE 0 END) AS BIGINT) AS num_nonzeros
FROM x GROUP BY component"""
ORACLE["sta01_corr_matrix"] = "\nUNION ALL\n".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS corr FROM lineitem"
    for a in _LI_NUM for b in _LI_NUM)
ORACLE["sta02_corr_pairs"] = "SELECT " + ", ".join(
    f"round(corr(l_extendedprice, {c}), 6) AS {c}" for c in _LI_NUM[:3]) + " FROM lineitem"


def _chisq(f: str) -> str:
    return f"""SELECT '{f}' AS feature, round(SUM((COALESCE(o, 0) - rv * cy / n) ^ 2 / (rv * cy / n)), 6) AS statistic,
       CAST((COUNT(DISTINCT v) - 1) * (COUNT(DISTINCT y) - 1) AS BIGINT) AS dof
FROM (SELECT v, SUM(o) AS rv FROM (SELECT {f} AS v, l_linestatus AS y, COUNT(*) AS o FROM lineitem GROUP BY 1, 2)
      GROUP BY v) r
CROSS JOIN (SELECT y, SUM(o) AS cy FROM (SELECT {f} AS v, l_linestatus AS y, COUNT(*) AS o FROM lineitem GROUP BY 1, 2)
            GROUP BY y) c
CROSS JOIN (SELECT COUNT(*) AS n FROM lineitem) t
LEFT JOIN (SELECT {f} AS v2, l_linestatus AS y2, COUNT(*) AS o FROM lineitem GROUP BY 1, 2) cells
  ON cells.v2 = r.v AND cells.y2 = c.y"""


ORACLE["sta03_chisq_independence"] = _chisq("l_linenumber") + "\nUNION ALL\n" + _chisq("l_returnflag")
ORACLE["sta04_chisq_gof"] = """
WITH c AS (SELECT c_mktsegment, COUNT(*) AS o FROM customer GROUP BY 1),
t AS (SELECT SUM(o) AS n, COUNT(*) AS k FROM c)
SELECT round(SUM((o - n / k) ^ 2 / (n / k)), 6) AS statistic, CAST(COUNT(*) - 1 AS BIGINT) AS dof FROM c, t"""
ORACLE["sta06_kde"] = "\nUNION ALL\n".join(
    f"SELECT CAST({p} AS DOUBLE) AS point, round(AVG(exp(-((l_discount - {p}) ^ 2) / (2 * 0.03 ^ 2))) "
    f"/ (0.03 * sqrt(2 * pi())), 6) AS density FROM lineitem" for p in [0.0, 0.05, 0.1])
ORACLE["sta07_column_cosine"] = "\nUNION ALL\n".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(SUM({a} * {b}) / (sqrt(SUM({a} * {a})) * sqrt(SUM({b} * {b}))), 6)"
    f" AS similarity FROM lineitem"
    for i, a in enumerate(_LI_NUM) for b in _LI_NUM[i + 1:])

# ---------------------------------------------------------------- patterns
BASKET_ITEMS = """b AS (SELECT l_orderkey AS o, p_brand AS item FROM lineitem JOIN part ON l_partkey = p_partkey
       GROUP BY 1, 2),
n AS (SELECT COUNT(DISTINCT o) AS n FROM b),
s AS (SELECT item, COUNT(*) AS freq FROM b GROUP BY item),
p AS (SELECT x.item AS a, y.item AS c, COUNT(*) AS freq FROM b x JOIN b y ON x.o = y.o AND x.item <> y.item
      GROUP BY 1, 2),
q AS (SELECT x.item AS a, y.item AS c, z.item AS e, COUNT(*) AS freq
      FROM b x JOIN b y ON x.o = y.o AND x.item < y.item JOIN b z ON y.o = z.o AND y.item < z.item GROUP BY 1, 2, 3)"""
ORACLE["fpm01_itemsets"] = f"""
WITH {BASKET_ITEMS}
SELECT [item] AS items, freq FROM s, n WHERE freq >= ceil(0.02 * n)
UNION ALL
SELECT [a, c] AS items, freq FROM p, n WHERE a < c AND freq >= ceil(0.02 * n)
UNION ALL
SELECT [a, c, e] AS items, freq FROM q, n WHERE freq >= ceil(0.02 * n)"""
ORACLE["fpm02_rules"] = f"""
WITH {BASKET_ITEMS}
SELECT [p.a] AS antecedent, [p.c] AS consequent, round(p.freq / s.freq, 6) AS confidence
FROM p JOIN s ON p.a = s.item, n
WHERE p.freq >= ceil(0.02 * n) AND s.freq >= ceil(0.02 * n) AND p.freq / s.freq >= 0.05"""
ORACLE["fpm03_rules_from"] = ORACLE["fpm02_rules"]

# ---------------------------------------------------------------- evaluation
THRESHOLDS = """s AS (SELECT l_discount AS threshold, SUM(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS pos,
              SUM(CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END) AS neg FROM lineitem GROUP BY 1),
c AS (SELECT threshold,
             SUM(pos) OVER (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING) AS tp,
             SUM(neg) OVER (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING) AS fp,
             SUM(pos) OVER () AS pp, SUM(neg) OVER () AS nn FROM s),
t AS (SELECT threshold, tp, fp, tp / (tp + fp) AS precision, tp / pp AS recall, fp / nn AS fpr FROM c)"""
ORACLE["eva01_binary_thresholds"] = f"""
WITH {THRESHOLDS}
SELECT threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, round(precision, 6) AS precision,
       round(recall, 6) AS recall, round(fpr, 6) AS fpr,
       round(CASE WHEN precision + recall = 0 THEN 0 ELSE 2 * precision * recall / (precision + recall) END, 6)
         AS f_measure
FROM t"""
ORACLE["eva01_binary_auc"] = f"""
WITH {THRESHOLDS},
l AS (SELECT *, COALESCE(lag(fpr) OVER (ORDER BY threshold DESC), 0) AS pf,
             COALESCE(lag(recall) OVER (ORDER BY threshold DESC), 0) AS pr,
             COALESCE(lag(precision) OVER (ORDER BY threshold DESC),
                      first(precision) OVER (ORDER BY threshold DESC
                                             ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS pp
      FROM t)
SELECT round(SUM((fpr - pf) * (recall + pr) / 2), 6) AS auc_roc,
       round(SUM((recall - pr) * (precision + pp) / 2), 6) AS auc_pr FROM l"""
ARGMAX = """p AS (SELECT CAST(label AS DOUBLE) AS l,
  CAST((list_position(embedding, list_max(embedding)) - 1) % 10 AS DOUBLE) AS p FROM embeddings),
labels AS (SELECT l AS label FROM p UNION SELECT p FROM p),
a AS (SELECT l AS label, COUNT(*) AS actual FROM p GROUP BY l),
pr AS (SELECT p AS label, COUNT(*) AS predicted FROM p GROUP BY p),
tt AS (SELECT l AS label, COUNT(*) AS tp FROM p WHERE l = p GROUP BY l),
n AS (SELECT COUNT(*) AS total FROM p),
m AS (SELECT label, COALESCE(actual, 0) AS actual, COALESCE(predicted, 0) AS predicted, COALESCE(tp, 0) AS tp, total
      FROM labels LEFT JOIN a USING (label) LEFT JOIN pr USING (label) LEFT JOIN tt USING (label), n),
per AS (SELECT label, tp, predicted - tp AS fp, actual - tp AS fn,
        CASE WHEN predicted = 0 THEN 0 ELSE tp / predicted END AS precision,
        CASE WHEN actual = 0 THEN 0 ELSE tp / actual END AS recall,
        (predicted - tp) / (total - actual) AS fpr, actual / total AS weight FROM m),
per2 AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0 ELSE 2 * precision * recall / (precision + recall) END
         AS f1 FROM per)"""
ORACLE["eva02_multiclass"] = f"""
WITH {ARGMAX}
SELECT label, tp, fp, fn, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
       round(fpr, 6) AS fpr, round(weight, 6) AS weight FROM per2"""
ORACLE["eva02_multiclass_summary"] = f"""
WITH {ARGMAX}
SELECT round(SUM(tp) / SUM(tp + fn), 6) AS accuracy, round(SUM(weight * precision), 6) AS weighted_precision,
       round(SUM(weight * recall), 6) AS weighted_recall, round(SUM(weight * f1), 6) AS weighted_f1 FROM per2"""
ORACLE["eva03_multilabel"] = """
WITH x AS (
  SELECT l_orderkey,
         COALESCE(list_sort(list(DISTINCT p_brand) FILTER (WHERE l_discount > 0.05)), []) AS pr,
         COALESCE(list_sort(list(DISTINCT p_brand) FILTER (WHERE l_quantity > 25)), []) AS lb
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey),
d AS (SELECT len(list_intersect(pr, lb)) AS i, len(pr) AS np, len(lb) AS nl,
             len(list_distinct(list_concat(pr, lb))) AS u, CASE WHEN pr = lb THEN 1 ELSE 0 END AS eq FROM x),
k AS (SELECT COUNT(DISTINCT z) AS k FROM (SELECT unnest(list_concat(pr, lb)) AS z FROM x))
SELECT round(AVG(CASE WHEN np > 0 THEN i / np ELSE 0 END), 6) AS precision,
       round(AVG(CASE WHEN nl > 0 THEN i / nl ELSE 0 END), 6) AS recall,
       round(AVG(CASE WHEN np + nl > 0 THEN 2 * i / (np + nl) ELSE 0 END), 6) AS f1,
       round(AVG(CASE WHEN u > 0 THEN i / u ELSE 1 END), 6) AS accuracy,
       round(SUM(i) / SUM(np), 6) AS micro_precision, round(SUM(i) / SUM(nl), 6) AS micro_recall,
       round(2 * SUM(i) / (SUM(np) + SUM(nl)), 6) AS micro_f1, round(AVG(eq), 6) AS subset_accuracy,
       round(SUM(np + nl - 2 * i) / (COUNT(*) * MAX(k)), 6) AS hamming_loss
FROM d, k"""
ORACLE["eva04_ranking"] = """
WITH r AS (SELECT o_custkey AS u, l_partkey AS item, CAST(SUM(l_quantity) AS FLOAT) AS rating
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2),
rel AS (SELECT u, COUNT(*) AS nrel FROM r WHERE rating >= 30 GROUP BY u),
rk AS (SELECT r.u, row_number() OVER (PARTITION BY r.u ORDER BY rating DESC, item) AS rank,
              CASE WHEN rating >= 30 THEN 1 ELSE 0 END AS hit, nrel FROM r JOIN rel USING (u)),
rk2 AS (SELECT *, SUM(hit) OVER (PARTITION BY u ORDER BY rank ROWS UNBOUNDED PRECEDING) AS hs FROM rk),
pu AS (SELECT u, SUM(CASE WHEN hit = 1 THEN hs / rank ELSE 0 END) / MAX(nrel) AS ap,
              SUM(CASE WHEN rank <= 1 THEN hit ELSE 0 END) / 1 AS p1,
              SUM(CASE WHEN rank <= 3 THEN hit ELSE 0 END) / 3 AS p3,
              SUM(CASE WHEN rank <= 5 THEN hit ELSE 0 END) / 5 AS p5,
              SUM(CASE WHEN rank <= 1 AND hit = 1 THEN 1 / log2(rank + 1) ELSE 0 END)
                / list_sum(list_transform(range(1, least(1, MAX(nrel)) + 1), lambda i: 1 / log2(i + 1))) AS n1,
              SUM(CASE WHEN rank <= 3 AND hit = 1 THEN 1 / log2(rank + 1) ELSE 0 END)
                / list_sum(list_transform(range(1, least(3, MAX(nrel)) + 1), lambda i: 1 / log2(i + 1))) AS n3,
              SUM(CASE WHEN rank <= 5 AND hit = 1 THEN 1 / log2(rank + 1) ELSE 0 END)
                / list_sum(list_transform(range(1, least(5, MAX(nrel)) + 1), lambda i: 1 / log2(i + 1))) AS n5
       FROM rk2 GROUP BY u)
SELECT round(AVG(ap), 6) AS map, round(AVG(p1), 6) AS precision_at_1, round(AVG(p3), 6) AS precision_at_3,
       round(AVG(p5), 6) AS precision_at_5, round(AVG(n1), 6) AS ndcg_at_1, round(AVG(n3), 6) AS ndcg_at_3,
       round(AVG(n5), 6) AS ndcg_at_5 FROM pu"""
PRICE_PRED = """pp AS (SELECT l_quantity * p_retailprice AS p, l_extendedprice AS y
               FROM lineitem JOIN part ON l_partkey = p_partkey)"""
ORACLE["eva05_regression"] = f"""
WITH {PRICE_PRED}
SELECT round(AVG((p - y) ^ 2), 4) AS mse, round(sqrt(AVG((p - y) ^ 2)), 4) AS rmse, round(AVG(abs(p - y)), 4) AS mae,
       round(1 - AVG((p - y) ^ 2) / var_pop(y), 4) AS r2,
       round(AVG(p * p) - 2 * AVG(y) * AVG(p) + AVG(y) * AVG(y), 4) AS explained_variance FROM pp"""
ORACLE["agg15_mse"] = f"""
WITH {PRICE_PRED}
SELECT round(AVG((p - y) ^ 2), 4) AS mse, round(sqrt(AVG((p - y) ^ 2)), 4) AS rmse,
       round(AVG(abs(p - y)), 4) AS mae FROM pp"""
ORACLE["eva06_error_rate"] = """
SELECT round(AVG(CASE WHEN CAST(label AS DOUBLE)
                           <> CAST((list_position(embedding, list_max(embedding)) - 1) % 10 AS DOUBLE)
                      THEN 1.0 ELSE 0.0 END), 6) AS error_rate FROM embeddings"""
ORACLE["eva07_wssse"] = """
WITH x AS (SELECT label, CAST(unnest(embedding) AS DOUBLE) AS x, unnest(range(1, len(embedding) + 1)) AS i
           FROM embeddings),
c AS (SELECT label, i, AVG(x) AS m FROM x GROUP BY label, i)
SELECT round(SUM((x.x - c.m) ^ 2), 4) AS wssse FROM x JOIN c USING (label, i)"""


# ---------------------------------------------------------------- UDFs
ORACLE["udf01_udaf_mean"] = "SELECT c_mktsegment, round(AVG(c_acctbal), 6) AS average FROM customer GROUP BY 1"
ORACLE["udf02_sql_udaf"] = ORACLE["udf01_udaf_mean"]
ORACLE["udf03_count_tokens"] = f"SELECT doc_id, CAST(len(t) AS INTEGER) AS n_tokens FROM ({REGEX_TOKENS_NE})"
ORACLE["udf03_count_tokens_pandas"] = ORACLE["udf03_count_tokens"]
ORACLE["udf04_map_frames"] = """
SELECT l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount), 4) AS revenue FROM lineitem"""
ORACLE["udf06_shift_transformer"] = "SELECT l_orderkey, l_linenumber, l_quantity + 1.5 AS shifted FROM lineitem"
ORACLE["udf07_my_classifier"] = "SELECT vec_id AS id, CAST(0.0 AS DOUBLE) AS prediction FROM embeddings"
ORACLE["snk10_roundtrip_count"] = """
SELECT COUNT(*) AS before, COUNT(*) AS after, true AS equal FROM orders"""


# ---------------------------------------------------------------- models with a closed form
ORACLE["mod12_linreg"] = """
SELECT round(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
       round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept FROM lineitem"""
ORACLE["mod13_glr"] = ORACLE["mod12_linreg"]
ORACLE["mod17_lloyd_step"] = """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda v: CAST(v AS DOUBLE)) AS x FROM embeddings),
c AS (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS ci, x AS c FROM (SELECT * FROM e ORDER BY vec_id LIMIT 3)),
d AS (SELECT e.vec_id, c.ci,
             list_sum(list_transform(range(1, len(e.x) + 1), lambda i: (e.x[i] - c.c[i]) * (e.x[i] - c.c[i]))) AS dist
      FROM e, c),
a AS (SELECT vec_id, arg_min(ci, dist) AS ci FROM d GROUP BY vec_id),
u AS (SELECT a.ci, unnest(e.x) AS v, unnest(range(1, len(e.x) + 1)) AS i FROM a JOIN e USING (vec_id)),
m AS (SELECT ci, i, round(AVG(v), 4) AS m FROM u GROUP BY ci, i)
SELECT CAST(ci AS INTEGER) AS cluster, list(m ORDER BY i) AS center FROM m GROUP BY ci"""


# ---------------------------------------------------------------- more streaming
ORACLE["str04_sliding_watermark"] = ORACLE["str03_windowed_count"]
ORACLE["str10_restartable"] = WORD_COUNTS
ORACLE["src22_file_stream_flights"] = ORACLE["air02_carriers_by_arr_delay"]
ORACLE["src25_custom_source"] = WORD_COUNTS
ORACLE["src26_union_streams"] = WORD_COUNTS
ORACLE["str20_ab_test_final"] = """
WITH g AS (SELECT event_type = 'purchase' AS label, COUNT(value) AS n, AVG(value) AS m, var_samp(value) AS v
           FROM events GROUP BY 1),
a AS (SELECT * FROM g WHERE label), b AS (SELECT * FROM g WHERE NOT label)
SELECT round((a.m - b.m) / sqrt(a.v / a.n + b.v / b.n), 6) AS statistic,
       round((a.v / a.n + b.v / b.n) ^ 2 / ((a.v / a.n) ^ 2 / (a.n - 1) + (b.v / b.n) ^ 2 / (b.n - 1)), 4) AS dof
FROM a, b"""
ORACLE["air01_top_airports_star"] = ORACLE["air01_top_airports"]
ORACLE["air02_carriers_star"] = ORACLE["air02_carriers_by_arr_delay"]


# ---------------------------------------------------------------- file formats
ORACLE["src01_flights_csv"] = ORACLE["air02_carriers_by_arr_delay"]
ORACLE["src02_text_scan"] = f"""WITH {DOC_WORDS}
SELECT word, COUNT(*) AS count FROM doc_words WHERE length(word) > 0 GROUP BY word"""
ORACLE["src03_json_scan"] = """
SELECT event_type, COUNT(*) AS n, round(SUM(value), 4) AS total FROM events GROUP BY event_type"""
ORACLE["src06_merged_schema"] = """
SELECT CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 2 END AS key, COUNT(*) AS n,
       COUNT(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END) AS with_price,
       COUNT(CASE WHEN o_orderstatus <> 'F' THEN o_custkey END) AS with_customer
FROM orders GROUP BY 1"""
ORACLE["src09_csv_header"] = """
SELECT c_mktsegment, COUNT(*) AS n, round(SUM(c_acctbal), 2) AS bal FROM customer GROUP BY 1"""
ORACLE["src10_libsvm"] = ORACLE["src11_dense_vectors"] = """
SELECT CAST(label AS DOUBLE) AS label, CAST(pos - 1 AS INTEGER) AS pos, COUNT(*) AS n, MIN(x) AS lo, MAX(x) AS hi,
       CAST(SUM(CAST(floor(x * 1e6) AS BIGINT)) AS BIGINT) AS millionths
FROM (SELECT label, unnest(range(1, len(embedding) + 1)) AS pos, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings)
GROUP BY ALL"""
ORACLE["src12_ratings_text"] = """
SELECT CAST(o_custkey AS INTEGER) AS "userId", CAST(l_partkey AS INTEGER) AS "movieId",
       CAST(CAST(SUM(l_quantity) AS FLOAT) AS DOUBLE) AS rating, CAST(o_custkey AS BIGINT) * 1000 AS "timestamp"
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey, l_partkey"""
ORACLE["src13_edge_list"] = f"""
WITH {PART_CHAIN}
SELECT DISTINCT CAST(least(src, dst) AS BIGINT) AS src, CAST(greatest(src, dst) AS BIGINT) AS dst FROM pc WHERE src <> dst"""
ORACLE["src15_catalog_table"] = "SELECT c_mktsegment, COUNT(*) AS n FROM customer GROUP BY 1"
ORACLE["src24_replay_queue"] = "SELECT o_orderstatus, COUNT(*) AS count FROM orders GROUP BY 1"
ORACLE["snk01_write_formats"] = "\nUNION ALL\n".join(
    f"SELECT '{f}' AS fmt, n_nationkey, n_name, n_regionkey FROM nation" for f in ("parquet", "json", "csv"))
ORACLE["snk02_partitioned_write"] = "SELECT o_orderstatus, COUNT(*) AS n FROM orders GROUP BY 1"
ORACLE["snk03_bucketed_table"] = "SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY 1"
ORACLE["snk04_text_write"] = """
SELECT CAST(n_nationkey AS VARCHAR) || chr(9) || n_name AS value FROM nation"""
ORACLE["joi02_join_attr"] = ORACLE["grf04_connected_components"].replace(
    "SELECT id, label FROM lab",
    "SELECT lab.id, lab.label, p.p_name FROM lab JOIN part p ON lab.id = p.p_partkey")
ORACLE["str07_update_mean"] = """
SELECT event_type, COUNT(*) AS n, round(SUM(value), 4) AS total,
       CAST(SUM(value) / COUNT(*) AS FLOAT) AS mean FROM events GROUP BY 1"""


# ---------------------------------------------------------------- vector transforms
ORACLE["fea16_slice_vector"] = """
SELECT vec_id AS id, [CAST(embedding[1] AS DOUBLE), CAST(embedding[3] AS DOUBLE), CAST(embedding[5] AS DOUBLE)]
       AS sliced FROM embeddings"""
ORACLE["fea17_interact"] = """
SELECT l_orderkey, l_linenumber, [round(l_quantity * l_discount, 6), round(l_quantity * l_tax, 6)] AS interaction
FROM lineitem"""
ORACLE["fea18_poly"] = """
SELECT l_orderkey, l_linenumber,
       [round(q, 6), round(q * q, 6), round(d, 6), round(q * d, 6), round(d * d, 6),
        round(t, 6), round(q * t, 6), round(d * t, 6), round(t * t, 6)] AS poly
FROM (SELECT l_orderkey, l_linenumber, l_quantity AS q, l_discount AS d, l_tax AS t FROM lineitem)"""
ORACLE["fea25_dct"] = """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda v: CAST(v AS DOUBLE)) AS x FROM embeddings)
SELECT vec_id AS id,
       list_transform(range(0, 64), lambda k:
         round(CASE WHEN k = 0 THEN sqrt(1 / 64) ELSE sqrt(2 / 64) END
               * list_sum(list_transform(range(0, 64), lambda n: x[n + 1] * cos(pi() / 64 * (n + 0.5) * k))), 6))
       AS dct
FROM e"""
ORACLE["air07_stream_itinerary"] = ORACLE["air06_itinerary"]
ORACLE["air07_stream_route_delay"] = ORACLE["air05_route_delay"]


# ---------------------------------------------------------------- fitted transforms with a closed form
# vector indexer: quantity (50 values) and discount (11 values) stay
# continuous at maxCategories = 10; tax (9 values) becomes a category index
# in ascending value order
ORACLE["fea14_index_vector"] = """
SELECT l_orderkey, l_linenumber,
       [l_quantity, l_discount, CAST(dense_rank() OVER (ORDER BY l_tax) - 1 AS DOUBLE)] AS indexed
FROM lineitem"""
# R formula: the segment is dummy-coded by frequency (ties by name), last level dropped
ORACLE["fea28_rformula"] = """
WITH idx AS (SELECT c_mktsegment, row_number() OVER (ORDER BY COUNT(*) DESC, c_mktsegment) - 1 AS seg
             FROM customer GROUP BY c_mktsegment)
SELECT c_custkey,
       list_concat(list_transform(range(0, 4), lambda j: CAST(CASE WHEN j = seg THEN 1 ELSE 0 END AS DOUBLE)),
                   [CAST(c_nationkey AS DOUBLE)]) AS features,
       CAST(CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END AS DOUBLE) AS label
FROM customer JOIN idx USING (c_mktsegment)"""
ORACLE["str13_active_users_exact"] = ORACLE["str13_active_users_batch"]
ORACLE["air03_dests_star"] = ORACLE["air03_dests_by_dep_delay"]
ORACLE["air04_carriers_on_route_star"] = ORACLE["air04_carriers_on_route"]
ORACLE["air05_route_delay_star"] = ORACLE["air05_route_delay"]

# ---------------------------------------------------------------- values and checked invariants
ORACLE["air07_stream_dests"] = ORACLE["air03_dests_by_dep_delay"]
ORACLE["air07_stream_carriers_on_route"] = ORACLE["air04_carriers_on_route"]
ORACLE["smp01_split_checked"] = """
SELECT COUNT(*) AS n, COUNT(DISTINCT o_orderkey) AS keys, true AS near_share FROM orders"""
ORACLE["smp02_sample_checked"] = "SELECT true AS no_repeats, true AS near_share, true AS from_table"
ORACLE["smp02_with_replacement_checked"] = "SELECT true AS repeats"
ORACLE["sta09_svd_checked"] = """
SELECT round(SUM(CAST(x AS DOUBLE) * x), 3) AS squared_norm FROM (SELECT unnest(embedding) AS x FROM embeddings)"""
ORACLE["fea31_vector_roundtrip"] = """
SELECT vec_id AS id, CAST(unnest(embedding) AS DOUBLE) AS x, CAST(unnest(range(0, len(embedding))) AS INTEGER) AS i FROM embeddings"""
ORACLE["fea05_hashing_tf"] = f"""
SELECT doc_id, 1024 AS dims, len(t) AS tokens FROM ({REGEX_TOKENS_NE})"""
ORACLE["mod28_model_roundtrip_checked"] = "SELECT COUNT(*) AS n, CAST(0 AS BIGINT) AS changed FROM embeddings"
# the isotonic fit at a point is the largest, over starts up to it, of the
# smallest, over ends from it on, mean of the run
ORACLE["mod14_isotonic"] = """
WITH g AS (SELECT l_quantity AS q, SUM(l_extendedprice) AS s, COUNT(*) AS n FROM lineitem GROUP BY 1),
c AS (SELECT q, SUM(s) OVER (ORDER BY q) AS s, SUM(n) OVER (ORDER BY q) AS n, s AS own, n AS one FROM g),
runs AS (SELECT i.q AS i, j.q AS j, (j.s - i.s + i.own) / (j.n - i.n + i.one) AS m FROM c i JOIN c j ON i.q <= j.q),
low AS (SELECT g.q, r.i, MIN(r.m) AS m FROM g JOIN runs r ON r.i <= g.q AND r.j >= g.q GROUP BY 1, 2)
SELECT q AS l_quantity, round(MAX(m), 4) AS prediction FROM low GROUP BY q"""
ORACLE["fpm04_predict"] = f"""
WITH {BASKET_ITEMS},
r AS (SELECT p.a, p.c FROM p JOIN s ON p.a = s.item, n
      WHERE p.freq >= ceil(0.02 * n) AND s.freq >= ceil(0.02 * n) AND p.freq / s.freq >= 0.2),
hit AS (SELECT DISTINCT b.o, r.c FROM b JOIN r ON b.item = r.a ANTI JOIN b x ON x.o = b.o AND x.item = r.c)
SELECT o.o AS order_id, COALESCE(list_sort(list(hit.c) FILTER (WHERE hit.c IS NOT NULL)), []) AS prediction
FROM (SELECT DISTINCT o FROM b) o LEFT JOIN hit ON o.o = hit.o GROUP BY o.o"""
ORACLE["fea12_unindex_strings"] = "SELECT p_partkey, p_brand AS label FROM part"
ORACLE["cat02_global_view"] = "SELECT o_orderstatus, COUNT(*) AS n FROM orders GROUP BY 1"
ORACLE["cat03_drop_table"] = "SELECT COUNT(*) AS rows_before, false AS still_there FROM customer"
ORACLE["cat04_typed_view"] = "SELECT CAST(o_totalprice AS DOUBLE) AS o_totalprice, o_orderkey FROM orders"
ORACLE["sta01_spearman"] = "WITH r AS (SELECT " + ", ".join(
    f"rank() OVER (ORDER BY {c}) + (COUNT(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS {c}" for c in _LI_NUM) \
    + " FROM lineitem)\n" + "\nUNION ALL\n".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS corr FROM r" for a in _LI_NUM for b in _LI_NUM)


# ---------------------------------------------------------------- models and tests in closed form
def _normal_cdf(z: str) -> str:
    """P(Z <= z) by the same rational approximation as the operator's."""
    from skyframe.operators.stats import TAIL_DOWN, TAIL_FAR, TAIL_TOP

    def horner(cs):
        out = f"{cs[0]!r}::DOUBLE"
        for c in cs[1:]:
            out = f"({out} * abs({z}) + {c!r}::DOUBLE)"
        return out
    far = f"(abs({z}) + 0.65::DOUBLE)"
    for k in (4, 3, 2, 1):
        far = f"(abs({z}) + {k}::DOUBLE / {far})"
    tail = (f"CASE WHEN abs({z}) < {TAIL_FAR}::DOUBLE THEN exp(-{z} * {z} / 2) * {horner(TAIL_TOP)} / {horner(TAIL_DOWN)} "
            f"ELSE exp(-{z} * {z} / 2) / {far} / 2.506628274631::DOUBLE END")
    return f"CASE WHEN {z} > 0 THEN 1 - ({tail}) ELSE {tail} END"


ORACLE["sta05_ks_cdf"] = f"""
WITH m AS (SELECT AVG(value) AS m, stddev_samp(value) AS s, COUNT(value) AS n FROM events),
c AS (SELECT value AS x, COUNT(*) AS c, SUM(COUNT(*)) OVER (ORDER BY value) AS cum FROM events
      WHERE value IS NOT NULL GROUP BY value),
z AS (SELECT x, c, cum, n, (x - m) / s AS z, m FROM c, m),
f AS (SELECT 'normal' AS distribution, c, cum, n, {_normal_cdf("z")} AS f FROM z
      UNION ALL SELECT 'exponential', c, cum, n, CASE WHEN x <= 0 THEN 0 ELSE 1 - exp(-x / m) END FROM z)
SELECT distribution, MAX(n) AS n, round(MAX(greatest(cum / n - f, f - (cum - c) / n)), 6) AS statistic
FROM f GROUP BY distribution"""
ORACLE["sta08_dimsum_error"] = "SELECT CAST(6 AS BIGINT) AS pairs, true AS sampled, true AS within"
ORACLE["str08_sessions_expired"] = """
SELECT CAST(user_id AS VARCHAR) AS id, CAST((epoch_us(MAX(ts)) - epoch_us(MIN(ts))) // 1000 AS BIGINT) AS duration_ms,
       COUNT(*) AS num_events
FROM events GROUP BY user_id"""
ORACLE["snk06_delta_compacted"] = """
SELECT o_custkey, o_orderkey, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END DESC,
                           o_totalprice DESC, o_orderkey DESC) = 1"""

DOC_TERMS = """terms AS (
  SELECT doc_id, lang AS c, term, COUNT(*) AS n
  FROM (SELECT doc_id, lang, unnest(regexp_split_to_array(text, '[ \\n]+')) AS term FROM documents
        WHERE text IS NOT NULL AND lang IS NOT NULL)
  WHERE term <> '' GROUP BY ALL),
train AS (SELECT * FROM terms WHERE doc_id % 5 <> 0),
test AS (SELECT * FROM terms WHERE doc_id % 5 = 0),
classes AS (SELECT c, COUNT(DISTINCT doc_id) AS docs, SUM(n) AS mass FROM train GROUP BY c),
vocabulary AS (SELECT DISTINCT term FROM train),
v AS (SELECT COUNT(*) AS v FROM vocabulary),
prior AS (SELECT c, ln((docs + 1) / (SUM(docs) OVER () + COUNT(*) OVER ())) AS prior, docs, mass FROM classes),
cells AS (SELECT term, c, SUM(n) AS n, COUNT(DISTINCT doc_id) AS d FROM train GROUP BY term, c)"""
_BEST = """
SELECT doc_id, arg_max(c, (score, -code)) AS prediction, round(MAX(score), 3) AS score
FROM (SELECT *, dense_rank() OVER (ORDER BY c) AS code FROM scores) GROUP BY doc_id"""
ORACLE["mod06_bayes_multinomial"] = f"""
WITH {DOC_TERMS},
scores AS (
  SELECT t.doc_id, p.c, p.prior + SUM(CASE WHEN w.term IS NULL THEN 0 ELSE
           t.n * ln((COALESCE(x.n, 0) + 1) / (p.mass + v.v)) END) AS score
  FROM test t JOIN prior p ON true JOIN v ON true LEFT JOIN vocabulary w ON t.term = w.term
  LEFT JOIN cells x ON x.term = t.term AND x.c = p.c
  GROUP BY t.doc_id, p.c, p.prior)
{_BEST}"""
ORACLE["mod06_bayes_bernoulli"] = f"""
WITH {DOC_TERMS},
seen AS (SELECT p.c, SUM(ln((p.docs + 1 - x.d) / (p.docs + 2))) AS s, COUNT(*) AS k FROM cells x JOIN prior p ON x.c = p.c GROUP BY p.c),
empty AS (SELECT p.c, p.prior + s.s + (v.v - s.k) * ln((p.docs + 1) / (p.docs + 2)) AS score, p.docs
          FROM prior p JOIN seen s ON p.c = s.c JOIN v ON true),
scores AS (
  SELECT t.doc_id, e.c, e.score + SUM(CASE WHEN w.term IS NULL THEN 0 ELSE
           ln((COALESCE(x.d, 0) + 1) / (e.docs + 1 - COALESCE(x.d, 0))) END) AS score
  FROM test t JOIN empty e ON true LEFT JOIN vocabulary w ON t.term = w.term
  LEFT JOIN cells x ON x.term = t.term AND x.c = e.c
  GROUP BY t.doc_id, e.c, e.score)
{_BEST}"""
ORACLE["mod20_lda_em"] = """
WITH t AS (SELECT unnest(regexp_split_to_array(text, '[ \\n]+')) AS term FROM documents WHERE text IS NOT NULL AND lang IS NOT NULL)
SELECT 5 AS rounds, true AS never_falls, true AS perplexity_falls, COUNT(*) AS tokens, COUNT(DISTINCT term) AS terms
FROM t WHERE term <> ''"""
ORACLE["mod22_als_implicit"] = """
SELECT COUNT(DISTINCT l_partkey) AS items, true AS solved, true AS never_rises
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

# With one indicator per group, a fitted mean is the group's mean; g is the link,
# w the weight of a row in the Fisher information.
_GLM = """
r AS (SELECT l_returnflag AS f, l_extendedprice AS price, CAST(l_quantity > 25 AS INTEGER) AS big, l_quantity AS q FROM lineitem),
y AS (SELECT 'gaussian' AS family, f, CAST(price AS DOUBLE) AS y FROM r UNION ALL SELECT 'binomial', f, CAST(big AS DOUBLE) FROM r
      UNION ALL SELECT 'poisson', f, CAST(q AS DOUBLE) FROM r UNION ALL SELECT 'gamma', f, CAST(price AS DOUBLE) FROM r),
m AS (SELECT *, AVG(y) OVER (PARTITION BY family, f) AS mu, AVG(y) OVER (PARTITION BY family) AS mean,
             COUNT(*) OVER (PARTITION BY family) AS rows FROM y),
d AS (
  SELECT *, CASE family WHEN 'gaussian' THEN (y - mu) ^ 2
              WHEN 'binomial' THEN -2 * (y * ln(mu) + (1 - y) * ln(1 - mu))
              WHEN 'poisson' THEN 2 * (CASE WHEN y > 0 THEN y * ln(y / mu) ELSE 0 END - (y - mu))
              ELSE -2 * (ln(y / mu) - (y - mu) / mu) END AS dev,
         CASE family WHEN 'gaussian' THEN (y - mean) ^ 2
              WHEN 'binomial' THEN -2 * (y * ln(mean) + (1 - y) * ln(1 - mean))
              WHEN 'poisson' THEN 2 * (CASE WHEN y > 0 THEN y * ln(y / mean) ELSE 0 END - (y - mean))
              ELSE -2 * (ln(y / mean) - (y - mean) / mean) END AS null_dev,
         (y - mu) ^ 2 / CASE family WHEN 'gaussian' THEN 1 WHEN 'binomial' THEN mu * (1 - mu) WHEN 'poisson' THEN mu
                                    ELSE mu * mu END AS pearson,
         CASE WHEN family = 'poisson' THEN -2 * (y * ln(mu) - mu - lgamma(y + 1)) END AS own
  FROM m),
s AS (
  SELECT family, MAX(rows) - 3 AS dof, SUM(dev) / MAX(rows) AS deviance, SUM(null_dev) / MAX(rows) AS null_deviance,
         CASE WHEN family IN ('binomial', 'poisson') THEN 1 ELSE SUM(pearson) / (MAX(rows) - 3) END AS dispersion,
         CASE family WHEN 'gaussian' THEN (MAX(rows) * (ln(SUM(dev) / MAX(rows) * 2 * pi()) + 1) + 2 + 6) / MAX(rows)
              WHEN 'binomial' THEN (SUM(dev) + 6) / MAX(rows) WHEN 'poisson' THEN (SUM(own) + 6) / MAX(rows) END AS aic
  FROM d GROUP BY family)"""
ORACLE["mod13_glm_summary"] = f"""
WITH {_GLM}
SELECT family, dof, true AS stationary, round(deviance, 4) AS deviance, round(null_deviance, 4) AS null_deviance,
       round(dispersion, 4) AS dispersion, round(aic, 4) AS aic FROM s"""
ORACLE["mod13_glm_coefficients"] = f"""
WITH {_GLM},
g AS (
  SELECT family, f, CASE family WHEN 'gaussian' THEN AVG(y) WHEN 'binomial' THEN ln(AVG(y) / (1 - AVG(y))) ELSE ln(AVG(y)) END AS eta,
         COUNT(*) * CASE family WHEN 'binomial' THEN AVG(y) * (1 - AVG(y)) WHEN 'poisson' THEN AVG(y) ELSE 1 END AS w
  FROM y GROUP BY family, f),
c AS (
  SELECT g.family, CASE g.f WHEN 'R' THEN '(intercept)' ELSE lower(g.f) END AS term,
         CASE g.f WHEN 'R' THEN g.eta ELSE g.eta - b.eta END AS coefficient,
         sqrt(s.dispersion * (1 / g.w + CASE g.f WHEN 'R' THEN 0 ELSE 1 / b.w END)) AS std_error
  FROM g JOIN g b ON g.family = b.family AND b.f = 'R' JOIN s ON g.family = s.family)
SELECT family, term, round(coefficient, 4) AS coefficient, round(std_error, 4) AS std_error,
       round(coefficient / std_error, 4) AS statistic FROM c"""

ORACLE["sta04_contingency"] = """
WITH o AS (SELECT o_orderstatus AS r, o_orderpriority AS c, COUNT(*) AS n FROM orders GROUP BY ALL),
m AS (SELECT r, c, SUM(n) OVER (PARTITION BY r) * SUM(n) OVER (PARTITION BY c) / SUM(n) OVER () AS e, n FROM o),
t AS (SELECT SUM(n * n / e) - SUM(n) AS x, (COUNT(DISTINCT r) - 1) * (COUNT(DISTINCT c) - 1) AS dof FROM m)
SELECT round(x, 6) AS statistic, CAST(dof AS BIGINT) AS dof,
       -- the tail of an even number of degrees of freedom is a finite sum
       round(exp(-x / 2) * list_sum(list_transform(range(dof // 2), lambda i: (x / 2) ^ i / gamma(i + 1))), 6) AS p_value
FROM t"""
ORACLE["sta10_projection_checked"] = """
SELECT vec_id, round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * x)), 3) AS squared_norm FROM embeddings"""
ORACLE["mod08_forest_regression_checked"] = ORACLE["mod09_gbt_regression_checked"] = """
SELECT COUNT(*) AS n, true AS explains_most FROM lineitem WHERE l_orderkey % 5 = 0"""
ORACLE["mod16_kmeans_random_checked"] = "SELECT COUNT(*) AS n, true AS of_k, true AS cheaper FROM embeddings"

# elastic net by coordinate descent over the three features' moments, 200 rounds
_SOFT = "sign({p}) * greatest(abs({p}) - 0.24, 0) / (1 + ridge)"
_NET = f"""RECURSIVE m AS (
  SELECT stddev_pop(l_quantity) AS s1, stddev_pop(l_discount) AS s2, stddev_pop(l_tax) AS s3,
         0.3 * 0.2 / stddev_pop(l_extendedprice) AS ridge,
         covar_pop(l_quantity, l_discount) / (s1 * s2) AS c12, covar_pop(l_quantity, l_tax) / (s1 * s3) AS c13,
         covar_pop(l_discount, l_tax) / (s2 * s3) AS c23, covar_pop(l_quantity, l_extendedprice) / s1 AS y1,
         covar_pop(l_discount, l_extendedprice) / s2 AS y2, covar_pop(l_tax, l_extendedprice) / s3 AS y3,
         AVG(l_quantity) AS m1, AVG(l_discount) AS m2, AVG(l_tax) AS m3, AVG(l_extendedprice) AS my FROM lineitem),
net AS (
  SELECT 0 AS i, 0.0::DOUBLE AS b1, 0.0::DOUBLE AS b2, 0.0::DOUBLE AS b3
  UNION ALL
  SELECT i + 1, n1, n2, {_SOFT.format(p="(y3 - c13 * n1 - c23 * n2)")} FROM (
    SELECT *, {_SOFT.format(p="(y2 - c12 * n1 - c23 * b3)")} AS n2 FROM (
      SELECT net.*, m.*, {_SOFT.format(p="(y1 - c12 * b2 - c13 * b3)")} AS n1 FROM net, m WHERE i < 200))),
w AS (
  SELECT b1 / s1 AS w1, b2 / s2 AS w2, b3 / s3 AS w3, my - b1 / s1 * m1 - b2 / s2 * m2 - b3 / s3 * m3 AS w0
  FROM net, m WHERE i = 200)"""
ORACLE["mod12_elastic_net"] = f"""
WITH {_NET}
SELECT unnest(['(intercept)', 'l_quantity', 'l_discount', 'l_tax']) AS term,
       round(unnest([w0, w1, w2, w3]), 3) AS coefficient FROM w"""
ORACLE["mod12_linreg_summary"] = f"""
WITH {_NET},
r AS (SELECT l_extendedprice AS y, l_extendedprice - w0 - w1 * l_quantity - w2 * l_discount - w3 * l_tax AS r FROM lineitem, w)
SELECT COUNT(*) AS n, round(AVG(abs(r)), 4) AS mae, round(MIN(r), 3) AS lowest, round(MAX(r), 3) AS highest,
       round(sqrt(AVG(r * r)), 4) AS rmse, round(1 - AVG(r * r) / var_pop(y), 6) AS r2, true AS optimal FROM r"""
