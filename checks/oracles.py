"""The registered queries as SQL for DuckDB, written independently of the operators."""

from __future__ import annotations

SUBS = """subs AS (
  SELECT o_custkey AS user_id, o_orderkey AS rid, CAST(o_orderdate AS date) AS date,
    CASE o_orderstatus WHEN 'F' THEN 'subs' WHEN 'O' THEN 'free' WHEN 'P' THEN 'trial' END AS state,
    CAST(day(o_orderdate) AS int) AS workout_day,
    CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(month(o_orderdate) AS int) END AS gameplay_day
  FROM orders)"""

HISTORY = """sess AS (
  SELECT o_custkey AS user_id, o_orderkey AS rid, CAST(o_orderdate AS date) AS date,
    CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice END AS lpi
  FROM orders)"""

PLAY = """ev AS (
  SELECT user_id, CAST(ts AS date) AS date, ts, event_id, event_type, value,
    CAST(hour(ts) AS int) AS h, json_extract_string(props, '$.k') AS g
  FROM events),
sess AS (
  SELECT user_id, date, min(event_id) AS rid,
    avg(value) FILTER (WHERE event_type <> 'error') AS lpi,
    string_agg(CAST(h AS varchar), ',' ORDER BY ts, event_id) AS hour,
    string_agg(g, ',' ORDER BY ts, event_id) AS gameId
  FROM ev GROUP BY user_id, date)"""

# Session features need the two text lists as integers.
HOURS = """hrs AS (
  SELECT user_id, unnest(CAST(string_split(hour, ',') AS int[])) AS h FROM sess),
hour_stats AS (
  SELECT user_id, avg(h) AS hour_avg, stddev_pop(h) AS hour_std FROM hrs GROUP BY user_id),
lens AS (
  SELECT user_id, CAST(string_split(hour, ',') AS int[]) AS a FROM sess),
lengths AS (
  SELECT user_id, avg(abs(a[-1] - a[1])) AS length_of_session_avgs FROM lens GROUP BY user_id)"""

FIRST = """first_lpi AS (
  SELECT user_id, arg_min(lpi, (date, rid)) FILTER (WHERE lpi IS NOT NULL) AS first_recorded_lpi
  FROM sess GROUP BY user_id)"""

DELTAS = """deltas AS (
  SELECT user_id, rid, lpi - lag(lpi) OVER w AS delta, row_number() OVER w AS rn,
    count(*) OVER (PARTITION BY user_id) AS n
  FROM sess WINDOW w AS (PARTITION BY user_id ORDER BY date, rid))"""

_SLOTS = [
    "ffth_last_lpi_change",
    "frth_last_lpi_change",
    "thrd_last_lpi_change",
    "sec_last_lpi_change",
    "last_lpi_change",
]


def _last5(align: str) -> str:
    slot = "rn - greatest(n - 5, 0)" if align == "left" else "rn - (n - 5)"
    picks = ", ".join(
        f"coalesce(max(CASE WHEN slot = {i} THEN delta END), 0.0) AS {name}" for i, name in enumerate(_SLOTS, 1)
    )
    return f"""{DELTAS},
slots AS (SELECT user_id, delta, {slot} AS slot FROM deltas WHERE rn > n - 5),
last5 AS (SELECT user_id, {picks} FROM slots GROUP BY user_id)"""


CHURN = """gaps AS (
  SELECT *, CAST(date_diff('day', lag(date) OVER w, date) AS int) AS day_gap
  FROM subs WINDOW w AS (PARTITION BY user_id ORDER BY date, rid)),
flags AS (
  SELECT *, CASE WHEN day_gap > 730 THEN 1 ELSE 0 END AS churned FROM gaps),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY churned DESC, date DESC, rid DESC) AS pick,
    CAST(sum(churned) OVER (PARTITION BY user_id) AS bigint) AS churn_count
  FROM flags),
kept AS (SELECT *, churn_count - churned AS prior_churn_count FROM ranked WHERE pick = 1)"""

SUBS_FEATURES = """med AS (
  SELECT median(workout_day) AS w, median(gameplay_day) AS g, median(day_gap) AS d FROM kept),
subs_features AS (
  SELECT user_id, CAST(coalesce(workout_day, w) AS double) AS workout_day,
    CAST(coalesce(gameplay_day, g) AS double) AS gameplay_day, churned, prior_churn_count
  FROM kept, med
  WHERE state IS NOT NULL AND date IS NOT NULL AND coalesce(workout_day, w) IS NOT NULL
    AND coalesce(gameplay_day, g) IS NOT NULL AND coalesce(day_gap, d) IS NOT NULL)"""

WEEKS = """weeks AS (
  SELECT user_id, CAST(weekofyear(ts) AS int) AS weekOfYear,
    CAST(CASE WHEN count(*) >= 4 THEN count(DISTINCT event_type) END AS double) AS gameVariety
  FROM events GROUP BY ALL)"""


def _variety(usable: str, where: str = "") -> str:
    def pick(expr: str, name: str) -> str:
        return f"CASE WHEN {usable} THEN {expr} ELSE 0.0 END AS {name}"

    return f"""variety AS (
  SELECT user_id, {pick('max(gameVariety)', 'gv_max')}, {pick('avg(gameVariety)', 'gv_avg')},
    {pick('stddev_pop(gameVariety)', 'gv_std_dev')}
  FROM weeks {where} GROUP BY user_id)"""


POISON = _variety("count(gameVariety) = count(*)")

DEMO = """demo_all AS (
  SELECT c_custkey AS user_id, CAST(floor(c_acctbal / 80) AS int) AS age,
    CASE WHEN c_mktsegment IN ('BUILDING', 'AUTOMOBILE') THEN 'm' WHEN c_mktsegment <> 'MACHINERY' THEN 'f' END AS gender,
    c_mktsegment AS language
  FROM customer),
demo AS (
  SELECT user_id, age, CASE WHEN gender = 'm' THEN 1 ELSE 0 END AS is_male
  FROM demo_all WHERE age > 4 AND age < 117)"""

GAMES = """plays AS (
  SELECT user_id, unnest(CAST(string_split(gameId, ',') AS int[])) AS game_id FROM sess),
counts AS (SELECT user_id, game_id, count(*) AS plays FROM plays GROUP BY user_id, game_id),
props AS (
  SELECT *, CAST(sum(plays) OVER u AS bigint) AS total_plays,
    CAST(plays AS double) / sum(plays) OVER u AS proportion
  FROM counts WINDOW u AS (PARTITION BY user_id))"""

SESSION_FEATURES = f"""{FIRST},
{_last5('left')},
{HOURS},
session_features AS (
  SELECT user_id, first_recorded_lpi, {', '.join(_SLOTS)}, length_of_session_avgs, hour_avg, hour_std
  FROM first_lpi JOIN last5 USING (user_id) JOIN lengths USING (user_id) JOIN hour_stats USING (user_id)
  WHERE first_recorded_lpi IS NOT NULL)"""

MATRIX = f"""{SUBS},
{CHURN},
{SUBS_FEATURES},
{PLAY},
{SESSION_FEATURES},
{WEEKS},
{POISON},
{DEMO},
m1 AS (SELECT * FROM subs_features JOIN session_features USING (user_id)),
m2 AS (SELECT * FROM m1 JOIN variety USING (user_id)),
m3 AS (SELECT * FROM m2 JOIN demo USING (user_id))"""


def _round(*names: str) -> str:
    return ", ".join(f"round({n}, 6) AS {n}" for n in names)


_GV = ("gv_max", "gv_avg", "gv_std_dev")
_SESSION_COLUMNS = ("first_recorded_lpi", *_SLOTS, "length_of_session_avgs", "hour_avg", "hour_std")

_FEATURES = ("workout_day", "gameplay_day", "prior_churn_count", *_SESSION_COLUMNS, *_GV, "age", "is_male")
_MATRIX_ROWS = f"""WITH {MATRIX} SELECT user_id, churned, prior_churn_count, age, is_male,
  {_round('workout_day', 'gameplay_day', *_SESSION_COLUMNS, *_GV)} FROM m3"""

_GAME_MATRIX = (f"WITH {PLAY}, {GAMES} SELECT user_id, "
    + ", ".join(f"round(coalesce(max(CASE WHEN game_id = {g} THEN proportion END), 0.0), 6) AS game_{g}" for g in range(100))
    + " FROM props GROUP BY user_id")

_FUNNEL = f"""WITH {MATRIX}
  SELECT 1 AS step, 'subs' AS side, count(DISTINCT user_id) AS users FROM subs_features
  UNION ALL SELECT 1, 'sessions', count(DISTINCT user_id) FROM session_features
  UNION ALL SELECT 2, 'matrix', count(DISTINCT user_id) FROM m1
  UNION ALL SELECT 2, 'variety', count(DISTINCT user_id) FROM variety
  UNION ALL SELECT 3, 'matrix', count(DISTINCT user_id) FROM m2
  UNION ALL SELECT 3, 'demographics', count(DISTINCT user_id) FROM demo
  UNION ALL SELECT 4, 'matrix', count(DISTINCT user_id) FROM m3"""

# Hash rank of users within their label, as in the stratified split.
SPLIT = f"""{SUBS},
{CHURN},
digests AS (SELECT user_id, churned, md5(concat_ws('-', CAST(user_id AS varchar), '42')) AS digest FROM kept),
ranks AS (
  SELECT user_id, churned, digest, row_number() OVER (PARTITION BY churned ORDER BY digest, user_id) AS r,
    count(*) OVER (PARTITION BY churned) AS n
  FROM digests)"""

RULES = f"""{SUBS},
{CHURN},
facts AS (SELECT user_id, count(*) AS orders, max(gameplay_day) AS latest FROM subs GROUP BY user_id),
predicted AS (
  SELECT 'few_orders' AS model, churned AS label, CASE WHEN orders < 9 THEN 1 ELSE 0 END AS prediction
  FROM kept JOIN facts USING (user_id)
  UNION ALL
  SELECT 'always' AS model, churned AS label, 1 AS prediction FROM kept
  UNION ALL
  SELECT 'never' AS model, churned AS label, 0 AS prediction FROM kept),
cells AS (
  SELECT model, count_if(label = 1 AND prediction = 1) AS tp, count_if(label = 0 AND prediction = 1) AS fp,
    count_if(label = 1 AND prediction = 0) AS fn, count_if(label = 0 AND prediction = 0) AS tn
  FROM predicted GROUP BY model),
scored AS (
  SELECT model, CAST(tp AS bigint) AS tp, CAST(fp AS bigint) AS fp, CAST(fn AS bigint) AS fn, CAST(tn AS bigint) AS tn,
    round(CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp::double / (tp + fp) END, 6) AS precision,
    round(CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp::double / (tp + fn) END, 6) AS recall,
    round((tp + tn)::double / (tp + fp + fn + tn), 6) AS accuracy,
    round((CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp::double / (tp + fn) END
      + CASE WHEN tn + fp = 0 THEN 0.0 ELSE tn::double / (tn + fp) END) / 2, 6) AS auc,
    round((fp + fn)::double / (tp + fp + fn + tn), 6) AS mse
  FROM cells)"""


def all_oracles() -> dict[str, str]:
    return {
        "churn_label": f"WITH {SUBS}, {CHURN} SELECT user_id, rid, date, day_gap, churned FROM kept",
        "day_gap": f"WITH {SUBS}, {CHURN} SELECT user_id, rid, date, day_gap, churned FROM flags",
        "churn_counts": f"""WITH {SUBS}, {CHURN}
            SELECT user_id, max(f.churned) AS ever_churned, max(k.churn_count) AS churn_count,
              max(k.prior_churn_count) AS prior_churn_count
            FROM flags f JOIN kept k USING (user_id) GROUP BY user_id""",
        "keep_one_row": f"""WITH {SUBS}, f AS (SELECT *, CAST(state = 'free' AS int) AS churned FROM subs)
            SELECT user_id, rid, date, churned FROM f
            QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY churned DESC, date DESC, rid DESC) = 1""",
        "subs_state_onehot": f"""WITH {SUBS} SELECT user_id, rid, CAST(state = 'subs' AS int) AS is_subs_acct,
            CAST(state = 'free' AS int) AS is_free, CAST(state = 'trial' AS int) AS is_trial FROM subs""",
        "impute_median_subs": f"""WITH {SUBS}, {CHURN},
            med AS (SELECT median(workout_day) w, median(gameplay_day) g, median(day_gap) d FROM kept)
            SELECT user_id, CAST(coalesce(workout_day, w) AS double) AS workout_day,
              CAST(coalesce(gameplay_day, g) AS double) AS gameplay_day,
              CAST(coalesce(day_gap, d) AS double) AS day_gap FROM kept, med""",
        "impute_median_by_state": f"""WITH {SUBS},
            med AS (SELECT state, median(gameplay_day) g FROM subs GROUP BY state)
            SELECT user_id, rid, state, CAST(coalesce(gameplay_day, g) AS double) AS gameplay_day
            FROM subs JOIN med USING (state)""",
        "subs_features": f"WITH {SUBS}, {CHURN}, {SUBS_FEATURES} SELECT * FROM subs_features",
        "lpi_first": f"WITH {HISTORY}, {FIRST} SELECT * FROM first_lpi",
        "lpi_delta": f"WITH {HISTORY}, {DELTAS} SELECT user_id, rid, {_round('delta')} FROM deltas",
        "lpi_last5_list": f"""WITH {HISTORY}, {DELTAS}
            SELECT user_id, string_agg(coalesce(CAST(CAST(round(delta * 100) AS bigint) AS varchar), '-'), ' ' ORDER BY rn) AS cents
            FROM deltas WHERE rn > n - 5 GROUP BY user_id""",
        "lpi_last5_left": f"WITH {HISTORY}, {_last5('left')} SELECT user_id, {_round(*_SLOTS)} FROM last5",
        "lpi_last5_right": f"WITH {HISTORY}, {_last5('right')} SELECT user_id, {_round(*_SLOTS)} FROM last5",
        "lpi_impute_median": f"""WITH {HISTORY}, med AS (SELECT median(lpi) m FROM sess)
            SELECT user_id, rid, round(coalesce(lpi, m), 6) AS lpi FROM sess, med""",
        "session_length_avg": f"WITH {PLAY}, {HOURS} SELECT user_id, {_round('length_of_session_avgs')} FROM lengths",
        "hour_stats": f"WITH {PLAY}, {HOURS} SELECT user_id, {_round('hour_avg', 'hour_std')} FROM hour_stats",
        "user_games_string": f"""WITH {PLAY},
            numbered AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY date, rid) AS pos FROM sess)
            SELECT user_id, CAST((pos - 1) // 10000 AS bigint) AS segment,
              string_agg(gameId, ',' ORDER BY pos) AS games
            FROM numbered GROUP BY user_id, (pos - 1) // 10000""",
        "session_features": f"WITH {PLAY}, {SESSION_FEATURES} SELECT user_id, {_round(*_SESSION_COLUMNS)} FROM session_features",
        "variety_poison": f"WITH {WEEKS}, {POISON} SELECT user_id, {_round(*_GV)} FROM variety",
        "variety_skip": f"WITH {WEEKS}, {_variety('count(gameVariety) > 0')} SELECT user_id, {_round(*_GV)} FROM variety",
        "variety_features": f"WITH {WEEKS}, {POISON} SELECT user_id, {_round(*_GV)} FROM variety",
        "variety_no_future_weeks": f"""WITH {WEEKS},
            {_variety('count(gameVariety) = count(*)', "WHERE weekOfYear <= weekofyear(DATE '2024-01-20')")}
            SELECT user_id, {_round(*_GV)} FROM variety""",
        "demo_onehot": f"WITH {DEMO} SELECT user_id, CASE WHEN gender = 'm' THEN 1 ELSE 0 END AS is_male FROM demo_all",
        "demo_age_filter": f"WITH {DEMO} SELECT * FROM demo_all WHERE age > 4 AND age < 117",
        "demo_features": f"WITH {DEMO} SELECT * FROM demo",
        "dedupe_rows": "SELECT DISTINCT user_id, CAST(ts AS date) AS date, event_type FROM events",
        "row_limit": f"WITH {SUBS} SELECT user_id, date, rid FROM subs ORDER BY user_id, date, rid LIMIT 100",
        "user_buckets": f"""WITH {SUBS}, b AS (
              SELECT user_id, CAST(CAST('0x' || substr(md5(concat_ws('-', CAST(user_id AS varchar), '0')), 1, 8) AS bigint) % 10 AS int)
                AS bucket FROM subs)
            SELECT bucket, count(*) AS n_rows, count(DISTINCT user_id) AS n_users FROM b GROUP BY bucket""",
        "game_counts": f"WITH {PLAY}, {GAMES} SELECT * FROM counts",
        "game_totals": f"WITH {PLAY}, {GAMES} SELECT user_id, max(total_plays) AS total_plays FROM props GROUP BY user_id",
        "game_proportions": f"WITH {PLAY}, {GAMES} SELECT user_id, game_id, plays, total_plays, {_round('proportion')} FROM props",
        "game_matrix": _GAME_MATRIX,
        "games_from_files": _GAME_MATRIX,
        "game_vectors": f"""WITH {PLAY}, {GAMES} SELECT user_id,
            string_agg(game_id || ':' || CAST(round(proportion * 1000000) AS bigint), ' ' ORDER BY game_id) AS millionths
            FROM props GROUP BY user_id""",
        "join_funnel": _FUNNEL,
        "matrix_job_funnel": _FUNNEL,
        "matrix_job_rows": _MATRIX_ROWS,
        "data_matrix": _MATRIX_ROWS,
        "matrix_from_files": _MATRIX_ROWS,
        "assembled_matrix": f"""WITH {MATRIX} SELECT user_id, churned AS label, 17 AS n,
            round({' + '.join(_FEATURES)}, 4) AS total,
            concat_ws(' ', {', '.join(f'CAST(round({c} * 10000) AS bigint)' for c in _FEATURES)}) AS parts FROM m3""",
        "user_games_in_order": f"""WITH {PLAY}
            SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY date, rid) AS pos, gameId FROM sess""",
        "event_value_delta": """SELECT user_id, event_id AS rid,
            round(value - lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id), 6) AS delta FROM events""",
        "tables_by_user": f"""WITH {SUBS}, {HISTORY}
            SELECT user_id, n_rows, last_date, best_lpi
            FROM (SELECT user_id, count(*) AS n_rows, max(date) AS last_date FROM subs GROUP BY user_id)
            JOIN (SELECT user_id, max(lpi) AS best_lpi FROM sess GROUP BY user_id) USING (user_id)""",
        "game_index": f"""WITH {PLAY}, {GAMES} SELECT game_id, CAST(row_number() OVER (ORDER BY game_id) - 1 AS int) AS index
            FROM (SELECT DISTINCT game_id FROM counts)""",
        "indexed_game_vectors": f"""WITH {PLAY}, {GAMES},
            ix AS (SELECT game_id, row_number() OVER (ORDER BY game_id) - 1 AS i, count(*) OVER () AS n
              FROM (SELECT DISTINCT game_id FROM counts))
            SELECT user_id, CAST(max(n) AS int) AS size, string_agg(CAST(i AS varchar), ' ' ORDER BY i) AS places,
              string_agg(CAST(CAST(round(proportion * 1000000) AS bigint) AS varchar), ' ' ORDER BY i) AS millionths
            FROM props JOIN ix USING (game_id) GROUP BY user_id""",
        "good_rows": f"""WITH {SUBS} SELECT * FROM subs
            WHERE rid % 17 <> 0 AND rid % 11 <> 0 AND rid % 13 <> 0 AND rid % 19 <> 0""",
        "rejected_rows": f"""WITH {SUBS}, told AS (
              SELECT rid, concat_ws('; ', CASE WHEN rid % 17 = 0 THEN 'user_id: missing' END,
                CASE WHEN rid % 11 = 0 THEN 'date: not a date: soon' END,
                CASE WHEN rid % 13 = 0 THEN 'workout_day: not a whole number: day ' || workout_day END,
                CASE WHEN rid % 19 = 0 THEN 'gameplay_day: not a whole number: 2.5' END) AS reasons
              FROM subs)
            SELECT * FROM told WHERE reasons <> ''""",
        "funnel_from_sketches": f"""WITH {SUBS},
            a AS (SELECT DISTINCT user_id FROM subs WHERE date BETWEEN DATE '1995-01-01' AND DATE '2024-01-10'),
            b AS (SELECT DISTINCT user_id FROM events WHERE CAST(ts AS date) BETWEEN DATE '1995-01-01' AND DATE '2024-01-10'),
            d AS (SELECT DISTINCT c_custkey AS user_id FROM customer),
            m AS (SELECT user_id FROM a INTERSECT SELECT user_id FROM b)
            SELECT 1 AS step, 'subs' AS side, count(*) AS users FROM a
            UNION ALL SELECT 1, 'sessions', count(*) FROM b
            UNION ALL SELECT 2, 'matrix', count(*) FROM m
            UNION ALL SELECT 2, 'variety', count(*) FROM b
            UNION ALL SELECT 3, 'matrix', count(*) FROM m
            UNION ALL SELECT 3, 'demographics', count(*) FROM d
            UNION ALL SELECT 4, 'matrix', count(*) FROM (SELECT user_id FROM m INTERSECT SELECT user_id FROM d)""",
        "row_positions": f"""WITH {SUBS} SELECT user_id, rid AS order_id, row_number() OVER (ORDER BY rid) - 1 AS position
            FROM subs""",
        "tsv_texts": """SELECT doc_id, text, '  ' || lang || ' ' AS spaced, CASE WHEN doc_id % 3 = 0 THEN '' WHEN doc_id % 3 = 1
            THEN NULL ELSE '"' || source || '"' END AS odd FROM documents""",
        "union_files": f"WITH {DEMO} SELECT * FROM demo_all",
        "tsv_roundtrip": f"WITH {SUBS} SELECT * FROM subs",
        "stratified_split": f"""WITH {SPLIT}
            SELECT user_id, churned, CAST(r AS bigint) AS label_rank, r <= round(0.2 * n) AS is_test FROM ranks""",
        "hash_split": f"""WITH {SPLIT}
            SELECT user_id, churned,
              CAST('0x' || substr(digest, 1, 8) AS bigint) < 0.2 * 4294967296 AS is_test FROM ranks""",
        "stratified_folds": f"WITH {SPLIT} SELECT user_id, churned, CAST((r - 1) % 3 AS int) AS fold FROM ranks",
        "binary_metrics_of_rules": f"WITH {RULES} SELECT * FROM scored",
        "score_auc_of_rules": f"""WITH {SUBS}, {CHURN},
            facts AS (SELECT user_id, count(*) AS orders, max(gameplay_day) AS latest FROM subs GROUP BY user_id),
            scored AS (
              SELECT 'few_orders' AS model, churned AS label, CAST(-orders AS double) AS score FROM kept JOIN facts USING (user_id)
              UNION ALL SELECT 'late_month', churned, CAST(latest AS double) FROM kept JOIN facts USING (user_id)
              UNION ALL SELECT 'same', churned, 0.5 FROM kept JOIN facts USING (user_id)),
            placed AS (
              SELECT model, label, rank() OVER (PARTITION BY model ORDER BY score)
                + (count(*) OVER (PARTITION BY model, score) - 1) / 2.0 AS r
              FROM scored WHERE score IS NOT NULL),
            sums AS (
              SELECT model, count_if(label = 1) AS p, count_if(label = 0) AS n, sum(r) FILTER (WHERE label = 1) AS s
              FROM placed GROUP BY model)
            SELECT model, CAST(p AS bigint) AS positives, CAST(n AS bigint) AS negatives,
              round(CAST((s - p * (p + 1) / 2.0) AS double) / (p * n), 6) AS score_auc FROM sums""",
        "stump_scores": f"""WITH {SUBS}, {CHURN}, {DEMO},
            facts AS (
              SELECT user_id, CAST(state = 'free' AS int) AS free, workout_day AS f0, coalesce(gameplay_day, 0) AS f1,
                CASE WHEN gender = 'm' THEN 1 ELSE 0 END AS f2
              FROM kept JOIN demo_all USING (user_id)),
            long AS (
              SELECT 0 AS f, f0 AS v, free FROM facts UNION ALL SELECT 1, f1, free FROM facts
              UNION ALL SELECT 2, f2, free FROM facts),
            per AS (SELECT f, v, count(*) AS n, sum(free) AS y FROM long GROUP BY f, v),
            cum AS (
              SELECT f, v, sum(n) OVER a AS nl, sum(y) OVER a AS yl, sum(n) OVER t AS n, sum(y) OVER t AS y
              FROM per WINDOW a AS (PARTITION BY f ORDER BY v), t AS (PARTITION BY f)),
            cut AS (
              SELECT f, v, CAST(yl AS double) / nl AS pl, CAST(y - yl AS double) / (n - nl) AS pr, CAST(y AS double) / n AS p0
              FROM cum WHERE nl < n
              ORDER BY nl * (CAST(yl AS double) / nl) * (1 - CAST(yl AS double) / nl)
                + (n - nl) * (CAST(y - yl AS double) / (n - nl)) * (1 - CAST(y - yl AS double) / (n - nl)), f, v LIMIT 1),
            side AS (
              SELECT user_id, CASE WHEN CASE f WHEN 0 THEN f0 WHEN 1 THEN f1 ELSE f2 END <= v THEN pl ELSE pr END AS p,
                CASE WHEN (pl > 0.5) = (pr > 0.5) THEN p0 ELSE p END AS q
              FROM facts, cut)
            -- Classification trees take back a split whose sides say the same.
            SELECT user_id, round(2 * p - 1, 6) AS margin, round(q, 6) AS share, round(ln(q / (1 - q)) / 2, 6) AS vote FROM side""",
        "logit_gradient": "SELECT unnest(["
        + ", ".join(f"'{n}'" for n in ("intercept", *[f"coefficient:{c}" for c in _FEATURES]))
        + "]) AS item, 0.0::double AS gradient",
        "best_rule": f"WITH {RULES} SELECT * FROM scored ORDER BY recall DESC, model LIMIT 1",
    }
