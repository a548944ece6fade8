"""DuckDB SQL for every registered query: the independent check of the Spark plans.

The binding (``podium.plans.bindings``) is written once more here in plain SQL;
event dates come straight from the order date instead of re-parsing the text,
so the Spark date parser is checked against the source values.
"""

from __future__ import annotations

from podium import constants as K
from podium.plans import bindings as B

W1_LO, W1_HI = B.WINDOWS["final"]
W2_LO, W2_HI = B.WINDOWS["championship"]


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


BINDING = r"""
li AS (
  SELECT l_orderkey,
         max(CASE WHEN l_linenumber = 1 THEN l_quantity END) * 2 AS m_skeet,
         max(CASE WHEN l_linenumber = 2 THEN l_quantity END) * 2 AS m_lane,
         max(CASE WHEN l_linenumber = 3 THEN l_quantity END) * 2 AS m_trap,
         max(CASE WHEN l_linenumber = 4 THEN l_quantity END) * 2 AS m_boar,
         max(CASE WHEN l_linenumber = 5 THEN l_quantity END) * 2 AS m_buck
  FROM lineitem WHERE l_linenumber BETWEEN 1 AND 5 GROUP BY l_orderkey
),
ob AS (
  SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_totalprice, o.o_orderpriority,
         CAST(o.o_orderdate AS DATE) AS d, c.c_name, n.n_name, n.n_regionkey
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
),
od AS (
  SELECT *,
    CASE o_orderkey % 4
      WHEN 0 THEN strftime(d, '%d.%m.%Y')
      WHEN 1 THEN strftime(d, '%Y-%m-%d')
      WHEN 2 THEN CASE WHEN day(d) <= 27 THEN strftime(d, '%d') || '-' || strftime(d + INTERVAL 1 DAY, '%d.%m.%Y')
                       ELSE strftime(d, '%d.%m.%Y') END
      ELSE strftime(d, '%d.%m') || '-' || strftime(d + INTERVAL 1 MONTH, '%d.%m.%Y')
    END AS date_text,
    CASE o_orderkey % 4
      WHEN 3 THEN make_date(year(d + INTERVAL 1 MONTH), month(d), day(d))
      ELSE d END AS d1,
    CASE o_orderkey % 4
      WHEN 2 THEN CASE WHEN day(d) <= 27 THEN CAST(d + INTERVAL 1 DAY AS DATE) END
      WHEN 3 THEN CAST(d + INTERVAL 1 MONTH AS DATE)
    END AS d2,
    o_orderpriority || ' ' || strftime(d, '%Y-%m') AS event_name,
    'Range ' || CAST(n_regionkey AS VARCHAR) AS venue,
    'u/' || CAST(o_orderkey AS VARCHAR) AS results_url
  FROM ob
),
results AS (
  SELECT od.o_orderkey AS row_seq, CAST(1 + (o_custkey + o_orderkey) % 2 AS INTEGER) AS table_no,
         c_name AS player, o_orderstatus AS klass, n_name AS district,
         CAST(o_orderkey % 100 + 1 AS DOUBLE) AS lp,
         li.m_skeet, li.m_lane, li.m_trap, li.m_boar, li.m_buck,
         li.m_skeet + li.m_lane + li.m_trap AS sub_shot, li.m_boar + li.m_buck AS sub_rifle,
         CAST(floor(o_totalprice / 1000) AS DOUBLE) AS score,
         regexp_extract(date_text, '(20\d{2})', 1) AS season,
         event_name, date_text, venue, results_url, d, d1, d2
  FROM od LEFT JOIN li ON li.l_orderkey = od.o_orderkey
),
events_b AS (
  SELECT regexp_extract(date_text, '(20\d{2})', 1) AS season,
         CAST(year(d) - 1994 AS INTEGER) AS schedule_table_no,
         CAST(o_orderkey AS VARCHAR) AS schedule_lp, event_name, n_name AS organizer, venue, date_text,
         results_url, o_orderkey, d, d1, d2
  FROM od
)
"""


def _in(lo: str, hi: str, a: str = "d1", b: str = "d2") -> str:
    return (f"(({a} BETWEEN DATE '{lo}' AND DATE '{hi}') OR "
            f"(coalesce({b} BETWEEN DATE '{lo}' AND DATE '{hi}', false)))")


def _band(points: str, category: str) -> str:
    def chain(steps):
        parts = " ".join(f"WHEN {points} >= {float(lo)} THEN {_q(lbl)}" for lo, lbl in steps)
        return f"CASE {parts} ELSE '' END"
    return (f"CASE WHEN {points} IS NULL THEN '' WHEN upper(trim({category})) = 'K' "
            f"THEN {chain(K.AWARD_LADDERS['K'])} ELSE {chain(K.AWARD_LADDERS['*'])} END")


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join([BINDING.strip(), *ctes]) + "\n"


def half_even(expr: str, digits: int) -> str:
    scale = float(10 ** digits)
    return f"(round_even(({expr}) * {scale}, 0) / {scale})"


AVERAGE_BOARD = _with(f"""
b AS (SELECT player, district, {half_even('avg(score)', 2)} AS mean_score, sum(score) AS total_score,
             count(score) AS starts, max(score) AS best_score, min(score) AS worst_score
      FROM results WHERE score IS NOT NULL GROUP BY player, district)""") + """
SELECT row_number() OVER (ORDER BY mean_score DESC NULLS LAST, best_score DESC NULLS LAST, starts DESC NULLS LAST,
       total_score DESC NULLS LAST, player, district) AS place, * FROM b"""

AWARD_CTES = f"""
s AS (SELECT *, CASE WHEN table_no = 1 THEN 'K' ELSE 'M' END AS category FROM results WHERE score IS NOT NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY player, district, category ORDER BY score DESC, row_seq) AS rn FROM s),
aw AS (SELECT player, district, category, sum(score) AS sum_top3, count(score) AS counted, max(score) AS best_score,
              max(CASE WHEN rn = 2 THEN score END) AS second_score, max(CASE WHEN rn = 3 THEN score END) AS third_score,
              string_agg(event_name, ' | ' ORDER BY rn) AS events_counted
       FROM r WHERE rn <= 3 GROUP BY player, district, category)"""

AWARD_BOARD = _with(AWARD_CTES) + f"""
SELECT row_number() OVER (ORDER BY sum_top3 DESC NULLS LAST, best_score DESC NULLS LAST, counted DESC NULLS LAST,
       player, district, category) AS place,
       player, district, category, sum_top3, counted, best_score, second_score, third_score, events_counted,
       {_band('sum_top3', 'category')} AS award
FROM aw"""

TEAM_CTES = f"""
p AS (SELECT district, player, {half_even('avg(score)', 2)} AS player_mean, count(score) AS starts,
             max(score) AS best_score, sum(score) AS total_score
      FROM results WHERE score IS NOT NULL GROUP BY district, player),
pr AS (SELECT *, row_number() OVER (PARTITION BY district ORDER BY player_mean DESC NULLS LAST,
              best_score DESC NULLS LAST, starts DESC NULLS LAST, total_score DESC NULLS LAST, player) AS rank_in_district
       FROM p),
top6 AS (SELECT * FROM pr WHERE rank_in_district <= 6)"""

TEAM_MEMBERS = _with(TEAM_CTES) + "SELECT * FROM top6"

TEAM_BOARD = _with(TEAM_CTES, """
tb AS (SELECT district, CAST(sum(CAST(round_even(player_mean * 100, 0) AS BIGINT)) AS BIGINT) AS h, count(player) AS members,
       """ + ", ".join(f"max(CASE WHEN rank_in_district = {k} THEN player END) AS player_{k}" for k in range(1, 7)) + """
       FROM top6 GROUP BY district)""") + """
SELECT row_number() OVER (ORDER BY round_even(h / members, 0) / 100 DESC, members DESC, h / 100 DESC, district) AS place,
       district, round_even(h / members, 0) / 100 AS team_mean, members, h / 100 AS team_sum,
       player_1, player_2, player_3, player_4, player_5, player_6
FROM tb"""

STARTS_CTES = """
sc AS (SELECT * FROM results WHERE score IS NOT NULL),
eb AS (SELECT event_name, max(score) AS event_best FROM sc WHERE score > 0 GROUP BY event_name),
bs AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY player, district, event_name
                       ORDER BY score DESC, row_seq) AS rn0 FROM sc) WHERE rn0 = 1)"""

EVENT_BEST = _with(STARTS_CTES) + "SELECT * FROM eb"

BEST_START_PER_EVENT = _with(STARTS_CTES) + """
SELECT player, district, event_name, row_seq, score, date_text, results_url FROM bs"""

STARTS = _with(STARTS_CTES) + f"""
SELECT bs.player, bs.district, bs.event_name, bs.score, eb.event_best,
       {half_even('bs.score / eb.event_best * 100', 1)} AS pct_of_best, bs.klass, bs.date_text, bs.venue,
       bs.results_url, bs.m_skeet, bs.m_lane, bs.m_trap, bs.m_boar, bs.m_buck
FROM bs LEFT JOIN eb ON bs.event_name = eb.event_name"""

def _qual_chain(bs: str) -> str:
    """Window ranks, both boards and their places over the deduped starts CTE ``bs``."""
    return f"""fl AS (SELECT player, district, event_name, score, date_text,
              {_in(W1_LO, W1_HI)} AS f1, {_in(W2_LO, W2_HI)} AS f2 FROM {bs}),
w1 AS (SELECT *, row_number() OVER (PARTITION BY player, district ORDER BY score DESC, date_text, event_name) AS rn
       FROM fl WHERE f1),
w2 AS (SELECT *, row_number() OVER (PARTITION BY player, district ORDER BY score DESC, date_text, event_name) AS rn
       FROM fl WHERE f2),
r1 AS (SELECT player, district,
              sum(CASE WHEN rn <= 3 THEN score END) AS sum_top3,
              sum(CASE WHEN rn <= 5 THEN score END) AS s5,
              count(CASE WHEN rn <= 5 THEN 1 END) AS counted,
              count(*) AS starts,
              {", ".join(f"max(CASE WHEN rn = {k} THEN score END) AS best_{k}" for k in range(1, 6))},
              string_agg(CASE WHEN rn <= 3 THEN event_name END, ' | ' ORDER BY rn) AS events_top3,
              string_agg(event_name, ' | ' ORDER BY rn) AS all_starts
       FROM w1 GROUP BY player, district),
q1 AS (SELECT row_number() OVER (ORDER BY sum_top3 DESC, best_1 DESC, starts DESC, player, district) AS place,
              *, {half_even('sum_top3 / least(counted, 3)', 2)} AS mean_top3,
              {half_even('s5 / counted', 2)} AS mean_top5_first FROM r1),
r2 AS (SELECT player, district,
              sum(score) AS champ_sum_top5, count(*) AS champ_counted, max(score) AS cbest,
              {", ".join(f"max(CASE WHEN rn = {k} THEN score END) AS champ_best_{k}" for k in range(1, 6))},
              string_agg(event_name, ' | ' ORDER BY rn) AS champ_events
       FROM w2 WHERE rn <= 5 GROUP BY player, district),
q2 AS (SELECT row_number() OVER (ORDER BY champ_sum_top5 DESC, cbest DESC, champ_counted DESC, player, district)
              AS champ_place, *, {half_even('champ_sum_top5 / champ_counted', 2)} AS champ_mean_top5 FROM r2)"""


QUAL_CTES = STARTS_CTES + ",\n" + _qual_chain("bs")

QB_SELECT = """
SELECT q1.place, coalesce(q1.player, q2.player) AS player, coalesce(q1.district, q2.district) AS district,
       q1.sum_top3, q1.mean_top3, q1.mean_top5_first, q1.counted, q1.starts,
       q1.best_1, q1.best_2, q1.best_3, q1.best_4, q1.best_5,
       q2.champ_place, q2.champ_sum_top5, q2.champ_mean_top5, q2.champ_counted,
       q2.champ_best_1, q2.champ_best_2, q2.champ_best_3, q2.champ_best_4, q2.champ_best_5,
       q1.events_top3, q2.champ_events, q1.all_starts
FROM q1 FULL OUTER JOIN q2 ON q1.player = q2.player AND q1.district = q2.district"""

QUALIFICATION_BOARD = _with(QUAL_CTES) + QB_SELECT

CHAMPIONSHIP_BOARD = _with(QUAL_CTES) + """
SELECT champ_place AS place, player, district, champ_sum_top5 AS sum_top, champ_counted AS counted,
       cbest AS best_score, champ_best_1 AS best_1, champ_best_2 AS best_2, champ_best_3 AS best_3,
       champ_best_4 AS best_4, champ_best_5 AS best_5, champ_events AS events_counted, champ_mean_top5 AS mean_top
FROM q2"""

WINDOW_MEMBERSHIP = _with() + f"""
SELECT results_url, 'final' AS window_id FROM results WHERE {_in(W1_LO, W1_HI)}
UNION ALL
SELECT results_url, 'championship' AS window_id FROM results WHERE {_in(W2_LO, W2_HI)}"""

_lo, _hi = min(W1_LO, W2_LO), max(W1_HI, W2_HI)
EVENTS_IN_PERIOD = _with() + f"""
SELECT season, schedule_table_no, schedule_lp, event_name, organizer, venue, date_text, results_url,
       CASE WHEN d2 IS NULL THEN strftime(d1, '%Y-%m-%d')
            ELSE strftime(d1, '%Y-%m-%d') || ', ' || strftime(d2, '%Y-%m-%d') END AS dates_iso
FROM events_b WHERE {_in(_lo, _hi)}"""

PERIOD_POSITIONS = f"""
SELECT row_number() OVER (ORDER BY date_text NULLS LAST, event_name NULLS LAST, results_url NULLS LAST) AS position, *
FROM ({EVENTS_IN_PERIOD})"""

# event names are upper-case ASCII: their collated order is that of their bytes once digit runs have equal width
SORTED_EVENTS = f"""
SELECT row_number() OVER (ORDER BY event_name DESC, date_text, results_url) AS position, *
FROM ({EVENTS_IN_PERIOD})"""

CRAWL_ORDER = _with() + """
SELECT row_number() OVER (ORDER BY season DESC NULLS LAST, date_text NULLS LAST, event_name NULLS LAST,
                                   results_url NULLS LAST) AS event_seq,
       season, date_text, event_name, results_url FROM events_b"""

PARSED_DATES = _with() + """
SELECT results_url, date_text,
       CASE WHEN d2 IS NULL THEN strftime(d1, '%Y-%m-%d')
            ELSE strftime(d1, '%Y-%m-%d') || ', ' || strftime(d2, '%Y-%m-%d') END AS dates_iso,
       season
FROM events_b"""


_WS_CLASS = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def clean(expr: str) -> str:
    return f"trim(regexp_replace({expr}, '{_WS_CLASS}', ' ', 'g'))"


def coerce(expr: str) -> str:
    pat = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
    return (f"(CASE WHEN regexp_matches({expr}, '{pat}') AND isfinite(TRY_CAST(trim({expr}) AS DOUBLE)) "
            f"THEN TRY_CAST(trim({expr}) AS DOUBLE) END)")


SE = B.SUPPLEMENT_EVENT
SUPP_CTES = rf"""
sraw AS (
  SELECT event_id AS row_seq,
         CASE WHEN event_id % 3 = 0
              THEN chr(160) || 'Customer#' || lpad(CAST(user_id * {B.SUPPLEMENT_PLAYER_STRIDE} AS VARCHAR), 9, '0') || ' ' || chr(9) || ' '
              ELSE 'Customer#' || lpad(CAST(user_id * {B.SUPPLEMENT_PLAYER_STRIDE} AS VARCHAR), 9, '0') END AS player_raw,
         'P' AS klass,
         regexp_extract(props, '"k":\s*(\d+)', 1) AS m_skeet_raw,
         CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) || CASE WHEN event_id % 10 = 0 THEN 'd' ELSE '' END AS score_raw
  FROM events WHERE event_type = 'purchase'),
known AS (SELECT DISTINCT {clean('player')} AS player FROM results
          WHERE lower(trim(district)) = {_q(B.SUPPLEMENT_DISTRICT)}),
supp AS (
  SELECT CAST(row_seq + {1 << 62} AS BIGINT) AS row_seq, p AS player, klass,
         {coerce('m_skeet_raw')} AS m_skeet, CAST(NULL AS DOUBLE) AS m_trap, CAST(NULL AS DOUBLE) AS m_lane,
         CAST(NULL AS DOUBLE) AS m_buck, CAST(NULL AS DOUBLE) AS m_boar, {coerce('score_raw')} AS score,
         {_q(B.SUPPLEMENT_DISTRICT_LABEL)} AS district, CAST(2 AS INTEGER) AS table_no, {_q(SE['season'])} AS season,
         {_q(SE['event_name'])} AS event_name, {_q(SE['date_text'])} AS date_text, {_q(SE['venue'])} AS venue,
         {_q(SE['results_url'])} AS results_url
  FROM (SELECT *, {clean('player_raw')} AS p FROM sraw) WHERE p IN (SELECT player FROM known)),
un AS (
  SELECT row_seq, table_no, player, klass, district, lp, m_skeet, m_lane, m_trap, m_boar, m_buck, sub_shot, sub_rifle,
         score, season, event_name, date_text, venue, results_url FROM results
  UNION ALL BY NAME SELECT * FROM supp)"""

SUPPLEMENT_KNOWN_PLAYERS = _with(SUPP_CTES) + "SELECT * FROM supp"
SUPPLEMENT_UNION = _with(SUPP_CTES) + "SELECT * FROM un"

EWS_CTES = f"""
ev_all AS (
  SELECT season, schedule_table_no, schedule_lp, event_name, organizer, venue, date_text, results_url,
         CASE WHEN d2 IS NULL THEN strftime(d1, '%Y-%m-%d')
              ELSE strftime(d1, '%Y-%m-%d') || ', ' || strftime(d2, '%Y-%m-%d') END AS dates_iso
  FROM events_b WHERE {_in(_lo, _hi)}
  UNION ALL
  SELECT {_q(SE['season'])}, CAST(NULL AS INTEGER), {_q(SE['schedule_lp'])}, {_q(SE['event_name'])},
         {_q(SE['organizer'])}, {_q(SE['venue'])}, {_q(SE['date_text'])}, {_q(SE['results_url'])}, {_q(SE['date_text'])}),
dst AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY player, district, event_name ORDER BY score DESC, row_seq) AS rn0
                       FROM un WHERE score IS NOT NULL AND lower(trim(district)) = {_q(B.SUPPLEMENT_DISTRICT)}) WHERE rn0 = 1)"""

EVENTS_WITH_STARTS = _with(SUPP_CTES, EWS_CTES) + """
SELECT * FROM ev_all WHERE results_url IN (SELECT results_url FROM dst WHERE results_url IS NOT NULL)"""

_CODES = [d[0] for d in K.DISCIPLINES]
_LABEL = "CASE code " + " ".join(f"WHEN '{c}' THEN {_q(lbl)}" for c, lbl, _ in K.DISCIPLINES) + " END"
_MAX = "CASE code " + " ".join(f"WHEN '{c}' THEN CAST({mx} AS DOUBLE)" for c, _, mx in K.DISCIPLINES) + " END"
_ORD = "CASE code " + " ".join(f"WHEN '{c}' THEN {i + 1}" for i, c in enumerate(_CODES)) + " END"

PROFILE_CTES = STARTS_CTES + f""",
st AS (SELECT bs.player, bs.district, bs.event_name, bs.score, eb.event_best,
              {half_even('bs.score / eb.event_best * 100', 1)} AS pct_of_best, bs.date_text,
              bs.m_skeet, bs.m_lane, bs.m_trap, bs.m_boar, bs.m_buck
       FROM bs LEFT JOIN eb ON bs.event_name = eb.event_name),
ps AS (SELECT *, row_number() OVER (PARTITION BY trim(player) ORDER BY score DESC NULLS LAST, district, event_name) AS pos
       FROM (SELECT * REPLACE (trim(player) AS player) FROM st WHERE trim(coalesce(player, '')) <> '')),
lng AS ({" UNION ALL ".join(f"SELECT player, pos, '{c}' AS code, CAST({c} AS DOUBLE) AS value FROM ps" for c in _CODES)}),
dl AS (SELECT player, pos, code, {_LABEL} AS label, value, {_MAX} AS max_score, {_ORD} AS disc_ord
       FROM lng WHERE value > 0),
dr AS (SELECT *, row_number() OVER (PARTITION BY player, code ORDER BY pos DESC) AS rn_desc FROM dl),
dp AS (SELECT player, code, label, disc_ord, count(value) AS starts, avg(value) AS mean, max(value) AS best,
              max(CASE WHEN rn_desc = 1 THEN value END) AS last,
              avg(value) / max_score * 100 AS mean_pct, max_score - avg(value) AS gap_to_max,
              greatest(CAST(0 AS DOUBLE), max(value) - avg(value)) AS reserve_to_best,
              avg(CASE WHEN rn_desc <= 3 THEN value END) - avg(CASE WHEN rn_desc > 3 THEN value END) AS trend
       FROM dr GROUP BY player, code, label, disc_ord, max_score),
refs AS (SELECT player, pos, coalesce(event_name, '') AS event, coalesce(date_text, '') AS date,
                CASE WHEN score > 0 THEN score END AS score, CASE WHEN event_best > 0 THEN event_best END AS event_best,
                coalesce(pct_of_best, (CASE WHEN score > 0 THEN score END) / (CASE WHEN event_best > 0 THEN event_best END) * 100) AS pct
         FROM ps),
refs2 AS (SELECT * FROM refs WHERE score IS NOT NULL AND event_best IS NOT NULL AND pct IS NOT NULL)"""


def _fmt1(x: str) -> str:
    r = f"(round_even(({x}) * 10.0, 0) / 10.0)"
    return (f"(CASE WHEN {r} = floor({r}) THEN CAST(CAST(floor({r}) AS BIGINT) AS VARCHAR) "
            f"ELSE replace(CAST({r} AS VARCHAR), '.', ',') END)")


DISCIPLINE_LONG = _with(PROFILE_CTES) + "SELECT * FROM dl"
DISCIPLINE_PROFILE = _with(PROFILE_CTES) + "SELECT * FROM dp"
EVENT_REFS = _with(PROFILE_CTES) + """
SELECT *, row_number() OVER (PARTITION BY player ORDER BY pct, pos) AS ref_ord FROM refs2"""
WEAKEST_DISCIPLINE = _with(PROFILE_CTES, f"""
wk AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY player ORDER BY mean_pct, -gap_to_max, disc_ord) AS r
                      FROM dp) WHERE r = 1),
agg AS (SELECT player, sum(gap_to_max ORDER BY mean_pct, -gap_to_max, disc_ord) AS overall_gap,
               sum(mean_pct ORDER BY mean_pct, -gap_to_max, disc_ord) / count(*) AS mean_pct
        FROM dp GROUP BY player),
cnt AS (SELECT player, count(*) AS starts FROM ps GROUP BY player),
ep AS (SELECT player, CAST(sum(CAST(round_even(pct * 10, 0) AS BIGINT)) AS DOUBLE) / count(pct) / 10 AS mean_event_pct
       FROM refs2 GROUP BY player),
ws AS (SELECT wk.player, cnt.starts, wk.code AS weakest_code, wk.label AS weakest_label, wk.mean AS weakest_mean,
              wk.mean_pct AS weakest_mean_pct, wk.gap_to_max AS weakest_gap, wk.reserve_to_best AS weakest_reserve,
              wk.trend AS weakest_trend,
              CASE WHEN wk.trend IS NULL THEN {_q(K.TREND_TOO_FEW)}
                   WHEN wk.trend > 0 THEN {_q(K.TREND_PREFIX + '+')} || {_fmt1('wk.trend')} || {_q(K.TREND_UNIT)}
                   WHEN wk.trend < 0 THEN {_q(K.TREND_PREFIX)} || {_fmt1('wk.trend')} || {_q(K.TREND_UNIT)}
                   ELSE {_q(K.TREND_FLAT)} END AS trend_text,
              agg.overall_gap, agg.mean_pct, ep.mean_event_pct
       FROM wk JOIN agg ON wk.player = agg.player LEFT JOIN cnt ON wk.player = cnt.player
       LEFT JOIN ep ON wk.player = ep.player)""") + """
SELECT row_number() OVER (ORDER BY weakest_mean_pct, -overall_gap, player) AS report_rank, * FROM ws"""


BOARD_CTES = QUAL_CTES + ",\nqb AS (" + QB_SELECT + ")"
_BOARD_POS = "row_number() OVER (ORDER BY place NULLS LAST, champ_place NULLS LAST)"

REPORT_TOTALS = _with(BOARD_CTES) + f"""
SELECT 'players' AS metric, count(*) AS value FROM qb
UNION ALL SELECT 'starts', CAST(coalesce(sum(coalesce(starts, 0)), 0) AS BIGINT) FROM qb
UNION ALL SELECT 'events', count(*) FROM events_b WHERE {_in(_lo, _hi)}"""

TOP_SIX = _with(BOARD_CTES) + f"""
SELECT * FROM (SELECT {_BOARD_POS} AS position, player, place, champ_place, mean_top3 FROM qb) WHERE position <= 6"""

QUALIFICATION_FLAGS = _with(BOARD_CTES) + """
SELECT player, district, place, champ_place, coalesce(place <= 6, false) AS is_final,
       coalesce(champ_place <= 3, false) AS is_championship FROM qb"""

WEAKNESS_RANKS = f"SELECT report_rank, player, weakest_code, overall_gap FROM ({WEAKEST_DISCIPLINE})"

SORTED_BOARD = _with(BOARD_CTES) + f"""
SELECT row_number() OVER (ORDER BY (mean_top3 IS NULL), mean_top3 DESC, pos) AS position, * EXCLUDE (pos)
FROM (SELECT *, {_BOARD_POS} AS pos FROM qb)"""

SEARCH_QUERY = " 1-URGENT 1997 "
SEARCH_BOARD = _with(BOARD_CTES) + f"""
SELECT * FROM qb WHERE """ + " OR ".join(
    f"contains(lower(coalesce(CAST({k} AS VARCHAR), '')), {_q(SEARCH_QUERY.strip().lower())})"
    for k in ("player", "events_top3", "champ_events", "all_starts"))


STARTS_QUERY = " .03.1997 "
SEARCH_STARTS = _with(STARTS_CTES) + f"""
SELECT * FROM (
  SELECT bs.player, bs.district, bs.event_name, bs.score, eb.event_best,
         {half_even('bs.score / eb.event_best * 100', 1)} AS pct_of_best, bs.klass, bs.date_text, bs.venue,
         bs.results_url, bs.m_skeet, bs.m_lane, bs.m_trap, bs.m_boar, bs.m_buck
  FROM bs LEFT JOIN eb ON bs.event_name = eb.event_name)
WHERE """ + " OR ".join(f"contains(lower(coalesce({k}, '')), {_q(STARTS_QUERY.strip().lower())})"
                        for k in ("player", "event_name", "date_text"))

EVENTS_QUERY = "Nation_1"
SEARCH_EVENTS = _with() + f"""
SELECT season, schedule_table_no, schedule_lp, event_name, organizer, venue, date_text, results_url,
       CASE WHEN d2 IS NULL THEN strftime(d1, '%Y-%m-%d')
            ELSE strftime(d1, '%Y-%m-%d') || ', ' || strftime(d2, '%Y-%m-%d') END AS dates_iso
FROM events_b WHERE {_in(_lo, _hi)} AND (""" + " OR ".join(
    f"contains(lower(coalesce({k}, '')), {_q(EVENTS_QUERY.strip().lower())})"
    for k in ("event_name", "organizer", "date_text")) + ")"


def _json_val(col: str, kind: str) -> str:
    if kind == "double":
        v = (f"CASE WHEN isnan({col}) THEN '\"\"' WHEN abs({col}) < 9.0e18 AND {col} = floor({col}) "
             f"THEN CAST(CAST(floor({col}) AS BIGINT) AS VARCHAR) ELSE CAST({col} AS VARCHAR) END")
    elif kind == "int":
        v = f"CAST({col} AS VARCHAR)"
    else:
        v = f"CAST(to_json(CAST({col} AS VARCHAR)) AS VARCHAR)"
    return f"CASE WHEN {col} IS NULL THEN '\"\"' ELSE {v} END"


_QB_KINDS = [("place", "int"), ("player", "str"), ("district", "str"), ("sum_top3", "double"),
             ("mean_top3", "double"), ("mean_top5_first", "double"), ("counted", "int"), ("starts", "int"),
             *[(f"best_{k}", "double") for k in range(1, 6)],
             ("champ_place", "int"), ("champ_sum_top5", "double"), ("champ_mean_top5", "double"),
             ("champ_counted", "int"), *[(f"champ_best_{k}", "double") for k in range(1, 6)],
             ("events_top3", "str"), ("champ_events", "str"), ("all_starts", "str")]


def _json_record(kinds) -> str:
    parts = []
    for i, (c, k) in enumerate(kinds):
        parts.append(_q(("{" if i == 0 else ", ") + '"' + c + '": '))
        parts.append("(" + _json_val(c, k) + ")")
    parts.append("'}'")
    text = " || ".join(parts)
    return f"replace(replace(replace({text}, '<', '\\u003c'), '>', '\\u003e'), '&', '\\u0026')"


JSON_RECORDS = _with(BOARD_CTES) + f"SELECT {_json_record(_QB_KINDS)} AS json FROM qb"

CLEAN_TEXT_DOCS = f"""
SELECT doc_id, {clean('text')} AS clean_text, length({clean('text')}) AS clean_chars FROM documents"""

DOC_QUERY = " The "
SEARCH_DOCS = f"""
SELECT doc_id, lang, source FROM documents
WHERE contains(lower(coalesce(text, '')), {_q(DOC_QUERY.strip().lower())})
   OR contains(lower(coalesce(source, '')), {_q(DOC_QUERY.strip().lower())})"""


TABLE_ROUND_TRIP = _with() + """
SELECT results_url, table_no, lp, player, klass, district, m_skeet, m_lane, m_trap, m_boar, m_buck, sub_shot,
       sub_rifle, score, season, event_name, date_text, venue FROM results"""

INGEST_ISSUES = _with() + """
SELECT results_url AS url, CAST(CASE WHEN table_no = 2 THEN 1 WHEN row_seq % 21 = 8 AND row_seq % 30 <> 2 THEN 3 ELSE 2 END AS INTEGER) AS table_no,
       'missing_headers' AS issue, 'player,district,score' AS detail FROM results
UNION ALL
-- the table nested in a cell of the result table comes right after it
SELECT results_url, CAST(table_no + 1 AS INTEGER), 'missing_headers', 'player,district,score'
FROM results WHERE row_seq % 21 = 8 AND row_seq % 30 <> 2"""

_PLAYER_LABELS = [label for label, c in K.HEADER_ALIASES.items() if c == "player"]
ROW_REJECTS = _with() + f"""
SELECT results_url AS url, CAST(table_no AS INTEGER) AS table_no, r.row_no, r.reason, r.detail FROM results,
       (VALUES (1, 'repeated_header', {_q(_PLAYER_LABELS[2 % len(_PLAYER_LABELS)])}), (2, 'blank_player', '')) AS r(row_no, reason, detail)
WHERE row_seq % 3 = 2
UNION ALL
-- a schedule block's second table: a short row first, the event without results behind the odd-keyed events
SELECT 'schedule/' || lpad(CAST(b AS VARCHAR), 10, '0'), 3, CASE WHEN r.reason = 'short_row' THEN 1 ELSE CAST(odd AS INTEGER) + 2 END, r.reason, r.detail
FROM (SELECT o_orderkey // 50 AS b, count(*) FILTER (WHERE o_orderkey % 2 = 1) AS odd FROM events_b GROUP BY 1) AS x,
     (VALUES ('short_row', ''), ('no_link', 'brak wyników')) AS r(reason, detail)"""

SCHEDULE_SCAN = _with() + """
SELECT season, CAST(2 + o_orderkey % 2 AS INTEGER) AS schedule_table_no, schedule_lp, event_name, organizer, venue,
       date_text, 'https://results.example/u/' || CAST(o_orderkey AS VARCHAR) AS results_url FROM events_b"""

_HREF = r"""(?is)<a\s[^>]*?href\s*=\s*(?:["'']([^"'']*)["'']|([^\s"''>]+))"""


def _decode(x: str) -> str:
    for ent, ch in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
                    ("&#039;", "'"), ("&apos;", "'"), ("&amp;", "&")):
        x = f"replace({x}, {_q(ent)}, {_q(ch)})"
    return x


def _resolve(h: str, b: str) -> str:
    origin = f"regexp_extract({b}, '^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)', 1)"
    scheme = f"regexp_extract({b}, '^([a-zA-Z][a-zA-Z0-9+.-]*):', 1)"
    no_frag = f"regexp_extract({b}, '^([^#]*)', 1)"
    no_query = f"regexp_extract({b}, '^([^?#]*)', 1)"
    base_dir = (f"(CASE WHEN regexp_extract({no_query}, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/]*(/.*)?$', 1) = '' "
                f"THEN {no_query} || '/' ELSE regexp_replace({no_query}, '[^/]*$', '') END)")
    return (f"(CASE WHEN {h} = '' THEN {b} "
            f"WHEN regexp_matches({h}, '^[a-zA-Z][a-zA-Z0-9+.-]*:') THEN {h} "
            f"WHEN starts_with({h}, '//') THEN {scheme} || ':' || {h} "
            f"WHEN starts_with({h}, '/') THEN {origin} || {h} "
            f"WHEN starts_with({h}, '?') THEN {no_query} || {h} "
            f"WHEN starts_with({h}, '#') THEN {no_frag} || {h} "
            f"ELSE {base_dir} || {h} END)")


_href = _decode(f"(regexp_extract(html, '{_HREF}', 1) || regexp_extract(html, '{_HREF}', 2))")
_text = clean(_decode("regexp_replace(html, '(?s)<[^>]*>', ' ', 'g')"))
PAGE_LINKS = rf"""
SELECT page_id, url,
       CASE WHEN regexp_matches(html, '{_HREF}') THEN {_resolve(_href, 'url')}
            ELSE regexp_extract({_text}, 'https?://\S+', 0) END AS link
FROM pages"""


# every form is put together from the page's origin and the segments of its folder
RESOLVED_LINKS = """
WITH u AS (SELECT page_id, url, regexp_extract(url, '^[^?#]*') AS plain, regexp_extract(url, '^[a-zA-Z]+://[^/?#]*') AS origin FROM pages),
f AS (SELECT *, string_split(substr(plain, length(origin) + 1), '/') AS s FROM u),
g AS (SELECT *, s[:greatest(len(s) - 1, 1)] AS dir FROM f),
h AS (SELECT *, array_to_string(dir, '/') AS folder, array_to_string(dir[:greatest(len(dir) - 1, 1)], '/') AS above FROM g)
SELECT page_id, r.href, CASE r.href
  WHEN '../x/y.html' THEN origin || above || '/x/y.html'
  WHEN './a/./b/../c' THEN origin || folder || '/a/c'
  WHEN '../../../../top' THEN origin || '/top'
  WHEN '?page=9#f' THEN plain || '?page=9#f'
  WHEN '//cdn.example.org/z/../q' THEN string_split(url, '//')[1] || '//cdn.example.org/z/../q'
  WHEN '/r/./s/../t/' THEN origin || '/r/t/'
  WHEN '#end' THEN string_split(url, '#')[1] || '#end'
  WHEN 'd//e/..' THEN origin || folder || '/d/' END AS link
FROM h, (VALUES ('../x/y.html'), ('./a/./b/../c'), ('../../../../top'), ('?page=9#f'), ('//cdn.example.org/z/../q'), ('/r/./s/../t/'),
         ('#end'), ('d//e/..')) AS r(href)"""

_DISTRICT_ORDER = "PARTITION BY district ORDER BY score DESC NULLS LAST, row_seq"
START_NUMBERS = _with() + f"""
SELECT row_seq, district, player, score, row_number() OVER ({_DISTRICT_ORDER}) AS rn FROM results"""
STARTS_JOINED = _with() + """
SELECT district, string_agg(event_name, ' | ' ORDER BY score DESC NULLS LAST, row_seq) AS all_events FROM results GROUP BY district"""

_TOP3 = """
t3 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY player, district ORDER BY score DESC, row_seq) AS rn
                      FROM results WHERE score IS NOT NULL) WHERE rn <= 3)"""
NTH_LARGEST = _with(_TOP3) + """
SELECT player, district, max(CASE WHEN rn = 1 THEN score END) AS largest_1,
       max(CASE WHEN rn = 2 THEN score END) AS largest_2, max(CASE WHEN rn = 3 THEN score END) AS largest_3
FROM t3 GROUP BY player, district"""
ORDERED_CONCAT = _with(_TOP3) + """
SELECT player, district, string_agg(event_name, ' | ' ORDER BY rn) AS top_events FROM t3 GROUP BY player, district"""
FIRST_PER_EVENT = _with() + """
SELECT event_name, row_seq, player, score FROM (
  SELECT *, row_number() OVER (PARTITION BY event_name ORDER BY row_seq) AS rn FROM results) WHERE rn = 1"""

_K = "regexp_extract(props, '\"k\":\\s*(\\d+)', 1)"
COERCE_SCORES = f"""
SELECT event_id, {coerce(_K)} AS k_num, {coerce('CAST(value AS VARCHAR)')} AS value_num,
       {coerce("event_type || ' ' || " + _K)} AS junk_num FROM events"""

RUN_METRICS = _with(SUPP_CTES, EWS_CTES) + f"""
SELECT 'results' AS metric, count(*) AS value FROM results
UNION ALL SELECT 'players', count(*) FROM (SELECT DISTINCT player, district FROM results)
UNION ALL SELECT 'events', count(*) FROM events_b
UNION ALL SELECT 'events_in_period', count(*) FROM events_b WHERE {_in(_lo, _hi)}
UNION ALL SELECT 'schedule_tables', 4 * count(DISTINCT o_orderkey // {50}) FROM events_b
UNION ALL SELECT 'district_events', count(*) FROM ev_all
          WHERE results_url IN (SELECT results_url FROM dst WHERE results_url IS NOT NULL)"""

SCALABLE_PLACE = _with() + """
SELECT row_number() OVER (ORDER BY score DESC NULLS LAST, row_seq) AS place, row_seq, player, score FROM results"""


def _fmt(x: str, digits: int) -> str:
    # printf rounds the exact binary value
    r = f"CAST(printf('%.{digits}f', {x}) AS DOUBLE)"
    return (f"(CASE WHEN {x} IS NULL THEN '-' WHEN {r} = floor({r}) THEN CAST(CAST(floor({r}) AS BIGINT) AS VARCHAR) "
            f"ELSE replace(CAST({r} AS VARCHAR), '.', ',') END)")


DISPLAY_BOARD = _with(BOARD_CTES) + f"""
SELECT player, district, coalesce(CAST(place AS VARCHAR), '') AS place_text,
       coalesce(CAST(champ_place AS VARCHAR), '') AS champ_place_text,
       {_fmt('mean_top3', 1)} AS mean_top3_text, {_fmt('champ_mean_top5', 2)} AS champ_mean_text,
       CAST(len(list_filter(string_split(coalesce(all_starts, ''), ' | '), lambda x: x <> '')) AS BIGINT) AS listed_starts
FROM qb"""

SORTED_STARTS = _with(STARTS_CTES) + f"""
SELECT row_number() OVER (ORDER BY bs.player, bs.score DESC, bs.district, bs.event_name) AS position,
       bs.player, bs.district, bs.event_name, bs.score, eb.event_best,
       {half_even('bs.score / eb.event_best * 100', 1)} AS pct_of_best, bs.klass, bs.date_text, bs.venue,
       bs.results_url, bs.m_skeet, bs.m_lane, bs.m_trap, bs.m_boar, bs.m_buck
FROM bs LEFT JOIN eb ON bs.event_name = eb.event_name"""

# one text column of whole numbers, negative numbers, exponents, blanks and words
SORTED_MIXED = rf"""
WITH t AS (SELECT event_id, event_type, {_K} AS k FROM events),
m AS (SELECT event_id, CASE event_type WHEN 'view' THEN k WHEN 'click' THEN '-' || k WHEN 'error' THEN ' ' || k || 'e1 '
             WHEN 'purchase' THEN event_type || ' ' || k END AS mixed,
             CASE event_type WHEN 'view' THEN CAST(k AS DOUBLE) WHEN 'click' THEN -CAST(k AS DOUBLE)
                  WHEN 'error' THEN 10 * CAST(k AS DOUBLE) WHEN 'purchase' THEN NULL ELSE 0 END AS v, CAST(k AS INTEGER) AS n FROM t)
SELECT row_number() OVER (ORDER BY v IS NULL, v, CASE WHEN v IS NULL THEN n END, event_id) AS position, event_id, mixed FROM m"""

CSV_ROW_PLACES = _with(SUPP_CTES) + """
SELECT row_number() OVER (ORDER BY row_seq DESC) AS row_seq, CAST(row_seq AS VARCHAR) AS player, nullif(m_skeet_raw, '') AS m_skeet,
       CASE WHEN row_seq % 7 = 0 THEN 'short' END AS malformed, CASE WHEN row_seq % 7 <> 0 THEN score_raw END AS score FROM sraw"""

TABLE_SINK = f"""
SELECT *, 'award' AS board FROM ({AWARD_BOARD})
UNION ALL BY NAME SELECT *, 'average' AS board FROM ({AVERAGE_BOARD})
UNION ALL BY NAME SELECT *, 'team' AS board FROM ({TEAM_BOARD})"""

CSV_SUPPLEMENT = _with(SUPP_CTES) + "SELECT * EXCLUDE (row_seq) FROM supp"


DISTRICT_QUAL = _with(SUPP_CTES, f"""
un2 AS (SELECT row_seq, table_no, player, klass, district, score, event_name, date_text, d1, d2 FROM results
        UNION ALL
        SELECT row_seq, table_no, player, klass, district, score, event_name, date_text,
               CAST({_q(SE['date_text'])} AS DATE) AS d1, CAST(NULL AS DATE) AS d2 FROM supp),
sc2 AS (SELECT * FROM un2 WHERE score IS NOT NULL),
bs2 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY player, district, event_name
                       ORDER BY score DESC, row_seq) AS rn0 FROM sc2
                       WHERE lower(trim(district)) = {_q(B.SUPPLEMENT_DISTRICT)}) WHERE rn0 = 1),
""" + _qual_chain("bs2")) + QB_SELECT


WEAKNESS_NESTED_FLAT = _with(PROFILE_CTES, """
ranked AS (SELECT *, row_number() OVER (PARTITION BY player ORDER BY mean_pct, -gap_to_max, disc_ord) AS disc_rank
           FROM dp),
agg AS (SELECT player, sum(gap_to_max ORDER BY mean_pct, -gap_to_max, disc_ord) AS overall_gap,
               sum(mean_pct ORDER BY mean_pct, -gap_to_max, disc_ord) / count(*) AS player_avg_pct,
               max(CASE WHEN disc_rank = 1 THEN code END) AS weakest_code
        FROM ranked GROUP BY player),
cnt AS (SELECT player, count(*) AS starts FROM ps GROUP BY player),
ep AS (SELECT player, sum(pct ORDER BY pos) / count(pct) AS avg_event_pct, count(*) AS n_refs
       FROM refs2 GROUP BY player)""") + """
SELECT r.player, cnt.starts, ep.avg_event_pct, agg.overall_gap, agg.player_avg_pct,
       coalesce(ep.n_refs, 0) AS n_refs, agg.weakest_code, r.disc_rank, r.code, r.label,
       r.starts AS disc_starts, r.mean AS disc_avg, r.best AS disc_best, r.last AS disc_last,
       r.mean_pct AS disc_avg_pct, r.gap_to_max AS improvement_to_max, r.reserve_to_best, r.trend
FROM ranked r JOIN agg ON r.player = agg.player LEFT JOIN cnt ON r.player = cnt.player
LEFT JOIN ep ON r.player = ep.player"""


WEAKNESS_NESTED_REFS = _with(PROFILE_CTES, """
withd AS (SELECT DISTINCT player FROM dp)""") + """
SELECT refs2.player, row_number() OVER (PARTITION BY refs2.player ORDER BY pct, pos) AS ref_rank,
       event, date, score, event_best, pct
FROM refs2 JOIN withd ON refs2.player = withd.player"""


def queries() -> dict[str, str]:
    return {
        "award_board": AWARD_BOARD,
        "average_board": AVERAGE_BOARD,
        "team_board": TEAM_BOARD,
        "team_members": TEAM_MEMBERS,
        "event_best": EVENT_BEST,
        "best_start_per_event": BEST_START_PER_EVENT,
        "pct_of_best": STARTS,
        "qualification_board": QUALIFICATION_BOARD,
        "district_qualification_board": DISTRICT_QUAL,
        "championship_board": CHAMPIONSHIP_BOARD,
        "window_membership": WINDOW_MEMBERSHIP,
        "events_in_period": EVENTS_IN_PERIOD,
        "period_positions": PERIOD_POSITIONS,
        "crawl_order": CRAWL_ORDER,
        "sorted_events": SORTED_EVENTS,
        "parsed_dates": PARSED_DATES,
        "supplement_known_players": SUPPLEMENT_KNOWN_PLAYERS,
        "supplement_union": SUPPLEMENT_UNION,
        "events_with_starts": EVENTS_WITH_STARTS,
        "discipline_long": DISCIPLINE_LONG,
        "discipline_profile": DISCIPLINE_PROFILE,
        "event_refs": EVENT_REFS,
        "weakest_discipline": WEAKEST_DISCIPLINE,
        "weakness_ranks": WEAKNESS_RANKS,
        "weakness_nested_flat": WEAKNESS_NESTED_FLAT,
        "weakness_nested_refs": WEAKNESS_NESTED_REFS,
        "report_totals": REPORT_TOTALS,
        "top_six": TOP_SIX,
        "qualification_flags": QUALIFICATION_FLAGS,
        "sorted_board": SORTED_BOARD,
        "search_board": SEARCH_BOARD,
        "search_starts": SEARCH_STARTS,
        "search_events": SEARCH_EVENTS,
        "json_records": JSON_RECORDS,
        "clean_text_docs": CLEAN_TEXT_DOCS,
        "search_docs": SEARCH_DOCS,
        "table_round_trip": TABLE_ROUND_TRIP,
        "ingest_issues": INGEST_ISSUES,
        "row_rejects": ROW_REJECTS,
        "schedule_scan": SCHEDULE_SCAN,
        "resolved_links": RESOLVED_LINKS,
        "start_numbers": START_NUMBERS,
        "starts_joined": STARTS_JOINED,
        "page_links": PAGE_LINKS,
        "nth_largest": NTH_LARGEST,
        "ordered_concat": ORDERED_CONCAT,
        "first_per_event": FIRST_PER_EVENT,
        "coerce_scores": COERCE_SCORES,
        "run_metrics": RUN_METRICS,
        "sorted_mixed": SORTED_MIXED,
        "csv_row_places": CSV_ROW_PLACES,
        "scalable_place": SCALABLE_PLACE,
        "display_board": DISPLAY_BOARD,
        "sorted_starts": SORTED_STARTS,
        "csv_supplement": CSV_SUPPLEMENT,
        "table_sink_round_trip": TABLE_SINK,
    }
