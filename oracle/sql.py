"""Independent SQL formulation of every registered query, for DuckDB.

The driver's tables are views named region, nation, customer, supplier,
part, orders, lineitem, ... . Each query is a WITH chain: stand-in sources
-> NA tokens -> cleaning -> dimensions -> facts -> analyses. Window
functions here are plain (single ordered windows); the Spark side uses the
distributed bucketed forms, so agreement checks those too.
"""

from __future__ import annotations

from boxstar.plans.recipes import STANDIN, Params
from boxstar.sources.bindings import FLAG_TEXT, GAME_TYPE_TEXT
from oracle import fixed as config

NUMBER_RE = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


NA_LIST = ", ".join(_q(t) for t in config.NA_TOKENS)


def na(expr: str) -> str:
    return f"CASE WHEN ({expr}) IN ({NA_LIST}) THEN NULL ELSE ({expr}) END"


def strip(expr: str) -> str:
    return f"regexp_replace(({expr}), '^\\s+|\\s+$', '', 'g')"


def num(expr: str) -> str:
    s = strip(expr)
    return f"(CASE WHEN regexp_matches({s}, '{NUMBER_RE}') THEN TRY_CAST({s} AS DOUBLE) END)"


def minutes(expr: str) -> str:
    t = strip(expr)
    head = f"substr({t}, 1, strpos({t}, ':') - 1)"
    tail = f"substr({t}, strpos({t}, ':') + 1)"
    return (
        f"(CASE WHEN ({expr}) IS NULL OR {t} = '' THEN NULL "
        f"WHEN strpos({t}, ':') > 0 THEN {num(head)} + {num(tail)} / 60.0 "
        f"ELSE {num(t)} END)"
    )


def season_label(y: str) -> str:
    return f"(CAST(({y}) - 1 AS VARCHAR) || '-' || right(CAST(({y}) AS VARCHAR), 2))"


def rnd(expr: str, places: int = 6) -> str:
    return f"ROUND(({expr}), {places})"


def _flag_text(k: str) -> str:
    whens = " ".join(f"WHEN {i} THEN {_q(t)}" for i, t in enumerate(FLAG_TEXT))
    return f"(CASE ({k}) % 7 {whens} END)"


def _game_type_text() -> str:
    whens = " ".join(f"WHEN {_q(p)} THEN {_q(t)}" for p, t in GAME_TYPE_TEXT)
    return f"(CASE o.o_orderpriority {whens} END)"


LINE_STATS = """
    CAST(floor(l.l_extendedprice / 1000.0) AS DOUBLE) AS points,
    CAST(round(l.l_discount * 100.0, 0) AS DOUBLE) AS assists,
    CAST(l.l_partkey % 5 AS DOUBLE) AS blocks,
    CAST(round(l.l_tax * 100.0, 0) AS DOUBLE) AS steals,
    CAST(l.l_quantity AS DOUBLE) AS fieldGoalsAttempted,
    CAST(floor(l.l_quantity / 2.0) AS DOUBLE) AS fieldGoalsMade,
    CAST(l.l_suppkey % 4 + l.l_partkey % 3 AS DOUBLE) AS threePointersAttempted,
    CAST(l.l_suppkey % 4 AS DOUBLE) AS threePointersMade,
    CAST((l.l_partkey + l.l_suppkey) % 5 AS DOUBLE) AS freeThrowsAttempted,
    CAST(floor(((l.l_partkey + l.l_suppkey) % 5) / 2.0) AS DOUBLE) AS freeThrowsMade,
    CAST(l.l_linenumber AS DOUBLE) AS reboundsDefensive,
    CAST(l.l_partkey % 3 AS DOUBLE) AS reboundsOffensive,
    CAST(l.l_linenumber + l.l_partkey % 3 AS DOUBLE) AS reboundsTotal,
    CAST(l.l_partkey % 6 AS DOUBLE) AS foulsPersonal,
    CAST(l.l_suppkey % 3 AS DOUBLE) AS turnovers,
    CAST(l.l_suppkey % 21 - 10 AS DOUBLE) AS plusMinusPoints"""

TEAM_SUMS = (
    "points", "assists", "blocks", "steals", "fieldGoalsAttempted", "fieldGoalsMade",
    "threePointersAttempted", "threePointersMade", "freeThrowsAttempted", "freeThrowsMade",
    "reboundsDefensive", "reboundsOffensive", "reboundsTotal", "foulsPersonal", "turnovers",
    "plusMinusPoints",
)

BOX_STATS = (
    "points", "assists", "blocks", "steals", "fieldGoalsAttempted", "fieldGoalsMade",
    "fieldGoalsPercentage", "threePointersAttempted", "threePointersMade",
    "threePointersPercentage", "freeThrowsAttempted", "freeThrowsMade", "freeThrowsPercentage",
    "reboundsDefensive", "reboundsOffensive", "reboundsTotal", "foulsPersonal", "turnovers",
    "plusMinusPoints",
)

TEAM_STATS = (
    "teamScore", "opponentScore", "assists", "blocks", "steals", "fieldGoalsAttempted",
    "fieldGoalsMade", "fieldGoalsPercentage", "threePointersAttempted", "threePointersMade",
    "threePointersPercentage", "freeThrowsAttempted", "freeThrowsMade", "freeThrowsPercentage",
    "reboundsDefensive", "reboundsOffensive", "reboundsTotal", "foulsPersonal", "turnovers",
    "plusMinusPoints", "numMinutes", "q1Points", "q2Points", "q3Points", "q4Points",
    "benchPoints", "biggestLead", "biggestScoringRun", "leadChanges", "pointsFastBreak",
    "pointsFromTurnovers", "pointsInThePaint", "pointsSecondChance", "timesTied",
    "timeoutsRemaining", "seasonWins", "seasonLosses",
)


def _norm_game_type(c: str) -> str:
    labels = config.GAME_TYPE_LABELS
    cup = ", ".join(_q(x) for x in config.GAME_TYPE_CUP)
    return (
        f"(CASE WHEN {c} IS NULL OR trim({c}) = '' THEN NULL "
        f"WHEN lower(replace(trim({c}), ' ', '')) = {_q(config.GAME_TYPE_PRESEASON)} THEN {_q(labels['preseason'])} "
        f"WHEN lower(trim({c})) = {_q(config.GAME_TYPE_REGULAR)} THEN {_q(labels['regular'])} "
        f"WHEN lower(trim({c})) IN ({cup}) THEN {_q(labels['cup'])} "
        f"ELSE trim({c}) END)"
    )


def base_ctes(p: Params) -> list[tuple[str, str]]:
    """Named CTEs in dependency order."""
    ctes: list[tuple[str, str]] = []
    add = lambda name, body: ctes.append((name, body))

    # ---- stand-in sources ---------------------------------------------------
    add("players_text", f"""
  SELECT
    CAST(c.c_custkey AS VARCHAR) AS personId,
    CASE WHEN c.c_custkey % 19 = 0 THEN 'N/A' ELSE c.c_name END AS firstName,
    c.c_mktsegment AS lastName,
    CASE WHEN c.c_custkey % 23 = 0 THEN 'unknown'
         ELSE CAST(CAST(DATE '1970-01-01' + CAST(c.c_custkey * 37 % 12000 AS INTEGER) AS DATE) AS VARCHAR) END AS birthDate,
    CASE WHEN c.c_custkey % 5 = 0 THEN 'None' ELSE 'School_' || CAST(c.c_custkey % 40 AS VARCHAR) END AS school,
    n.n_name AS country,
    CAST(60 + c.c_custkey % 35 AS VARCHAR) AS heightInches,
    CAST(100 + (c.c_custkey * 7) % 320 AS VARCHAR) AS bodyWeightLbs,
    {_flag_text('c.c_custkey')} AS guard,
    {_flag_text('c.c_custkey + 2')} AS forward,
    {_flag_text('c.c_custkey + 5')} AS center,
    CASE WHEN c.c_custkey % 10 = 0 THEN '-1' WHEN c.c_custkey % 10 = 1 THEN '-22'
         ELSE CAST(1980 + c.c_custkey % 45 AS VARCHAR) END AS draftYear,
    CASE WHEN c.c_custkey % 13 = 0 THEN 'NA' ELSE CAST(1 + c.c_custkey % 2 AS VARCHAR) END AS draftRound,
    CASE WHEN c.c_custkey % 9 = 0 THEN 'undrafted' ELSE CAST(c.c_custkey % 61 - 1 AS VARCHAR) END AS draftNumber
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey""")
    str_cols = ["personId", "firstName", "lastName", "birthDate", "school", "country", "heightInches",
                "bodyWeightLbs", "guard", "forward", "center", "draftYear", "draftRound", "draftNumber"]
    add("players_src", "SELECT " + ", ".join(f"{na(c)} AS {c}" for c in str_cols) + " FROM players_text")

    add("orders_cust", """
  SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_orderdate, o.o_orderpriority, o.o_totalprice,
         c.c_custkey, c.c_nationkey, c.c_mktsegment
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey""")

    game_cols = f"""
    o.o_orderkey AS gameId,
    strftime(o.o_orderdate, '%Y-%m-%d %H:%M:%S') AS gameDateTimeEst,
    CASE o.o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS win,
    CAST(o.o_orderkey % 2 AS INTEGER) AS home"""
    q = "CAST(CAST(l.l_quantity AS INTEGER) AS VARCHAR)"
    qm1 = "CAST(CAST(l.l_quantity AS INTEGER) - 1 AS VARCHAR)"
    add("box_text", f"""
  SELECT
    o.o_custkey AS personId,{game_cols},
    {_game_type_text()} AS gameType,
    'NATION_' || CAST(o.c_nationkey AS VARCHAR) AS playerteamName,
    'NATION_' || CAST((o.c_nationkey + o.o_orderkey) % 30 AS VARCHAR) AS opponentteamName,
    o.o_orderpriority AS gameLabel,
    CASE WHEN l.l_linenumber = 1 THEN 'NA' ELSE l.l_returnflag END AS gameSubLabel,
    l.l_linenumber AS seriesGameNumber,
    CASE l.l_linenumber WHEN 1 THEN {q} || ':00' WHEN 2 THEN ' ' || {q} || ' ' WHEN 7 THEN {qm1} || ':30' ELSE {q} END AS numMinutes,{LINE_STATS}
  FROM lineitem l JOIN orders_cust o ON l.l_orderkey = o.o_orderkey""")
    box_str = ["gameDateTimeEst", "gameType", "playerteamName", "opponentteamName", "gameLabel", "gameSubLabel", "numMinutes"]
    add("box_src", "SELECT * REPLACE (" + ", ".join(f"{na(c)} AS {c}" for c in box_str) + """),
    fieldGoalsMade / NULLIF(fieldGoalsAttempted, 0) AS fieldGoalsPercentage,
    threePointersMade / NULLIF(threePointersAttempted, 0) AS threePointersPercentage,
    freeThrowsMade / NULLIF(freeThrowsAttempted, 0) AS freeThrowsPercentage
  FROM box_text""")

    sums = ",\n    ".join(f"SUM({c}) AS {c}" for c in TEAM_SUMS)
    add("team_box", f"""
  SELECT l_orderkey,
    {sums},
    SUM(l_quantity) AS minutes_total,
    SUM(CASE WHEN l_linenumber IN (1, 5) THEN points ELSE 0.0 END) AS q1Points,
    SUM(CASE WHEN l_linenumber IN (2, 6) THEN points ELSE 0.0 END) AS q2Points,
    SUM(CASE WHEN l_linenumber IN (3, 7) THEN points ELSE 0.0 END) AS q3Points,
    SUM(CASE WHEN l_linenumber = 4 THEN points ELSE 0.0 END) AS q4Points,
    SUM(CASE WHEN l_linenumber >= 4 THEN points ELSE 0.0 END) AS benchPoints
  FROM (SELECT l.l_orderkey, l.l_linenumber, l.l_quantity,{LINE_STATS} FROM lineitem l) x
  GROUP BY l_orderkey""")
    passthru = ",\n    ".join(f"b.{c}" for c in TEAM_SUMS if c != "points")
    add("team_text", f"""
  SELECT {game_cols},
    'NATION_' || CAST(o.c_nationkey AS VARCHAR) AS teamName,
    CASE WHEN o.o_orderkey % 11 = 0 THEN 'NULL' ELSE o.c_mktsegment END AS teamCity,
    'NATION_' || CAST((o.c_nationkey + o.o_orderkey) % 30 AS VARCHAR) AS opponentTeamName,
    CAST(o.c_custkey AS DOUBLE) AS coachId,
    b.points AS teamScore,
    CAST(floor(o.o_totalprice / 2000.0) AS DOUBLE) AS opponentScore,
    {passthru},
    b.fieldGoalsMade / NULLIF(b.fieldGoalsAttempted, 0) AS fieldGoalsPercentage,
    b.threePointersMade / NULLIF(b.threePointersAttempted, 0) AS threePointersPercentage,
    b.freeThrowsMade / NULLIF(b.freeThrowsAttempted, 0) AS freeThrowsPercentage,
    CAST(CAST(b.minutes_total AS INTEGER) AS VARCHAR) || ':00' AS numMinutes,
    b.q1Points, b.q2Points, b.q3Points, b.q4Points, b.benchPoints,
    CAST(o.o_orderkey % 25 AS DOUBLE) AS biggestLead,
    CAST(o.o_orderkey % 13 AS DOUBLE) AS biggestScoringRun,
    CAST(o.o_orderkey % 17 AS DOUBLE) AS leadChanges,
    b.steals AS pointsFastBreak,
    b.turnovers * 2.0 AS pointsFromTurnovers,
    (b.fieldGoalsMade - b.threePointersMade) * 2.0 AS pointsInThePaint,
    b.reboundsOffensive AS pointsSecondChance,
    CAST(o.o_orderkey % 7 AS DOUBLE) AS timesTied,
    CAST(o.o_orderkey % 4 AS DOUBLE) AS timeoutsRemaining,
    CAST(o.o_custkey % 60 AS DOUBLE) AS seasonWins,
    CAST(o.o_custkey % 50 AS DOUBLE) AS seasonLosses
  FROM team_box b JOIN orders_cust o ON b.l_orderkey = o.o_orderkey""")
    team_str = ["gameDateTimeEst", "teamName", "teamCity", "opponentTeamName", "numMinutes"]
    add("team_src", "SELECT * REPLACE (" + ", ".join(f"{na(c)} AS {c}" for c in team_str) + ") FROM team_text")

    # ---- cleaning ------------------------------------------------------------
    lo_h, hi_h = config.HEIGHT_RANGE
    lo_w, hi_w = config.WEIGHT_RANGE
    sent = ", ".join(str(v) for v in config.DRAFT_SENTINELS)
    true_t = ", ".join(_q(t) for t in config.FLAG_TRUE)
    false_t = ", ".join(_q(t) for t in config.FLAG_FALSE)
    flag = lambda c: f"(CASE WHEN {c} IN ({true_t}) THEN 1 WHEN {c} IN ({false_t}) THEN 0 END)"
    draft = lambda c: f"(CASE WHEN {num(c)} IN ({sent}) THEN NULL ELSE {num(c)} END)"
    add("players_clean", f"""
  SELECT personId, firstName, lastName,
    try_strptime(birthDate, '%Y-%m-%d') AS birthdate,
    school AS lastAttended, country,
    CASE WHEN {num('heightInches')} BETWEEN {lo_h} AND {hi_h} THEN {num('heightInches')} END AS height,
    CASE WHEN {num('bodyWeightLbs')} BETWEEN {lo_w} AND {hi_w} THEN {num('bodyWeightLbs')} END AS bodyWeight,
    CAST({flag('guard')} AS INTEGER) AS guard,
    CAST({flag('forward')} AS INTEGER) AS forward,
    CAST({flag('center')} AS INTEGER) AS center,
    {draft('draftYear')} AS draftYear,
    {draft('draftRound')} AS draftRound,
    {draft('draftNumber')} AS draftNumber
  FROM players_src""")
    add("box_clean", f"""
  SELECT * REPLACE ({minutes('numMinutes')} AS numMinutes,
                    try_strptime(gameDateTimeEst, '%Y-%m-%d %H:%M:%S') AS gameDateTimeEst)
  FROM box_src""")
    add("team_clean", f"""
  SELECT * REPLACE ({minutes('numMinutes')} AS numMinutes,
                    try_strptime(gameDateTimeEst, '%Y-%m-%d %H:%M:%S') AS gameDateTimeEst)
  FROM team_src""")

    # ---- dimensions ----------------------------------------------------------
    add("players", """
  SELECT ROW_NUMBER() OVER (ORDER BY personId ASC NULLS LAST) AS playerKey, *
  FROM (SELECT TRY_CAST(personId AS BIGINT) AS personId, firstName, lastName, CAST(birthdate AS DATE) AS birthdate,
               lastAttended, country, height, bodyWeight, guard, forward, center, draftYear, draftRound, draftNumber
        FROM players_clean) s""")
    add("team_history", """
  SELECT teamName, teamCity, MAX(coachId) AS coachId, MAX(gameDateTimeEst) AS last_seen
  FROM team_clean GROUP BY teamName, teamCity""")
    add("teams", """
  SELECT ROW_NUMBER() OVER (ORDER BY teamName ASC NULLS LAST) AS teamKey, teamName, teamCity, coachId
  FROM (SELECT * FROM team_history
        QUALIFY ROW_NUMBER() OVER (PARTITION BY teamName
                                   ORDER BY last_seen DESC NULLS LAST, (teamCity IS NULL) ASC, teamCity DESC) = 1) t""")
    add("team_lookup", "SELECT teamName, MIN(teamKey) AS teamKey FROM teams GROUP BY teamName")
    add("games", f"""
  SELECT ROW_NUMBER() OVER (ORDER BY gameId ASC NULLS LAST) AS gameKey, gameId, gameType
  FROM (SELECT TRY_CAST(gameId AS BIGINT) AS gameId,
               COALESCE(MAX({_norm_game_type('gameType')}), {_q(config.GAME_TYPE_LABELS['unknown'])}) AS gameType
        FROM box_clean GROUP BY 1) g""")
    add("dates", """
  SELECT count(*) OVER (ORDER BY stamp NULLS LAST ROWS UNBOUNDED PRECEDING) AS dateKey, stamp AS gameDateEst,
         left(CAST(stamp AS VARCHAR), 10) AS fullDate,
         CAST(date_part('year', stamp) AS INTEGER) AS year, CAST(date_part('month', stamp) AS INTEGER) AS month,
         CAST(date_part('day', stamp) AS INTEGER) AS day, CAST(date_part('dow', stamp) AS INTEGER) AS dayOfTheWeek,
         CAST(date_part('quarter', stamp) AS INTEGER) AS quarter
  FROM (SELECT stamp FROM (SELECT gameDateTimeEst AS stamp FROM box_clean UNION ALL SELECT gameDateTimeEst FROM team_clean) b
        GROUP BY stamp) s""")

    # ---- facts ---------------------------------------------------------------
    box_stats = ",\n    ".join(f"CAST(b.{c} AS DOUBLE) AS {c}" for c in BOX_STATS)
    add("player_fact", f"""
  SELECT p.playerKey, tl.teamKey, ol.teamKey AS opponentTeamKey, g.gameKey, d.dateKey,
    b.gameType, b.gameLabel, b.gameSubLabel, b.seriesGameNumber,
    CAST(b.win AS INTEGER) AS win, CAST(b.home AS INTEGER) AS home,
    CAST(b.numMinutes AS DOUBLE) AS numMinutes,
    {box_stats}
  FROM box_clean b
  LEFT JOIN players p ON TRY_CAST(b.personId AS BIGINT) = p.personId
  LEFT JOIN team_lookup tl ON b.playerteamName = tl.teamName
  LEFT JOIN team_lookup ol ON b.opponentteamName = ol.teamName
  LEFT JOIN games g ON TRY_CAST(b.gameId AS BIGINT) = g.gameId
  LEFT JOIN dates d ON b.gameDateTimeEst = d.gameDateEst""")
    team_stats = ",\n    ".join(f"CAST(t.{c} AS DOUBLE) AS {c}" for c in TEAM_STATS)
    add("team_fact", f"""
  SELECT tl.teamKey, ol.teamKey AS opponentTeamKey, g.gameKey, d.dateKey,
    CAST(t.home AS INTEGER) AS home, CAST(t.win AS INTEGER) AS win,
    {team_stats}
  FROM team_clean t
  LEFT JOIN team_lookup tl ON t.teamName = tl.teamName
  LEFT JOIN team_lookup ol ON t.opponentTeamName = ol.teamName
  LEFT JOIN games g ON TRY_CAST(t.gameId AS BIGINT) = g.gameId
  LEFT JOIN dates d ON t.gameDateTimeEst = d.gameDateEst""")

    # ---- team analyses -------------------------------------------------------
    wl = ",\n    ".join(
        (f"AVG({c}) * 100 AS {c}" if pct else f"AVG({c}) AS {c}") for c, pct in config.WIN_LOSS_COLUMNS
    )
    add("win_loss", f"""
  SELECT win,
    {wl}
  FROM team_fact WHERE win IN (0, 1) GROUP BY win""")
    pct_col = f"win_pct_{p.top_since_year}_plus"
    add("top_teams", f"""
  SELECT n.teamName, n.teamCity, round(r.share * 100, 2) AS {pct_col}, r.games AS games_count
  FROM (SELECT teamKey, avg(CAST(coalesce(win = 1, false) AS DOUBLE)) AS share, count(*) AS games
        FROM team_fact SEMI JOIN (SELECT dateKey FROM dates WHERE year >= {p.top_since_year}) recent USING (dateKey)
        GROUP BY teamKey) r
  JOIN (SELECT * FROM teams WHERE teamCity IS NOT NULL) n USING (teamKey)
  WHERE r.games >= {p.top_min_games}
  ORDER BY 3 DESC, 4 DESC, 1
  LIMIT {p.top_limit}""")
    prof = ",\n    ".join(f"AVG(f.{c}) AS {c}" for c, _ in config.COUNT_LABELS)
    add("team_profile", f"""
  SELECT
    {prof}
  FROM team_fact f
  JOIN teams t ON t.teamKey = f.teamKey
  JOIN dates d ON d.dateKey = f.dateKey
  WHERE d.year >= {p.top_since_year} AND lower(t.teamName) = {_q(p.profile_team.lower())} AND f.win = 1""")

    # ---- player-season pool --------------------------------------------------
    rate = lambda col, name: f"SUM(f.{col}) / NULLIF(SUM(f.numMinutes), 0) * {config.PER_MINUTES} AS {name}"
    rates = dict(config.RATE_METRICS)
    add("season_rows", f"""
  SELECT CASE WHEN d.month >= {config.SEASON_START_MONTH} THEN d.year + 1 ELSE d.year END AS season_end_year,
    p.playerKey, p.firstName, p.lastName,
    COUNT(DISTINCT f.gameKey) AS games_played,
    SUM(f.numMinutes) AS total_minutes,
    {rate(rates['pts36'], 'pts36')},
    {rate(rates['ast36'], 'ast36')},
    {rate(rates['stl36'], 'stl36')},
    {rate(rates['blk36'], 'blk36')},
    {rate(rates['tpm36'], 'tpm36')},
    SUM(f.threePointersAttempted) AS three_pa_total,
    {rate(rates['tpa36'], 'tpa36')},
    {rate(rates['dreb36'], 'dreb36')},
    {rate(rates['oreb36'], 'oreb36')},
    {rate(rates['tov36'], 'tov36')},
    SUM(f.fieldGoalsAttempted) AS field_goal_attempts,
    SUM(f.fieldGoalsMade) / NULLIF(SUM(f.fieldGoalsAttempted), 0) AS fg_pct,
    SUM(f.threePointersMade) / NULLIF(SUM(f.threePointersAttempted), 0) AS tp_pct
  FROM player_fact f
  JOIN players p ON p.playerKey = f.playerKey
  JOIN dates d ON d.dateKey = f.dateKey
  GROUP BY 1, 2, 3, 4
  HAVING SUM(f.numMinutes) >= {float(p.pool_min_minutes)} AND COUNT(DISTINCT f.gameKey) >= {int(p.pool_min_games)}""")
    add("pool_masked", f"""
  SELECT * REPLACE (
      CASE WHEN three_pa_total >= {float(p.tp_min_attempts)} THEN tp_pct END AS tp_pct,
      CASE WHEN field_goal_attempts >= {float(p.fg_min_attempts)} THEN fg_pct END AS fg_pct),
    firstName || ' ' || lastName AS player,
    {season_label('season_end_year')} AS season_label
  FROM season_rows""")
    add("pool", """
  SELECT * REPLACE (
      COALESCE(tp_pct, (SELECT quantile_cont(tp_pct, 0.5) FROM pool_masked)) AS tp_pct,
      COALESCE(fg_pct, (SELECT quantile_cont(fg_pct, 0.5) FROM pool_masked)) AS fg_pct)
  FROM pool_masked""")

    # ---- roles -----------------------------------------------------------------
    zcols = config.ZSCORE_METRICS
    stats = ", ".join(f"AVG({m}) AS mu_{m}, STDDEV_POP({m}) AS sd_{m}" for m in zcols)
    add("zstats", f"SELECT {stats} FROM pool")
    zexpr = ",\n    ".join(
        f"(p.{m} - s.mu_{m}) / CASE WHEN s.sd_{m} = 0 THEN 1.0 ELSE s.sd_{m} END AS z_{m}" for m in zcols
    )
    add("zs", f"""
  SELECT p.*,
    {zexpr}
  FROM pool p CROSS JOIN zstats s""")
    sig = []
    for role, terms in config.ROLE_SIGNALS:
        expr = " + ".join(f"({w!r})::DOUBLE * z_{m}" for m, w in terms)
        sig.append(f"{expr} AS {role.lower()}_signal")
    add("signals", "SELECT *, " + ",\n    ".join(sig) + " FROM zs")
    names = [f"{r.lower()}_signal" for r, _ in config.ROLE_SIGNALS]
    best = f"greatest({', '.join(names)})"
    argmax = "CASE " + " ".join(f"WHEN {n} = {best} THEN {_q(r)}" for (r, _), n in zip(config.ROLE_SIGNALS, names)) + " END"
    add("roles", f"""
  SELECT * EXCLUDE (raw_role, {', '.join('z_' + m for m in zcols)}),
    CASE WHEN raw_role = 'Wing'
              AND (dreb36 + oreb36 >= {config.INTERIOR_REBOUNDS} OR blk36 >= {config.INTERIOR_BLOCKS})
              AND tpm36 < {config.INTERIOR_MAX_TPM}
         THEN 'Big' ELSE raw_role END AS role
  FROM (SELECT *, {argmax} AS raw_role FROM signals) r""")

    # ---- pillars and scores -------------------------------------------------
    def pct_rank(col: str, asc: bool, part: str = "role") -> str:
        order = "ASC" if asc else "DESC"
        return (
            f"(CASE WHEN {col} IS NULL THEN NULL ELSE "
            f"(CAST(RANK() OVER (PARTITION BY {part} ORDER BY {col} {order} NULLS LAST) AS DOUBLE)"
            f" + CAST(COUNT(*) OVER (PARTITION BY {part}, {col}) - 1 AS DOUBLE) / 2.0::DOUBLE)"
            f" / CAST(COUNT({col}) OVER (PARTITION BY {part}) AS DOUBLE) * 100.0::DOUBLE END)"
        )

    terms = {}
    for _, parts in config.PILLARS:
        for m, _, asc in parts:
            terms[("p_" if asc else "pd_") + m] = (m, asc)
    pct_exprs = ",\n    ".join(f"{pct_rank(m, asc)} AS {name}" for name, (m, asc) in terms.items())
    add("pct_ranks", f"""
  SELECT *,
    {pct_exprs}
  FROM roles WHERE role IS NOT NULL""")
    pillars = []
    for pillar, parts in config.PILLARS:
        expr = " + ".join(f"({w!r})::DOUBLE * {('p_' if asc else 'pd_') + m}" for m, w, asc in parts)
        pillars.append(f"{expr} AS {pillar}")
    add("pillars", "SELECT * EXCLUDE (" + ", ".join(terms) + "), " + ",\n    ".join(pillars) + " FROM pct_ranks")
    weight_terms = []
    for i, (pillar, _) in enumerate(config.PILLARS):
        case = "CASE " + " ".join(f"WHEN role = {_q(r)} THEN ({w[i]!r})::DOUBLE" for r, w in config.ROLE_WEIGHTS) + " END"
        weight_terms.append(f"{pillar} * {case}")
    add("overall", "SELECT *, " + " + ".join(weight_terms) + " AS overall_score FROM pillars")
    add("scored", f"""
  SELECT *,
    {pct_rank('overall_score', True)} AS historical_percentile_within_role,
    CASE WHEN overall_score IS NULL THEN NULL
         ELSE DENSE_RANK() OVER (PARTITION BY role ORDER BY overall_score DESC NULLS LAST) END AS historical_rank_within_role,
    COUNT(*) OVER (PARTITION BY role) AS historical_pool_size,
    dreb36 + oreb36 AS reb36
  FROM overall""")

    # ---- benchmarks ------------------------------------------------------------
    longs = " UNION ALL ".join(
        f"SELECT role, {_q(m)} AS metric, {m} AS value FROM scored" for m, _ in config.BENCHMARK_METRICS
    )
    add("bench_long", longs)
    qs = ", ".join(f"quantile_cont(value, {qv}) AS p{pv}" for pv, qv in config.BENCHMARK_QUANTILES)
    add("bench_q", f"SELECT role, metric, {qs}, COUNT(value) AS pool_size FROM bench_long GROUP BY role, metric")
    scaffold = ", ".join(
        f"({_q(r)}, {_q(m)}, {_q(lbl)}, {ri}, {mi})"
        for ri, r in enumerate(config.ROLE_ORDER)
        for mi, (m, lbl) in enumerate(config.BENCHMARK_METRICS)
    )
    add("bench_scaffold", f"SELECT * FROM (VALUES {scaffold}) v(role, metric, label, role_order, metric_order)")
    add("benchmarks", """
  SELECT s.role, s.metric, s.label, q.p50, q.p75, q.p95, CAST(COALESCE(q.pool_size, 0) AS BIGINT) AS pool_size,
         s.role_order, s.metric_order
  FROM bench_scaffold s LEFT JOIN bench_q q ON q.role = s.role AND q.metric = s.metric""")

    # ---- active pool -----------------------------------------------------------
    years = ", ".join(str(y) for y in p.active_years)
    add("season_window", f"""
  SELECT MAX(season_end_year) - {p.recent_seasons - 1} AS first_season, MAX(season_end_year) AS latest_season FROM scored""")
    add("active_ids", f"""
  SELECT DISTINCT f.playerKey FROM player_fact f JOIN dates d ON d.dateKey = f.dateKey
  WHERE d.year IN ({years}) AND f.playerKey IS NOT NULL""")
    add("active_latest", f"""
  SELECT s.* FROM scored s CROSS JOIN season_window w
  WHERE s.playerKey IN (SELECT playerKey FROM active_ids)
    AND s.season_end_year BETWEEN w.first_season AND w.latest_season
    AND s.total_minutes >= {float(p.active_min_minutes)} AND s.games_played >= {int(p.active_min_games)}
  QUALIFY ROW_NUMBER() OVER (PARTITION BY s.playerKey
                             ORDER BY s.season_end_year DESC, s.total_minutes ASC, s.games_played ASC) = 1""")
    add("active", """
  SELECT *,
    CASE WHEN overall_score IS NULL THEN NULL
         ELSE DENSE_RANK() OVER (ORDER BY overall_score DESC NULLS LAST) END AS current_rank_overall,
    CASE WHEN overall_score IS NULL THEN NULL
         ELSE DENSE_RANK() OVER (PARTITION BY role ORDER BY overall_score DESC NULLS LAST) END AS current_rank_within_role
  FROM active_latest""")
    metrics = [m for m, _ in config.BENCHMARK_METRICS]
    cut_cols = ", ".join(
        f"MAX(CASE WHEN metric = {_q(m)} THEN p{pv} END) AS cut_{m}_{pv}"
        for m in metrics for pv, _ in config.BENCHMARK_QUANTILES
    )
    add("cuts", f"SELECT role, {cut_cols} FROM benchmarks GROUP BY role")
    tier_exprs = []
    for m in metrics:
        ladder = " ".join(
            f"WHEN a.{m} >= c.cut_{m}_{pv} THEN {_q(str(pv))}"
            for pv, _ in sorted(config.BENCHMARK_QUANTILES, reverse=True)
        )
        tier_exprs.append(f"CASE {ladder} ELSE 'Low' END AS {m}_tier")
    add("metric_tiers", "SELECT a.*, " + ",\n    ".join(tier_exprs) + " FROM active a LEFT JOIN cuts c ON c.role = a.role")
    key_roles = {m: [r for r, keys in config.ROLE_KEY_METRICS if m in keys] for m in metrics}

    def count(cond_key: bool, values: list[str]) -> str:
        parts = []
        for m in metrics:
            roles_in = ", ".join(_q(r) for r in key_roles[m]) or "NULL"
            key = f"role IN ({roles_in})" if key_roles[m] else "FALSE"
            if not cond_key:
                key = f"NOT ({key})"
            vals = ", ".join(_q(v) for v in values)
            parts.append(f"(CASE WHEN {key} AND {m}_tier IN ({vals}) THEN 1 ELSE 0 END)")
        return "(" + " + ".join(parts) + ")"

    k95, k75, k50, o75 = count(True, ["95"]), count(True, ["75", "95"]), count(True, ["50", "75", "95"]), count(False, ["75", "95"])
    add("active_tiers", f"""
  SELECT *,
    CASE WHEN {k95} >= 2 OR ({k95} = 1 AND {o75} >= 2) THEN '95'
         WHEN {k75} >= 2 OR ({k75} >= 1 AND {o75} >= 2) THEN '75'
         WHEN {k50} >= 1 THEN '50'
         ELSE 'Low' END AS overall_tier
  FROM metric_tiers""")
    return ctes


def with_chain(ctes: list[tuple[str, str]], select: str) -> str:
    body = ",\n".join(f"{name} AS ({sql}\n)" for name, sql in ctes)
    return f"WITH {body}\n{select}"


def _r(cols, rounded) -> str:
    return ", ".join(rnd(c) + f" AS {c}" if c in rounded else c for c in cols)


def oracle_queries(p: Params = STANDIN) -> dict[str, str]:
    from boxstar.plans.registered import ACTIVE_COLS, POOL_COLS, ROUNDED, SCORE_COLS, SIGNALS, TIER_COLS, WL_COLS

    ctes = base_ctes(p)
    chain = lambda select: with_chain(ctes, select)
    pct_col = f"win_pct_{p.top_since_year}_plus"
    out: dict[str, str] = {}

    out["csv_scan_na"] = """
SELECT p_partkey,
       CASE WHEN p_partkey % 17 = 0 THEN p_name || ' "q", x'
            WHEN p_partkey % 19 = 0 THEN p_name || chr(10) || 'second, line' ELSE p_name END AS p_name,
       CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_brand END AS p_brand,
       CASE WHEN p_partkey % 11 = 0 OR p_partkey % 13 = 0 THEN NULL ELSE p_type END AS p_type,
       p_size, p_retailprice
FROM part"""
    out["landing_roundtrip"] = "SELECT * FROM orders"
    q = "CAST(CAST(l_quantity AS INTEGER) AS VARCHAR)"
    text = (
        f"CASE WHEN l_linenumber = 1 THEN {q} || ':00' "
        f"WHEN l_linenumber = 2 THEN '  ' || {q} || ' ' "
        f"WHEN l_linenumber = 3 THEN CAST(CAST(l_quantity AS INTEGER) - 1 AS VARCHAR) || ':30' "
        f"WHEN l_linenumber = 4 THEN {q} || '.5' "
        f"WHEN l_linenumber = 5 THEN '-' || {q} || ':15' "
        f"WHEN l_linenumber = 6 AND l_partkey % 5 = 0 THEN {q} || ':34:56' "
        f"WHEN l_linenumber = 6 AND l_partkey % 5 = 1 THEN {q} || 'd' "
        f"WHEN l_linenumber = 6 AND l_partkey % 5 = 2 THEN ':30' "
        f"WHEN l_linenumber = 6 AND l_partkey % 5 = 3 THEN {q} || ':' "
        f"WHEN l_linenumber = 6 THEN 'abc' "
        f"ELSE {q} || 'e0' END"
    )
    out["parse_minutes"] = f"""
SELECT l_orderkey, l_linenumber, text, {minutes('text')} AS minutes
FROM (SELECT l_orderkey, l_linenumber, {text} AS text FROM lineitem) t"""
    out["clean_people"] = chain("""
SELECT personId, firstName, lastName, CAST(birthdate AS DATE) AS birthdate, lastAttended, country, height, bodyWeight,
       guard, forward, center, draftYear, draftRound, draftNumber
FROM players_clean""")
    out["dim_people"] = chain("SELECT * FROM players")
    out["dim_teams"] = chain("SELECT * FROM teams")
    out["team_lookup"] = chain("SELECT * FROM team_lookup")
    out["dim_games"] = chain("SELECT * FROM games")
    out["dim_dates"] = chain("SELECT * FROM dates")
    out["fact_player"] = chain("SELECT * FROM player_fact")
    out["fact_team"] = chain("SELECT * FROM team_fact")
    counts = " UNION ALL ".join(
        f"SELECT {_q(t)} AS table_name, COUNT(*) AS row_count FROM {src}"
        for t, src in (
            ("team_stats_raw", "team_clean"), ("player_stats_raw", "box_clean"), ("players_raw", "players_clean"),
            ("players", "players"), ("teams", "teams"), ("games", "games"), ("dates", "dates"),
            ("player_stats_fact", "player_fact"), ("team_stats_fact", "team_fact"),
        )
    )
    out["row_count_summary"] = chain(f"SELECT * FROM ({counts}) c ORDER BY table_name")
    out["duplicate_key_audit_players"] = chain("""
SELECT COUNT(*) AS total_rows, COUNT(DISTINCT personId) AS distinct_person_ids,
       COUNT(*) - COUNT(DISTINCT personId) AS duplicate_person_id_rows FROM players""")
    out["duplicate_key_audit_games"] = chain("""
SELECT COUNT(*) AS total_rows, COUNT(DISTINCT gameId) AS distinct_game_ids,
       COUNT(*) - COUNT(DISTINCT gameId) AS duplicate_game_id_rows FROM games""")
    out["duplicate_key_audit_lineitem"] = """
SELECT COUNT(*) AS total_rows, COUNT(DISTINCT l_orderkey) AS distinct_keys,
       COUNT(*) - COUNT(DISTINCT l_orderkey) AS duplicate_key_rows FROM lineitem"""
    amb = """
SELECT teamName, COUNT(*) AS dimension_rows, COUNT(DISTINCT teamCity) AS city_count, COUNT(DISTINCT coachId) AS coach_count
FROM {src} GROUP BY teamName HAVING COUNT(*) > 1 ORDER BY dimension_rows DESC, teamName"""
    out["ambiguous_name_audit"] = chain(amb.format(src="teams"))
    out["ambiguous_name_history"] = chain(amb.format(src="team_history"))
    miss = lambda c: f"CAST(SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing_{c.lower()}"
    out["missing_fk_player"] = chain(
        "SELECT " + ", ".join(miss(c) for c in ("playerKey", "teamKey", "opponentTeamKey", "gameKey", "dateKey")) + " FROM player_fact"
    )
    out["missing_fk_team"] = chain(
        "SELECT " + ", ".join(miss(c) for c in ("teamKey", "opponentTeamKey", "gameKey", "dateKey")) + " FROM team_fact"
    )
    out["flag_distribution"] = chain("""
SELECT guard, forward, center, COUNT(*) AS players FROM players GROUP BY guard, forward, center
ORDER BY players DESC, guard, forward, center""")
    years = ", ".join(str(y) for y in p.active_years)
    out["active_multi_flag"] = chain(f"""
SELECT COUNT(DISTINCT p.playerKey) AS active_multi_position_players
FROM players p JOIN player_fact f ON f.playerKey = p.playerKey JOIN dates d ON d.dateKey = f.dateKey
WHERE d.year IN ({years}) AND COALESCE(p.guard, 0) + COALESCE(p.forward, 0) + COALESCE(p.center, 0) > 1""")

    out["win_loss_summary"] = chain(f"SELECT {_r(('win', *WL_COLS), ROUNDED['win_loss_summary'])} FROM win_loss ORDER BY win")
    out["top_teams"] = chain("SELECT * FROM top_teams")
    out["team_profile"] = chain(f"SELECT {_r([c for c, _ in config.COUNT_LABELS], ROUNDED['team_profile'])} FROM team_profile")
    count_metrics = [c for c, _ in config.COUNT_LABELS]
    pct_metrics = [c for c, _ in config.PCT_LABELS]
    labels = ", ".join(
        [f"({_q(c)}, {_q(lbl)}, 'count')" for c, lbl in config.COUNT_LABELS]
        + [f"({_q(c)}, {_q(lbl)}, 'pct')" for c, lbl in config.PCT_LABELS]
    )
    unpiv = ", ".join(count_metrics + pct_metrics)
    out["driver_gap_table"] = chain(f"""
SELECT metric, label, kind, {rnd('Win')} AS Win, {rnd('Loss')} AS Loss,
       {rnd("CASE WHEN kind = 'count' THEN Win - Loss END")} AS gap
FROM (
  SELECT l.metric, l.label, l.kind,
         MAX(CASE WHEN u.win = 1 THEN u.value END) AS Win,
         MAX(CASE WHEN u.win = 0 THEN u.value END) AS Loss
  FROM (UNPIVOT win_loss ON {unpiv} INTO NAME metric VALUE value) u
  JOIN (VALUES {labels}) l(metric, label, kind) ON l.metric = u.metric
  GROUP BY l.metric, l.label, l.kind) g""")
    stat_labels = ", ".join(f"({_q(c)}, {_q(lbl)}, {i})" for i, (c, lbl) in enumerate(config.COUNT_LABELS))
    cm = ", ".join(count_metrics)
    out["team_vs_history"] = chain(f"""
SELECT l.stat, l.metric, {rnd('h.winning_avg')} AS winning_avg, {rnd('h.losing_avg')} AS losing_avg,
       {rnd('t.value')} AS team_wins_avg
FROM (VALUES {stat_labels}) l(metric, stat, ord)
LEFT JOIN (SELECT metric, MAX(CASE WHEN win = 1 THEN value END) AS winning_avg,
                  MAX(CASE WHEN win = 0 THEN value END) AS losing_avg
           FROM (UNPIVOT (SELECT win, {cm} FROM win_loss) ON {cm} INTO NAME metric VALUE value) u GROUP BY metric) h
  ON h.metric = l.metric
LEFT JOIN (UNPIVOT (SELECT {cm} FROM team_profile) ON {cm} INTO NAME metric VALUE value) t ON t.metric = l.metric
ORDER BY l.ord""")
    out["top_team_labels"] = chain(f"""
SELECT teamCity || ' ' || teamName AS label, teamName, teamCity, {pct_col}, games_count
FROM top_teams ORDER BY {pct_col} DESC, games_count DESC, teamName""")

    out["player_season_pool"] = chain(f"SELECT {_r(POOL_COLS, ROUNDED['player_season_pool'])} FROM pool")
    out["role_assignment"] = chain(
        f"SELECT {_r(('season_end_year', 'playerKey', *SIGNALS, 'role'), ROUNDED['role_assignment'])} FROM roles"
    )
    out["pillar_scores"] = chain(f"SELECT {_r(SCORE_COLS, ROUNDED['pillar_scores'])} FROM scored")
    out["role_benchmarks"] = chain(
        f"SELECT {_r(('role', 'metric', 'label', 'p50', 'p75', 'p95', 'pool_size'), ROUNDED['role_benchmarks'])} FROM benchmarks"
    )
    out["active_pool"] = chain(f"SELECT {_r(ACTIVE_COLS, ROUNDED['active_pool'])} FROM active")
    out["metric_tiers"] = chain(
        "SELECT playerKey, season_end_year, role, " + ", ".join(TIER_COLS) + " FROM metric_tiers"
    )
    out["overall_tier"] = chain("SELECT playerKey, season_end_year, role, overall_tier FROM active_tiers")
    out["season_window_label"] = chain(f"""
SELECT first_season, latest_season, {season_label('first_season')} || ' to ' || {season_label('latest_season')} AS window_label
FROM season_window""")
    out["benchmark_matrix"] = chain(
        f"SELECT {_r(('role', 'metric', 'label', 'p50', 'p75', 'p95', 'pool_size', 'role_order', 'metric_order'), ROUNDED['benchmark_matrix'])} "
        "FROM benchmarks ORDER BY metric_order, role_order"
    )
    role_rows = ", ".join(f"({_q(r)}, {i})" for i, r in enumerate(config.ROLE_ORDER))
    out["tier_distribution"] = chain(f"""
SELECT r.role, r.role_order,
       COUNT(*) FILTER (WHERE t.overall_tier = 'Low') AS tier_low,
       COUNT(*) FILTER (WHERE t.overall_tier = '50') AS tier_50,
       COUNT(*) FILTER (WHERE t.overall_tier = '75') AS tier_75,
       COUNT(*) FILTER (WHERE t.overall_tier = '95') AS tier_95,
       COUNT(t.overall_tier) AS total
FROM (VALUES {role_rows}) r(role, role_order) LEFT JOIN active_tiers t ON t.role = r.role
GROUP BY r.role, r.role_order ORDER BY r.role_order""")
    order_case = "CASE role " + " ".join(f"WHEN {_q(r)} THEN {i}" for i, r in enumerate(config.ROLE_ORDER)) + " END"
    out["leaderboard"] = chain(f"""
SELECT season_label AS season, role, current_rank_within_role AS role_rank, player, overall_tier AS tier,
       {rnd('historical_percentile_within_role')} AS historical_percentile
FROM (SELECT *, {order_case} AS role_order,
             ROW_NUMBER() OVER (PARTITION BY role ORDER BY current_rank_within_role ASC NULLS LAST, playerKey ASC) AS rn
      FROM active_tiers) t
WHERE rn <= {p.per_role}
ORDER BY role_order, role_rank, playerKey""")

    out["bucketed_key"] = "SELECT o_orderkey, o_orderdate, ROW_NUMBER() OVER (ORDER BY o_orderkey NULLS LAST) AS order_key FROM orders"
    out["bucketed_key_text"] = "SELECT c_custkey, c_name, ROW_NUMBER() OVER (ORDER BY c_name NULLS LAST) AS name_key FROM customer"
    out["bucketed_key_dates"] = """
SELECT l_shipdate, ROW_NUMBER() OVER (ORDER BY l_shipdate NULLS LAST) AS ship_key FROM (SELECT DISTINCT l_shipdate FROM lineitem) s"""
    out["bucketed_percentile_rank"] = f"""
SELECT l_returnflag, l_extendedprice, l_orderkey, l_linenumber,
       {rnd("(CAST(RANK() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice) AS DOUBLE) + CAST(COUNT(*) OVER (PARTITION BY l_returnflag, l_extendedprice) - 1 AS DOUBLE) / 2.0::DOUBLE) / CAST(COUNT(l_extendedprice) OVER (PARTITION BY l_returnflag) AS DOUBLE) * 100.0::DOUBLE")} AS pct
FROM lineitem"""
    out["bucketed_dense_rank"] = """
SELECT l_linestatus, l_quantity, l_orderkey, l_linenumber,
       DENSE_RANK() OVER (PARTITION BY l_linestatus ORDER BY l_quantity DESC) AS qty_rank
FROM lineitem"""
    out["exact_quantiles"] = f"""
SELECT l_returnflag, COUNT(l_extendedprice) AS n,
       {rnd('quantile_cont(l_extendedprice, 0.5)')} AS p50,
       {rnd('quantile_cont(l_extendedprice, 0.75)')} AS p75,
       {rnd('quantile_cont(l_extendedprice, 0.95)')} AS p95
FROM lineitem GROUP BY l_returnflag"""
    return out
