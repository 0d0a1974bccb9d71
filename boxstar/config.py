"""Fixed values of the analysis and the default parameters of the recipes.

Everything in the "fixed values" block below defines the semantics of the
original analysis and must not be changed: NA tokens, the game-type map,
role signal weights, pillar blends, role weights, key metrics and labels.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# fixed values (must equal the original analysis)
# ---------------------------------------------------------------------------

# Tokens read as missing by the CSV reader: the three extra tokens of the
# original reader ("", "None", "NULL") plus the pandas default NA list.
NA_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# Position flag text -> 0/1; anything else becomes NULL.
FLAG_TRUE = ("True", "true", "1")
FLAG_FALSE = ("False", "false", "0")
# Words that make a column boolean when it holds nothing else.
FLAG_WORDS = ("True", "TRUE", "true", "False", "FALSE", "false")

# Draft fields: sentinel values meaning "unknown".
DRAFT_SENTINELS = (-1, -22)

# Plausible ranges (inclusive) for player attributes.
HEIGHT_RANGE = (65.0, 90.0)
WEIGHT_RANGE = (120.0, 400.0)

# Source column renames for the player file.
PLAYER_RENAMES = {
    "birthDate": "birthdate",
    "school": "lastAttended",
    "heightInches": "height",
    "bodyWeightLbs": "bodyWeight",
}

# Game type normalisation (compared after trim + lower).
GAME_TYPE_PRESEASON = "preseason"  # compared with all spaces removed
GAME_TYPE_REGULAR = "regular season"
GAME_TYPE_CUP = ("emirates nba cup", "in-season-knockout")
GAME_TYPE_LABELS = {
    "preseason": "Preseason",
    "regular": "Regular Season",
    "cup": "In-Season Tournament",
    "unknown": "Unknown",
}

# Season attribution: games from this month on count for the next season.
SEASON_START_MONTH = 10

# Per-unit scale of the rate metrics (per 36 minutes).
PER_MINUTES = 36.0

# Rate metrics of a player-season: name -> summed box-score column.
RATE_METRICS = (
    ("pts36", "points"),
    ("ast36", "assists"),
    ("stl36", "steals"),
    ("blk36", "blocks"),
    ("tpm36", "threePointersMade"),
    ("tpa36", "threePointersAttempted"),
    ("dreb36", "reboundsDefensive"),
    ("oreb36", "reboundsOffensive"),
    ("tov36", "turnovers"),
)

# Metrics standardised for the role signals, in this order.
ZSCORE_METRICS = (
    "pts36",
    "ast36",
    "stl36",
    "blk36",
    "tpm36",
    "dreb36",
    "oreb36",
    "tov36",
    "fg_pct",
    "tp_pct",
)

# Role signals: role -> ordered (metric, weight) terms on z-scores.
ROLE_SIGNALS = (
    ("Creator", (("ast36", 1.00), ("pts36", 0.45), ("tpm36", 0.30), ("oreb36", -0.15), ("blk36", -0.10))),
    ("Wing", (("pts36", 0.70), ("tpm36", 0.55), ("tp_pct", 0.30), ("stl36", 0.35), ("dreb36", 0.15))),
    ("Big", (("pts36", 0.40), ("dreb36", 0.60), ("oreb36", 0.70), ("blk36", 0.70), ("fg_pct", 0.35), ("tpm36", -0.35))),
)
ROLE_ORDER = ("Creator", "Wing", "Big")

# Interior override: a Wing with (dreb36 + oreb36 >= 11 or blk36 >= 1.5)
# and tpm36 < 1.8 becomes a Big.
INTERIOR_REBOUNDS = 11.0
INTERIOR_BLOCKS = 1.5
INTERIOR_MAX_TPM = 1.8

# Pillars: name -> ordered (metric, weight, ascending) percentile terms.
PILLARS = (
    ("pillar_scoring", (("pts36", 1.0, True),)),
    ("pillar_playmaking", (("ast36", 0.75, True), ("tov36", 0.25, False))),
    ("pillar_shooting", (("tpm36", 0.65, True), ("tp_pct", 0.35, True))),
    ("pillar_defense", (("stl36", 0.55, True), ("blk36", 0.45, True))),
    ("pillar_rebounding", (("dreb36", 0.70, True), ("oreb36", 0.30, True))),
)

# Role weights of the pillars (scoring, playmaking, shooting, defense, rebounding).
ROLE_WEIGHTS = (
    ("Creator", (0.25, 0.35, 0.20, 0.10, 0.10)),
    ("Wing", (0.30, 0.10, 0.25, 0.20, 0.15)),
    ("Big", (0.20, 0.05, 0.05, 0.35, 0.35)),
)

# Benchmark metrics and their labels, in report order.
BENCHMARK_METRICS = (
    ("pts36", "Points per 36 min"),
    ("ast36", "Assists per 36 min"),
    ("tpm36", "3P Made per 36 min"),
    ("stl36", "Steals per 36 min"),
    ("reb36", "Rebounds per 36 min"),
    ("blk36", "Blocks per 36 min"),
)
BENCHMARK_QUANTILES = ((50, 0.50), (75, 0.75), (95, 0.95))

# Key metrics per role for the overall tier.
ROLE_KEY_METRICS = (
    ("Creator", ("pts36", "ast36", "tpm36")),
    ("Wing", ("pts36", "tpm36", "stl36")),
    ("Big", ("pts36", "reb36", "blk36")),
)
TIER_ORDER = ("Low", "50", "75", "95")

# Team box-score averages of the win/loss summary: (column, scaled by 100).
WIN_LOSS_COLUMNS = (
    ("assists", False),
    ("blocks", False),
    ("steals", False),
    ("fieldGoalsMade", False),
    ("threePointersMade", False),
    ("freeThrowsMade", False),
    ("reboundsDefensive", False),
    ("reboundsOffensive", False),
    ("benchPoints", False),
    ("fieldGoalsPercentage", True),
    ("threePointersPercentage", True),
    ("freeThrowsPercentage", True),
    ("foulsPersonal", False),
    ("turnovers", False),
)

# Counting stats of the driver table and of the team comparison, with labels.
COUNT_LABELS = (
    ("assists", "Assists"),
    ("blocks", "Blocks"),
    ("steals", "Steals"),
    ("fieldGoalsMade", "FG Made"),
    ("threePointersMade", "3P Made"),
    ("freeThrowsMade", "FT Made"),
    ("reboundsDefensive", "Def. Rebounds"),
    ("reboundsOffensive", "Off. Rebounds"),
    ("foulsPersonal", "Fouls"),
    ("turnovers", "Turnovers"),
    ("benchPoints", "Bench Points"),
)
PCT_LABELS = (
    ("fieldGoalsPercentage", "FG%"),
    ("threePointersPercentage", "3PT%"),
    ("freeThrowsPercentage", "FT%"),
)

# Tables of the warehouse, as listed by the table audit.
WAREHOUSE_TABLES = (
    "team_stats_raw",
    "player_stats_raw",
    "players_raw",
    "players",
    "teams",
    "games",
    "dates",
    "player_stats_fact",
    "team_stats_fact",
)

# Columns of box rows that say who played when, where and against whom, and who won.
GAME_COLUMNS = (
    "personId",
    "gameId",
    "gameDateTimeEst",
    "gameType",
    "playerteamName",
    "opponentteamName",
    "teamName",
    "teamCity",
    "opponentTeamName",
    "coachId",
    "home",
    "win",
)

# Column orders and types of the players dimension and the two facts.
PLAYER_COLUMNS = (
    ("personId", "long"),
    ("firstName", "string"),
    ("lastName", "string"),
    ("birthdate", "date"),
    ("lastAttended", "string"),
    ("country", "string"),
    ("height", "double"),
    ("bodyWeight", "double"),
    ("guard", "int"),
    ("forward", "int"),
    ("center", "int"),
    ("draftYear", "double"),
    ("draftRound", "double"),
    ("draftNumber", "double"),
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

# Columns without which the inputs cannot be read as box scores.
REQUIRED_COLUMNS = {
    "players": ("personId", "firstName", "lastName"),
    "player_stats": ("personId", "gameId", "gameDateTimeEst", "gameType", "playerteamName", "opponentteamName", "numMinutes", *BOX_STATS),
    "team_stats": ("gameId", "gameDateTimeEst", "teamName", "teamCity", "opponentTeamName", "coachId", *TEAM_STATS),
}

# ---------------------------------------------------------------------------
# fixed values: default parameters (the original analysis values)
# ---------------------------------------------------------------------------

POOL_MIN_MINUTES = 750
POOL_MIN_GAMES = 30
TP_PCT_MIN_ATTEMPTS = 125
FG_PCT_MIN_ATTEMPTS = 250
ACTIVE_MIN_MINUTES = 1000
ACTIVE_MIN_GAMES = 30
ACTIVE_YEARS = (2024, 2025)
RECENT_SEASONS = 3
TOP_TEAMS_SINCE_YEAR = 2024
TOP_TEAMS_MIN_GAMES = 100
TOP_TEAMS_LIMIT = 10
PROFILE_TEAM = "thunder"
LEADERBOARD_PER_ROLE = 5

# ---------------------------------------------------------------------------
# own parameters
# ---------------------------------------------------------------------------

# Time formats tried in this order on a column's first value.
TIMESTAMP_FORMATS = (
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ssXXX",
    "yyyy-MM-dd HH:mm",
    "yyyy-MM-dd",
    "MM/dd/yyyy HH:mm:ss",
    "MM/dd/yyyy HH:mm",
    "MM/dd/yyyy",
)

#: Dimensions of up to so many rows are joined to the whole fact (the planner broadcasts
#: them); where two are larger, keys are resolved on the key columns alone.
DIRECT_JOIN_ROWS = 500_000
