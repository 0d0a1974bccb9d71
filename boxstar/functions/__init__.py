"""Column expressions: all native Spark functions, no Python UDFs."""

from boxstar.functions.cleaning import (  # noqa: F401
    decode_flag,
    mask_outside,
    mask_values,
    normalize_game_type,
    null_na_tokens,
    parse_minutes,
    parse_timestamp,
    to_flag,
    to_double,
    to_whole,
)
from boxstar.functions.calendar import (  # noqa: F401
    day_of_week_sunday0,
    season_end_year,
    season_label,
)
from boxstar.functions.numeric import (  # noqa: F401
    arg_max,
    count_true,
    round_half_away,
    safe_ratio,
    threshold_ladder,
    weighted_sum,
)
