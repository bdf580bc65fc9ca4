from actionlens.functions.expr import (  # noqa: F401
    age_rank, age_years, day_offset, days_since, decay_weight, elapsed_whole_days,
    flag_positive, one_hot, pair_key, safe_ratio, ts_lit, date_lit, SEGMENT_AGE_CODES,
)
