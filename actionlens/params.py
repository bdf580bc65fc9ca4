"""Default parameters of the shipped analyses (FIXTURES.md dates)."""

from __future__ import annotations

# Fixed values (must equal the original analysis for equal results):
# behaviour type codes of the action log, look-back windows, the score
# threshold and the submission size.
BROWSE, ADD_CART, DEL_CART, PURCHASE, FOLLOW, CLICK = 1, 2, 3, 4, 5, 6
TYPES = (1, 2, 3, 4, 5, 6)
NON_PURCHASE_TYPES = (1, 2, 3, 5, 6)

# Look-back windows in days.
PAIR_WINDOWS = (1, 2, 3, 5, 7, 10, 15, 21)          # pair features (first generation)
ACC_WINDOWS = (1, 2, 3, 5, 7, 10, 15, 21, 30)       # user / sku accumulations
SHORT_WINDOWS = (1, 2, 3, 4, 5, 6, 7)               # later generations

# Dates of the shipped fixture (driver tables: events span 2024-01-01..01-30).
FEATURE_END = "2024-01-25"
LABEL_START = "2024-01-25"
LABEL_END = "2024-01-30"
HISTORY_START = "2023-12-31"        # earliest date a past purchase is looked for
CURVE_DAYS = 20
COMMENT_CUTOFF = "2000-06-15"
REG_BASE_DATE = "1995-07-01"        # base date for registration day counts
TARGET_CATE = "PROMO"

SCORE_THRESHOLD = 0.03
SUBMISSION_K = 900
