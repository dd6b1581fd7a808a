"""Tunable constants shared by every operator, test and query.

Fixed values: these must equal the reference's settings for results to match.
They are stated plainly, together, in their natural order.
"""

from __future__ import annotations

# --- fixed values (data) ----------------------------------------------------
MARKET_SYMBOL = "MKT_EW"
LIVE_MARKET_SYMBOL = "^GSPC"
MIN_ROWS_REQUIRED = 260
DEFAULT_LIVE_PERIOD_YEARS = 8

# --- fixed values (features) ------------------------------------------------
RSI_WINDOW = 14
MACD_FAST = 12
MACD_SLOW = 26
MACD_SIGNAL = 9
BOLLINGER_WINDOW = 20
BOLLINGER_STD = 2.0
SMA_WINDOWS = (5, 10, 20, 50)
EMA_WINDOWS = (10, 20)
MOMENTUM_WINDOWS = (3, 5, 10, 20)
VOLATILITY_WINDOWS = (5, 10, 20)
VOLUME_SMA_WINDOW = 20
WARMUP_ROWS = 60
TRADING_DAYS_PER_YEAR = 252
MARKET_COVERAGE_MIN = 0.5
NULL_SHARE_MAX = 0.02

# --- fixed values (modelling and signal) ------------------------------------
TRAIN_FRACTION = 0.70
VALIDATION_FRACTION = 0.15
RANDOM_STATE = 42
CV_SPLITS = 5
BULLISH_THRESHOLD = 0.55
BEARISH_THRESHOLD = 0.45
TRANSACTION_COST_BPS = 5.0
MIN_SPLIT_ROWS = 100
LOGISTIC_C = 0.1
CORRELATION_TOP_N = 20
IMPORTANCE_TOP_N = 15
PERMUTATION_REPEATS = 10
RAW_VIEW_ROWS = 250
HISTOGRAM_BINS = 70

# --- fixed values (labels) --------------------------------------------------
REQUIRED_COLUMNS = ("open", "high", "low", "close", "volume")
OHLCV_COLUMNS = ("open", "high", "low", "close", "adj_close", "volume")
WEEKDAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday")
MONTH_NAMES = ("Jan", "Feb", "Mar", "Apr", "May", "Jun",
               "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
SIGNAL_BULLISH = "Bullish"
SIGNAL_NEUTRAL = "Neutral"
SIGNAL_BEARISH = "Bearish"
SIGNAL_ORDER = (SIGNAL_BEARISH, SIGNAL_NEUTRAL, SIGNAL_BULLISH)
TARGET_COLUMN = "target_up_next_day"
SNAPSHOT_FILE_PATTERN = r"([A-Za-z.\-]+)_data\.csv$"

# Parameters of the deterministic score used to exercise metrics and the
# signal study without a fitted model (build plan step 7).
SCORE_SLOPE = 10.0

#: Rows of a series that one task works through at a time (scans and frames).
SLICE_ROWS = 4096
