"""Default thresholds and settings.

Fixed values: these numbers define the published behaviour of each step, so
they are stated here once, in step order, and used as keyword defaults.
"""

# Loading
SENTINELS = (-1, -999, -1111)
EXCLUDED_FEATURES = ("gender", "race", "nationality", "religion", "user_id")

# Abnormal months
MIN_MONTH_BAD = 10
MIN_MONTH_ROWS = 500

# Missing rate
MISSING_THRESHOLD = 0.6

# Information value
IV_BINS = 5
IV_THRESHOLD = 0.02
ORG_IV_THRESHOLD = 0.02
MAX_ORG_LOW_IV = 2
MIN_VALUES_TO_BIN = 50

# Population stability
PSI_BINS = 10
PSI_THRESHOLD = 0.10
MAX_MONTHS_RATIO = 1 / 3
MAX_UNSTABLE_ORGS = 6
PSI_MIN_SAMPLE = 100
SHARE_FLOOR = 1e-6

# Null importance
NULL_TREES = 100
NULL_DEPTH = 5
NULL_RUNS = 5
NULL_GAIN_THRESHOLD = 50.0
NULL_GAIN_RATIO = 2.0

# Correlation
CORRELATION_THRESHOLD = 0.8
VIF_THRESHOLD = 5.0

# Weight of evidence and scorecard
WOE_BINS = 10
WOE_MIN_BIN_SHARE = 0.05
WOE_LIMIT = 5.0
SCORE_PDO = 20
SCORE_BASE = 600
SCORE_BASE_ODDS = 50
LR_C = 1.0
LR_MAX_ITER = 1000

# Split and folds
TEST_SIZE = 0.15
VAL_SIZE = 0.15
CV_FOLDS = 5
SEARCH_TRIALS = 20
RANDOM_SEED = 42

# Evaluation pass lines
AUC_PASS = 0.70
KS_PASS = 0.30
GINI_PASS = 0.40
TOP_LIFT_PASS = 3.0
SEGMENT_MIN_ROWS = 50

# Monitoring
MONITOR_PSI = 0.10
MONITOR_PSI_HIGH = 0.25
MONITOR_MISSING_CHANGE = 0.05
MONITOR_AUC_DROP = 0.05
MONITOR_AUC_DROP_HIGH = 0.10
MONITOR_BAD_RATE_CHANGE = 0.01

# Bands of the distribution reports, as [lower, upper)
IV_BANDS = (0.0, 0.02, 0.05, 0.1, float("inf"))
PSI_BANDS = (0.0, 0.05, 0.1, float("inf"))
VALUE_BANDS = (0.0, 0.15, 0.35, 0.65, 0.95, 1.0)

# Sample checks
GATE_BAD_RATE = (0.005, 0.30)
GATE_MIN_ROWS = 10_000
GATE_MIN_BADS = 500
GATE_FEATURES = (10, 200)
