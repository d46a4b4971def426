"""Names and numbers that the results depend on.

Everything here is a literal that has to stay as it is for results to agree with
the churn pipeline this library re-expresses. Nothing here is computed.
"""

# Raw event columns kept by the cleaning step.
EVENT_COLUMNS = (
    "userId",
    "gender",
    "location",
    "level",
    "sessionId",
    "page",
    "artist",
    "song",
    "length",
    "userAgent",
    "registration",
    "ts",
)

# Columns added to an event by cleaning and indexing.
DERIVED_COLUMNS = (
    "userIdIndex",
    "artistIndex",
    "elapsed",
    "timestamp",
    "registration_date",
    "elapsed_days",
)

# Page names with a meaning of their own.
SONG_PAGE = "NextSong"
CHURN_PAGE = "Cancellation Confirmation"
CANCEL_PAGES = ("Cancel", "Cancellation Confirmation")

# Fixed value: the plan whose share is left out, since the shares sum to 1.
BASE_LEVEL = "free"

# Time units and the length of the most recent period.
SECOND_MS = 1000
DAY_MS = 24 * 60 * 60 * 1000
RECENT_DAYS = 7
HOURS = tuple(range(24))

# Class labels and their display names.
LABELS = (0, 1)
LABEL_NAMES = {0: "Not Cancelled", 1: "Cancelled"}

# Latent factor model.
# Blocks of users and of items in the factorisation: what Spark takes by itself.
ALS_BLOCKS = 10
ALS_RANK = 20
ALS_REG = 0.01

# Hold-out split and forest size.
SPLIT = (0.75, 0.25)
SEED = 42
TREES = 100

# Classifiers; on equal scores the earlier one is chosen.
CLASSIFIER_PRIORITY = ("linear_svm", "logistic_regression", "random_forest")

# Fixed value: number of bars in the age histograms.
HISTOGRAM_BINS = 10
