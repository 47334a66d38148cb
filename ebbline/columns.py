"""Column names of the gold feature table and the groups other modules need."""

# The gold contract, in output order.
ID_COLUMN = "user_id"
TARGET_COLUMN = "churn"

DIRECT_IDENTIFIER_COLUMNS = ["email", "firstname", "lastname", "address"]

FEATURE_COLUMNS = [
    "age_group",
    "gender",
    "canal",
    "country",
    "order_count",
    "total_amount",
    "avg_order_amount",
    "total_items",
    "event_count",
    "session_count",
    "platform",
    "days_since_creation",
    "days_since_last_activity",
    "days_since_last_transaction",
    "days_since_last_event",
]

STRING_FEATURES = ["canal", "country", "platform"]
# End of fixed values.

GOLD_COLUMNS = [ID_COLUMN] + FEATURE_COLUMNS + [TARGET_COLUMN]
NUMERIC_FEATURES = [name for name in FEATURE_COLUMNS if name not in STRING_FEATURES]

# age_group and gender are codes, so only the remaining measures have a lower bound of zero.
NON_NEGATIVE_FEATURES = [name for name in NUMERIC_FEATURES if name not in ("age_group", "gender")]
