"""Column roles and fixed parameters of the transaction table."""

from __future__ import annotations

from pyspark.sql import types as T

# Names and numbers that results depend on.
TARGET = "is_fraud"
KEY = "trans_num"
TIME_COLUMN = "unix_time"
BIRTH_COLUMN = "dob"
DISTANCE = "customer_merchant_distance_km"
AGE = "customer_age"

RAW_SCHEMA = T.StructType(
    [
        T.StructField("trans_date_trans_time", T.StringType()),
        T.StructField("cc_num", T.StringType()),
        T.StructField("merchant", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("amt", T.DoubleType()),
        T.StructField("first", T.StringType()),
        T.StructField("last", T.StringType()),
        T.StructField("gender", T.StringType()),
        T.StructField("street", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("zip", T.StringType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("long", T.DoubleType()),
        T.StructField("city_pop", T.DoubleType()),
        T.StructField("job", T.StringType()),
        T.StructField("dob", T.DateType()),
        T.StructField("trans_num", T.StringType()),
        T.StructField("unix_time", T.LongType()),
        T.StructField("merch_lat", T.DoubleType()),
        T.StructField("merch_long", T.DoubleType()),
        T.StructField("is_fraud", T.BooleanType()),
        T.StructField("source_dataset", T.StringType()),
    ]
)

MEDIAN_FILLED = ("amt", "lat", "long", "city_pop", "unix_time", "merch_lat", "merch_long")
MODE_FILLED = (
    "merchant", "category", "first", "last", "gender", "street", "city", "state", "zip",
    "job", "dob", "trans_date_trans_time", "cc_num", "source_dataset",
)
UNKNOWN_FILLED = ("merchant", "job", "zip")
UNKNOWN = "Unknown"
MISSING = "__missing__"

TEXT_IDENTIFIERS = ("cc_num", "zip")
ONE_HOT = ("category", "gender")
FREQUENCY_ENCODED = ("job", "zip")
REDUCED_AWAY = (
    "Unnamed: 0", "trans_date_trans_time", "unix_time", "cc_num", "merchant", "first", "last",
    "street", "city", "state", "lat", "long", "dob", "trans_num", "merch_lat", "merch_long",
    "source_dataset",
)

TRUE_WORDS = ("true", "1", "yes")
WEEKEND_DAYS = (5, 6)
NIGHT_HOURS = (22, 23, 0, 1, 2, 3, 4, 5, 6)
WEEKDAY_LABELS = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")
EARTH_RADIUS_KM = 6371.0
DAYS_PER_YEAR = 365.25
DISTANCE_EDGES_KM = (10, 25, 50, 100, 250)
DISTANCE_LABELS = ("0-10", "10-25", "25-50", "50-100", "100-250", "250+")

CYCLES = {"transaction_hour": 24, "transaction_day_of_week": 7, "transaction_month": 12}
LOG_ROBUST = ("amt", "city_pop", "customer_merchant_distance_km")
STANDARDISED = ("customer_age",)
MINMAX_SCALED = ("transaction_day_of_month",)
CORRELATED = (
    "amt", "customer_merchant_distance_km", "transaction_hour", "transaction_day_of_week",
    "transaction_month", "is_night", "is_weekend", "customer_age", "city_pop", "gender_F",
    "gender_M", "is_fraud",
)

SEED = 42
SAMPLE_RATE = 0.05
TEST_SHARE = 0.20
SCATTER_NEGATIVES = 60_000
CAP_QUANTILE = 0.995
RECALL_GOAL = 0.80
FPR_GOAL = 0.02
TRAIN_GRID_POINTS = 300
EVAL_GRID_POINTS = 240
GRID_SPAN = (0.001, 0.999)
HISTOGRAM_BINS = 80
DISTANCE_HISTOGRAM_BINS = 40
TOP_VALUES = 10
