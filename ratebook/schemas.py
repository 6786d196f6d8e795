"""Schemas at every boundary (explicit, never inferred)."""

from pyspark.sql import types as T

# Quoted rates are exact decimals: twelve integer digits and twelve decimals
# (a text with more of either is refused).  A derived rate is also kept as the
# ratio it comes from, so that it is divided, scaled and rounded only once.
RATE = T.DecimalType(24, 12)
WIDE_RATE = T.DecimalType(38, 20)
RATIO = T.DecimalType(26, 12)
OUT_RATE = T.DecimalType(18, 5)
FACTOR = T.DecimalType(9, 0)
REF_RATE = T.DecimalType(18, 5)

# One downloaded quote document: a period and a list of items.
QUOTE_FILE = T.StructType([
    T.StructField("start", T.StringType()),
    T.StructField("end", T.StringType()),
    T.StructField("items", T.ArrayType(T.StructType([
        T.StructField("code", T.StringType()),
        T.StructField("buyValue", T.StringType()),
        T.StructField("sellValue", T.StringType()),
    ]))),
])

PAGES = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()),
])

# Pages of a growing archive: the day of capture and the capture's number.
CAPTURES = T.StructType([
    *PAGES.fields,
    T.StructField("captured_on", T.DateType()),
    T.StructField("capture_id", T.LongType()),
])

# Reference factors per pair and date (the receiving system's rate table).
REF_RATES = T.StructType([
    T.StructField("rate_date", T.DateType()),
    T.StructField("from_curr", T.StringType()),
    T.StructField("to_curr", T.StringType()),
    T.StructField("from_factor", FACTOR),
    T.StructField("kursf", REF_RATE),
    T.StructField("to_factor", FACTOR),
])

# Output layout for the ERP rate table: ten text columns in this order.
ERP_COLUMNS = [
    "FROM_CURR", "TO_CURRNCY", "EXCH_RATE", "VALID_FROM", "RATE_TYPE",
    "FROM_FACTOR", "TO_FACTOR", "EXCH_RATE_V", "FROM_FACTOR_V", "TO_FACTOR_V",
]

# Output layout for the keyed rate table.
BPM_COLUMNS = ["Currency", "Currency2", "Rate", "RateDate"]
BPM_KEYS = ["Currency", "Currency2", "RateDate"]

EXCHANGE_RATE = T.StructType([
    T.StructField("Currency", T.StringType()),
    T.StructField("Currency2", T.StringType()),
    T.StructField("Rate", OUT_RATE),
    T.StructField("RateDate", T.StringType()),
])

