"""Column roles, types and fixed parameters of the card-transaction data."""

from __future__ import annotations

from pyspark.sql import types as T

TRANSACTION_ID = "TransactionID"
TIME = "TransactionDT"
LABEL = "isFraud"
CARD = "card1"

# The feature columns of each role, in vector order.
BINARY_FEATURES = ["V286", "V26"]
DISCRETE_FEATURES = ["weekdays", "minutes"]
CONTINUOUS_FEATURES = [
    "addr1", "addr2", "C7", "V97", "V183", "V236",
    "V279", "V280", "V290", "V306", "V308", "V317",
]

# The upper cap of each continuous column.
CAP_THRESHOLDS = {
    "addr1": 540.0,
    "addr2": 87.0,
    "C7": 10.0,
    "V97": 7.0,
    "V183": 4.0,
    "V236": 3.0,
    "V279": 5.0,
    "V280": 9.0,
    "V290": 3.0,
    "V306": 938.0,
    "V308": 1649.5,
    "V317": 1762.0,
}

# Fillers for missing features and the length of the training period.
DISCRETE_FILLER = -999.0
CONTINUOUS_FILLER = 0.0
TRAIN_SECONDS = 30 * 24 * 3600

RAW_FEATURES = BINARY_FEATURES + CONTINUOUS_FEATURES

TRANSACTION_SCHEMA = T.StructType(
    [
        T.StructField(TRANSACTION_ID, T.LongType()),
        T.StructField(TIME, T.LongType()),
        T.StructField(LABEL, T.IntegerType()),
        T.StructField(CARD, T.LongType()),
    ]
    + [T.StructField(name, T.DoubleType()) for name in RAW_FEATURES]
)

# Live messages carry everything but the label.
SCORING_SCHEMA = T.StructType([f for f in TRANSACTION_SCHEMA.fields if f.name != LABEL])

SENSOR_SCHEMA = T.StructType(
    [
        T.StructField("device_id", T.LongType()),
        T.StructField("ts", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)
