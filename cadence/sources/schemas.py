"""Schemas of the message stream and the layer tables."""

from __future__ import annotations

from pyspark.sql import types as T

# The 23 message fields in message order, with their types.
MESSAGE_FIELDS = [
    ("kafka_timestamp", T.StringType()),
    ("user_id", T.StringType()),
    ("event_type", T.StringType()),
    ("track_id", T.StringType()),
    ("track_name", T.StringType()),
    ("artists", T.StringType()),
    ("album_name", T.StringType()),
    ("track_genre", T.StringType()),
    ("popularity", T.IntegerType()),
    ("duration_ms", T.IntegerType()),
    ("explicit", T.StringType()),
    ("danceability", T.FloatType()),
    ("energy", T.FloatType()),
    ("key", T.IntegerType()),
    ("loudness", T.FloatType()),
    ("mode", T.IntegerType()),
    ("speechiness", T.FloatType()),
    ("acousticness", T.FloatType()),
    ("instrumentalness", T.FloatType()),
    ("liveness", T.FloatType()),
    ("valence", T.FloatType()),
    ("tempo", T.FloatType()),
    ("time_signature", T.IntegerType()),
]

MESSAGE_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in MESSAGE_FIELDS])
MESSAGE_COLUMNS = [n for n, _ in MESSAGE_FIELDS]

# Audio features that are 32-bit floats in the message.
FLOAT_FEATURES = [n for n, t in MESSAGE_FIELDS if isinstance(t, T.FloatType)]

# The ten features the exploration step profiles (boxes, correlation).
AUDIO_FEATURES = [
    "popularity", "danceability", "energy", "loudness", "speechiness",
    "acousticness", "instrumentalness", "liveness", "valence", "tempo",
]

# Added by the feature step, in table order.
ENGINEERED_FEATURES = [
    "energy_danceability_ratio", "loudness_normalized", "tempo_category",
    "energy_acoustic_contrast", "dancefloor_score",
]

FEATURE_TABLE_COLUMNS = MESSAGE_COLUMNS + ENGINEERED_FEATURES

# Model frame: label plus fifteen features (fourteen numeric, one categorical).
LABEL_COLUMN = "track_genre"
MODEL_FEATURES = [
    "danceability", "energy", "loudness_normalized", "speechiness", "acousticness",
    "instrumentalness", "liveness", "valence", "tempo_category",
    "energy_acoustic_contrast", "dancefloor_score", "popularity", "key", "mode",
    "time_signature",
]
MODEL_NUMERIC = [c for c in MODEL_FEATURES if c != "tempo_category"]
MODEL_CATEGORICAL = ["tempo_category"]

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType(), True),
    T.StructField("ts", T.TimestampNTZType(), True),
    T.StructField("user_id", T.LongType(), True),
    T.StructField("event_type", T.StringType(), True),
    T.StructField("value", T.DoubleType(), True),
    T.StructField("props", T.StringType(), True),
])
