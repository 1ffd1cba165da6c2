"""Small dimension tables.

The lists below are FIXED VALUES that must equal the original application's
for the results to agree (names, coordinates, encodings and weights). They are
stated plainly, in their natural order. Every table here is bounded (at most a
few dozen rows), which is what makes broadcasting them safe at any data size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# ---- FIXED VALUES (must match the original application) -------------------

# The 30 canonical cuisine names, most frequent first.
CUISINES = [
    "North Indian", "Chinese", "South Indian", "Mughlai", "Cafe", "Bakery",
    "Italian", "Fast Food", "Continental", "Desserts", "Biryani", "Street Food",
    "Ice Cream", "Andhra", "Thai", "Kerala", "Seafood", "Bengali", "Rajasthani",
    "Goan", "Japanese", "Korean", "Mexican", "Mediterranean", "Lebanese",
    "American", "French", "German", "Vietnamese", "Middle Eastern",
]

# Bangalore area centroids (latitude, longitude), in lookup order.
CENTROIDS = [
    ("Koramangala", 12.9352, 77.6245),
    ("Indiranagar", 12.9784, 77.6408),
    ("HSR Layout", 12.9116, 77.6389),
    ("Whitefield", 12.9698, 77.7500),
    ("Electronic City", 12.8456, 77.6602),
    ("JP Nagar", 12.8911, 77.5851),
    ("BTM Layout", 12.9166, 77.6101),
    ("Marathahalli", 12.9562, 77.7011),
    ("Jayanagar", 12.9293, 77.5841),
    ("MG Road", 12.9758, 77.6062),
    ("HSR", 12.9116, 77.6389),
    ("Bannerghatta Road", 12.8880, 77.6000),
    ("Rajajinagar", 12.9878, 77.5544),
    ("Vijayanagar", 12.9735, 77.5425),
    ("Basavanagudi", 12.9408, 77.5722),
    ("Malleshwaram", 13.0034, 77.5651),
    ("Yelahanka", 13.1076, 77.5659),
    ("Hebbal", 13.0358, 77.5970),
    ("Sarjapur Road", 12.9010, 77.6870),
    ("Old Airport Road", 12.9604, 77.6464),
]

# Weather text (lower case) -> ordinal; anything else is 1.
WEATHER_CODES = {"sunny": 0, "cloudy": 1, "fog": 2, "sandstorms": 2, "windy": 3, "stormy": 4, "rainy": 4}

# Road traffic density -> ordinal; anything else is 1.
TRAFFIC_CODES = {"Low": 0, "Medium": 1, "High": 2, "Jam": 3}

# Congestion labels of a traffic feed -> level; anything else is 1.
CONGESTION_CODES = {"low": 0, "medium": 1, "high": 2, "jam": 3}

# Order hours counted as rush hour.
RUSH_HOURS = [8, 9, 10, 13, 14, 18, 19, 20]

# Reliability weight profiles for the scenario comparison: (profile, w_rating, w_sentiment, w_delay).
WEIGHT_PROFILES = [
    ("balanced", 0.4, 0.3, 0.3),
    ("quality_first", 0.5, 0.3, 0.2),
    ("speed_first", 0.2, 0.2, 0.6),
]

# Hybrid recommender profiles: (priority, content, collaborative, reliability, bayesian).
HYBRID_PROFILES = [
    ("balanced", 0.4, 0.3, 0.3, 0.0),
    ("speed", 0.2, 0.2, 0.5, 0.1),
    ("quality", 0.25, 0.25, 0.1, 0.4),
]

# Weightings of the rank-sensitivity study: (label, w_rating, w_sentiment, w_delay).
SENSITIVITY_WEIGHTINGS = [
    ("Default (0.4/0.3/0.3)", 0.4, 0.3, 0.3),
    ("Rating-heavy (0.6/0.2/0.2)", 0.6, 0.2, 0.2),
    ("Sentiment-heavy (0.2/0.5/0.3)", 0.2, 0.5, 0.3),
    ("Delay-penalizing (0.3/0.3/0.4)", 0.3, 0.3, 0.4),
]

# Central delivery point used by the concierge ETA estimate.
CITY_CENTRE = (12.97, 77.59)

# ---------------------------------------------------------------------------


def cuisine_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, c) for i, c in enumerate(CUISINES)], "ord int, cuisine string")


def centroid_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [(i, n, la, lo) for i, (n, la, lo) in enumerate(CENTROIDS)],
        "ord int, area string, latitude double, longitude double",
    )


def weight_profiles(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [(i, p, a, b, c) for i, (p, a, b, c) in enumerate(WEIGHT_PROFILES)],
        "profile_ord int, profile string, w_rating double, w_sentiment double, w_delay double",
    )


def hybrid_profiles(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        list(HYBRID_PROFILES),
        "priority string, w_content double, w_collaborative double, w_reliability double, w_bayesian double",
    )


def frame(spark: SparkSession, rows, schema: str | T.StructType) -> DataFrame:
    return spark.createDataFrame(rows, schema)
