"""Ordered CASE rules: the first rule that holds names the bucket."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Rules = Sequence[tuple[float, str]]


def first_match(rules: Sequence[tuple[Column, str]], otherwise: str) -> Column:
    condition, label = rules[0]
    chain = F.when(condition, label)
    for condition, label in rules[1:]:
        chain = chain.when(condition, label)
    return chain.otherwise(otherwise)


def at_least(column: Column | str, rules: Rules, otherwise: str) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return first_match([(column >= limit, label) for limit, label in rules], otherwise)


def at_most(column: Column | str, rules: Rules, otherwise: str) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return first_match([(column <= limit, label) for limit, label in rules], otherwise)


def below(column: Column | str, rules: Rules, otherwise: str) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return first_match([(column < limit, label) for limit, label in rules], otherwise)


# Thresholds and labels of the reports. Every report takes its thresholds as an
# argument; these are the defaults.
PLAY_SEGMENTS = ((10000, "Power User"), (1000, "Active User"), (100, "Regular User"))
PLAY_SEGMENT_ELSE = "Casual User"

# (sessions, average tracks per session, label)
USER_TYPES = (
    (5000, 25, "Power User"),
    (1000, 15, "Heavy Listener"),
    (500, 10, "Regular User"),
    (100, 5, "Casual Listener"),
    (10, 0, "Light User"),
)
USER_TYPE_ELSE = "Minimal User"

RETENTION_RISK = ((10, "High Risk"), (100, "Medium Risk"))
RETENTION_RISK_ELSE = "Low Risk"

SESSION_DURATION = (
    (1, "Very Short (≤1min)"),
    (15, "Short (1-15min)"),
    (60, "Medium (15-60min)"),
    (180, "Long (1-3hrs)"),
)
SESSION_DURATION_ELSE = "Very Long (>3hrs)"

TOP_SESSION_DURATION = ((30, "Short (<30min)"), (120, "Medium (30min-2h)"), (300, "Long (2h-5h)"))
TOP_SESSION_DURATION_ELSE = "Very Long (>5h)"

DIVERSITY = ((1.0, "All Unique"), (0.8, "High Diversity"), (0.6, "Medium Diversity"), (0.4, "Low Diversity"))
DIVERSITY_ELSE = "Very Low Diversity"

GAP_MINUTES = (
    (1, "≤1 min"),
    (5, "1-5 min"),
    (20, "5-20 min"),
    (60, "20-60 min"),
    (1440, "1-24 hours"),
)
GAP_MINUTES_ELSE = ">24 hours"

ARTIST_TIERS = ((10000, "Very Popular (10k+)"), (1000, "Popular (1k-10k)"), (100, "Moderate (100-1k)"))
ARTIST_TIER_ELSE = "Niche (<100)"

TRACK_TIERS = (
    (100, "Popular (100+)"),
    (50, "Well-Known (50-99)"),
    (10, "Moderate (10-49)"),
    (5, "Low (5-9)"),
)
TRACK_TIER_ELSE = "Rare (1-4)"

MBID_RATE = (
    (0.8, "High Quality (80%+ MBID)"),
    (0.5, "Medium Quality (50-80% MBID)"),
    (0.2, "Low Quality (20-50% MBID)"),
)
MBID_RATE_ELSE = "Very Low Quality (<20% MBID)"

PROFILE_SCORE = ((3, "Complete (3/3)"), (2, "Mostly Complete (2/3)"), (1, "Incomplete (1/3)"))
PROFILE_SCORE_ELSE = "Empty (0/3)"

ANOMALY_LONG = "Extremely Long Duration"
ANOMALY_MANY_TRACKS = "Extremely High Track Count"
ANOMALY_NO_DURATION = "Zero Duration Multi-Track"
ANOMALY_LOOP = "Potential Repeat Loop"
ANOMALY_ELSE = "Normal"

OUTLIER_PLAYS = "Extreme play count"
OUTLIER_PER_DAY = "Extreme daily activity"
OUTLIER_REPETITION = "Extreme repetition"

BEHAVIOUR_FAST = "Fast Listener"
BEHAVIOUR_EXPLORER = "Explorer"
BEHAVIOUR_REPEATER = "Repeater"
BEHAVIOUR_MARATHON = "Marathon Listener"
BEHAVIOUR_ELSE = "Balanced Listener"
