"""Lookups and tier labels."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Page names and the category each belongs to.
PAGE_CATEGORY = {
    "About": "Platform Information",
    "Help": "Platform Information",
    "Home": "Landing",
    "Register": "Registration",
    "Submit Registration": "Registration",
    "Settings": "Customisation",
    "Save Settings": "Customisation",
    "Cancel": "Customisation",
    "Cancellation Confirmation": "Customisation",
    "NextSong": "Streaming",
    "PlayAd": "Advertising",
    "Error": "Error",
    "Login": "Authentication",
    "Logout": "Authentication",
    "Upgrade": "Subscription",
    "Submit Upgrade": "Subscription",
    "Downgrade": "Subscription",
    "Submit Downgrade": "Subscription",
}
UNKNOWN_CATEGORY = "UNKNOWN"

# Labels of the session and subscription tiers.
SESSION_TIERS = ("High Quality", "Medium Quality", "Short Session")
ENGAGEMENT = ("Highly Active", "Passive")
NEVER_UPGRADED = "Free Tier (Never Upgraded)"
UPGRADE_SEGMENTS = (
    "Fast Conversion (< 1 Week)",
    "Standard Conversion (< 1 Month)",
    "Long-term Conversion (> 1 Month)",
)


def page_category(page: Column) -> Column:
    lookup = F.create_map(*[F.lit(text) for text in chain.from_iterable(PAGE_CATEGORY.items())])
    # A NULL page must not reach the map lookup with ANSI semantics in force.
    return F.coalesce(F.try_element_at(lookup, F.coalesce(page, F.lit(""))), F.lit(UNKNOWN_CATEGORY))


def flipped_level(previous: Column) -> Column:
    """The level a status change leads to."""
    return F.when(previous == "free", F.lit("paid")).otherwise(F.lit("free"))


def session_tier(minutes: Column, high: int = 30, medium: int = 10) -> Column:
    top, middle, low = SESSION_TIERS
    return F.when(minutes >= high, top).when(minutes >= medium, middle).otherwise(low)


def engagement_label(events: Column, above: int = 50) -> Column:
    active, passive = ENGAGEMENT
    return F.when(events > above, active).otherwise(passive)


def days_segment(upgraded_at: Column, days: Column, fast: int = 7, standard: int = 30) -> Column:
    quick, usual, slow = UPGRADE_SEGMENTS
    return (
        F.when(upgraded_at.isNull(), NEVER_UPGRADED)
        .when(days <= fast, quick)
        .when(days <= standard, usual)
        .otherwise(slow)
    )
