"""Text normalisation used by the dimensions and the song match."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what a song title loses before it is compared.
TITLE_NOISE = r'([^\p{ASCII}]+)|(")'

# The characters Unicode counts as white space.
WHITE_SPACE = (
    "\t\n\u000b\u000c\r \u0085\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def normalize_title(title: Column) -> Column:
    return F.regexp_replace(title, TITLE_NOISE, "")


def match_title(title: Column) -> Column:
    """Title as the song match compares it: without backslashes."""
    return F.replace(title, F.lit("\\"), F.lit(""))


def match_artist(artist: Column) -> Column:
    return F.lower(F.btrim(artist, F.lit(WHITE_SPACE)))


def strip_quotes(text: Column) -> Column:
    return F.btrim(text, F.lit('"'))


def standard_postal(postal: Column, country: Column) -> Column:
    """US codes are five digits, zero-padded and cut; others are upper-cased."""
    text = postal.cast("string")
    return F.when(country == "US", F.lpad(text, 5, "0")).otherwise(F.upper(text))
