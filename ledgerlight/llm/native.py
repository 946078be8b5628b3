"""Column expressions on text that stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SPACES = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def word_count(text: Column) -> Column:
    """Number of runs of anything but ASCII white space; 0 for null."""
    outer = F.when(text.rlike(r"^[\x20\x09-\x0D]"), 1).otherwise(0) + F.when(F.substring(text, -1, 1).rlike(SPACES), 1).otherwise(0)
    return F.when(F.length(text) > 0, F.size(F.split(text, SPACES)) - outer).otherwise(0).cast("long")


def lower_ascii(word: Column) -> Column:
    """A-Z lower-cased and nothing else; the slow way is needed only where other letters occur."""
    return F.when(F.octet_length(word) == F.length(word), F.lower(word)).otherwise(F.translate(word, UPPER, UPPER.lower()))
