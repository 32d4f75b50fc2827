"""Token and tag expressions, quoting, and the time of a text stamp."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that end a token, and the mark of a tag.
NOT_TOKEN_CHARACTERS = "[^a-zA-Z0-9_#]"
TAG_MARK = "#"


def tokens(text: Column) -> Column:
    """Words of a text; every character outside letters, digits, _ and # is a separator."""
    spaced = F.trim(F.regexp_replace(text, NOT_TOKEN_CHARACTERS, " "))
    return F.filter(F.split(spaced, " +"), lambda t: t != "")


def is_tag(token: Column) -> Column:
    return token.startswith(TAG_MARK) & (F.length(token) > 1)


def strip_mark(token: Column) -> Column:
    return F.substr(token, F.lit(2))


def tags(text: Column) -> Column:
    """Tags of a text without their mark, in order, repeats kept."""
    return F.transform(F.filter(tokens(text), is_tag), strip_mark)


def quoted_list(members: Column) -> Column:
    """'a', 'b', 'c'"""
    return F.array_join(F.transform(members, lambda x: F.concat(F.lit("'"), x.cast("string"), F.lit("'"))), ", ")


def epoch_seconds(stamp: Column) -> Column:
    """Seconds since 1970 of a UTC stamp, given as TIMESTAMP_NTZ or as 'yyyy-MM-dd HH:mm:ss' text.

    Reads the clock time as UTC whatever the session zone is.
    """
    clock = stamp.cast("timestamp_ntz")
    days = F.unix_date(clock.cast("date")).cast("bigint")
    return days * 86400 + F.hour(clock) * 3600 + F.minute(clock) * 60 + F.second(clock)


def list_length(value: Column, separator: str = ", ") -> Column:
    """Entries in a list kept as separated text; 0 for a missing or empty one."""
    return F.when(value.isNull() | (F.trim(value) == ""), F.lit(0)).otherwise(F.size(F.split(value, separator)))
