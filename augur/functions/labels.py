"""Presentation labels as built-in expressions, no Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the dashboard labels: two spaces between id and text, text
# cut at 62 characters and followed by "...", " / " between forecaster and
# question, " pts" after a signed change and "no change" for zero.
LABEL_SEP = "  "
LABEL_TEXT_CHARS = 62
LABEL_ELLIPSIS = "..."
PAIR_SEP = " / "
POINTS_SUFFIX = " pts"
NO_CHANGE = "no change"


def question_label(qid: Column, text: Column, width: int = LABEL_TEXT_CHARS) -> Column:
    """``id + '  ' + text[:width] + '...'``."""
    return F.concat(qid, F.lit(LABEL_SEP), F.substring(text, 1, width), F.lit(LABEL_ELLIPSIS))


def first_word(name: Column, sep: str | None = None) -> Column:
    """First token of a name (F18), split on any white space, leading one
    ignored; '' for a blank name. With ``sep``, what comes before it."""
    if sep is not None:
        return F.split_part(name, F.lit(sep), F.lit(1))
    return F.regexp_extract(name, r"(\S+)", 1)


def pair_label(name: Column, qid: Column, sep: str | None = None) -> Column:
    """``first word of name + ' / ' + question id``."""
    return F.concat(first_word(name, sep), F.lit(PAIR_SEP), qid)


def signed_points(delta: Column) -> Column:
    """``+5 pts`` / ``-3 pts`` / ``no change``."""
    as_text = delta.cast("string")
    return (
        F.when(delta > 0, F.concat(F.lit("+"), as_text, F.lit(POINTS_SUFFIX)))
        .when(delta < 0, F.concat(as_text, F.lit(POINTS_SUFFIX)))
        .otherwise(F.lit(NO_CHANGE))
    )

