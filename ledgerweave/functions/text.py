"""String expressions: trimming, model-output cleaning, templates, money."""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns results depend on.
# White space as Python's str.strip() sees it, as characters and as a Java class.
SPACES = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
          "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")
SPACE = r"[\s\x1c-\x1f\x85\p{Z}]"
# A closed reasoning block; an unclosed one stays.
REASONING = r"(?s)<think>.*?</think>"
# A code fence with its optional language tag and the white space after it.
FENCE = r"```(?:sql)?" + SPACE + "*"
TRAILING_TICKS = r"(?<!`)`++\z"


def strip(text: Column) -> Column:
    """White space removed at both ends."""
    return F.trim(text, F.lit(SPACES))


def strip_reasoning(text: Column) -> Column:
    return F.regexp_replace(text, REASONING, "")


def clean_sql_text(text: Column) -> Column:
    """Bare SQL from a model's answer."""
    unfenced = F.regexp_replace(strip(strip_reasoning(text)), FENCE, "")
    return strip(F.regexp_replace(strip(unfenced), TRAILING_TICKS, ""))


def fill_template(template: str, **values: Column) -> Column:
    """Named placeholders replaced once.

    The template is cut on the driver, so inserted text that looks like a
    placeholder stays as it is.  A null value counts as the empty string.
    """
    parts = []
    for literal, name, _, _ in Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if name is not None:
            parts.append(F.coalesce(values[name].cast("string"), F.lit("")))
    return F.concat(*parts)


def whole_dollars(amount: Column) -> Column:
    """Amount without decimals; a tie goes to the even dollar."""
    return F.format_string("%.0f", F.bround(amount, 0).cast("double"))
