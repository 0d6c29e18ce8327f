"""Text normalisers. ASCII texts stay in the JVM; others take one Arrow pass."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Presentation forms that are spelled out before NFKC.
LIGATURES = {"ﬃ": "ffi", "ﬄ": "ffl", "ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl"}
_ASCII = r"^[\x00-\x7F]*$"
_WHITE = r"[\x09-\x0D\x1C-\x20]+"


def nfkc_lower_text(text: str) -> str:
    for form, letters in LIGATURES.items():
        text = text.replace(form, letters)
    return unicodedata.normalize("NFKC", text).lower()


@lru_cache(1)
def _nfkc_lower():
    """Made on first use: a worker that imports this module has no session."""
    return F.pandas_udf(lambda s: s.map(nfkc_lower_text, na_action="ignore"), "string", F.PandasUDFType.SCALAR)


@lru_cache(1)
def _casefold():
    return F.pandas_udf(lambda s: s.map(lambda t: " ".join(t.split()).casefold(), na_action="ignore"), "string", F.PandasUDFType.SCALAR)


def nfkc_lower(c: Column, strip: bool = False) -> Column:
    """NFKC and lower case; the ASCII case needs no normal form."""
    done = F.when(c.rlike(_ASCII), F.lower(c)).otherwise(_nfkc_lower()(F.when(~c.rlike(_ASCII), c)))
    return F.trim(done) if strip else done


def norm_text(c: Column) -> Column:
    """White space collapsed, case folded."""
    ascii_form = F.lower(F.trim(F.regexp_replace(c, _WHITE, " ")))
    return F.when(c.rlike(_ASCII), ascii_form).otherwise(_casefold()(F.when(~c.rlike(_ASCII), c)))


def end_slack_match(a: Column, b: Column, slack: int = 2) -> Column:
    """Of two normalised texts the shorter occurs in the longer with at most
    ``slack`` characters left over at each end."""
    short, long = F.when(F.length(a) <= F.length(b), a).otherwise(b), F.when(F.length(a) <= F.length(b), b).otherwise(a)
    at = lambda i: (F.substring(long, i + 1, F.length(short)) == short) & (F.length(long) - i - F.length(short) <= slack) & (F.length(long) - i - F.length(short) >= 0)
    found = F.lit(False)
    for i in range(slack + 1):
        found = found | at(F.lit(i))
    return (a == b) | ((F.length(short) > 0) & found)


def digit_stratum(c: Column) -> Column:
    """How many digit groups hold only digits that look like letters (0, 1, 5, 8)."""
    groups = F.regexp_extract_all(c, F.lit("[0-9]+"), F.lit(0))
    alike = F.filter(groups, lambda g: g.rlike("^[0158]+$"))
    return F.when(F.size(groups) == 0, "no_digits").when(F.size(alike) == F.size(groups), "all").when(F.size(alike) > 0, "some").otherwise("none")


def last_token(c: Column) -> Column:
    """The last of the space-separated parts of a name."""
    return F.element_at(F.split(F.trim(c), " +"), -1)


def tokens(c: Column) -> Column:
    """Lower-case runs of ASCII letters and digits."""
    return F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit("[a-z0-9]+"), F.lit(0))
