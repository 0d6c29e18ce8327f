"""The 13 context features of a detection, over UTF-16 offsets.

A text is prepared once: its code units, its tokens, and the places of the keywords.
What a detection asks for is then a matter of neighbours in sorted places.
"""

from __future__ import annotations

import re
from array import array
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The features' order, the doctypes, and windows in UTF-16 units and tokens.
FEATURES = ("kw_positive_window", "kw_negative_window", "nearest_positive_distance", "nearest_negative_distance", "digit_run_length", "has_separator", "left_is_label", "at_line_start", "doctype_is_court", "doctype_is_medical", "doctype_is_financial", "doctype_is_foia", "doctype_is_generic")
DOCTYPES = ("court", "medical", "financial", "foia", "generic")
RADIUS, TOKENS = 200, 5
#: Blanks that may stand between a line's start and a match: tab and the space separators.
_BLANKS = frozenset("\t \xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000")
_RUN = re.compile(r"\S+")


def units(text: str) -> str:
    """One character for each UTF-16 code unit."""
    if text.isascii() or max(text) <= "\uffff":
        return text
    return "".join(map(chr, array("H", text.encode("utf-16", "surrogatepass")[2:])))


@lru_cache(64)
def _finder(words: tuple[str, ...]):
    """A pattern of any of the words, longest first, each with no letter, mark or number on
    its outer sides where it begins or ends with one."""
    import regex

    inner = r"[\p{L}\p{M}\p{N}]"

    def one(w: str) -> str:
        head = f"(?<!{inner})" if regex.match(inner, w) else ""
        tail = f"(?!{inner})" if regex.match(inner, w[-1]) else ""
        return head + regex.escape(w) + tail

    listed = sorted({w for w in words if w}, key=lambda w: (-len(w), w))
    return regex.compile("|".join(map(one, listed))) if listed else None


class Passage:
    """A text made ready for its detections."""

    def __init__(self, text: str):
        self.units = units(text)
        runs = [m.span() for m in _RUN.finditer(self.units)]
        self.begins, self.ends = [a for a, _ in runs], [b for _, b in runs]

    def _tokens(self, low: int, high: int, last: bool) -> list[str]:
        """The first or last tokens of a stretch; one that its edge cuts counts as what is left."""
        i, j = bisect_right(self.ends, low), bisect_left(self.begins, high)
        i, j = (max(i, j - TOKENS), j) if last else (i, min(j, i + TOKENS))
        return [self.units[max(a, low) : min(b, high)] for a, b in zip(self.begins[i:j], self.ends[i:j], strict=True)]

    def features(self, start: int, length: int, positive: tuple[str, ...], negative: tuple[str, ...], doctype: str) -> list[float]:
        """The features of the match at ``start``."""
        u, end = self.units, start + length
        low, high = max(0, start - RADIUS), min(len(u), end + RADIUS)
        left, right = self._tokens(low, start, True), self._tokens(end, high, False)
        window = f"{' '.join(left)} {' '.join(right)}".lower()
        near, match = u[low:high].lower(), u[start:end]
        line = start
        while line and u[line - 1] in _BLANKS:
            line -= 1
        said = [(found.search(window) is not None, _nearness(found, near, start - low, end - low)) if found else (False, 0.0) for found in (_finder(positive), _finder(negative))]
        return [
            float(said[0][0]),
            float(said[1][0]),
            said[0][1],
            said[1][1],
            float(sum(map(match.count, "0123456789"))),
            float(not all(c.isalpha() or c.isdigit() for c in match)),
            float(bool(left) and left[-1].endswith((":", "#"))),
            float(line == 0 or u[line - 1] in "\r\n"),
            *(float(doctype == d) for d in DOCTYPES),
        ]


def _nearness(found, near: str, start: int, end: int) -> float:
    """1 / (1 + gap / 10) of the keyword nearest to [start, end), 0 if there is none."""
    gap = min((max(start - m.end(), m.start() - end, 0) for m in found.finditer(near, overlapped=True)), default=None)
    return 0.0 if gap is None else 1.0 / (1.0 + gap / 10.0)


def features(text: str, start: int, length: int, positive: list[str], negative: list[str], doctype: str) -> list[float]:
    """The features of one match of a text."""
    return Passage(text).features(start, length, tuple(positive), tuple(negative), doctype)


def with_features(rows: DataFrame, keywords: dict[str, tuple[list[str], list[str]]]) -> DataFrame:
    """``rows`` (id, text, start, length, family, doctype) as (id, family, features)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            b["features"] = [features(r.text, r.start, r.length, *keywords.get(r.family, ([], [])), r.doctype) for r in b.itertuples()]
            yield b[["id", "family", "features"]]

    return rows.select("id", "text", F.col("start").cast("int"), F.col("length").cast("int"), "family", "doctype").mapInPandas(run, "id long, family string, features array<double>")


def match_features(docs: DataFrame, family: str, pattern: str, keywords: tuple[list[str], list[str]]) -> DataFrame:
    """``docs`` (id, text, doctype) as (id, family, features), one row a match of
    ``pattern``, each at its own offset."""
    found, (positive, negative) = re.compile(pattern, re.ASCII), map(tuple, keywords)  # Java's \s is ASCII

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for r in b.itertuples():
                passage = Passage(r.text or "")
                rows += [(r.id, family, passage.features(m.start(), len(m[0]), positive, negative, r.doctype)) for m in found.finditer(passage.units)]
            yield pd.DataFrame(rows, columns=["id", "family", "features"])

    return docs.select("id", "text", "doctype").mapInPandas(run, "id long, family string, features array<double>")
