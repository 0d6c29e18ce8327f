"""Structural validators as Column expressions.

Each takes a string column and gives the first reason to reject it, or null if it
is accepted; ``*_ok`` forms give a boolean. Nothing leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Ranges and literals of the public numbering rules.
SSN_LITERAL = "078-05-1120"
ITIN_RANGES = ((50, 65), (70, 88), (90, 92), (94, 99))
ABA_WEIGHTS = (3, 7, 1, 3, 7, 1, 3, 7, 1)
ABA_RANGES = ((1, 12), (21, 32), (61, 72), (80, 80))
NPI_PREFIX = "80840"


def _digit(c: Column, i: int) -> Column:
    return F.substring(c, i, 1).cast("int")


def _within(c: Column, ranges: tuple[tuple[int, int], ...]) -> Column:
    ok = F.lit(False)
    for low, high in ranges:
        ok = ok | c.between(low, high)
    return ok


def luhn_ok(digits: Column) -> Column:
    """Luhn's check; false for an empty string."""
    return F.call_function("luhn_check", digits)


def ssn_reason(ssn: Column) -> Column:
    """Of ``AAA-GG-SSSS``; other shapes are ``shape``."""
    area, group, serial = F.substring(ssn, 1, 3), F.substring(ssn, 5, 2), F.substring(ssn, 8, 4)
    return (
        F.when(~ssn.rlike(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), "shape")
        .when(area == "000", "area_000")
        .when(area == "666", "area_666")
        .when(area >= "900", "area_900_999")
        .when(group == "00", "group_00")
        .when(serial == "0000", "serial_0000")
        .when(ssn == SSN_LITERAL, "literal_078_05_1120")
        .when(F.translate(ssn, "-", "").rlike(r"^([0-9])\1{8}$"), "all_same_digit")
    )


def itin_reason(itin: Column) -> Column:
    """``9NN-YY-NNNN`` with the fourth and fifth digit in an issued range."""
    return F.when(~itin.rlike(r"^9[0-9]{2}-[0-9]{2}-[0-9]{4}$"), "shape").when(~_within(F.substring(itin, 5, 2).try_cast("int"), ITIN_RANGES), "yy_out_of_range")


def ein_ok(ein: Column) -> Column:
    """The shape alone; the list of issued prefixes is no gate."""
    return ein.rlike(r"^[0-9]{2}-[0-9]{7}$")


def npi_reason(npi: Column) -> Column:
    return F.when(~npi.rlike(r"^[0-9]{10}$"), "length").when(~F.substring(npi, 1, 1).isin("1", "2"), "prefix").when(~luhn_ok(F.concat(F.lit(NPI_PREFIX), npi)), "checksum")


def dea_reason(dea: Column) -> Column:
    """Two letters and seven digits; the last is (d0+d2+d4+2(d1+d3+d5)) mod 10."""
    d = [_digit(dea, 3 + i) for i in range(7)]
    shaped = dea.rlike(r"^[A-Z]{2}[0-9]{7}$")
    check = (d[0] + d[2] + d[4] + 2 * (d[1] + d[3] + d[5])) % 10
    return F.when(F.length(dea) != 9, "length").when(~dea.rlike(r"^[A-Z]{2}"), "prefix").when(~shaped, "shape").when(check != d[6], "checksum")


def card_brand(digits: Column) -> Column:
    """Brand by length and prefix, null if none."""
    n, two, four = F.length(digits), F.substring(digits, 1, 2), F.substring(digits, 1, 4)
    return (
        F.when(digits.startswith("4") & n.isin(13, 16), "visa")
        .when((n == 16) & (two.between("51", "55") | four.between("2221", "2720")), "mastercard")
        .when((n == 15) & two.isin("34", "37"), "amex")
        .when((n == 16) & ((four == "6011") | (two == "65")), "discover")
        .when((n == 16) & four.between("3528", "3589"), "jcb")
        .when(n.between(16, 19) & (two == "62"), "unionpay")
    )


def card_reason(digits: Column) -> Column:
    """The triple gate: 13 to 19 digits, Luhn, a known brand."""
    return F.when(~digits.rlike(r"^[0-9]{13,19}$"), "length").when(~luhn_ok(digits), "luhn").when(card_brand(digits).isNull(), "brand")


def aba_reason(number: Column) -> Column:
    weighted = sum((w * _digit(number, i + 1) for i, w in enumerate(ABA_WEIGHTS[1:], 1)), ABA_WEIGHTS[0] * _digit(number, 1))
    return F.when(~number.rlike(r"^[0-9]{9}$"), "length").when(~_within(F.substring(number, 1, 2).try_cast("int"), ABA_RANGES), "prefix").when(weighted % 10 != 0, "checksum")


def days_in_month(month: Column, year: Column) -> Column:
    leap = ((year % 4 == 0) & (year % 100 != 0)) | (year % 400 == 0)
    return F.when(month == 2, F.when(leap, 29).otherwise(28)).when(month.isin(4, 6, 9, 11), 30).otherwise(31)


def dob_reason(month: Column, day: Column, year: Column) -> Column:
    return (
        F.when(~month.between(1, 12), "invalid_month")
        .when(~day.between(1, 31), "invalid_day")
        .when((month == 2) & (day == 29) & (days_in_month(month, year) == 28), "non_leap_feb_29")
        .when(day > days_in_month(month, year), "month_day_overflow")
    )
