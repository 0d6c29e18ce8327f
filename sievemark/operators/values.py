"""Made values of personal data, and test vectors that say why a value is none.

A value is drawn from a shape: ``#`` a digit, ``A`` a letter, ``X`` either, all else as it
stands; what a shape cannot say (check digits, ranges) a finisher adds. All draws come from
the generator that is passed in, so a value depends on its seed alone.
"""

from __future__ import annotations

import random
import string
from calendar import monthrange
from collections.abc import Callable

from ..functions.validators import ABA_RANGES, ABA_WEIGHTS, ITIN_RANGES, NPI_PREFIX, SSN_LITERAL

#: Own small pools; the es ones stand for two locales of Spanish.
FIRST = {"en_US": ("Ada", "Ben", "Cora", "Dev", "Elif", "Femi", "Gus", "Hana", "Ines", "Jun", "Kofi", "Lena"), "es_ES": ("Alba", "Bruno", "Carmen", "Diego", "Elena", "Hugo"), "es_MX": ("Itzel", "Jimena", "Luis", "Marisol", "Pablo", "Renata")}
LAST = {"en_US": ("Alder", "Birch", "Cedar", "Dogwood", "Elm", "Fir", "Gum", "Hazel", "Ivy", "Juniper", "Kapok", "Larch"), "es_ES": ("Olmo", "Pino", "Roble", "Sauce"), "es_MX": ("Ahuehuete", "Ceiba", "Encino", "Mezquite")}
PARTICLES, SUFFIXES = ("de la", "van", "von", "del"), ("Jr.", "Sr.", "III")
STREETS, CITIES = ("Oak Street", "Mill Road", "Harbor Avenue", "Lake Drive", "Hill Lane"), ("Northfield", "Eastport", "Westbrook", "Southgate")
#: Two-digit prefixes of federal employer numbers that are not issued.
EIN_GAPS = (0, 7, 8, 9, 17, 18, 19, 28, 29, 49, 69, 70, 78, 79, 89, 96, 97)
#: The first letters of registrations, the forms of a name.
DEA_FIRST = "ABCDEFGHJKLMPRSTUX"
FORMS = ("full", "initial", "last_first", "all_caps", "suffix", "particled")


def shaped(rng: random.Random, shape: str) -> str:
    pools = {"#": string.digits, "A": string.ascii_uppercase, "X": string.ascii_uppercase + string.digits}
    return "".join(rng.choice(pools[c]) if c in pools else c for c in shape)


def luhn_digit(head: str) -> str:
    """The digit that completes a number by Luhn's rule."""
    total = 0
    for place, c in enumerate(reversed(head)):
        total += sum(divmod(int(c) * 2, 10)) if place % 2 == 0 else int(c)
    return str(-total % 10)


def dea_digit(six: str) -> str:
    d = [int(c) for c in six]
    return str((sum(d[::2]) + 2 * sum(d[1::2])) % 10)


def aba_digit(eight: str) -> str:
    weighted = sum(w * int(c) for w, c in zip(ABA_WEIGHTS, eight, strict=False))
    return str(-weighted % 10)  # the last weight is 1


def other_digit(rng: random.Random, digit: str) -> str:
    return str((int(digit) + rng.randrange(1, 10)) % 10)


def ssn(rng: random.Random) -> str:
    area = rng.choice([a for a in range(1, 900) if a != 666])
    made = f"{area:03d}-{rng.randrange(1, 100):02d}-{rng.randrange(1, 10_000):04d}"
    return ssn(rng) if made == SSN_LITERAL or len(set(made) - {"-"}) == 1 else made


def itin(rng: random.Random) -> str:
    low, high = rng.choice(ITIN_RANGES)
    return f"9{shaped(rng, '##')}-{rng.randint(low, high)}-{shaped(rng, '####')}"


def ein(rng: random.Random) -> str:
    return f"{rng.choice([p for p in range(1, 100) if p not in EIN_GAPS]):02d}-{shaped(rng, '#######')}"


def npi(rng: random.Random) -> str:
    head = rng.choice("12") + shaped(rng, "#" * 8)
    return head + luhn_digit(NPI_PREFIX + head)


def dea(rng: random.Random) -> str:
    six = shaped(rng, "#" * 6)
    return rng.choice(DEA_FIRST) + shaped(rng, "A") + six + dea_digit(six)


BRANDS = {"visa": ("4", 16), "mastercard": ("53", 16), "amex": ("37", 15), "discover": ("6011", 16), "jcb": ("3530", 16), "unionpay": ("62", 17)}


def card(rng: random.Random, brand: str = "visa") -> str:
    prefix, length = BRANDS[brand]
    head = prefix + shaped(rng, "#" * (length - len(prefix) - 1))
    return head + luhn_digit(head)


def routing_number(rng: random.Random) -> str:
    low, high = rng.choice(ABA_RANGES)
    eight = f"{rng.randint(low, high):02d}" + shaped(rng, "#" * 6)
    return eight + aba_digit(eight)


def phone(rng: random.Random) -> str:
    return f"({rng.randrange(200, 1000)}) 555-{shaped(rng, '####')}"


def birth_date(rng: random.Random) -> str:
    year, month = rng.randrange(1935, 2006), rng.randrange(1, 13)
    return f"{month:02d}/{rng.randint(1, monthrange(year, month)[1]):02d}/{year}"


def address(rng: random.Random, locale: str = "en_US") -> str:
    street = f"{rng.randrange(1, 10_000)} {rng.choice(STREETS)}, {rng.choice(CITIES)}"
    return street + (f", C.P. {shaped(rng, '#####')}" if locale == "es_MX" else f", {shaped(rng, 'AA #####')}")


def person(rng: random.Random, locale: str = "en_US") -> tuple[str, str, str]:
    """(first, middle initial, last)."""
    return rng.choice(FIRST[locale]), rng.choice(string.ascii_uppercase), rng.choice(LAST[locale])


def name_form(who: tuple[str, str, str], form: str, extra: str = "") -> str:
    """A person's name in one of the forms; ``extra`` is the suffix or particle."""
    first, middle, last = who
    made = {"full": f"{first} {last}", "initial": f"{first} {middle}. {last}", "last_first": f"{last}, {first}", "all_caps": f"{first} {last}".upper(), "suffix": f"{first} {last} {extra}", "particled": f"{first} {extra} {last}"}
    return made[form]


def draw_form(rng: random.Random) -> tuple[str, str]:
    """(form, extra) at fixed rates: 20 % initial, 10 % last first, 10 % capitals, 5 % suffix,
    5 % particle, else in full."""
    form = rng.choices(FORMS, weights=(50, 20, 10, 10, 5, 5))[0]
    return form, rng.choice(SUFFIXES if form == "suffix" else PARTICLES) if form in ("suffix", "particled") else ""


def email(rng: random.Random, who: tuple[str, str, str] | None = None) -> str:
    first, _, last = who or person(rng)
    return f"{first}.{last}{rng.randrange(100)}@example.com".lower()


#: The families of the corpus by how a value is made.
FAMILIES: dict[str, Callable[[random.Random], str]] = {
    "ssn": ssn, "itin": itin, "ein": ein, "npi": npi, "dea": dea, "creditCard": card, "routingNumber": routing_number, "phone": phone, "dateOfBirth": birth_date, "address": address, "email": email,
    "account": lambda rng: shaped(rng, "#" * rng.randint(9, 12)),
    "mrn": lambda rng: "MRN: " + shaped(rng, "#######"),
    "name": lambda rng: name_form(person(rng), "full"),
    "driversLicense": lambda rng: shaped(rng, "A#######"),
    "passport": lambda rng: shaped(rng, "A########"),
    "licensePlate": lambda rng: shaped(rng, "AAA-####"),
}

#: Look-alikes that must not be found, by the family that they look like.
DECOYS: dict[str, Callable[[random.Random], str]] = {
    "ssn": lambda rng: f"{rng.randrange(900, 1000)}-{shaped(rng, '##-####')}",
    "itin": lambda rng: f"9{shaped(rng, '##')}-{rng.randrange(10, 50)}-{shaped(rng, '####')}",
    "npi": lambda rng: f"({rng.randrange(300, 900)}) {rng.randrange(200, 1000)}-{shaped(rng, '####')}",
    "creditCard": lambda rng: (lambda v: v[:-1] + other_digit(rng, v[-1]))(card(rng)),
    "driversLicense": lambda rng: shaped(rng, "AAA##"),
    "passport": lambda rng: shaped(rng, "AAA####"),
    "account": lambda rng: shaped(rng, "INV-######"),
    "ein": lambda rng: shaped(rng, "REG ##-#######-#"),
    "dateOfBirth": lambda rng: f"{rng.randrange(1, 13):02d}/{rng.randrange(1, 29):02d}/{rng.randrange(2015, 2025)}",
    "routingNumber": lambda rng: "9" + shaped(rng, "########"),
}


def _dates(rng: random.Random) -> list[tuple[str, str | None]]:
    out: list[tuple[str, str | None]] = [(birth_date(rng), None) for _ in range(20)]
    return [*out, ("02/29/2000", None), ("02/29/2004", None), ("02/29/1900", "non_leap_feb_29"), ("02/29/2001", "non_leap_feb_29"), ("13/01/1990", "invalid_month"), ("00/10/1990", "invalid_month"), ("01/32/1990", "invalid_day"), ("01/00/1990", "invalid_day"), ("04/31/1990", "month_day_overflow"), ("02/30/1992", "month_day_overflow")]


def _cards(rng: random.Random) -> list[tuple[str, str | None]]:
    good = [card(rng, b) for b in BRANDS for _ in range(8)]
    head = "1" + shaped(rng, "#" * 14)
    return [(v, None) for v in good] + [(v[:-1] + other_digit(rng, v[-1]), "luhn") for v in good] + [("4" * 12, "length"), ("4" * 20, "length"), (head + luhn_digit(head), "brand")]


def _npis(rng: random.Random) -> list[tuple[str, str | None]]:
    good = [npi(rng) for _ in range(20)]
    return [(v, None) for v in good] + [(v[:-1] + other_digit(rng, v[-1]), "checksum") for v in good] + [("3" + v[1:], "prefix") for v in good[:5]] + [(v[:9], "length") for v in good[:3]]


def _deas(rng: random.Random) -> list[tuple[str, str | None]]:
    good = [dea(rng) for _ in range(20)]
    return [(v, None) for v in good] + [(v[:-1] + other_digit(rng, v[-1]), "checksum") for v in good] + [("1" + v[1:], "prefix") for v in good[:3]] + [(v + "0", "length") for v in good[:3]]


def _routing(rng: random.Random) -> list[tuple[str, str | None]]:
    good = [routing_number(rng) for _ in range(20)]
    return [(v, None) for v in good] + [(v[:-1] + other_digit(rng, v[-1]), "checksum") for v in good] + [("99" + v[2:], "prefix") for v in good[:3]] + [(v[:8], "length") for v in good[:3]]


def _ssns(rng: random.Random) -> list[tuple[str, str | None]]:
    tail = lambda: f"{rng.randrange(1, 100):02d}-{rng.randrange(1, 10_000):04d}"
    bad = [("000-" + tail(), "area_000"), ("666-" + tail(), "area_666"), ("900-" + tail(), "area_900_999"), ("999-" + tail(), "area_900_999"), ("123-00-1234", "group_00"), ("123-45-0000", "serial_0000"), (SSN_LITERAL, "literal_078_05_1120"), ("111-11-1111", "all_same_digit"), ("123456789", "shape")]
    return [(ssn(rng), None) for _ in range(50)] + bad


def _itins(rng: random.Random) -> list[tuple[str, str | None]]:
    outside = [y for y in range(100) if not any(a <= y <= b for a, b in ITIN_RANGES)]
    return [(itin(rng), None) for _ in range(20)] + [(f"9{shaped(rng, '##')}-{y:02d}-{shaped(rng, '####')}", "yy_out_of_range") for y in outside[::5]] + [("812-70-1234", "shape")]


def _labelled(shapes: dict[str, str], bad: tuple[str, ...]) -> Callable[[random.Random], list[tuple[str, str | None]]]:
    """Vectors of a label and, after it, a shape."""
    return lambda rng: [(label + shaped(rng, s), None) for label, s in shapes.items() for _ in range(6)] + [(b, "shape") for b in bad]


#: Vector families: (value, reason to reject it or none) lists.
VECTORS: dict[str, Callable[[random.Random], list[tuple[str, str | None]]]] = {
    "npi": _npis, "dea": _deas, "ssn": _ssns, "creditCard": _cards, "itin": _itins, "dateOfBirth": _dates, "routingNumber": _routing,
    "ein": lambda rng: [(ein(rng), None) for _ in range(20)] + [("123456789", "shape"), ("1-2345678", "shape")],
    "phone": lambda rng: [(phone(rng), None) for _ in range(10)] + [(shaped(rng, s), None) for s in ("2##-555-####", "2##.555.####", "+1 2##-555-####", "2##555####")] + [(b, "shape") for b in ("555-0100", "12-345-6789", "21255501001")],
    "email": lambda rng: [(email(rng), None) for _ in range(10)] + [("a+b@mail.example.org", None), ("x_y%z@ex-ample.co", None)] + [(b, "shape") for b in ("no-at.example.com", "a@b", "@example.com")],
    "mrn": _labelled({"MRN: ": "#######", "MR# ": "XXXXX", "MRN ": "XXXXXXXXXXXX"}, ("MRN: 1234", "M: 1234567")),
    "driversLicense": _labelled({"DL ": "A#######", "Driver's License: ": "########", "Driver Lic # ": "######"}, ("DL 12", "license A1234567")),
    "passport": _labelled({"Passport ": "A########", "Passport No: ": "AA######", "PP # ": "A######"}, ("Passport 12345678", "A12345678")),
    "licensePlate": _labelled({"Plate: ": "AAA-####", "License Plate ": "XXX XXXX", "Tag #": "AA XXX"}, ("ABC-1234", "Plate: A")),
    "bates": _labelled({"": "AAA-######", " ": "AAAAA_########", "  ": "A ####"}, ("-123456", "ABC-123")),
}


def vectors(seed: int) -> list[tuple[str, str, bool, str | None]]:
    """(family, value, valid, reason) of all families, each from a stream of its own."""
    out = []
    for family, make in VECTORS.items():
        out += [(family, v, reason is None, reason) for v, reason in make(random.Random(f"{seed}:{family}"))]
    return out
