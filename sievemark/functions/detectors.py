"""Detectors: the pattern that proposes each kind, and what it captures.

Patterns are Java's, with explicit ASCII classes where a text's other letters must
not count. ``REGISTRY`` drives a scan of all kinds in one pass.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EMAIL_LIMIT = 254


@dataclass(frozen=True)
class Detector:
    rule: str
    pattern: str
    group: int = 0
    checksum: bool = False
    needs: str = ""  # what any text with a match has, told at less cost than the pattern


#: The detection contracts.
REGISTRY: dict[str, Detector] = {
    "email": Detector("pii.email.v1", r"[a-zA-Z0-9_%+-](?:[a-zA-Z0-9_%+-]|\.(?=[a-zA-Z0-9_%+-]))*@(?:[a-zA-Z0-9](?:[a-zA-Z0-9.-]*[a-zA-Z0-9])?)\.[a-zA-Z]{2,}", needs=r"@"),
    "phone": Detector("pii.phone.v1", r"(?<![0-9])(?:\+1[\s.-]?)?(?:\([0-9]{3}\)[\s.-]?[0-9]{3}[\s.-]?[0-9]{4}|[0-9]{3}[\s.-]?[0-9]{3}[\s.-]?[0-9]{4})(?![0-9])", needs=r"[0-9]{3}\)?[\s.-]?[0-9]{3}"),
    "creditCard": Detector("pii.cc.luhn.v1", r"(?<![0-9A-Za-z_])[0-9]{13,19}(?![0-9A-Za-z_])", checksum=True, needs=r"[0-9]{13}"),
    "ssn": Detector("pii.ssn.state_machine.v1", r"(?<![0-9A-Za-z_])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z_])", needs=r"[0-9]{3}-[0-9]{2}-"),
    "itin": Detector("pii.itin.v1", r"(?<![0-9A-Za-z_])9[0-9]{2}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z_])", needs=r"9[0-9]{2}-[0-9]{2}-"),
    "ein": Detector("pii.ein.v1", r"(?<![0-9A-Za-z_])[0-9]{2}-[0-9]{7}(?![0-9A-Za-z_])", needs=r"[0-9]{2}-[0-9]{7}"),
    "npi": Detector("pii.npi.luhn.v1", r"(?<![0-9A-Za-z_])[12][0-9]{9}(?![0-9A-Za-z_])", checksum=True, needs=r"[12][0-9]{9}"),
    "dea": Detector("pii.dea.checksum.v1", r"(?<![0-9A-Za-z_])[A-Z]{2}[0-9]{7}(?![0-9A-Za-z_])", checksum=True, needs=r"[A-Z]{2}[0-9]{7}"),
    "routingNumber": Detector("pii.routing_number.v1", r"(?<![0-9A-Za-z_])[0-9]{9}(?![0-9A-Za-z_])", checksum=True, needs=r"[0-9]{9}"),
    "mrn": Detector("pii.mrn.labeled.v1", r"(?i)\bMR[N]?[:#\s]+[A-Z0-9]{5,12}\b"),
    "patientId": Detector("pii.mrn.patient_id.v1", r"(?i)\bPatient\s+ID[:#\s]+[A-Z0-9]{5,12}\b"),
    "institutionMrn": Detector("pii.mrn.institution.v1", r"\b[A-Z]{2,5}-[0-9]{6,10}\b"),
    "driversLicense": Detector("pii.dl.v1", r"(?i)(?:Driver(?:'?s)?\s+Lic(?:ense)?|DL|D\.?L\.?)\s*[:#]?\s*([A-Z][0-9]{4,14}|[0-9]{6,12})", 1),
    "passport": Detector("pii.passport.v1", r"(?i)(?:Passport|PP|Passport\s+No|Passport\s+Number)\s*[#:]?\s*([A-Z]{1,2}[0-9]{6,9})", 1),
    "licensePlate": Detector("pii.lp.v1", r"(?i)\b(?:License\s+Plate|Plate|Tag)[:#\s]+[A-Z0-9]{2,3}[-\s]?[A-Z0-9]{2,5}\b"),
    "bates": Detector("pii.bates.v1", r"\b[A-Z]{1,10}[-_ ]?[0-9]{4,10}\b"),
}
#: ``phone`` as engines without look-around (RE2) find it: a match uses up the characters beside it, so that of two
#: matches with one character between them the second is passed over, and white space is without the vertical tab.
PHONE_APART = Detector("pii.phone.v1", r"(?:^|[^0-9])((?:\+1[ \t\n\f\r.-]?)?(?:\([0-9]{3}\)|[0-9]{3})[ \t\n\f\r.-]?[0-9]{3}[ \t\n\f\r.-]?[0-9]{4})(?:[^0-9]|$)", 1, needs=REGISTRY["phone"].needs)
#: The 21 rules by the kind that they are about. Six have no pattern here: names
#: come from a tagger, barcodes and signatures from images, dates from ``dob_reason``, accounts
#: and addresses from scores over several lines.
RULES: dict[str, str] = {d.rule: kind for kind, d in REGISTRY.items() if kind != "bates"} | {
    "pii.account.v1": "account", "pii.address.v1": "address", "pii.dob.v1": "dateOfBirth", "pii.name.nltagger.v1": "name", "pii.barcode.vision.v1": "barcode", "pii.signature.heuristic.v1": "signature",
}


def rule_catalog(spark: SparkSession) -> DataFrame:
    """(rule_id, family, kind, version, is_checksum_gated, pattern) of every rule."""
    rows = [(rule, "pii", kind, rule.rsplit(".", 1)[1], kind in REGISTRY and REGISTRY[kind].checksum, REGISTRY[kind].pattern if kind in REGISTRY else None) for rule, kind in sorted(RULES.items())]
    return spark.createDataFrame(rows, "rule_id string, family string, kind string, version string, is_checksum_gated boolean, pattern string")


def hits(text: Column, kind: str | Detector) -> Column:
    """All matches of a kind, or of a detector of one's own, in a text, null text giving none."""
    d = kind if isinstance(kind, Detector) else REGISTRY[kind]
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(d.pattern), F.lit(d.group))
    if d.needs:
        found = F.when(F.contains(text, F.lit(d.needs)) if d.needs == "@" else text.rlike(d.needs), found).otherwise(F.array().cast("array<string>"))
    return F.filter(found, lambda m: F.length(m) <= EMAIL_LIMIT) if kind == "email" else found


def scan(df: DataFrame, text: str = "text", kinds: tuple[str, ...] = tuple(REGISTRY)) -> DataFrame:
    """``df`` without ``text``, one row a match, with ``kind`` and ``value``."""
    found = F.flatten(F.array(*(_tagged(text, k) for k in kinds)))
    return df.withColumn("_hit", F.explode(found)).select(*(c for c in df.columns if c != text), "_hit.kind", "_hit.value")


def _tagged(text: str, kind: str) -> Column:
    return F.transform(hits(F.col(text), kind), lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("value")))


def masked(value: Column) -> Column:
    """All but the last four characters of a value hidden."""
    return F.concat(F.repeat(F.lit("*"), F.greatest(F.length(value) - 4, F.lit(0))), F.right(value, F.lit(4)))


def register_finditer(spark: SparkSession, name: str = "finditer") -> None:
    """Make ``finditer(text, kind)`` a table function of SQL: (value, start, end) of every match
    of a registered kind, by places, which no built-in function gives."""
    import re

    patterns = {k: (d.pattern, d.group) for k, d in REGISTRY.items()}

    @F.udtf(returnType="value string, start int, end int")
    class Finditer:
        def __init__(self):
            self.known = {k: (re.compile(p, re.ASCII), g) for k, (p, g) in patterns.items()}

        def eval(self, text: str, kind: str):
            pattern, group = self.known[kind]
            for m in pattern.finditer(text or ""):
                yield m[group], m.start(group), m.end(group)

    spark.udtf.register(name, Finditer)
