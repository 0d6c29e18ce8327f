"""A labelled corpus: documents of six kinds with known values, look-alikes and furniture.

A document is a function of (seed, doctype, index, profile). Its values come from one
stream and what a profile changes from another, so that the same document under two
profiles differs in what the profile moves and nowhere else.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import values as V
from .calibration import locale_of, sub_seed, template_of

#: Documents of each class, buckets, span bounds, tags, tiers, context classes.
PLAN = {"court": 300, "medical": 250, "financial": 300, "foia": 150, "generic": 100}
BUCKETS = ("white", "black", "hispanic", "asian", "ai_an")
LEAST_SPANS, MOST_SPANS = 5, 18
TAGS = ("decoy", "repeated_value", "name_sparse", "marginal")
CONTEXTS = ("label_same_line", "boxed_label", "table_row", "header", "body_prose", "care_of", "honorific", "signature", "none")
TIER_OF = {"redact": "must", "flag": "watch", "suppress": "must_not"}
KINDS = ("role_noun", "label", "salutation", "closing", "page_number")
#: What a profile moves: C name contexts, D furniture, A name forms, G locales, H placeholders.
PROFILES = {"base": "", "specC": "C", "specD": "D", "specCD": "CD", "specA": "A", "specG": "G", "specH": "H", "specAGH": "AGH"}
PLACEHOLDER, ROLES = "[REDACTED]", ("the applicant", "the deponent", "the account holder", "the patient")

SPAN_TYPE = "array<struct<category:string,start:int,end:int,value:string,tier:string,expected_outcome:string,context_class:string,form:string,locale:string>>"
FURNITURE_TYPE = "array<struct<start:int,end:int,kind:string>>"


@dataclass
class Page:
    """Text that grows piece by piece and knows where its values and its furniture are."""

    text: str = ""
    spans: list[dict] = field(default_factory=list)
    furniture: list[dict] = field(default_factory=list)
    tags: set[str] = field(default_factory=set)

    def say(self, piece: str) -> Page:
        self.text += piece
        return self

    def plant(self, piece: str, kind: str) -> Page:
        """Furniture: never a span."""
        if piece:
            self.furniture.append({"start": len(self.text), "end": len(self.text) + len(piece), "kind": kind})
        return self.say(piece)

    def value(self, category: str, value: str, outcome: str = "redact", tier: str | None = None, context: str = "none", form: str | None = None) -> Page:
        """A labelled value. Only a value to redact may have a tier of its own (should)."""
        if tier is not None and (outcome != "redact" or tier not in ("must", "should")):
            raise ValueError(f"tier {tier} contradicts {outcome}")
        if context not in CONTEXTS or (form is not None and (category != "name" or form not in V.FORMS)):
            raise ValueError(f"unknown context {context} or form {form}")
        start = len(self.text)
        self.say(value)
        self.spans.append({"category": category, "start": start, "end": len(self.text), "value": value, "tier": tier or TIER_OF[outcome], "expected_outcome": outcome, "context_class": context, "form": form})
        return self


#: Templates: lines in which ``{family}`` is a value, ``{!family}`` a look-alike, ``{~family}`` a
#: value off its usual context, ``{?family}`` one for review; ``[kind|text]`` is furniture of
#: profile D. ``{name}`` is rendered as the profile has it.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "court": (
        "[label|NOTICE OF FILING]", "In the matter of {name}, the following was entered on the docket.", "Born {dateOfBirth}, the party resides at {address}.", "Social security number {ssn} was shown to the clerk.",
        "[role_noun|The deponent] may be reached at {phone} or {email}.", "Driver's License: {driversLicense} and Plate: {licensePlate} are noted.", "Case reference {!ssn} is not a personal number.", "Filed on {!dateOfBirth} under entry {!account}.", "Counsel asks that {?account} be looked at again.",
    ),
    "medical": (
        "[label|VISIT RECORD]", "Patient {name} was seen on the ward.", "{mrn}", "Date of birth {dateOfBirth}; telephone {phone}.", "Ordered under registration {dea} by provider {npi}.", "Insurance asks for {ssn} and {email}.", "Home: {address}.", "The desk at {!npi} is no provider number.", "[role_noun|The attending physician] signed the chart.", "Passport No: {passport} was used to register.",
    ),
    "financial": (
        "[label|STATEMENT OF ACCOUNT]", "Account holder: {name}", "Account {account}, routing {routingNumber}.", "Card on file {creditCard}.", "Mailing address {address}.", "Employer identification {ein}.", "Questions go to {email} or {phone}.", "The declined card {!creditCard} and batch {!routingNumber} are kept for the record.", "An entry reads {~account} with nothing near it.",
    ),
    "financial_tax": (
        "[label|RETURN OF INCOME]", "Taxpayer {name}, number {ssn}.", "Spouse number {itin}.", "Preparer's employer number {ein}.", "Refund to account {account}, routing {routingNumber}.", "Lives at {address}; born {dateOfBirth}.", "Form serial {!itin} and notice {!ein} are not numbers of persons.", "Telephone {phone}.",
    ),
    "foia": (
        "[label|RECORDS RELEASE]", "Request by {name} of {address}.", "Reply to {email}; daytime {phone}.", "The file holds {ssn} and passport {passport}.", "Passport No: {passport} appears on page two.", "The control number {!passport} and permit {!driversLicense} stay.", "[role_noun|The records officer] withheld one date: {dateOfBirth}.",
    ),
    "generic": (
        "Hello {name},", "as agreed, my number is {phone} and I write from {email}.", "Send it to {address}.", "For the form: {ssn}, born {dateOfBirth}.", "My plate is Plate: {licensePlate}.", "The invoice {!account} is paid.",
    ),
}
#: How profile C sets a name, by context class.
NAME_SLOTS = {"boxed_label": ("| Full Name: ", " |"), "table_row": ("Name\t", "\t"), "header": ("-- ", " --"), "body_prose": ("we spoke with ", ""), "care_of": ("Attn: ", ""), "honorific": ("Ms. ", ", Esq."), "signature": ("/s/ ", "")}
SALUTATIONS, CLOSINGS = ("To whom it may concern:", "Dear colleague,"), ("Respectfully submitted,", "With kind regards,")


def _pieces(line: str) -> Iterator[tuple[str, str]]:
    """(what, text) of a template line: plain text, a slot, or furniture."""
    import re

    for m in re.finditer(r"\{([^}]+)\}|\[([a-z_]+)\|([^\]]+)\]|([^{\[]+)", line):
        slot, kind, planted, plain = m.groups()
        yield ("slot", slot) if slot else (kind, planted) if kind else ("plain", plain)


def render(doctype: str, template: str, index: int, seed: int, locale: str = "en_US", profile: str = "base") -> Page:
    """One document."""
    spec, rng, own = PROFILES[profile], random.Random(seed), random.Random(f"{seed}:{doctype}:{index}:{profile}")
    where = own.choices(("es_MX", "es_ES", "en_US"), weights=(6, 6, 88))[0] if "G" in spec else locale
    page, who = Page(), V.person(rng, locale)
    sparse = rng.random() < 0.08
    made: dict[str, str] = {}
    if "D" in spec:
        page.plant(own.choice(SALUTATIONS), "salutation").say("\n")
    lines = TEMPLATES[template]
    for number, line in enumerate(lines):
        for what, text in _pieces(line):
            if what == "plain":
                page.say(text)
            elif what != "slot":
                page.plant(text, what) if "D" in spec else page.say(text if what == "role_noun" else "")
            elif text == "name":
                _name(page, who, sparse, spec, own)
            else:
                mark, family = (text[0], text[1:]) if text[0] in "!~?" else ("", text)
                value = _made(family, mark, rng, who, locale, where, made)
                outcome = {"!": "suppress", "?": "flag"}.get(mark, "redact")
                page.value(family, value, outcome, "should" if mark == "~" else None)
                page.tags |= {"decoy"} if mark == "!" else {"marginal"} if mark == "~" else set()
        if page.text and not page.text.endswith("\n"):
            page.say("\n")
        if number == len(lines) // 2 and rng.random() < 0.2 and "ssn" in made:
            page.say("As stated above: ").value("ssn", made["ssn"]).say("\n")
            page.tags.add("repeated_value")
    if "D" in spec:
        page.plant(own.choice(CLOSINGS), "closing").say("\n")
        page.plant(cue("Page {page}", own), "page_number").say("\n")
    if sparse:
        page.tags.add("name_sparse")
    for s in page.spans:
        s["locale"] = where if "G" in spec else None
    return page


def cue(text: str, rng: random.Random) -> str:
    """A cue with ``{page}`` as a place among pages: "3 of 7"."""
    if "{page}" not in text:
        return text
    last = rng.randrange(2, 40)
    return text.replace("{page}", f"{rng.randrange(1, last + 1)} of {last}")


def _made(family: str, mark: str, rng: random.Random, who: tuple[str, str, str], locale: str, where: str, made: dict[str, str]) -> str:
    """A value; the stream is drawn from alike, whatever the profile then shows."""
    if mark == "!":
        return V.DECOYS[family](rng)
    if family == "email":
        return V.email(rng, who)
    if family == "address":
        state = rng.getstate()
        shown = V.address(rng, locale)
        if where != locale:
            after = rng.getstate()
            rng.setstate(state)
            shown = V.address(rng, where)
            rng.setstate(after)
        return shown
    made[family] = V.FAMILIES[family](rng)
    return made[family].removeprefix("MRN: ") if family == "mrn" and mark else made[family]


def _name(page: Page, who: tuple[str, str, str], sparse: bool, spec: str, own: random.Random) -> None:
    if sparse:
        page.say(own.choice(ROLES) if "H" in spec else PLACEHOLDER)
        return
    form, extra = V.draw_form(own) if "A" in spec else ("full", "")
    context = own.choice(("label_same_line", *NAME_SLOTS)) if "C" in spec else "label_same_line"
    before, after = NAME_SLOTS.get(context, ("", ""))
    page.say(before).value("name", V.name_form(who, form, extra), context=context, form=form if "A" in spec else None).say(after)


def plan(spark: SparkSession, counts: dict[str, int] | None = None, seed: int = 20260416) -> DataFrame:
    """(doctype, template, index, bucket, locale, seed) of every document to render; a seed
    below 0 is refused."""
    if seed < 0:
        raise ValueError("a seed is at least 0")
    rows = spark.createDataFrame(list((counts or PLAN).items()), "doctype string, n int").where("n > 0")
    each = rows.select("doctype", "n", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("index"))
    bucket = F.element_at(F.array(*map(F.lit, BUCKETS)), F.col("index") % 5 + 1)
    each = each.withColumns({"bucket": bucket, "seed": sub_seed(F.col("doctype"), F.col("index"), seed=seed)})
    return each.select("doctype", template_of(F.col("doctype"), F.col("index"), F.col("n")).alias("template"), "index", "bucket", locale_of(F.col("bucket"), F.col("seed")).alias("locale"), "seed")


def corpus(planned: DataFrame, profile: str = "base") -> DataFrame:
    """(id, doctype, template, bucket, text, pii_spans, furniture, tags) of a plan."""
    if profile not in PROFILES:
        raise ValueError(f"unknown profile {profile}")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            docs = [render(*row, profile) for row in zip(*(b[c].tolist() for c in ("doctype", "template", "index", "seed", "locale")), strict=True)]
            yield pd.DataFrame({"id": [f"{d}_{i:06d}" for d, i in zip(b["doctype"], b["index"], strict=True)], "doctype": b["doctype"], "template": b["template"], "bucket": b["bucket"], "text": [d.text for d in docs], "pii_spans": [sorted(d.spans, key=lambda s: s["start"]) for d in docs], "furniture": [d.furniture for d in docs], "tags": [sorted(d.tags) for d in docs]})

    return planned.mapInPandas(run, f"id string, doctype string, template string, bucket string, text string, pii_spans {SPAN_TYPE}, furniture {FURNITURE_TYPE}, tags array<string>")


def assembly_violations(docs: DataFrame) -> DataFrame:
    """(id, rule): documents with too few or many spans, values that do not read back from the
    text, spans that overlap, unknown tags, or furniture that is empty, out of the text or on
    a span."""
    text, spans, planted = F.col("text"), F.col("pii_spans"), F.col("furniture")
    misread = F.exists(spans, lambda s: F.substring(text, s["start"] + 1, s["end"] - s["start"]) != s["value"])
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("a"), s["end"].alias("b"))))
    overlap = F.exists(F.transform(ordered, lambda s, i: (i > 0) & (F.coalesce(F.get(ordered, i - 1)["b"], F.lit(0)) > s["a"])), lambda x: x)
    tag = F.size(F.array_except("tags", F.array(*map(F.lit, TAGS)))) > 0
    malformed = F.exists(planted, lambda f: ~((f["start"] >= 0) & (f["start"] < f["end"]) & (f["end"] <= F.length(text)) & (F.length(f["kind"]) > 0)))
    covered = F.exists(planted, lambda f: F.exists(spans, lambda s: (f["start"] < s["end"]) & (s["start"] < f["end"])))
    rules = {"count": ~F.size(spans).between(LEAST_SPANS, MOST_SPANS), "value": misread, "overlap": overlap, "tag": tag, "furniture": malformed, "furniture_on_span": covered}
    broken = F.array_compact(F.array(*(F.when(c, name) for name, c in rules.items())))
    return docs.select("id", F.explode(broken).alias("rule"))


#: Pieces of benign letters, without a run of five digits.
_OPENINGS = ("The committee met in the small hall", "Our library will lend its spare chairs", "The garden club planted the long border", "The school choir sang in the square", "A new bridge was opened for walkers")
_MIDDLES = ("and the minutes were read aloud", "while the weather held until noon", "as the older members remembered", "though the gate stayed shut at first", "with tea served in room 12")
_ENDINGS = ("before everyone went home.", "until the lamps were lit.", "so the work can go on in spring.", "and a vote of thanks was passed.", "which pleased the visitors.", "after page 140 of the report was found.")


def benign(spark: SparkSession, n: int = 150) -> DataFrame:
    """(id, text) of letters without any personal data: no digit run of five."""
    pick = lambda xs, by: F.element_at(F.array(*map(F.lit, xs)), (F.pmod(F.floor(F.col("id") / by), F.lit(len(xs))) + 1).cast("int"))
    sentence = lambda k: F.concat_ws(" ", pick(_OPENINGS, k), pick(_MIDDLES, k + 1), pick(_ENDINGS, k + 2))
    return spark.range(n).select(F.format_string("benign_%03d", "id").alias("id"), F.concat_ws("\n", *(sentence(k) for k in (1, 3, 7))).alias("text"))
