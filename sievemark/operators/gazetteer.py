"""Builders of lookup tables: institutions, postal areas, nicknames, keywords."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .merge import concat_specs, first_wins
from .ordered import cut

#: Suffixes of company names, longest form first, and words of financial titles.
STRIP_SUFFIXES = (
    ", national association", " national association", ", n.a.", " n.a.", " na", ", f.s.b.", " federal savings bank",
    ", llc", " llc", " l.l.c.", ", inc.", " inc", " incorporated", ", corp.", " corp", " corporation",
    ", co.", " co", ", ltd.", " ltd", " & co.",
)
FINANCIAL_WORDS = ("bank", "bancorp", "bancshares", "financial", "finance", "capital", "insurance", "securities", "invest", "asset", "holdings", "trust", "mortgage", "credit")

#: Phrases that a description of a mechanism must not use.
BANNED_PHRASES = (
    "guaranteed", "guarantees", "ensures", "securely removes", "100%", "impossible to recover", "military-grade", "bank-level", "certified", "structurally impossible", "the only provably secure approach",
    "destroy-level sanitization per nist", "mathematically irreversible", "security invariant", "provably reliable", "your data is safe", "no one can recover", "fully secure", "completely secure", "absolutely safe", "tamper-proof", "unhackable",
)
#: The shapes of passport numbers by issuer.
PASSPORT_PATTERNS = {
    "CA": ["^[A-Z]{2}[0-9]{6}$", "^[A-Z][0-9]{6}[A-Z]{2}$"],
    "CN": ["^(?:G[0-9]{8}|E[0-9]{8}|E[A-HJ-NP-Z][0-9]{7})$"],
    "DO": ["^[A-Z]{3}[0-9]{6}$"],
    "GB": ["^[0-9]{9}$"],
    "IN": ["^[A-PR-WY][1-9][0-9]{5}[1-9]$", "^[A-Z][0-9]{7}$"],
    "KR": ["^[MSROD][0-9]{8}$", "^[MSROD][0-9]{3}[A-Z][0-9]{4}$"],
    "MX": ["^[A-Z][0-9]{8}$"],
    "PH": ["^[A-Z]{2}[0-9]{7}$", "^[A-Z][0-9]{7}[A-Z]$"],
    "SV": ["^[A-Z0-9]{9}$"],
    "US": ["^[0-9]{9}$", "^[A-Z][0-9]{8}$"],
    "VN": ["^[A-Z][0-9]{8}$"],
}


def strip_suffix(name: Column) -> Column:
    """``name`` without the first listed suffix that it ends with."""
    out = None
    for s in STRIP_SUFFIXES:
        cut = F.trim(F.substring(name, 1, F.length(name) - len(s)))
        out = F.when(name.endswith(s), cut) if out is None else out.when(name.endswith(s), cut)
    return out.otherwise(name)


def aliases(name: Column) -> Column:
    """{whole, before the first comma} x {as is, without suffix}, less the name itself, sorted."""
    head = F.trim(F.split_part(name, F.lit(","), F.lit(1)))
    every = F.array(strip_suffix(name), head, strip_suffix(head))
    return F.array_sort(F.array_distinct(F.filter(every, lambda a: (a != name) & (a != ""))))


def is_financial(title: Column) -> Column:
    return F.lower(title).rlike("|".join(FINANCIAL_WORDS))


def priority_union(sources: list[DataFrame], key: str, keep: list[str]) -> DataFrame:
    """Rows of several sources; of equal keys the earlier source's."""
    return first_wins(concat_specs(sources), key, keep, ["spec_ord", *keep])


def multimap(pairs: DataFrame, alias: str, canonical: str) -> DataFrame:
    """alias -> sorted distinct canonicals; a canonical maps to itself."""
    own = pairs.select(F.col(canonical).alias(alias), F.col(canonical))
    return pairs.select(alias, canonical).unionByName(own).where(F.col(alias) != "").groupBy(alias).agg(F.array_sort(F.collect_set(canonical)).alias("canonicals"))


def winners(rows: DataFrame, key: str, ratio: str, tie: str) -> DataFrame:
    """Per key the row with the largest ratio, ties to the smaller ``tie``; a null ratio is the
    least. One row a key and task is shuffled."""
    order = F.struct(F.col(ratio).isNull(), -F.col(ratio), F.col(tie))
    return rows.groupBy(F.col(key).alias("_key")).agg(F.min_by(F.struct(*rows.columns), order).alias("_row")).select("_row.*")


def prefix_overrides(won: DataFrame, key: str, value: str, width: int = 3) -> DataFrame:
    """Members whose value is not the dominant one of their prefix."""
    prefixed = won.withColumn("prefix", F.substring(key, 1, width))
    counts = prefixed.groupBy("prefix", value).agg(F.count("*").alias("n"))
    dominant = winners(counts, "prefix", "n", value).select("prefix", F.col(value).alias("dominant"))
    return prefixed.join(dominant, "prefix").where(F.col(value) != F.col("dominant")).select(key, value, "prefix", "dominant")


def area_share(rows: DataFrame, key: str, part: str, area: str) -> DataFrame:
    """Share of each part in its key's area; where all areas are 0, equal shares."""
    sums = rows.groupBy(key, part).agg(F.sum(area).alias("area"))
    own = Window.partitionBy(key)
    total, n = F.sum("area").over(own), F.count("*").over(own)
    return sums.select(key, part, F.when(total == 0, 1.0 / n).otherwise(F.col("area").cast("double") / total).alias("share"))


def roots(nodes: DataFrame, child: str, parent: str, hops: int = 32) -> DataFrame:
    """(node, root, depth) by walking parents at most ``hops`` times from the parent on: the
    first value that is no node, or where the walk is cut off, and the steps made.

    Steps are doubled: the table of 2**k steps joined to itself gives that of 2**(k+1), so
    the joins number log2(hops), each over the table of nodes. Cycles end at the cut.
    """
    walk = nodes.select(F.col(child).alias("node"), F.col(parent).alias("root"), F.lit(0).alias("depth"))
    jump = cut(nodes.select(F.col(child).alias("x"), F.col(parent).alias("to"), F.lit(1).alias("n")))

    def stepped(rows: DataFrame, at: str, n: str) -> DataFrame:
        more = jump.select(F.col("x").alias(at), F.struct("to", "n").alias("_more"))
        out = rows.join(more, at, "left")
        return out.withColumns({"_at": F.when(F.col("_more").isNull(), F.col(at)).otherwise(F.col("_more.to")), "_n": F.col(n) + F.coalesce("_more.n", F.lit(0))})

    while hops:
        if hops & 1:
            walk = stepped(walk, "root", "depth").select("node", F.col("_at").alias("root"), F.col("_n").alias("depth"))
        hops >>= 1
        if hops:
            jump = cut(stepped(jump, "to", "n").select("x", F.col("_at").alias("to"), F.col("_n").alias("n")))
    return walk.select("node", "root", "depth")


#: Keywords that may be constants of a plan.
MOST_KEYWORDS = 10_000


def capped_hits(docs: DataFrame, token_array: Column, keywords: DataFrame, cap: int = 5) -> DataFrame:
    """Per document and class, the sum over keywords of min(hits, cap). Only tokens that are a
    keyword become rows, to be joined with the closed list ``keywords`` (class, keyword)."""
    listed = [r[0] for r in keywords.select("keyword").distinct().limit(MOST_KEYWORDS + 1).collect()]
    own = F.filter(token_array, lambda t: t.isin(*listed)) if len(listed) <= MOST_KEYWORDS else token_array
    words = docs.select("doc_id", F.explode(own).alias("keyword"))
    hits = words.groupBy("doc_id", "keyword").agg(F.least(F.count("*"), F.lit(cap)).alias("n")).join(keywords, "keyword")
    return hits.groupBy("doc_id", "class").agg(F.sum("n").alias("score"), F.count("*").alias("n_terms"))


def phrase_pattern(phrase: str) -> str:
    """Any white space between words; word boundaries where the phrase ends in a word character."""
    import re

    body = r"\s+".join(re.escape(w) for w in phrase.split())
    return ("(?i)" + (r"\b" if phrase[0].isalnum() else "") + body + (r"\b" if phrase[-1].isalnum() else ""))


def phrase_hits(docs: DataFrame, phrases: list[str], text: str = "text", around: int = 30) -> DataFrame:
    """(doc_id, phrase, start, end, excerpt) of every phrase in every text, whatever white
    space is between its words. One Arrow pass, as no built-in gives the places of matches."""
    import re

    found = [(p, re.compile(phrase_pattern(p))) for p in phrases]

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            rows = [(d, p, m.start(), m.end(), t[max(0, m.start() - around) : m.end() + around]) for d, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) if t for p, r in found for m in r.finditer(t)]
            kinds = (batch.schema.field(0).type, pa.string(), pa.int32(), pa.int32(), pa.string())
            columns = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "phrase", "start", "end", "excerpt"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text).mapInArrow(run, f"doc_id {kind}, phrase string, start int, end int, excerpt string")


def fanned_out(rows: DataFrame, scopes: str = "scopes") -> DataFrame:
    """(keyword, category, source) of rules (ordinal, keyword, aliases, scopes, source, bucket):
    the keyword and its aliases in every category of the rule, in lower case; the source is
    the bucket where none is named; of equal rows the first proposed wins."""
    words = rows.select("ordinal", F.coalesce("source", "bucket").alias("source"), scopes, F.posexplode(F.concat(F.array("keyword"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("_word", "keyword"))
    scoped = words.select("ordinal", "source", "_word", F.lower(F.trim("keyword")).alias("keyword"), F.posexplode(scopes).alias("_scope", "category"))
    keyed = scoped.withColumn("k", F.struct("keyword", "category"))
    return first_wins(keyed, "k", ["source"], ["ordinal", "_word", "_scope"]).select("k.keyword", "k.category", "source")


def first_proposals(corpora: DataFrame, manual: DataFrame, removed: DataFrame) -> DataFrame:
    """(keyword, category, doctype, source): of equal keys the first, corpora before manual
    rows, less what a source's removal list (source, keyword) names."""
    every = concat_specs([corpora, manual]).join(removed.select("source", "keyword").distinct(), ["source", "keyword"], "left_anti")
    keyed = every.withColumn("k", F.struct("keyword", "category", "doctype"))
    return first_wins(keyed, "k", ["source"], ["spec_ord", "ordinal"]).select("k.*", "source")


def shipped(rows: DataFrame, categories: tuple[str, ...], statuses: tuple[str, ...] = ("approved",)) -> DataFrame:
    """Candidates of an approved status and a category of the closed list."""
    return rows.where(F.col("status").isin(*statuses) & F.col("category").isin(*categories))


def shipped_issuers(rows: DataFrame, promoted: tuple[str, ...] = ()) -> DataFrame:
    """Issuers that are not excluded and not embargoed; candidates only if promoted."""
    off = F.coalesce("excluded", F.lit(False)) | F.coalesce("embargoed", F.lit(False))
    return rows.where(~off & (~F.coalesce("candidate_only", F.lit(False)) | F.col("issuer").isin(*promoted)))


def accepted_by(value: Column, patterns: dict[str, list[str]]) -> Column:
    """The issuers of which some anchored pattern takes the whole value, in order of name."""
    return F.array_compact(F.array(*(F.when(value.rlike("|".join(f"^(?:{p.removeprefix('^').removesuffix('$')})$" for p in ps)), issuer) for issuer, ps in sorted(patterns.items()))))


def domain_verdict(address: Column, allowed: tuple[str, ...], personal: tuple[str, ...]) -> Column:
    """allowed, failure (a personal provider) or warning, by an address's domain."""
    domain = F.lower(F.regexp_extract(address, "@([^@]*)$", 1))
    return F.when(domain.isin(*allowed), "allowed").when(domain.isin(*personal), "failure").otherwise("warning")


def identifier_hits(docs: DataFrame, pattern: str, tokens: DataFrame, places: DataFrame) -> DataFrame:
    """(path, token) of identifiers in texts (path, text) that no list allows: ``tokens``
    (token) anywhere, ``places`` (path, part) in a path if the token holds the part."""
    hits = docs.select("path", F.explode(F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).alias("token")).distinct()
    left = hits.join(tokens.select("token").distinct(), "token", "left_anti")
    near = places.select(F.col("path").alias("_path"), F.col("part").alias("_part"))
    return left.join(near, (F.col("path") == F.col("_path")) & F.contains("token", "_part"), "left_anti").select("path", "token")


def acronym(name: Column) -> Column:
    """struct<stem, name, acronym> of ``Stem (ACR)``: the name is the stem without a leading
    ``US ``; the acronym is null where there is none."""
    pattern = r"^(.+?)\s*\(([A-Z0-9][A-Za-z0-9&/\- ]{0,31})\)\s*$"
    stem = F.trim(F.when(name.rlike(pattern), F.regexp_extract(name, pattern, 1)).otherwise(name))
    return F.struct(stem.alias("stem"), F.regexp_replace(stem, "^US (?=.)", "").alias("name"), F.when(name.rlike(pattern), F.trim(F.regexp_extract(name, pattern, 2))).alias("acronym"))


def translated(names: Column, vocabulary: dict[str, str]) -> Column:
    """A list of names in a closed vocabulary, distinct and sorted; an unknown one fails."""
    known = F.create_map(*(F.lit(x) for kv in vocabulary.items() for x in kv))
    one = lambda n: F.coalesce(F.try_element_at(known, n), F.raise_error(F.concat(F.lit("no such name: "), n)))
    return F.array_sort(F.array_distinct(F.transform(names, one)))


def word_list(rows: DataFrame, word: Column, order: str) -> DataFrame:
    """(word, first, well_formed): distinct words with where each is first, and whether it is
    letters, apostrophes and hyphens after a letter."""
    listed = rows.select(word.alias("word"), order).where("word != ''").groupBy("word").agg(F.min(order).alias("first"))
    return listed.withColumn("well_formed", F.col("word").rlike(r"^[a-z][a-z'\-]*$"))


def parity_gaps(counts: DataFrame, table: str, bucket: str, n: str, unlabelled: str = "unlabeled") -> DataFrame:
    """(table, gap): the spread of the labelled buckets' shares of a table, in points."""
    shares = counts.withColumn("_share", F.col(n).cast("double") / F.sum(n).over(Window.partitionBy(table)))
    spread = F.max(F.when(F.col(bucket) != unlabelled, F.col("_share"))) - F.min(F.when(F.col(bucket) != unlabelled, F.col("_share")))
    return shares.groupBy(table).agg(F.round(spread * 100, 6).alias("gap"))


def wire(rows: DataFrame, keys: tuple[str, ...] = (), audit: tuple[str, ...] = ()) -> DataFrame:
    """Rows as they ship: the wire keys alone, or all but audit keys and names with a leading
    underscore."""
    kept = [c for c in rows.columns if (c in keys if keys else c not in audit and not c.startswith("_"))]
    if missing := set(keys) - set(kept):
        raise ValueError(f"wire keys that the rows lack: {sorted(missing)}")
    return rows.select(*kept)
