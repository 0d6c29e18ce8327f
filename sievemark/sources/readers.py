"""Readers of the public source files, each with an explicit row ordinal.

Text sources go through Spark's readers with a fixed schema and fail on malformed
rows. Files inside archives and dBase files are read whole, one file a row, and
parsed in Arrow batches on the executors.
"""

from __future__ import annotations

import io
import json
import re
import struct
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import nfkc_lower
from ..operators.gazetteer import acronym, area_share, roots
from ..operators.merge import broken_runs, keep_entities, plurality

#: Bytes under which a large source is taken for a pointer to itself.
POINTER_BYTES = 1 << 20


@dataclass(frozen=True)
class Format:
    """How a delimited source is laid out."""

    columns: str
    sep: str = ","
    header: bool = False
    encoding: str = "UTF-8"
    comment: str = ""


SSA = Format("name string, sex string, n int", comment="#")
CENSUS_SURNAMES = Format("name string, pctwhite string, pctblack string, pctapi string, pctaian string, pcthispanic string", header=True)
PARANAMES = Format("wikidata_id string, eng string, label string, language string, type string", sep="\t", header=True)
POPNAMES = Format("country string, type string, name string", header=True)
FDIC = Format("NAME string, CERT int, CITY string, STNAME string, ACTIVE string", header=True)
HUD_ZIP = Format("ZIP string, STATE string, RES_RATIO double, BUS_RATIO double, OTH_RATIO double, TOT_RATIO double", header=True)


def delimited(spark: SparkSession, path: str, layout: Format) -> DataFrame:
    """Rows of a delimited file; with a header its names are checked."""
    reader = spark.read.schema(layout.columns).option("sep", layout.sep).option("header", layout.header).option("encoding", layout.encoding).option("mode", "FAILFAST").option("enforceSchema", not layout.header)
    if layout.comment:
        reader = reader.option("comment", layout.comment)
    return reader.csv(path)


def with_ordinal(rows: DataFrame, spec: str, key: Column) -> DataFrame:
    """(key, source_id, row_ord): ordinals grow with the order of rows in the files."""
    return rows.select(key.alias("key"), F.lit(spec).alias("source_id"), F.monotonically_increasing_id().alias("row_ord"), *rows.columns).where("key != ''")


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(line, row_ord) without blank and comment lines."""
    rows = spark.read.text(path).select(F.trim("value").alias("line"), F.monotonically_increasing_id().alias("row_ord"))
    return rows.where("line != '' AND NOT startswith(line, '#')")


def given_names(spark: SparkSession, path: str, spec: str) -> DataFrame:
    return with_ordinal(delimited(spark, path, SSA), spec, nfkc_lower(F.trim("name"))).select("key", "source_id", "row_ord", F.lit("unlabeled").alias("demographic"))


def census_surnames(spark: SparkSession, path: str, spec: str) -> DataFrame:
    """Surnames with the plurality label of their five shares; suppressed shares are 0."""
    rows = with_ordinal(delimited(spark, path, CENSUS_SURNAMES), spec, nfkc_lower(F.trim("name")))
    share = lambda c: F.coalesce(F.col(c).try_cast("double"), F.lit(0.0))
    label = plurality({"white": share("pctwhite"), "black": share("pctblack"), "asian": share("pctapi"), "ai_an": share("pctaian"), "hispanic": share("pcthispanic")})
    return rows.select("key", "source_id", "row_ord", label.alias("demographic"))


def spanish_surnames(spark: SparkSession, path: str, spec: str) -> DataFrame:
    return lines(spark, path).select(nfkc_lower(F.col("line")).alias("key"), F.lit(spec).alias("source_id"), "row_ord", F.lit("hispanic").alias("demographic"))


def multilingual_names(spark: SparkSession, path: str, least: int = 5, languages: list[str] | None = None) -> DataFrame:
    """Labels of the persons that have names in at least ``least`` languages."""
    rows = delimited(spark, path, PARANAMES).where("type = 'PER'")
    return keep_entities(rows, "wikidata_id", "language", nfkc_lower(F.trim("label")), least, languages)


def interrupted_entities(spark: SparkSession, path: str) -> DataFrame:
    """(wikidata_id, runs): entities whose rows do not stand together in the file."""
    rows = delimited(spark, path, PARANAMES).select("wikidata_id", F.monotonically_increasing_id().alias("row_ord"))
    return broken_runs(rows, "wikidata_id", "row_ord")


def names_by_type(spark: SparkSession, path: str, kind: str, spec: str) -> DataFrame:
    rows = delimited(spark, path, POPNAMES).where(F.col("type") == kind)
    return with_ordinal(rows, spec, nfkc_lower(F.trim("name"))).select("key", "source_id", "row_ord", F.lit("unlabeled").alias("demographic"))


def active_banks(spark: SparkSession, path: str, states: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(institutions, rows of unknown states); inactive ones are left out."""
    rows = delimited(spark, path, FDIC).where(F.coalesce(F.col("ACTIVE").try_cast("int"), F.lit(0)) == 1)
    known = F.broadcast(spark.createDataFrame(list(states.items()), "STNAME string, jurisdiction string"))
    joined = rows.join(known, "STNAME", "left")
    return joined.where("jurisdiction IS NOT NULL").select(F.lower(F.trim("NAME")).alias("name"), "jurisdiction"), joined.where("jurisdiction IS NULL")


def listed_companies(spark: SparkSession, path: str, most: int = 500) -> DataFrame:
    """The first ``most`` entries of a JSON object with numbers as keys."""
    kind = "map<string,struct<cik_str:bigint,ticker:string,title:string>>"
    rows = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", kind)).alias("k", "v"))
    return rows.select(F.col("k").cast("int").alias("rank"), "v.*").orderBy("rank").limit(most)


def nicknames(spark: SparkSession, path: str) -> DataFrame:
    """(canonical, alias) pairs of lines ``canonical, alias, alias ...``."""
    parts = F.transform(F.split("line", ","), lambda p: F.lower(F.trim(p)))
    rows = lines(spark, path).select(parts.alias("p"))
    return rows.select(F.element_at("p", 1).alias("canonical"), F.explode(F.slice("p", 2, F.size("p"))).alias("alias")).where("alias != ''").distinct()


def keywords(spark: SparkSession, path: str) -> DataFrame:
    """Lower-case keywords with the ordinal of their first line."""
    return lines(spark, path).groupBy(F.lower("line").alias("keyword")).agg(F.min("row_ord").alias("row_ord"))


def zip_ratios(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(rows, violations) of a postal crosswalk."""
    rows = delimited(spark, path, HUD_ZIP).select("ZIP", F.upper("STATE").alias("STATE"), F.col("RES_RATIO").alias("ratio"))
    good = F.col("ZIP").rlike("^[0-9]{5}$") & F.col("STATE").rlike("^[A-Z]{2}$") & F.col("ratio").between(0, 1)
    return rows.where(good), rows.where(~F.coalesce(good, F.lit(False)))


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def hash_lines(spark: SparkSession, path: str) -> DataFrame:
    """(rel_path, sha256) of a lock file; other lines fail."""
    rows = lines(spark, path).select(F.regexp_extract("line", r"^(\S.*?)  ([0-9a-f]{64})$", 1).alias("rel_path"), F.regexp_extract("line", r"  ([0-9a-f]{64})$", 1).alias("sha256"), "line")
    return rows.select(F.when(F.col("sha256") != "", F.col("rel_path")).otherwise(F.raise_error(F.concat(F.lit("not a lock line: "), "line"))).alias("rel_path"), "sha256")


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a Markdown table: path, license, url, date, digest, description."""
    cell = r"\s*([^|]+?)\s*\|"
    pattern = r"^\s*\|" + cell * 3 + r"\s*([0-9]{4}-[0-9]{2}-[0-9]{2})\s*\|\s*([0-9a-f]{64})\s*\|" + cell + r"\s*$"
    names = ("rel_path", "license", "url", "retrieved", "sha256", "description")
    return spark.read.text(path).where(F.col("value").rlike(pattern)).select(*(F.regexp_extract("value", pattern, i + 1).alias(n) for i, n in enumerate(names)))


def files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path, bytes, sha256) of files, contents digested on the executors."""
    rows = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
    return rows.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def refuse_pointer(spark: SparkSession, path: str, least: int = POINTER_BYTES, allow_small: bool = False) -> None:
    """Fail for a large source that is not there but a pointer to it; ``allow_small`` is for
    small stand-ins, as in tests."""
    if allow_small:
        return
    small = spark.read.format("binaryFile").load(path).select("path", "length").where(F.col("length") < least).first()
    if small:
        raise ValueError(f"{small['path']} has {small['length']} bytes: the source was not fetched")


def zipped_lines(spark: SparkSession, path: str, member: str = "", encoding: str = "utf-8-sig") -> DataFrame:
    """(path, member, line_no, line) of the members of archives whose name ends in ``member``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path_, content in zip(b["path"], b["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for name in sorted(n for n in z.namelist() if n.endswith(member) and not n.endswith("/")):
                        text = z.read(name).decode(encoding).splitlines()
                        yield pd.DataFrame({"path": path_, "member": name, "line_no": range(len(text)), "line": text})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "path string, member string, line_no long, line string")


def dbase_fields(data: bytes, field: str = "NAME", encoding: str = "cp1252") -> list[str]:
    """Values of one field of a dBase table; deleted records are skipped."""
    n, head, width = struct.unpack_from("<xxxxIHH", data)
    at, begin, size = 32, 1, None
    while data[at] != 0x0D:
        name = data[at : at + 11].split(b"\0")[0].decode("ascii")
        if name == field:
            size = data[at + 16]
            break
        begin += data[at + 16]
        at += 32
    if size is None:
        raise ValueError(f"no field {field}")
    records = (data[head + i * width : head + (i + 1) * width] for i in range(n))
    return [r[begin : begin + size].decode(encoding).strip() for r in records if r[:1] != b"*"]


def dbase_names(spark: SparkSession, path: str, field: str = "NAME") -> DataFrame:
    """Distinct values of a field in the dBase files of archives."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for content in b["content"]:
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for name in sorted(n for n in z.namelist() if n.lower().endswith(".dbf")):
                        yield pd.DataFrame({"name": dbase_fields(z.read(name), field)})

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, "name string").where("name != ''").distinct()


#: What is left out of a scan of built files.
SKIPPED_NAMES = (".stamp", ".gitkeep", "_timings.jsonl", "bundle_size.meta.json")
SKIPPED_FOLDERS = (".stamps", "diagnostics", "_ingest_cache")
#: State codes by their two-digit numbers.
STATE_NUMBERS = dict(
    pair.split(":")
    for pair in (
        "01:AL 02:AK 04:AZ 05:AR 06:CA 08:CO 09:CT 10:DE 11:DC 12:FL 13:GA 15:HI 16:ID 17:IL 18:IN 19:IA 20:KS 21:KY 22:LA 23:ME 24:MD 25:MA 26:MI 27:MN 28:MS 29:MO 30:MT 31:NE 32:NV 33:NH 34:NJ 35:NM 36:NY 37:NC 38:ND 39:OH "
        "40:OK 41:OR 42:PA 44:RI 45:SC 46:SD 47:TN 48:TX 49:UT 50:VT 51:VA 53:WA 54:WV 55:WI 56:WY 60:AS 66:GU 69:MP 72:PR 78:VI"
    ).split()
)
ROOT_PARENTS = ("[Branch]", "[Bucket]", "")


def spanish_surnames_file(spark: SparkSession, path: str, spec: str, member: str = "app_c.csv") -> DataFrame:
    """The Spanish surname list from its archive (the named member) or as delimited text;
    any other kind of file is refused."""
    suffix = path.rsplit(".", 1)[-1].lower()
    if suffix == "zip":
        rows = zipped_records(spark, path, member, ",")
        missing = F.raise_error(F.lit("no column name"))
        key, ord_ = nfkc_lower(F.trim(F.coalesce(F.try_element_at("record", F.lit("name")), missing))), F.col("line_no")
    elif suffix in ("csv", "txt"):
        rows = spark.read.option("header", True).option("mode", "FAILFAST").csv(path)
        key, ord_ = nfkc_lower(F.trim("name")), F.monotonically_increasing_id()
    else:
        raise ValueError(f"{path}: expected .zip, .csv or .txt")
    return rows.select(key.alias("key"), F.lit(spec).alias("source_id"), ord_.alias("row_ord"), F.lit("hispanic").alias("demographic")).where("key != ''")


def linked_names(spark: SparkSession, path: str, spec: str) -> DataFrame:
    """Names of lines ``qid<TAB>label<TAB>sitelinks``; a first line that begins with qid is a
    header, and a line of fewer than two fields fails."""
    rows = spark.read.text(path).select(F.split("value", "\t").alias("f"), "value", F.monotonically_increasing_id().alias("row_ord"))
    rows = rows.where("trim(value) != '' AND NOT startswith(value, '#') AND NOT (lower(f[0]) = 'qid')")
    label = F.when(F.size("f") >= 2, F.get("f", 1)).otherwise(F.raise_error(F.concat(F.lit("fewer than two fields: "), "value")))
    return rows.select(nfkc_lower(F.trim(label)).alias("key"), F.lit(spec).alias("source_id"), "row_ord", F.lit("unlabeled").alias("demographic")).where("key != ''")


def romanized_names(spark: SparkSession, path: str, spec: str) -> DataFrame:
    """The ``Romanized Name`` column of a file of one type of names; a byte-order mark at the
    head of the file does no harm."""
    rows = spark.read.option("header", True).option("mode", "FAILFAST").csv(path)
    named = {c.lstrip("\ufeff").strip('"'): c for c in rows.columns}
    if "Romanized Name" not in named:
        raise ValueError(f"{path}: no column Romanized Name among {rows.columns}")
    plain = rows.select(F.col("`" + named["Romanized Name"] + "`").alias("name"))
    return with_ordinal(plain, spec, nfkc_lower(F.trim("name"))).select("key", "source_id", "row_ord", F.lit("unlabeled").alias("demographic"))


def zone_tracts(spark: SparkSession, path: str, states: dict[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, violations) of the relationship file of postal zones and tracts: rows (ZIP,
    STATE, ratio) with each state's share of a zone's land; rows without a zone are skipped."""
    raw = spark.read.option("header", True).option("sep", "|").csv(path)
    raw = raw.toDF(*(c.lstrip("\ufeff") for c in raw.columns))
    rows = raw.select(F.trim("GEOID_ZCTA5_20").alias("zone"), F.trim("GEOID_TRACT_20").alias("tract"), F.coalesce(F.nullif(F.trim("AREALAND_PART"), F.lit("")), F.lit("0")).alias("land")).where("coalesce(zone, '') != ''")
    known = F.create_map(*(F.lit(x) for kv in (states or STATE_NUMBERS).items() for x in kv))
    rows = rows.withColumns({"state": F.try_element_at(known, F.substring("tract", 1, 2)), "area": F.col("land").try_cast("long")})
    rule = F.when(~F.col("zone").rlike("^[0-9]{5}$"), "zone").when(~F.coalesce(F.col("tract").rlike("^[0-9]{11}$"), F.lit(False)), "tract").when(F.col("state").isNull(), "state").when(F.col("area").isNull() | (F.col("area") < 0), "area")
    judged = rows.withColumn("rule", rule)
    shares = area_share(judged.where("rule IS NULL"), "zone", "state", "area")
    return shares.select(F.col("zone").alias("ZIP"), F.col("state").alias("STATE"), F.col("share").alias("ratio")), judged.where("rule IS NOT NULL").select("zone", "tract", "land", "rule")


def crosswalk(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(rows, violations) of a postal crosswalk of either layout, told by its first line."""
    first = spark.read.text(path).first()
    head = first[0].lstrip("\ufeff") if first else ""
    if "GEOID_ZCTA5_20" in head and "|" in head:
        return zone_tracts(spark, path)
    if head.startswith("ZIP") and "," in head:
        return zip_ratios(spark, path)
    raise ValueError(f"{path}: neither layout of a postal crosswalk: {head!r}")


def federal_agencies(spark: SparkSession, path: str, kinds: tuple[str, ...], branches: tuple[str, ...]) -> DataFrame:
    """(name, aliases, category, jurisdictions) of a hierarchy file: rows of the given entity
    kinds whose topmost ancestor is one of the given branches; the first row of a name wins."""
    field = lambda name: F.trim(F.coalesce(F.element_at("record", F.lit(name)), F.lit("")))
    raw = encoded_records(spark, path, "cp1252")
    rows = raw.select(field("GSA SFP Name").alias("raw"), field("GSA SFP Entity Type").alias("kind"), field("Parent").alias("parent"), F.col("line_no").alias("ord")).where("raw != ''")
    nodes = rows.groupBy("raw").agg(F.max_by("parent", "ord").alias("parent"))
    known = nodes.select(F.col("raw").alias("parent"), F.lit(True).alias("_known"))
    edges = nodes.join(known, "parent", "left").where(F.col("_known") & ~F.col("parent").isin(*ROOT_PARENTS)).select("raw", "parent")
    tops = roots(edges, "raw", "parent").select(F.col("node").alias("raw"), "root")
    placed = rows.where(F.col("kind").isin(*kinds)).join(tops, "raw", "left").where(F.coalesce("root", "raw").isin(*branches))
    named = placed.withColumn("a", acronym(F.col("raw"))).where("a.name != ''")
    first = named.groupBy(F.col("a.name").alias("name")).agg(F.min_by(F.struct("raw", "a"), "ord").alias("r"))
    stem, whole = F.col("r.a.stem"), F.col("r.raw")
    every = F.array_compact(F.array(F.col("r.a.acronym"), F.when(stem != F.col("name"), stem), F.when((whole != F.col("name")) & (whole != stem), whole)))
    return first.select("name", F.array_sort(F.array_distinct(every)).alias("aliases"), F.lit("federal_agency").alias("category"), F.array(F.lit("US")).alias("jurisdictions"))


def register_agencies(spark: SparkSession, path: str) -> DataFrame:
    """(name, aliases, category, jurisdictions) of a JSON list of agencies; the alias is the
    short name where it differs, the first record of a name wins."""
    rows = spark.read.text(path, wholetext=True).select(F.posexplode(F.from_json("value", "array<struct<name:string,short_name:string>>", {"mode": "FAILFAST"})).alias("ord", "r"))
    rows = rows.select("ord", F.trim("r.name").alias("name"), F.trim("r.short_name").alias("short")).where("coalesce(name, '') != ''")
    first = rows.groupBy("name").agg(F.min_by(F.struct("short"), "ord").alias("f"))
    alias = F.when((F.coalesce("f.short", F.lit("")) != "") & (F.col("f.short") != F.col("name")), F.col("f.short"))
    return first.select("name", F.array_compact(F.array(alias)).alias("aliases"), F.lit("federal_agency").alias("category"), F.array(F.lit("US")).alias("jurisdictions"))


def _records(text: io.TextIOBase, sep: str) -> list[dict]:
    import csv

    return [{(k or "").strip(): v for k, v in r.items() if k is not None} for r in csv.DictReader(text, delimiter=sep)]


def encoded_records(spark: SparkSession, path: str, encoding: str, sep: str = ",") -> DataFrame:
    """(path, line_no, record map<column, value>) of a delimited file in an encoding that
    Spark's own reader does not take; one file a task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path_, content in zip(b["path"], b["content"], strict=True):
                records = _records(io.StringIO(content.decode(encoding), newline=""), sep)
                yield pd.DataFrame({"path": path_, "line_no": range(2, len(records) + 2), "record": records})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "path string, line_no long, record map<string,string>")


def zipped_records(spark: SparkSession, path: str, member: str, sep: str) -> DataFrame:
    """(path, line_no, record map<column, value>) of a delimited member with a header; quotes
    and line ends inside quotes are honoured. An archive without the member fails."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path_, content in zip(b["path"], b["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    names = [n for n in z.namelist() if n == member or n.endswith("/" + member)]
                    if not names:
                        raise ValueError(f"{path_}: no {member} among {z.namelist()}")
                    for name in names:
                        with io.TextIOWrapper(z.open(name), encoding="utf-8-sig", newline="") as text:
                            records = _records(text, sep)
                        yield pd.DataFrame({"path": path_, "line_no": range(2, len(records) + 2), "record": records})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "path string, line_no long, record map<string,string>")


def zipped_names(spark: SparkSession, path: str, member: str, sep: str, column: str) -> DataFrame:
    """Distinct values of a column of a zipped file: populated places (``|``, feature_name),
    counties (tab, NAME) and the like. A file without the column fails."""
    value = F.when(F.map_contains_key("record", F.lit(column)), F.trim(F.try_element_at("record", F.lit(column)))).otherwise(F.raise_error(F.lit(f"no column {column}")))
    return zipped_records(spark, path, member, sep).select(value.alias("name")).where("name != ''").distinct()


def strict_json(data: bytes):
    """The value of a JSON file: UTF-8 without a byte-order mark, no repeated keys, no NaN."""

    def once(pairs: list) -> dict:
        out = dict(pairs)
        if len(out) < len(pairs):
            raise ValueError("a key comes twice")
        return out

    def refuse(name: str):
        raise ValueError(f"{name} is no JSON")

    if data.startswith(b"\xef\xbb\xbf"):
        raise ValueError("a byte-order mark")
    return json.loads(data.decode("utf-8"), object_pairs_hook=once, parse_constant=refuse)


def candidate_rows(spark: SparkSession, path: str, schema: str, rows_key: str | None = None) -> DataFrame:
    """Rows (ordinal, columns of ``schema``) of a candidates file: a JSON array, or an object
    that holds it under ``rows_key``. Anything else fails."""
    whole = spark.read.text(path, wholetext=True)
    kind = f"array<struct<{schema}>>"
    parsed = F.from_json("value", kind if rows_key is None else f"struct<`{rows_key}`:{kind}>", {"mode": "FAILFAST"})
    listed = parsed if rows_key is None else parsed[rows_key]
    shape = F.substring(F.ltrim("value"), 1, 1) == ("[" if rows_key is None else "{")
    rows = F.when(shape & listed.isNotNull(), listed).otherwise(F.raise_error(F.lit(f"{path}: not the expected rows")))
    each = whole.select(F.posexplode(rows).alias("ordinal", "r"))
    return each.select(F.when(F.col("r").isNotNull(), F.col("ordinal")).otherwise(F.raise_error(F.lit("a row that is no object"))).alias("ordinal"), "r.*")


def checked_dump(spark: SparkSession, path: str, schema: dict, columns: str, rows_key: str, seed_key: str | None = None, seed: int | None = None) -> DataFrame:
    """Rows of a JSON dump that keeps a JSON schema, after a check of its corpus seed. A dump
    is one artifact of a build, read whole on the driver for the check."""
    from ..operators.schema import violations

    text = spark.read.text(path, wholetext=True).first()[0]
    value = strict_json(text.encode())
    broken = [f"{at or '<root>'}: {what}" for at, what in violations(value, schema)]
    if broken:
        raise ValueError(f"{path}: " + "; ".join(broken[:20]))
    if seed_key and value[seed_key] != seed:
        raise ValueError(f"{path}: made from seed {value[seed_key]}, not {seed}")
    return candidate_rows(spark, path, columns, rows_key)


def built_files(spark: SparkSession, path: str) -> DataFrame:
    """(rel_path, bytes, sha256) of what a build left, without marks, caches and diagnostics."""
    root = path.rstrip("/")
    rows = files(spark, root).withColumn("rel_path", F.regexp_replace("path", r"^.*?" + re.escape(root.split(":")[-1]) + "/", ""))
    parts = F.split("rel_path", "/")
    folders = F.slice(parts, 1, F.size(parts) - 1)
    off = F.element_at(parts, -1).isin(*SKIPPED_NAMES) | F.arrays_overlap(folders, F.array(*map(F.lit, SKIPPED_FOLDERS)))
    return rows.where(~off).select("rel_path", "bytes", "sha256")


def dated_source(spark: SparkSession, folder: str, glob: str) -> tuple[str, str] | None:
    """(path, ISO date) of the one file that a pattern finds, none if there is none. Two are an
    error: a newer fetch must not take an older one's place unseen."""
    found = [r[0] for r in spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder).select("path").orderBy("path").limit(3).collect()]
    if len(found) > 1:
        raise ValueError(f"more than one file for {glob}: {found}")
    if not found:
        return None
    day = re.search(r"_([0-9]{4})([0-9]{2})([0-9]{2})\.[^.]+$", found[0])
    if not day:
        raise ValueError(f"{found[0]}: no date at its end")
    return found[0], "-".join(day.groups())


def sidecar_rows(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(rows, violations) of a JSON-lines sidecar. A line that is no object, lacks a key or has
    one that is not known is a violation (line_no, rule); the rules of rows are checked, too."""
    from ..operators.spans import SIDECAR_KEYS, SIDECAR_MORE, sidecar_violations

    kind = "doc_id string, family string, start int, end int, outcome string, tier string, det_start int, det_end int, det_spans array<array<int>>"
    text = spark.read.text(path).select(F.monotonically_increasing_id().alias("line_no"), "value").where("trim(value) != ''")
    keys = F.json_object_keys("value")
    known = F.array(*map(F.lit, SIDECAR_KEYS + SIDECAR_MORE))
    rule = F.when(keys.isNull(), "not_an_object").when(F.size(F.array_except(F.array(*map(F.lit, SIDECAR_KEYS)), keys)) > 0, "key_absent").when(F.size(F.array_except(keys, known)) > 0, "key_unknown")
    read = F.from_json("value", f"{kind}, _odd string", {"columnNameOfCorruptRecord": "_odd"})
    judged = text.withColumns({"rule": rule, "r": read}).withColumn("rule", F.coalesce("rule", F.when(F.col("r._odd").isNotNull(), "type")))
    parsed = judged.where("rule IS NULL").select("line_no", "r.*").drop("_odd")
    pairs = F.transform("det_spans", lambda p: F.struct(F.get(p, 0).alias("start"), F.get(p, 1).alias("end")))
    rows = parsed.withColumn("det_spans", pairs)
    broken = sidecar_violations(rows).select("line_no", "rule")
    return rows, judged.where("rule IS NOT NULL").select("line_no", "rule").unionByName(broken)
