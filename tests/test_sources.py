"""Readers and sinks on files of the sources' shapes; schema checks."""

import gzip
import hashlib
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from sievemark.operators import schema
from sievemark.sources import readers, sinks


def test_spanish_surnames_by_kind_of_file(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "s.zip", "w") as z:
        z.writestr("app_c.xlsx", b"x")
        z.writestr("app_c.csv", '\ufeffname,rank\nPEREZ,1\n"DE LA ""O""",2\n')
    (tmp_path / "s.csv").write_text("name,rank\nLopez,1\n")
    assert [r.key for r in readers.spanish_surnames_file(spark, str(tmp_path / "s.zip"), "s").orderBy("row_ord").collect()] == ["perez", 'de la "o"']
    assert [r.key for r in readers.spanish_surnames_file(spark, str(tmp_path / "s.csv"), "s").collect()] == ["lopez"]
    with pytest.raises(ValueError, match="expected"):
        readers.spanish_surnames_file(spark, str(tmp_path / "s.xlsx"), "s")
    with pytest.raises(Exception, match="no other.csv"):
        readers.zipped_records(spark, str(tmp_path / "s.zip"), "other.csv", ",").collect()


def test_names(spark, tmp_path):
    (tmp_path / "n.tsv").write_text("qid\tlabel\tsitelinks\nQ1\tAda\t9\n\n# note\nQ2\tBo\n")
    assert sorted(r.key for r in readers.linked_names(spark, str(tmp_path / "n.tsv"), "n").collect()) == ["ada", "bo"]
    (tmp_path / "bad.tsv").write_text("Q1 Ada\n")
    with pytest.raises(Exception, match="two fields"):
        readers.linked_names(spark, str(tmp_path / "bad.tsv"), "n").collect()
    (tmp_path / "p.csv").write_text("\ufeffCountry,Localized Name,Romanized Name\nXX,\u0410\u0434\u0430,Ada\nXX,Bo,Bo\n", encoding="utf-8")
    assert sorted(r.key for r in readers.romanized_names(spark, str(tmp_path / "p.csv"), "n").collect()) == ["ada", "bo"]
    with pytest.raises(ValueError, match="Romanized"):
        readers.romanized_names(spark, str(tmp_path / "n.tsv"), "n")


def test_postal_crosswalks(spark, tmp_path):
    head = "OID|GEOID_ZCTA5_20|GEOID_TRACT_20|AREALAND_PART"
    rows = ["1|10001|36061000100|30", "2|10001|34003000100|10", "3||36061000200|5", "4|10002|36061000300|0", "5|1000|36061000100|1", "6|10003|99061000100|1", "7|10003|36061000100|-1", "8|10003|3606100010|1"]
    (tmp_path / "c.txt").write_text("\ufeff" + "\n".join([head, *rows]) + "\n", encoding="utf-8")
    good, bad = readers.crosswalk(spark, str(tmp_path / "c.txt"))
    assert sorted(map(tuple, good.collect())) == [("10001", "NJ", 0.25), ("10001", "NY", 0.75), ("10002", "NY", 1.0)]
    assert sorted(r.rule for r in bad.collect()) == ["area", "state", "tract", "zone"]
    (tmp_path / "h.csv").write_text("ZIP,STATE,RES_RATIO,BUS_RATIO,OTH_RATIO,TOT_RATIO\n00501,NY,1.0,0,0,1\n")
    assert [r.ZIP for r in readers.crosswalk(spark, str(tmp_path / "h.csv"))[0].collect()] == ["00501"]
    (tmp_path / "x.csv").write_text("a,b\n")
    with pytest.raises(ValueError, match="neither"):
        readers.crosswalk(spark, str(tmp_path / "x.csv"))


def test_agencies(spark, tmp_path):
    rows = [("Executive", "[Branch]", "Branch"), ("US Agency of Caf\xe9 (AC)", "Executive", "Agency"), ("Sub Office", "US Agency of Caf\xe9 (AC)", "Agency"), ("Judicial", "[Branch]", "Branch"), ("Court", "Judicial", "Agency"), ("US Agency of Caf\xe9", "Executive", "Agency"), ("Kind", "Executive", "Other")]
    lines = ["GSA SFP Name,Parent,GSA SFP Entity Type", *(",".join(r) for r in rows)]
    (tmp_path / "g.csv").write_bytes(("\n".join(lines) + "\n").encode("cp1252"))
    got = {r.name: r.aliases for r in readers.federal_agencies(spark, str(tmp_path / "g.csv"), ("Agency",), ("Executive",)).collect()}
    assert got == {"Agency of Caf\xe9": ["AC", "US Agency of Caf\xe9", "US Agency of Caf\xe9 (AC)"], "Sub Office": []}
    (tmp_path / "r.json").write_text(json.dumps([{"name": " A ", "short_name": "X"}, {"name": "A", "short_name": "Y"}, {"name": "B", "short_name": "B"}, {"name": ""}]))
    assert sorted((r.name, r.aliases) for r in readers.register_agencies(spark, str(tmp_path / "r.json")).collect()) == [("A", ["X"]), ("B", [])]


def test_zipped_names(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        z.writestr("Text/places.txt", "feature_id|feature_name\n1|Akron\n2|Akron\n3| Bath \n4|\n")
        z.writestr("counties.txt", "USPS\tNAME\nAL\tAutauga County\n")
    path = str(tmp_path / "z.zip")
    assert sorted(r.name for r in readers.zipped_names(spark, path, "places.txt", "|", "feature_name").collect()) == ["Akron", "Bath"]
    assert [r.name for r in readers.zipped_names(spark, path, "counties.txt", "\t", "NAME").collect()] == ["Autauga County"]
    with pytest.raises(Exception, match="no column"):
        readers.zipped_names(spark, path, "counties.txt", "\t", "name").collect()


def test_json(spark, tmp_path):
    assert readers.strict_json(b'{"a": [1]}') == {"a": [1]}
    for bad in (b'\xef\xbb\xbf{}', b'\xff', b'{"a": 1, "a": 2}', b'[NaN]', b'{'):
        with pytest.raises(ValueError):
            readers.strict_json(bad)
    (tmp_path / "a.json").write_text('[{"term": "x"}, {"term": "y"}]')
    (tmp_path / "b.json").write_text('{"version": 1, "rows": [{"term": "z"}]}')
    assert [r.term for r in readers.candidate_rows(spark, str(tmp_path / "a.json"), "term:string").orderBy("ordinal").collect()] == ["x", "y"]
    assert [r.term for r in readers.candidate_rows(spark, str(tmp_path / "b.json"), "term:string", "rows").collect()] == ["z"]
    for path, key in (("a.json", "rows"), ("b.json", None), ("b.json", "other")):
        with pytest.raises(Exception):
            readers.candidate_rows(spark, str(tmp_path / path), "term:string", key).collect()
    rule = {"type": "object", "required": ["seed", "documents"], "properties": {"seed": {"type": "integer"}, "documents": {"type": "array", "items": {"type": "object", "required": ["doc_id"]}}}}
    (tmp_path / "d.json").write_text('{"seed": 7, "documents": [{"doc_id": "a"}]}')
    read = lambda **k: [r.doc_id for r in readers.checked_dump(spark, str(tmp_path / "d.json"), rule, "doc_id:string", "documents", "seed", **k).collect()]
    assert read(seed=7) == ["a"]
    with pytest.raises(ValueError, match="seed"):
        read(seed=8)
    (tmp_path / "d.json").write_text('{"seed": 7, "documents": [{}]}')
    with pytest.raises(ValueError, match="lacks doc_id"):
        read(seed=7)


def test_built_files_and_dated_sources(spark, tmp_path):
    for name in ("a/x.json", "a/.stamp", ".stamps/y", "diagnostics/z", "a/_ingest_cache/w", "b.txt"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(name)
    assert sorted(r.rel_path for r in readers.built_files(spark, str(tmp_path)).collect()) == ["a/x.json", "b.txt"]
    folder = tmp_path / "dated"
    folder.mkdir()
    (folder / "other.txt").write_text("x")
    assert readers.dated_source(spark, str(folder), "fdic_*.csv") is None
    (folder / "fdic_20260611.csv").write_text("x")
    path, day = readers.dated_source(spark, str(folder), "fdic_*.csv")
    assert path.endswith("fdic_20260611.csv") and day == "2026-06-11"
    (folder / "fdic_20260612.csv").write_text("x")
    with pytest.raises(ValueError, match="more than one"):
        readers.dated_source(spark, str(folder), "fdic_*.csv")
    readers.refuse_pointer(spark, str(folder), allow_small=True)


def test_shards_manifests_and_cache(spark, tmp_path):
    rows = spark.createDataFrame([(i % 2, f"line {i}") for i in range(10)], "shard int, line string")
    sinks.write_shards(rows, str(tmp_path / "s"), "shard", "line")
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "s" / "shard=1")).collect()) == [f"line {i}" for i in (1, 3, 5, 7, 9)]
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").option("recursiveFileLookup", "true").load(str(tmp_path / "s")).select("path", "content")
    for r in sinks.shard_metadata(files, "c0ffee").collect():
        data = open(r.shard.removeprefix("file:"), "rb").read()
        assert (r.sha256, r.content_sha256, r.bytes, r.commit) == (hashlib.sha256(data).hexdigest(), hashlib.sha256(gzip.decompress(data)).hexdigest(), len(data), "c0ffee")
    base = sinks.filter_manifest([{"name": "f", "type": "given", "n": 1, "m": 64, "k": 10, "fprTarget": 0.001, "sources": ["a"]}], 7, "2026-01-01T00:00:00Z")
    shipped = json.loads(sinks.shipped_manifest(base, spark.createDataFrame([("b", "2", 1), ("a", "1", 2)], "path string, sha256 string, bytes long")))
    assert shipped["version"] == "1.1.0" and [a["path"] for a in shipped["assets"]] == ["a", "b"] and shipped["filters"][0]["builtAt"].startswith("2026")
    built = []

    def build():
        built.append(1)
        return spark.createDataFrame([("x", 1)], "k string, n int")

    for mark in ("f1", "f1", "f2"):
        assert [tuple(r) for r in sinks.cached(spark, str(tmp_path / "c"), mark, build).collect()] == [("x", 1)]
    assert len(built) == 2


RULE = {
    "type": "object", "required": ["id", "tags"], "additionalProperties": False,
    "properties": {"id": {"type": "string", "pattern": "^[a-z]+$", "maxLength": 4}, "n": {"type": "integer", "minimum": 0, "exclusiveMaximum": 10, "multipleOf": 2}, "tags": {"type": "array", "items": {"enum": ["a", "b"]}, "uniqueItems": True, "minItems": 1}, "kind": {"$ref": "#/$defs/kind"}, "size": {"oneOf": [{"type": "number"}, {"const": "auto"}]}},
    "$defs": {"kind": {"anyOf": [{"type": "null"}, {"type": "string", "minLength": 2}]}},
}


@pytest.mark.parametrize(
    ("value", "wrong"),
    [
        ({"id": "ab", "tags": ["a"]}, []),
        ({"id": "ab", "tags": ["a"], "n": 4.0, "kind": None, "size": "auto"}, []),
        ({"id": "ABCDE", "tags": ["a"]}, ["/id", "/id"]),
        ({"tags": []}, ["", "/tags"]),
        ({"id": "a", "tags": ["a", "a", "c"], "x": 1}, ["/tags", "/tags/2", "/x"]),
        ({"id": "a", "tags": ["a"], "n": True}, ["/n"]),
        ({"id": "a", "tags": ["a"], "n": 11, "kind": "x", "size": "small"}, ["/kind", "/n", "/n", "/size"]),
        ([], [""]),
    ],
)
def test_schema_of_documents(value, wrong):
    assert sorted(at for at, _ in schema.violations(value, RULE)) == wrong


def test_schema_of_rows(spark):
    rows = spark.createDataFrame([("ab", 2, ["a"]), ("ABCDE", 12, ["a", "a"]), (None, None, [])], "id string, n int, tags array<string>").withColumn("row", F.monotonically_increasing_id())
    rule = {"required": ["id"], "properties": {k: RULE["properties"][k] for k in ("id", "n", "tags")}}
    got = sorted((r.field, r.rule) for r in schema.row_violations(rows, rule, "row").collect())
    assert got == [("id", "maxLength"), ("id", "pattern"), ("id", "required"), ("n", "exclusiveMaximum"), ("tags", "minItems"), ("tags", "uniqueItems")]
    with pytest.raises(ValueError, match="absent"):
        schema.row_violations(rows, {"required": ["other"], "properties": {}}, "row")
    with pytest.raises(ValueError, match="not supported"):
        list(schema.violations({}, {"unevaluatedProperties": False}))


def test_sidecar_lines(spark, tmp_path):
    row = {"doc_id": "d", "family": "ssn", "start": 5, "end": 10, "outcome": "tp", "tier": "must", "det_start": 4, "det_end": 12, "det_spans": [[4, 7], [8, 12]]}
    lines = [row, row | {"det_spans": [[4, 7], [8, 11]]}, row | {"det_spans": [[8, 12], [4, 7]]}, row | {"det_spans": [[4, 5], [8, 12]]}, row | {"more": 1}, {k: v for k, v in row.items() if k != "end"}, row | {"outcome": "xx"}, row | {"start": "five"}, {"doc_id": "d", "family": "ssn", "start": 5, "end": 10, "outcome": "fn", "tier": "must"}]
    (tmp_path / "s.jsonl").write_text("\n".join([*map(json.dumps, lines), "[1]", ""]))
    rows, broken = readers.sidecar_rows(spark, str(tmp_path / "s.jsonl"))
    assert rows.count() == 6
    assert sorted(r.rule for r in broken.collect()) == ["hull", "key_absent", "key_unknown", "not_an_object", "outcome", "span_order", "span_outside", "type"]


def test_table_function_of_matches(spark):
    from sievemark.functions.detectors import register_finditer

    register_finditer(spark)
    got = spark.sql("SELECT value, start, end FROM finditer('mail a@b.org, c@d.org', 'email')").collect()
    assert [tuple(r) for r in got] == [("a@b.org", 5, 12), ("c@d.org", 14, 21)]


def test_stamps_installs_and_presets(spark):
    from sievemark.operators import calibration, integrity

    files = spark.createDataFrame([("b", "1" * 64), ("a", "2" * 64)], "rel_path string, sha256 string")
    stamp = integrity.content_manifest(files)
    assert [r.line for r in stamp.collect()] == ["2" * 64 + "  a", "1" * 64 + "  b"]
    assert not integrity.content_changed(files, stamp)
    assert integrity.content_changed(files.where("rel_path = 'a'"), stamp) and integrity.content_changed(files, spark.createDataFrame([("x",)], "line string"))
    new = spark.createDataFrame([("g", 3, "x"), ("h", None, "y")], "rel_path string, entries int, sha256 string")
    old = spark.createDataFrame([("g", 5)], "rel_path string, entries int")
    assert integrity.installed(new, old, ()).count() == integrity.installed(new, old, ("g",), allow_shrink=True).count() == 2
    with pytest.raises(Exception, match="would shrink"):
        integrity.installed(new, old, ("g", "h")).collect()
    assert integrity.rebuilt_alike(lambda: files.repartition(3))
    table = calibration.preset_table(spark)
    assert calibration.checked_presets(table, tuple(calibration.PRESETS)).count() == 0 and table.count() == 17
    held = calibration.feasible(table, calibration.ceiling_table(spark), "category", ("conservative", "balanced", "aggressive"))
    assert all(abs(r[p] - v) < 1e-9 for r in held.collect() for p, v in zip(("conservative", "balanced", "aggressive"), calibration.PRESETS[r.category]))
    assert readers.strict_json(b"1") == 1


def test_sinks_in_order_and_wire_rows(spark, tmp_path):
    from sievemark.operators import gazetteer

    rows = spark.createDataFrame([(i * 7 % 100, None if i % 2 else "x", i) for i in range(100)], "k int, b string, _note int").repartition(5)
    sinks.write_sorted(rows, str(tmp_path / "p"), ["k"])
    ranges = spark.read.parquet(str(tmp_path / "p")).groupBy(F.input_file_name().alias("f")).agg(F.min("k").alias("a"), F.max("k").alias("b")).orderBy("f").collect()
    assert all(x.b < y.a for x, y in zip(ranges, ranges[1:]))
    sinks.write_json_lines(gazetteer.wire(rows), str(tmp_path / "j"), ["k"])
    lines = [r.value for r in spark.read.text(str(tmp_path / "j")).collect()]
    assert sorted(lines)[0] in ('{"b":null,"k":0}', '{"b":"x","k":0}') and all(list(json.loads(x)) == ["b", "k"] for x in lines)
    assert gazetteer.wire(rows, keys=("k",)).columns == ["k"]
    with pytest.raises(ValueError, match="lack"):
        gazetteer.wire(rows, keys=("z",))


def test_interrupted_entities(spark, tmp_path):
    lines = ["wikidata_id\teng\tlabel\tlanguage\ttype"] + [f"{q}\te\tl\ten\tPER" for q in ("Q1", "Q1", "Q2", "Q1", "Q3")]
    (tmp_path / "p.tsv").write_text("\n".join(lines) + "\n")
    assert [(r.wikidata_id, r.runs) for r in readers.interrupted_entities(spark, str(tmp_path / "p.tsv")).collect()] == [("Q1", 2)]
