"""Operators against hand-made rows, fixed vectors and brute force."""

import random
import struct
import zipfile

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sievemark.functions import context, detectors, text
from sievemark.functions import validators as V
from sievemark.operators import bloom, calibration, corpus, documents, evaluation, gazetteer, generate, hostile, integrity, merge, ordered, spans, tally, values
from sievemark.sources import readers, sinks


def column(spark, values, make, kind="string"):
    rows = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(make(F.col("v"))).collect()]


def test_validators(spark):
    ssn = {"000-12-3456": "area_000", "666-12-3456": "area_666", "900-12-3456": "area_900_999", "123-00-1234": "group_00", "123-45-0000": "serial_0000", "078-05-1120": "literal_078_05_1120", "111-11-1111": "all_same_digit", "666-66-6666": "area_666", "123-45-6789": None, "12-3": "shape"}
    assert column(spark, list(ssn), V.ssn_reason) == list(ssn.values())
    itin = {"912-50-1234": None, "912-66-1234": "yy_out_of_range", "912-93-1234": "yy_out_of_range", "912-99-0001": None, "812-50-1234": "shape"}
    assert column(spark, list(itin), V.itin_reason) == list(itin.values())
    card = {"4111111111111111": None, "4111111111111112": "luhn", "5500000000000004": None, "2221000000000009": None, "340000000000009": None, "6011000000000004": None, "3530111333300000": None, "1234567890123452": "brand", "41": "length"}
    assert column(spark, list(card), V.card_reason) == list(card.values())
    npi = {"1234567893": None, "1234567894": "checksum", "3234567893": "prefix", "123": "length"}
    assert column(spark, list(npi), V.npi_reason) == list(npi.values())
    dea = {"AB1234563": None, "AB1234564": "checksum", "A11234563": "prefix", "AB123": "length"}
    assert column(spark, list(dea), V.dea_reason) == list(dea.values())
    aba = {"021000021": None, "021000022": "checksum", "131000021": "prefix", "2": "length"}
    assert column(spark, list(aba), V.aba_reason) == list(aba.values())


def test_cutover_diff(spark):
    old = spark.createDataFrame([("a", 1, 1), ("a", 2, 2), ("b", 1, 1), ("c", None, 1), ("d", 1, 1)], "k string, v int, o int")
    new = spark.createDataFrame([("a", 2, 1), ("a", 3, 0), ("c", 1, 1), ("d", 1, 1), ("e", 1, 1)], "k string, v int, o int")
    later = integrity.cutover_diff(old, new, "k", ["v"], "o").orderBy("k").collect()
    assert [tuple(r) for r in later] == [("b", "legacy_only"), ("c", "changed"), ("e", "rebuild_only")]
    pairs = integrity.cutover_diff(old, new, "k", ["v"]).orderBy("k").collect()
    assert [tuple(r) for r in pairs] == [("a", "changed")] * 3 + [("b", "legacy_only"), ("e", "rebuild_only")]


def test_dates(spark):
    rows = [((2, 29, 2000), None), ((2, 29, 1900), "non_leap_feb_29"), ((2, 30, 2000), "month_day_overflow"), ((4, 31, 1999), "month_day_overflow"), ((13, 1, 1999), "invalid_month"), ((1, 32, 1999), "invalid_day")]
    df = spark.createDataFrame([(i, *d) for i, (d, _) in enumerate(rows)], "i int, m int, d int, y int")
    got = df.orderBy("i").select(V.dob_reason(F.col("m"), F.col("d"), F.col("y"))).collect()
    assert [r[0] for r in got] == [w for _, w in rows]


def test_detectors(spark):
    texts = ["a.b@c.org x..y@d.com .z@e.fr", "call (212) 555-0100 or +1 212-555-0100x, 12125550100", "MRN: AB12345 and Passport No: A1234567", None]
    assert column(spark, texts, lambda c: detectors.hits(c, "email"))[0] == ["a.b@c.org", "y@d.com", "z@e.fr"]
    assert column(spark, texts, lambda c: detectors.hits(c, "phone"))[1] == ["(212) 555-0100", "+1 212-555-0100"]
    assert column(spark, texts, lambda c: detectors.hits(c, "mrn"))[2:] == [["MRN: AB12345"], []]
    found = detectors.scan(spark.createDataFrame([(1, texts[2])], "id int, text string"), kinds=("mrn", "passport")).collect()
    assert [(r.kind, r.value) for r in found] == [("mrn", "MRN: AB12345"), ("passport", "A1234567")]
    assert column(spark, ["123456789", "12"], detectors.masked) == ["*****6789", "12"]


def test_normalisers(spark):
    raw = ["ﬁle Ａ", "PLAIN", "İ", None]
    assert column(spark, raw, text.nfkc_lower) == [text.nfkc_lower_text(r) if r else None for r in raw]
    assert column(spark, ["  A \t b ", "Straße  X"], text.norm_text) == ["a b", "strasse x"]
    assert column(spark, ["10-58", "10-23", "23", "x"], text.digit_stratum) == ["all", "some", "none", "no_digits"]
    pairs = [("abc", "abc", True), ("abc", "xxabcx", True), ("abc", "xxxabc", False), ("", "ab", False), ("abc", "abcxxx", False)]
    df = spark.createDataFrame(pairs, "a string, b string, want boolean")
    assert all(r[0] == r[1] for r in df.select("want", text.end_slack_match(F.col("a"), F.col("b"))).collect())


#: Public MurmurHash3_x64_128 results at seed 0.
GOLDEN = {b"": (0, 0), b"a": (9607679276477937801, 16624257681780017498), b"ab": (10631611042442844974, 16599888901876929709), b"abc": (13012657714217449575, 4297124817637354834)}


def test_murmur3():
    h1, h2 = bloom.murmur3(list(GOLDEN), 0)
    assert list(zip(h1.tolist(), h2.tolist())) == list(GOLDEN.values())
    keys = [bytes(range(n % 256)) * (n // 40 + 1) for n in range(80)]
    whole, alone = bloom.murmur3(keys, 42), [bloom.murmur3([k], 42) for k in keys]
    assert whole[0].tolist() == [int(a[0][0]) for a in alone] and whole[1].tolist() == [int(a[1][0]) for a in alone]


def test_bloom_filter(spark):
    names = spark.createDataFrame([(f"name{i}",) for i in range(3000)], "name string")
    built = bloom.build(names, "name")
    assert built.m == bloom.optimal_bits(3000) and built.contains([f"name{i}".encode() for i in range(3000)]).all()
    assert built.contains([f"other{i}".encode() for i in range(20_000)]).mean() < 0.005
    plain = np.zeros(built.m // 8, np.uint8)
    for p in bloom.positions([f"name{i}".encode() for i in range(3000)], built.m, built.k, built.seed).ravel():
        plain[p // 8] |= 1 << (p % 8)
    assert plain.tobytes() == built.bits
    back, digest = bloom.unpack(bloom.pack(built, b"d" * 32))
    assert back == built and digest == b"d" * 32
    with pytest.raises(ValueError):
        bloom.unpack(bloom.pack(built, b"d" * 32)[:-1])
    rows = spark.createDataFrame([("name1",), (None,), ("zz",)], "name string")
    assert [r.hit for r in bloom.probe(rows, "name", built).collect()] == [True, False, False]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(st.tuples(st.sampled_from("abcdef"), st.sampled_from("xyz")), max_size=15), min_size=1, max_size=5))
def test_first_and_last_win(spark, specs):
    frames = [spark.createDataFrame([(k, s, i) for i, (k, s) in enumerate(rows)], "key string, source string, row_ord int") for rows in specs]
    union = merge.concat_specs(frames)
    first, last = {}, {}
    for rows in specs:
        for k, s in rows:
            first.setdefault(k, s)
            last[k] = s
    assert {r.key: r.source for r in merge.first_wins(union, "key", ["source"], ["spec_ord", "row_ord"]).collect()} == first
    assert {r.key: r.source for r in merge.last_wins(union, "key", ["source"], ["spec_ord", "row_ord"]).collect()} == last


def test_tables(spark):
    df = spark.createDataFrame([("a", "x", 0), ("a", "y", 0), ("b", "x", 3), ("b", "y", 1)], "k string, p string, area long")
    assert {(r.k, r.p): r.share for r in gazetteer.area_share(df, "k", "p", "area").collect()} == {("a", "x"): 0.5, ("a", "y"): 0.5, ("b", "x"): 0.75, ("b", "y"): 0.25}
    assert column(spark, ["acme, inc.", "first bank, n.a.", "plain"], gazetteer.aliases) == [["acme"], ["first bank"], []]
    runs = spark.createDataFrame([(i, k) for i, k in enumerate("aabba")], "o int, k string")
    assert [(r.k, r.runs) for r in merge.broken_runs(runs, "k", "o").collect()] == [("a", 2)]
    digest = merge.keys_digest(runs, "k").first()
    import hashlib

    assert digest.digest == hashlib.sha256(b"a\nb").hexdigest() and merge.tree_digest(runs, "k").first().digest


def test_joins_of_spans(spark):
    rng = random.Random(1)
    left = [("d", i, a := rng.randrange(500), a + rng.randrange(1, 90)) for i in range(60)]
    right = [("d", i, a := rng.randrange(500), a + rng.randrange(1, 90)) for i in range(60)]
    met = spans.overlap_join(spark.createDataFrame(left, "k string, l_id int, l0 int, l1 int"), spark.createDataFrame(right, "k string, r_id int, r0 int, r1 int"), "k", 50)
    want = sorted((i, j) for _, i, a, b in left for _, j, c, d in right if a < d and c < b)
    assert sorted((r.l_id, r.r_id) for r in met.collect()) == want
    toks = column(spark, ["  ab c\nd", ""], spans.token_spans)
    assert [(t.token, t.start, t.end) for t in toks[0]] == [("ab", 2, 4), ("c", 5, 6), ("d", 7, 8)] and toks[1] == []
    occ = spark.createDataFrame([(1, 1, 0.0, 0.0, 10.0, 10.0)], "page int, occ_id int, gx double, gy double, gw double, gh double")
    hits = spark.createDataFrame([(1, 1, "a", 0.0, 0.0, 10.0, 6.0), (1, 2, "b", 0.0, 0.0, 5.0, 10.0), (1, 3, "b", 4.0, 0.0, 4.0, 10.0)], "page int, hit_id int, category string, hx double, hy double, hw double, hh double")
    single, unions = spans.best_cover(occ, hits), spans.union_cover(occ, hits)
    assert (single.first().cover, single.first().category) == (0.6, "a")
    assert {r.category: round(r.cover, 9) for r in unions.collect()} == {"a": 0.6, "b": 0.8}
    assert (c := spans.credited(single, unions).first()).category == "b" and c.by_union


def test_metrics_and_verdicts(spark):
    rows = spark.createDataFrame([("x", True, True)] * 8 + [("x", False, True)] * 2 + [("y", True, False)], "a string, t boolean, p boolean")
    got = {(r.level, r.a): r for r in evaluation.metrics(evaluation.roll_up(evaluation.outcomes(rows, "t", "p"), ["a"], ["tp", "fp", "fn", "tn"])).collect()}
    assert got["total", "*"].precision == 0.8 and round(got["total", "*"].recall, 4) == 0.8889 and got["cell", "y"].recall == 0.0 and got["cell", "y"].low_confidence
    judged = spark.createDataFrame([("mrn", 0.9, 0.8, 0.1, 0.1, 0.9, 0.9), ("phone", 0.5, 0.6, 0.5, 0.3, 0.9, 0.895), ("ein", 0.9, 0.9, 0.0, 0.1, 0.9, 0.9)], "f string, before_precision double, after_precision double, before_fpr double, after_fpr double, before_recall double, after_recall double")
    out = {r.f: (r.regression, r.win, r.failed) for r in evaluation.verdict(evaluation.clauses(judged), "f").collect()}
    assert out == {"mrn": (False, True, ""), "phone": (False, True, ""), "ein": (True, False, "C2")}


@pytest.mark.parametrize("n", [1, 2, 7, 20])
def test_nearest_rank(spark, n):
    values = [float(x) for x in random.Random(n).sample(range(100), n)]
    row = spark.createDataFrame([(v,) for v in values], "v double").agg(*evaluation.percentiles("v")).first()
    import math

    assert list(row) == [sorted(values)[min(max(math.ceil(p / 100 * n), 1), n) - 1] for p in evaluation.PERCENTILES]


def test_calibration():
    rng = np.random.default_rng(0)
    x, y = rng.standard_normal((200, 3)), (rng.random(200) < 0.4).astype(float)
    w = calibration.newton_logistic(x, y, 1.0)
    grad = np.hstack([x, np.ones((200, 1))]).T @ (1 / (1 + np.exp(-(x @ w[:-1] + w[-1]))) - y) + np.append(w[:-1], 0)
    assert np.abs(grad).max() < 1e-6
    separable = calibration.newton_logistic(np.array([[-2.0], [-1.0], [1.0], [2.0]]), np.array([0.0, 0.0, 1.0, 1.0]), 0.5)
    assert np.isfinite(separable).all() and separable[0] > 0


#: Hand-computed feature vectors.
CASES = [
    ("Account: 1234567890", 9, 10, ["account"], [], "financial", [1.0, 0.0, 1 / 1.2, 0.0, 10.0, 0.0, 1.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0]),
    ("Case No: 5551234567 filed", 9, 10, ["phone"], ["case no"], "generic", [0.0, 1.0, 0.0, 1 / 1.2, 10.0, 0.0, 1.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0]),
    ("Patient chart\nMR-9988776", 14, 10, ["chart"], [], "medical", [1.0, 0.0, 1 / 1.1, 0.0, 7.0, 1.0, 0.0, 1.0, 0.0, 1.0, 0.0, 0.0, 0.0]),
    ("Tel\n 5551234567", 5, 10, ["tel"], [], "generic", [1.0, 0.0, 1 / 1.2, 0.0, 10.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 0.0, 1.0]),
    ("Acct: \U000104371234567890", 8, 10, ["acct"], [], "court", [1.0, 0.0, 1 / 1.4, 0.0, 10.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 0.0]),
]


@pytest.mark.parametrize("case", CASES)
def test_context_features(case):
    assert context.features(*case[:6]) == pytest.approx(case[6])


@pytest.mark.parametrize("profile", corpus.PROFILES)
def test_generated_corpus(spark, profile):
    planned = corpus.plan(spark, {"court": 12, "foia": 9, "financial": 12, "medical": 5, "generic": 5})
    docs = corpus.corpus(planned, profile).cache()
    assert corpus.assembly_violations(docs).count() == 0
    again = corpus.corpus(planned.repartition(3), profile)
    assert docs.exceptAll(again).count() == 0 and docs.count() == 43
    rows = {r.id: r for r in docs.collect()}
    plain = {r.id: r for r in corpus.corpus(planned).collect()}
    assert {r.template for r in rows.values()} == set(corpus.TEMPLATES)
    for i, r in rows.items():  # a profile moves names, and addresses under G, and nothing else
        moved = {"name"} | ({"address"} if "G" in corpus.PROFILES[profile] else set())
        assert [(s.category, s.value) for s in r.pii_spans if s.category not in moved] == [(s.category, s.value) for s in plain[i].pii_spans if s.category not in moved]
        assert bool(r.furniture) == ("D" in corpus.PROFILES[profile])
        assert {s.tier for s in r.pii_spans if s.expected_outcome == "suppress"} <= {"must_not"}
        assert ("[REDACTED]" in r.text) <= ("H" not in corpus.PROFILES[profile])
    if "A" in corpus.PROFILES[profile]:
        assert len({s.form for r in rows.values() for s in r.pii_spans if s.category == "name"}) > 2


def test_assembly_rules_are_checked(spark):
    span = lambda a, b, v: (("x", a, b, v, "must", "redact", "none", None, None))
    good = [span(i, i + 1, "abcdefgh"[i]) for i in range(5)]
    rows = [("ok", "abcdefgh", good, [(6, 8, "label")], ["decoy"]), ("few", "abcdefgh", good[:2], [], []), ("over", "abcdefgh", [*good, span(4, 6, "ef")], [], []), ("read", "abcdefgh", [*good, span(6, 7, "x")], [], []), ("tag", "abcdefgh", good, [], ["odd"]), ("out", "abcdefgh", good, [(7, 9, "label")], []), ("on", "abcdefgh", good, [(4, 6, "label")], [])]
    docs = spark.createDataFrame(rows, f"id string, text string, pii_spans {corpus.SPAN_TYPE}, furniture {corpus.FURNITURE_TYPE}, tags array<string>")
    assert sorted(map(tuple, corpus.assembly_violations(docs).collect())) == [("few", "count"), ("on", "furniture_on_span"), ("out", "furniture"), ("over", "overlap"), ("read", "value"), ("tag", "tag")]


def test_values_and_bootstrap(spark):
    from sievemark.plans import QUERIES

    judged = QUERIES["vector_families"](spark, "").collect()
    assert {r.family for r in judged} == set(values.VECTORS) and len(values.VECTORS) == 15
    assert [r for r in judged if r.n != r.n_alike] == []
    assert len(values.FAMILIES) == 17
    for n in (1, 5, 7, 1000, 65_536):
        rng = random.Random(9)
        assert np.concatenate(list(generate.draws(n, 500, 9))).tolist() == [rng.randrange(n) for _ in range(500)]
    assert generate.bca_interval([(1, 0, 0)]) is None
    docs = [(3, 1, 0), (1, 1, 1), (5, 0, 2), (2, 2, 2)]
    rng, f1 = random.Random(generate.SEED), lambda xs: 2 * sum(x[0] for x in xs) / (2 * sum(x[0] for x in xs) + sum(x[1] + x[2] for x in xs))
    drawn = sorted(f1([docs[rng.randrange(4)] for _ in range(4)]) for _ in range(generate.RESAMPLES))
    assert np.allclose(np.sort(generate.f1_of_sums(generate.resampled_sums(np.array(docs, float), generate.RESAMPLES, generate.SEED))), drawn)
    low, high = generate.bca_interval(docs)
    assert drawn[0] <= low < f1(docs) < high <= drawn[-1]
    names = {f: values.name_form(("Ada", "Q", "Elm"), f, "Jr.") for f in values.FORMS}
    assert names == {"full": "Ada Elm", "initial": "Ada Q. Elm", "last_first": "Elm, Ada", "all_caps": "ADA ELM", "suffix": "Ada Elm Jr.", "particled": "Ada Jr. Elm"}
    with pytest.raises(ValueError, match="at least 0"):
        corpus.plan(spark, seed=-1)
    source = b"%PDF-1.4\n/Length 5\nxref\n0000000009 00000 n \nstartxref\n20\n"
    made = {r.id: bytes(r.content) for r in hostile.mutations(spark, source, 3, 16).collect()}
    assert len(made) == 16 and {i.rsplit("_", 1)[0] for i in made} == set(hostile.KINDS) and source not in made.values()
    assert made == {r.id: bytes(r.content) for r in hostile.mutations(spark, source, 3, 16).repartition(5).collect()}
    with pytest.raises(ValueError, match="PDF"):
        hostile.mutations(spark, b"no", 3)
    assert {r.category for r in hostile.adversarial(spark).collect()} == set(hostile.PATTERN_KINDS)


def test_fits_in_passes_equal_fits_in_memory(spark):
    rng = np.random.default_rng(3)
    z = rng.standard_normal((400, 5)) * 3
    y = np.array([rng.choice(5, p=np.exp(r / 2.0 - (r / 2.0).max()) / np.exp(r / 2.0 - (r / 2.0).max()).sum()) for r in z])
    rows = spark.createDataFrame([("a" if i % 2 else "b", v.tolist(), int(k)) for i, (v, k) in enumerate(zip(z, y))], "part string, logits array<double>, label int").repartition(5)
    got = {r.part: r for r in calibration.fit_temperature(rows, "logits", "label", "part").collect()}
    for part, i in (("b", 0), ("a", 1)):
        grid = np.linspace(0.5, 6, 20_001)
        best = grid[calibration.losses(z[i::2], y[i::2], grid).argmin()]
        assert abs(got[part].temperature - best) < 5e-4 and got[part].n == 200 and got[part].nll_after <= got[part].nll_before
    x = rng.standard_normal((500, 3)) * [1, 5, 0.1] + [0, 2, 1]
    hit = (rng.random(500) < 1 / (1 + np.exp(-x[:, 0]))).astype(int)
    rows = spark.createDataFrame([("one" if i < 20 else "f", v.tolist(), 1 if i < 20 else int(h), i) for i, (v, h) in enumerate(zip(x, hit))], "family string, features array<double>, label int, event_id long").repartition(4)
    fits = {r.family: r for r in calibration.fit_scorers(rows, "family", "features", "label", "event_id", seed=5).collect()}
    assert (fits["one"].w_family, fits["one"].weights) == (0.0, [0.0] * 3)
    own, labels = x[20:], hit[20:].astype(float)
    std = (own - own.mean(0)) / own.std(0)
    fold = (np.arange(480) * 2654435761 + 5) % calibration.FOLDS
    lost = {l2: sum(calibration.logistic_loss(std[fold == k], labels[fold == k], calibration.newton_logistic(std[fold != k], labels[fold != k], l2)) for k in range(5)) for l2 in calibration.L2_GRID}
    l2 = min(lost, key=lambda v: (lost[v], -v))
    assert fits["f"].l2 == l2 and fits["f"].w_family == 1.0 and fits["f"].n == 480
    assert np.allclose([*fits["f"].weights, fits["f"].bias], calibration.newton_logistic(std, labels, l2), atol=1e-7)
    assert calibration.fit_scorers(rows, "family", "features", "label", "event_id", promote=("phone",)).where("w_family > 0").count() == 0


@pytest.mark.parametrize("range_rows", [500, 10_000])
def test_walks_and_ranges_at_size(spark, monkeypatch, range_rows):
    monkeypatch.setattr(ordered, "RANGE_ROWS", range_rows)
    placed = ordered.in_ranges(spark.range(20_000).select("id", (F.col("id") % 7).alias("m"), F.when(F.col("id") % 1000 != 0, F.concat(F.lit("k"), F.col("id") % 5000)).alias("s")), ["s", "m"])
    ends = placed.groupBy("_range").agg(F.min(F.struct("s", "m")).alias("a"), F.max(F.struct("s", "m")).alias("b"), F.count("*").alias("n")).orderBy("_range").collect()
    assert all((x.b.s or "", x.b.m) < (y.a.s or "", y.a.m) for x, y in zip(ends, ends[1:])) and (len(ends) > 20) == (range_rows == 500) and max(r.n for r in ends) < 8 * range_rows
    nodes = spark.range(1, 200_001).select("id", F.floor(F.col("id") / 2).alias("up"))
    got = gazetteer.roots(nodes, "id", "up")
    assert got.agg(F.max("root"), F.max("depth"), F.count("*")).first()[:] == (0, 17, 200_000)
    loop = spark.createDataFrame([(1, 2), (2, 1), (3, 9), (4, None)], "c int, p int")
    assert {r.node: (r.root, r.depth) for r in gazetteer.roots(loop, "c", "p").collect()} == {1: (2, 32), 2: (1, 32), 3: (9, 0), 4: (None, 0)}
    keys = spark.range(30_000).select(F.sha1(F.col("id").cast("string").cast("binary")).alias("k"))
    placed = integrity.shard_of(keys, "k", 1_000, 100).orderBy("k").collect()
    assert [r.shard for r in placed] == [i // 1_000 for i in range(30_000)]
    plan = integrity.shard_of(keys, "k", 1_000, 100)._jdf.queryExecution().optimizedPlan().toString()
    assert all("_range" in line for line in plan.splitlines() if "Window [" in line)
    rows = spark.range(20_000).select((F.floor(F.col("id") / 100) % 150).alias("k"), "id")
    assert sorted(r.k for r in merge.broken_runs(rows, "k", "id").collect()) == list(range(50))
    import hashlib

    want = hashlib.sha256("\n".join(sorted(hashlib.sha1(str(i).encode()).hexdigest() for i in range(30_000))).encode()).hexdigest()
    assert merge.keys_digest(keys, "k").first()[:] == (want, 30_000)


def test_integrity(spark):
    placed = integrity.shard_of(spark.createDataFrame([(k,) for k in (1, 1, 1, 2, 5000, 5000, 9000)], "k long"), "k", 3, 8)
    assert {r.k: r.shard for r in placed.collect()} == {1: 0, 2: 1, 5000: 1, 9000: 2}
    rows = spark.createDataFrame([("A", 1), ("B", 2)], "k string, v int")
    assert integrity.fingerprint(rows, ["k", "v"]).first() == integrity.fingerprint(rows.orderBy(F.desc("k")), ["k", "v"]).first()
    df = spark.createDataFrame([("MIT AND CPT", True), ("CC-BY-4.0", False), ("CC-BY-4.0", True), ("X", True)], "l string, r boolean")
    assert [r[0] for r in df.select(integrity.license_verdict(F.col("l"), F.col("r"))).collect()] == [["forbidden"], ["gated"], [], ["unknown"]]


def test_readers_and_sinks(spark, tmp_path):
    (tmp_path / "ssa.csv").write_text("#head\nAnna,F,10\n\nBo,M,3\n")
    assert [r.key for r in readers.given_names(spark, str(tmp_path / "ssa.csv"), "ssa").orderBy("row_ord").collect()] == ["anna", "bo"]
    (tmp_path / "census.csv").write_text("name,pctwhite,pctblack,pctapi,pctaian,pcthispanic\nGARCIA,5.0,1,1,(S),92\nX,30,30,20,10,10\n")
    assert [(r.key, r.demographic) for r in readers.census_surnames(spark, str(tmp_path / "census.csv"), "c").orderBy("row_ord").collect()] == [("garcia", "hispanic"), ("x", "unlabeled")]
    names = ["wikidata_id\teng\tlabel\tlanguage\ttype"] + [f"Q1\tA\tAda {i % 2}\tl{i}\tPER" for i in range(5)] + ["Q2\tB\tBo\tl1\tPER", "Q3\tC\tC\tl1\tLOC"]
    (tmp_path / "para.tsv").write_text("\n".join(names) + "\n")
    assert sorted(r.label for r in readers.multilingual_names(spark, str(tmp_path / "para.tsv")).collect()) == ["ada 0", "ada 1"]
    (tmp_path / "fdic.csv").write_text('NAME,CERT,CITY,STNAME,ACTIVE\n"First Bank, N.A.",1,X,Ohio,1\nOld,2,Y,Ohio,0\nFar,3,Z,Nowhere,1\n')
    known, unknown = readers.active_banks(spark, str(tmp_path / "fdic.csv"), {"Ohio": "OH"})
    assert [tuple(r) for r in known.collect()] == [("first bank, n.a.", "OH")] and [r.NAME for r in unknown.collect()] == ["Far"]
    (tmp_path / "edgar.json").write_text('{"1": {"cik_str": 7, "ticker": "B", "title": "Bee"}, "0": {"cik_str": 5, "ticker": "A", "title": "Aye"}}')
    assert [r.title for r in readers.listed_companies(spark, str(tmp_path / "edgar.json"), 1).collect()] == ["Aye"]
    (tmp_path / "nick.csv").write_text("albert, Al ,bert,al\n")
    assert sorted(r.alias for r in readers.nicknames(spark, str(tmp_path / "nick.csv")).collect()) == ["al", "bert"]
    (tmp_path / "zip.csv").write_text("ZIP,STATE,RES_RATIO,BUS_RATIO,OTH_RATIO,TOT_RATIO\n00501,ny,1.0,0,0,1\n123,NY,0.5,0,0,1\n")
    good, bad = readers.zip_ratios(spark, str(tmp_path / "zip.csv"))
    assert [(r.ZIP, r.STATE) for r in good.collect()] == [("00501", "NY")] and bad.count() == 1
    (tmp_path / "led.md").write_text("# t\n| a/b.csv | MIT | http://x | 2024-01-02 | " + "a" * 64 + " | some file |\n| no | row |\n")
    assert [(r.rel_path, r.license, r.retrieved) for r in readers.ledger(spark, str(tmp_path / "led.md")).collect()] == [("a/b.csv", "MIT", "2024-01-02")]
    rows = spark.createDataFrame([("b", "1" * 64), ("a", "2" * 64)], "rel_path string, sha256 string")
    sinks.replace_file(tmp_path / "lock", sinks.lock_text(rows).encode())
    assert sorted(r.rel_path for r in readers.hash_lines(spark, str(tmp_path / "lock")).collect()) == ["a", "b"]
    assert sinks.canonical_json({"b": 1, "a": "é"}) == '{\n  "a": "é",\n  "b": 1\n}\n'.encode()
    with pytest.raises(ValueError, match="not fetched"):
        readers.refuse_pointer(spark, str(tmp_path / "lock"))
    table = struct.pack("<B3xIHH20x", 3, 3, 32 + 64 + 1, 1 + 4 + 6) + b"ID".ljust(11, b"\0") + b"C" + b"\0" * 4 + bytes([4]) + b"\0" * 15 + b"NAME".ljust(11, b"\0") + b"C" + b"\0" * 4 + bytes([6]) + b"\0" * 15 + b"\r"
    table += b" 0001Akron " + b"*0002Bath  " + b" 0003Caf\xe9  "
    with zipfile.ZipFile(tmp_path / "t.zip", "w") as z:
        z.writestr("x/places.dbf", table)
        z.writestr("app_c.csv", "﻿name\nPEREZ\n")
    assert sorted(r.name for r in readers.dbase_names(spark, str(tmp_path / "t.zip")).collect()) == ["Akron", "Café"]
    assert [r.line for r in readers.zipped_lines(spark, str(tmp_path / "t.zip"), "app_c.csv").orderBy("line_no").collect()] == ["name", "PEREZ"]


def test_stream_of_detections(spark, tmp_path):
    from sievemark.streaming.detect import detect_stream

    spark.createDataFrame([(1, "mail a@b.org")], "id int, text string").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("id int, text string").parquet(f"{tmp_path}/in")
    detect_stream(stream, f"{tmp_path}/out", f"{tmp_path}/ck").awaitTermination(60)
    assert [(r.kind, r.value) for r in spark.read.parquet(f"{tmp_path}/out").collect()] == [("email", "***.org"[:3] + ".org")]


def test_context_features_at_each_match(spark, tmp_path):
    from sievemark.plans import QUERIES

    number = "415-555-0123"
    texts = [f"Call {number} now\nand again:\n{number} invoice {number}", f"9{number} then tel: {number}", f"\U0001f600\U0001f600 phone: {number}\n{number}", "none", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    at = {0: [5, 33, 54], 1: [24], 2: [12, 25]}
    words = (["phone", "tel", "call", "the"], ["case no", "invoice"])
    want = sorted((i, "phone", context.features(texts[i], s, len(number), *words, "generic")) for i, starts in at.items() for s in starts)
    assert all(context.units(texts[i])[s : s + len(number)] == number for i, starts in at.items() for s in starts)
    assert sorted((r.id, r.family, r.features) for r in QUERIES["context_features"](spark, str(tmp_path)).collect()) == want


def test_violations_fail_loud(spark):
    rows = spark.createDataFrame([(f"d{i}", i, i + 2, "ssn", "must", "tp", [(i, i + 1)]) for i in range(30)], "doc_id string, start int, end int, family string, tier string, outcome string, det_spans array<struct<start:int,end:int>>")
    docs = rows.select("doc_id", F.lit("court").alias("doctype"), F.lit("white").alias("bucket"))
    spans_ = rows.select("doc_id", "start", "end", "family", "tier", F.array(F.struct(F.col("start"), F.col("end"))).alias("tokens"), F.lit(None).cast("string").alias("context_class"))
    tally.fail_on(tally.truth_violations(tally.join_truth(rows, docs, spans_)), "sidecar")
    with pytest.raises(ValueError, match="sidecar: .*no_span") as error:
        tally.fail_on(tally.truth_violations(tally.join_truth(rows, docs, spans_.where("start < 5"))), "sidecar")
    assert str(error.value).count("no_span") == tally.SHOWN
    assert tally.cell_tallies(tally.join_truth(rows, docs, spans_)).first().one_token_tp == 0
    none = spark.createDataFrame([], "doc_id string, start int, end int, kind string")
    spurious = rows.withColumns({"tier": F.lit(None).cast("string"), "outcome": F.lit("fp")})
    joined = tally.join_truth(spurious, docs, spans_)
    assert tally.furniture_counts(joined, none).collect() == []
    some = spark.createDataFrame([("d3", 0, 9, "label"), ("d3", 4, 9, "label")], none.schema)
    assert {r.kind: r.n for r in tally.furniture_counts(joined, some).collect()} == {"label": 1, "unattributed": 29}


def test_documents_by_hand(spark):
    box = lambda x, y, w, h: (float(x), float(y), float(w), float(h))
    kind = "struct<x:double,y:double,w:double,h:double>"
    occ = spark.createDataFrame([(1, 1, "dob", box(0, 0, 10, 10), None), (1, 2, "phone", box(20, 0, 10, 10), [box(20, 0, 4, 10), box(26, 0, 4, 10)]), (1, 3, "phone", None, None), (1, 4, "name", box(40, 0, 10, 10), [box(40, 0, 4, 10), None])], f"page int, occ_id int, category string, box {kind}, spans array<{kind}>")
    hit = lambda i, c, x, y, w, h: (1, i, c, f"t{i}", *box(x, y, w, h))
    rows = [hit(1, "phone", 0, 0, 6, 10), hit(2, "dateOfBirth", 0, 0, 5, 10), hit(3, "dateOfBirth", 5, 0, 5, 10), hit(4, "phone", 20, 0, 4, 10), hit(5, "phone", 26, 0, 4, 10), hit(6, "name", 40, 0, 4, 10)]
    hits = spark.createDataFrame(rows, "page int, hit_id int, category string, text string, hx double, hy double, hw double, hh double")
    got = {r.occ_id: r for r in documents.verdicts(occ, hits, ["page"], 16.0).collect()}
    one = got[1]  # two halves of a date beat the larger phone
    assert (one.cover_category, one.cover_text, one.cover_fraction, one.cover_detections, one.strict) == ("dateOfBirth", "t2", 1.0, 2, True)
    assert documents.verdicts(occ, hits, ["page"], 16.0, "single").where("occ_id = 1").first().cover_category == "phone"
    assert (got[2].covered, got[2].iou_matched, got[2].cover_fraction) == (True, True, 1.0)  # every span is covered
    assert (got[3].covered, got[3].cover_detections, got[3].cover_category) == (False, 0, None)
    assert (got[4].covered, got[4].cover_fraction) == (False, 0.4)  # a span without a box earns nothing
    with pytest.raises(ValueError, match="rule"):
        documents.verdicts(occ, hits, ["page"], 16.0, "other")
    legs = spark.createDataFrame([("natural", ["rich"]), ("natural", ["poor"]), ("natural", ["rich", "poor"]), ("natural", None), ("ocr-forced", ["rich"])], "leg string, s array<string>")
    assert [r[0] for r in legs.select(documents.leg_kind(F.col("leg"), F.col("s"))).collect()] == ["text", "ocr", "mixed", "ocr", "ocr-forced"]
    order = spark.createDataFrame([("b", "text"), ("a", "zz"), ("a", "mixed"), ("a", "text")], "document string, leg string")
    assert [tuple(r) for r in documents.report_order(order).collect()] == [("a", "text"), ("a", "mixed"), ("a", "zz"), ("b", "text")]


def test_closed_lists_fail_on_strangers(spark):
    one = spark.createDataFrame([(["x"],)], "n array<string>")
    with pytest.raises(Exception, match="no such name"):
        one.select(gazetteer.translated(F.col("n"), {"y": "z"})).collect()
    with pytest.raises(ValueError, match="prior mode"):
        calibration.composed(F.lit(0.5), F.lit(0.5), "other")
    assert spark.range(1).select(calibration.composed(F.lit(2.0), F.lit(0.5), "corpus", F.lit(True))).first()[0] == 1.0
