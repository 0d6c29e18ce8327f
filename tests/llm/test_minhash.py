import random
import re

import numpy as np
import pytest

from sievemark.llm import minhash, words

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def brute_sets(texts, n):
    out = []
    for t in texts:
        w = WORD.findall(re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode()))
        out.append({tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set())
    return out


def brute_components(ids, sets, percent):
    label = dict(zip(ids, ids))
    changed = True
    pairs = [(a, b) for i, a in enumerate(ids) for j, b in enumerate(ids) if i < j and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    while changed:
        changed = False
        for a, b in pairs:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


def near_copies(rng, base, n, most):
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randint(0, most)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def check(spark, rows, n, percent):
    got = {r.id: r for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=n, percent=percent).collect()}
    sets = brute_sets([t for _, t in rows], n)
    want = brute_components([i for i, _ in rows], sets, percent)
    assert {i: r.component_id for i, r in got.items()} == want
    assert {i: r.n_shingles for i, r in got.items()} == {i: len(s) for (i, _), s in zip(rows, sets)}
    assert all(r.kept == (r.component_id == i) for i, r in got.items())


def test_groups_larger_than_a_tile_key(spark):
    rng = random.Random(5)
    base = [f"w{rng.randrange(400)}" for _ in range(120)]
    texts = near_copies(rng, base, 260, 9) + [" ".join(f"v{rng.randrange(500)}" for _ in range(60)) for _ in range(60)]
    ids = rng.sample(range(10_000), len(texts))
    check(spark, list(zip(ids, texts)), 3, 85)


def test_chains_and_small_texts(spark):
    rng = random.Random(6)
    texts = [None, "", " \n\t", "one", "ONE", "one two", "one  two", "two one", "a b c", "A B\tC", "a b c d", "é ü", "É ü"]
    w = [f"c{i}" for i in range(100)]
    for step in range(12):
        w = w[2:] + [f"d{step}a", f"d{step}b"]
        texts.append(" ".join(w))
    texts += near_copies(rng, [f"z{i}" for i in range(60)], 20, 3)
    check(spark, [(i * 7 + 3, t) for i, t in enumerate(texts)], 3, 85)
    check(spark, [(i * 7 + 3, t) for i, t in enumerate(texts)], 5, 80)


def test_repeated_rows_null_ids_and_empty_table(spark):
    rows = [(1, "a b c d"), (1, "a b c d"), (2, "a b c d"), (None, "a b c d"), (None, "q r s t"), (3, None)]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=3, percent=85).collect()
    assert sorted((r.id or 0, r.component_id or 0, r.kept) for r in got) == [(0, 0, True), (0, 1, False), (1, 1, True), (1, 1, True), (2, 1, False), (3, 3, True)]
    empty = spark.createDataFrame([], "doc_id long, text string, id string")
    assert minhash.near_duplicates(empty).collect() == []


def test_word_hashes_are_the_words():
    texts = ["The cat", "the  CAT", " the\x0bcat ", "thecat", "x" * 3_000_000 + " the cat", ""]
    h = [words.word_hashes(t.encode())[0] for t in texts]
    assert (h[0] == h[1]).all() and (h[0] == h[2]).all() and len(h[3]) == 1 and (h[4][1:] == h[0]).all() and len(h[5]) == 0


@pytest.mark.parametrize(("similarity", "width"), [(0.85, 5), (0.8, 3)])
def test_scheme_keeps_its_promise(similarity, width):
    s = minhash.scheme(similarity)
    assert s.width >= width and s.miss(similarity) <= 2e-6 and s.radius == 2 * s.chunks - 1


def test_pairs_within_the_radius_share_a_key(spark):
    s = minhash.scheme(0.85)
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 16, s.slots).astype("<u2")
    rows = [(0, base.tobytes())]
    for i in range(1, 60):
        other = base.copy()
        at = rng.choice(s.slots, s.radius, replace=False)
        other[at] ^= 1
        rows.append((i, other.tobytes()))
    from pyspark.sql import functions as F

    keyed = spark.createDataFrame([(i, bytearray(b)) for i, b in rows], "id long, sig binary").select("id", F.explode(minhash._keys(F.col("sig"), s)).alias("key"))
    first = keyed.where("id = 0").select("key")
    assert keyed.join(first, "key", "left_semi").select("id").distinct().count() == 60
