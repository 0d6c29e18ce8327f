"""Language ID, packing, SentencePiece, token counts."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievemark.llm import language_id, packing, sentence_pieces, token_counts, word_bpe
from sievemark.llm.storage import Workspace

TEXTS = ["Hello, it's 3 o'clock", None, "", " \n", "İstanbul ΑΣ ﬁ ２ ½ a\x1cb c\x85d", "x<|endoftext|>y", "y" * 300 + " 日本語 🙂", "the cat " * 3000]


def docs(spark, texts=TEXTS):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_word_bpe_equals_the_library():
    e = word_bpe.encoder(word_bpe.default_path())
    rng = random.Random(4)
    more = ["".join(rng.choice("ab'st é.,!?1🙂\n\t\x1c\x85\xa0ß|ΣİA<|endoftext|>") for _ in range(rng.randint(1, 60))) for _ in range(800)]
    for text in [t or "" for t in TEXTS] + more:
        assert np.frombuffer(e.encode(text), "<u4").tolist() == e.tokenizer.encode(text, add_special_tokens=False).ids, text


def test_packing_is_whole_and_gapless(spark):
    path, length = word_bpe.default_path(), 64
    rng = random.Random(1)
    texts = TEXTS + [" ".join(rng.choice(["alpha", "beta", "gam"]) for _ in range(rng.randint(0, 90))) for _ in range(300)]
    rows = packing.pack(docs(spark, texts), path, length).collect()
    tok = word_bpe.encoder(path).tokenizer
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    for i, t in enumerate(texts):
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 0]
        pieces = sorted(by_doc[i], key=lambda r: r.piece)
        assert [r.piece for r in pieces] == list(range(-(-len(ids) // length)))
        for r in pieces:
            part = ids[r.start : r.start + r.length]
            assert r.start == r.piece * length and len(part) == min(length, len(ids) - r.start) == r.length
            assert r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
    for held in by_seq.values():
        held.sort(key=lambda r: r.offset)
        assert [r.offset for r in held] == [sum(x.length for x in held[:i]) for i in range(len(held))]
        assert sum(r.length for r in held) <= length
    assert len(by_seq) <= 1.03 * sum(r.length for r in rows) / length + 1


def test_place_follows_the_rule():
    rng = random.Random(2)
    for _ in range(40):
        cap = rng.choice([5, 9, 16])
        items = np.array(sorted((rng.randint(1, cap) for _ in range(40)), reverse=rng.random() < 0.5))
        seq, off = packing.place(items, cap)
        fill = {}
        for s, n, at in zip(items.tolist(), seq.tolist(), off.tolist()):
            level = {}
            for v in fill.values():
                level[v] = level.get(v, 0) + 1
            cost = lambda f: 2 * ((level.get(f + s, 0) if f + s < cap else 0) - level.get(f, 0)) + (1 if f + s == cap else 2)
            fits = [f for f in level if 0 < f <= cap - s]
            assert fill.get(n, 0) == at
            if fits:
                assert at in fits and cost(at) == min(map(cost, fits))
            else:
                assert n not in fill
            fill[n] = at + s


def test_language_of_held_out_texts(spark):
    rng = random.Random(7)
    parts = {"aa": "the of and ing tion", "bb": "der die und sch ung", "cc": "le la de eau ment"}
    rows = [(i, " ".join(rng.choice(parts[lang].split()) for _ in range(rng.randint(3, 40))), lang) for i, lang in enumerate(rng.choice(sorted(parts)) for _ in range(300))]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(df, where=F.col("doc_id") % 3 != 1)
    got = language_id.predict(df, model).where("doc_id % 3 = 1").collect()
    assert len(got) > 50 and np.mean([r.lang == r.lang_pred for r in got]) > 0.97 and all(0 <= r.score <= 1 for r in got)
    odd = [(1, None), (2, ""), (3, "12 !?"), (4, "x"), (5, "der die " * 100_000)]
    out = {r.doc_id: (r.lang_pred, r.score) for r in language_id.predict(spark.createDataFrame(odd, "doc_id long, text string"), model).collect()}
    assert out[1] == out[2] == out[3] == ("und", 0.0) and out[4][0] in parts and out[5][0] == "bb"
    empty = language_id.fit(df.where("false"))
    assert {r.lang_pred for r in language_id.predict(df.limit(3), empty).collect()} == {"und"}


def test_model_scores_equal_brute_force():
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab é\n.") for _ in range(rng.randint(0, 30))) for _ in range(30)]
    logs = np.asfortranarray(np.vstack([np.random.default_rng(1).standard_normal((1 << language_id.BUCKET_BITS, 2)), np.zeros((1, 2))]), np.float32)
    model = language_id.Model(["a", "b"], logs)
    got, _ = model.scores(texts)
    for t, row in zip(texts, got):
        want = np.zeros(2)
        points = np.array([ord(c) for c in f" {t.lower()} "], np.uint32)
        for n in language_id.ORDERS:
            for i in range(len(points) - n + 1):
                want += logs[language_id._buckets(points[i : i + n], n)[0]]
        assert np.allclose(row, want, atol=1e-3)


@pytest.fixture(scope="module")
def pieces():
    import public_tokenizers

    return sentence_pieces.load(public_tokenizers.path("piece_bpe_32k.model"))


def brute_cut(p, keys, low, text):
    m, literal = sentence_pieces.MARK + text.replace(" ", sentence_pieces.MARK), [False] + [c == sentence_pieces.MARK for c in text]
    best, back = [0.0] + [-1e18] * len(m), [None] * (len(m) + 1)
    for e in range(1, len(m) + 1):
        for s in range(e):
            c = None if any(literal[s:e]) else keys.get(m[s:e])
            c = (low, -1) if c is None and e - s == 1 else c
            if c and best[s] + c[0] > best[e]:
                best[e], back[e] = best[s] + c[0], (s, c[1])
    out, at = [], len(m)
    while at:
        s, i = back[at]
        out += [i] if i >= 0 else [int(p.byte_ids[b]) for b in reversed(m[s:at].encode())]
        at = s
    return out[::-1]


def test_sentence_pieces_equal_brute_force(pieces):
    import public_tokenizers
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    keys = {sp.id_to_piece(int(i)): (float(s), int(i)) for i, s in zip(pieces.ids, pieces.scores)}
    low = min(v[0] for v in keys.values()) - sentence_pieces.PENALTY
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choice("the and  ing. éñ🙂\n\t▁ß<0xE2>日 ") for _ in range(rng.randint(1, 30)))
        ids = np.frombuffer(sentence_pieces.encode_texts(pieces, [text])[0], "<i4").tolist()
        assert ids == brute_cut(pieces, keys, low, text) and sentence_pieces.decode_ids(pieces, ids) == text


def test_sentence_pieces_round_trip(spark, pieces):
    df = docs(spark, [*TEXTS, "z" * 5000]).withColumn("ids", F.lit("clash"))
    got = sentence_pieces.decode(sentence_pieces.encode(df, pieces), pieces).collect()
    assert len(got) == len(TEXTS) + 1 and all(r.decoded == r.text for r in got)
    assert got[1].ids is None and got[2].ids == []


def test_token_counts_stitch_blocks(spark):
    path, end = word_bpe.default_path(), 49_407
    work = Workspace(spark, "test")
    folder = work.fresh("files")
    written = work.write(token_counts.write_token_files(docs(spark).repartition(2), folder, path, end), "written")
    tok = word_bpe.WordBpe(path, plain_specials=True).tokenizer
    want = {i: len(tok.encode(t or "", add_special_tokens=False).ids) for i, t in enumerate(TEXTS)}
    for block in (3, 1000, 1 << 20):
        got = written.join(token_counts.count_tokens(spark, folder, end, block=block), ["file", "ordinal"]).collect()
        assert {r.doc_id: r.n_tokens for r in got} == want and all(r.ended for r in got)


@pytest.mark.parametrize("ids", [[], [9], [1, 2], [9, 9, 1, 2, 3, 9, 4], [1, 9, 2, 9], list(range(1, 9)) * 3])
def test_flat_files_equal_a_plain_scan(spark, tmp_path, ids):
    (tmp_path / "a.bin").write_bytes(np.array(ids, "<u2").tobytes())
    want, run = [], 0
    for x in ids:
        want, run = (want + [(run, True)], 0) if x == 9 else (want, run + 1)
    want += [(run, False)] if run else []
    for block in (1, 2, 5):
        got = token_counts.count_tokens(spark, str(tmp_path), 9, block=block).orderBy("ordinal").collect()
        assert [(r.n_tokens, r.ended) for r in got] == want and [r.ordinal for r in got] == list(range(len(want)))
