import hashlib
import random
import re

from sievemark.llm import pii


def brute(text):
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 14 <= len(d) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return sorted(out, key=lambda r: (r[1], pii.KINDS.index(r[0])))


def base(text):
    return [(r["kind"], r["start"], r["end"]) for r in pii.spans(text) if r["base"]]


def test_base_kinds_equal_brute_force():
    rng = random.Random(3)
    for _ in range(20_000):
        letters = rng.choice(["a.@-%1", "0123.", "1 -+().23", "a@b.c1 ", "+1234567890 ()-.", "4 -0123456789é🙂"])
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))
        assert base(text) == brute(text), text


def test_time_is_linear_in_endless_words():
    for text in ("a" * 10**6, "1" * 10**6, "1." * 300_000, "a@" * 300_000, "+1" * 300_000, "a@b" + ".c" * 300_000 + "@"):
        pii.spans(text)


def test_added_kinds_need_their_check_or_context():
    assert [s["kind"] for s in pii.spans("pay to DE89 3704 0044 0532 0130 00 now")] == ["iban"]
    assert pii.spans("code DE88 3704 0044 0532 0130 00 now") == []
    assert [s["kind"] for s in pii.spans("his SSN is 123-45-6789.")] == ["ssn"]
    assert pii.spans("part 123-45-6789 in stock") == []
    near, far = pii.spans("card 4111111111111111")[0], pii.spans("x 4111111111111111")[0]
    assert near["score"] > far["score"] >= pii.THRESHOLD


def test_detect_and_redact(spark):
    rows = [(1, "mail a.b@c.org or +1 (743) 555-3824, é 4111 1111 1111 1111", "x"), (2, None, "y"), (3, "", "z"), (3, "", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    got = {r.doc_id: r for r in pii.detect(df, redact_to="clean").collect()}
    assert got[1].clean == "mail <EMAIL> or <PHONE>, é <CARD>" and got[2].clean is None and got[3].clean == ""
    out = pii.digest_columns(pii.detect(df)).collect()
    text = rows[0][1]
    want = ",".join(f"{k}:{s}:{e}" for k, s, e in brute(text))
    one = next(r for r in out if r.doc_id == 1)
    assert (one.n_email, one.n_ip, one.n_card, one.n_phone) == (1, 0, 1, 1)
    assert one.base_sha256 == hashlib.sha256(want.encode()).hexdigest() and one.spans == want
    assert sum(r.doc_id == 3 and r.spans == "" for r in out) == 2
