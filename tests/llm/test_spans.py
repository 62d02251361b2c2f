import hashlib
import random
import re
import time

from vetmill.llm import pii, secrets

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def luhn(hit):
    d = [int(c) for c in hit if c.isdigit()][::-1]
    return sum(x if i % 2 == 0 else x * 2 - 9 * (x > 4) for i, x in enumerate(d)) % 10 == 0


def digits(hit):
    return sum(c.isdigit() for c in hit)


PII = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m[0].split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= digits(m[0]) <= 19 and luhn(m[0])),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= digits(m[0]) <= 15),
}
SECRETS = {"assign": (ASSIGN, lambda m: len(m[2]) >= 6), "access": (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20), "hex": (r"[0-9a-f]+", lambda m: len(m[0]) >= 24)}


def found(kinds, text):
    return [(k, m.start(), m.end()) for k, (p, ok) in kinds.items() for m in re.finditer(p, text or "") if ok(m)]


def sha(spans):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()


PARTS = ["a@b.co", "a@b.c_x@d.ef", "x.y%z@a-b.c.d", "@", "1.2.3.4.5.6.7.8", "300.1.1.1", "255.255.0.1", "0001.2.3.4", "4111 1111 1111 1111", "4111-1111-1111-1112", "4111111111111111 11", "+49 (30) 123-4567",
         "+1", "+1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7", "é😀", " ", "\n", "DE89370400440532013000", "DE89 3704 0044 0532 0130 00", "DE88370400440532013000", "ssn 123-45-6789", "123-45-6789", "word"]
KEYS = ["token=token=abcdefgh", "token: token: abcdef", "PassWord : 'hunter22'", "api_key=abc", "apikey=\"abcdef\"", "secret", "AKIA" + "A" * 16, "AKIA" + "A" * 15, "AKIAAKIA" + "Z9" * 8, "0123456789abcdef01234567",
        "0123456789ABCDEF01234567", "deadbeef" * 2, "passwd:x", "Kapi_key=zzzzzz", "ghp_" + "a" * 36, "xoxb-1234567890", "-----BEGIN RSA PRIVATE KEY-----", "é", "\n", " ", "tokentoken=abcdefg"]


def texts(parts, n):
    rng = random.Random(9)
    return [None, "", *parts, *["".join(rng.choice(parts + [" ", "-", "."]) for _ in range(rng.randint(1, 12))) for _ in range(n)]]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, email string, kind int")


def test_pii_like_brute_force(spark):
    rows = [*enumerate(texts(PARTS, 400)), (7, "again a@b.co"), (None, "a@b.co")]
    got = pii.digest(pii.find(frame(spark, rows))).collect()
    assert len(got) == len(rows)
    want = sorted((repr(i), *[sum(x[0] == k for x in found(PII, t)) for k in PII], sha(found(PII, t))) for i, t in rows)
    assert sorted((repr(r.doc_id), r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got) == want


def test_cards_with_a_mark_after_every_digit(spark):
    cards = [mark.join("4111111111111111") for mark in (" ", "-")]
    got = pii.digest(pii.find(frame(spark, enumerate(cards)))).orderBy("doc_id").collect()
    assert [(r.n_card, r.base_sha256) for r in got] == [(1, sha(found(PII, t))) for t in cards]
    assert {r.text for r in pii.redact(frame(spark, enumerate(cards))).collect()} == {"[CARD]"}


def test_pii_checksums_context_and_redaction(spark):
    rows = [(1, "pay DE89370400440532013000 not DE88370400440532013000"), (2, "my ssn: 123-45-6789"), (3, "part 123-45-6789"), (4, "mail a@b.co, ip 1.2.3.4!"), (5, None)]
    spans = {r.doc_id: r.spans for r in pii.digest(pii.find(frame(spark, rows))).collect()}
    assert spans == {1: "iban:4:26", 2: "ssn:8:19", 3: "", 4: "email:5:11,ip:16:23", 5: ""}
    out = {r.doc_id: r for r in pii.redact(frame(spark, rows).drop("email", "kind")).collect()}
    assert out[4].text == "mail [EMAIL], ip [IP]!" and out[5].text is None and out[3].text == "part 123-45-6789"
    assert pii.digest(pii.find(frame(spark, []))).count() == 0


def test_secrets_like_brute_force(spark):
    rows = [*enumerate(texts(KEYS, 400)), (3, "token=abcdef"), (None, "token=abcdef"), (None, None)]
    got = secrets.digest(secrets.scan(frame(spark, rows))).collect()
    assert len(got) == len(rows)
    order = {k: i for i, k in enumerate(SECRETS)}
    base = lambda t: sorted(found(SECRETS, t), key=lambda x: (x[1], order[x[0]]))
    want = sorted((repr(i), *[sum(x[0] == k for x in base(t)) for k in SECRETS], sha(base(t))) for i, t in rows)
    assert sorted((repr(r.doc_id), r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in got) == want
    one = secrets.digest(secrets.scan(frame(spark, [(1, "x ghp_" + "Z" * 36 + " -----BEGIN RSA PRIVATE KEY-----")]))).first()
    assert one.spans == "github:2:42,private_key:43:74"


def test_tokens_in_three_parts_like_the_plain_rule(spark):
    rng = random.Random(4)
    parts = ["eyJ", "eyJ" + "a" * 10, "eyJ" + "b" * 9, ".", ".", ".", "c" * 10, "-", "_x", " ", "é", "😀", "eyJeyJ" + "d" * 7]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(3, 14)))) for i in range(1000)]
    heads = ["eyJ" + "a" * 10, "eyJ" + "b" * 9, "xeyJ" + "c" * 11, "eyJeyJ" + "d" * 7, "c" * 10]
    rows += [(i, ".".join(rng.choice(heads) for _ in range(rng.randint(3, 9)))) for i in range(1000, 1500)]
    rows += [(-1, "x" + ".".join(["eyJ" + "a" * 10] * 6)), (-2, "é zzeyJ" + "a" * 10 + ".eyJ" + "b" * 10 + "." + "c" * 10 + " eyJ")]
    want = {i: ",".join(f"jwt:{m.start()}:{m.end()}" for m in re.finditer(secrets.RULES["jwt"], t)) for i, t in rows}
    got = secrets.digest(secrets.scan(frame(spark, rows))).collect()
    assert {r.doc_id: ",".join(x for x in r.spans.split(",") if x.startswith("jwt")) for r in got} == want
    assert sum(map(bool, want.values())) > 20


def test_token_heads_without_end_take_linear_time(spark):
    start = time.monotonic()
    rows = [(1, ".eyJ " + "eyJ" * 340_000), (2, ".eyJ " + "eyJ" * 340_000 + "." + "eyJ" * 340_000)]
    assert {r.spans for r in secrets.digest(secrets.scan(frame(spark, rows))).collect()} == {""}
    assert time.monotonic() - start < 60  # hours if each head read on to the end


def test_trigram_queries():
    q = secrets.trigram_query(secrets.ASSIGN)
    assert len(q) == 1 and frozenset({"tok", "oke", "ken"}) in q[0] and frozenset({"api", "pik", "ike", "key"}) in q[0] and len(q[0]) == 18
    assert secrets.trigram_query(r"[0-9a-f]{24,}") == []
    assert secrets.trigram_query(r"AKIA[A-Z]+") == [[frozenset({"aki", "kia"})]]
    assert secrets.trigram_query(r"ab(c|d)e*fgh") == [[frozenset({"abc"}), frozenset({"abd"})], [frozenset({"fgh"})]]


def test_long_texts_stay_linear(spark):
    long = ["a" * 150_000, "1" * 150_000, "a." * 60_000 + "@" + "b." * 60_000, "+1" + " 2" * 60_000, "0f" * 60_000]
    rows = [*enumerate(long)]
    assert pii.digest(pii.find(frame(spark, rows))).count() == len(rows)
    assert {r.doc_id: r.n_hex for r in secrets.digest(secrets.scan(frame(spark, rows))).collect()} == {0: 1, 1: 1, 2: 0, 3: 0, 4: 1}


def test_many_matches_in_one_text(spark):
    n = 100_000
    text = "a@b.co, " * n
    got = pii.digest(pii.find(frame(spark, [(1, text)]))).first()
    assert got.n_email == n and got.base_sha256 == sha([("email", 8 * i, 8 * i + 6) for i in range(n)])
    assert pii.redact(frame(spark, [(1, text)])).first().text == "[EMAIL], " * n
    got = secrets.digest(secrets.scan(frame(spark, [(1, "token=abcdef é" * 30_000)]))).first()
    assert got.n_assign == 30_000 and got.spans.endswith(f"assign:{14 * 29_999}:{14 * 29_999 + 12}")


def test_redaction_of_overlapping_spans_and_clashing_columns(spark):
    text = "mail 4111111111111111@b.co x" + "é" * 5000 + " +49 30 1234567"
    docs = spark.createDataFrame([(1, text, "r", 1, 7, "x"), (None, None, None, None, None, None)], "doc_id long, text string, row string, pii int, n_chars int, `a.b` string")
    got = {r.doc_id: r for r in pii.redact(docs).collect()}
    assert got[1].text == "mail [EMAIL] x" + "é" * 5000 + " [PHONE]" and got[1].n_chars == len(got[1].text)
    assert (got[1].row, got[1].pii, got[1]["a.b"]) == ("r", 1, "x") and got[None].text is None


def test_secrets_without_rows_and_with_one_text_everywhere(spark):
    assert secrets.digest(secrets.scan(frame(spark, []))).count() == 0
    rows = [(None if i % 2 else i, "my token=abcdef") for i in range(3000)] + [(i, f"plain {i}") for i in range(100)]
    got = secrets.digest(secrets.scan(frame(spark, rows)))
    assert got.count() == 3100 and got.where("n_assign = 1").count() == 3000
