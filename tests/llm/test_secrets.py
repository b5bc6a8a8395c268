import random
import re

from cellspark.llm import secrets
from cellspark.llm.common import table

ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def brute(text):
    text = text or ""
    out = [(m.start(), 0, "assign", m.end()) for m in re.finditer(ASSIGN, text, re.I | re.A) if len(m.group(2)) >= 6]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m.group()) >= 24]
    for place, r in enumerate(secrets.MORE, 3):
        out += [(m.start(), place, r.kind, m.end()) for m in re.finditer(r.pattern, text, re.A)]
    return sorted(out)


CASES = ["", None, "Password: hunter22", 'api_key = "abcdef1"', "APIKEY='short'", "token token=abc.def secret: x", "AKIA" + "A" * 16,
         "AKIA" + "A" * 15, "akia" + "a" * 16, "f" * 24 + "g" + "e" * 23, "é passwd=ééé passwd=abcdef", "api__key=abcdef", "ſecret=abcdef",
         "toKen=abcdef", "-----BEGIN RSA PRIVATE KEY-----", "ghp_" + "a1" * 18, "xoxb-1234567890", "sk_live_" + "a" * 20, "x" * 100_000,
         "eyJabcdefghi.eyJabcdefghi.abcdefghij", "ftp://user:passw0rd@host", "secret" + " " * 5000 + "=" + "a" * 9]


def test_queries():
    assert secrets.query_of(secrets.BASE[2]) is True
    code = lambda s: int.from_bytes(s.encode(), "big")
    assert secrets.query_of(secrets.BASE[1]) == ("and", (code("aki"), code("kia")))
    kinds = secrets.query_of(secrets.BASE[0])
    assert kinds[0] == "or" and {code("pas"), code("tok"), code("sec"), code("ike")} <= secrets.trigrams(kinds)
    assert all(secrets.query_of(r) is not True for r in secrets.MORE)


def test_matches_plain_scan(spark, sf):
    rng = random.Random(5)
    bits = ["pass", "word", "passwd", "secret", "token", "api", "_", "key", ":", "=", " ", '"', "AKIA", "A9" * 9, "0af" * 8, "é", "x"]
    made = ["".join(rng.choice(bits) for _ in range(rng.randint(1, 14))) for _ in range(600)]
    docs = [r.text for r in table(spark, sf, "documents").collect()]
    cases = CASES + made + docs
    df = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: [(s.start, s.place, s.kind, s.end) for s in r.secrets] for r in secrets.scan(df).collect()}
    assert got == {i: brute(t) for i, t in enumerate(cases)}
    assert secrets.scan(df.limit(0)).count() == 0


def test_redact_and_clash(spark):
    df = spark.createDataFrame([(1, "a token=abcdef b", "own"), (None, None, "own")], "doc_id long, text string, SECRETS string")
    out = secrets.scan(df)
    assert sorted(c.lower() for c in out.columns) == ["doc_id", "secrets", "text"]
    assert [r[0] for r in out.select(secrets.redact(out.text, out.secrets)).collect()] == ["a <assign> b", ""]
