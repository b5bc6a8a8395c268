import math
import re
from collections import Counter

from pyspark.sql import functions as F

from cellspark.llm import pii, quality
from cellspark.llm.common import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_base(t):
    t = t or ""
    w = WORD.findall(t)
    grams = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {i + k for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for k in range(5)}
    lines, seen, dup = t.split("\n"), set(), 0
    for x in lines:
        if WORD.search(x):
            dup += x in seen
            seen.add(x)
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(covered), failed


def test_quality_against_brute_force(spark, sf):
    docs = [(r.doc_id, r.text, r.source) for r in table(spark, sf, "documents").collect()]
    docs += [(-1, None, None), (-1, None, None), (-2, "", "s"), (-3, "a\xa0b c\x1cd e " * 9, None), (-4, "w " * 100_000, "s"), (None, "x y\nx y\n \n", "s")]
    docs += [(1000 + i, f"Common line number {i}.\nown{i} words here\n" + "common LINE number 7", "h") for i in range(12)]
    docs += [(2000 + i, "common line number 0\n" + " ".join(f"u{i}x{k}" for k in range(20)), "h") for i in range(3)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").withColumn("kept", F.lit("clash"))
    got = quality.judge(df, max_documents=10).collect()
    hosts = {}
    for i, t, s in docs:
        for x in (t or "").split("\n"):
            if WORD.search(x):
                hosts.setdefault((s, quality.line_key(x)), set()).add(i)
    want = []
    for i, t, s in docs:
        base = brute_base(t)
        cut = sum(len(WORD.findall(x)) for x in (t or "").split("\n") if WORD.search(x) and len(hosts[s, quality.line_key(x)]) > 10)
        want.append((i, *base, not base[5] and base[0] - cut >= 0.3 * base[0], cut))
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted((tuple(r) for r in got), key=key) == sorted(want, key=key)
    assert any(r.kept for r in got if (r.doc_id or 0) >= 2000)
    assert quality.judge(df.limit(0)).count() == 0


def test_clean_text_against_brute_force(spark):
    docs = [(i, f"Common line number {i}.\n\n{chr(97 + i) * 4} words here\n common LINE number 7", "h") for i in range(12)]
    docs += [(100 + i, "common line number 0\nsame text", None) for i in range(12)] + [(i, "common line number 1\nkept", "few") for i in range(5)]
    docs += [(200, None, "h"), (201, "", "h"), (None, "x\ncommon line number 3", "h"), (3, docs[3][1], "h"), (0, "only here", "few")]
    got = quality.clean(spark.createDataFrame(docs, "doc_id long, text string, source string"), max_documents=10).collect()
    hosts = {}
    for i, t, s in docs:
        for x in (t or "").split("\n"):
            if WORD.search(x):
                hosts.setdefault((s, quality.line_key(x)), set()).add(i)
    want = []
    for i, t, s in docs:
        left = t and "\n".join(x for x in t.split("\n") if not WORD.search(x) or len(hosts[s, quality.line_key(x)]) <= 10)
        want.append((i, t, s, left))
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted((tuple(r) for r in got), key=key) == sorted(want, key=key)
    assert [r.clean_text for r in got if r.doc_id == 5 and r.source == "h"] == ["\nffff words here"]


EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"


def brute_spans(t):
    t = t or ""
    out = [(m.start(), 0, "email", m.end()) for m in re.finditer(EMAIL, t)]
    out += [(m.start(), 1, "ip", m.end()) for m in re.finditer(IP, t) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(CARD, t):
        d = re.sub("[^0-9]", "", m.group())
        if 12 <= len(d) <= 19 and pii.luhn(d):
            out.append((m.start(), 2, "card", m.end()))
    for m in re.finditer(PHONE, t):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append((m.start(), 3, "phone", m.end()))
    return sorted(out)


CASES = [None, "", "a@b.c_d@e.f", "a@b@c.d.e", "@x.y a@.b a.b@c-d.e.f.", "x@y.z@w.v", "1.2.3.4.5.6.7.8", "256.1.1.1 1.1.1.256 01.002.0003.4",
         "1..2.3.4", "4111 1111 1111 1111", "4111-1111-1111-1111 5", "4111  1111", "+1 (555) 123-4567", "+12345678 ", "++49 30 1234567",
         "+1" + " " * 300, "é a@b.cc é 10.0.0.1", "4" * 5000, "1." * 4000, "a" * 30_000 + "@", "١٢٣ a@b.c", "x+1 234 567 8901@y.zz"]


def test_base_spans(spark, sf):
    docs = CASES + [r.text for r in table(spark, sf, "documents").collect()]
    for t in docs:
        assert pii.base_spans(t or "") == brute_spans(t), (t or "")[:60]


def test_disclosure_against_brute_force(spark, sf):
    docs = [(r.doc_id, r.text) for r in table(spark, sf, "documents").collect()]
    docs += [(5000 + i, f"Filler{i} Zorblax writes from jo@x.org, the quay {'the ' * i}") for i in range(5)]
    docs += [(6000 + i, t) for i, t in enumerate(CASES)] + [(6000, None), (None, "zorblax? no. 10.1.2.3 the")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("spans", F.lit(1))
    got = pii.find(df).collect()
    distinct = {pii.digest(t or ""): t or "" for _, t in docs}
    near = {k: pii.contexts(t, pii.base_spans(t), 80) for k, t in distinct.items()}
    n_term = Counter()
    for _, t in docs:
        n_term.update({pii.digest(x) for w in WORD.findall(t or "") if (x := pii.term_of(w))})
    both = Counter(x for c in near.values() for x in {(e, w) for e, w, _, _ in c})
    ent = Counter(e for c in near.values() for e in {e for e, *_ in c})
    n = len(docs)
    flagged = {x for x, k in both.items() if k >= 3 and math.log(n * k / (n_term[x[1]] * ent[x[0]])) / math.log(n / ent[x[0]]) >= 0.8}
    want = []
    for i, t in docs:
        spans = pii.base_spans(t or "") + [(a, 4, "term", b) for e, w, a, b in set(near[pii.digest(t or "")]) if (e, w) in flagged]
        want.append((i, sorted(set(spans))))
    key = lambda r: (r[0] is None, r)
    assert sorted(((r.doc_id, [tuple(s) for s in r.spans]) for r in got), key=key) == sorted(want, key=key)
    terms = {r.doc_id: {s.start for s in r.spans if s.kind == "term"} for r in got}
    assert all(8 in terms[5000 + i] for i in range(5))
    clean = {r.doc_id: r.text for r in pii.sanitise(df).collect() if r.doc_id}
    assert "Zorblax" not in clean[5001] and "<email>" in clean[5001] and clean[5001].startswith("Filler1 ")
    assert pii.find(df.limit(0)).count() == 0 and pii.sanitise(df).count() == len(docs)


def test_copies_of_a_text_count_once(spark):
    docs = [(i, f"Plain text number{i} about nothing") for i in range(2000)]
    docs += [(3000 + i, f"Filler{i} Zorblax writes from jo@x.org") for i in range(3)]
    docs += [(4000 + i, "Filler0 Zorblax writes from jo@x.org") for i in range(1000)]
    got = pii.find(spark.createDataFrame(docs, "doc_id long, text string")).filter("doc_id >= 3000").collect()
    assert len(got) == 1003 and all(any(s.kind == "term" and s.start == 8 for s in r.spans) for r in got)


def test_whole_texts_and_rare_entities_against_brute_force(spark, sf):
    far = "the old mill stands by the river and turns slowly " * 8
    docs = [(r.doc_id, r.text) for r in table(spark, sf, "documents").collect()]
    docs += [(7000 + i, f"Zorblax {far * i}jo@x.org, (Zorblax). 10.9.8.7") for i in range(1, 4)]
    docs += [(7100, f"Quixwort {far}ann@y.org"), (7101, f"Quixwort {far}ann@y.org"), (7102, None), (7103, "a@b.c_d@e.f jo@x.org zorblax")]
    docs += [(7200 + i, t) for i, t in enumerate(CASES)]
    got = pii.find(spark.createDataFrame(docs, "doc_id long, text string"), **pii.WHOLE).collect()
    distinct = {t or "" for _, t in docs}
    n, n_term, ent, both, held = len(distinct), Counter(), Counter(), Counter(), {}
    for t in distinct:
        spans = pii.base_spans(t)
        n_term.update({x for w in WORD.findall(t) if (x := pii.term_of(w))})
        who = {pii.entity_of(t, s) for s in spans}
        free = [m for m in WORD.finditer(t) if pii.term_of(m.group()) and not any(m.start() < s[3] and s[0] < m.end() for s in spans)]
        at = [(x := pii.term_of(m.group()), m.start() + (k := m.group().lower().index(x)), m.start() + k + len(x)) for m in free] if spans else []
        held[t] = who, at
        ent.update(who)
        both.update({(e, x) for e in who for x in {a[0] for a in at}})

    def flagged(e, x):
        k, m = both[e, x], n_term[x] * ent[e] / n
        share = math.log(n * k / (n_term[x] * ent[e])) / math.log(n / ent[e])
        return share >= 0.8 and k > m and k * math.log(k / m) - k + m >= -math.log(0.05)

    keep = {p for p in both if flagged(*p)}
    for r in got:
        t = next(t or "" for i, t in docs if i == r.doc_id)
        who, at = held[t]
        want = set(brute_spans(t)) | {(a, 4, "term", b) for x, a, b in at if any((e, x) in keep for e in who)}
        assert [tuple(s) for s in r.spans] == sorted(want), r.doc_id
    assert len(got) == len(docs)
    terms = {r.doc_id: {s.start for s in r.spans if s.kind == "term"} for r in got}
    assert 0 in terms[7003] and 0 in terms[7100] and 0 in terms[7101]
