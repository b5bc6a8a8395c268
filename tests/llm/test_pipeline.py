import math
import random
import re
from collections import Counter

import corpus_pipeline
from cellspark.llm import pii
from tests.llm.test_packing import check
from tests.llm.test_passages import brute as passages_brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, None, "s", len(t or "")) for i, t in rows], SCHEMA)


def test_near_duplicates_by_row_at_five_words_and_80_percent(spark, rows):
    word = lambda tag, n: [f"{tag}{k}" for k in range(n)]
    long = word("a", 1000)
    copied = word("b", 300)
    changed = [f"x{k}" if k % 37 == 18 else w for k, w in enumerate(copied)]
    docs = [(1, " ".join(long)), (2, " ".join(long + word("z", 200))), (3, " ".join(copied)), (4, " ".join(changed))]
    docs += [(5, "the same row twice in full"), (5, "the same row twice in full"), (5, "other words under that id again")]
    docs += [(None, "a copy without any id here"), (None, "a copy without any id here"), (None, "another text that has no id")]
    docs += [(6, None), (6, None), (7, " \t\n"), (8, "the same row twice in full")]
    got = [r[:2] for r in rows(corpus_pipeline.near_duplicates(spark, frame(spark, docs), ""))]
    want = [docs[0], docs[2], docs[3], docs[4], docs[6], docs[7], docs[9], docs[10], docs[11], docs[12]]
    key = lambda r: [(x is None, x) for x in r]
    assert sorted(got, key=key) == sorted(want, key=key)


def test_language_keeps_texts_with_a_letter_when_nothing_is_labelled(spark, rows):
    docs = [(1, "words of a text"), (2, "\u4e2d"), (3, "12 34 !"), (4, None), (5, ""), (None, "no id")]
    got = [r[:2] for r in rows(corpus_pipeline.language(spark, frame(spark, docs), ""))]
    assert sorted(got, key=str) == sorted([docs[0], docs[1], docs[5]], key=str)


def linked(docs):
    """Component number of each row: five-word shingles, 80 percent; rows without a word are alone."""
    sets = []
    for _, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    label = list(range(len(docs)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    return label


def brute_once(docs):
    best = {}
    for row, group in zip(docs, linked(docs)):
        best[group] = min(best.get(group, row), row, key=lambda r: (r[0] is None, r[0] or 0))
    return list(best.values())


def brute_cut(docs):
    out = []
    for i, _, n_removed, _, kept in passages_brute(docs):
        text = kept.decode("utf-8", "ignore")
        if not n_removed or re.search(r"\S", text):
            out.append((i, text))
    return out


def brute_clean(docs):
    distinct = {t for _, t in docs}
    held, n_term, ent, both = {}, Counter(), Counter(), Counter()
    for t in distinct:
        spans = pii.base_spans(t)
        words = [(x, m.start() + len(m.group()) - len(m.group().lstrip(pii.EDGES)), m) for m in re.finditer(r"[^\x20\x09-\x0D]+", t) if (x := pii.term_of(m.group()))]
        n_term.update({x for x, *_ in words})
        free = [(x, a) for x, a, m in words if spans and not any(m.start() < s[3] and s[0] < m.end() for s in spans)]
        who = {pii.entity_of(t, s) for s in spans}
        held[t] = spans, who, free
        ent.update(who)
        both.update({(e, x) for e in who for x, _ in free})
    n = len(distinct)

    def tells(e, x):
        k, m = both[e, x], n_term[x] * ent[e] / n
        return ent[e] < n and math.log(n * k / (n_term[x] * ent[e])) / math.log(n / ent[e]) >= 0.8 and k > m and k * math.log(k / m) - k + m >= -math.log(0.05)

    out = []
    for i, t in docs:
        spans, who, free = held[t]
        marks = sorted([(s[0], s[3], f"<{s[2]}>") for s in spans] + [(a, a + len(x), "") for x, a in free if any(tells(e, x) for e in who)])
        done, at = "", 0
        for a, b, shown in marks:
            if b > at:
                done, at = done + t[at : max(a, at)] + shown, b
        out.append((i, done + t[at:]))
    return out


def made():
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8)))
    docs = [(k, " ".join(word() for _ in range(rng.randint(1, 120)))) for k in range(70)]
    passage = " ".join(word() for _ in range(60))
    docs += [(100 + k, f"{word()} {word()} {passage} " + " ".join(word() for _ in range(100))) for k in range(6)]
    docs += [(200 + k, docs[5][1] if k % 2 else docs[6][1].upper()) for k in range(5)] + [(5, docs[5][1])]
    docs += [(300 + k, f"Name{k}́ writes to jo{k}@x.org or 10.0.0.{k}, says O'Brien{k}. " + " ".join(word() for _ in range(30))) for k in range(4)]
    docs += [(400, None), (401, ""), (402, " \n"), (403, "12 34 !"), (404, "李明"), (None, "no id but words " + word()), (405, passage)]
    docs += [(406, "".join(rng.choice("abc de") for _ in range(200_000)))]
    rng.shuffle(docs)
    return docs


def test_run_against_brute_force(spark, tmp_path):
    docs = made()
    df = frame(spark, docs).selectExpr("*", "1 AS label", "'x' AS spans", "2 AS kept", "3 AS sequence_id")
    df.repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    kept = brute_once([(i, t) for i, t in docs if t and re.search(r"[^\W\d_]", t)])
    final = brute_clean(brute_cut(kept))
    assert len(final) < len(kept) < len(docs) and any("<email>" in t for _, t in final)
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    check(rows, final, 2048)


def test_each_stage_keeps_the_columns_and_takes_an_empty_table(spark):
    docs = frame(spark, made()[:12]).selectExpr("*", "1 AS label", "'x' AS spans")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, "").columns == docs.columns
        assert stage(spark, docs.limit(0), "").count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), "").count() == 0
