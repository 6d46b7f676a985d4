"""Personal data against the plain patterns and a brute-force disclosure count."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from ingot.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(d[::-1])) % 10 == 0


def plain_spans(text):
    out = []
    for rank, (kind, p) in enumerate(PLAIN.items()):
        for m in re.finditer(p, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and not all(int(x) <= 255 for x in m[0].split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), rank, m.end()))
    return sorted(out)


CASES = [
    "", "a@b.c", "x a@b@c.de.", "a.@-.-..b", "ééa%+@x-y.z.9_", "a@b.c@d.e", "@@a@.b a@b..c", "1.2.3.4.5.6.7.8", "256.1.1.1 1.256.1.1 0001.02.3.255", "1.2.3",
    "4111 1111-1111 1111", "4111111111111111 4952935900253052", "41111111111111110 ", "+1 (017) 555-7713 +12345678901234567 +1 ((((", "+1+2 345 678 901 2", "🙂 +49 30 123456789. x",
    "token 4111111111111111", "12.34.56.78@mail.example.com", "1 " * 50,
]


@pytest.mark.parametrize("text", CASES)
def test_base_spans_are_the_patterns(text):
    assert pii.base_spans(text) == plain_spans(text)


def test_base_spans_on_random_text():
    r = random.Random(3)
    for _ in range(3000):
        text = "".join(r.choice("0123456789..@@+ -()aZ_%é\n") for _ in range(r.randrange(60)))
        assert pii.base_spans(text) == plain_spans(text), text


def test_very_long_runs_take_linear_time():
    for run in ("a" * 400_000, "1" * 400_000, "1." * 200_000, "+1" * 200_000, "a@" * 200_000, "+1" + "(" * 400_000):
        pii.base_spans(run)


def corpus():
    """A telling word beside phones, common words everywhere, copies of one text."""
    r = random.Random(7)
    common = [f"word{i}" for i in range(30)]
    say = lambda n: " ".join(r.choice(common) for _ in range(n))
    rows = [f"{say(20)} Hotline +1 (2{i:02}) 555-7{i:03} {say(20)}" for i in range(40)]
    rows += [f"{say(20)} hotline {say(10)}" for _ in range(10)]
    rows += [f"{say(9)} rareword 4111111111111111 {say(9)}"] + ["copied phrase around +1 (299) 555-7999 repeated often"] * 60
    rows += [say(40) for _ in range(40)] + ["", None, "a" * 60_000 + " x@y.zz"]
    return list(enumerate(rows))


def brute_terms(rows):
    near, total = defaultdict(Counter), Counter()
    places = defaultdict(set)
    for i, t in rows:
        t = t or ""
        total.update(pii._WORDS.findall(t.translate(pii._TO_LOWER)))
        for c in pii.contexts(t, pii.base_spans(t)):
            places[c["term"], c["kind"]].add((i, c["start"]))
            near[c["term"], c["kind"]][c["context"]] += 1
    return {k for k, ctx in near.items() if len(ctx) >= pii.SUPPORT and -math.log2(len(places[k]) / total[k[0]]) <= pii.HIDDEN_BITS}


def test_disclosing_terms_and_sanitised_text(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, terms string").repartition(3)
    assert brute_terms(rows) == {("hotline", 3)}
    got = {r["doc_id"]: r for r in pii.spans_of(docs).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        assert [(s["start"], s["rank"], s["end"]) for s in got[i]["base"]] == plain_spans(t or "")
        terms = [t[s["start"] : s["end"]] for s in got[i]["spans"] if s["kind"] == "term"]
        assert terms == (["Hotline"] if i < 40 else [])
    clean = {r["doc_id"]: r for r in pii.sanitize(docs).collect()}
    assert "[PHONE-TERM] [PHONE]" in clean[3]["text"] and "555" not in clean[3]["text"]
    for i, t in rows[40:50] + rows[111:]:
        if not plain_spans(t or ""):
            assert clean[i]["text"] == t and clean[i]["terms"] == "x"


def test_repeated_null_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "a@b.cc"), (1, "a@b.cc"), (None, "a@b.cc"), (2, None)], "doc_id long, text string")
    assert sorted((str(r["doc_id"]), len(r["base"])) for r in pii.spans_of(docs).collect()) == [("1", 1), ("1", 1), ("2", 0), ("None", 1)]
    assert sorted(str(r["text"]) for r in pii.sanitize(docs).collect()) == ["None", "[EMAIL]", "[EMAIL]", "[EMAIL]"]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert pii.spans_of(empty).count() == 0 and pii.sanitize(empty).count() == 0


def test_query_on_the_table(spark):
    from ingot.llm.queries import QUERIES

    d = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()}
    got = QUERIES["op5_pii"](spark, d).collect()
    assert len(got) == len(texts)
    for r in got:
        spans = plain_spans(texts[r["doc_id"]])
        listed = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in spans)
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(x[1] == j for x in spans) for j in range(4)]
        assert set(listed.split(",")) <= set(r["spans"].split(","))


def test_support_counts_contexts_not_copies(spark):
    docs = spark.createDataFrame([(i, "copied phrase around +1 (299) 555-7999 repeated often") for i in range(30)], "doc_id long, text string")
    assert pii.spans_of(docs).where(F.size("spans") > F.size("base")).count() == 0


def added_terms(docs):
    """Texts of the disclosing terms, per row."""
    rows = docs.withColumn("doc_id", F.coalesce("doc_id", F.lit(-1)))
    texts = {r["doc_id"]: r["text"] or "" for r in rows.collect()}
    return sorted((i, tuple(texts[i][s["start"] : s["end"]] for s in r["spans"] if s["kind"] == "term")) for r in pii.spans_of(docs).collect() for i in [-1 if r["doc_id"] is None else r["doc_id"]])


def test_repeated_rows_hide_nothing(spark):
    r = random.Random(11)
    say = lambda n: " ".join(f"word{r.randrange(20)}" for _ in range(n))
    once = [(i, f"{say(12)} hotline +1 (2{i:02}) 555-7{i:03} {say(12)}") for i in range(12)] + [(i, say(30)) for i in range(12, 40)]
    for rows in (once, once * 3):
        got = added_terms(spark.createDataFrame(rows, "doc_id long, text string"))
        assert got == sorted((i, ("hotline",) if "hotline" in t else ()) for i, t in rows)
    # rows without an id count like rows with ids of their own
    copies = [added_terms(spark.createDataFrame(once + [(i, once[0][1]) for i in ids], "doc_id long, text string")) for ids in ([None] * 90, range(100, 190))]
    assert [t for _, t in copies[0]][90:] == [t for _, t in copies[1]][:40] and {t for i, t in copies[0] if i < 0} == {t for i, t in copies[1] if i >= 100}
    assert all("hotline" in t for i, t in copies[0] if i < 12)


def test_names_in_the_address_hide_nothing(spark):
    r = random.Random(12)
    say = lambda n: " ".join(f"word{r.randrange(20)}" for _ in range(n))
    rows = [(i, f"{say(12)} smith john.smith{'' if i % 2 else '.smith'}@smith.com {say(12)}") for i in range(12)] + [(i, say(30)) for i in range(12, 40)]
    assert added_terms(spark.createDataFrame(rows, "doc_id long, text string")) == [(i, ("smith",) if i < 12 else ()) for i, _ in rows]


def test_terms_of_one_entity(spark):
    r = random.Random(13)
    say = lambda n: " ".join(f"word{r.randrange(20)}" for _ in range(n))
    forms = ["+49 (30) 1234-5678", "+49 30 12345678", "+493012345678"]
    texts = [f"{say(12)} Zimmermann {p} {say(12)}" for p in forms] + [f"{say(12)} Mara {m} {say(12)}" for m in ("m.k@x.org", "M.K@x.org", "m.k@X.org")]
    texts += [f"{say(12)} seldom z@x.org {say(12)}"] + [say(40) for _ in range(100)]
    for copies in (1, 4):
        rows = [(i, t) for i, t in enumerate(texts * copies)]
        want = [("Zimmermann",)] * 3 + [("Mara",)] * 3 + [()] * 101
        assert added_terms(spark.createDataFrame(rows, "doc_id long, text string")) == list(enumerate(want * copies))
    # the name elsewhere as often tells too little
    more = texts + [f"{say(12)} zimmermann {say(3)}"] * 4
    assert added_terms(spark.createDataFrame(list(enumerate(more)), "doc_id long, text string"))[:4] == [(i, ()) for i in range(3)] + [(3, ("Mara",))]


def test_beyond_chance(spark):
    tail = lambda k, n, q: sum(math.comb(n, j) * q**j * (1 - q) ** (n - j) for j in range(k, n + 1))
    cases = [(k, n, near, words) for words in (500, 5000, 10**6) for near in (12, 24, 120) for n in (1, 2, 3, 6, 12) for k in range(1, n + 1)]
    df = spark.createDataFrame(cases, "k long, n long, near long, words long")
    flags = [F.when(F.col("words") == w, pii.beyond_chance(F.col("k"), F.col("n"), F.col("near"), w)) for w in (500, 5000, 10**6)]
    got = df.select("*", F.coalesce(*flags).alias("yes")).collect()
    assert any(x["yes"] for x in got) and not any(x["yes"] and x["k"] == 1 for x in got)
    for x in got:  # never where the exact tail is above, always where it is far below
        p = tail(x["k"], x["n"], x["near"] / x["words"]) * x["words"]
        assert not (x["yes"] and p > pii.CHANCE) and (x["yes"] or p * 50 > pii.CHANCE), (x, p)


def plain_contexts(text, width=6):
    """(start, kind) of the words beside the spans, all words of the text at hand."""
    spans, words = plain_spans(text), [m.span() for m in pii._WORDS.finditer(text)]
    out = []
    for s, k, e in spans:
        beside = [w for w in words if w[1] <= s][-width:] + [w for w in words if w[0] >= e][:width]
        out += [(a, k) for a, b in beside if not any(a < y and x < b for x, _, y in spans)]
    return out


def test_contexts_reach_any_distance():
    padded = "Zimmermann" + " " * 500 + "+1 (017) 555-7713" + "." * 5000 + "w" * 1000 + " | " * 300 + "tail"
    assert [c["term"] for c in pii.contexts(padded, pii.base_spans(padded))] == ["zimmermann", "w" * 1000, "tail"]
    r = random.Random(5)
    pieces = ["+1 (017) 555-7713", "a@b.cc", "1.2.3.4", "4111111111111111", "\u00e9", " ", "  ", ".", " " * 200, "-" * 200, "word", "x", "w" * 300]
    for _ in range(500):
        text = "".join(r.choice(pieces) for _ in range(r.randrange(40)))
        assert [(c["start"], c["kind"]) for c in pii.contexts(text, pii.base_spans(text))] == plain_contexts(text), text
        inside = [m for m in pii._WORDS.finditer(text) if any(m.start() < e and s < m.end() for s, _, e in plain_spans(text))]
        assert pii.inside(text, pii.base_spans(text)) == [m[0].lower() for m in inside]
