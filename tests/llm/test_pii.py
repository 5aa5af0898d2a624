import hashlib
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from salestide.llm import pii, queries

DATA = "/root/testdata/sf0.001/documents.parquet"
PLAIN = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def passes(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "card":
        doubled = [int(d) * (2 if i % 2 else 1) for i, d in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(d // 10 + d % 10 for d in doubled) % 10 == 0
    if kind == "phone":
        return 9 <= len(digits) <= 15
    return True


def base_by_hand(text):
    return [(k, m.start(), m.end()) for k, p in PLAIN.items() for m in p.finditer(text) if passes(k, m.group())]


PARTS = ["a", "b@", "@", ".", "-", "+", "1", "23", "4.5", "255", "256", " ", "(", ")", "4111111111111111", "x.y", "@c.de", "é", "0001", "\n", "%", "..", "+1 (206) 555-0100"]


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=24).map("".join))
def test_base_spans_equal_the_patterns(text):
    assert pii.base_spans(text) == base_by_hand(text)


@pytest.mark.parametrize("text", ["1" * 100_000, "a" * 100_000, "@" * 100_000, "a@" * 50_000, "1." * 50_000, "+1" * 50_000, "1 " * 50_000, "+1" + "(" * 90_000, "a at b dot " * 9000])
def test_long_texts_take_no_more_than_linear_time(text):
    pii.occurrences(text, pii.base_spans(text))


def test_rows_of_the_query_equal_brute_force(spark):
    docs = spark.read.parquet(DATA)
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = pii.digest(pii.find(docs.repartition(3))).collect()
    assert len(got) == len(texts)
    for r in got:
        base = base_by_hand(texts[r.doc_id] or "")
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for k, _, _ in base) for kind in pii.KINDS]
        line = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert set(filter(None, line.split(","))) <= set(r.spans.split(","))
        assert len(list(filter(None, r.spans.split(",")))) == len(base) + r.n_added


def bootstrap_by_hand(seen, rounds):
    """Scores of candidates by plain loops over all occurrences."""
    edges = {}
    for value, kind, form, patterns in seen:
        for p in patterns:
            edges[p, value, form, kind] = edges.get((p, value, form, kind), 0) + 1
    scores = {}
    for _ in range(rounds):
        mass, values, total = {}, {}, {}
        for (p, value, form, kind), n in edges.items():
            total[p] = total.get(p, 0) + n
            marks = {kind: 1.0} if kind else {k: s for (v, f, k), s in scores.items() if (v, f) == (value, form)}
            for k, s in marks.items():
                mass[p, k] = mass.get((p, k), 0) + n * s
                values.setdefault((p, k), set()).add(value)
        confident = {
            pk: m / (total[pk[0]] + pii.PRIOR) for pk, m in mass.items()
            if len(values[pk]) >= pii.MIN_INSTANCES and m / (total[pk[0]] + pii.PRIOR) >= pii.MIN_CONFIDENCE
        }
        doubt = {}
        for (p, value, form, kind), n in edges.items():
            for (q, k), c in confident.items():
                digits = len(re.sub("[^0-9]", "", value))
                number = form == "number"
                fits = {"email": form == "spelled", "phone": number and 7 <= digits <= 15, "card": number and 13 <= digits <= 19, "ip": number and value.count(".") == 3}
                if kind is None and p == q and fits[k]:
                    doubt[value, form, k] = doubt.get((value, form, k), 1.0) * (1 - c)
        scores = {key: 1 - d for key, d in doubt.items()}
    return scores


def sample():
    rnd = random.Random(8)
    rows = []
    for i in range(60):
        number = f"+1 ({rnd.randrange(200, 999)}) 555-{rnd.randrange(1000, 9999)}"
        rows.append(f"please call me at {number} thanks {rnd.choice(['anne', 'bob'])}")
    rows += [f"please call me at (206) 555-{1000 + i} thanks carol" for i in range(6)]
    rows += [f"the part number is {10_000_000 + i} in stock" for i in range(30)]
    rows += [f"you may write to u{i}@mail.example.com about it" for i in range(25)]
    rows += ["you may write to jane dot doe at mail dot example dot com about it", "you may write to jane (at) mail dot example dot com about it"]
    return rows


def test_bootstrap_equals_brute_force_and_finds_unseen_identifiers(spark):
    rows = sample()
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(rows)], "doc_id long, text string, base string")
    seen = [
        (o["value"], o["kind"], o["form"], o["patterns"])
        for t in rows for o in pii.occurrences(t, pii.base_spans(t))
    ]
    frame = spark.createDataFrame(seen, "value string, kind string, form string, patterns array<string>").repartition(3)
    for rounds, played, apart in ((3, 3, 1e-9), (None, 30, 2 * pii.TOLERANCE)):  # at the end nothing changes any more
        scores, patterns = pii.bootstrap(frame, rounds)
        got = {(r.value, r.form, r.kind): r.score for r in scores.collect()}
        want = bootstrap_by_hand(seen, played)
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < apart for k in got)
    assert {"at _", "me at _"} <= {r.pattern for r in patterns.collect()}
    found = {r.doc_id: r for r in pii.find(docs).collect()}
    for i, text in enumerate(rows):
        added = [(s.kind, text[s.start : s.end]) for s in found[i].added]
        if 60 <= i < 66:
            assert added == [("phone", f"(206) 555-{1000 + i - 60}")]
        elif i == len(rows) - 1:
            assert [k for k, _ in added] == ["email"]
        elif i < 120:
            assert not added
    masked = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert masked[60] == "please call me at <phone> thanks carol" and "@" not in masked[100]


@pytest.mark.parametrize(("text", "want"), [
    ("to jane (at) mail.example.com.", ["jane (at) mail.example.com"]),
    ("to jane AT mail dot example.com now", ["jane AT mail dot example.com"]),
    ("j@x a[at]b [dot] c at d.e", ["a[at]b [dot] c"]),
    ("look at this", []),
    ("at 206 555 1000 206 555 1001 or", ["206 555 1000", "206 555 1001"]),
    ("at 2065551000 2065551001, 030 2001 or", ["2065551000", "2065551001", "030 2001"]),
    ("at (206) 555-1000 (206) 555-1001 or", ["(206) 555-1000", "(206) 555-1001"]),
    ("at 2065551000 206 555 1001 or", ["2065551000", "206 555 1001"]),
    ("12345678901234567890", []),
])
def test_candidates(text, want):
    assert [text[a:b] for _, a, b in pii._candidates(text, pii.base_spans(text))] == want


def test_wider_forms_are_found_by_their_context(spark):
    rows = [f"you may write to u{i}@mail.example.com about it" for i in range(25)] + ["you may write to jane (at) mail.example.com about it"]
    rows += [f"call me at +1 206 555 {1000 + i} or at +1 206 555 {2000 + i} today" for i in range(25)]
    rows += ["call me at 206 555 3000 206 555 3001 today"]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    added = {rows[r.doc_id][s.start : s.end] for r in pii.find(docs).collect() for s in r.added}
    assert {"jane (at) mail.example.com", "206 555 3000"} <= added


def test_a_context_whose_majority_is_unseen(spark):
    rows = [f"phone: +1 (206) 555-{1000 + i}" for i in range(20)] + [f"phone: (0)30 / {200_000 + i}" for i in range(60)]
    rows += [f"ref +1 (206) 555-{2000 + i} end" for i in range(5)] + [f"ref u{i}@mail.example.com end" for i in range(20)]
    rows += [f"ref {30_000_000 + i} end" for i in range(20)] + [f"part {40_000_000 + i} end" for i in range(20)]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    added = {r.doc_id: [(s.kind, rows[r.doc_id][s.start : s.end]) for s in r.added] for r in pii.find(docs).collect()}
    for i, text in enumerate(rows):  # of "ref", most that is known are no phones
        assert added[i] == ([("phone", text.removeprefix("phone: "))] if 20 <= i < 80 else [])


def test_registered_query_adds_what_the_base_patterns_miss(spark, tmp_path):
    rows = sample()
    spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries.QUERIES["op10_pii"](spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    for i, text in enumerate(rows):
        base = [f"{k}:{a}:{b}" for k, a, b in base_by_hand(text)]
        spans = list(filter(None, got[i].spans.split(",")))
        assert set(base) <= set(spans) and len(spans) == len(base) + got[i].n_added
    assert [got[i].n_added for i in range(60, 66)] == [1] * 6 and got[len(rows) - 1].n_added == 1
    assert got[61].spans == f"phone:18:{18 + len('(206) 555-1001')}"


def test_chains_of_contexts_are_followed_to_their_end(spark):
    """Each context shares its values with the next, so the last is learned four rounds after the first."""
    rows = [f"alpha +1 206 555 {1000 + i} end" for i in range(5)] + [f"alpha 206 555 {1000 + i} end" for i in range(5)]
    for first, second in zip(["alpha", "beta", "gamma", "delta", "omega"], ["beta", "gamma", "delta", "omega", "kappa"]):
        at = 1000 if first == "alpha" else 100 * len(first) + ord(first[0])
        following = 100 * len(second) + ord(second[0])
        rows += [f"{second} 206 555 {n} stop" for n in range(at, at + 5)] + [f"{second} 206 555 {n} stop" for n in range(following, following + 5)]
    rows += [f"part {40_000_000 + i} stop" for i in range(20)]
    seen = [
        (o["value"], o["kind"], o["form"], o["patterns"][:1]) for t in rows for o in pii.occurrences(t, pii.base_spans(t))
    ]
    frame = spark.createDataFrame(seen, "value string, kind string, form string, patterns array<string>")
    patterns = {n: {r.pattern for r in pii.bootstrap(frame, n)[1].collect()} for n in (2, None)}
    assert "kappa _" in patterns[None] and "kappa _" not in patterns[2]
    assert "part _" not in patterns[None]


def test_contexts_are_whole_words():
    long = "x" * 5000
    text = f"one {long} two 1.2.3.4 {long} end"
    a = text.index("1.2")
    assert pii.contexts(text, a, a + 7) == ["two _", f"{long} two _", f"two _ {long}"]
    assert pii.contexts("1.2.3.4", 0, 7) == []


def test_redact_goes_by_row(spark):
    rows = [(1, "a@b.c x", "s"), (1, "a@b.c x", "s"), (1, "no", "t"), (None, "to 1.2.3.4", "u"), (None, None, "v"), (2, "", "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _spans string")
    docs = docs.selectExpr("*", "1 as _row", "2 as _k", "3 as _text", "4 as _doc", "5 as base")
    got = pii.redact(docs)
    assert got.columns == docs.columns
    assert sorted(((r.doc_id or 0, r.text or "", r["_spans"]) for r in got.collect())) == [
        (0, "", "v"), (0, "to <ip>", "u"), (1, "<email> x", "s"), (1, "<email> x", "s"), (1, "no", "t"), (2, "", "w"),
    ]
    assert pii.redact(docs.limit(0)).count() == 0


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, "a@b.c"), (4, "a@b.c"), (4, "a@b.c"), (5, "é😀 1.2.3.4")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = pii.digest(pii.find(docs)).collect()
    assert sorted((r.doc_id or 0, r.spans) for r in got) == [
        (0, "email:0:5"), (1, ""), (2, ""), (4, "email:0:5"), (4, "email:0:5"), (5, "ip:3:10"),
    ]
    assert pii.find(docs.limit(0)).count() == 0
