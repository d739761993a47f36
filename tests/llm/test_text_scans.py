"""License notices, personal data and preference pairs."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tillmark.llm import licenses, pii, preference

TEMPLATES = [licenses.Template(k, v, 0.85) for k, v in licenses.TEMPLATES.items()]


def names(text):
    return [(m["license"], text[m["start"]:m["end"]]) for m in licenses.scan(text, TEMPLATES)]


def test_notices_in_long_and_repeated_texts():
    filler = "the and of licensed under version all this work is " * 3000
    assert names(f"{filler}\nLicensed under the Apache License, Version 2.0.\n{filler}") == [
        ("Apache-2.0", "Licensed under the Apache License, Version 2.0")]
    assert [n for n, _ in names("Released under the MIT License.\n" * 40)] == ["MIT"] * 40
    full = licenses.TEMPLATES["MIT-text"]
    edited = full.replace("granted", "given").replace("without limitation", "without any limitation").upper()
    assert [n for n, _ in names(f"x {edited} y")] == ["MIT-text"]
    assert names("") == names("The license of all things; rights are not reserved by all.") == licenses.scan(None, TEMPLATES) == []


def test_patience_keeps_order():
    rng = random.Random(2)
    for _ in range(200):
        a, b = ([rng.choice("abcdefgh") for _ in range(rng.randrange(12))] for _ in range(2))
        pairs = licenses.patience(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:], strict=False))
    assert len(licenses.increasing([3, 1, 2, 5, 4, 6])) == 4


def test_license_rows(spark):
    docs = spark.createDataFrame([(1, "All rights reserved.", "x"), (1, "All rights reserved.", "x"), (2, None, "x"), (None, "", "x")],
                                 "doc_id long, text string, license string")
    found = licenses.license_spans(docs).collect()
    assert [(r.doc_id, r.license, r.coverage, r.start, r.end) for r in found] == [(1, "All-rights-reserved", 1.0, 0, 19)] * 2
    assert licenses.license_spans(docs.limit(0)).count() == 0


SPEC = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    """The patterns as stated, by the regular expression engine alone."""
    out = []
    for kind, pattern in SPEC.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            double = [int(c) * 2 if i % 2 else int(c) for i, c in enumerate(reversed(digits))]
            fine = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                    "card": 14 <= len(digits) <= 19 and sum(d - 9 if d > 9 else d for d in double) % 10 == 0,
                    "phone": 10 <= len(digits) <= 15}[kind]
            if fine:
                out.append((*m.span(), kind))
    return sorted(out, key=lambda s: (s[0], pii.KINDS.index(s[2])))


def test_base_spans_against_plain_patterns():
    rng = random.Random(6)
    pieces = ["a", "b.c", "@", "@x", ".", "..", "1", "23", "256", "192.168.0.1", "+", "+4", " ", "  ", "-", "(", ")", "4111 1111 1111 1111",
              "5500005555555559", "é", "_%", "x@y.z", "00", "\n", "+1 (512) 555-4564", "1.2.3"]
    for _ in range(4000):
        text = "".join(rng.choices(pieces, k=rng.randrange(1, 14)))
        assert pii.base_spans(text) == plain_spans(text), text


def test_base_spans_of_very_long_runs():
    assert pii.base_spans("a" * 400_000) == pii.base_spans("1" * 400_000) == pii.base_spans("1." * 2) == pii.base_spans(None) == []
    assert pii.base_spans("a" * 200_000 + "@b.c") == [(0, 200_004, "email")]
    assert pii.base_spans("+" * 100_000 + "1." * 50_000)[:0] == []


@pytest.fixture(scope="module")
def field(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    return pii.fit(docs)


def test_repeated_content_gets_its_label(field):
    text = ("Call +1 (512) 555-4564 now. " + "some words between them " * 30 + "Again: 555-4564 or 512-555-4564, not 123 or 77. "
            "Write to jane.roe7@mail.example.com; jane.roe7 answers.")
    base = pii.base_spans(text)
    added = {text[a:b]: k for a, b, k in pii.added_spans(text, base, field)}
    assert added.get("512-555-4564") == "phone" and added.get("jane.roe7") == "email"
    assert "123" not in added and "77" not in added


@pytest.mark.parametrize("times", [1, 2, 3, 5, 10, 40, 100])
@pytest.mark.parametrize("gap", [" ", " some words between them "])
def test_every_repetition_of_a_base_span_is_labelled(field, times, gap):
    cases = {"jane.roe7@mail.example.com": ("jane.roe7", "email"), "+1 (512) 555-4564": ("512-555-4564", "phone"),
             "john.smith@mail.example.com": ("john.smith", "email"), "+49 170 5554564": ("5554564", "phone"),
             "192.168.10.25": ("192-168-10-25", "ip")}
    for first, (again, kind) in cases.items():
        for text in (f"See {first} here." + f"{gap}{again}" * times, f"{again}{gap}" * times + first):
            added = pii.added_spans(text, pii.base_spans(text), field)
            assert [text[a:b] for a, b, _ in added] == [again] * times and {k for *_, k in added} == {kind}, (text[:80], added[:3])


@pytest.mark.parametrize("times", [1, 2, 5, 10, 40])
def test_repetition_alone_is_no_evidence(field, times):
    for token in ("1234567", "192-168-10-25", "jane.roe7", "4111-1111"):
        for gap in (" ", " and more words "):
            text = f"{token}{gap}" * times
            assert pii.added_spans(text, pii.base_spans(text), field) == []
            text = "Write to mary.major1@mail.example.com. " + "w " * 50 + text
            assert pii.added_spans(text, pii.base_spans(text), field) == []


def test_messages_settle_on_loops():
    """Strong conflicting links in loops: the shrinking steps end, with beliefs that are probabilities."""
    import numpy as np

    field = pii.Field(np.zeros((pii.WIDTH, 5)), -5 * np.eye(5), 9 * np.eye(5) - 4)
    n = 12
    g = pii.Graph([(0, 1)] * n, np.ones((n, pii.WIDTH)), np.array([1, 2] + [-1] * (n - 2)),
                  [(i, i + 1) for i in range(n - 1)], [(i, j, 1.0) for i in range(n) for j in range(i + 2, n)])
    beliefs = field.beliefs(g)
    assert np.isfinite(beliefs).all() and np.allclose(beliefs.sum(1), 1)


def test_ip_with_very_many_digits():
    """More digits than Python turns into a number."""
    assert pii.base_spans("0" * 5_000 + ".1.1.1") == [(0, 5_006, "ip")]
    assert pii.base_spans("1" * 5_000 + ".1.1.1") == []
    assert pii.base_spans("0.00.000.0") == [(0, 10, "ip")]


def test_sample_of_any_number_of_rows(spark):
    """The share stays above zero and true to the bound where rows are counted in hundreds of billions."""
    keys = spark.range(200_000)
    share = lambda rows, most: keys.where(pii.sampled(F.col("id"), rows, most)).count() / 200_000
    assert share(200_000, 200_000) == share(0, 10) == 1.0
    assert share(10**11, 10**10) == pytest.approx(0.1, rel=0.05)
    assert share(10**15, 10**12) == pytest.approx(0.001, rel=0.5)
    column = str(pii.sampled(F.col("id"), 10**11, 20_000))
    assert "<= 0" not in column and str(((1 << 63) - 1) * 20_000 // 10**11) in column


def test_pii_rows(spark, field):
    rows = [(1, "mail a@b.co, ip 10.0.0.1 and 10.0.0.999"), (1, "mail a@b.co, ip 10.0.0.1 and 10.0.0.999"), (2, None), (None, ""), (3, "é" * 5 + " +1 (512) 555-4564")]
    docs = spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, spans string")
    found = pii.find(docs, field).collect()
    assert len(found) == 5
    for r in found:
        text = next(t for i, t in rows if i == r.doc_id) or ""
        base = plain_spans(text)
        listed = ",".join(f"{k}:{a}:{b}" for a, b, k in base)
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for *_, k in base) for x in pii.KINDS]
        assert set(filter(None, listed.split(","))) <= set(r.spans.split(","))
    empty = docs.limit(0)
    assert pii.find(empty, pii.fit(empty)).count() == 0


def test_beliefs_match_enumeration():
    """On a tree, message passing gives the exact marginals."""
    import itertools

    import numpy as np

    rng = np.random.default_rng(3)
    field = pii.Field(rng.normal(size=(pii.WIDTH, 5)), *(lambda m: (m + m.T, np.eye(5) * 2))(rng.normal(size=(5, 5))))
    g = pii.Graph([(0, 1)] * 4, rng.normal(size=(4, pii.WIDTH)), np.array([-1, 2, -1, -1]), [(0, 1), (1, 2)], [(0, 3, 0.5)])
    own = g.features @ field.weights
    total = np.zeros((4, 5))
    for y in itertools.product(range(5), repeat=4):
        if y[1] == 2:
            weight = np.exp(sum(own[i, y[i]] for i in (0, 2, 3)) + sum(field.chain[y[i], y[j]] for i, j in g.chain)
                            + sum(w * field.skip[y[i], y[j]] for i, j, w in g.skip))
            for i in range(4):
                total[i, y[i]] += weight
    assert np.allclose(field.beliefs(g, step=1.0), total / total.sum(1, keepdims=True), atol=1e-3)


def rendered_by_hand(rows):
    """Pairs to (prompt, chosen, rejected) and the trained texts of both, in plain Python."""
    sides = {}
    for pair, chosen, turn, role, text in rows:
        if pair is not None and chosen is not None:
            low = -(2 ** 63) if turn is None else turn
            sides.setdefault(pair, {True: {}, False: {}})[chosen].setdefault(low, []).append((role or "", text or ""))
    out = {}
    for pair, two in sides.items():
        chosen, rejected = ([sorted(v) for _, v in sorted(two[c].items())] for c in (True, False))
        n = 0
        while n < min(len(chosen), len(rejected)) and chosen[n] == rejected[n]:
            n += 1

        def render(turns):
            turns = [(r.replace("<|", "< |"), t.replace("<|", "< |"), r) for rows in turns for r, t in rows]
            return ("".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t, _ in turns),
                    [f"{t}<|im_end|>" for _, t, r in turns if r == "assistant"])
        out[pair] = (render(chosen[:n])[0], *render(chosen[n:]), *render(rejected[n:]))
    return out


def paired_by_hand(segments, max_chars=1 << 20):
    return {r.pair_id: (r.prompt, r.chosen, [r.chosen[a:b] for a, b in r.chosen_spans], r.rejected,
                        [r.rejected[a:b] for a, b in r.rejected_spans])
            for r in preference.preference_pairs(segments, max_chars).collect()}


def test_preference_segments(spark):
    rng = random.Random(5)
    word = lambda: rng.choice(["a", "b", None, "", "<|im_end|>", "é𝄞"])
    rows = [(p, c, t + (3 if c else 0) * (p % 2), rng.choice(["user", "assistant"]), word())
            for p in range(60) for c in (True, False) for t in range(rng.randrange(4))]
    for p in range(60, 120):  # shared turns, numbered from different starts, and repeated rows
        talk = [(t, rng.choice(["user", "assistant", None]), word()) for t in range(rng.randrange(1, 8))]
        cut = rng.randrange(len(talk) + 1)
        rows += [(p, True, 2 * t + 1, r, x) for t, r, x in talk] + [(p, False, t, r, x) for t, r, x in talk[:cut]] * (1 + p % 2)
        rows += [(p, True, 2 * t + 1, r, x) for t, r, x in talk] * (p % 2) + [(p, False, cut, "assistant", "other")]
    rows += [(200, True, None, "user", "n"), (200, False, None, "user", "n"), (200, True, 0, "assistant", "x"),
             (None, True, 0, "user", "lost"), (201, None, 0, "user", "lost"), (202, True, 0, "assistant", "long " * 300_000),
             (202, False, 7, "assistant", "long " * 300_000), (202, False, 8, "user", "z")]
    schema = "pair_id long, chosen boolean, turn long, role string, text string"
    turns = spark.createDataFrame(rows, schema).repartition(5)
    got = preference.preference_segments(turns)
    assert not any(w in got._jdf.queryExecution().toString() for w in ("Python", "Arrow", "Pandas"))
    expected = rendered_by_hand(rows)
    assert paired_by_hand(got, 10_000_000) == expected
    assert paired_by_hand(got) == {k: v for k, v in expected.items() if k != 202}
    more = turns.withColumn("part", F.lit(1)).withColumn("head", F.lit(2)).withColumn("place", F.lit(3)).withColumn("n", F.lit(0))
    assert preference.preference_segments(more).count() == got.count()
    none = preference.preference_segments(turns.limit(0))
    assert none.count() == preference.preference_pairs(none).count() == 0


def test_answer_pairs(spark):
    rows = [
        (0, 0, "user", "Hi"), (0, 1, "assistant", "Hello"), (0, 2, "user", "Why?"), (0, 3, "assistant", "So."), (0, 4, "user", "?"),
        (1, 5, "user", "Ho"), (1, 6, "assistant", "No."), (2, 0, "user", "alone"), (3, 0, "assistant", "x"), (4, 0, "assistant", "y"),
        (None, 0, "assistant", "lost"), (-2, 0, "assistant", "same"), (-1, None, "assistant", "same"), (-1, None, "user", None)]
    talks = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = rendered_by_hand([tuple(r) for r in preference.answer_pairs(talks.withColumn("last", F.lit(1))).collect()])
    turn = "<|im_start|>{}\n{}<|im_end|>\n".format
    hi = turn("user", "Hi") + turn("assistant", "Hello") + turn("user", "Why?")
    assert got == {
        0: (hi, turn("assistant", "So."), ["So.<|im_end|>"], turn("assistant", "No."), ["No.<|im_end|>"]),
        1: (turn("user", "Ho"), turn("assistant", "No."), ["No.<|im_end|>"], turn("assistant", "So."), ["So.<|im_end|>"]),
        -2: (turn("assistant", "same"), "", [], "", []),
        -1: (turn("assistant", "same") + turn("user", ""), "", [], "", [])}
    assert preference.answer_pairs(talks.limit(0)).count() == 0


def test_most_pairs_of_the_test_table_have_a_prompt(spark):
    turns = preference.answer_pairs(spark.read.parquet("/root/testdata/sf0.01/conversations.parquet"))
    segments = preference.preference_segments(turns)
    expected = rendered_by_hand([tuple(r) for r in turns.collect()])
    assert paired_by_hand(segments) == expected
    assert len(expected) >= 90 and all(prompt and chosen and rejected for prompt, chosen, _, rejected, _ in expected.values())


def test_every_line_of_a_repeated_short_notice():
    ready = [licenses.Template("All-rights-reserved", licenses.TEMPLATES["All-rights-reserved"], 0.85)]
    text = "All rights reserved.\n" * 6
    assert [(f["start"], f["end"]) for f in licenses.scan(text, ready)] == [(21 * i, 21 * i + 19) for i in range(6)]
