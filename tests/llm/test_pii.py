from __future__ import annotations

import random
import re

import numpy as np
import pytest

from clickloom.llm import boosting, pii
from tests.llm.conftest import ODD

#: the contract's patterns as they stand
PATTERNS = [
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"),
    re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def brute(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in pattern.finditer(text):
            digits = [int(c) for c in m.group() if c in "0123456789"]
            if kind == 1 and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == 2 and not (12 <= len(digits) <= 19 and sum(d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(reversed(digits))) % 10 == 0):
                continue
            if kind == 3 and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, *m.span()))
    return sorted(out, key=lambda s: (s[1], s[0]))


def test_base_spans_against_the_patterns():
    rng = random.Random(3)
    known = ["4041894974608795", "10.0.0.1", "+1 (988) 555-2485", "a.b@c.d.e", "0010.0.0.00255", ""]
    for _ in range(30_000):
        text = rng.choice(known) + "".join(rng.choice("ab@..-+ 0123459()é") for _ in range(rng.randint(0, 40))) + rng.choice(known)
        assert pii.base_spans(text) == brute(text), text


@pytest.mark.parametrize("text", ["1" * 200_000, "1." * 100_000, "a" * 200_000 + "@", "a@" * 80_000, "+1" + " " * 200_000, "1 " * 100_000 + "x", "(1)" * 80_000, " at " * 60_000])
def test_long_runs_take_linear_time(text):
    pii.base_spans(text)
    pii.proposals(text)


@pytest.mark.parametrize(
    "kind, span",
    [
        (2, "45.32.01.51.12.83.03.66"), (2, "45/32/01/51/12/83/03/66"), (3, "00 33 1 23 45 67 89"), (3, "555-123-4567"),
        (0, "a" * 80 + " at example.com"), (0, "me [at] a.b.c.d.e.f.g.h"), (0, "me at " + "n" * 70 + " dot org"),
    ],
)
def test_whole_spans_are_proposed(kind, span):
    for before in ("see ", "call="):
        assert (kind, len(before), len(before) + len(span)) in pii.proposals(f"{before}{span} now")


def test_spans_scored_in_pieces_are_the_same(model, monkeypatch):
    scorer, rows = pii.Model(*model), training_texts(60)
    whole = pii.find_spans(rows, scorer)
    monkeypatch.setattr(pii, "_SCORED", 7)
    assert pii.find_spans(rows, scorer) == whole
    for text in ("a." * 100_000 + " at " + "b." * 100_000, "x dot " * 50_000 + "at " * 50_000, "a at b dot " * 40_000):
        pii.proposals(text)


def test_boosted_trees_learn_a_rule():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 2] > 0.5)).astype(float)
    model = boosting.fit(x[:2000], y[:2000])
    assert ((boosting.margins(model, x[2000:]) > 0) == y[2000:]).mean() > 0.97
    assert boosting.margins(boosting.fit(x[:50], np.zeros(50)), x[:5]).max() < 0


def training_texts(n=400):
    rng = random.Random(7)
    def digits(k): return "".join(rng.choice("0123456789") for _ in range(k))
    def card():
        d = "4" + digits(14)
        return next(d + c for c in "0123456789" if pii.luhn(d + c))
    out = []
    for k in range(n):
        fill = " ".join(rng.choice(["the", "at", "house", "of", "version 2.0", "page 14", "in 1999", f"order {digits(16)}", digits(5)]) for _ in range(12))
        span = [f"{rng.choice('abcdef')}{digits(2)}@mail{digits(1)}.example.com", f"10.{rng.randint(0, 255)}.0.{rng.randint(1, 255)}", card(), f"+1 ({digits(3)}) 555-{digits(4)}"][k % 4]
        out.append(f"{fill} {span} {fill[::-1][:20]}")
    return out


@pytest.fixture(scope="module")
def model(spark):
    rows = [(k, t) for k, t in enumerate(training_texts())]
    return pii.train(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4))


def test_the_method_adds_other_formats_and_leaves_clean_texts_alone(model):
    scorer = pii.Model(*model)
    def found(text): return [(pii.KINDS[k], text[a:b]) for k, a, b in pii.find_spans([text], scorer)[0][1]]
    assert found("the house (988) 555-2485 of the") == [("phone", "(988) 555-2485")]
    assert found("in the house 4041-8949-7460-8795 of") == [("card", "4041-8949-7460-8795")]
    for clean in ("version 2.0 of the house at page 14", "in 1999 the order 4041894974608796 at", "Born 2021-03-04 12:30, at 5.30."):
        assert found(clean) == []


def test_held_out_accuracy(spark, model):
    rows = [pii.training_rows(t) for t in training_texts(800)[400:]]
    x, y = np.array([f for r in rows for f, _ in r]), np.array([label for r in rows for _, label in r])
    p = pii.Model(*model).probability(x)
    assert ((p > 0.5) == y).mean() > 0.97
    assert abs(p.mean() - y.mean()) < 0.03


def test_selection_keeps_base_spans_and_the_most_probable():
    base = [(0, 10, 20)]
    offered = [(0.9, (2, 0, 5)), (0.99, (3, 3, 8)), (0.999, (1, 15, 25)), (0.8, (1, 30, 40))]
    assert pii.select(base, offered) == [(3, 3, 8), (0, 10, 20), (1, 30, 40)]


def test_redaction_odd_rows_and_empty_table(spark, documents):
    docs = documents([*ODD, (50, "mail a.b@c.de or +1 (988) 555-2485, é 10.0.0.1!", "en", "s")]).selectExpr("*", "'x' as spans", "1 as kind")
    rows = pii.redact(docs).collect()
    assert len(rows) == len(ODD) + 1
    got = next(r for r in rows if r["doc_id"] == 50)
    assert got["text"] == "mail [EMAIL] or [PHONE], é [IP]!" and got["n_chars"] == len(got["text"]) and got["spans"] == "x"
    assert {r["doc_id"]: r["text"] for r in rows if r["doc_id"] != 50} == {i: t for i, t, *_ in ODD}
    empty = documents([])
    assert pii.redact(empty).count() == pii.detect(empty).count() == 0


def test_query_base_spans_against_brute_force(spark):
    from clickloom.llm.queries import op6_personal_data

    sf_dir = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r for r in op6_personal_data(spark, sf_dir).collect()}
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        spans = brute(r["text"])
        row = got[r["doc_id"]]
        assert row["base_sha256"] == pii.sha(spans)
        assert [row[f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == n for s in spans) for n in range(4)]
        assert {f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in spans} <= set(row["spans"].split(","))


def test_proposals_of_addresses_in_any_case():
    for text in ("bob At example.com", "bob (At) example.com", "bob aT example.com", "bob [AT] example.com", "bob@example.com", "bob {at} example dot com"):
        assert (0, 0, len(text)) in pii.proposals(text)


def planted(n=300):
    """Texts with one span each in a form that the base rules do not know: (text, kind, start, end)."""
    rng = random.Random(21)

    def digits(k):
        return "".join(rng.choice("0123456789") for _ in range(k))

    def card():
        d = "4" + digits(14)
        return next(d + c for c in "0123456789" if pii.luhn(d + c))

    out = []
    for k in range(n):
        fill = " ".join(rng.choice(["the", "house", "of", "version 2.0", "page 14", "in 1999", f"order {digits(16)}", digits(5)]) for _ in range(12))
        c = card()
        span = [
            f"{rng.choice('abcdef')}{digits(2)}{(' at ', ' [at] ', ' (at) ')[k % 3]}mail{digits(1)}{(' dot ', '.', '(dot)')[k // 3 % 3]}example.com",
            "[.]".join(["10", str(rng.randint(0, 255)), "0", str(rng.randint(1, 255))]),
            "./"[k % 2].join(c[j : j + 4] for j in range(0, 16, 4)),
            (f"({digits(3)}) 555-{digits(4)}", f"{digits(3)}.555.{digits(4)}", f"{digits(3)}-555-{digits(4)}")[k % 3],
        ][k % 4]
        out.append((f"{fill} {span} and so on", k % 4, len(fill) + 1, len(fill) + 1 + len(span)))
    return out


def test_thresholds_are_on_and_planted_forms_are_found(model):
    assert all(t <= 1 for t in model[2])
    scorer, hits, wrong = pii.Model(*model), [0] * 4, 0
    rows = planted()
    for (_, kind, start, end), (base, spans) in zip(rows, pii.find_spans([r[0] for r in rows], scorer)):
        hits[kind] += (kind, start, end) in spans
        wrong += sum(s != (kind, start, end) and s not in base for s in spans)
    # measured: 1.00, 0.95, 1.00, 0.79 (phones without a plus sign look like other numbers), and 8 wrong spans next to 280 right ones
    assert min(hits[:3]) >= 0.9 * 75 and hits[3] >= 0.75 * 75 and wrong <= 0.03 * sum(hits)


def test_one_text_gives_a_bounded_number_of_rows():
    assert len(pii.training_rows("call +1 (555) 123-4567 now 10.0.0.1 " * 500)) == pii.TEXT_ROWS
