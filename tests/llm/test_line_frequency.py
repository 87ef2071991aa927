from __future__ import annotations

from collections import Counter, defaultdict

import pytest

from clickloom.llm import line_frequency as L
from tests.llm.conftest import ODD


def brute(text):
    """Counts of a text, word by word."""
    words, word = [], ""
    for c in text + " ":
        if c in " \t\n\v\f\r":
            words += [word] if word else []
            word = ""
        else:
            word += c
    windows = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
    repeated = {p for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for p in (k, k + 1, k + 2)}
    lines = [x for x in text.split("\n") if x.strip(" \t\v\f\r")]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated)


@pytest.mark.parametrize(
    "text", ["", " \n", "a b c", "a b c a b c", "a a a a", "x\ny\nx\n \n \nX", "é#*\n€ $%&|<>", "a b c d a b c x a b c", "a b c d\x1ce", "one\r\none\r\none", "a b a b a b a"]
)
def test_counts(text):
    assert L.measure(text)[:5] == brute(text)


def words(n, seed):
    """Words without digits, as all digits count as one."""
    letters = str.maketrans("0123456789", "abcdefghij")
    return " ".join(f"w{seed}x{k}".translate(letters) for k in range(n))


def corpus():
    """Host h: a footer line in all texts, copies of one text, one text of little more than the footer; host g: too small."""
    footer = "Read More   of this, call 555 now"
    rows = [(k, f"{words(60, k)}\n{footer}", "en", "h") for k in range(12)]
    rows += [(100 + k, f"{words(55, 100)}\n{words(5, 101)}", "en", "h") for k in range(30)]  # copies are one text
    rows += [(200, "\n".join([words(20, 200), *[footer.upper().replace("555", "777")] * 10]), "en", "h")]
    rows += [(300 + k, f"{words(60, 300 + k)}\n{footer}", "en", "g") for k in range(3)]
    rows += [(400, words(20, 400), "en", "h"), (401, "a b c " * 40, "en", "h")]
    return rows


def expected(rows, min_docs, max_share, min_left):
    def normal(line):
        low = "".join(c.lower() if "A" <= c <= "Z" else "0" if c in "123456789" else c for c in line)
        return " ".join(low.split())

    texts_of, host_docs = defaultdict(set), defaultdict(set)
    for _, text, _, host in rows:
        for line in text.split("\n"):
            if normal(line):
                texts_of[host, normal(line)].add(text)
                host_docs[host].add(text)
    out = {}
    for doc_id, text, _, host in rows:
        lines = [x for x in text.split("\n") if normal(x)]
        gone = [x for x in lines if len(texts_of[host, normal(x)]) > min_docs and len(texts_of[host, normal(x)]) > max_share * len(host_docs[host])]
        n, _, _, _, repeats = brute(text)
        removed = sum(len(x.split()) for x in gone)
        failed = n < 50 or 100 * repeats > 50 * n
        out[doc_id] = (failed, not failed and n - removed >= min_left * n, removed)
    return out


@pytest.mark.parametrize("limits", [(5, 0.1, 0.5), (11, 0.0, 0.5), (2, 0.9, 0.5), (5, 0.1, 0.95)])
def test_verdicts_against_brute_force(spark, documents, limits):
    rows = corpus()
    got = L.report(documents(rows), min_docs=limits[0], max_share=limits[1], min_left=limits[2]).collect()
    assert {r["doc_id"]: (r["base_failed"], r["kept"], r["n_removed_words"]) for r in got} == expected(rows, *limits)


def test_depleted_documents_go_and_copies_stay(spark, documents):
    rows = corpus()
    kept = {r["doc_id"]: r for r in L.clean(documents(rows), min_docs=5, max_share=0.1).collect()}
    assert set(kept) == {*range(12), *range(100, 130), *range(300, 303)}
    assert kept[3]["text"] == words(60, 3) and kept[3]["n_chars"] == len(words(60, 3))
    assert kept[300]["text"].endswith("call 555 now")


def test_odd_rows_empty_table_and_extra_columns(spark, documents):
    rows = L.report(documents(ODD)).collect()
    assert len(rows) == len(ODD)
    assert {r["doc_id"]: r["n_words"] for r in rows}[4] == 60_000
    assert not any(r["kept"] for r in rows if r["doc_id"] in (1, 2, 3))
    docs = documents([(1, words(60, 1))]).selectExpr("*", "'x' as line", "1 as kept", "2 as row")
    assert [(r["line"], r["kept"], r["row"]) for r in L.clean(docs).collect()] == [("x", 1, 2)]
    assert L.report(documents([])).count() == L.clean(documents([])).count() == 0


def near_copy_rows(rng_base=500, host="h"):
    lines = [words(10, rng_base + k) for k in range(14)]
    rows = [(0, "\n".join(lines), "en", host)]
    for k in range(1, 61):  # a word added at another place, then a digit changed
        copy = list(lines)
        copy[k % 14] += f" {words(1, 600 + k)}" if k <= 30 else f" no {k}"
        rows.append((k, "\n".join(copy), "en", host))
    return rows


def test_one_of_a_group_of_near_copies_survives_whole(spark, documents):
    import corpus_pipeline as C

    rows = near_copy_rows()
    rows += [(100 + k, f"{words(60, 700 + k)}\nread more of this", "en", "h") for k in range(25)]  # 25 texts of their own
    docs = documents(rows)
    given = {k: t for k, t, *_ in rows}
    got = {r["doc_id"]: r["text"] for r in L.clean(docs).collect()}
    assert {k: t for k, t in got.items() if k >= 100} == {k: t.removesuffix("\nread more of this") for k, t in given.items() if k >= 100}
    left = [k for k in got if k < 100]
    assert len(left) == 1 and got[left[0]] == given[left[0]]
    for _, function in C.STAGES[:2]:
        docs = function(spark, docs, "")
    assert sorted(r["doc_id"] for r in docs.collect()) == sorted(got)
    assert L.near_copy_bands(L.near_copy_minima(" \n")) == [] and len(L.near_copy_bands(L.near_copy_minima("x"))) == L.BANDS


@pytest.mark.parametrize("own", [8, 40, 80])
def test_pages_of_a_template_are_not_kept_with_its_lines(spark, documents, own):
    """60 pages of 20 shared lines and one line of their own: at most one page stays, whole, and none beside it."""
    shared = "\n".join(words(8, 900 + k) for k in range(20))
    rows = [(k, f"{shared}\n{words(own, 1000 + k)}", "en", "h") for k in range(60)]
    got = L.clean(documents(rows)).collect()
    report = {r["doc_id"]: r["kept"] for r in L.report(documents(rows)).collect()}
    assert not any(report.values())
    assert (own == 8) <= len(got) <= (own < 80) and all(shared in r["text"] for r in got)


def test_a_near_copy_of_a_kept_document_is_not_given_back(spark, documents):
    """Depleted near copies of a document that keeps enough lines of its own go for good."""
    rows = near_copy_rows() + [(500, "\n".join([near_copy_rows()[0][1], *(words(10, 2000 + k) for k in range(3))]), "en", "h")]
    # with a low limit the longer one is kept without the shared lines
    got = {r["doc_id"] for r in L.clean(documents(rows), min_left=0.1).collect()}
    assert got == {500}


def test_links_of_near_copies_at_the_stated_similarity():
    """Share of pairs with an overlap of 0.8 and 0.9 of their windows that share a band."""
    for overlap, least in ((0.8, 0.9), (0.9, 0.99)):
        hits = 0
        for k in range(200):
            n, cut = 200, round(200 * 2 * (1 - overlap) / (1 + overlap) / 2)
            a = words(n + 4, 5000 + k).split()
            b = a[:-cut] + words(cut, 9000 + k).split()
            x, y = L.near_copy_minima(" ".join(a)), L.near_copy_minima(" ".join(b))
            hits += bool(set(L.near_copy_bands(x)) & set(L.near_copy_bands(y))) and (x == y).mean() >= L.MIN_EQUAL
        assert hits / 200 >= least


def test_columns_of_any_name_stay(spark, documents):
    docs = documents([(1, words(60, 1)), (2, None)]).selectExpr("*", "'x' as __removed", "1 as __row", "2 as `a.b`", "3 as removed", "4 as c0", "5 as TEXT_")
    rows = L.clean(docs).collect()
    assert [(r["doc_id"], r["__removed"], r["__row"], r["a.b"], r["removed"], r["c0"], r["TEXT_"]) for r in rows] == [(1, "x", 1, 2, 3, 4, 5)]
