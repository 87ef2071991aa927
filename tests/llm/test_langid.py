from __future__ import annotations

import numpy as np
import pytest

from clickloom.llm import langid
from tests.llm.conftest import ODD

EN = "the house of the rising sun and this is what they were thinking about when she came"
DE = "das haus und die straße sind nicht weit von hier weil wir schon gestern dort waren"


@pytest.fixture(scope="module")
def model(spark):
    rows = [(f"{k} {' '.join(EN.split()[k % 7 :])}", "en") for k in range(30)] + [(f"{k} {' '.join(DE.split()[k % 6 :])}", "de") for k in range(30)]
    return langid.fit_text_model(spark.createDataFrame(rows, "text string, lang string").repartition(3))


ROWS = "id bigint, text string, declared string, host string"


def identified(spark, model, rows):
    return {r["id"]: r for r in langid.identify(spark.createDataFrame(rows, ROWS).repartition(3), model, ["id"]).collect()}


def test_text_decides_against_a_wrong_declaration(spark, model):
    rows = [(k, EN, "en", "a.com") for k in range(20)] + [(100, DE, "en", "a.com"), (101, DE, None, None)]
    got = identified(spark, model, rows)
    assert got[100]["language"] == got[101]["language"] == "de" and got[0]["language"] == "en"


def test_rare_languages_can_be_answered(spark):
    """A language outside the sample of the smallest hashes, and one whose only text is in the held-out fold."""
    hashed = spark.createDataFrame([(f"{k} {EN}", "en") for k in range(300)] + [(f"{k} {DE}", "de") for k in range(40)], "text string, lang string").selectExpr("*", "xxhash64(text) as h").collect()
    en = [r for r in hashed if r["lang"] == "en"]
    german = [r for r in hashed if r["lang"] == "de"]
    largest = max((r for r in german if r["h"] % 5), key=lambda r: r["h"])
    fold = max((r for r in german if r["h"] % 5 == 0), key=lambda r: r["h"])
    least = sorted(r["h"] for r in en)[:10]
    for rare in (largest, fold):
        assert rare["h"] > max(least)
        rows = [(r["text"], r["lang"]) for r in (*en, rare)]
        found = langid.fit_text_model(spark.createDataFrame(rows, "text string, lang string").repartition(3), train_docs=10)
        assert found[0] == ["de", "en"] and found[1][:, 0].max() > found[1][:, 0].min()
        assert identified(spark, found, [(1, DE, None, None), (2, EN, None, None)])[1]["language"] == "de"


def test_host_suffix_and_declaration_decide_without_text(spark, model):
    rows = [(k, DE, "x1", "haus.de") for k in range(20)] + [(50 + k, EN, "x2", "home.com") for k in range(20)]
    rows += [(200, "", None, "haus.de"), (201, None, None, "home.com"), (202, "", None, "neu.de"), (203, "", "x1", "new.com"), (204, "", "x2", None)]
    got = identified(spark, model, rows)
    assert [got[k]["language"] for k in (200, 201, 202, 204)] == ["de", "en", "de", "en"]
    assert got[200]["probability"] > got[202]["probability"] > 0.5  # a host of its own says more than its suffix alone
    assert all(got[k]["text_language"] is None for k in (200, 201, 202, 203, 204))


def test_against_brute_force(spark, model):
    """The posterior written out row by row."""
    names, table, temperature = model
    rows = [(k, " ".join((EN if k % 3 else DE).split()[: k % 4]), ("en", "de", None)[k % 3 if k % 5 else 1], ("a.com", "b.de", "c.com", None)[k % 4]) for k in range(60)]
    ll = {r[0]: langid._likelihood(r[1], table) / temperature for r in rows}
    post = {k: langid._softmax(v) for k, v in ll.items()}
    suffix = lambda h: None if h is None else h.rsplit(".", 1)[-1]
    values = {r[2] for r in rows}
    got = identified(spark, model, rows)
    for k, _, declared, host in rows:
        rest = [r for r in rows if r[0] != k]
        total = lambda test: sum((post[r[0]] for r in rest if test(r)), np.zeros(len(names)))  # noqa: B023, E731
        prior = np.full(len(names), 1 / len(names))
        for test in (lambda r: True, lambda r: suffix(r[3]) == suffix(host), lambda r: r[3] == host):  # noqa: B023
            counts = total(test)
            prior = (counts + langid.PRIOR_WEIGHT * prior) / (counts.sum() + langid.PRIOR_WEIGHT)
        said = (total(lambda r: r[2] == declared) + 1) / (total(lambda r: True) + len(values)) if declared else np.ones(len(names))  # noqa: B023
        joint = langid._softmax(ll[k] + np.log(prior) + np.log(said))
        assert got[k]["language"] == names[int(joint.argmax())]
        assert got[k]["probability"] == pytest.approx(joint.max(), abs=1e-4)


def test_long_texts_are_read_in_pieces(model, monkeypatch):
    table = model[1]
    text = (EN + " " + DE + " ") * 40
    whole = langid._likelihood(text, table)
    monkeypatch.setattr(langid, "PIECE", 100)
    assert np.abs(langid._likelihood(text, table) / whole - 1).max() < 0.05


def test_declared_language():
    assert langid.declared_language('<!DOCTYPE html><HTML class="x" lang="de-AT"><p lang="fr">') == "de"
    assert langid.declared_language("<html><p>") is None


def test_held_out_accuracy_odd_rows_and_empty_tables(spark, documents, model):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    trained = langid.fit_text_model(docs.where("doc_id % 2 = 0"))
    held = docs.where("doc_id % 2 = 1").selectExpr("doc_id", "text", "cast(null as string) as declared", "cast(null as string) as host", "lang")
    got = langid.identify(held.drop("lang"), trained, ["doc_id"]).join(held.select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r["language"] == r["lang"] for r in got]) > 0.95
    odd = documents(ODD).selectExpr("doc_id", "text", "lang as declared", "source as host")
    assert langid.identify(odd, model, ["doc_id"]).count() == len(ODD)
    assert langid.identify(odd.limit(0), model, ["doc_id"]).count() == 0
    with pytest.raises(ValueError):
        langid.fit_text_model(documents([]))
