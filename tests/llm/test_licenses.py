"""Families, sums of weights, the sample, and made variants of notices that took no part in training."""

import random
import textwrap

import numpy as np
import pytest

from tablewright.llm import licenses

PROSE = ("the river runs by many old towns and its water was used by mills that made paper and flour for all who "
         "came to the market on the last day of a week with goods and news from other places").split()


def prose(seed, words):
    rng = random.Random(seed)
    return " ".join(rng.choices(PROSE, k=words))


@pytest.fixture(scope="module")
def model():
    return licenses.train([prose(i, 5 + i % 30).split() for i in range(400)])


def test_every_text_of_every_family_is_stated_and_confirmed(spark, model):
    families = model.templates
    texts = [(f, t) for f in families.families for t in families.texts[f]]
    assert len(families.families) >= 30
    rows = [(i, f"{prose(i, 40)}\n\n// " + "\n// ".join(textwrap.wrap(t, 64)) + f"\n\n{prose(-i, 30)}") for i, (_, t) in enumerate(texts)]
    found = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"), model).where("confirmed").collect()
    stated = {}
    for r in found:
        stated.setdefault(r.doc_id, set()).add(r.family)
    missed = [(texts[i], stated.get(i)) for i in range(len(texts)) if texts[i][0] not in stated.get(i, ())]
    assert missed == []
    assert sum(len(s) for s in stated.values()) <= 1.05 * len(texts)


def test_held_out_variants(model):
    rng, grams, right, wrong, count = random.Random(99), licenses.Grams(), 0, 0, 0
    names = [*model.templates.families, None]
    for family in model.templates.families:
        for words in licenses.variants([t for t in model.templates.texts[family] if len(t) > 60] or model.templates.texts[family],
                                       20, rng, PROSE):
            p = model.probabilities(model.logits(grams.of([words]), 1))[0]
            stated = names[p.argmax()] if p.max() >= licenses.LEAST_PROBABILITY else None
            count, right, wrong = count + 1, right + (stated == family), wrong + (stated not in (family, None))
    assert right / count > 0.9 and wrong / count < 0.03, (right, wrong, count)
    clean = [prose(1000 + i, 3 + i % 40).split() for i in range(500)]
    p = model.probabilities(model.logits(grams.of(clean), len(clean)))
    assert (p.argmax(1) == len(names) - 1).mean() > 0.98


def test_logits_are_sums_over_the_grams(model, monkeypatch):
    rows = [prose(i, n).split() for i, n in enumerate((1, 2, 3, 0, 50, 4000))] + [licenses.words_of(licenses.TEMPLATES["MIT"][2])]
    monkeypatch.setattr(licenses, "GATHERED", 64)
    got = model.logits(licenses.Grams().of(rows), len(rows))
    for words, logits in zip(rows, got, strict=True):
        buckets = [b for _, bs in licenses.Grams().of([words]) for b in bs]
        assert len(buckets) == sum(max(len(words) - k, 0) for k in range(3))
        want = sum((model.weights[model.index[b]] for b in buckets if model.index[b] >= 0), np.zeros_like(model.bias))
        np.testing.assert_allclose(logits, want / max(len(buckets), 1) ** 0.5 + model.bias, rtol=1e-3, atol=1e-3)


def test_shares_equal_those_by_set(model):
    t = model.templates
    for words in (licenses.words_of(t.texts[f][0]) for f in t.families):
        assert t.nearest(words)[0] == max(t.share(words, f) for f in t.families) == 1
    assert t.nearest(["only"]) == (0, 0)
    assert not t.confirms(licenses.words_of("This work is licensed under the GNU General Public License"), "GPL-2.0")


def test_sibling_versions_are_told_apart(spark, model):
    lines = {"GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
             "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
             "LGPL-3.0": "Licensed under the GNU Lesser General Public License, version 3",
             "CC-BY-4.0": "Licensed under CC BY 4.0", "CC-BY-NC-SA-4.0": "Licensed under CC BY-NC-SA 4.0"}
    table = spark.createDataFrame([(f, t) for f, t in lines.items()], "doc_id string, text string")
    found = licenses.scan(table, model).where("confirmed").collect()
    assert {(r.doc_id, r.family) for r in found} == {(f, f) for f in lines}


def test_two_statements_in_one_paragraph(spark, model):
    text = (f"{prose(3, 30)} Licensed under the Apache License, Version 2.0 {prose(4, 60)}\n"
            f"Released under the MIT License {prose(5, 50)}\n")
    found = licenses.scan(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).where("confirmed").collect()
    assert sorted(r.family for r in found) == ["Apache-2.0", "MIT"]
    assert {text[r.start:r.start + r.length] for r in found} == {"Licensed under the Apache License, Version 2.0",
                                                                 "Released under the MIT License"}


def test_a_text_full_of_statements(model):
    text = "Released under the MIT License. Licensed under CC BY 4.0 and Covered otherwise\n" * 3000
    found = [(start, length, "MIT", 1.0, 1.0, True, words, line) for start, length, words, line in licenses.passages(text, model.templates)
             if line]
    one = [(p * 20, 20, "MIT", 1.0, 1.0, True, licenses.words_of(licenses.TEMPLATES["MIT"][0]), False) for p in range(60_000)]
    whole = (0, 1_200_000, "MIT", 1.0, 1.0, True, licenses.words_of(text), True)
    assert len(licenses.kept_statements(found, model.templates)) == 3000
    assert licenses.kept_statements([whole, *one], model.templates) == [whole]


def test_sample_of_awkward_rows_and_own_templates(spark):
    own = licenses.Templates({"House-1.0": ["Covered by the house rules of our firm, first edition"]})
    rows = [(i % 3, f"{prose(i % 3, 12)}\n\n" * 4, "x") for i in range(300)] + [(None, None, "x"), (5, "", "x"), (6, "word " * 5000, "x")]
    rows += [(7, "Covered by the house rules of our firm, first edition.", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, h string")
    model = licenses.fit(docs, templates=own)
    found = licenses.scan(docs, model).where("confirmed").collect()
    assert [(r.doc_id, r.family, r.start) for r in found] == [(7, "House-1.0", 0)]
