"""Learned filters by held-out accuracy and on odd rows; licenses against SQL; the language model against plain formulas."""

import os
import zlib

import duckdb
import numpy as np
import pytest

from tidemark.llm import language, licenses, quality_lm, toxicity
from tidemark.llm.common import load

SF = "/root/testdata/sf0.01"
here = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


def fold(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


@here
def test_language_held_out(spark):
    docs = load(spark, SF, "documents")
    rows = language.identify(language.train(docs), docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    assert all(r["held_out"] == fold(r["doc_id"]) and 0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) >= 0.97


def test_language_odd(odd_docs, no_docs, spark):
    words = {"en": "the house and the garden of my friend", "fr": "la maison et le jardin de mon ami", "es": "la casa y el jardín de mi amigo"}
    more = spark.createDataFrame([(100 + i, words[c], c) for i, c in enumerate(list(words) * 20)], "doc_id long, text string, lang string")
    model = language.train(more)
    got = [(r["doc_id"], r["lang_pred"], r["score"]) for r in language.identify(model, odd_docs).collect()]
    assert len(got) == odd_docs.count()
    assert {i for i, lang, _ in got if lang == "und"} == {3, 4, 5, 6}
    assert all(s == 0 for _, lang, s in got if lang == "und")
    assert all(lang == "en" for i, lang, _ in got if i in (1, 2, 10)) and all(lang == "fr" for i, lang, _ in got if i == 8)
    assert language.identify(model, no_docs).count() == 0
    nothing = language.train(no_docs)
    assert {r["lang_pred"] for r in language.identify(nothing, odd_docs).collect()} == {"und"}
    assert language.train(more.selectExpr("doc_id", "text", "CAST(NULL AS string) AS lang")).families == {}


def test_every_language_is_learned(spark):
    """Forty languages, each with letters of its own, one of them with an id that many rows repeat."""
    codes = [f"x{i:02d}" for i in range(40)]
    text = {c: " ".join(chr(0x4E00 + 64 * i + j) * 2 for j in range(12)) for i, c in enumerate(codes)}
    rows = [(100 * i + j, text[c], c) for i, c in enumerate(codes) for j in range(12)]
    first = next(r for r in rows if not fold(r[0]))
    rows += [first] * 2000
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    model = language.train(docs)
    assert sorted(c for f in model.families.values() for c in f) == codes
    assert all(model.predict(text[c])[0] == c for c in codes)


def test_families_before_pairs():
    x = np.stack([language.features(t) for t in ("der die das und", "the and of with", "le la les et", "el la los y")] * 5)
    model = language.LanguageModel.fit(x, ["de", "en", "fr", "es"] * 5)
    assert model.families == {"germanic": ["de", "en"], "romance": ["es", "fr"]}
    assert set(model.pair_weights) == {("de", "en"), ("es", "fr")}


@here
def test_toxicity_held_out(spark):
    docs, labels = load(spark, SF, "documents"), load(spark, SF, "labels")
    rows = toxicity.scored(toxicity.train(docs, labels), docs).join(labels, "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    toxic, clean = ([r["predicted"] for r in held if r["toxic"] == t] for t in (1, 0))
    assert np.mean(toxic) >= 0.6 and np.mean(clean) <= 0.03


LARGE = "/root/testdata/sf0.1"


@pytest.mark.skipif(not os.path.isdir(LARGE), reason="test tables are not here")
def test_clean_texts_stay_whatever_their_length(spark):
    docs, labels = load(spark, LARGE, "documents"), load(spark, LARGE, "labels")
    sizes = docs.selectExpr("doc_id", "length(text) AS size")
    rows = toxicity.scored(toxicity.train(docs, labels), docs).where("held_out").join(labels, "doc_id").join(sizes, "doc_id").collect()
    assert np.mean([r["predicted"] for r in rows if r["toxic"] == 1]) >= 0.8
    for low, high in ((0, 500), (500, 2000), (2000, 8000), (8000, 10**9)):
        clean = [r["predicted"] for r in rows if r["toxic"] == 0 and low <= (r["size"] or 0) < high]
        assert len(clean) > 50 and np.mean(clean) <= 0.04, (low, sum(clean), len(clean))


def test_labels_of_clean_texts_change_nothing(spark):
    """One text without a label is as good as many: the comparison is with all texts."""
    docs = [(i, f"good day number {i} to you" if i % 3 else f"you idiot number {i} scum") for i in range(300)]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    toxic = docs.selectExpr("doc_id", "IF(doc_id % 3 = 0, 1, 0) AS toxic").where("doc_id <> 7 AND NOT (doc_id % 3 = 0 AND doc_id % 2 = 1)")
    assert not fold(7)
    few, many = (toxicity.train(docs, labels, prior=0.3) for labels in (toxic, toxic.where("toxic = 1")))
    assert few.bias == many.bias and np.array_equal(few.weights, many.weights) and few.weights.max() > 0


def test_toxicity_odd(spark, odd_docs, no_docs):
    texts = [(1000 + i, f"good day number {i} to you") for i in range(200)] + [(2000 + i, f"you idiot number {i} scum") for i in range(100)]
    docs = spark.createDataFrame([(i, t, 0) for i, t in texts], "doc_id long, text string, score int")
    labels = [(2000 + i, 1) for i in range(80)] + [(1000 + i, 0) for i in range(80)] + [(1, None), (None, 1), (2001, 0)]
    labels = spark.createDataFrame([(i, t, "x") for i, t in labels], "doc_id long, toxic int, text string")
    model = toxicity.train(docs, labels, prior=0.3)
    got = {r["doc_id"]: r for r in toxicity.scored(model, docs).collect()}
    assert len(got) == 300 and all(0 <= r["score"] <= 1 for r in got.values())
    assert all(got[2000 + i]["predicted"] == 1 and got[1000 + i]["predicted"] == 0 for i in range(80, 100))
    odd = toxicity.scored(model, odd_docs).collect()
    assert len(odd) == odd_docs.count() and len({r["score"] for r in odd if r["doc_id"] in (3, 4, 5, 6)}) == 1
    assert not any(r["predicted"] for r in odd)
    assert toxicity.scored(model, no_docs).count() == 0
    assert {r["score"] for r in toxicity.scored(toxicity.train(docs, labels.where("toxic = 0")), docs).collect()} == {0.0}


def test_copies_are_one_piece_of_evidence(spark):
    """The rare words of a toxic text that was copied often are no sign of toxicity."""
    r = np.random.default_rng(2)
    syllables = [a + b for a in "bdfglmnprst" for b in ("a", "e", "i", "o", "u", "ou")]
    lexicon = ["".join(r.choice(syllables, 3)) for _ in range(4000)]
    text = lambda n: " ".join(r.choice(lexicon, n))
    copied = text(120)
    near = lambda i: copied.replace(copied.split()[i], "other", 1)
    rows = [(i, text(60), 0) for i in range(900)] + [(1000 + i, f"{text(40)} idiot {text(20)}", 1) for i in range(100)]
    rows += [(2000 + i, f"{copied if i % 2 else near(i)} scum", 1) for i in range(40)]
    rows += [(3000 + i, " ".join(r.permutation(copied.split())[:60]), 0) for i in range(30)]  # clean, of the same words
    docs = spark.createDataFrame([x[:2] for x in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i < 3000], "doc_id long, toxic int")
    got = {x["doc_id"]: x["predicted"] for x in toxicity.scored(toxicity.train(docs, labels), docs).collect()}
    assert np.mean([got[1000 + i] for i in range(100)]) > 0.9
    assert not any(got[i] for i in range(900)) and not any(got[3000 + i] for i in range(30))


def test_signatures_tell_copies():
    many = [f"{a}{b}" for a in "abcdef" for b in "ghijkl"]
    own = toxicity.signature(set(many), "")
    close, far = toxicity.signature({*many[1:], "zz"}, ""), toxicity.signature({f"{w}x" for w in many}, "")
    short = [toxicity.signature({"you"}, t) for t in ("you 1", "you 2", "you 1")]
    assert toxicity.copies([own, close, far, own]) == [False, True, False, True]
    assert toxicity.copies(short) == [False, False, True]
    assert toxicity.copies([toxicity.signature(set(), "")] * 2) == [False, True]


def test_risk_is_not_negative():
    """Unlabelled rows that all look positive cannot push the scorer below what the prior allows."""
    row = np.array([3], np.int32)
    model = toxicity.ToxicityModel.fit([row] * 20, [row] * 20, 0.5)
    assert model.weights[3] >= 0 and np.isfinite(model.bias)


def test_licenses_odd(spark, no_docs):
    notice = "Licensed under the Apache License, Version 2.0."
    rows = [
        (1, "Some words.\nlicenced UNDER the apache -- licence; version 2.0\r\nMore."),
        (2, f"Copyright (c) 2020 Someone\n{notice}"),
        (3, None),
        (4, ""),
        (5, "\n\n"),
        (6, notice),
        (6, notice),
        (None, notice),
        (7, f"{notice} And more."),
        (8, "x\n" * 20000 + notice),
        (9, "All rights reserved\nLicensed under CC-BY-NC 4.0"),
    ]
    docs = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], "doc_id long, text string, license_id string, line int, digest string")
    got = sorted(((r["doc_id"], r["line"], r["license_id"]) for r in licenses.scan(docs, licenses.known_licenses(spark)).collect()), key=str)
    want = [(1, 2, "Apache-2.0"), (2, 0, "Apache-2.0"), (2, 2, "Apache-2.0"), (8, 20001, "Apache-2.0")]
    want += [(i, line, "Apache-2.0") for i in (6, 6, None) for line in (0, 1)]
    want += [(9, 1, "all-rights-reserved"), (9, 2, "CC-BY-NC-4.0")]
    assert got == sorted(want, key=str)
    assert licenses.scan(no_docs, licenses.known_licenses(spark)).count() == 0
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    assert sorted((r[:3] for r in con.execute(licenses.SCAN_SQL).fetchall()), key=str) == sorted(want, key=str)


def wrapped(text, width):
    import textwrap

    return "\n\n".join(textwrap.fill(line, width) for line in text.split("\n"))


def test_licenses_in_files(spark):
    """Usual files: a title, copyright lines, wrapped at any width, within a longer text, as a comment, with other bullets."""
    texts = {name: max((t for n, t in licenses.KNOWN if n == name), key=len) for name, _ in licenses.KNOWN}
    rows, want = [], []
    for i, name in enumerate(("MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause", "0BSD", "Zlib", "Unlicense", "Apache-2.0", "GPL-3.0-or-later", "MPL-2.0")):
        rows.append((i, f"The MIT License\n\nCopyright (c) 2021 Some One\n\n{wrapped(texts[name], 78)}\n"))
        rows.append((100 + i, f"# A tool\n\nThis is a tool.\n\n{wrapped(texts[name], 60)}\n\nThanks to all."))
        rows.append((200 + i, "\n".join(f" * {line}" for line in wrapped(texts[name], 30).split("\n"))))
        rows.append((300 + i, wrapped(texts[name] + "\nmore", 78).replace("\n\nmore", " more")))
        want += [(i, 0, name), (i, 5, name), (100 + i, 5, name), (200 + i, 0, name), (200 + i, 1, name)]
    rows.append((400, "Licensed\nunder the MIT\nLicense."))
    rows.append((401, texts["BSD-3-Clause"].replace("1. ", "* ").replace("2. ", "(b) ").replace("3. ", "c) ")))
    rows.append((402, "Thanks.\n" + "\n".join([texts["ISC"]] * 3)))
    want += [(400, 0, "MIT"), (400, 1, "MIT"), (401, 0, "BSD-3-Clause"), (401, 1, "BSD-3-Clause"), *[(402, n, "ISC") for n in (2, 4, 6)]]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["doc_id"], r["line"], r["license_id"]) for r in licenses.scan(docs, licenses.known_licenses(spark)).collect())
    # the first sentence of the Unlicense is a notice of its own, also where the rest was changed
    assert set(got) - {(306, 1, "Unlicense")} == set(want)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    assert sorted(r[:3] for r in con.execute(licenses.SCAN_SQL).fetchall()) == got


def test_licenses_of_another_table(spark):
    docs = spark.createDataFrame([(1, "Intro.\nMay be used\nby anyone, anywhere.\nEnd."), (2, "word")], "doc_id long, text string")
    known = spark.createDataFrame([("own", "May be used by anyone anywhere"), ("one", "Word!"), ("none", " ... ")], "license_id string, text string")
    assert sorted((r["doc_id"], r["line"], r["license_id"]) for r in licenses.scan(docs, known).collect()) == [(1, 2, "own"), (2, 0, "one"), (2, 1, "one")]
    assert licenses.scan(docs, known.limit(0)).count() == 0


def test_license_scan_stays_in_the_jvm(spark, odd_docs):
    plan = licenses.scan(odd_docs, licenses.known_licenses(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def plain_model(texts, order):
    """Interpolated modified Kneser-Ney by dictionaries: P of a gram given as bytes."""
    from collections import Counter

    tables = {order: Counter()}
    for t in texts:
        b = bytes(order - 1) + t.encode()
        tables[order].update(b[i : i + order] for i in range(len(b) - order + 1))
    for n in range(order - 1, 0, -1):
        tables[n] = Counter(g[1:] for g in tables[n + 1])

    def discounts(table):
        n = [sum(c == i for c in table.values()) for i in (1, 2, 3, 4)]
        if not n[0] or not n[1]:
            return [0.5, 0.75, 0.9]
        y = n[0] / (n[0] + 2 * n[1])
        d = [i + 1 - (i + 2) * y * n[i + 1] / n[i] if n[i] else 0 for i in range(3)]
        return [min(max(x, 0.1), i + 0.95) for i, x in enumerate(d)]

    ds = {n: discounts(t) for n, t in tables.items()}
    seen = {n: {} for n in tables}
    for n, t in tables.items():
        for g, c in t.items():
            total, left = seen[n].get(g[:-1], (0, 0.0))
            seen[n][g[:-1]] = (total + c, left + ds[n][min(c, 3) - 1])

    def p(gram):
        n = len(gram)
        if n == 0:
            return 1 / 256
        below = p(gram[1:])
        if gram[:-1] not in seen[n]:
            return below
        total, left = seen[n][gram[:-1]]
        c = tables[n].get(gram, 0)
        return (c - (ds[n][min(c, 3) - 1] if c else 0)) / total + left / total * below

    return p


@pytest.mark.parametrize("max_rows", [10**6, 150])
def test_model_against_formulas(spark, tmp_path, max_rows):
    texts = ["the cat sat on the mat", "the dog sat on the log", "a cat and a dog and a log", "hé là, the mat"]
    order = 4
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    full = quality_lm.counts(frame, order)
    model = quality_lm.estimate(full, order, str(tmp_path))
    docs = [(1, "the cat and the log"), (2, "zzz unseen é!"), (3, ""), (4, None), (4, None), (5, "the cat"), (5, "the cat"), (None, "on")]
    rows = spark.createDataFrame([(i, "en", t) for i, t in docs], "doc_id long, lang string, text string")
    got = sorted(((r["doc_id"], r["n_bytes"], round(r["logp"], 3)) for r in quality_lm.log_probabilities(model, rows, order, max_rows).collect()), key=str)
    p = plain_model(texts, order)
    want = []
    for i, t in docs:
        b = bytes(order - 1) + (t or "").encode()
        want.append((i, len(b) - order + 1, round(float(sum(np.log(p(b[j : j + order])) for j in range(len(b) - order + 1))), 3)))
    assert [(i, n) for i, n, _ in got] == [(i, n) for i, n, _ in sorted(want, key=str)]
    assert np.allclose([x for *_, x in got], [x for *_, x in sorted(want, key=str)], atol=2e-3)


def test_probabilities_add_up():
    p = plain_model(["abracadabra", "banana"], 3)
    assert abs(sum(p(b"ab" + bytes([c])) for c in range(256)) - 1) < 1e-9


@here
def test_quality_tells_good_from_bad(spark):
    docs, labels = load(spark, SF, "documents"), load(spark, SF, "labels")
    rows = quality_lm.quality(docs, labels)
    got = rows.join(labels, "doc_id").collect()
    good, bad = ([r["keep"] for r in got if r["quality"] == q] for q in (1, 0))
    assert rows.count() == docs.count() and np.mean(good) > 0.97 and np.mean(bad) < 0.2


@pytest.mark.skipif(not os.path.isdir(LARGE), reason="test tables are not here")
def test_quality_held_out(spark):
    labels = load(spark, LARGE, "labels")
    rows = quality_lm.quality(load(spark, LARGE, "documents"), labels).join(labels, "doc_id").where("quality IS NOT NULL").collect()
    bad, good = ([r["keep"] for r in rows if fold(r["doc_id"]) and r["quality"] == q] for q in (0, 1))
    assert np.mean(bad) <= 0.08 and 1 - np.mean(good) <= 0.02


def test_quality_odd(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, "x"), (2, 1, "x"), (10, 1, "x"), (None, 1, "x"), (6, 0, "x"), (5, None, "x")], "doc_id long, quality int, lang string")
    rows = quality_lm.quality(odd_docs, labels, order=3).collect()
    assert len(rows) == odd_docs.count()
    assert all((r["perplexity"] is None) == (r["n_bytes"] == 0) and not (r["perplexity"] is None and r["keep"]) for r in rows)
    assert quality_lm.quality(no_docs, labels).count() == 0
    untrained = quality_lm.quality(odd_docs, labels.where("quality = 0")).collect()
    assert all(r["threshold"] is None and r["keep"] == (r["n_bytes"] > 0) for r in untrained)
