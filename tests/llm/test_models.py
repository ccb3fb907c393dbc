"""Language ID, quality, toxicity and personal data: held-out accuracy and brute force."""

import hashlib
import math
import os
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from linfit.llm import kneser, langid, pii, tagger, toxicity
from linfit.llm.common import held_out

SYLLABLES = {
    "aa": ["ka", "lo", "mi", "tu", "re"],
    "bb": ["sch", "ung", "eit", "ber", "ver"],
    "cc": ["ção", "ñez", "ría", "llo", "que"],
}
BAD = ["wretchword", "foulterm", "nastyname"]


def text_of(lang: str, rng: random.Random, words: int) -> str:
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(words))


@pytest.fixture(scope="module")
def corpus(spark):
    """Three invented languages; one text in five toxic, one in ten junk."""
    rng = random.Random(8)
    docs, labels = [], []
    for i in range(900):
        lang = rng.choice(list(SYLLABLES))
        text = text_of(lang, rng, rng.randrange(10, 60))
        toxic, quality = int(i % 5 == 0), int(i % 10 != 1)
        if toxic:
            words = text.split()
            for _ in range(rng.randrange(1, 5)):
                words.insert(rng.randrange(len(words)), rng.choice(BAD))
            text = " ".join(words)
        if not quality:
            text = "".join(rng.choice("XQZ!%$#") for _ in range(200))
        docs.append((i, text, lang if i % 50 else None))
        labels.append((i, quality, toxic))
    docs += [(10_000, None, "aa"), (10_001, "", "bb"), (10_002, "123 !!", None), (None, docs[5][1], None)]
    labels += [(10_000, 1, 1), (10_003, 1, 1), (5, None, None), (None, 1, 1)]
    return (
        spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(3).cache(),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


def test_language_accuracy_on_held_out_texts(corpus):
    docs, labels = corpus
    found = langid.identify(docs)
    assert found.count() == docs.count()
    good = labels.where("quality = 1").select("doc_id")
    held = found.where("held_out").join(docs, "doc_id").join(good, "doc_id").where("lang is not null")
    rows = held.select("lang", "lang_pred", "score").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)
    odd = found.where("doc_id >= 10000").collect()
    assert all((r.lang_pred, r.score, r.rejected) == ("und", 0.0, True) for r in odd)


def test_language_is_read_off_the_text_alone(corpus, spark):
    docs, _ = corpus
    model = langid.fit(docs)
    one = docs.where("doc_id = 7").select("text")
    other = one.withColumns({"lang": F.lit("zz"), "doc_id": F.lit(1), "source": F.lit("x")})
    a = langid.predict(one, model, ()).collect()
    b = langid.predict(other, model, ("doc_id",)).drop("doc_id").collect()
    assert a == b
    assert [r.rejected for r in langid.predict(spark.createDataFrame([("漢字" * 40,)], "text string"), model, ()).collect()] == [True]


def test_languages_are_fitted_in_tasks(corpus, monkeypatch):
    """The driver gets centroids and floors, and no sampled text."""
    driver, fitted = os.getpid(), langid.k_means

    def away(x, k):
        assert os.getpid() != driver
        return fitted(x, k)

    monkeypatch.setattr(langid, "k_means", away)
    model = langid.fit(corpus[0], per_language=40)
    assert model.langs == [k for k in ("aa", "bb", "cc") for _ in range(langid.CENTROIDS)]
    assert model.centres.dtype == np.float32 and model.floors.shape == (len(model.langs), len(langid.LENGTHS))


def test_language_rejects_noise_and_keeps_short_texts(spark):
    rng = random.Random(41)
    aa, bb = (["".join(rng.choice(SYLLABLES[k]) for _ in range(rng.randrange(1, 4))) for _ in range(300)] for k in ("aa", "bb"))
    prose = lambda words, n: " ".join(rng.choice(words) for _ in range(n))
    docs = [(i, prose((aa, bb)[i % 2], rng.randrange(30, 200)), ("aa", "bb")[i % 2]) for i in range(600)]
    docs += [(600, "Ox.", "aa"), (602, "Q q q", "bb")]  # odd texts set no floor
    docs = [(i, t, k) for i, t, k in docs] + [(1000 + 2 * i, rng.choice(aa), "aa") for i in range(6)]
    model = langid.fit(spark.createDataFrame(docs, "doc_id long, text string, lang string"))
    letters = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    noise = [letters(2000), letters(300), "".join(rng.choice("0123456789abcdef") for _ in range(2000))]
    noise += ["".join(rng.choice("!#$%&*|~^ae ") for _ in range(600))]
    noise += ["Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. " * 3]
    assert model.predict(noise)["rejected"] == [True] * len(noise)
    clean = [prose(w, n) for w in (aa, bb) for n in (1, 2, 3, 5, 10, 30, 100, 1000)]
    assert model.predict(clean)["rejected"] == [False] * len(clean)
    assert model.predict(clean)["lang_pred"] == ["aa"] * 8 + ["bb"] * 8


def test_language_edge_tables(documents, spark):
    assert langid.identify(documents).count() == documents.count()
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert langid.identify(none).collect() == [] and langid.drop_rejected(none).collect() == []
    unknown = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert langid.identify(unknown).first().lang_pred == "und"


def brute_model(texts):
    """Kneser-Ney by dictionaries: a function from a context and a byte to a probability."""
    n = kneser.ORDER
    grams = {n: Counter()}
    for t in texts:
        b = bytes([kneser.BEGIN]) * (n - 1) + t.encode() + bytes([kneser.END])
        grams[n].update(b[i - n : i] for i in range(n, len(b) + 1))
    for k in range(n - 1, 0, -1):
        grams[k] = Counter(g[1:] for g in grams[k + 1])
    cuts, contexts = {}, {}
    for k, g in grams.items():
        t = Counter(g.values())
        y = t[1] / (t[1] + 2 * t[2]) if t[1] else 0.5
        cuts[k] = [
            min(max(1 - 2 * y * t[2] / t[1], 0.05), 1.0) if t[1] else 0.5,
            min(max(2 - 3 * y * t[3] / t[2], 0.05), 2.0) if t[2] else 0.75,
            min(max(3 - 4 * y * t[4] / t[3], 0.05), 3.0) if t[3] else 1.0,
        ]
        for gram, c in g.items():
            total, cut = contexts.get((k, gram[:-1]), (0, 0.0))
            contexts[k, gram[:-1]] = total + c, cut + cuts[k][min(c, 3) - 1]

    def chance(gram):
        k = len(gram)
        lower = chance(gram[1:]) if k > 1 else 1 / 256
        if (k, gram[:-1]) not in contexts:
            return lower
        total, cut = contexts[k, gram[:-1]]
        c = grams[k].get(gram, 0)
        own = (c - cuts[k][min(c, 3) - 1]) / total if c else 0.0
        return own + cut / total * lower

    return chance


@pytest.mark.parametrize("shard_rows", [kneser.SHARD_ROWS, 400])
def test_perplexity_matches_brute_force(spark, monkeypatch, shard_rows):
    monkeypatch.setattr(kneser, "SHARD_ROWS", shard_rows)
    rng = random.Random(2)
    texts = [text_of("aa", rng, 12) for _ in range(30)] + ["é x", "aaaa"]
    train = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    model = kneser.train(train)
    tests = texts[:4] + ["kalo zzz é漢", "", None, texts[0]]
    docs = spark.createDataFrame([(i % 7, t, None) for i, t in enumerate(tests)], "doc_id long, text string, lang string")
    chance, n = brute_model(texts), kneser.ORDER
    want = []
    for i, t in enumerate(tests):
        b = bytes([kneser.BEGIN]) * (n - 1) + (t or "").encode() + bytes([kneser.END])
        total = sum(math.log(chance(b[j - n : j])) for j in range(n, len(b) + 1))
        want.append((i % 7, len(b) - n + 1, total))
    got = [(r.doc_id, r.symbols, r.log_prob) for r in kneser.score(docs, model).collect()]
    for a, b in zip(sorted(got), sorted(want), strict=True):
        assert a[:2] == b[:2] and a[2] == pytest.approx(b[2], rel=1e-4)


def test_probabilities_sum_to_one(spark):
    chance = brute_model(["abab abba", "baab"])
    for context in (b"\xfe\xfe\xfea", b"abab", b"zzzz"):
        assert sum(chance(context + bytes([b])) for b in range(256)) == pytest.approx(1)


def test_quality_keeps_clean_texts_and_drops_junk(corpus, spark):
    docs, labels = corpus
    found = kneser.classify(docs, labels)
    assert found.count() == docs.count()
    rows = found.join(labels.where("doc_id < 1000 and quality is not null"), "doc_id").collect()
    assert all(r.kept for r in rows if r.quality)
    assert sum(r.kept for r in rows if not r.quality) == 0
    odd = found.where("doc_id in (10000, 10001)").collect()
    assert [(r.perplexity, r.kept) for r in odd] == [(None, False)] * 2
    none = spark.createDataFrame([], docs.schema)
    assert kneser.classify(none, labels).collect() == []
    assert all(r.kept for r in kneser.classify(docs.limit(3), labels.limit(0)).collect() if r.symbols > 1)


def test_quality_drops_repeated_words_symbols_and_junk_of_unlabelled_languages(spark):
    rng = random.Random(21)
    words = ["".join(rng.choice(SYLLABLES["aa"]) for _ in range(rng.randrange(1, 4))) for _ in range(60)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    docs = [(i, prose(rng.randrange(20, 80)), "aa") for i in range(600)]
    docs[:3] = [(i, "".join(rng.choice("XQZ!%$#") for _ in range(200)), "aa") for i in range(3)]
    labels = [(i, 1) for i in range(600)]  # a few of the trusted are odd, as they are in the tables
    spelt = [w[::-1] for w in words if len(w) == 4 and w[::-1] not in words]
    junk = [(1000 + i, f"{w} " * 200, "aa") for i, w in enumerate(spelt[:8])]
    junk += [(1100 + i, prose(200).replace(" ", " | "), "aa") for i in range(8)]
    junk += [(1200 + i, f"{w} " * 200, "zz") for i, w in enumerate(spelt[:8])]
    docs += junk + [(2000, prose(40), "zz"), (2001, prose(3), "aa")]
    found = kneser.classify(
        spark.createDataFrame(docs, "doc_id long, text string, lang string"),
        spark.createDataFrame(labels, "doc_id long, quality int"),
    )
    kept = {r.doc_id: r.kept for r in found.collect()}
    assert [i for i, _, _ in junk if kept[i]] == []
    assert kept[2000] and kept[2001]
    assert np.mean([kept[i] for i in range(3, 600)]) > 0.98


def test_toxicity_on_held_out_texts(corpus, spark):
    docs, labels = corpus
    found = toxicity.score(docs, labels)
    assert found.count() == docs.count()
    held = found.where(held_out(F.col("doc_id"))).withColumnRenamed("toxic", "said")
    rows = held.join(labels.where("quality = 1 and doc_id < 1000"), "doc_id").collect()
    assert all(r.said == bool(r.toxic) for r in rows) and any(r.said for r in rows)
    assert all(0 <= r.severity <= toxicity.GRADES - 1 and r.toxic_prob <= r.severity + 1e-12 for r in rows)
    more = [r.severity for r in rows if r.toxic]
    assert len(set(np.round(more, 3))) > 2
    odd = found.where("doc_id in (10000, 10001)").collect()
    assert not any(r.toxic for r in odd)
    none = spark.createDataFrame([], docs.schema)
    assert toxicity.score(none, labels).collect() == []
    assert not any(r.toxic for r in toxicity.score(docs.limit(20), labels.limit(0)).collect())


def test_toxicity_learns_from_few_texts_and_rare_words(spark):
    rng = random.Random(31)
    schema = "doc_id long, text string"

    def fitted(bad, good):
        rows = [(i, t) for i, t in enumerate(bad + good)]
        labels = [(i, int(i < len(bad))) for i in range(len(rows))]
        labels = spark.createDataFrame(labels, "doc_id long, toxic int")
        labels = labels.where(~held_out(F.col("doc_id")))
        return toxicity.fit(spark.createDataFrame(rows, schema), labels)

    def said(model, text):
        return model.grades(model.found(text))[0] >= toxicity.TOXIC

    clean = lambda: text_of("aa", rng, 30)
    few = fitted([f"{clean()} {BAD[i % 3]}" for i in range(12)], [clean() for _ in range(70)])
    assert few.places and all(said(few, f"{clean()} {BAD[i]} {BAD[i - 1]} {clean()}") for i in range(3))
    assert not any(said(few, clean()) for _ in range(50))
    bad = [f"{clean()} {'rareslur' if i < 7 else rng.choice(BAD)}" for i in range(400)]
    many = fitted(bad, [clean() for _ in range(400)])
    assert "=rareslur" in many.places and many.weights[many.places["=rareslur"]] > 0
    assert said(many, f"{clean()} rareslur") and not any(said(many, clean()) for _ in range(50))


def test_ordinal_fit_orders_its_cuts():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 3))
    y = np.digitize(x @ [2.0, -1.0, 0.0] + rng.logistic(size=2000), [-1, 1, 3])
    w, cuts = toxicity.fit_ordinal(x, y)
    assert np.allclose(w, [2, -1, 0], atol=0.2) and np.allclose(cuts, [-1, 1, 3], atol=0.3)


PLAIN = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def plain_spans(text):
    out = []
    for kind, pattern in PLAIN:
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            ok = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else False,
                "card": 12 <= len(digits) <= 19 and pii.luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if ok:
                out.append((kind, *m.span()))
    return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0])))


def test_base_spans_match_the_patterns():
    rng = random.Random(12)
    parts = ["a.b@c.de", "1.2.3.4", "256.1.1.1", "4111 1111 1111 1111", "+1 (305) 555-0199", "@", ".", "x", "-", " ", "é", "12", "+", "1.1.1.1.1", "a@b@c.d-e.f"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(9)))
        assert pii.base_spans(text) == plain_spans(text), text
    assert pii.base_spans(None) == pii.base_spans("") == []
    long = "a" * 300_000 + "1" * 300_000
    assert pii.base_spans(long) == []


@pytest.fixture(scope="module")
def private(spark):
    rng = random.Random(13)
    rows = []
    for i in range(260):
        words = text_of("aa", rng, 40).split()
        for kind in rng.sample(range(5), 2):
            d = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
            value = [
                f"{''.join(rng.choice('abcdef') for _ in range(6))}.{d(2)}@mail{d(1)}.example.com",
                ".".join(str(rng.randrange(1, 255)) for _ in range(4)),
                next(c for c in (d(16) for _ in range(999)) if pii.luhn(c)),
                f"+1 ({d(3)}) 555-{d(4)}",
                f"token{d(9)}",
            ][kind]
            words.insert(rng.randrange(len(words)), value)
        rows.append((i, " ".join(words)))
    return spark.createDataFrame(rows + [(900, None), (901, ""), (None, "7 " * 3000)], "doc_id long, text string")


def test_tagger_learns_the_spans_of_held_out_texts(private):
    model = pii.fit(private, steps=250)
    texts = [r.text for r in private.where(held_out(F.col("doc_id"))).collect()]
    seen = [set(s) for s in pii.tagged_spans(texts, model)]
    true = [set(pii.base_spans(t)) for t in texts]
    hits = sum(len(a & b) for a, b in zip(seen, true, strict=True))
    assert hits / sum(map(len, true)) > 0.8 and hits / sum(map(len, seen)) > 0.8
    found = pii.find(private, model).collect()
    texts = {r.doc_id: r.text for r in private.collect()}
    assert len(found) == len(texts)
    for r in found:
        text = texts[r.doc_id]
        base = plain_spans(text)
        assert r.base_sha256 == hashlib.sha256(pii.joined(base).encode()).hexdigest()
        assert set(pii.joined(base).split(",")) <= set(r.spans.split(",")) | {""}
        assert r.n_email == sum(s[0] == "email" for s in base)
        assert r.n_added == len([s for s in r.spans.split(",") if s]) - len(base)


def test_windows_cover_every_anchor():
    rng = random.Random(3)
    for _ in range(200):
        text = "".join(rng.choice("ab 1@") if rng.random() < 0.05 else "x" for _ in range(rng.randrange(800)))
        starts = pii.windows_of(text)
        assert starts == sorted(set(starts))
        for m in pii._ANCHOR.finditer(text):
            assert any(s <= max(0, m.start() - 1) and m.start() + pii.REACH <= s + pii.WINDOW for s in starts)


def test_gradient_is_the_slope_of_the_loss():
    rng = np.random.default_rng(1)
    model = tagger.Tagger.new(5, 3, np.array([[1, 1, 0], [1, 0, 1], [1, 1, 1]], bool), np.array([1, 1, 0], bool), 3, 4)
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    windows = rng.integers(0, 5, (4, 7))
    tags = np.array([[0, 1, 2, 2, 0, 0, 1]] * 4)
    _, g = model.gradient(windows, tags)
    for name in model.p:
        flat = model.p[name].reshape(-1)
        i = int(np.abs(g[name]).argmax())
        old = flat[i]
        losses = []
        for step in (1e-4, -1e-4):
            flat[i] = old + step
            losses.append(model.gradient(windows, tags)[0])
        flat[i] = old
        assert (losses[0] - losses[1]) / 2e-4 == pytest.approx(g[name].reshape(-1)[i], rel=2e-2, abs=1e-4), name


def test_personal_data_edge_tables(documents, spark):
    assert pii.find(documents).count() == documents.count()
    none = spark.createDataFrame([], "doc_id long, text string")
    assert pii.find(none).collect() == []
