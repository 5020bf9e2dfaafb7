import numpy as np

from conftest import SF01
from helpers import awkward, empty
from mdmspark.llm import langid
from mdmspark.llm.queries import op10_langid


def test_codewords_differ_in_half_of_the_bits():
    for n in (1, 2, 3, 4, 5, 17, 60):
        codes = langid.codewords(n)
        assert codes.shape[0] == n
        for i in range(n):
            for j in range(i):
                assert 2 * (codes[i] != codes[j]).sum() == codes.shape[1] + 1


def slow_features(text):
    """Hashes of all byte n-grams in plain integers, longest last."""
    import regex

    raw = (" " + " ".join(regex.split(r"[^\p{L}\p{M}]+", text.lower())) + " ").encode()
    out = []
    for k in (1, 2, 3, 4):
        for i in range(len(raw) - k + 1):
            gram = int.from_bytes(raw[i : i + k], "big")
            mixed = (gram ^ (0x9E3779B9 * k & 0xFFFFFFFF)) * 0x85EBCA6B & 0xFFFFFFFF
            out.append(((mixed ^ (mixed >> 15)) * 0xC2B2AE35 & 0xFFFFFFFF) >> 17)
    return out


def slow_model(rows):
    """(languages, predict) by dictionaries and sums, number by number."""
    import math

    counts = {}
    for text, lang in rows:
        if text is not None and lang is not None:
            own = counts.setdefault(lang, {})
            for f in slow_features(text):
                own[f] = own.get(f, 0) + 1
    langs = sorted(counts)
    codes = [[1 if langid.codewords(len(langs))[i][j] > 0 else -1 for j in range(langid.codewords(len(langs)).shape[1])] for i in range(len(langs))]
    bits = [j for j in range(len(codes[0])) if len({c[j] for c in codes}) == 2]
    size = {lang: sum(own.values()) for lang, own in counts.items()}
    share = lambda lang, f: (counts[lang].get(f, 0) + 0.1) / (size[lang] + 0.1 * langid.BUCKETS)
    mean = lambda xs: sum(xs) / len(xs)

    def weight(f, j):
        return math.log(mean([share(lang, f) for lang, c in zip(langs, codes) if c[j] > 0])) - math.log(mean([share(lang, f) for lang, c in zip(langs, codes) if c[j] < 0]))

    own = [[sum(n * weight(f, j) for f, n in counts[lang].items()) / size[lang] * c[j] for j in bits] for lang, c in zip(langs, codes)]
    scale = [max(mean([abs(o[b]) for o in own]), 1e-6) / 4 for b in range(len(bits))]
    trust = [min(1.0, max(0.1, min(o[b] for o in own) / max(mean([abs(o[b]) for o in own]), 1e-6))) for b in range(len(bits))]

    def predict(text):
        found = slow_features(text)
        margin = [max(-30.0, min(30.0, sum(weight(f, j) for f in found) / len(found) / scale[b])) for b, j in enumerate(bits)]
        loss = [sum(math.log1p(math.exp(-c[j] * margin[b])) * trust[b] for b, j in enumerate(bits)) for c in codes]
        best = min(range(len(langs)), key=lambda i: (loss[i], i))
        second = min((i for i in range(len(langs)) if i != best), key=lambda i: (loss[i], i))
        return langs[best], 1 / sum(math.exp(loss[best] - x) for x in loss), (loss[second] - loss[best]) / max(loss[second], 1e-12) < langid.AMBIGUOUS, loss

    return langs, predict


def test_model_equals_one_made_number_by_number(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").where("doc_id % 25 = 0 and length(text) < 1500").select("text", "lang").collect()
    train = [(r.text, r.lang) for r in docs[::2]] + [(None, "en"), ("nothing", None)]
    langs, predict = slow_model(train)
    model = langid.fit(spark.createDataFrame(train, "text string, lang string").repartition(3))
    assert model.languages == langs and len(langs) >= 3
    for text in [r.text for r in docs[1::6]] + ["Le chat est sur la table.", "x", "und der", docs[0].text * 12]:
        lang, score, doubt, _ = predict(text)
        got = model.predict(text)
        assert got[0] == lang and abs(got[1] - score) < 1e-9 and got[2] == doubt


def test_features_equal_plain_integers():
    for text in ("a", "Grüße, 漢字 x", "", "the cat  sat", "..a--b.", "İSTANBUL ǅ é́", "\x00a\x1fb\u2028c", "123", "हिन्दी। १२"):
        assert langid.features(text).tolist() == slow_features(text)


def test_words_equal_the_pattern():
    import regex

    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    for text in (every, every[::-1], every[::37]):
        assert langid.spaced_words(text).decode() == " " + " ".join(regex.split(r"[^\p{L}\p{M}]+", text.lower())) + " "
    assert langid.spaced_words("x \ud800y") == b" x y "


def test_a_dirty_language_column_is_bounded(spark):
    rows = [("hello there", "en")] * 5 + [("bonjour madame", "fr")] * 4 + [(f"junk {i}", f"x{i}") for i in range(300)]
    df = spark.createDataFrame(rows, "text string, lang string")
    assert langid.fit(df, most=3).languages == ["en", "fr", "x0"]
    assert len(langid.fit(df).languages) == langid.LANGUAGES


def test_held_out_accuracy(spark):
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()}
    rows = op10_langid(spark, SF01).collect()
    assert len(rows) == len(langs) and all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert 0.25 < len(held) / len(rows) < 0.42
    assert np.mean([r.lang_pred == langs[r.doc_id] for r in held]) >= 0.98


def test_training_ignores_rows_that_cannot_teach(spark):
    docs = awkward(spark)
    model = langid.fit(docs)
    assert model.languages == ["de", "en", "fr"] or model.languages == ["en", "fr"]
    rows = langid.identify(docs, model).collect()
    assert len(rows) == 11
    assert all((r.lang_pred, r.score) == (langid.UNKNOWN, 0.0) for r in rows if r.doc_id in (3, 4, 5))
    none = langid.fit(empty(spark))
    assert {r.lang_pred for r in langid.identify(docs, none).collect()} == {langid.UNKNOWN}
    assert langid.identify(empty(spark), model).count() == 0


def test_one_language_and_unsure_texts(spark):
    one = langid.fit(spark.createDataFrame([("hello there", "en")], "text string, lang string"))
    assert one.predict("xyz") == ("en", 1.0, False) and one.predict("123")[0] == langid.UNKNOWN
    two = langid.fit(spark.createDataFrame([("aaaa bbbb", "x"), ("cccc dddd", "y")], "text string, lang string"))
    assert two.predict("aaaa")[0] == "x" and two.predict("dddd")[0] == "y" and two.predict("aaaa cccc")[2]
