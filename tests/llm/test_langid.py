import numpy as np
import plain
import pytest
from pyspark.sql import functions as F

from velometry.llm import langid

EN = "the cat sat on the mat and the dog was not there when they came home"
DE = "der hund und die katze sind nicht hier weil das haus zu klein ist"


def rows(spark, data, schema="doc_id bigint, text string, lang string"):
    return spark.createDataFrame(data, schema)


@pytest.fixture(scope="module")
def model(spark):
    return langid.learn(rows(spark, [(1, EN, "en"), (2, DE, "de"), (3, None, "fr"), (4, EN, None)]))


def test_small_model(model):
    assert model.languages == ("de", "en")
    langs, score = langid.identify(["The cat and the dog", "die katze", "", "12 !?", "ЖЖЖ", "x"], model)
    assert langs[:4] == ["en", "de", "und", "und"] and langs[4] in model.languages
    assert score[0] > 0.9 and score[2] == score[3] == 0 and all(0 <= s <= 1 for s in score)


def test_a_mask_names_every_language_of_a_gram(model):
    hashes, _, _ = langid._grams(["the", "die"])
    (masks,) = langid.masks_of(hashes, model)
    en, de = 1 << model.languages.index("en"), 1 << model.languages.index("de")
    assert all(int(m) & en for m in masks[:3]) and all(int(m) & de for m in masks[3:])


def test_grams_stay_inside_words_and_texts():
    def count(*texts):
        return np.bincount(langid._grams(list(texts))[1], minlength=len(texts)).tolist()

    assert count("abc") == [3]  # " ab", "abc", "bc "
    assert count("a b") == [2]
    assert count("abc", "", "a") == [3, 0, 1]
    assert count("a--b", "A, b") == [2, 2]
    same = langid._grams(["Éa  b"])[0].tolist()
    assert langid._grams(["x y", " éA!b9"])[0].tolist()[2:] == same


def test_false_positives_are_taken_off(monkeypatch, spark):
    monkeypatch.setattr(langid, "PLACES", 64)  # nearly full filters
    model = langid.learn(rows(spark, [(1, EN, "en"), (2, DE, "de")]))
    assert all(r > 0.2 for r in model.false_rates)
    assert langid.identify([EN, DE], model)[0] == ["en", "de"]


def test_quoted_passages_do_not_make_a_language(spark):
    quoted = "whose quick brown fox jumps over every lazy dog"
    data = [(i, f"{EN} {quoted} {i}", "en") for i in range(60)]
    data += [(100 + i, DE + (" " + quoted if i % 10 == 0 else ""), "de") for i in range(60)]
    data += [(200, EN, "xx")]
    model = langid.learn(rows(spark, data))
    assert model.languages == ("de", "en", "xx")
    langs, score = langid.identify([quoted, "fox", "der hund", EN + " " + quoted], model)
    assert langs == ["en", "en", "de", "en"] and min(score) > 0.9
    # Without rivals, all n-grams of the quoting documents are theirs.
    assert langid.identify([quoted], langid.learn(rows(spark, data), rival=1e9))[0] == ["de"]


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_held_out_accuracy(spark, sf):
    import __spark_entry__

    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = __spark_entry__.queries()["op10_language_id"](spark, sf).collect()
    assert len(got) == len(lang)
    assert all(r.held_out == plain.held_out(r.doc_id) for r in got)
    tested = [r for r in got if r.held_out and lang[r.doc_id]]
    right = sum(r.lang_pred == lang[r.doc_id] for r in tested)
    assert right >= 0.985 * len(tested)


def test_rows_with_nulls_and_clashing_columns(spark, model):
    data = [(1, EN, "x"), (1, EN, "x"), (None, DE, None), (2, None, "en"), (3, "", "en")]
    df = rows(spark, data).withColumn("score", F.lit("s")).withColumn("lang_pred", F.lit(1))
    got = sorted(str((r.doc_id, r.lang_pred)) for r in langid.predict(df, model).collect())
    assert got == sorted(
        ["(1, 'en')", "(1, 'en')", "(None, 'de')", "(2, 'und')", "(3, 'und')"]
    )
    assert langid.predict(df.limit(0), model).count() == 0
    nothing = langid.learn(df.limit(0))
    assert {r.lang_pred for r in langid.predict(df, nothing).collect()} == {"und"}
    flags = df.select(langid.held_out(F.col("doc_id")).alias("h")).collect()
    assert [r.h for r in flags] == [plain.held_out(1)] * 2 + [False, plain.held_out(2), plain.held_out(3)]


def test_sample_is_bounded(spark):
    df = spark.range(20_000).select(
        F.col("id").alias("doc_id"),
        F.lit("word").alias("text"),
        F.when(F.col("id") < 19_000, "big").otherwise("small").alias("lang"),
    )
    n = {r.lang: r["count"] for r in langid._sample(df, 1000).groupBy("lang").count().collect()}
    assert n["small"] == 1000 and 800 < n["big"] < 1200


def test_long_text(model):
    assert langid.identify([EN * 20_000], model)[0] == ["en"]


def _same_as_sets(spark, data, texts, **options):
    """Learn from (doc_id, text, lang) rows; compare with exact sets of n-grams."""
    model = langid.learn(rows(spark, data), **options)
    sets, counts = plain.language_sets([(t, lang) for _, t, lang in data], **options)
    assert model.languages == tuple(sorted(sets))
    every = sorted(set().union(*sets.values()))
    for i, lang in enumerate(model.languages):
        hashes = np.array([plain.gram_hash(g) for g in every], np.uint64)
        has = langid._bit(langid.masks_of(hashes, model), i)
        own = np.array([g in sets[lang] for g in every])
        assert has[own].all()  # a filter forgets nothing
        wrong = has[~own].sum()
        expected = model.false_rates[i] * (~own).sum()
        assert wrong <= expected + 5 * expected**0.5 + 3
    langs, score = langid.identify(texts, model)
    close = 0
    for text, lang, got in zip(texts, langs, score):
        shares = plain.language_shares(text, sets)
        if shares is None:
            assert (lang, got) == ("und", 0)
            continue
        ranked = sorted(shares.values(), reverse=True)
        assert abs(got - ranked[0]) < 0.02
        if len(ranked) > 1 and ranked[0] - ranked[1] < 0.02:
            close += 1
        else:
            assert shares[lang] == ranked[0]
    return model, close


def test_equals_exact_sets(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    data = [(r.doc_id, r.text, r.lang) for r in documents if not plain.held_out(r.doc_id) and r.lang and r.text]
    texts = [r.text or "" for r in documents]
    _, close = _same_as_sets(spark, data, texts, top_grams=10**6)
    assert close < len(texts) / 20


def test_the_most_common_grams_are_kept(spark):
    data = [(i, " ".join(f"w{c}x" for c in "abcdefgh"[: i + 1]), "en") for i in range(8)]
    model = langid.learn(rows(spark, data), top_grams=6)
    sets, counts = plain.language_sets([(t, lang) for _, t, lang in data], top_grams=10**6)
    by_count = sorted(counts["en"].values(), reverse=True)
    hashes = {g: np.array([plain.gram_hash(g)], np.uint64) for g in sets["en"]}
    kept = [counts["en"][g] for g, h in hashes.items() if langid._bit(langid.masks_of(h, model), 0)[0]]
    assert sorted(kept, reverse=True) == by_count[:6]


def test_more_languages_than_a_word_has_bits(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    name = lambda i: letters[i // 26] + letters[i % 26]
    data = [(i, f"q{name(i)}z {name(i) * 3}", f"l{i:03}") for i in range(150)]
    model, _ = _same_as_sets(spark, data, [t for _, t, _ in data], rival=4)
    assert len(model.languages) == 150 and model.table.shape[0] == 3
    assert langid.identify([t for _, t, _ in data], model)[0] == [lang for _, _, lang in data]


def test_too_many_languages_are_an_error(monkeypatch, spark):
    monkeypatch.setattr(langid, "LANGUAGES", 1)
    with pytest.raises(ValueError, match="more than 1"):
        langid.learn(rows(spark, [(1, EN, "en"), (2, DE, "de")]))
