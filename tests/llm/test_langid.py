import math
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest

from driftwatch.llm import langid

PATH = public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.01/documents.parquet"


def brute_word(model, word):
    """Sum over all segmentations, by recursion over the first piece."""

    def total(s):
        if not s:
            return np.ones(len(model.langs))
        out = np.zeros(len(model.langs))
        for n in range(1, len(s) + 1):
            k = model.pieces.get(s[:n])
            if k is not None:
                out += model.probs[k] * total(s[n:])
            elif n == 1:
                out += model.unknown * total(s[1:])
        return out

    return np.log(total(langid.MARK + word))


def test_forward_sums_all_segmentations():
    pieces = {p: i for i, p in enumerate(["▁", "▁a", "a", "b", "ab", "ba", "▁ab", "aba", "é"])}
    probs = np.random.default_rng(1).dirichlet(np.ones(len(pieces)), 2).T
    model = langid.Model(["x", "y"], pieces, probs, probs.min(axis=0) / 100)
    words = ["a", "ab", "abab", "zé", "babaab", "zzz"]
    assert np.allclose(langid.word_scores(model, words), [brute_word(model, w) for w in words])


def test_long_words_follow_the_same_recurrence(monkeypatch):
    pieces = {p: i for i, p in enumerate(["▁", "a", "b", "ab", "▁b"])}
    probs = np.random.default_rng(2).dirichlet(np.ones(len(pieces)), 3).T
    model = langid.Model(["x", "y", "z"], pieces, probs, probs.min(axis=0) / 10)
    words = ["abba" * 5, "bab", "b" * 17 + "q"]
    short = langid.word_scores(model, words)
    monkeypatch.setattr(langid, "LONG", 0)
    assert np.allclose(langid.word_scores(model, words), short)
    assert np.isfinite(langid.word_scores(model, ["ab" * 50_000])).all()


def test_rare_letters_do_not_underflow(monkeypatch):
    """Letters outside the vocabulary or never seen, in runs below and above LONG: finite sums, and the same by both ways."""
    pieces = {p: i for i, p in enumerate(["▁", "a", "b", "ab", "q"])}
    counts = np.array([[2e9, 6e7], [1e9, 3e7], [5e8, 2e7], [3e8, 9e6], [0, 1e3]]) + langid.SMOOTH
    probs = counts / counts.sum(axis=0)
    model = langid.Model(["x", "y"], pieces, probs, probs.min(axis=0) * langid.UNKNOWN)
    words = ["é" * 27, "é" * 30, "é" * 40, "q" * 39, "ab" * 10 + "é" * 20, "q" * 41, "é" * 200]
    got = langid.word_scores(model, words)
    assert np.isfinite(got).all()
    assert np.allclose(got[2], np.log(probs[0]) + 40 * np.log(model.unknown))
    assert np.allclose(got[3], np.log(probs[0]) + 39 * np.log(probs[4]))
    assert np.allclose(got[6], np.log(probs[0]) + 200 * np.log(model.unknown))
    monkeypatch.setattr(langid, "LONG", 0)
    assert np.allclose(langid.word_scores(model, words), got)
    (lang,), (score,) = langid.Scorer(model)(["ab ab " * 20 + "é" * 40])
    assert lang in model.langs and 0.25 <= score <= 1


def test_long_pieces_are_learned_and_summed(spark, monkeypatch):
    names = [p for p in langid.vocabulary(PATH)[1] if p]
    rows = [("an international organization", "en"), ("une organisation", "fr")]
    model = langid.train(spark.createDataFrame(rows, "text string, lang string"), PATH)
    assert set(model.pieces) == set(names) and model.longest == max(map(len, names)) > 12
    k = model.pieces["▁international"]
    assert model.probs[k, 0] > 5 * model.probs[k, 1]
    words = ["international", "internationally", "communication"]
    got = langid.word_scores(model, words)
    assert np.allclose(got, [brute_word(model, w) for w in words])
    monkeypatch.setattr(langid, "LONG", 0)
    assert np.allclose(langid.word_scores(model, words), got)


def test_counts_cover_all_training_rows(spark):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    rows = [("Der Hund, der", "de"), ("le chien", "fr"), ("der", "de"), (None, "de"), ("x", None)]
    got = {(r.lang, r.piece): r.n for r in langid.piece_counts(spark.createDataFrame(rows, "text string, lang string"), langid.vocabulary(PATH)[0]).collect()}
    want = {}
    for text, lang in rows:
        for w in langid.WORDS.findall(text.lower()) if text and lang else []:
            for i in sp.encode(w):
                want[lang, i] = want.get((lang, i), 0) + 1
    assert got == want


def test_held_out_accuracy(spark):
    got = {r.doc_id: r for r in langid.identify(spark.read.parquet(SF), PATH).collect()}
    rows = duckdb.sql(f"SELECT doc_id, lang FROM '{SF}'").fetchall()
    assert len(got) == len(rows)
    held = [(got[i].lang_pred, lang) for i, lang in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, _ in rows)
    assert sum(a == b for a, b in held) / len(held) >= 0.97
    assert all(0 <= r.score <= 1 for r in got.values())


def test_prediction_ignores_the_labels(spark):
    docs = spark.read.parquet(SF)
    model = langid.train(docs.where(~langid.held_out()), PATH)
    plain = docs.select("doc_id", "text")
    assert sorted(langid.predict(plain, model).collect()) == sorted(langid.predict(docs, model).collect())


def test_defined_cases(spark):
    rows = [(1, "the dog and the cat", "en"), (3, "le chien et le chat", "fr"), (None, "the", "en"), (4, None, "en"), (5, "", None), (5, "12 :-)", None), (5, "le", None), (6, "w" * 200_000, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = [(r.doc_id, r.lang_pred) for r in langid.identify(df, PATH).collect()]
    assert (4, "und") in got and got.count((5, "und")) == 2 and (5, "fr") in got and (None, "en") in got
    assert langid.identify(df.limit(0), PATH).count() == 0
    nothing = df.withColumn("lang", df["lang"].substr(1, 0)).where("false").unionByName(df.selectExpr("doc_id", "text", "cast(null as string) lang"))
    assert {(r.lang_pred, r.score) for r in langid.identify(nothing, PATH).collect()} == {("und", 0.0)}


@pytest.mark.parametrize("temper", [1.0, 4.0])
def test_score_is_a_posterior(temper):
    total = np.array([-10.0, -11.0])
    assert math.isclose(float(1 / np.exp((total - total[0]) / temper).sum()), 1 / (1 + math.exp(-1 / temper)))
