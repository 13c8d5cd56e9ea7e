"""Language identification: held-out accuracy and defined cases."""

import numpy as np
from pyspark.sql import functions as F

from changeflow.llm import langid
from changeflow.llm.queries import QUERIES

DATA = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = QUERIES["op4_language_id"](spark, DATA)
    labels = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang")
    held = got.where("held_out").join(labels, "doc_id").where("lang is not null and lang_pred <> 'und'")
    right = held.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right > 0.97
    assert got.count() == 1000 and got.where("score < 0 or score > 1").count() == 0


def test_trigram_sums_equal_brute_force():
    texts = ["Ab, c", None, "", "12 !", "é", "a  b\n\nÜb"]
    rows, codes = langid.trigrams(texts)
    want = []
    table = langid._symbols()
    for i, text in enumerate(texts):
        symbols = [0]
        for c in (text or "").lower() + " ":
            if table[ord(c)] or symbols[-1]:
                symbols.append(int(table[ord(c)]))
        want += [(i, a << 12 | b << 6 | c) for a, b, c in zip(symbols, symbols[1:], symbols[2:], strict=False)]
    assert list(zip(rows.tolist(), codes.tolist(), strict=True)) == want
    vector = langid.trigram_vectors(np.asarray([(1 << 12) | (2 << 6) | 3]))[0]
    one, two, three = (langid._letters()[k] for k in (1, 2, 3))
    assert (vector == np.roll(one, 2) * np.roll(two, 1) * three).all()


def test_every_letter_has_its_own_vector():
    letters = [chr(p) for p in (*range(0xC0, 0x250), *range(0x370, 0x530), *range(0x4E00, 0x5200), 0x20000) if chr(p).isalpha()]
    letters = sorted({c.lower() for c in letters if len(c.lower()) == 1} | set("abcdefghijklmnopqrstuvwxyz"))
    rows, codes = langid.trigrams(letters)
    assert rows.tolist() == list(range(len(letters))) and len(set(codes.tolist())) == len(letters) > 1_000
    vectors = langid.trigram_vectors(codes)
    assert set(np.unique(vectors)) == {-1, 1}
    near = vectors @ vectors.T / langid.DIMENSIONS
    np.fill_diagonal(near, 0)
    assert np.abs(near).max() < 0.25
    three = langid.trigrams(["\u00e9\u4e00\u0434", "\u00e9\u0434\u4e00"])[1]
    assert len(set(three.tolist())) == 6


def test_languages_that_differ_only_in_letters_beyond_ascii(spark):
    rng = np.random.default_rng(3)
    # Pairs of letters that shared a class when other letters had few symbols.
    own = {"one": "\u00fc\u00e2\u00e4", "two": "\u00e9\u00e7\u00df", "three": "\u00e0\u00f1\u00e4", "four": "\u00ef\u00f5\u00e3"}

    def text(name, n):
        letters = list("aeinrst" + own[name])
        return " ".join("".join(rng.choice(letters, rng.integers(2, 8))) for _ in range(n))

    rows = [(100 * k + i, text(name, 60), name) for k, name in enumerate(own) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    held = F.col("doc_id") % 3 == 0
    got = {r.doc_id: r.lang_pred for r in langid.identify(docs, held).where("held_out").collect()}
    assert len(got) == 40 and all(got[i] == name for i, _, name in rows if i in got)


def test_defined_cases(spark):
    rows = [(1, "the cat and the dog", "en", 0.0), (2, "der hund und die katze", "de", 0.0), (3, None, "en", 0.0)]
    rows += [(4, "", None, 0.0), (5, "123 !?", "de", 0.0), (None, "the cat", None, None), (6, "die katze " * 50_000, None, 0.0)]
    rows += [(7, "das und der", "de", 0.0)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(docs, F.lit(False)).collect()}
    assert [got[i][0] for i in (1, 2, 3, 4, 5, None, 6, 7)] == ["en", "de", "und", "und", "und", "en", "de", "de"]
    assert got[3][1] == got[5][1] == 0.0
    none = langid.identify(docs, F.lit(True))
    assert {r.lang_pred for r in none.collect()} == {"und"}
    assert langid.identify(docs.limit(0), F.lit(False)).count() == 0
