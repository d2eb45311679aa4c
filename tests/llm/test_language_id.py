"""Language ID: the kernel against plain sets, held-out accuracy, defined cases."""

import zlib
from math import sqrt

import numpy as np
from pyspark.sql import functions as F

from casetrail.llm import language_id as lid
from casetrail.llm import queries


def plain_grams(text):
    line = lid.normal(text)
    return {line[i:i + n] for n in (1, 2, 3) for i in range(len(line) - n + 1)}


def test_folded_scores_equal_the_kernel_computation():
    rows = [("the cat sat on the mat", "en"), ("le chat est sur la table", "fr"),
            ("this is the other house", "en"), ("une autre maison est ici", "fr")]
    model = lid.fit(rows, landmarks=1)
    marks = [rows[0], rows[1]]

    def kernel(a, b):
        a, b = plain_grams(a), plain_grams(b)
        return len(a & b) / sqrt(len(a) * len(b))
    own = np.array([[kernel(a, b) for b, _ in marks] for a, _ in marks])
    values, vectors = np.linalg.eigh(own)
    root = vectors / np.sqrt(values)
    z = np.array([[kernel(t, m) for m, _ in marks] for t, _ in rows]) @ root
    y = np.array([[1, -1], [-1, 1], [1, -1], [-1, 1]], float)
    w = np.linalg.solve((z - z.mean(0)).T @ (z - z.mean(0)) + lid.RIDGE * np.eye(2),
                        (z - z.mean(0)).T @ (y - y.mean(0)))
    text = "Das Haus, the house ist la maison!"
    want = (np.array([[kernel(text, m) for m, _ in marks]]) @ root - z.mean(0)) @ w + y.mean(0)
    langs, scores = lid.Scorer(model).score([text])
    assert langs == [["en", "fr"][int(want.argmax())]]
    assert abs(scores[0] - (1 + want.max()) / 2) < 1e-4


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries.op8_language_id(spark, sf).collect()
    assert sorted(r.doc_id for r in got) == sorted(truth)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)


def test_defined_cases(spark):
    text = "the quick brown fox and the lazy dog"
    rows = [(1, text, "en"), (1, text, "en"), (None, text, None), (2, None, "en"), (3, "", "en"),
            (4, "123 ---", "fr"), (5, "le renard brun et le chien de la maison", "fr"),
            (6, text * 5000, None), (7, "_²½ 5", "en")]
    df = spark.createDataFrame([(*r, 0.0) for r in rows],
                               "doc_id long, text string, lang string, score double")
    got = lid.identify(df).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    assert by_id[None].held_out and by_id[None].lang_pred == "en" == by_id[6].lang_pred
    assert {by_id[i].lang_pred for i in (2, 3, 4, 7)} == {"und"}
    kept = lid.keep_identified(df)
    assert kept.columns == df.columns and kept.count() == 5
    assert lid.identify(df.limit(0)).collect() == []
    unlabelled = lid.identify(df.filter("lang is null")).collect()
    assert {(r.lang_pred, r.score) for r in unlabelled} == {("und", 0.0)}


def test_every_language_is_learned(spark):
    """More languages than 64, a group of copies in each of the frequent ones."""
    rows = [(i, f"text{chr(97 + lang % 26) * 4}{chr(97 + lang // 26) * 4} number {'x' * (i % 7)}",
             f"l{lang:02}") for lang in range(70) for i in range(lang * 20, lang * 20 + 12)]
    rows += [(2000 + i, "many copies of one text", "l00") for i in range(900)]
    rows += [(3000 + i, "1 2 3 " + str(i), "l01") for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sample = lid.labelled_sample(df, 5)
    assert {lang for _, lang in sample} == {f"l{i:02}" for i in range(70)}
    assert len(sample) == len(set(sample))
    by_lang = [sum(lang == f"l{i:02}" for _, lang in sample) for i in range(70)]
    assert max(by_lang) == 5 and min(by_lang) >= 2
    assert len(lid.fit(sample).names) == 70


def test_sample_is_the_first_texts_by_hash(spark):
    """Ranking in parts picks what one ranking per language would, copies counted once."""
    rows = [(i, f"some words number {i % 700} {chr(97 + i % 26)}", "en" if i % 9 else "fr")
            for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    place = {r.text: r.place for r in df.select("text", F.xxhash64("text").alias("place"))
             .distinct().collect()}
    want = []
    for lang in ("en", "fr"):
        seen = {t for i, t, l in rows if l == lang and zlib.crc32(str(i).encode()) % 5}
        want += [(t, lang) for t in sorted(seen, key=place.get)[:40]]
    assert sorted(lid.labelled_sample(df, per_language=40)) == sorted(want)


def test_query_against_a_plain_kernel_version(spark, sf_small):
    """The whole query from sets of n-grams: sample, landmarks, ridge regression, scores."""
    place = F.xxhash64("text").alias("place")
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("*", place).collect()
    sample = {}
    for d in docs:
        if zlib.crc32(str(d.doc_id).encode()) % 5 and d.lang and lid.normal(d.text):
            sample.setdefault(d.lang, {})[d.text] = d.place
    train = sorted((p, t, lang) for lang, found in sample.items()
                   for t, p in sorted(found.items(), key=lambda x: x[1])[:lid.PER_LANGUAGE])
    names = sorted(sample)
    sets = [(plain_grams(t), lang) for _, t, lang in train]
    marks = [g for name in names for g in [g for g, lang in sets if lang == name][:lid.LANDMARKS]]

    def kernel(a):
        return [len(a & m) / sqrt(len(a) * len(m)) for m in marks]
    values, vectors = np.linalg.eigh(np.array([kernel(m) for m in marks]))
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    z = np.array([kernel(g) for g, _ in sets]) @ root
    y = np.array([[1.0 if lang == n else -1.0 for n in names] for _, lang in sets])
    zc, yc = z - z.mean(0), y - y.mean(0)
    w = np.linalg.solve(zc.T @ zc + lid.RIDGE * np.eye(zc.shape[1]), zc.T @ yc)
    got = {r.doc_id: r for r in queries.op8_language_id(spark, sf_small).collect()}
    assert sorted(got) == sorted(d.doc_id for d in docs)
    for d in docs:
        r = got[d.doc_id]
        if not lid.normal(d.text):
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        out = (np.array(kernel(plain_grams(d.text))) @ root - z.mean(0)) @ w + y.mean(0)
        assert abs(r.score - min(1.0, max(0.0, (1 + out.max()) / 2))) < 2e-3, d.doc_id
        second = np.sort(out)[-2]
        assert r.lang_pred == names[int(out.argmax())] or out.max() - second < 2e-3
