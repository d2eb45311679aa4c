"""The pipeline against plain versions of its stages, and its defined cases."""

import numpy as np

import corpus_pipeline
from casetrail.llm import language_id

from .test_byte_bpe import PATH, reference  # noqa: F401
from .test_decontaminate import dec
from .test_secret_scan import brute as brute_spans
from .test_simhash import brute_components, brute_mark

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_keep_columns_and_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "simhash", "decontamination", "secret_scan", "byte_bpe"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_run_against_plain_stages(spark, sf_small, reference):  # noqa: F811
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    model = language_id.fit(language_id.labelled_sample(docs))
    langs, scores = language_id.Scorer(model).score(list(rows.values()))
    kept = {i: t for (i, t), lang, s in zip(rows.items(), langs, scores) if lang != "und" and s >= 0.25}
    marks = [(i, brute_mark(t)) for i, t in kept.items()]
    kept = {i: kept[i] for (i, _), c in zip(marks, brute_components(marks)) if i == c}
    bench = spark.read.parquet(f"{sf_small}/benchmark.parquet").collect()
    items = dec.Items([(b.item_id, b.text) for b in bench])

    def leaked(text):
        numbers = items.numbers(text)
        return any(dec.align([w], [numbers])[0][0] / len(w) >= dec.THRESHOLD for w in items.words)
    kept = {i: t for i, t in kept.items() if not t or not leaked(t)}
    got = corpus_pipeline.run(spark, sf_small).collect()
    assert sorted(r.doc_id for r in got) == sorted(kept)
    masked = 0
    for r in got:
        assert bytes(r.decoded) == r.text.encode()
        assert np.frombuffer(r.ids, "<u4").tolist() == reference.encode_ordinary(r.text)
        spans = brute_spans(kept[r.doc_id])[2]
        masked += r.text != kept[r.doc_id]
        assert ("[SECRET]" in r.text) >= bool(spans)
        if not spans and "[SECRET]" not in r.text:
            assert r.text == kept[r.doc_id]
    assert masked == sum(bool(brute_spans(t)[2]) for t in kept.values())


def test_odd_rows_pass_through_every_stage(spark, sf_small):
    text = "the quick brown fox jumps over the lazy dog and runs away from it "
    rows = [(1, text, "en", "s", 1), (1, text, "en", "s", 1), (None, text + "now", None, None, None),
            (2, None, "en", "s", 0), (3, "", "en", None, 0), (4, text * 3000, "en", "s", 9),
            (5, "other words with password=hunter22 inside a sentence", "en", "s", 1)]
    df = spark.createDataFrame([(*r, "x") for r in rows],
                               "doc_id long, text string, lang string, source string, n_chars long, "
                               "ids string")
    for data in (df, df.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, data, sf_small)
            if name != "byte_bpe":
                assert out.columns == data.columns, name
            data = out
        rows_left = data.collect()
        ids = sorted(r.doc_id or 0 for r in rows_left)
        assert all("hunter22" not in r.text and "[SECRET]" in r.text
                   for r in rows_left if r.doc_id == 5)
        assert set(ids) <= {0, 1, 4, 5} and len(ids) == len(set(ids))
    assert data.columns[-2:] == ["ids", "decoded"]
