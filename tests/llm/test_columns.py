"""Extra columns with the names that the operators use inside pass through unchanged."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from casetrail.llm import byte_bpe, common, decontaminate, language_id, secret_scan, simhash

NAMES = ("_text_hash", "_spans", "_mark", "_root", "_least", "_kept", "_shared", "_found", "_leaks",
         "_codec", "_Codec_", "mark", "component_id", "root", "n", "value_hash", "spans", "lang_pred",
         "a`b", "dotted.name")
ROWS = [(1, "one two three four five six seven password=abcdef1", "en", "s"),
        (2, "one two three four five six seven password=abcdef1", "en", "s"),
        (2, "quite another text about something else", "en", "s"), (3, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string")
    for name in NAMES:
        df = df.withColumns({name: F.concat(F.lit(f"{name}-"), F.col("doc_id"))})
    return df


def _kept(docs, out):
    assert out.columns[:len(docs.columns)] == docs.columns
    rows = out.collect()
    assert all(r[n] == f"{n}-{r.doc_id}" for r in rows for n in NAMES)
    return rows


def test_redact(docs):
    assert len(_kept(docs, secret_scan.redact(docs))) == len(ROWS)


def test_keep_one(docs):
    assert sorted(r.doc_id for r in _kept(docs, simhash.keep_one(docs))) == [1, 2, 3]


def test_keep_identified(docs):
    assert {r.doc_id for r in _kept(docs, language_id.keep_identified(docs, 0.0))} <= {1, 2}


def test_drop_leaks(spark, docs):
    bench = spark.createDataFrame([(7, ROWS[2][1])], "item_id long, text string")
    assert sorted(r.doc_id for r in _kept(docs, decontaminate.drop_leaks(docs, bench))) == [1, 2, 3]


def test_encode(docs):
    out = byte_bpe.encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                          public_tokenizers.PATTERN)
    assert out.columns == [*docs.columns, "ids", "decoded"]
    assert len(_kept(docs, out)) == len(ROWS)


def test_running_totals_over_chunks(spark):
    df = spark.createDataFrame([([],), ([5],), (list(range(10)),)], "v array<int>")
    got = [r.at for r in df.select(common.running(F.col("v"), 0, lambda a, b: a + b, chunk=3)
                                   .alias("at")).collect()]
    assert got == [[], [0], [sum(range(i)) for i in range(10)]]
