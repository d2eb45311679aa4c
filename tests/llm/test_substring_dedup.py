"""Substring dedup against brute force over all windows, and the SQL twin."""

import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from casetrail.llm import queries
from casetrail.llm import substring_dedup as sub


def brute(rows, window):
    """rows: (doc_id, text) -> (n_words, n_removed, kept text) of every row."""
    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    least = {}
    for (doc_id, _), words in zip(rows, split):
        for i in range(len(words) - window + 1):
            key = tuple(words[i:i + window])
            if doc_id is not None:
                least[key] = min(doc_id, least.get(key, doc_id))
    out = []
    for (doc_id, _), words in zip(rows, split):
        gone = set()
        for i in range(len(words) - window + 1):
            if doc_id is not None and least[tuple(words[i:i + window])] < doc_id:
                gone.update(range(i, i + window))
        out.append((len(words), len(gone),
                    " ".join(w for i, w in enumerate(words) if i not in gone)))
    return out


def test_minimisers_are_window_minima():
    hashes = np.random.default_rng(0).integers(0, 9, 400).astype(np.uint64)
    for window, gram in ((50, 8), (12, 3), (9, 9), (20, 1)):
        grams = sub.minimisers(hashes, gram, gram)
        want = [grams[i:i + window - gram + 1].min() for i in range(len(hashes) - window + 1)]
        assert sub.minimisers(hashes, window, gram).tolist() == want


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab\u00e9 \t\n\x0b\x1c\u2003\U0001F600", max_size=80))
def test_words_of_a_line(text):
    words = [w.encode() for w in re.findall(r"[^\x20\x09-\x0D]+", text)]
    line, starts, ends = sub.split_line(text)
    assert line.tobytes() == b" ".join(words)
    assert [line[a:b].tobytes() for a, b in zip(starts, ends)] == words
    if words:
        hashes = sub.word_hashes(line, starts, ends).tolist()
        assert all((hashes[i] == hashes[j]) == (words[i] == words[j]) or len(words[i]) > 16
                   for i in range(len(words)) for j in range(i))


@pytest.mark.parametrize("seed, hot", [(1, sub.HOT), (2, sub.HOT), (1, 5), (2, 0)])
def test_random_overlaps(spark, seed, hot, monkeypatch):
    monkeypatch.setattr(sub, "FLUSH_BYTES", 4000)
    rng = random.Random(seed)
    vocabulary = [f"w{i}é" for i in range(300)]
    passages = [[rng.choice(vocabulary) for _ in range(rng.randint(8, 60))] for _ in range(8)]
    rows = []
    for i in range(80):
        words = []
        for _ in range(rng.randint(0, 5)):
            words += rng.choice(passages)[rng.randint(0, 3):] if rng.random() < .6 else [
                rng.choice(vocabulary) for _ in range(rng.randint(1, 20))]
        rows.append((rng.randint(0, 60) if i % 9 else None, "\n ".join(words)))
    rows += [(70, None), (71, ""), (72, "same " * 4000), (73, "same " * 30), (74, " \t\x0b"),
             (2, rows[0][1]), (2, rows[0][1]), (75, "a b " * 40), (1, "a b " * 30)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, first string")
    got = sub.remove_repeats(df.repartition(5), window=12, gram=3, hot=hot).collect()
    want = brute(rows, 12)
    key = repr
    assert sorted([(r.doc_id, r.n_words, r.n_removed, r.kept) for r in got], key=key) == sorted(
        [(d, *w) for (d, _), w in zip(rows, want)], key=key)


def test_phrase_that_a_third_of_the_documents_hold(spark, monkeypatch):
    """Its minimiser is hot: the strings around it are dealt over all buckets, counts stay exact."""
    monkeypatch.setattr(sub, "FLUSH_BYTES", 20_000)
    rng = random.Random(5)
    phrase = [f"hot{i}" for i in range(8)]
    shared = [f"s{i}" for i in range(4)]
    rows = []
    for i in range(240):
        words = [f"u{rng.randint(0, 10 ** 9)}" for _ in range(40)]
        if i % 3 == 0:
            # words around the phrase that some documents share: windows that repeat
            words[15:15] = shared[:rng.randint(0, 4)] + phrase + shared[:rng.randint(0, 4)]
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    members = df.select("doc_id", F.lit(0).cast("long").alias("text_key"), "text").mapInArrow(
        sub._members(12, 8), "m long, h1 long, h2 long, doc_id long, text_key long, at int")
    hot = sub.hot_minimisers(members, 30)
    assert hot and all(members.filter(members.m == np.uint64(m).astype(np.int64).item())
                       .select("h1").distinct().count() > 20 for m in hot)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept)
           for r in sub.remove_repeats(df, window=12, gram=8, hot=30).collect()}
    want = brute(rows, 12)
    assert got == {d: w for (d, _), w in zip(rows, want)}
    assert sum(w[1] > 0 for w in want) > 20
    counted = sub.repeated_ranges(df, 12, 8, 30)
    assert counted.count() == sum(w[1] > 0 for w in want)


def test_hot_strings_are_dealt_by_their_own_hash():
    texts = [f"{' '.join(f'u{i}x{k}' for k in range(4))} a b c d {i} {i + 1} {i + 2}"
             for i in range(200)]
    batch = pa.record_batch([pa.array(range(200)), pa.array(texts)], ["doc_id", "text"])
    hot = frozenset(m for t in texts for m, *_ in sub.super_kmers(t, 9, 4))
    rows = [r for out in sub._send(8, 9, 4, hot)(iter([batch])) for r in out.to_pylist()]
    assert sorted(r["bucket"] for r in rows) == list(range(8, 16))


def test_query_against_sql_and_brute_force(spark, sf_small):
    con = duckdb.connect()
    con.execute(f"create view documents as from '{sf_small}/documents.parquet'")
    docs = con.sql("select doc_id, text from documents").fetchall()
    got = sorted(map(tuple, queries.op5_substring_dedup(spark, sf_small).collect()))
    assert got == sorted(con.sql(queries.ORACLE["op5_substring_dedup"]).fetchall())
    assert [(r[1], r[2]) for r in got] == [
        w[:2] for _, w in sorted(zip([d[0] for d in docs], brute(docs, 50)))]


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert sub.digest(sub.remove_repeats(df)).collect() == []
