"""Spelling variants against brute force over all pairs, the tile comparison, defined cases."""

import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from casetrail.llm import spelling


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows):
    count = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            count[run] += 1
    n = {w: c for w, c in count.items() if len(w) >= 6 and c >= 5}
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return sorted(out, key=repr)


def run(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows],
                               "doc_id long, text string, word string, n int").repartition(3)
    got = spelling.variants(df)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(map(tuple, got.collect()), key=repr)


def edited(rng, word):
    i = rng.randrange(len(word))
    return rng.choice([word[:i] + word[i + 1:], word[:i] + rng.choice("abé") + word[i:],
                       word[:i] + rng.choice("abé") + word[i + 1:]])


def corpus(seed, texts=60):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcé") for _ in range(rng.randrange(5, 11))) for _ in range(25)]
    base += ["a" * k for k in (5, 6, 7, 8, 9)] + ["Straße", "naïveté", "NAÏVETÉ", "wordÿÀword"]
    pool = [w for b in base for w in [b] * rng.choice([1, 6, 40])]
    pool += [edited(rng, w) for w in base for _ in range(3) if len(w) > 5]
    return [(i, " ".join(rng.choices(pool, k=150)) + rng.choice([".", "\n1", ""]))
            for i in range(texts)]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = corpus(seed)
    assert run(spark, rows) == brute(rows)


def test_split_buckets_and_small_tiles(spark, monkeypatch):
    monkeypatch.setattr(spelling, "TILE", 3)
    monkeypatch.setattr(spelling, "CELLS", 20)
    rows = corpus(3)
    assert run(spark, rows) == brute(rows)


def test_a_whole_table(spark, sf_small):
    from casetrail.llm import queries
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted(map(tuple, queries.op13_spelling(spark, sf_small).collect()), key=repr) == want
    assert any(w[1] for w in want)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="abé", min_size=6, max_size=8), unique=True, max_size=12))
def test_tiles_find_each_pair_once(block):
    for longer in (6, 7, 8):
        mine = [w for w in block if len(w) in (longer, longer - 1)]
        want = sorted(tuple(sorted((a, b))) for i, a in enumerate(mine) for b in mine[:i]
                      if one_edit(a, b) and max(len(a), len(b)) == longer)
        found = list(spelling.near_pairs(mine, None, longer, 0)) if mine else []
        assert sorted(tuple(sorted(p)) for p in found) == want
        two = list(spelling.near_pairs(mine[:4], mine[4:], longer, 0)) if mine else []
        cut = [p for p in want if (p[0] in mine[:4]) != (p[1] in mine[:4])]
        assert sorted(tuple(sorted(p)) for p in two) == cut


def test_nulls_ties_repeats_and_long_words(spark):
    rows = [(None, "letters letters letters"), (1, None), (2, ""), (3, "lettera " * 4),
            (3, "lettera " * 4), (3, "letterb " * 8), (4, "lettersx " * 400), (5, "letterz"),
            (6, ("q" * 3000 + " ") * 5 + ("q" * 3001 + " ") * 30), (7, "letters letters")]
    assert run(spark, rows) == brute(rows)
    # equal frequencies: the smaller word is the form
    tied = [(i, "abcdeg " * 30 + "abcdeh " * 30 + "abcdef ") for i in range(1, 7)]
    got = {r[0]: r for r in run(spark, tied)}
    assert got == {r[0]: r for r in brute(tied)} and got["abcdef"][1] == "abcdeg"


def test_forms_of_forms_have_one_root(spark):
    chain = ["aaaaaa", "aaaaab", "aaaabb", "aaabbb", "aabbbb"]
    rows = [(i, f"{w} " * (5 * 5 ** k)) for k, w in enumerate(chain) for i in [k + 10]]
    got = run(spark, rows)
    assert got == brute(rows) and {r[2] for r in got} == {"aabbbb"}


def test_empty_table(spark):
    assert run(spark, []) == []
