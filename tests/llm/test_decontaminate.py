"""Decontamination: alignment against a plain Smith-Waterman, planted copies, defined cases."""

import random

import numpy as np

from casetrail.llm import decontaminate as dec
from casetrail.llm import queries


def plain_score(a, b, penalty):
    h = [[0.0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            h[i + 1][j + 1] = max(0, h[i][j] + (1 if x == y and x >= 0 else -penalty),
                                  h[i][j + 1] - penalty, h[i + 1][j] - penalty)
    return max(map(max, h))


def test_align_is_smith_waterman():
    rng = np.random.default_rng(5)
    items = [rng.integers(0, 4, rng.integers(1, 12)) for _ in range(60)]
    windows = [rng.integers(-1, 4, rng.integers(1, 20)) for _ in range(60)]
    for penalty in (0.5, 1.0):
        score, _, _ = dec.align(items, windows, penalty)
        assert np.allclose(score, [plain_score(a.tolist(), b.tolist(), penalty)
                                   for a, b in zip(items, windows)])


def corpus():
    rng = random.Random(6)
    vocabulary = ["w" + str(i) for i in range(5000)]

    def prose(n):
        return [rng.choice(["the", "of", "and"]) if rng.random() < 0.4 else rng.choice(vocabulary)
                for _ in range(n)]
    items = [(i, prose(30)) for i in range(12)]
    docs, leaked = [], {}
    for d in range(120):
        words = prose(rng.randint(20, 200))
        if d % 4 == 0:
            item, copy = rng.choice(items)
            copy = list(copy)
            if d % 8 == 0:                               # edited: replaced, dropped, added words
                for _ in range(4):
                    copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
                del copy[rng.randrange(len(copy))]
                copy.insert(rng.randrange(len(copy)), "extra")
            at = rng.randint(0, len(words))
            words[at:at] = [w.upper() + rng.choice(["", ",", "."]) for w in copy]
            leaked[d] = item
        docs.append((d, " ".join(words)))
    return docs, [(i, " ".join(w)) for i, w in items], leaked


def test_planted_copies(spark, monkeypatch):
    docs, items, leaked = corpus()
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, score int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = sorted(leaked.items())
    got = dec.leaks(df, bench).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == want
    assert all(r.last_word - r.first_word < 40 for r in got)
    monkeypatch.setattr(dec.item_blocks, "__defaults__", (400,))       # several blocks
    assert sorted((r.doc_id, r.item_id) for r in dec.leaks(df, bench).collect()) == want
    kept = dec.drop_leaks(df, bench)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [d for d, _ in docs if d not in leaked]


def test_defined_cases(spark):
    item = "alpha beta gamma delta epsilon zeta"
    docs = spark.createDataFrame(
        [(1, None), (2, ""), (3, "x " * 100_000 + item.upper()), (3, item), (None, item),
         (4, "the one"), (5, "clean text")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "one"), (1, item)],
                                  "item_id long, text string")
    got = sorted(((r.doc_id or 0, r.item_id) for r in dec.leaks(docs, bench).collect()))
    assert got == [(0, 1), (0, 1), (3, 1), (3, 1), (3, 1), (3, 1), (4, 4)]
    assert dec.leaks(docs.limit(0), bench).collect() == []
    assert dec.leaks(docs, bench.limit(0)).collect() == []
    assert dec.drop_leaks(docs, bench.limit(0)).count() == 7


def test_query_against_brute_force(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").collect()
    items = spark.read.parquet(f"{sf_small}/benchmark.parquet").collect()
    block = dec.Items([(i.item_id, i.text) for i in items])
    want = set()
    for d in docs:
        numbers = block.numbers(d.text)
        for item_id, words in zip(block.ids, block.words):
            step = 2000
            for at in range(0, max(1, len(numbers)), step):
                part = numbers[at:at + step + 2 * len(words)]
                if len(part) and dec.align([words], [part])[0][0] / len(words) >= dec.THRESHOLD:
                    want.add((d.doc_id, item_id))
    got = {(r.doc_id, r.item_id) for r in queries.op9_decontaminate(spark, sf_small).collect()}
    assert got == want and want


def test_no_edit_hides_a_copy():
    """Copies without the item's rare words, or with words added everywhere, and long gaps."""
    rng = random.Random(12)
    common = [f"c{i}" for i in range(40)]
    rows = []
    for i in range(40):
        words = [rng.choice(common) for _ in range(rng.randint(1, 40))]
        for k in range(0, len(words), 6):
            words[k] = f"rare{i}x{k}"
        rows.append((i, " ".join(words)))
    items = dec.Items(rows)
    found = 0
    for d in range(150):
        words = [rng.choice(common) for _ in range(rng.randint(0, 60))]
        copy = rng.choice(rows)[1].split()
        if d % 3 == 0:                                   # every rare word replaced
            copy = ["new" if w.startswith("rare") else w for w in copy]
        elif d % 3 == 1:                                 # no two words stay together
            copy = [w for c in copy for w in ((c, "new") if rng.random() < 0.95 else (c,))]
        else:                                            # two halves far apart
            half = len(copy) // 2
            copy = copy[:half] + ["new"] * (len(copy) // 3) + copy[half:]
        words[len(words) // 2:len(words) // 2] = copy
        text = " ".join(words)
        numbers = items.numbers(text)
        want = {}
        for i, item in zip(items.ids, items.words):
            score = dec.align([item], [numbers])[0][0] / len(item)
            if score >= dec.THRESHOLD:
                want[i] = round(float(score), 6)
        got = dec._leaks(items, [text], dec.THRESHOLD)[0]
        assert {f["item_id"]: f["score"] for f in got} == want
        found += len(want)
    assert found > 100


def test_parts_of_a_long_document(monkeypatch):
    items = dec.Items([(1, "a b c d e f g h"), (2, "a a b b")])
    text = "x a " * 50 + "a b c d z e f g h " + "b a y " * 40
    whole = dec._leaks(items, [text], dec.THRESHOLD)
    monkeypatch.setattr(dec, "CELLS", 7)
    assert dec._leaks(items, [text], dec.THRESHOLD) == whole and len(whole[0]) == 2


def test_every_alignment_holds_a_seed():
    """Random edits of an item, seeds by random counts: what scores enough shares a seed."""
    rng = random.Random(8)
    reached = tight = 0
    for _ in range(3000):
        n = rng.randint(1, 14)
        item = [f"i{rng.randint(0, 30)}" for _ in range(n)]
        one, two, _ = dec.grams([" ".join(item)])
        two = two[:-1]
        words, pairs = dec.seeds(np.array([rng.choice([0, 1, 9, 500]) for _ in one], np.int64),
                                 np.array([rng.choice([0, 1, 9, 500]) for _ in two], np.int64))
        own = set(one[words].tolist()), set(two[pairs].tolist())
        share = rng.choice([0.1, 0.3, 0.6, 0.95])
        copy = []
        for k, w in enumerate(item):
            # edits aimed at seeds: added words behind a seed pair, seed words replaced
            hit = k in words or k in pairs
            if rng.random() < (share if hit else share / 3):
                copy += rng.choice([["new"], [], [w, "new"], [w, "new"]])
            else:
                copy.append(w)
        block = dec.Items([(0, " ".join(item))])
        numbers = block.numbers(" ".join(copy))
        score = dec.align(block.words, [numbers])[0][0] / n if len(numbers) else 0
        if score >= dec.THRESHOLD:
            reached += 1
            found = [set(c.tolist()) for c in dec.grams([" ".join(copy)])[:2]]
            assert found[0] & own[0] or found[1] & own[1]
            tight += score < 0.6
    assert reached > 500 and tight > 100


def test_seeds_prefer_rare_grams():
    words, pairs = np.array([900, 1, 900, 2, 3, 900]), np.array([1, 0, 800, 0, 1])
    chosen = dec.seeds(words, pairs)
    assert 2 not in chosen[1] and not set(chosen[0]) & {0, 2, 5}
    assert sorted(chosen[1]) == [0, 1, 3, 4] and sorted(chosen[0]) == [1, 3, 4]
    none = dec.seeds(np.zeros(0, np.int64), np.zeros(0, np.int64))
    assert len(none[0]) == len(none[1]) == 0


def test_codes_of_many_texts():
    whole = ["", "A b, a", None, "  ", "b a", "b", "Stra\u00dfe b a x" + "y" * 40, ""]
    one, two, starts = dec.grams(whole)
    assert starts.tolist() == [0, 0, 3, 3, 3, 5, 6, 10, 10]
    words = [w for t in whole for w in dec.words_of(t)]
    assert len(set(zip(words, one.tolist()))) == len(set(words)) == len(set(one.tolist()))
    assert (two == 0).nonzero()[0].tolist() == [2, 4, 5, 9]
    assert two[1] == two[3] == two[7] and two[0] != two[1]
    assert [len(c) for c in dec.grams([])] == [0, 0, 1]


def test_bitmap_keeps_every_gram(spark):
    codes = np.random.default_rng(3).integers(-2 ** 63, 2 ** 63, 500)
    codes[:3] = [0, -1, dec.BITS]
    df = spark.createDataFrame([(int(c),) for c in codes], "gram long")
    bits = dec.bitmap(df)
    assert len(dec._marked(bits, codes.view(np.uint64))) == 500
    others = np.random.default_rng(4).integers(0, 2 ** 63, 500).astype(np.uint64)
    assert len(dec._marked(bits, others)) < 5
