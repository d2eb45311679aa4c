"""SimHash fingerprints, the pigeonhole search and components against brute force."""

import re
from itertools import combinations, product

import numpy as np
import pytest
import xxhash

from casetrail.llm import components, queries, simhash


def brute_mark(text, k=4):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    grams = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows, distance=4):
    """rows: (doc_id, mark) -> least doc_id of every row's component."""
    marks = sorted({m for _, m in rows})
    root = {m: m for m in marks}

    def find(m):
        while root[m] != m:
            m = root[m]
        return m
    for a, b in combinations(marks, 2):
        if (a ^ b).bit_count() <= distance:
            root[find(a)] = find(b)
    least = {}
    for doc_id, m in rows:
        if doc_id is not None:
            least[find(m)] = min(doc_id, least.get(find(m), doc_id))
    return [least.get(find(m)) for _, m in rows]


TEXTS = ["", None, " \t\n", "one", "One two", "one two three four five É é", "x " * 3000,
         "A b c d e f g", "a B c d e f g", "a b c d e f h"]


@pytest.mark.parametrize("text", TEXTS)
def test_fingerprint(text):
    assert simhash.fingerprint(text or "") == brute_mark(text)


def test_thresholds_are_the_cheapest_of_all():
    costs = [[0, 5, 9], [0, 1, 9], [0, 4, 4.5]]
    every = [(sum(c[e] for c, e in zip(costs, choice)), choice)
             for choice in product(range(3), repeat=3) if sum(choice) == 5]
    cost, chosen = simhash.allot(costs, 5)
    assert cost == min(every)[0] and sum(e + 1 for e in chosen) == 5


def test_search_finds_every_link(spark):
    rng = np.random.default_rng(0)
    centres = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    marks = set()
    for c in centres:                       # clusters of several sizes and radii
        for _ in range(int(rng.integers(1, 60))):
            flips = rng.choice(64, int(rng.integers(0, 7)), replace=False)
            marks.add(int(c) ^ sum(1 << int(b) for b in flips))
    rows = [(i if i % 7 else None, m) for i, m in enumerate(sorted(marks) * 2)]
    df = spark.createDataFrame([(i, simhash._signed(m)) for i, m in rows], "doc_id long, mark long")
    want = dict(zip([m for _, m in rows], brute_components(rows)))
    old = simhash.BLOCK
    try:
        for block in (old, 3):              # the second cuts buckets into blocks
            simhash.BLOCK = block
            got = {r.mark % (1 << 64): r.component_id
                   for r in simhash.component_of(df).collect()}
            assert got == want
    finally:
        simhash.BLOCK = old


def test_layouts_with_wider_thresholds(spark):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    marks = np.unique(np.concatenate([base, base ^ np.uint64(0b1011), base ^ np.uint64(1 << 50)]))
    df = spark.createDataFrame([(simhash._signed(int(m)),) for m in marks], "mark long")
    layout = [(list(range(0, 32)), 2), (list(range(32, 64)), 1)]
    rows = simhash.probe_rows(df, layout)
    found = set()
    by_key = {}
    for r in rows.collect():
        by_key.setdefault((r.part, r.key), []).append((r.mark, r.exact))
    for members in by_key.values():
        for (a, ea), (b, eb) in combinations(members, 2):
            if (ea or eb) and a != b and ((a ^ b) % (1 << 64)).bit_count() <= 4:
                found.add((min(a, b), max(a, b)))
    want = {(min(a, b), max(a, b)) for a, b in combinations(
        [simhash._signed(int(m)) for m in marks], 2) if ((a ^ b) % (1 << 64)).bit_count() <= 4}
    assert found == want


def test_components_of_a_star_and_a_path(spark):
    links = [(100, i) for i in range(200, 260)] + [(i, i + 1) for i in range(40)] + [(7, 7)]
    got = {r.node: r.root for r in components.roots(
        spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(200, 260)}, **{i: 0 for i in range(1, 41)}}


def test_query(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").collect()
    rows = [(d.doc_id, brute_mark(d.text)) for d in docs]
    want = {i: (f"{m:016x}", c) for (i, m), c in zip(rows, brute_components(rows))}
    got = {r.doc_id: (r.fingerprint, r.component_id)
           for r in queries.op2_simhash(spark, sf_small).collect()}
    assert got == want


def test_keep_one(spark):
    long = " ".join(f"word{i}" for i in range(300))
    rows = [(5, long, 1), (3, long, 2), (3, long, 3), (9, "other text here now", 4),
            (3, "a third text of its own", 5), (None, "", 6), (4, None, 7), (None, "no id here", 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, mark int")
    out = simhash.keep_one(df)
    assert out.columns == df.columns
    kept = sorted(r.mark for r in out.collect())
    assert kept in ([2, 4, 5, 7, 8], [3, 4, 5, 7, 8])
    assert simhash.keep_one(df.limit(0)).collect() == []
    assert simhash.near_duplicates(df.limit(0)).collect() == []
