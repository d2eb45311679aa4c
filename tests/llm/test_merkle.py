"""Merkle manifest against a plain tree, at several sizes, and the defined cases."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from casetrail.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, at int, node string"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def plain_leaf(row):
    def part(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"
    return sha("".join(map(part, row[:5])))


def plain_tree(nodes):
    """The root, and for every node the sibling runs (left, right) up to it."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for j, i in enumerate(at):
            run = i // 8 * 8
            paths[j].append(("".join(nodes[run:i]), "".join(nodes[i + 1:run + 8])))
            at[j] = i // 8
        nodes = [sha("".join(nodes[i:i + 8])) for i in range(0, len(nodes), 8)]
    return nodes[0], paths


def plain(rows):
    langs = sorted({r[2] for r in rows}, key=lambda v: (v is not None, (v or "").encode()))
    trees = []
    for lang in langs:
        mine = sorted((r for r in rows if r[2] == lang),
                      key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r)))
        trees.append((mine, *plain_tree([plain_leaf(r) for r in mine])))
    root, tops = plain_tree([t[1] for t in trees]) if trees else (None, [])
    out = []
    for (mine, subroot, paths), top in zip(trees, tops):
        for r, path in zip(mine, paths):
            path = path + top
            h = plain_leaf(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None:
                low = "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4])
                h = plain_leaf((*r[:4], low))
            for left, right in path:
                h = sha(left + h + right)
            out.append((r[0], plain_leaf(r), subroot, root,
                        sha("".join(a + b for a, b in path)), h, h == root))
    return sorted(out, key=repr)


def spark_rows(spark, rows):
    df = spark.createDataFrame([(*r, 1, "mine") for r in rows], SCHEMA).repartition(3)
    got = merkle.digest(merkle.proofs(df, merkle.tampered(df)))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
                           "verified"]
    return sorted(map(tuple, got.collect()), key=repr)


def make(n, langs, seed):
    rng = random.Random(seed)
    return [(i, rng.choice(["web", None]), rng.choice(langs), i % 7, rng.choice(
        ["", "Some Text", "ÄÖ lower", None, "same"])) for i in rng.sample(range(n * 3), n)]


@pytest.mark.parametrize("rows", [
    make(1, ["en"], 1), make(9, ["en"], 2), make(65, ["en", None, "de", "é", ""], 3),
    make(700, ["en"] * 9 + ["de"], 4), make(60, [f"l{i}" for i in range(30)], 5),
    make(520, ["one"], 6) + make(40, [None], 7),
])
def test_equals_a_plain_tree(spark, rows):
    assert spark_rows(spark, rows) == plain(rows)


def test_three_rounds(spark, monkeypatch):
    monkeypatch.setattr(merkle, "LEVELS", 1)
    monkeypatch.setattr(merkle, "BLOCK", 8)
    rows = make(600, ["en", "en", "de"], 8)
    assert spark_rows(spark, rows) == plain(rows)


def test_null_ids_ties_repeats_and_long_texts(spark):
    rows = [(None, "a", "en", 1, "x"), (None, None, None, None, None), (5, "a", "en", 2, "B"),
            (5, "a", "en", 2, "A"), (5, "a", "en", 2, "A"), (5, "a", "en", 2, "A"),
            (6, "", "", 0, ""), (7, "b", "en", 3, "Ab" * 400_000)]
    assert spark_rows(spark, rows) == plain(rows)


def test_empty_table(spark):
    assert spark_rows(spark, []) == []


def test_a_group_of_all_rows_spreads_over_tasks(spark):
    df = spark.range(4000).select(F.lit("k").alias("key"), F.col("id").alias("by"),
                                  F.sha2(F.col("id").cast("string"), 256).alias("node"))
    got = merkle.ranked(df.repartition(4))
    assert [r.at for r in got.orderBy("by").collect()] == list(range(4000))
    assert {r.n for r in got.select("n").distinct().collect()} == {4000}
