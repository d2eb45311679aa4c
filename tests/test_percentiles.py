"""Exact percentile_cont against a brute-force reference on small data."""

import math
import random

from pyspark.sql import functions as F

from casetrail.operators.percentiles import percentiles


def brute(values, p):
    xs = sorted(v for v in values if v is not None)
    if not xs:
        return None
    pos = (len(xs) - 1) * p
    lo, hi = math.floor(pos), math.ceil(pos)
    return xs[lo] + (xs[hi] - xs[lo]) * (pos - lo)


def test_matches_brute_force_with_skew_and_nulls(spark):
    rnd = random.Random(7)
    rows = []
    for g in range(6):
        n = 3000 if g == 0 else rnd.randint(0, 40)   # group 0 is hot
        for _ in range(n):
            rows.append((g, None if rnd.random() < 0.1 else rnd.randint(0, 60),
                         rnd.choice([None, rnd.randint(0, 5)])))
    rows.append((9, None, None))                     # all-null group
    df = spark.createDataFrame(rows, "g int, x int, y int")
    out = {r.g: r for r in percentiles(
        df, ["g"], {"x": "x", "y": "y"},
        {"p50": ("x", 0.5), "p75": ("x", 0.75), "p90": ("x", 0.9), "y50": ("y", 0.5)}).collect()}
    groups = {}
    for g, x, y in rows:
        groups.setdefault(g, ([], []))
        groups[g][0].append(x)
        groups[g][1].append(y)
    for g, (xs, ys) in groups.items():
        got = out.get(g)
        for col, vals, p in (("p50", xs, 0.5), ("p75", xs, 0.75), ("p90", xs, 0.9), ("y50", ys, 0.5)):
            expected = brute(vals, p)
            actual = None if got is None else got[col]
            assert actual == expected, (g, col, actual, expected)


def test_approx_opt_in_close_to_exact(spark):
    rnd = random.Random(3)
    rows = [(g, rnd.randint(0, 1000)) for g in range(3) for _ in range(500)]
    df = spark.createDataFrame(rows, "g int, x int")
    exact = {r.g: r.p50 for r in percentiles(df, ["g"], {"x": "x"}, {"p50": ("x", 0.5)}).collect()}
    approx = {r.g: r.p50 for r in percentiles(df, ["g"], {"x": "x"}, {"p50": ("x", 0.5)},
                                              approx=True).collect()}
    assert set(exact) == set(approx)
    assert all(abs(exact[g] - approx[g]) <= 5 for g in exact)


def test_approximate_path_keeps_the_extra_columns(spark):
    from casetrail.operators import percentiles as P
    df = spark.createDataFrame([("a", 1), ("a", 3), ("a", None), ("b", 5)], "g string, v int")
    measures = {"v": "v", "one": F.lit(1)}
    extra = {"n": P.cell_count("one"), "total": P.cell_sum("v")}
    exact, rough = (P.percentiles(df, ["g"], measures, {"p50": ("v", 0.5)}, approx=a, extra=extra)
                    for a in (False, True))
    assert sorted(exact.columns) == sorted(rough.columns)
    assert {r.g: (r.n, r.total) for r in rough.collect()} == {"a": (3, 4), "b": (1, 5)}


def test_one_exchange_above_the_counts(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("b", 5)], "g string, v int")
    plan = percentiles(df, ["g"], {"v": "v", "w": F.col("v") * 2},
                       {"p50": ("v", 0.5), "p90": ("v", 0.9), "w50": ("w", 0.5)})
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 2          # the counts and one above
    assert "Window" not in text


def test_stored_lists_merge_like_base_rows(spark):
    from casetrail.operators import percentiles as P
    rnd = random.Random(11)
    rows = [(d, rnd.choice("ab"), None if rnd.random() < 0.2 else rnd.randint(-5, 400))
            for d in range(90) for _ in range(rnd.randint(0, 30))] + [(200, "c", None)]
    df = spark.createDataFrame(rows, "d int, g string, x int").withColumn("m", F.expr("d div 30"))
    measures = {"_rows": F.lit(1), "x": "x"}
    outputs = {"p50": ("x", 0.5), "p75": ("x", 0.75), "p90": ("x", 0.9)}
    extra = {"n": P.cell_count("x"), "total": P.cell_sum("x")}
    lists = P.value_lists(df, ["d", "m", "g"], measures)
    merged = P.from_counts(P.merge_value_lists(lists, ["m", "g"]), ["m", "g"], outputs, extra)
    want = P.percentiles(df, ["m", "g"], measures, outputs, extra=extra)
    key = lambda r: (r.m, r.g)
    assert sorted(merged.collect(), key=key) == sorted(want.collect(), key=key)
    assert [r.p50 for r in merged.where("g = 'c'").collect()] == [None]
    empty = P.value_lists(df.where("false"), ["m", "g"], measures)
    assert P.from_counts(P.merge_value_lists(empty, ["m", "g"]), ["m", "g"], outputs).collect() == []
