"""SimHash near-duplicates by a generalised pigeonhole search over fingerprints.

The 64 bits are grouped into parts so that correlated bits share a part.  If two fingerprints
differ in at most ``distance`` bits, then for any thresholds T with sum(T + 1) = distance + 1
some part differs in at most its T bits (T = -1 leaves a part out).  Dynamic programming
allots the thresholds, and the number of parts, by the estimated cost: rows to probe plus
candidates to verify, both measured on a bounded sample of fingerprints (``SAMPLE``).  The
sample only decides how fast the search is; any layout finds every link.

Equal fingerprints are one fingerprint for the search, so exact copies cost nothing.  A probe
row goes to every key within its part's threshold; a bucket is verified where it lands and gives
a spanning forest of its links, never all its pairs.  A bucket beyond the block size is cut into
blocks, and each pair of blocks is verified apart from the others.

Defined cases: words are runs without ASCII white space, A-Z lower-cased; fewer words than a
shingle hash as one sequence; no words (null or empty text) give fingerprint zero, linked like
any other; component_id is the smallest non-null doc_id reachable (null if all are); repeated
rows each get their row; extra columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import components
from .common import columns, fresh, stored, tasks, texts

BITS = 64
SHINGLE, DISTANCE, SEED = 4, 4, 42
#: Bound of the fingerprint sample that shapes the search.
SAMPLE = 2048
#: Cost of a shuffled probe row in verified pairs.
ROW_COST = 100
#: A bucket is cut into blocks beyond this size, or beyond four times the mean bucket.
BLOCK = 1024
_CHUNK = 1 << 16


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """Majority bits of the shingles' hashes, as an unsigned 64-bit number."""
    words = text.encode().lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    n = max(1, len(words) - shingle + 1)
    first = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    last = ends[min(shingle, len(words)) - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(BITS, np.int64)
    for at in range(0, n, _CHUNK):
        hashes = np.fromiter((digest(line[a:b], SEED) for a, b in
                              zip(first[at:at + _CHUNK], last[at:at + _CHUNK])), "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprint_column(text: Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint of a text column as a signed long with the same bits."""
    @F.arrow_udf("long")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            marks = np.array([fingerprint(t, shingle) for t in texts(column)], np.uint64)
            yield pa.array(marks.view(np.int64))
    return of(text)


# --- the layout of the search -------------------------------------------------------------

def group_bits(sample: np.ndarray, parts: int) -> list[list[int]]:
    """Bits dealt into ``parts`` groups of nearly equal size, correlated bits together."""
    bits = (sample[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)
    centred = bits.astype(float) - bits.mean(axis=0)
    spread = np.sqrt((centred ** 2).sum(axis=0))
    spread[spread == 0] = np.inf
    tie = np.abs(centred.T @ centred) / np.outer(spread, spread)
    free, groups = set(range(BITS)), []
    for left in range(parts, 0, -1):
        size = len(free) // left + (len(free) % left > 0)
        order = sorted(free)
        group = [max(order, key=lambda b: (tie[b, order].sum(), -b))]
        while len(group) < size:
            rest = [b for b in order if b not in group]
            group.append(max(rest, key=lambda b: (tie[b, group].sum(), -b)))
        free -= set(group)
        groups.append(sorted(group))
    return groups


def allot(costs: list[list[float]], total: int) -> tuple[float, list[int]]:
    """Thresholds (from -1) with the given sum of (threshold + 1) and the least total cost.

    ``costs[i][e + 1]`` is the cost of part i at threshold e.
    """
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for part in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for spent, (cost, chosen) in best.items():
            for more, extra in enumerate(part):
                at = spent + more
                if at <= total and (at not in step or cost + extra < step[at][0]):
                    step[at] = (cost + extra, [*chosen, more - 1])
        best = step
    return best[total]


def plan(sample: np.ndarray, n: int, distance: int = DISTANCE) -> list[tuple[list[int], int]]:
    """(bits, threshold) of every part in use for ``n`` fingerprints like the sample."""
    differ = np.triu_indices(len(sample), 1)
    scale = n * n / 2 / max(1, len(differ[0]))
    best = (np.inf, [])
    for parts in range(2, distance + 2):
        groups = group_bits(sample, parts)
        costs = []
        for group in groups:
            mask = np.uint64(sum(1 << b for b in group))
            apart = np.bitwise_count((sample[differ[0]] ^ sample[differ[1]]) & mask)
            part, probes = [0.0], 0
            for e in range(3):
                probes += comb(len(group), e)
                uniform = n * n / 2 * probes / 2 ** len(group)
                candidates = max(uniform, scale * float((apart <= e).sum()))
                part.append(n * (1 + probes * (e > 0)) * ROW_COST + candidates)
            costs.append(part)
        cost, chosen = allot(costs, distance + 1)
        if cost < best[0]:
            best = (cost, [(g, e) for g, e in zip(groups, chosen) if e >= 0])
    return best[1]


# --- probe and verify ---------------------------------------------------------------------

def _signed(n: int) -> int:
    return n - (1 << 64) if n >= 1 << 63 else n


def probe_rows(marks: DataFrame, layout: list[tuple[list[int], int]]) -> DataFrame:
    """(part, key, exact, mark): a fingerprint's own bucket in each part, and the buckets of
    keys within the part's threshold."""
    rows = []
    for part, (bits, most) in enumerate(layout):
        mask = F.lit(_signed(sum(1 << b for b in bits)))
        own = F.col("mark").bitwiseAND(mask)
        rows.append(F.array(F.struct(F.lit(part).alias("part"), own.alias("key"),
                                     F.lit(True).alias("exact"))))
        flips = [_signed(sum(1 << b for b in chosen))
                 for e in range(1, most + 1) for chosen in combinations(bits, e)]
        if flips:
            rows.append(_flipped(part, own, flips))
    return marks.select("mark", F.explode(F.concat(*rows)).alias("r")).select("r.*", "mark")


def _flipped(part: int, own: Column, flips: list[int]) -> Column:
    return F.transform(F.array(*map(F.lit, flips)), lambda flip: F.struct(
        F.lit(part).alias("part"), own.bitwiseXOR(flip).alias("key"), F.lit(False).alias("exact")))


def spanning_links(marks: np.ndarray, exact: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """A spanning forest of a bucket's links between own members, and own members and probes."""
    n = len(marks)
    if n <= 512:
        near = np.bitwise_count(marks[:, None] ^ marks[None, :]) <= distance
        if np.count_nonzero(near) == n:
            return []
    links = []
    left = np.arange(n)
    while left.size:
        queue, left = [left[0]], left[1:]
        while queue and left.size:
            u = queue.pop()
            reach = np.bitwise_count(marks[left] ^ marks[u]) <= distance
            if not exact[u]:
                reach &= exact[left]
            found = left[reach]
            if found.size:
                links += [(marks[u], marks[v]) for v in found]
                queue += found.tolist()
                left = left[~reach]
    return links


def _verify(distance: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(rows):
            links = np.array(spanning_links(rows["mark"].view(np.uint64), rows["exact"], distance),
                             np.uint64).reshape(-1, 2).view(np.int64)
            return pa.record_batch([pa.array(links[:, 0]), pa.array(links[:, 1])], ["a", "b"])

        kept = None
        for batch in batches:
            names = ("part", "key", "i", "j", "exact", "mark")
            now = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in names}
            if kept is not None:
                now = {c: np.concatenate([kept[c], now[c]]) for c in names}
            n = len(now["mark"])
            change = np.zeros(n, bool)
            for c in names[:4]:
                change[1:] |= now[c][1:] != now[c][:-1]
            cuts = [0, *np.flatnonzero(change).tolist()]
            for a, b in zip(cuts, cuts[1:]):
                if b - a > 1:
                    out = done({c: now[c][a:b] for c in names})
                    if out.num_rows:
                        yield out
            kept = {c: now[c][cuts[-1]:] for c in names}
        if kept is not None:
            yield done(kept)
    return run


def links_between(marks: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Links (a, b) whose components are those of all pairs of ``mark`` (distinct fingerprints)
    within ``distance`` bits."""
    sample = np.array([r.mark for r in marks.orderBy(F.xxhash64("mark"), "mark")
                       .limit(SAMPLE).collect()], np.int64).view(np.uint64)
    layout = plan(sample, marks.count(), distance) if len(sample) > 1 else [([0], 0)]
    rows = probe_rows(marks, layout)
    sizes = rows.groupBy("part", "key").agg(F.count(F.lit(1)).alias("n"))
    mean = sizes.agg(F.avg("n")).first()[0] or 0.0
    block = max(BLOCK, int(4 * mean))
    large = stored(sizes.filter(F.col("n") > block)
                   .select("part", "key", F.ceil(F.col("n") / block).cast("int").alias("blocks")),
                   "large-buckets")
    own = F.pmod(F.xxhash64("mark"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1))
    cut = (rows.join(large, ["part", "key"], "left")
           .withColumn("own", F.coalesce(own, F.lit(0))).withColumn("other", other)
           .select("part", "key", F.least("own", "other").alias("i"),
                   F.greatest("own", "other").alias("j"), "exact", "mark"))
    dealt = (cut.repartition(tasks(marks.sparkSession), "part", "key", "i", "j")
             .sortWithinPartitions("part", "key", "i", "j"))
    return dealt.mapInArrow(_verify(distance), "a long, b long")


def component_of(marks: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(mark, root, component_id): each fingerprint's component and the least doc_id in it.

    ``marks`` has doc_id and mark; one row per different fingerprint comes back.
    """
    least = stored(marks.groupBy("mark").agg(F.min("doc_id").alias("least")), "fingerprints")
    roots = components.roots(links_between(least.select("mark"), distance))
    rooted = least.join(roots.withColumnRenamed("node", "mark"), "mark", "left").select(
        "mark", "least", F.coalesce("root", "mark").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(ids, "root").select("mark", "root", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE,
                    distance: int = DISTANCE) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``."""
    marks = stored(docs.select("doc_id", fingerprint_column(F.col("text"), shingle).alias("mark")),
                   "simhash")
    return marks.join(component_of(marks, distance), "mark").select(
        "doc_id", F.lower(F.lpad(F.hex("mark"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row of every group of near-duplicates, that of its least doc_id, with all columns.

    Ids that name one row are kept by a semi join.  Rows that share an id (or have none) are
    told apart by their fingerprint, and one of equals stays.
    """
    marks = stored(docs.select("doc_id", fingerprint_column(F.col("text"), shingle).alias("mark")),
                   "simhash")
    first = stored(component_of(marks, distance), "components")
    own, joint, mark, root, least = (fresh(n, docs) for n in ("_kept", "_shared", "_mark", "_root",
                                                              "_least"))
    kept = (marks.join(first, "mark").filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
            .select(F.col("doc_id").alias(own)))
    shared = stored(marks.groupBy(F.col("doc_id").alias(joint))
                    .agg(F.count(F.lit(1)).alias("n"))
                    .filter((F.col("n") > 1) | F.col(joint).isNull()).select(joint), "shared-ids")
    lone = stored(kept.join(shared, F.col(own).eqNullSafe(F.col(joint)), "left_anti"), "kept-ids")
    alone = docs.join(lone, docs["doc_id"] == lone[own], "left_semi").select(*columns(docs))
    again = (docs.join(shared, docs["doc_id"].eqNullSafe(shared[joint]), "left_semi")
             .withColumn(mark, fingerprint_column(F.col("text"), shingle))
             .join(first.withColumnsRenamed({"mark": mark, "root": root, "component_id": least}),
                   mark)
             .filter(F.col("doc_id").eqNullSafe(F.col(least)))
             .dropDuplicates([root]).select(*columns(docs)))
    return alone.unionByName(again)
