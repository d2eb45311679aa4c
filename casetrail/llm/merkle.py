"""Merkle manifest of a table: leaf digests, a subroot per group, one root, inclusion proofs.

A leaf is the digest of a row's columns; leaves of a group ascend by ``doc_id``, and every
``ARITY`` consecutive nodes of a level become their digest until one node remains, the group's
subroot.  The subroots, ordered by group, make the root in the same way.

Method: *concatenated-level strings*.  The leaves of a group are cut into aligned blocks of
``BLOCK`` = ``ARITY`` ** ``LEVELS`` positions.  A block keeps each of its levels as one hex string:
a substring of ``ARITY`` fixed-width digests is what the parent hashes, and what flanks a node's
digest in that substring is its sibling segment.  The blocks' own digests are the leaves of the
next, 512 times smaller, round; the rounds recurse until every group has one block.

Scale: positions come from one range shuffle by (group, doc_id) of digests, not of texts, so a
group that holds all rows spreads over all tasks; per task and group one count goes into a window.
A task holds one block of at most ``BLOCK`` rows at a time.  Each round is a written table.

Defined cases: a null value counts as ``-``, an empty text as ``0:``; a null group and a null
doc_id come first; rows with equal doc_id ascend by leaf digest, equal rows have equal leaves, each
with its own position; a lone leaf is its group's subroot, a lone subroot the root; extra columns
are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, tasks

ARITY, LEVELS = 8, 3
BLOCK = ARITY ** LEVELS
#: Hex digits of a digest, and of a full run of siblings.
DIGEST = 64
RUN = ARITY * DIGEST
#: The columns of a leaf, in their order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_NO_PATH = "array<struct<left:string,right:string>>"


def leaf(values: list[Column]) -> Column:
    """Digest of the values: ``-`` for a null, else byte count, colon and value."""
    def part(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
    return F.sha2(F.concat(*[part(v) for v in values]).cast("binary"), 256)


def group_key(group: Column) -> Column:
    """A string that orders like the group's UTF-8 bytes, a null first."""
    return F.coalesce(F.concat(F.lit("+"), group.cast("string")), F.lit(""))


def _bound(value: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn(value)`` with ``value`` held in a lambda variable, so that it is computed once."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def _parents(level: Column) -> Column:
    """The level above: the digests of its runs as one string."""
    return _bound(level, lambda s: F.array_join(F.transform(
        F.sequence(F.lit(0), F.floor((F.length(s) - 1) / RUN).cast("int")),
        lambda run: F.sha2(F.substring(s, run * RUN + 1, F.lit(RUN)).cast("binary"), 256)), ""))


def _height(n: Column) -> Column:
    """Levels that a block climbs, in a group of ``n`` nodes."""
    return sum(((n > ARITY ** i).cast("int") for i in range(LEVELS)), F.lit(0))


def ranked(rows: DataFrame) -> DataFrame:
    """``rows`` (key, by, node, ...) with ``at``, the position by (by, node) in the key, and ``n``,
    the key's rows.  Rows that are equal in all three may stand in any order."""
    order = ["key", F.col("by").asc_nulls_first(), "node", "salt"]
    spread = (rows.withColumn("salt", F.monotonically_increasing_id())
              .repartitionByRange(tasks(rows.sparkSession), *order).sortWithinPartitions(*order)
              .drop("salt").withColumn("task", F.spark_partition_id())
              .withColumn("nth", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    placed = stored(spread, "merkle-leaves")
    held = placed.groupBy("task", "key").agg(F.min("nth").alias("first"),
                                             F.count(F.lit(1)).alias("held"))
    by_key = Window.partitionBy("key")
    before = by_key.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = held.select("task", "key", F.sum("held").over(by_key).alias("n"),
                         (F.coalesce(F.sum("held").over(before), F.lit(0)) - F.col("first"))
                         .alias("shift"))
    return (placed.join(starts, ["task", "key"])
            .withColumn("at", F.col("nth") + F.col("shift")).drop("task", "nth", "shift"))


def blocks(rows: DataFrame) -> DataFrame:
    """One row for each aligned block of ``rows`` (key, n, at, node, ...): its members' other
    columns, its levels as strings, and the node that it becomes."""
    rest = [c for c in rows.columns if c not in ("key", "n", "at", "node")]
    made = (rows.groupBy("key", "n", F.floor(F.col("at") / BLOCK).alias("block"))
            .agg(F.sort_array(F.collect_list(F.struct("at", "node", *rest))).alias("members")))
    made = made.select(
        "key", "n", "block",
        F.transform("members", lambda m: F.struct(m["at"].alias("at"),
                                                  *[m[c].alias(c) for c in rest])).alias("members"),
        F.array_join(F.transform("members", lambda m: m["node"]), "").alias("level0"))
    height = _height(F.col("n"))
    for i in range(1, LEVELS + 1):
        made = made.withColumn(f"level{i}", F.when(height >= i, _parents(F.col(f"level{i - 1}"))))
    top = F.coalesce(*[F.col(f"level{i}") for i in range(LEVELS, -1, -1)])
    return made.withColumn("node", top).drop(f"level{LEVELS}")


def _segments(at: Column, height: Column) -> Column:
    """What flanks the node of position ``at`` on every level of its block: [(left, right)]."""
    at = at % BLOCK
    steps = []
    for i in range(LEVELS):
        nth = F.floor(at / ARITY ** i).cast("int")
        run, place = F.floor(nth / ARITY).cast("int"), nth % ARITY
        level = F.col(f"level{i}")
        steps.append(F.struct(
            F.substring(level, run * RUN + 1, place * DIGEST).alias("left"),
            F.substring(level, (nth + 1) * DIGEST + 1, (ARITY - 1 - place) * DIGEST).alias("right")))
    return F.slice(F.array(*steps), F.lit(1), height)


def climb(made: DataFrame, most: int) -> DataFrame:
    """(key, block, root, path) for every block of ``made``: the segments from its node up to its
    key's root.  ``most`` is the largest number of nodes of one key below the blocks."""
    if most <= BLOCK:
        return made.select("key", "block", F.col("node").alias("root"),
                           F.array().cast(_NO_PATH).alias("path"))
    upper = stored(blocks(made.select("key", F.ceil(F.col("n") / BLOCK).alias("n"),
                                      F.col("block").alias("at"), "node")), "merkle-round")
    above = climb(upper, -(-most // BLOCK))
    return members(upper, above).select("key", F.col("at").alias("block"), "root", "path")


def members(made: DataFrame, above: DataFrame) -> DataFrame:
    """Every member of the blocks with its node, its root and its path there."""
    names = made.schema["members"].dataType.elementType.names
    height = _height(F.col("n"))
    joined = made.join(above.withColumnRenamed("path", "rest"), ["key", "block"])
    each = F.transform("members", lambda m: F.struct(
        *[m[c].alias(c) for c in names],
        F.substring(F.col("level0"), (m["at"] % BLOCK * DIGEST + 1).cast("int"), F.lit(DIGEST))
        .alias("node"),
        F.concat(_segments(m["at"], height), F.col("rest")).alias("path")))
    return joined.select("key", "root", F.inline(each))


def tree(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(blocks, paths of the blocks) of the trees over ``rows`` (key, by, node, ...), one a key."""
    made = stored(blocks(ranked(rows)), "merkle-blocks")
    most = made.agg(F.max("n")).first()[0] or 0
    return made, stored(climb(made, most), "merkle-paths")


def proofs(docs: DataFrame, altered: Column | None = None) -> DataFrame:
    """(doc_id, leaf, subroot, root, path, altered) for every row of ``docs``.

    ``path`` lists the sibling segments (left, right) of every level from the leaf by the subroot
    to the root.  ``altered`` is any column of ``docs`` to carry along with the leaf.
    """
    rows = docs.select(group_key(F.col("lang")).alias("key"), F.col("doc_id").alias("by"),
                       leaf([F.col(c) for c in FIELDS]).alias("node"),
                       (F.lit(None).cast("string") if altered is None else altered).alias("altered"))
    made, paths = tree(rows)
    subroots = paths.filter("block = 0").select(F.lit("").alias("key"), F.col("key").alias("by"),
                                                F.col("root").alias("node"))
    top = members(*tree(subroots)).select(F.col("by").alias("key"), F.col("root").alias("whole"),
                                          F.col("path").alias("last"))
    above = paths.join(top, "key").select(
        "key", "block", F.struct(F.col("root").alias("subroot"), F.col("whole").alias("root"))
        .alias("root"), F.concat("path", "last").alias("path"))
    return members(made, above).select(F.col("by").alias("doc_id"), F.col("node").alias("leaf"),
                                       "root.subroot", "root.root", "path", "altered")


def fold(node: Column, path: Column) -> Column:
    """The root that a leaf digest and its sibling segments lead to."""
    return F.aggregate(path, node, lambda below, s: F.sha2(
        F.concat(s["left"], below, s["right"]).cast("binary"), 256))


def tampered(docs: DataFrame) -> Column:
    """The leaf with the text's A-Z lower-cased, where 3 divides the doc_id's crc32; else null."""
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(chosen, leaf([lower if c == "text" else F.col(c) for c in FIELDS]))


def digest(found: DataFrame) -> DataFrame:
    """Proof digests, and the check of every (altered, else original) leaf against the root."""
    siblings = F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), "")
    return found.select(
        "doc_id", "leaf", "subroot", "root",
        F.sha2(siblings.cast("binary"), 256).alias("proof_sha256"),
        fold(F.coalesce("altered", "leaf"), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


#: The same rows by recursive SQL: levels are tables of nodes, a proof is a join of every level.
ORACLE_SQL = """
WITH RECURSIVE lowered AS (
  SELECT *, list_reduce(list_concat([4294967295::BIGINT],
      list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
      lambda crc, b: list_reduce(list_concat([xor(crc, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
          lambda x, z: xor(x >> 1, (x & 1) * 3988292384::BIGINT))) AS crc,
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low
  FROM documents),
leaves AS (
  SELECT doc_id, lang, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS h,
    CASE WHEN xor(crc, 4294967295::BIGINT) % 3 = 0
         THEN sha256(head || coalesce(strlen(low) || ':' || low, '-')) END AS bad
  FROM (SELECT *, coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-')
      || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
      || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head FROM lowered)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, h) - 1 AS i,
    count(*) OVER (PARTITION BY lang) AS n FROM leaves),
nodes AS (
  SELECT lang, 0 AS lvl, i, n, h FROM placed
  UNION ALL
  SELECT lang, lvl + 1, i // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY i))
  FROM nodes WHERE n > 1 GROUP BY lang, lvl, n, i // 8),
subroots AS (
  SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i,
    count(*) OVER () AS n FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS lvl, i, n, subroot AS h FROM subroots
  UNION ALL
  SELECT lvl + 1, i // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY i))
  FROM tops WHERE n > 1 GROUP BY lvl, n, i // 8),
runs AS (
  SELECT lang, lvl, i // 8 AS run, list(h ORDER BY i) AS hs FROM nodes WHERE n > 1
  GROUP BY lang, lvl, i // 8),
top_runs AS (
  SELECT lvl, i // 8 AS run, list(h ORDER BY i) AS hs FROM tops WHERE n > 1 GROUP BY lvl, i // 8),
walk AS (
  SELECT lang, doc_id, i AS nth, 0 AS lvl, i, coalesce(bad, h) AS h, '' AS proof, n FROM placed
  UNION ALL
  SELECT w.lang, doc_id, nth, w.lvl + 1, i // 8,
    sha256(array_to_string(list_concat(hs[:i % 8], [h], hs[i % 8 + 2:]), '')),
    proof || array_to_string(list_concat(hs[:i % 8], hs[i % 8 + 2:]), ''), (n + 7) // 8
  FROM walk w JOIN runs r
    ON r.lang IS NOT DISTINCT FROM w.lang AND r.lvl = w.lvl AND r.run = w.i // 8 WHERE n > 1),
top_walk AS (
  SELECT w.lang, doc_id, nth, 0 AS lvl, s.i, w.h, proof, s.n
  FROM walk w JOIN subroots s ON s.lang IS NOT DISTINCT FROM w.lang WHERE w.n = 1
  UNION ALL
  SELECT lang, doc_id, nth, w.lvl + 1, i // 8,
    sha256(array_to_string(list_concat(hs[:i % 8], [h], hs[i % 8 + 2:]), '')),
    proof || array_to_string(list_concat(hs[:i % 8], hs[i % 8 + 2:]), ''), (n + 7) // 8
  FROM top_walk w JOIN top_runs r ON r.lvl = w.lvl AND r.run = w.i // 8 WHERE n > 1)
SELECT p.doc_id, p.h AS leaf, s.subroot, t.h AS root, sha256(w.proof) AS proof_sha256,
  w.h AS folded_root, w.h = t.h AS verified
FROM top_walk w
JOIN placed p ON p.lang IS NOT DISTINCT FROM w.lang AND p.i = w.nth
JOIN subroots s ON s.lang IS NOT DISTINCT FROM w.lang
JOIN tops t ON t.n = 1
WHERE w.n = 1
"""
