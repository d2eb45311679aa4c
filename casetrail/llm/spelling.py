"""Spelling variants: words one edit apart, grouped under their most frequent form.

Two words are near if one inserted, deleted or replaced code point turns one into the other.

Method: *dense prefix-suffix tiling*.  Words stand as rows of padded code-point matrices, and a
pair of blocks is compared at once: the length of the common prefix plus that of the common suffix
reaches the longer length minus one exactly where the words are one edit apart.

Which blocks meet.  Of a near pair with the longer length ``m``, prefix or suffix reaches
``half(m)`` = ceil((m - 1) / 2) code points.  So a word of length ``l`` goes to the buckets (side,
m, its first or last ``half(m)`` code points) for m = l and, as the shorter word, m = l + 1; a near
pair shares one.  The suffix side leaves out pairs that the prefix side finds, so a pair is found
once.  A bucket of more than ``TILE`` words is split by hash into blocks, and its block pairs are
dealt over the tasks: a task holds two blocks at a time, and no bucket is collected.  The work in
a bucket grows with the square of its *different* words; no pair of words is dropped.

Scale: occurrences are counted with a map-side combine, so a word that a third of all rows holds
is one row per task; everything later is as large as the vocabulary.

Defined cases: a null text has no word; a null doc_id counts as an empty string; repeated rows
count each; equal frequencies go to the smaller word in code-point order; very long words are
compared in smaller tiles; extra columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

#: A word's letters (fixed value of the contract).
RUN = r"[A-Za-zÀ-ÿ]+"
LEAST_LENGTH, LEAST_COUNT, DROP_EVERY, RATIO = 6, 5, 199, 5
#: Words of a block, and code points that a tile of two blocks compares at once.
TILE, CELLS = 256, 1 << 21


def words(docs: DataFrame) -> DataFrame:
    """(word, n): the words of all whole texts with their occurrences.

    A run of letters with A-Z lower-cased is a word; where ``DROP_EVERY`` divides the crc32 of
    doc_id, colon and run, one of its code points is dropped.
    """
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
                       F.explode(F.regexp_extract_all(lower, F.lit(RUN), 0)).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = (h % F.length("run")).cast("int")
    dropped = F.concat(F.substring("run", F.lit(1), at),
                       F.substring(F.col("run"), at + 2, F.length("run")))
    return (runs.filter(F.length("run") >= LEAST_LENGTH)
            .select(F.when(h % DROP_EVERY == 0, dropped).otherwise(F.col("run")).alias("word"))
            .filter(F.length("word") >= LEAST_LENGTH)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= LEAST_COUNT))


def half(longer: int) -> int:
    """Code points that a near pair's common prefix or suffix reaches: ceil((longer - 1) / 2)."""
    return longer // 2


def blocks(vocabulary: DataFrame) -> DataFrame:
    """(side, longer, part, block, words): the words of each bucket in blocks of about ``TILE``."""
    def bucket(side: int, longer: Column) -> Column:
        reach = F.floor(longer / 2).cast("int")
        part = F.substring("word", F.lit(1), reach) if side == 0 else F.right("word", reach)
        return F.struct(F.lit(side).alias("side"), longer.alias("longer"), part.alias("part"))

    keyed = vocabulary.select("word", F.inline(F.array(
        *[bucket(side, F.length("word") + more) for side in (0, 1) for more in (0, 1)])))
    size = (keyed.groupBy("side", "longer", "part").agg(F.count(F.lit(1)).alias("held"))
            .filter("held > 1")
            .withColumn("blocks", F.ceil(F.col("held") / TILE).cast("int")))
    return (keyed.join(size, ["side", "longer", "part"])
            .withColumn("block", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
            .groupBy("side", "longer", "part", "blocks", "block")
            .agg(F.collect_list("word").alias("words")))


def tiles(made: DataFrame) -> DataFrame:
    """(side, longer, left, right): the pairs of blocks of a bucket; right is null on the diagonal.

    A block travels to each pair that it is in; the halves of a pair meet by (bucket, pair).
    """
    low, high = F.least("block", "other"), F.greatest("block", "other")
    sent = (made.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("side", "longer", "part", low.alias("low"), high.alias("high"),
                    (F.col("block") == low).alias("first"), "words"))
    return sent.groupBy("side", "longer", "part", "low", "high").agg(
        F.max(F.when(F.col("first"), F.col("words"))).alias("left"),
        F.max(F.when(~F.col("first"), F.col("words"))).alias("right"))


def matrices(block: list[str], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the words from the left and from the right, and the lengths."""
    forward = np.zeros((len(block), width), np.uint32)
    backward = np.zeros((len(block), width), np.uint32)
    for row, word in enumerate(block):
        points = np.frombuffer(word.encode("utf-32-le"), np.uint32)
        forward[row, :len(points)] = points
        backward[row, :len(points)] = points[::-1]
    return forward, backward, np.fromiter(map(len, block), np.int64, len(block))


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Common leading code points of every row of ``a`` with every row of ``b``."""
    same = np.ones((len(a), len(b)), bool)
    length = np.zeros((len(a), len(b)), np.int32)
    for i in range(a.shape[1]):
        same &= a[:, i, None] == b[None, :, i]
        length += same
        if not same.any():
            break
    return length


def near_pairs(left: list[str], right: list[str] | None, longer: int, side: int,
               ) -> Iterator[tuple[str, str]]:
    """Pairs of a tile whose longer word has ``longer`` code points and that are one edit apart;
    on the suffix side without those that share the leading half."""
    other = left if right is None else right
    step = max(1, min(len(left), math.isqrt(CELLS // longer)))
    reach = half(longer)
    for i in range(0, len(left), step):
        rows = left[i:i + step]
        a, a_back, a_length = matrices(rows, longer)
        for j in range(i if right is None else 0, len(other), step):
            columns = other[j:j + step]
            b, b_back, b_length = matrices(columns, longer)
            # padding is equal beyond both words' ends, so a prefix ends at the shorter word's
            shorter = np.minimum(a_length[:, None], b_length[None, :])
            prefix = np.minimum(_common(a, b), shorter)
            suffix = np.minimum(_common(a_back, b_back), shorter)
            near = ((prefix + suffix >= longer - 1) & (prefix < longer)
                    & (np.maximum(a_length[:, None], b_length[None, :]) == longer))
            if side == 1:
                near &= prefix < reach
            if right is None and i == j:
                near &= np.triu(np.ones(near.shape, bool), 1)
            for x, y in zip(*np.nonzero(near)):
                yield rows[x], columns[y]


def links(vocabulary: DataFrame) -> DataFrame:
    """(a, b): every near pair of different words, once."""
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                side, longer, left, right = (batch.column(c)[row].as_py() for c in range(4))
                found = list(near_pairs(left, right, longer, side))
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([p[k] for p in found], pa.string()) for k in (0, 1)], ["a", "b"])

    paired = tiles(blocks(vocabulary.select("word")))
    # a block by itself needs two words, a pair of blocks both halves
    return (paired.filter("size(left) > if(low = high, 1, 0) and (low = high or right is not null)")
            .select("side", "longer", "left", "right").mapInArrow(compare, "a string, b string"))


def variants(docs: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of ``docs``.

    ``form`` is the most frequent near word, if it is ``RATIO`` times as frequent; ``root`` is
    where following forms ends.  Frequencies grow by ``RATIO`` at each step, so doubling the steps
    a few times reaches every root.
    """
    vocabulary = stored(words(docs), "vocabulary")
    both = links(vocabulary).select(F.inline(F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("near")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("near")))))
    counts = vocabulary.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    best = (both.join(counts, "near").groupBy("word")
            .agg(F.count(F.lit(1)).alias("n_near"),
                 F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")))
    has_form = -F.col("best.less") >= RATIO * F.col("n")
    judged = stored(vocabulary.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(has_form, F.col("best.near")).alias("form"),
        F.when(has_form, -F.col("best.less")).alias("form_n")), "forms")
    steps = stored(judged.filter("form is not null").select("word", F.col("form").alias("to")),
                   "steps-0")
    most = vocabulary.agg(F.max("n")).first()[0] or LEAST_COUNT
    longest = max(1, math.ceil(math.log(most / LEAST_COUNT, RATIO)))
    for i in range(max(0, math.ceil(math.log2(longest)))):
        then = steps.select(F.col("word").alias("to"), F.col("to").alias("further"))
        steps = stored(steps.join(then, "to", "left").select(
            "word", F.coalesce("further", "to").alias("to")), f"steps-{i + 1}")
    return judged.join(steps, "word", "left").select(
        "word", "form", F.coalesce("to", "word").alias("root"), "n", "n_near", "form_n")


#: The same rows by another way: near words share a string with one code point left out.
ORACLE_SQL = """
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce([i::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0],
      lambda x, z: xor(x >> 1, (x & 1) * 3988292384::BIGINT)) ORDER BY i) AS t
  FROM range(256) r(i)),
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
held AS (
  SELECT run, count(*) AS times, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS x
  FROM runs WHERE length(run) >= 6 GROUP BY run, doc_id),
hashed AS (
  SELECT run, times, xor(4294967295::BIGINT, list_reduce(
      list_concat([4294967295::BIGINT], list_transform(range(length(x) // 2),
        lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT)),
      lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1]))) AS h FROM held, crc_table),
vocabulary AS (
  SELECT word, sum(times)::BIGINT AS n FROM (
    SELECT times, CASE WHEN h % 199 = 0
      THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
    FROM hashed) WHERE length(word) >= 6 GROUP BY word HAVING sum(times) >= 5),
shortened AS (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM vocabulary)),
near AS (
  SELECT a.word, b.word AS near, b.n FROM shortened a JOIN shortened b
    ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM vocabulary a JOIN shortened b ON a.word = b.rest
  UNION SELECT b.word, a.word, a.n FROM vocabulary a JOIN shortened b ON a.word = b.rest),
best AS (
  SELECT word, count(*) AS n_near, arg_min(near, (-n, near)) AS near, max(n) AS near_n
  FROM near GROUP BY word),
forms AS (
  SELECT word, v.n, coalesce(n_near, 0) AS n_near,
    CASE WHEN near_n >= 5 * v.n THEN near END AS form,
    CASE WHEN near_n >= 5 * v.n THEN near_n END AS form_n
  FROM vocabulary v LEFT JOIN best USING (word)),
walk AS (
  SELECT word, word AS at FROM forms
  UNION ALL SELECT w.word, f.form FROM walk w JOIN forms f ON f.word = w.at
  WHERE f.form IS NOT NULL)
SELECT f.word, f.form, w.at AS root, f.n, f.n_near, f.form_n
FROM forms f JOIN walk w USING (word) JOIN forms last ON last.word = w.at
WHERE last.form IS NULL
"""
