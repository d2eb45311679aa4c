"""Removal of long word sequences that an earlier document already holds.

A window is ``WINDOW`` consecutive words.  The minimiser of a window is its least ``GRAM``-word
hash; consecutive windows with the same minimiser form a super-k-mer, one string of words that
travels to the minimiser's bucket.  Equal windows have equal minimisers, so each bucket can
count its windows exactly: it sorts the windows' 128-bit digests and takes the least doc_id of
each.  Documents then look up, per super-k-mer, which of its windows start in a smaller document.

Skew: equal super-k-mers are merged where they are read, with their least and greatest doc_id,
so a group of copies reaches its bucket as one string per task; what each document must look
up travels apart (``members``) in a join that adaptive execution can split.  A run of equal
words keeps one minimiser and stays one super-k-mer.  Strings travel compressed, many to a row.
A phrase that many documents hold with different words around it gives one minimiser many
different strings.  The strings of such a hot minimiser (more than ``HOT`` super-k-mers) go to
buckets by their own hash instead; their windows' digests are counted by a grouped minimum that
combines before it shuffles.  All strings of a minimiser go one way, so the counts stay exact.

Defined cases: words are runs without ASCII white space, unchanged; a null text has no words;
documents shorter than a window lose nothing; rows that share a doc_id are one document for the
comparison and each get their row; a row without doc_id is never smaller than another and keeps
its words; extra columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, tasks, texts

WINDOW, GRAM = 50, 8
#: Characters of documents behind one bucket, and of strings gathered before a task sends them.
BUCKET_CHARS, FLUSH_BYTES = 24_000_000, 48_000_000
#: Super-k-mers of a minimiser above which it is hot, and the most hot minimisers there can be:
#: of n super-k-mers a hot one has more than n / HOT_LIST, so the list stays below 8 MB.
HOT, HOT_LIST = 50_000, 1_000_000
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_STEP = np.uint64(0x9E3779B97F4A7C15)


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[32, *range(9, 14)]] = True
#: Masks of the first 0 to 8 bytes of a little-endian number.
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def split_line(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The text's words joined by one space, as bytes, and where each word starts and ends."""
    data = np.frombuffer(text.encode(), np.uint8)
    space = _IS_SPACE[data]
    keep = ~space
    keep[1:] |= ~space[:-1]                       # the space right after a word separates
    line = np.where(space, 32, data)[keep].astype(np.uint8)
    if len(line) and line[-1] == 32:
        line = line[:-1]
    if not len(line):
        return line, np.zeros(0, np.int64), np.zeros(0, np.int64)
    gaps = np.flatnonzero(line == 32)
    return line, np.concatenate(([0], gaps + 1)), np.concatenate((gaps, [len(line)]))


def word_hashes(line: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of every word, from its length and its first and last eight bytes.

    Hashes choose the minimisers only; words with equal hashes are compared as text like others.
    """
    at = np.ndarray(len(line) + 1, "<u8", line.tobytes() + bytes(8), 0, (1,))
    length = ends - starts
    head = at[starts] & _FIRST[np.minimum(length, 8)]
    tail = np.where(length > 8, at[np.maximum(ends - 8, 0)], np.uint64(0))
    code = head * _MIX[0] + tail * _MIX[1] + length.astype(np.uint64)
    return (code ^ (code >> np.uint64(32))) * _STEP


def minimisers(hashes: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> np.ndarray:
    """The minimiser of every window of a sequence of word hashes."""
    size = len(hashes) - gram + 1
    code = np.zeros(size, np.uint64)
    for k in range(gram):
        code = code * _STEP + hashes[k:k + size]
    code ^= code >> np.uint64(30)
    code *= _MIX[0]
    code ^= code >> np.uint64(27)
    code *= _MIX[1]
    code ^= code >> np.uint64(31)
    span, width = window - gram + 1, 1
    while 2 * width <= span:
        code = np.minimum(code[:-width], code[width:])
        width *= 2
    rest = span - width
    return np.minimum(code[:len(code) - rest], code[rest:]) if rest else code


def super_kmers(text: str, window: int = WINDOW,
                gram: int = GRAM) -> Iterator[tuple[int, int, int, bytes]]:
    """(minimiser, first window, windows, words joined by a space) of a text."""
    line, word_start, word_end = split_line(text)
    if len(word_start) < window:
        return
    least = minimisers(word_hashes(line, word_start, word_end), window, gram)
    cuts = np.flatnonzero(least[1:] != least[:-1]) + 1
    starts = np.concatenate(([0], cuts))
    ends = np.concatenate((cuts, [len(least)]))
    whole = line.tobytes()
    first, last = word_start[starts].tolist(), word_end[ends + window - 2].tolist()
    for m, s, e, a, b in zip(least[starts].tolist(), starts.tolist(), ends.tolist(), first, last):
        yield m, s, e - s, whole[a:b]


def _packed(found: dict[bytes, list[int]]) -> bytes:
    """Compressed strings of one bucket: count, lengths, minimisers, least and greatest ids."""
    n = len(found)
    table = np.array(list(found.values()), dtype=object).reshape(n, 3)
    parts = [struct.pack("<I", n), np.fromiter(map(len, found), "<i4", n).tobytes(),
             table[:, 0].astype("<u8").tobytes(), table[:, 1].astype("<i8").tobytes(),
             table[:, 2].astype("<i8").tobytes(), *found]
    return zstandard.ZstdCompressor(level=3).compress(b"".join(parts))


def _unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, bytes]:
    data = zstandard.ZstdDecompressor().decompress(blob)
    n, = struct.unpack_from("<I", data)
    at = 4
    out = []
    for kind, size in (("<i4", 4), ("<u8", 8), ("<i8", 8), ("<i8", 8)):
        out.append(np.frombuffer(data, kind, n, at))
        at += n * size
    return (*out, data[at:])


def _digest(string: bytes) -> tuple[int, int]:
    n = xxhash.xxh3_128_intdigest(string)
    return n >> 64, n & 0xFFFFFFFFFFFFFFFF


def _signed(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def _send(buckets: int, window: int, gram: int, hot: frozenset[int]):
    """Rows (bucket, strings): the different super-k-mers of a task, by bucket; those of hot
    minimisers in as many buckets more, by the string's hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush():
            for b, found in held.items():
                yield pa.record_batch([pa.array([b], pa.int32()),
                                       pa.array([_packed(found)], pa.binary())],
                                      ["bucket", "strings"])
        held, size = {}, 0
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for doc_id, text in zip(ids, texts(batch.column("text"))):
                for m, _, _, string in super_kmers(text, window, gram):
                    bucket = (buckets + xxhash.xxh3_64_intdigest(string) % buckets if m in hot
                              else m % buckets)
                    found = held.setdefault(bucket, {})
                    entry = found.get(string)
                    if entry is None:
                        found[string] = [m, doc_id, doc_id]
                        size += len(string) + 200
                    else:
                        entry[1], entry[2] = min(entry[1], doc_id), max(entry[2], doc_id)
                if size > FLUSH_BYTES:
                    yield from flush()
                    held, size = {}, 0
        yield from flush()
    return run


def _window_digests(string: bytes, window: int) -> list[bytes]:
    """The 128-bit digests of a string's windows."""
    words = string.split(b" ")
    after = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    first = np.concatenate(([0], after[:len(words) - window])).tolist()
    return [xxhash.xxh3_128_digest(string[a:b])
            for a, b in zip(first, (after[window - 1:] - 1).tolist())]


def _window_least(strings: list[bytes], least: list[int], window: int) -> list[np.ndarray]:
    """For every string the least doc_id of each of its windows, over all the strings."""
    digests, owners, counts = [], [], []
    for string, doc_id in zip(strings, least):
        own = _window_digests(string, window)
        digests += own
        owners += [doc_id] * len(own)
        counts.append(len(own))
    codes = np.frombuffer(b"".join(digests), "<u8").reshape(-1, 2)
    order = np.lexsort((codes[:, 1], codes[:, 0]))
    ranked, ids = codes[order], np.array(owners, np.int64)
    heads = np.flatnonzero(np.concatenate(([True], (ranked[1:] != ranked[:-1]).any(axis=1))))
    lowest = np.minimum.reduceat(ids[order], heads)
    out = np.empty(len(ids), np.int64)
    out[order] = np.repeat(lowest, np.diff(np.append(heads, len(ids))))
    return np.split(out, np.cumsum(counts)[:-1])


def _runs(least: np.ndarray, most: int) -> tuple[list[int], list[int], list[int]]:
    """Runs (first window, windows, least doc_id) that matter to a document up to ``most``."""
    heads = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
    sizes = np.diff(np.append(heads, len(least)))
    keep = least[heads] < most
    return heads[keep].tolist(), sizes[keep].tolist(), least[heads][keep].tolist()


#: A counted super-k-mer has ``first``, ``size`` and ``least``; one of a hot minimiser still has
#: its ``windows`` to be counted, and the least and greatest document that holds it.
_COUNTED = {"h1": pa.int64(), "h2": pa.int64(), "first": pa.list_(pa.int32()),
            "size": pa.list_(pa.int32()), "least": pa.list_(pa.int64()),
            "windows": pa.list_(pa.binary()), "low": pa.int64(), "high": pa.int64()}
_COUNTED_DDL = ("h1 long, h2 long, first array<int>, size array<int>, least array<long>, "
                "windows array<binary>, low long, high long")


def _counted_batch(**given: list) -> pa.RecordBatch:
    n = len(given["h1"])
    return pa.record_batch(
        [_signed(given[c]) if c in ("h1", "h2") else
         pa.array(given[c], kind) if c in given else pa.nulls(n, kind)
         for c, kind in _COUNTED.items()], list(_COUNTED))


def _hot_rows(merged: dict[bytes, tuple[int, int]], window: int) -> Iterator[pa.RecordBatch]:
    """The different strings of a bucket of hot minimisers with their windows' digests."""
    names = ("h1", "h2", "windows", "low", "high")
    rows = {c: [] for c in names}
    held = 0
    for string, (low, high) in merged.items():
        windows = _window_digests(string, window)
        for c, value in zip(names, (*_digest(string), windows, low, high)):
            rows[c].append(value)
        held += len(windows)
        if held >= 100_000:
            yield _counted_batch(**rows)
            rows, held = {c: [] for c in names}, 0
    yield _counted_batch(**rows)


def _count(buckets: int, window: int):
    """The super-k-mers of a bucket that have windows in several documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads, bodies, hot = [], [], False
        merged: dict[bytes, tuple[int, int]] = {}

        def merge(string: bytes, low: int, high: int) -> None:
            lo, hi = merged.get(string, (low, high))
            merged[string] = (min(lo, low), max(hi, high))

        for batch in batches:
            for bucket, blob in zip(batch.column("bucket").to_pylist(), batch.column("strings")):
                size, m, low, high, body = _unpacked(blob.as_buffer())
                end = np.cumsum(size, dtype=np.int64)
                if bucket >= buckets:
                    hot = True
                    for a, b, lo, hi in zip((end - size).tolist(), end.tolist(), low.tolist(),
                                            high.tolist()):
                        merge(body[a:b], lo, hi)
                    continue
                heads.append((np.full(len(m), len(bodies)), end - size, end, m, low, high))
                bodies.append(body)
        if hot:
            yield from _hot_rows(merged, window)
            merged.clear()
        if not bodies:
            return
        src, start, end, m, low, high = (np.concatenate(c) for c in zip(*heads))
        order = np.argsort(m, kind="stable")
        cuts = np.flatnonzero(np.concatenate(([True], m[order][1:] != m[order][:-1], [True])))
        names = ("h1", "h2", "first", "size", "least")
        rows = {c: [] for c in names}
        for a, b in zip(cuts, cuts[1:]):
            if b - a == 1 and low[order[a]] == high[order[a]]:
                continue
            merged.clear()
            for i in order[a:b]:
                merge(bodies[src[i]][start[i]:end[i]], int(low[i]), int(high[i]))
            strings = list(merged)
            lows = [lo for lo, _ in merged.values()]
            if len(strings) == 1:
                n = strings[0].count(b" ") + 2 - window
                leasts = [np.full(n, lows[0], np.int64)]
            else:
                leasts = _window_least(strings, lows, window)
            for string, (_, hi), least in zip(strings, merged.values(), leasts):
                first, size, ids = _runs(least, hi)
                if first:
                    for c, value in zip(names, (*_digest(string), first, size, ids)):
                        rows[c].append(value)
            if len(rows["h1"]) >= 2000:
                yield _counted_batch(**rows)
                rows = {c: [] for c in names}
        yield _counted_batch(**rows)
    return run


def _members(window: int, gram: int):
    """Rows (m, h1, h2, doc_id, text_key, at): which super-k-mer, of which minimiser, starts
    where in a document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                least, h1, h2, row, first = [], [], [], [], []
                for k, text in enumerate(texts(part.column("text"))):
                    for m, start, _, string in super_kmers(text, window, gram):
                        a, b = _digest(string)
                        least.append(m)
                        h1.append(a)
                        h2.append(b)
                        row.append(k)
                        first.append(start)
                where = pa.array(row, pa.int32())
                yield pa.record_batch(
                    [_signed(least), _signed(h1), _signed(h2), part.column("doc_id").take(where),
                     part.column("text_key").take(where), pa.array(first, pa.int32())],
                    ["m", "h1", "h2", "doc_id", "text_key", "at"])
    return run


def hot_minimisers(members: DataFrame, hot: int = HOT) -> frozenset[int]:
    """The minimisers of more than ``hot`` super-k-mers, at most ``HOT_LIST`` of them."""
    limit = max(hot, members.count() // HOT_LIST)
    found = members.groupBy("m").count().filter(F.col("count") > limit).select("m").toPandas()
    return frozenset(found["m"].to_numpy(np.int64).view(np.uint64).tolist())


def _count_hot(counted: DataFrame) -> DataFrame:
    """The super-k-mers of hot minimisers that have windows in several documents."""
    windows = (counted.filter("windows is not null")
               .select("h1", "h2", "low", "high", F.posexplode("windows").alias("k", "w")))
    least = windows.groupBy("w").agg(F.min("low").alias("least"))
    return (windows.join(least, "w").filter("least < high").groupBy("h1", "h2")
            .agg(F.collect_list(F.struct("k", "least")).alias("found"))
            .select("h1", "h2", F.col("found.k").alias("first"),
                    F.transform("found", lambda _: F.lit(1)).alias("size"),
                    F.col("found.least").alias("least")))


def repeated_ranges(docs: DataFrame, window: int = WINDOW, gram: int = GRAM,
                    hot: int = HOT) -> DataFrame:
    """(doc_id, text_key, first, size): the window ranges of each document to remove."""
    spark = docs.sparkSession
    keyed = (docs.filter("doc_id is not null and text is not null")
             .select("doc_id", F.xxhash64("text").alias("text_key"), "text"))
    chars = keyed.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = max(tasks(spark), chars // BUCKET_CHARS)
    members = stored(keyed.mapInArrow(
        _members(window, gram), "m long, h1 long, h2 long, doc_id long, text_key long, at int"),
        "members")
    found = hot_minimisers(members, hot)
    counted = stored(keyed.select("doc_id", "text")
                     .mapInArrow(_send(buckets, window, gram, found), "bucket int, strings binary")
                     .repartitionById(buckets * (2 if found else 1), F.col("bucket"))
                     .mapInArrow(_count(buckets, window), _COUNTED_DDL), "shared-windows")
    # The same super-k-mer in one bucket is one row of ``shared``: its bucket is its minimiser's,
    # or its own hash's if that is hot.
    shared = counted.filter("windows is null").select("h1", "h2", "first", "size", "least")
    if found:
        shared = shared.unionByName(_count_hot(counted))
    hits = members.join(shared, ["h1", "h2"]).select(
        "doc_id", "text_key", F.filter(
            F.transform(F.arrays_zip("first", "size", "least"), lambda r: F.struct(
                (r["first"] + F.col("at")).alias("first"), r["size"].alias("size"),
                (r["least"] < F.col("doc_id")).alias("earlier"))),
            lambda r: r["earlier"]).alias("runs"))
    return (hits.filter(F.size("runs") > 0).groupBy("doc_id", "text_key")
            .agg(F.flatten(F.collect_list("runs")).alias("runs"))
            .select("doc_id", "text_key", F.col("runs.first").alias("first"),
                    F.col("runs.size").alias("size")))


def _kept_column(window: int):
    """Struct (n_words, n_removed, kept) of a text and its window ranges."""
    @F.arrow_udf("struct<n_words:bigint,n_removed:bigint,kept:string>")
    def of(text: pa.Array, first: pa.Array, size: pa.Array) -> pa.Array:
        n_words, n_removed, kept = [], [], []
        for t, a, n in zip(texts(text), first.to_pylist(), size.to_pylist()):
            words = left = t.encode().split()
            if a:
                mark = np.zeros(len(words) + 1, np.int64)
                np.add.at(mark, np.array(a), 1)
                np.add.at(mark, np.array(a) + np.array(n) + window - 1, -1)
                left = [w for w, gone in zip(words, np.cumsum(mark)) if not gone]
            n_words.append(len(words))
            n_removed.append(len(words) - len(left))
            kept.append(b" ".join(left).decode())
        return pa.StructArray.from_arrays(
            [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
             pa.array(kept, pa.string())], names=["n_words", "n_removed", "kept"])
    return of("text", "first", "size")


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM,
                   hot: int = HOT) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) for every row; ``kept`` is the text that stays, its
    words joined by one space."""
    ranges = stored(repeated_ranges(docs, window, gram, hot), "repeats")
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    return (keyed.join(ranges, ["doc_id", "text_key"], "left")
            .select("doc_id", _kept_column(window).alias("k"))
            .select("doc_id", "k.*"))


def digest(removed: DataFrame) -> DataFrame:
    return removed.select("doc_id", "n_words", "n_removed",
                          F.sha2("kept", 256).alias("kept_sha256"))


#: The contract in DuckDB SQL: windows as text, the least document of each.
ORACLE_SQL = f"""
WITH docs AS (
  SELECT row_number() OVER () AS n, doc_id,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'),
                     lambda w: w <> '') AS words
  FROM documents),
windows AS (
  SELECT n, doc_id, i, md5(array_to_string(words[i:i + {WINDOW - 1}], ' ')) AS w
  FROM (SELECT *, unnest(range(1, len(words) - {WINDOW - 2})) AS i FROM docs)),
least AS (SELECT w, min(doc_id) AS least FROM windows GROUP BY w),
covered AS (
  SELECT n, list(i) AS starts FROM windows JOIN least USING (w) WHERE least < doc_id GROUP BY n),
gone AS (
  SELECT DISTINCT n, unnest(range(i, i + {WINDOW})) AS place
  FROM (SELECT n, unnest(starts) AS i FROM covered)),
places AS (SELECT n, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM docs
           WHERE n IN (SELECT n FROM covered)),
kept AS (
  SELECT n, count(gone.place) AS n_removed,
         coalesce(string_agg(word, ' ' ORDER BY place) FILTER (gone.place IS NULL), '') AS kept
  FROM places LEFT JOIN gone USING (n, place) GROUP BY n)
SELECT doc_id, len(words)::bigint AS n_words, coalesce(n_removed, 0)::bigint AS n_removed,
       sha256(coalesce(kept, array_to_string(words, ' '))) AS kept_sha256
FROM docs LEFT JOIN kept USING (n)
"""
