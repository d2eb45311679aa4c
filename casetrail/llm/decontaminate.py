"""Benchmark decontamination: rare n-gram seeds joined to the test items, then local alignment.

Words are lower-cased, ASCII punctuation separates them.  Documents are aligned with the items:
Smith-Waterman over words (match 1, mismatch and gap ``PENALTY``).  The score is the best
local alignment divided by the item's length; at ``THRESHOLD`` or more the document holds
an exact, paraphrased or edited copy of the item.

Seeds.  An item's seeds are its rarest pairs of neighbouring words and its rarest words, by their
counts in the whole corpus, so many that no alignment at the threshold avoids all of them.  Of an
item of n words, leave out the c commonest of the n - 1 pairs.  An alignment that holds no other
pair intact pays ``PENALTY`` for each it breaks by added words, and no less for pairs that it
breaks by u words replaced, dropped or cut off, which cost it u (1 - PENALTY) more:
PENALTY (n - 1 - c) + (1 - PENALTY) u <= (1 - threshold) n.  So it matches all but u of the
item's words, and any u + 1 of them as seeds find it.  c is chosen for the fewest seed hits.

The corpus is read twice for n-grams, to count the items' and to find the seeds.  A bitmap of a
fixed size (``BITS``) keeps other n-grams from leaving their task; both steps end in equi-joins
in Spark, so neither items nor seeds are collected.  Each text then gets its candidate items in
blocks of ``BLOCK_CHARS`` (all items are dealt into blocks of that size), and only the stretches
around seeds that can reach the threshold are aligned: with 1 for every word that the item has and
-PENALTY for every other word, some stretch must sum to the threshold times the item's length.

Skew: counts and seed hits combine before they shuffle; a common n-gram is a seed only where the
item has no rarer ones; joins can be split by adaptive execution.

Defined cases: null texts count as empty and match nothing; an item without words matches
nothing; repeated rows and repeated items each give their rows; extra columns are ignored (``drop_leaks`` keeps them); empty
tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cached_property
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import columns, fresh, stored, texts
from .substring_dedup import word_hashes

PENALTY = 0.5
THRESHOLD = 0.5
#: Characters of items in one block: a text travels with the candidates of one block at a time.
BLOCK_CHARS = 1_000_000
#: Most bits of a bitmap of n-grams (8 MB, whatever the size of the benchmark), and bits per
#: n-gram of a smaller one.
BITS, GRAM_BITS = 1 << 26, 256
#: Cells of one batch of alignments (memory bound).
CELLS = 1 << 20
#: Characters that a task cuts into words at a time (or one text), and n-grams that it gathers
#: before it counts them.
CUT_CHARS, GATHERED = 1_000_000, 1 << 20
#: Share of the threshold that the words left out of a search without seeds may make up.
SHARED = 0.75
_EPS = 1e-9
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9))

_SPACED = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().translate(_SPACED).split()


def reaches(sizes: np.ndarray, threshold: float) -> np.ndarray:
    """The longest stretches of words of alignments that reach the threshold."""
    return np.ceil(sizes * max(1.0, (1 + PENALTY - threshold) / PENALTY)).astype(int)


def grams(whole: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of the words of the texts, one text after another, and of the pairs that begin with
    them (a text's last word begins none: 0), and where the texts' words begin.

    Equal n-grams have equal codes.  Some long words share theirs (see ``word_hashes``), which can
    only add candidates.
    """
    parts = [(t or "").lower().encode().translate(_SPACED) for t in whole]
    line = np.frombuffer(b" ".join([b"", *parts, b""]), np.uint8)
    edges = np.flatnonzero(np.diff(line != 32)) + 1
    begins, ends = edges[::2], edges[1::2]
    starts = np.searchsorted(begins, np.cumsum([0, *(len(t) + 1 for t in parts)]))
    one = word_hashes(line, begins, ends)
    two = np.zeros(len(one), np.uint64)
    code = one[:-1] * _MIX[0] + one[1:]
    code = (code ^ (code >> np.uint64(29))) * _MIX[1]
    two[:-1] = code ^ (code >> np.uint64(32))
    two[starts[1:][np.diff(starts) > 0] - 1] = 0
    return one, two, starts


def seeds(words: np.ndarray, pairs: np.ndarray, threshold: float = THRESHOLD,
          penalty: float = PENALTY) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words and of the pairs of an item that are its seeds, from their counts in
    the corpus: every alignment that reaches the threshold holds one of them."""
    n = len(words)
    by_word, by_pair = np.argsort(words, kind="stable"), np.argsort(pairs, kind="stable")
    left = np.arange(len(pairs), -1, -1)                       # pairs that are seeds
    free = ((1 - threshold) * n - penalty * left) / (1 - penalty)
    needed = np.clip(np.floor(free + _EPS).astype(int) + 1, 0, n)
    hits = (np.concatenate(([0], np.cumsum(pairs[by_pair])))[left]
            + np.concatenate(([0], np.cumsum(words[by_word])))[needed])
    best = int(np.argmin(hits))
    return by_word[:needed[best]], by_pair[:left[best]]


class Items:
    """A block of test items as word numbers, and for every word the items to look at."""

    def __init__(self, rows: list[tuple[object, str]], threshold: float = THRESHOLD):
        lists = [(item_id, words) for item_id, text in rows if (words := words_of(text))]
        self.ids = [item_id for item_id, _ in lists]
        self.number: dict[bytes, int] = {}
        for _, words in lists:
            for w in words:
                self.number.setdefault(w, len(self.number))
        self.words = [np.array([self.number[w] for w in words], np.int64) for _, words in lists]
        self.sizes = np.array([len(w) for w in self.words], np.int64)
        self.own = [np.unique(w) for w in self.words]
        self.threshold = threshold
        self.reach = reaches(self.sizes, threshold)

    def numbers(self, text: str | None) -> np.ndarray:
        words = words_of(text)
        return np.fromiter(map(self.number.get, words, repeat(-1)), np.int64, len(words))

    @cached_property
    def _held(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per word the items that a search without seeds counts it for: the items by word, where
        each word's begin, and the places of every item left out."""
        held = np.bincount(np.concatenate([*self.own, np.zeros(0, np.int64)]),
                           minlength=len(self.number))
        words, items, left_out = [], [], np.zeros(len(self.words), np.int64)
        for i, (own, all_words) in enumerate(zip(self.own, self.words)):
            places = np.bincount(np.searchsorted(own, all_words))
            order = np.argsort(-held[own], kind="stable")
            out = np.cumsum(places[order])
            most = int(SHARED * self.threshold * len(all_words) / (1 + PENALTY))
            first = np.searchsorted(out, most, "right")
            left_out[i] = out[first - 1] if first else 0
            words.append(own[order[first:]])
            items.append(np.full(len(own) - first, i))
        words = np.concatenate([*words, np.zeros(0, np.int64)])
        order = np.argsort(words, kind="stable")
        return (np.concatenate([*items, np.zeros(0, np.int64)])[order],
                np.searchsorted(words[order], np.arange(len(self.number) + 1)), left_out)

    def _stretches(self, words: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(item, first, end), sorted by both: every alignment that reaches the threshold lies
        within one; a search without seeds."""
        holders, cut, left_out = self._held
        known = np.flatnonzero(words >= 0)
        low = cut[words[known]]
        sizes = cut[words[known] + 1] - low
        reach = self.reach
        before = np.concatenate(([0], np.cumsum(sizes)))
        found, at = [], 0
        while at < len(known):                            # parts of about CELLS hits
            end = max(at + 1, int(np.searchsorted(before, before[at] + CELLS, "right")) - 1)
            # what ends in this part may start up to the longest reach before it
            a = int(np.searchsorted(known, known[at] - reach.max()))
            n = sizes[a:end]
            hit = np.repeat(low[a:end] - np.cumsum(n) + n, n) + np.arange(n.sum())
            item, place = holders[hit], np.repeat(known[a:end], n)
            order = np.argsort(item, kind="stable")
            item, place = item[order], place[order]
            best = best_ending(item, place, len(words))
            need = self.threshold * self.sizes - (1 + PENALTY) * left_out
            good = (best >= need[item] - _EPS) & (place >= known[at])
            found.append((item[good], place[good]))
            at = end
        if not found:
            return
        item, place = (np.concatenate(c) for c in zip(*found))
        order = np.lexsort((place, item))
        # words left out may precede the first and follow the last word that was counted
        first, end = place - reach[item], place + reach[item] + 1
        yield from _merged(zip(item[order].tolist(), first[order].tolist(), end[order].tolist()))

    def present(self, words: np.ndarray, hits: list[tuple[int, list[int]]]
                ) -> list[tuple[int, list[int]]]:
        """The hits whose items have enough words anywhere in the document."""
        has = np.zeros(len(self.number) + 1, bool)
        has[words] = True                                    # an unknown word sets the last
        return [(item, places) for item, places in hits if
                np.count_nonzero(has[self.words[item]]) >= self.threshold * self.sizes[item] - _EPS]

    def around(self, hits: Iterable[tuple[int, list[int]]]) -> Iterator[tuple[int, int, int]]:
        """(item, first, end) of the stretches around seeds, given as items and their places."""
        for item, places in hits:
            reach = int(self.reach[item])
            yield from _merged((item, p - reach, p + reach + 2) for p in sorted(places))

    def windows(self, words: np.ndarray,
                hits: Iterable[tuple[int, list[int]]] | None = None) -> list[tuple[int, int, int]]:
        """(item, first, end) of the stretches of a document that must be aligned: around the
        given seeds, or anywhere if there are none given."""
        out = []
        for item, first, end in self._stretches(words) if hits is None else self.around(hits):
            first, end = max(0, first), min(len(words), end)
            own = self.own[item]
            part = words[first:end]
            near = np.minimum(np.searchsorted(own, part), len(own) - 1)
            place = np.flatnonzero(own[near] == part)
            best = best_ending(np.zeros(len(place), np.int64), place, len(words))
            ends = first + place[best >= self.threshold * self.sizes[item] - _EPS]
            out += _merged((item, max(0, p - int(self.reach[item])), p + 1) for p in ends.tolist())
        return out


def _merged(spans: Iterable[tuple[int, int, int]]) -> Iterator[tuple[int, int, int]]:
    """Sorted spans (item, first, end), those that touch as one."""
    now = None
    for item, first, end in spans:
        if now and now[0] == item and first <= now[2]:
            now = (item, now[1], max(end, now[2]))
            continue
        if now:
            yield now
        now = (item, first, end)
    if now:
        yield now


def best_ending(group: np.ndarray, place: np.ndarray, size: int) -> np.ndarray:
    """For hits sorted by group and place: the greatest sum of a stretch that ends with each,
    1 for a hit and -PENALTY for another word."""
    level = (1 + PENALTY) * np.arange(len(place)) - PENALTY * place
    # a step down between groups: the running minimum starts afresh
    step = group * ((1 + PENALTY) * (len(place) + 1.0) + PENALTY * (size + 1.0))
    return level + 1 - (np.minimum.accumulate(level - step) + step)


def align(items: list[np.ndarray], windows: list[np.ndarray],
          penalty: float = PENALTY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best local alignment of every (item, window) pair: score, and the ends (exclusive) of
    the alignment in item and window.  One numpy step handles a row of all the pairs."""
    n, width = max(map(len, items)), max(map(len, windows))
    left, right = np.full((len(items), n), -2, np.int64), np.full((len(items), width), -1, np.int64)
    for k, (a, b) in enumerate(zip(items, windows)):
        left[k, :len(a)], right[k, :len(b)] = a, b
    slope = penalty * np.arange(width + 1)
    above = np.zeros((len(items), width + 1))
    best, item_end, end = (np.zeros(len(items)), np.zeros(len(items), int),
                           np.zeros(len(items), int))
    for i in range(n):
        row = np.zeros_like(above)
        step = np.where(right == left[:, i:i + 1], 1.0, -penalty)
        np.maximum(above[:, :-1] + step, above[:, 1:] - penalty, out=row[:, 1:])
        np.maximum(row, 0, out=row)
        row = np.maximum.accumulate(row + slope, axis=1) - slope      # gaps along the row
        place = row.argmax(axis=1)
        top = row[np.arange(len(items)), place]
        better = top > best
        best[better], item_end[better], end[better] = top[better], i + 1, place[better]
        above = row
    return best, item_end, end


def _batches(pairs: list[tuple]) -> Iterator[list[tuple]]:
    """Pairs of similar size together, each batch within the cell bound (or one pair)."""
    pairs = sorted(pairs, key=lambda p: (len(p[2]), len(p[1])))
    batch, wide = [], 0
    for pair in pairs:
        wide_next = max(wide, len(pair[2]))
        if batch and ((len(batch) + 1) * wide_next > CELLS
                      or len(batch) >= 32 and wide_next > 1.3 * len(batch[0][2])):
            yield batch
            batch, wide_next = [], len(pair[2])
        batch.append(pair)
        wide = wide_next
    if batch:
        yield batch


def _leaks(items: Items, whole: list[str | None], threshold: float,
           hits: list[list[tuple[int, list[int]]]] | None = None) -> list[list[dict]]:
    out: list[list[dict]] = [[] for _ in whole]
    pairs = []
    for row, text in enumerate(whole):
        numbers = items.numbers(text)
        near = items.present(numbers, hits[row]) if hits else None
        for item, first, end in items.windows(numbers, near):
            pairs.append(((row, item, first), items.words[item], numbers[first:end].copy()))
    best: dict[tuple[int, int], dict] = {}
    for batch in _batches(pairs):
        score, item_end, end = align([p[1] for p in batch], [p[2] for p in batch])
        score = score / np.array([len(p[1]) for p in batch])
        hits = np.flatnonzero(score >= threshold)
        if not len(hits):
            continue
        # the same alignment from its end backwards gives the start
        _, _, back = align([batch[k][1][:item_end[k]][::-1] for k in hits],
                           [batch[k][2][:end[k]][::-1] for k in hits])
        for k, size in zip(hits, back):
            (row, item, first), _, _ = batch[k]
            found = {"item_id": items.ids[item], "score": round(float(score[k]), 6),
                     "first_word": int(first + end[k] - size), "last_word": int(first + end[k] - 1)}
            old = best.get((row, item))
            if old is None or (-found["score"], found["first_word"]) < (-old["score"],
                                                                       old["first_word"]):
                best[row, item] = found
    for (row, _), found in sorted(best.items()):
        out[row].append(found)
    return out


def text_key(text: Column) -> Column:
    return F.unhex(F.md5(text))


def item_blocks(benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The different item texts, dealt into blocks of about ``block_chars`` characters."""
    items = (benchmark.filter("text is not null").select("text").distinct()
             .select(text_key(F.col("text")).alias("item"), "text"))
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    return items.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(-(-chars // block_chars) or 1)))


def _item_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (item, place, pair, gram): every word and every pair of an item."""
    for part, whole in _parts(batches):
        one, two, starts = grams(whole)
        row = np.repeat(np.arange(len(whole)), np.diff(starts))
        place = np.arange(len(one)) - starts[row]
        begins = np.flatnonzero(np.diff(row, append=-1) == 0)          # not a text's last word
        yield pa.record_batch(
            [part.column("item").take(pa.array(np.concatenate((row, row[begins])))),
             pa.array(np.concatenate((place, place[begins])), pa.int32()),
             pa.array(np.repeat([False, True], [len(one), len(begins)])),
             pa.array(np.concatenate((one, two[begins])).view(np.int64))],
            ["item", "place", "pair", "gram"])


def bitmap(codes: DataFrame) -> np.ndarray:
    """The bits of all n-gram codes, modulo a power of two of them: 8 MB at most."""
    size = min(BITS, max(1 << 15, 1 << (GRAM_BITS * codes.count()).bit_length()))
    place = F.pmod("gram", F.lit(size)) + 1
    parts = (codes.select(place.alias("p"))
             .groupBy(F.bitmap_bucket_number("p").alias("bucket"))
             .agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits")).collect())
    out = np.zeros(size // 8, np.uint8)
    for r in parts:
        at = (r.bucket - 1) * len(r.bits)
        out[at:at + len(r.bits)] = np.frombuffer(r.bits, np.uint8)
    return out


def _marked(bits: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """The places of the n-grams that the bitmap may hold."""
    place = codes & np.uint64(8 * len(bits) - 1)
    return np.flatnonzero(bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of batches and their texts, of about ``CUT_CHARS`` characters or one row."""
    for batch in batches:
        whole = texts(batch.column("text"))
        at = size = 0
        for k, text in enumerate(whole):
            if k > at and size + len(text) > CUT_CHARS:
                yield batch.slice(at, k - at), whole[at:k]
                at, size = k, 0
            size += len(text)
        if whole:
            yield batch.slice(at), whole[at:]


def _counted(bits: np.ndarray):
    """Rows (gram, n): the items' n-grams in a task's texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out():
            codes, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.record_batch([pa.array(codes.view(np.int64)), pa.array(n, pa.int64())],
                                   ["gram", "n"])
        held, size = [], 0
        for _, whole in _parts(batches):
            for codes in grams(whole)[:2]:
                held.append(codes[_marked(bits, codes)])
                size += len(held[-1])
            if size > GATHERED:
                yield out()
                held, size = [], 0
        if held:
            yield out()
    return run


def _found(bits: np.ndarray):
    """Rows (text_key, gram, place): the seeds in a task's texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, whole in _parts(batches):
            *both, starts = grams(whole)
            hits = [_marked(bits, codes) for codes in both]
            code = np.concatenate([codes[at] for codes, at in zip(both, hits)])
            at = np.concatenate(hits)
            row = np.searchsorted(starts, at, "right") - 1
            yield pa.record_batch(
                [part.column("text_key").take(pa.array(row)), pa.array(code.view(np.int64)),
                 pa.array(at - starts[row], pa.int32())], ["text_key", "gram", "place"])
    return run


def _chosen(threshold: float):
    """Rows (item, gram): the seeds of every item, from its counted n-grams."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, code = [], []
            for k, counted in enumerate(batch.column("grams").to_pylist()):
                counted.sort(key=lambda g: (g["pair"], g["place"]))
                cut = sum(not g["pair"] for g in counted)
                n = np.array([g["n"] for g in counted], np.int64)
                words, pairs = seeds(n[:cut], n[cut:], threshold)
                own = {counted[i]["gram"] for i in (*words, *(cut + pairs))}
                row += [k] * len(own)
                code += own
            yield pa.record_batch([batch.column("item").take(pa.array(row, pa.int32())),
                                   pa.array(code, pa.int64())], ["item", "gram"])
    return run


def item_seeds(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(item, gram): the seeds of every item, by the n-grams' counts in all the documents."""
    own = stored(items.select("item", "text").mapInArrow(
        _item_grams, "item binary, place int, pair boolean, gram long"), "item-grams")
    counts = (docs.select("text").mapInArrow(_counted(bitmap(own)), "gram long, n long")
              .groupBy("gram").agg(F.sum("n").alias("n")))
    counted = own.join(counts, "gram", "left").select(
        "item", F.struct("place", "pair", "gram", F.coalesce("n", F.lit(0)).alias("n")).alias("g"))
    return stored(counted.groupBy("item").agg(F.collect_list("g").alias("grams"))
                  .mapInArrow(_chosen(threshold), "item binary, gram long"), "item-seeds")


def candidates(keyed: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(text_key, block, found): the items of a block that share seeds with a text, and where."""
    chosen = item_seeds(keyed, items, threshold)
    hits = keyed.select("text_key", "text").mapInArrow(
        _found(bitmap(chosen)), "text_key binary, gram long, place int")
    pairs = (hits.join(chosen, "gram").groupBy("text_key", "item")
             .agg(F.collect_set("place").alias("places")))
    return (pairs.join(items, "item").groupBy("text_key", "block")
            .agg(F.collect_list(F.struct("item", "text", "places")).alias("found")))


def _aligned(threshold: float):
    """Rows (doc_id, text_key, item, score, first_word, last_word) of texts with candidates."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                found = part.column("found").to_pylist()
                block = Items(list({f["item"]: f["text"] for row in found for f in row}.items()),
                              threshold)
                number = {item: k for k, item in enumerate(block.ids)}
                hits = [[(number[f["item"]], f["places"]) for f in row] for row in found]
                leaked = _leaks(block, part.column("text").to_pylist(), threshold, hits)
                where = pa.array([k for k, row in enumerate(leaked) for _ in row], pa.int32())
                flat = [f for row in leaked for f in row]
                yield pa.record_batch(
                    [part.column("doc_id").take(where), part.column("text_key").take(where),
                     pa.array([f["item_id"] for f in flat], pa.binary()),
                     pa.array([f["score"] for f in flat], pa.float64()),
                     pa.array([f["first_word"] for f in flat], pa.int32()),
                     pa.array([f["last_word"] for f in flat], pa.int32())],
                    ["doc_id", "text_key", "item", "score", "first_word", "last_word"])
    return run


def _matches(docs: DataFrame, benchmark: DataFrame, threshold: float) -> DataFrame:
    """The leaks of every row of ``docs``, by the keys of its text and of the item's text."""
    keyed = (docs.filter("text is not null")
             .select("doc_id", text_key(F.col("text")).alias("text_key"), "text"))
    found = stored(candidates(keyed, item_blocks(benchmark), threshold), "candidates")
    return keyed.join(found, "text_key").select("doc_id", "text_key", "text", "found").mapInArrow(
        _aligned(threshold), "doc_id long, text_key binary, item binary, score double, "
        "first_word int, last_word int")


def leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, item_id, score, first_word, last_word) of every document and item it holds."""
    ids = benchmark.select("item_id", text_key(F.col("text")).alias("item"))
    return _matches(docs, benchmark, threshold).join(ids, "item").select(
        "doc_id", "item_id", "score", "first_word", "last_word")


def drop_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that hold no test item; all columns stay."""
    key = fresh("_text_key", docs)
    leaked = stored(_matches(docs, benchmark, threshold).select("text_key").distinct(), "leaked")
    return (docs.withColumn(key, text_key(F.col("text")))
            .join(leaked.withColumnRenamed("text_key", key), key, "left_anti")
            .select(*columns(docs)))
