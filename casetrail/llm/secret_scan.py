"""Secret scan with corpus-wide ownership frequency, in DataFrame functions only.

Three base kinds are found by pattern in every whole text (``assign``, ``access``, ``hex``).
The method adds ``token``: long mixed-case strings with digits that stand alone.  Every
candidate value is hashed, and the corpus is aggregated to the number of distinct owners and
of distinct repositories that hold the hash.  A value that many owners hold is a widely copied
example; a value that few hold looks live and owner-specific.  Base spans are always reported,
with their class; a ``token`` span is reported only where it looks live.

Positions are counted in code points from 0, the end exclusive.  Spark's pattern functions
return matches without positions, so every match is wrapped in two control characters (which
are first replaced by a third in the text, one for one) and positions are added up from the
lengths of the pieces between them.  The work of a text grows with its length and its number of
matches: every list is computed once and walked in order.

Defined cases: a null text counts as empty; texts without matches have no spans; repeated rows
each get their row, and count once for ownership; a null owner is an owner of its own; extra
columns are ignored (``redact`` keeps them); empty tables give empty tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import columns, fresh, let, running, stored

OPEN, CLOSE, PLAIN = "\u0001", "\u0002", "\u0003"


@dataclass(frozen=True)
class Kind:
    """A span kind: its pattern, the group that holds the value, and the least value length."""
    name: str
    pattern: str
    group: int
    least: int
    base: bool = True


# Fixed values of the contract.  Maximal runs make "+ with a least length" and "{least,}" the
# same for access and hex; assign must consume short values too, so its length is tested after.
ASSIGN = Kind("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                        r"""([A-Za-z0-9+/_.=-]+)""", 1, 6)
ACCESS = Kind("access", r"AKIA[A-Z0-9]{16,}", 0, 20)
HEX = Kind("hex", r"[0-9a-f]{24,}", 0, 24)
TOKEN = Kind("token", r"(?<![A-Za-z0-9_-])(?=[A-Za-z_-]*[0-9])(?=[a-z0-9_-]*[A-Z])"
                      r"(?=[A-Z0-9_-]*[a-z])[A-Za-z0-9_-]{20,}", 0, 20, base=False)
KINDS = (ASSIGN, ACCESS, HEX, TOKEN)
BASE = tuple(k for k in KINDS if k.base)
MASK = "[SECRET]"
#: A value that this many distinct owners hold is a widely copied example.
COPIED_OWNERS = 5

_SPAN = "struct<start:int,rank:int,kind:string,end:int,value:string>"


def _spans(text: Column, kind: Kind) -> Column:
    """Spans of one kind in a text, in order of position."""
    marked = F.regexp_replace(F.translate(text, OPEN + CLOSE, PLAIN + PLAIN), kind.pattern,
                              OPEN + "$0" + CLOSE)

    def located(pieces: Column, starts: Column) -> Column:
        def span(piece: Column, i: Column) -> Column:
            match = F.substring_index(piece, CLOSE, 1)
            at = F.get(starts, i + 1)
            return F.struct(at.alias("start"), F.lit(KINDS.index(kind)).alias("rank"),
                            F.lit(kind.name).alias("kind"),
                            (at + F.length(match)).cast("int").alias("end"),
                            F.regexp_extract(match, kind.pattern, kind.group).alias("value")
                            if kind.group else match.alias("value"))
        return F.transform(F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0))), span)

    # every piece but the first holds one closing mark
    found = let(F.split(marked, OPEN), lambda pieces: let(
        running(F.transform(pieces, lambda p, i: (F.length(p) - F.least(i, F.lit(1))).cast("int")),
                0, lambda x, y: x + y),
        lambda starts: located(pieces, starts)))
    kept = F.filter(found, lambda s: F.length(s["value"]) >= kind.least).cast(f"array<{_SPAN}>")
    return F.when(text.rlike(kind.pattern), kept).otherwise(F.array().cast(f"array<{_SPAN}>"))


def spans_column(text: Column) -> Column:
    """All candidate spans of a text ordered by start, then kind; a token that overlaps a base
    span is part of that span.

    One sweep in order of start: a token stands if no base span before it reaches beyond its
    start, and the next base span starts at its end or later.
    """
    token, none = KINDS.index(TOKEN), 2**31 - 1

    def standing(spans: Column) -> Column:
        reach = running(F.transform(spans, lambda s: F.when(s["rank"] != token, s["end"])
                                    .otherwise(0)), 0, F.greatest)
        ahead = F.reverse(running(
            F.transform(F.reverse(spans), lambda s: F.when(s["rank"] != token, s["start"])
                        .otherwise(none)), none, F.least))
        return let(reach, lambda before: let(ahead, lambda after: F.filter(
            spans, lambda s, i: (s["rank"] != token) | ((F.get(before, i) <= s["start"])
                                                        & (F.get(after, i) >= s["end"])))))

    return let(F.array_sort(F.concat(*[_spans(text, k) for k in KINDS])), standing)


def candidates(docs: DataFrame, owner_col: str = "source", repo_col: str = "doc_id") -> DataFrame:
    """One row for each document that has a candidate: the text's hash, owner, repository, spans."""
    text = F.coalesce(F.col("text"), F.lit(""))
    likely = F.lit(False)
    for kind in KINDS:
        likely = likely | text.rlike(kind.pattern)
    return (docs.select("doc_id", F.col(owner_col).alias("owner"), F.col(repo_col).alias("repo"),
                        text.alias("text"))
            .filter(likely)
            .select("doc_id", "owner", "repo", F.sha2("text", 256).alias("text_hash"),
                    spans_column(F.col("text")).alias("spans")))


def ownership(found: DataFrame) -> DataFrame:
    """Distinct owners and repositories of every candidate value, by the value's hash.

    Every step shrinks on the map side first, so a value that a third of the corpus holds
    reaches its reducer as a few rows.
    """
    held = (found.select("owner", "repo", F.explode("spans").alias("s"))
            .select(F.sha2("s.value", 256).alias("value_hash"), "owner", "repo").distinct())
    by_owner = held.groupBy("value_hash", "owner").agg(F.count(F.lit(1)).alias("repos"))
    return by_owner.groupBy("value_hash").agg(F.count(F.lit(1)).alias("owners"),
                                              F.sum("repos").alias("repos"))


def judged(found: DataFrame, copied_owners: int = COPIED_OWNERS) -> DataFrame:
    """Reported spans of every distinct text: (text_hash, spans) with owners, repos and class.

    Copies of a text share their spans, so each distinct text is joined once.
    """
    texts = found.groupBy("text_hash").agg(F.first("spans").alias("spans"))
    single = (texts.select("text_hash", F.explode("spans").alias("s"))
              .withColumn("value_hash", F.sha2("s.value", 256)))
    classed = (single.join(ownership(found), "value_hash")
               .withColumn("copied", F.col("owners") >= copied_owners)
               .filter((F.col("s.kind") != TOKEN.name) | ~F.col("copied")))
    return classed.groupBy("text_hash").agg(F.array_sort(F.collect_list(F.struct(
        F.col("s.start").alias("start"), F.col("s.rank").alias("rank"),
        F.col("s.kind").alias("kind"), F.col("s.end").alias("end"),
        F.col("s.value").alias("value"), "owners", "repos", "copied"))).alias("spans"))


def scan(docs: DataFrame, owner_col: str = "source", repo_col: str = "doc_id",
         copied_owners: int = COPIED_OWNERS) -> DataFrame:
    """(doc_id, spans) for every row of ``docs``; spans are null where there are none."""
    found = stored(candidates(docs, owner_col, repo_col), "secrets")
    spans = judged(found, copied_owners)
    with_spans = found.select("doc_id", "text_hash").join(spans, "text_hash", "left")
    text = F.coalesce(F.col("text"), F.lit(""))
    likely = F.lit(False)
    for kind in KINDS:
        likely = likely | text.rlike(kind.pattern)
    none = F.lit(None).cast(with_spans.schema["spans"].dataType)
    without = docs.filter(~likely).select("doc_id", none.alias("spans"))
    return with_spans.select("doc_id", "spans").unionByName(without)


def _listed(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def digest(scanned: DataFrame) -> DataFrame:
    """Counts and digests of scanned documents."""
    spans = F.coalesce(F.col("spans"), F.array().cast(scanned.schema["spans"].dataType))
    base = F.filter(spans, lambda s: s["kind"] != TOKEN.name)

    def count(test) -> Column:
        return F.size(F.filter(spans, test)).cast("long")

    def is_kind(name: str):
        return lambda s: s["kind"] == name

    return scanned.select(
        "doc_id",
        *[count(is_kind(k.name)).alias(f"n_{k.name}") for k in BASE],
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(spans).alias("spans"),
        count(lambda s: s["copied"]).alias("n_copied"),
        count(lambda s: ~s["copied"]).alias("n_live"))


def _masked(text: Column, spans: Column) -> Column:
    """The text with every span (overlapping ones joined) replaced by the mask."""
    def opened(before: Column):
        def piece(s: Column, i: Column) -> Column:
            at = F.get(before, i)
            return F.when(s["start"] < at, F.lit("")).otherwise(
                F.concat(F.substring(text, at + 1, s["start"] - at), F.lit(MASK)))
        return piece

    def rest(s: Column) -> Column:
        return F.coalesce(F.array_max(F.transform(s, lambda x: x["end"])), F.lit(0))

    return let(spans, lambda listed: let(
        running(F.transform(listed, lambda s: s["end"]), 0, F.greatest),
        lambda before: F.concat(F.array_join(F.transform(listed, opened(before)), ""),
                                F.substring(text, rest(listed) + 1, F.length(text)))))


def redact(docs: DataFrame, owner_col: str = "source", repo_col: str = "doc_id",
           copied_owners: int = COPIED_OWNERS) -> DataFrame:
    """``docs`` with every reported span of ``text`` masked; all rows and columns stay.

    Only the texts that have candidates take part in the join.
    """
    found = stored(candidates(docs, owner_col, repo_col), "secrets")
    key, listed = fresh("_text_hash", docs), fresh("_spans", docs)
    spans = stored(judged(found, copied_owners).withColumnsRenamed(
        {"text_hash": key, "spans": listed}), "judged")
    text = F.coalesce(F.col("text"), F.lit(""))
    likely = F.lit(False)
    for kind in KINDS:
        likely = likely | text.rlike(kind.pattern)
    hit = (docs.filter(likely).withColumn(key, F.sha2("text", 256))
           .join(spans, key, "left")
           .withColumn("text", F.when(F.col(listed).isNull(), F.col("text"))
                       .otherwise(_masked(F.col("text"), F.col(listed))))
           .select(*columns(docs)))
    return hit.unionByName(docs.filter(~likely))
