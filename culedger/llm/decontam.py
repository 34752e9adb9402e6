"""Benchmark decontamination by spaced seeds (operator 9).

A mask fixes which of a window's tokens are hashed and which are ignored, so a
copy in which an ignored token was replaced still meets its source. The hashes
of all windows of the benchmark and of the documents are joined; around each
hit, document and item are laid over each other and compared token by token.
A document is contaminated if some ``window`` tokens in a row agree with an
item in all but ``substitutions`` places.

No such overlap lacks a seed. Any two substituted places in ``WHOLE`` tokens
leave a window of one of the ``MASKS`` whole (the test enumerates them). Shorter
items, smaller windows and more substitutions s are met by lighter seeds: of
s + 2 pieces in a row, s substitutions leave two whole, and the seeds hash each
two pieces. Documents get the lighter seeds only if some item needs them.

Only built-in functions; seeds of documents are not shuffled, only hits are,
and texts meet their hits by id.
The benchmark's seeds are broadcast up to ``broadcast_seeds`` rows (a count is
taken first) and joined by shuffle beyond that.

Tokens are words in lower case without the characters ``DROPPED``. Nulls and
empty texts have no tokens and are clean; an item with fewer tokens than a
window is compared as far as it goes, if it has ``SPAN`` tokens; shorter items
are too short to be evidence and are not searched. Repeated rows are judged
each on its own, by id and text. Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from culedger.llm.common import BLANKS, let, materialize

#: 1 is hashed, 0 is ignored.
MASKS = ("11101011", "11011101", "11100111")
SPAN = 8
#: Fixed value: tokens in a row that the masks suffice for, with so many
#: substitutions.
WHOLE, REPLACED = 13, 2
#: Characters that tokens are compared without.
DROPPED = r"""[.,;:!?"'()\[\]]"""


def tokens(text: Column) -> Column:
    """64-bit hashes of a text's tokens, in order."""
    flat = F.trim(F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), DROPPED, ""), f"[{BLANKS}]+", " "))
    return F.transform(F.filter(F.split(flat, " "), lambda w: w != ""), lambda w: F.xxhash64(w))


def heavy_masks() -> list[list[int]]:
    """The hashed places of each mask."""
    return [[k for k, c in enumerate(m) if c == "1"] for m in MASKS]


def light_masks(window: int, substitutions: int) -> list[list[int]]:
    """The hashed places of each two of ``substitutions`` + 2 equal pieces."""
    piece = min(SPAN, window) // (substitutions + 2)
    if piece < 1:
        raise ValueError(f"{substitutions} substitutions in {window} tokens leave no seed")
    return [[*range(piece), *range(gap * piece, (gap + 1) * piece)] for gap in range(1, substitutions + 2)]


def seeds(hashes: str, masks: list[list[int]]) -> Column:
    """(pos, seed) for each mask and each place of the token hashes that it
    fits at."""
    def at(mask: list[int]) -> Column:
        name = " ".join(map(str, mask))
        one = lambda i: F.struct(i.alias("pos"), F.xxhash64(F.lit(name), *[F.get(F.col(hashes), i + k) for k in mask]).alias("seed"))
        none = F.array().cast("array<struct<pos:int,seed:bigint>>")
        return F.when(F.size(hashes) > mask[-1], F.transform(F.sequence(F.lit(0), F.size(hashes) - 1 - mask[-1]), one)).otherwise(none)

    return F.concat(*[at(m) for m in masks])


def _spread(table: DataFrame, masks: list[list[int]], *keep: str) -> DataFrame:
    """A row for each seed: keep, n (tokens), pos, seed. The token arrays stay
    behind: a row for each seed must not carry a copy. An outer explode keeps
    Spark from filtering on, and so computing, the seeds twice."""
    found = table.withColumn("n", F.size("hashes")).withColumn("seeds", seeds("hashes", masks)).select(*keep, "n", "seeds")
    return found.select(*keep, "n", F.explode_outer("seeds").alias("s")).select(*keep, "n", "s.pos", "s.seed").where("seed is not null")


def agreement(part: Column, item: Column, window: int) -> Column:
    """Most tokens in agreement over ``window`` tokens in a row (all, if the
    item has fewer); a place beyond the document's ends is null in ``part``."""
    width = F.least(F.lit(window), F.size(item))
    same = F.zip_with(part, item, lambda a, b: F.coalesce((a == b).cast("int"), F.lit(0)))
    return let(same, lambda x: F.array_max(F.transform(F.sequence(F.lit(0), F.size(x) - width), lambda i: F.aggregate(F.slice(x, i + 1, width), F.lit(0), lambda t, y: t + y))))


def overlaps(docs: DataFrame, benchmark: DataFrame, window: int = 13, substitutions: int = 2, broadcast_seeds: int = 1_000_000, text: str = "text", doc_id: str = "doc_id", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Rows (doc_id, key, item_id, offset, agreeing): verified overlaps, one for
    each document, item and offset between the two. ``key`` is the hash of a
    document's id and text."""
    items = benchmark.select(F.col(item_id).alias("item_id"), tokens(F.col(item_text)).alias("hashes")).where(F.size("hashes") >= SPAN).withColumn("item_key", F.xxhash64("item_id", "hashes")).distinct()
    heavy = F.size("hashes") >= WHOLE if window >= WHOLE and substitutions <= REPLACED else F.lit(False)
    masks, light = heavy_masks(), light_masks(window, substitutions)
    known = _spread(items.where(heavy), masks, "item_key")
    if not items.where(~heavy).isEmpty():
        known = known.unionByName(_spread(items.where(~heavy), light, "item_key"))
        masks = masks + light
    known = known.select("item_key", "seed", F.col("pos").alias("item_pos"), F.col("n").alias("item_size"))
    known = materialize(known.distinct(), "seeds")
    if known.count() <= broadcast_seeds:
        known = F.broadcast(known)
    keyed = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(doc_id), F.col(text)).alias("key"), F.col(text).alias("text"))
    hits = _spread(keyed.select("key", tokens(F.col("text")).alias("hashes")), masks, "key").join(known, "seed")
    hits = materialize(hits.select("key", "item_key", "item_size", (F.col("pos") - F.col("item_pos")).alias("offset")).distinct(), "hits")
    by_doc = hits.groupBy("key").agg(F.collect_list(F.struct("item_key", "item_size", "offset")).alias("hits"))
    # Hits have no size bound, so they are never broadcast: texts meet them by
    # the same sort-merge join at every size.
    under = keyed.join(by_doc.hint("merge"), "key").dropDuplicates(["key"]).withColumn("hashes", tokens(F.col("text"))).drop("text")

    def part(h: Column) -> Column:
        head = F.greatest(-h["offset"], F.lit(0))  # tokens of the item before the document's first
        found = F.concat(F.array_repeat(F.lit(None).cast("bigint"), head), F.slice("hashes", F.greatest(h["offset"], F.lit(0)) + 1, h["item_size"] - head))
        return F.struct(h["item_key"].alias("item_key"), h["offset"].alias("offset"), found.alias("part"))

    parts = under.withColumn("parts", F.transform("hits", part)).select("doc_id", "key", F.explode("parts").alias("p")).select("doc_id", "key", "p.*")
    both = parts.join(items.withColumnRenamed("hashes", "item"), "item_key").withColumn("agreeing", agreement(F.col("part"), F.col("item"), window))
    return both.where(F.col("agreeing") >= F.least(F.lit(window), F.size("item")) - substitutions).select("doc_id", "key", "item_id", "offset", "agreeing")


def contaminated(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """Rows (doc_id, key, n_items, agreeing) for the contaminated documents."""
    return overlaps(docs, benchmark, **how).groupBy("doc_id", "key").agg(F.countDistinct("item_id").alias("n_items"), F.max("agreeing").cast("long").alias("agreeing"))


def remove(docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id", **how) -> DataFrame:
    """``docs`` without the contaminated documents."""
    own = [f"c{i}" for i in range(len(docs.columns))]  # the input may use any name
    at = dict(zip(docs.columns, own, strict=True))
    wide = docs.toDF(*own)
    bad = contaminated(wide, benchmark, text=at[text], doc_id=at[doc_id], **how).select("key")
    keyed = wide.withColumn("key", F.xxhash64(F.col(at[doc_id]), F.col(at[text])))
    return keyed.join(bad, "key", "left_anti").select(own).toDF(*docs.columns)
