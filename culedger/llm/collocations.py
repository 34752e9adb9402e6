"""Phrase collocation mining with an FM-index per shard over word ids
(operator 13).

Per language, phrases of 2 to ``LONGEST`` (3) words that occur ``least`` (10)
times or more within pieces of text are scored by floor(10^6 a^2 / (l r)): a,
l, r are the occurrences of the phrase, of its first part and of the rest, at
the cut that scores lowest. A phrase that lies in a longer one which has half
of its occurrences or more goes.

1. Each task cuts its texts into shards (one language, some ``SHARD_WORDS``
   words), without a shuffle: a shard is the sequence of word ids with a break
   between pieces, and a dictionary of its own. Texts are read three times;
   only counts move.
2. ``FMIndex`` sorts the shard's suffixes and reads off the Burrows-Wheeler
   transform of the sequence and of its reverse. An n-gram is an interval of
   either; extending it to the left splits its interval by the symbols of the
   transform that stand there, and the reverse's interval moves in step, so it
   can be extended to the right next. All intervals of a level are extended at
   once. Levels are depth-limited by the longest phrase.
3. Shards' counts are summed in Spark. Words come first. Two-word phrases of
   frequent words are many and mostly rare, so they are summed by a hash next,
   as packed arrays of a hash range each; two hashes that meet only raise a
   sum. Then phrases of two words with a sum of ``least`` or more, and of
   three words whose two-word ends have one, are summed by their words, packed
   alike: a phrase cannot occur more often than what it holds, so nothing is
   lost. What is
   frequent reaches the shards as a bit table of bounded size (``MOST_BITS``); a
   wrong hit there costs a row that the last sum drops, never a phrase.
4. Cuts, extensions and ranks are joins and aggregates over frequent phrases.

Nulls: a null lang is ``und``, a null text has no words; blank pieces count
nothing. A text is worked on whole, however long. Ties in score and occurrences
go by phrase in byte order. Repeated rows count again. Extra columns are not
read. An empty table gives no rows.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from culedger.llm import arrays
from culedger.llm.common import materialize

# The bytes that end a piece, and those that part words.
BREAKS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
LONGEST = 3
#: Words of a shard, about, at so many bytes a word.
SHARD_WORDS, WORD_BYTES = 500_000, 6
#: A table of what is frequent has 2 to the power of these bits, by what it
#: holds (2 to 128 MB), and is merged in stripes.
LEAST_BITS, MOST_BITS, STRIPES = 24, 30, 64
#: Words of the corpus for each range of hashes that phrases are summed in, and
#: the bytes that tell hashes of a range apart.
RANGE_WORDS, KEY_BYTES = 4_000_000, 5
#: Tasks that ranges are dealt to at most; a task takes one after the other.
MOST_TASKS = 50_000
SCALE = 1_000_000

#: A byte that UTF-8 does not have marks the end of a piece.
END = b"\xff"
_FOLD = bytes(END[0] if c in BREAKS else 32 if c in BLANKS else c + 32 if 65 <= c <= 90 else c for c in range(256))


# Shards -----------------------------------------------------------------------


def _sequence(texts: list[bytes]) -> pa.DictionaryArray:
    """The words of ``texts`` in order, with ``END`` after each piece."""
    joined = (b"\n".join(texts) + b"\n").translate(_FOLD).replace(END, b" " + END + b" ")
    return pa.array(joined.split(), pa.binary()).dictionary_encode()


def _shard(texts: list[bytes]) -> tuple[np.ndarray, pa.Array]:
    """(ids, words): the sequence of word ids, 0 for a break, and the shard's
    words in byte order, the first of which has id 1."""
    seq = _sequence(texts)
    ids = seq.indices.to_numpy(zero_copy_only=False)
    order = pc.array_sort_indices(seq.dictionary)
    place = np.empty(len(order), np.int32)
    place[order.to_numpy()] = np.arange(1, len(order) + 1, dtype=np.int32)
    ids = place[ids]
    # END is above every byte of UTF-8, and each text ends with one.
    ids[ids == len(order)] = 0
    return ids, seq.dictionary.take(order[:-1]).cast(pa.string())


def _shards(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[tuple[str, np.ndarray, pa.Array]]:
    """(lang, ids, words) for runs of some ``words`` words of a task's texts."""
    held: dict[str, list[bytes]] = {}
    size: dict[str, int] = {}
    for b in batches:
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            held.setdefault(lang, []).append(text)
            size[lang] = size.get(lang, 0) + len(text)
            if size[lang] >= WORD_BYTES * words:
                yield lang, *_shard(held.pop(lang))
                size.pop(lang)
    for lang, texts in held.items():
        yield lang, *_shard(texts)


# The index ----------------------------------------------------------------------


def _suffix_order(s: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``s`` by what follows, up to ``depth`` symbols or a break
    (symbols behind a break don't matter), then by position."""
    n = len(s)
    top = int(s.max()) + 1 if n else 1
    order = np.arange(n)
    rank = s.astype(np.int64)
    far = np.zeros(n + depth, np.int64)
    key = rank.copy()
    seen = s == 0
    for k in range(1, depth):
        far[:n] = rank
        nxt = far[k : k + n].copy()
        nxt[seen] = 0
        if int(key.max(initial=0)) >= (1 << 62) // top:
            key = np.unique(key, return_inverse=True)[1].astype(np.int64)
        key = key * top + nxt
        seen = seen | (nxt == 0)
    return order[np.argsort(key, kind="stable")]


class FMIndex:
    """The transform of a sequence of symbols (0: break), sorted to ``depth``."""

    def __init__(self, s: np.ndarray, depth: int):
        order = _suffix_order(s, depth)
        # The symbol before; the sequence ends with a break, which stands
        # before the first.
        self.bwt = s[order - 1]
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(s))]).astype(np.int64)
        # Where a row goes when the symbol before it is read as well.
        self.moves = np.empty(len(s), np.int64)
        self.moves[np.argsort(self.bwt, kind="stable")] = np.arange(len(s))

    def extend(self, low: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, ...]:
        """All extensions of disjoint intervals by one symbol before them:
        (interval's number, symbol, the extension's low and size, rows of the
        interval whose symbol is smaller). Breaks are not extended into."""
        which = np.repeat(np.arange(len(low)), count)
        rows = low[which] + np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
        symbol = self.bwt[rows]
        order = np.lexsort((symbol, which))
        which, symbol, rows = which[order], symbol[order], rows[order]
        new = np.ones(len(which), bool)
        new[1:] = (which[1:] != which[:-1]) | (symbol[1:] != symbol[:-1])
        at = np.flatnonzero(new)
        size = np.diff(np.append(at, len(which)))
        first = np.searchsorted(which[at], which[at])
        smaller = at - at[first]
        keep = symbol[at] > 0
        return which[at][keep], symbol[at][keep], self.moves[rows[at]][keep], size[keep], smaller[keep]


class BiIndex:
    """An n-gram is an interval of the index and one of the reverse's."""

    def __init__(self, s: np.ndarray, depth: int = LONGEST):
        self.s, self.depth = s, depth
        self.forward = FMIndex(s, depth)

    @functools.cached_property
    def backward(self) -> FMIndex:
        return FMIndex(np.concatenate([self.s[:-1][::-1], self.s[-1:]]), self.depth)

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(symbol, low, count): one-word intervals, the same in both."""
        counts = np.diff(self.forward.starts)
        ids = np.flatnonzero(counts[1:]) + 1 if len(counts) else np.empty(0, np.int64)
        return ids, self.forward.starts[ids], counts[ids]

    def pairs(self, wanted: np.ndarray) -> tuple[np.ndarray, ...]:
        """Two-word phrases by extension to the left of words that are wanted:
        (first, second, count, low in the reverse's index)."""
        ids, low, count = self.words()
        keep = wanted[ids]
        ids, low, count = ids[keep], low[keep], count[keep]
        which, left, _, size, smaller = self.forward.extend(low, count)
        # The reverse's interval of the longer phrase lies inside the word's,
        # behind the rows that go on with a smaller symbol.
        reverse = low[which] + smaller
        keep = wanted[left]
        return left[keep], ids[which][keep], size[keep], reverse[keep]

    def triples(self, pairs: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
        """Three-word phrases by extension to the right: (number of the pair,
        third word, count)."""
        _, _, count, reverse = pairs
        which, right, _, size, _ = self.backward.extend(reverse, count)
        return which, right, size


# What is frequent ------------------------------------------------------------------


def _hashes(words: pa.Array, lang: str) -> np.ndarray:
    data, offs = arrays.buffers(words)
    own, cut = arrays.buffers(pa.array([lang]))
    seed = arrays.hash_words(own, cut[:-1], cut[1:]) if len(own) else np.zeros(1, np.uint64)
    return arrays.mix(arrays.hash_words(data, offs[:-1], offs[1:]) ^ seed[0])


def _paired(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return arrays.mix(a * np.uint64(arrays.BASE) + b)


class Table:
    """A bit for each slot that a hash falls in."""

    def __init__(self, bits: np.ndarray):
        self.bits, self.shift = bits, np.uint64(64 - (len(bits) * 8).bit_length() + 1)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        slot = hashes >> self.shift
        return (self.bits[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _marked(hashes: DataFrame) -> Table:
    """The table of the hashes (column h): an array of bounded size, merged in
    Spark."""
    count = hashes.count()
    power = min(MOST_BITS, max(LEAST_BITS, (16 * count).bit_length()))
    width = (1 << power) // 8 // STRIPES

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            slot = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64) >> np.uint64(64 - power)
            stripe = (slot >> np.uint64(power - STRIPES.bit_length() + 1)).astype(np.int64)
            for k in np.unique(stripe).tolist():
                own = slot[stripe == k] & np.uint64(8 * width - 1)
                bits = total.setdefault(k, np.zeros(width, np.uint8))
                np.bitwise_or.at(bits, (own >> np.uint64(3)).astype(np.int64), (1 << (own & np.uint64(7))).astype(np.uint8))
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], ["stripe", "bits"])

    # A stripe is made in one task: 2 MB at most, whatever falls in it.
    dealt = hashes.select("h").repartition(STRIPES, F.shiftrightunsigned("h", 64 - STRIPES.bit_length() + 1))
    out = np.zeros((STRIPES, width), np.uint8)
    for r in dealt.mapInArrow(merged, "stripe int, bits binary").collect():
        out[r["stripe"]] |= np.frombuffer(bytes(r["bits"]), np.uint8)
    return Table(out.ravel())


def _slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        own, key = (b.column(i).to_numpy(zero_copy_only=False) for i in range(2))
        h = arrays.mix(key.view(np.uint64) | own.astype(np.uint64) << np.uint64(8 * KEY_BYTES))
        yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], ["h"])


def _word_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        langs = b.column(0).dictionary_encode()
        which = langs.indices.to_numpy(zero_copy_only=False)
        for i, lang in enumerate(langs.dictionary.to_pylist()):
            own = b.column(1).take(pa.array(np.flatnonzero(which == i)))
            yield pa.RecordBatch.from_arrays([pa.array(_hashes(own, lang).view(np.int64))], ["h"])


# Counts of shards -------------------------------------------------------------------


def _counted(lang: str, phrase: list[pa.Array], count: np.ndarray) -> Iterator[pa.RecordBatch]:
    names = [f"w{k + 1}" for k in range(len(phrase))]
    step = 1 << 16
    for a in range(0, len(count), step):
        own = [p[a : a + step] for p in phrase]
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(own[0])), *own, pa.array(count[a : a + step])], ["lang", *names, "n"])


def _word_counts(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, ids, words in _shards(batches, size):
            yield from _counted(lang, [words], np.bincount(ids, minlength=len(words) + 1)[1:].astype(np.int64))

    return run


def _indexed(ids: np.ndarray, words: pa.Array, lang: str, common: Table) -> tuple[BiIndex, np.ndarray, np.ndarray]:
    """The shard's index; rarer words are breaks, as no frequent phrase holds
    one. Also the words' hashes and which are common (by id)."""
    h = np.concatenate([np.zeros(1, np.uint64), _hashes(words, lang)])
    wanted = common.has(h)
    wanted[0] = False
    s = np.where(wanted[ids], ids, np.int32(0))
    # Breaks in a row are one.
    s = s[np.append(True, (s[1:] != 0) | (s[:-1] != 0))] if len(s) else s
    return BiIndex(np.append(s, np.int32(0))), h, wanted


def _cuts(ascending: np.ndarray, ranges: int) -> list[int]:
    """Where each of ``ranges`` equal ranges of 64 bits begins, and the end."""
    at = (np.arange(1, ranges, dtype=object) * 2**64 // ranges).astype(np.uint64)
    return [0, *np.searchsorted(ascending, at).tolist(), len(ascending)]


def _range_of(h: np.ndarray, ranges: int) -> np.ndarray:
    at = (np.arange(1, ranges, dtype=object) * 2**64 // ranges).astype(np.uint64)
    return np.searchsorted(at, h, side="right").astype(np.uint64)


def _slot(h: np.ndarray, ranges: int) -> np.ndarray:
    """The hash that a pair's range and key make, for the table."""
    low = h & np.uint64((1 << (8 * KEY_BYTES)) - 1)
    return arrays.mix(low | _range_of(h, ranges) << np.uint64(8 * KEY_BYTES))


def _pair_sums(size: int, common: Table, ranges: int):
    """(range, hashes, counts): a shard's two-word phrases by ranges of their
    hash, packed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, ids, words in _shards(batches, size):
            index, h, wanted = _indexed(ids, words, lang, common)
            first, second, count, _ = index.pairs(wanted)
            key = _paired(h[first], h[second])
            order = np.argsort(key)
            key, count = key[order], np.minimum(count[order], 2**31 - 1).astype(np.int32)
            cut = _cuts(key, ranges)
            some = np.flatnonzero(np.diff(cut)).tolist()
            low = key.view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES]
            packed = [pa.array([x[cut[k] : cut[k + 1]].tobytes() for k in some], pa.binary()) for x in (low, count)]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), *packed], ["range", "hashes", "counts"])

    return run


def _often(least: int):
    """(range, keys) of the hashes whose counts reach ``least``, of rows sorted
    by range."""
    def total(held: list) -> tuple[np.ndarray, np.ndarray]:
        key, count = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.argsort(key)
        key, count = key[order], count[order]
        at = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        return key[at], np.add.reduceat(count, at)

    def kept(now: int, held: list) -> pa.RecordBatch:
        key, count = total(held)
        key = key[count >= least]
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(key), now, np.int32)), pa.array(key.view(np.int64))], ["range", "key"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, size = None, [], 0
        for b in batches:
            for k, h, n in zip(b.column(0).to_pylist(), b.column(1), b.column(2), strict=True):
                if k != now and held:
                    yield kept(now, held)
                    held, size = [], 0
                now = k
                low = np.frombuffer(h.as_py(), np.uint8).reshape(-1, KEY_BYTES)
                wide = np.zeros((len(low), 8), np.uint8)
                wide[:, :KEY_BYTES] = low
                held.append((wide.view(np.uint64).ravel(), np.frombuffer(n.as_py(), np.int32).astype(np.int64)))
                size += len(low)
                if size >= RANGE_WORDS:
                    held = [total(held)]
                    size = 0
        if held:
            yield kept(now, held)

    return run


def _phrase_sums(size: int, common: Table, often: Table, ranges: int):
    """(range, lang, block): a shard's phrases of two words that are often, and
    of three whose ends are, as compressed tables by ranges of their hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        for lang, ids, words in _shards(batches, size):
            index, h, wanted = _indexed(ids, words, lang, common)
            pairs = index.pairs(wanted)
            two = _paired(h[pairs[0]], h[pairs[1]])
            keep = often.has(_slot(two, ranges))
            pairs, two = tuple(x[keep] for x in pairs), two[keep]
            which, third, count = index.triples(pairs)
            keep = often.has(_slot(_paired(h[pairs[1][which]], h[third]), ranges))
            which, third, count = which[keep], third[keep], count[keep]
            named = lambda *x: pc.binary_join_element_wise(*[words.take(pa.array(i - 1)) for i in x], " ")
            phrase = pa.concat_arrays([named(*pairs[:2]), named(pairs[0][which], pairs[1][which], third)])
            n = np.concatenate([pairs[2], count]).astype(np.int64)
            key = np.concatenate([two, _paired(two[which], h[third])])
            order = np.argsort(key)
            cut = _cuts(key[order], ranges)
            for k in np.flatnonzero(np.diff(cut)).tolist():
                own = pa.array(np.sort(order[cut[k] : cut[k + 1]]))  # as the index has them: words in order
                block = pa.record_batch([phrase.take(own), pa.array(n).take(own)], ["phrase", "n"])
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, block.schema, options=options) as w:
                    w.write_batch(block)
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([lang]), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["range", "lang", "block"])

    return run


def _phrase_totals(least: int):
    """(lang, phrase, n) of the phrases with ``least`` occurrences or more, of
    rows sorted by range and lang."""
    def total(held: list[pa.Table]) -> pa.Table:
        return pa.concat_tables(held).group_by("phrase").aggregate([("n", "sum")]).rename_columns(["phrase", "n"])

    def kept(lang: str, held: list[pa.Table]) -> Iterator[pa.RecordBatch]:
        t = total(held)
        t = t.filter(pc.greater_equal(t["n"], least))
        for b in t.to_batches(max_chunksize=1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(b)), b.column(0), b.column(1)], ["lang", "phrase", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, rows = None, [], 0
        for b in batches:
            for key in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                if key[:2] != now and held:
                    yield from kept(now[1], held)
                    held, rows = [], 0
                now = key[:2]
                with pa.ipc.open_stream(key[2].as_buffer()) as r:
                    held.append(r.read_all())
                rows += held[-1].num_rows
                if rows >= RANGE_WORDS // 2:
                    held, rows = [total(held)], 0
        if held:
            yield from kept(now[1], held)

    return run


def counts(docs: DataFrame, least: int = 10, size: int = SHARD_WORDS) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(words of each lang in all, frequent words, two-word and three-word
    phrases), each with its occurrences n in its lang."""
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))

    def summed(run, k: int) -> DataFrame:
        names = [f"w{i + 1}" for i in range(k)]
        found = rows.mapInArrow(run, "lang string, " + ", ".join(f"{x} string" for x in names) + ", n long")
        return found.groupBy("lang", *names).agg(F.sum("n").alias("n"))

    every = materialize(summed(_word_counts(size), 1), "phrase-words")
    totals = every.groupBy("lang").agg(F.sum("n").alias("total"))
    one = every.where(F.col("n") >= least)
    common = _marked(one.select("lang", "w1").mapInArrow(_word_hashes, "h long"))
    ranges = 1 + int(every.agg(F.sum("n")).first()[0] or 0) // RANGE_WORDS
    tasks = min(ranges, MOST_TASKS)
    packed = rows.mapInArrow(_pair_sums(size, common, ranges), "range int, hashes binary, counts binary")
    sums = packed.repartition(tasks, "range").sortWithinPartitions("range").mapInArrow(_often(least), "range int, key long")
    slots = materialize(sums, "phrase-hashes").mapInArrow(_slots, "h long")
    blocks = rows.mapInArrow(_phrase_sums(size, common, _marked(slots), ranges), "range int, lang string, block binary")
    found = blocks.repartition(tasks, "range").sortWithinPartitions("range", "lang").mapInArrow(_phrase_totals(least), "lang string, phrase string, n long")
    w = F.split("phrase", " ")
    phrases = materialize(found.select("lang", *[F.get(w, F.lit(i)).alias(f"w{i + 1}") for i in range(LONGEST)], "n"), "phrases")
    return totals, one, phrases.where("w3 is null").drop("w3"), phrases.where("w3 is not null")


# Scores ------------------------------------------------------------------------------


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(SCALE a^2 / (l r)) in whole numbers of up to 38 digits."""
    wide = lambda c: c.cast("decimal(38,0)")
    over = (F.lit(SCALE).cast("decimal(38,0)") * wide(wide(a) * wide(a))).cast("decimal(38,0)")
    under = wide(wide(left) * wide(right))
    return F.call_function("div", over, under)


def _of(counts: DataFrame, names: list[str], as_: list[str], out: str) -> DataFrame:
    """Occurrences by (lang, words), the words named ``as_``."""
    return counts.select("lang", *[F.col(x).alias(y) for x, y in zip(names, as_, strict=True)], F.col("n").alias(out))


def mine(docs: DataFrame, least: int = 10, top: int = 2000, size: int = SHARD_WORDS) -> DataFrame:
    """The ``top`` phrases of each lang: lang, rank, phrase, a, l, r, n, score."""
    totals, one, two, three = counts(docs, least, size)
    n1, n2 = (lambda as_, out: _of(one, ["w1"], as_, out)), (lambda as_, out: _of(two, ["w1", "w2"], as_, out))
    pairs = two.withColumnRenamed("n", "a").join(n1(["w1"], "l"), ["lang", "w1"]).join(n1(["w2"], "r"), ["lang", "w2"])
    # Occurrences of the longer phrases that a pair lies in: its extensions.
    longer = three.select("lang", "w1", "w2", "n").unionByName(three.select("lang", F.col("w2").alias("w1"), F.col("w3").alias("w2"), "n"))
    most = longer.groupBy("lang", "w1", "w2").agg(F.max("n").alias("inside"))
    pairs = pairs.join(most, ["lang", "w1", "w2"], "left").where("inside is null or 100 * cast(inside as decimal(20,0)) < 50 * cast(a as decimal(20,0))")
    scored_pairs = pairs.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r", _score(F.col("a"), F.col("l"), F.col("r")).alias("score"))

    triples = three.withColumnRenamed("n", "a").join(n1(["w1"], "l1"), ["lang", "w1"]).join(n2(["w2", "w3"], "r1"), ["lang", "w2", "w3"])
    triples = triples.join(n2(["w1", "w2"], "l2"), ["lang", "w1", "w2"]).join(n1(["w3"], "r2"), ["lang", "w3"])
    cuts = triples.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", "l1", "r1", "l2", "r2", _score(F.col("a"), F.col("l1"), F.col("r1")).alias("s1"), _score(F.col("a"), F.col("l2"), F.col("r2")).alias("s2"))
    second = F.col("s2") < F.col("s1")
    pick = lambda x, y: F.when(second, F.col(y)).otherwise(F.col(x))
    scored = scored_pairs.unionByName(cuts.select("lang", "phrase", "a", pick("l1", "l2").alias("l"), pick("r1", "r2").alias("r"), pick("s1", "s2").alias("score")))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # The best of each share of a language's phrases, then of those.
    shares = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    scored = scored.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(shares)))
    some = scored.withColumn("place", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order))).where(F.col("place") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), F.col("score").cast("long").alias("score"))
