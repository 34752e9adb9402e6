"""SimHash near-duplicates through an index of byte positions (operator 12).

A document's fingerprint has a bit for each bit of its shingles' XXH64 (seed
42, the hash that Spark's ``xxhash64`` computes): 1 if set in over half of
them. Two fingerprints link when ``distance`` (3) or fewer of their 64 bits
differ. Such a pair differs in 3 of 8 bytes at most, so it shares 5 positional
bytes at least: that count is the filter, and only pairs that reach it are
verified bit by bit.

1. Texts become fingerprints; equal fingerprints become one, with the smallest
   of their doc_ids, by a partial aggregate, so copies never meet.
2. A list of the index for one byte at one position would hold 1/256 of all
   fingerprints. Lists are therefore intersected before pairs are tallied: of
   any 5 positions, 3 lie in the first or in the second half of the 8, so a
   linked pair meets in the list of one of the 8 triples of positions inside a
   half (``TRIPLES``).
3. In a list of up to ``limit`` fingerprints, shared positional bytes are
   tallied for pairs block by block, those with 5 or more are verified, and the
   list's links leave as one edge for each fingerprint to the smallest of its
   group: pairs are never written.
4. A longer list is dealt anew by two more positions (``FIVES``: a linked pair
   shares two of the other five as well). What shares five bytes differs in 24
   bits only, so such a list holds 2^24 fingerprints at most, whatever the
   input; where it is long, its links are found by probing the 2,324 values
   within ``distance`` bits of each in a table of 2^24 numbers.
5. Edges become components in Spark (``common.connected``).

Nulls: a null text, and a text without words, has the fingerprint zero, which
links like any other; a text of fewer words than ``size`` is one shingle. A
null doc_id is a document like others and never the smallest; where a component
has no other, its id is null. Repeated rows have equal fingerprints. Extra
columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from culedger.llm import arrays
from culedger.llm.common import UNEVEN_BLANKS, connected, materialize

#: Fixed value: the seed of Spark's xxhash64.
SEED = 42
#: Triples of byte positions (0 is the lowest byte) inside a half; of any 5
#: positions, 3 are one of them.
TRIPLES = [t for half in ((0, 1, 2, 3), (4, 5, 6, 7)) for t in combinations(half, 3)]
#: All sets of five positions.
FIVES = list(combinations(range(8), 5))
SHARED = 5
#: Fingerprints of a list of three bytes that are compared as they are.
LIMIT = 8192
#: Rows of a block of pairs.
ROWS = 512
#: From so many fingerprints on, a list of five bytes is probed.
PROBED = 4096


# Fingerprints ------------------------------------------------------------------


def _bits(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each run of hashes (``first``: where runs begin, one more than runs):
    the bits that are set in over half of it."""
    out = np.zeros(len(first) - 1, np.uint64)
    some = np.flatnonzero(first[1:] > first[:-1])
    if not len(some):
        return out
    set_ = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    counts = np.add.reduceat(set_, first[:-1][some], axis=0, dtype=np.int64)
    over = 2 * counts > (first[1:] - first[:-1])[some, None]
    out[some] = np.packbits(over, axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def fingerprint(size: int):
    """mapInArrow function: (rest..., text as folded words joined by one space)
    to (rest..., fingerprint as a signed number)."""

    def one(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        starts, ends, first = arrays.words(data, offs)
        raw, hashes, cuts = data.tobytes(), [], np.zeros(len(first), np.int64)
        # Runs of up to a few million hashes, so bits never pile up.
        out, done, held = [], 0, 0
        for k, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist(), strict=True)):
            n = max(1, b - a - size + 1) if b > a else 0
            last = min(b, a + size) - 1
            s, e = starts[a : a + n].tolist(), ends[last : last + n].tolist()
            hashes.extend([xxhash.xxh64_intdigest(raw[x:y], SEED) for x, y in zip(s, e, strict=True)])
            held += n
            cuts[k + 1] = held
            if held > 500_000:
                out.append(_bits(np.asarray(hashes, np.uint64), cuts[done : k + 2] - cuts[done]))
                hashes, done, held = [], k + 1, 0
                cuts[k + 1] = 0
        out.append(_bits(np.asarray(hashes, np.uint64), cuts[done:] - cuts[done]))
        return np.concatenate(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [one(data, offs) for _, _, data, offs in arrays.groups(b.column(b.num_columns - 1))]
            out = np.concatenate(found) if found else np.empty(0, np.uint64)
            columns = [*b.columns[:-1], pa.array(out.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, [*b.schema.names[:-1], "fingerprint"])

    return run


def fingerprints(docs: DataFrame, size: int = 3) -> DataFrame:
    """(doc_id, fingerprint) of each row of ``docs``."""
    text = F.translate(F.coalesce(F.col("text"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    even = F.trim(F.regexp_replace(text, UNEVEN_BLANKS, " "))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), even.cast("binary").alias("text"))
    return rows.mapInArrow(fingerprint(size), "doc_id long, fingerprint long")


# The index ----------------------------------------------------------------------


def _mask(positions: tuple[int, ...]) -> int:
    m = sum(0xFF << (8 * p) for p in positions)
    return m - (1 << 64) if m >> 63 else m


def _lists(families: list[tuple[int, ...]], value: Column) -> Column:
    """Postings of a fingerprint: (number of the set of positions, the bytes
    there)."""
    return F.array(*[F.struct(F.lit(i).alias("at"), value.bitwiseAND(F.lit(_mask(f))).alias("bytes")) for i, f in enumerate(families)])


def shared_bytes(x: np.ndarray) -> np.ndarray:
    """Positional bytes that two values share, by their exclusive or."""
    x = x | x >> np.uint64(4)
    x |= x >> np.uint64(2)
    x |= x >> np.uint64(1)
    return 8 - np.bitwise_count(x & np.uint64(0x0101010101010101)).astype(np.int64)


def _join(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Merge the groups of each pair of places; every place knows the smallest
    of its group before and after."""
    while True:
        a, b = root[i], root[j]
        apart = a != b
        if not apart.any():
            return
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root[:] = root[root]


def tallied(values: np.ndarray, distance: int) -> np.ndarray:
    """For each of the ascending ``values`` (uint64) the place of the smallest
    one in its linked group. Positional bytes are tallied for a block of rows at
    a time; pairs with ``SHARED`` or more are verified."""
    root = np.arange(len(values))
    for a in range(0, len(values), ROWS):
        x = values[a : a + ROWS, None] ^ values[None, a:]
        i, j = np.nonzero(shared_bytes(x) >= SHARED)
        near = np.bitwise_count(x[i, j]) <= distance
        _join(root, i[near] + a, j[near] + a)
    return root


def probed(values: np.ndarray, free: tuple[int, ...], distance: int) -> np.ndarray:
    """As :func:`tallied` for values that differ in the three bytes ``free``
    only: a table of 2^24 places is probed at each value within ``distance``
    bits."""
    own = sum((((values >> np.uint64(8 * p)) & np.uint64(255)) << np.uint64(8 * i)) for i, p in enumerate(free)).astype(np.int64)
    place = np.full(1 << 24, -1, np.int32)
    place[own] = np.arange(len(values), dtype=np.int32)
    root = np.arange(len(values))
    for k in range(1, distance + 1):
        for bits in combinations(range(24), k):
            other = place[own ^ sum(1 << b for b in bits)]
            met = np.flatnonzero(other >= 0)
            _join(root, met, other[met].astype(np.int64))
    return root


def _edges(families: list[tuple[int, ...]], distance: int, probe_from: int):
    """mapInArrow function over postings sorted by list: for each list, an edge
    from each linked fingerprint to the smallest of its group."""

    def links(at: int, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        values = np.sort(values.view(np.uint64))
        if len(values) >= probe_from:
            root = probed(values, tuple(p for p in range(8) if p not in families[at]), distance)
        else:
            root = tallied(values, distance)
        moved = root != np.arange(len(root))
        return values[moved].view(np.int64), values[root[moved]].view(np.int64)

    def batch(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found, strict=True)], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        key = None
        for b in batches:
            at, own, value = (b.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            if not len(at):
                continue
            cut = np.flatnonzero((at[1:] != at[:-1]) | (own[1:] != own[:-1])) + 1
            begin, end = np.append(0, cut), np.append(cut, len(at))
            # A list of one inside the batch has no pair.
            worth = end - begin > 1
            worth[[0, -1]] = True
            found = []
            for s, e in zip(begin[worth].tolist(), end[worth].tolist(), strict=True):
                if (at[s], own[s]) != key:
                    if sum(map(len, held)) > 1:
                        found.append(links(int(key[0]), np.concatenate(held)))
                    held, key = [], (at[s], own[s])
                held.append(value[s:e].copy())
            if found:
                yield batch(found)
        if sum(map(len, held)) > 1:
            yield batch([links(int(key[0]), np.concatenate(held))])

    return run


def edges(values: DataFrame, distance: int = 3, limit: int = LIMIT, probe_from: int = PROBED) -> DataFrame:
    """Edges (a, b) that connect what links connect, for distinct fingerprints
    (column ``fingerprint``)."""
    if not 0 <= distance <= 8 - SHARED:
        raise ValueError(f"distance must be 0 to {8 - SHARED}")
    posted = values.select("fingerprint", F.explode(_lists(TRIPLES, F.col("fingerprint"))).alias("p")).select("p.at", "p.bytes", "fingerprint")
    key = ["at", "bytes"]
    long = materialize(posted.groupBy(*key).count().where(F.col("count") > limit).select(*key), "simhash-long-lists")
    split = not long.isEmpty()
    some = posted.join(long, key, "left_anti") if split else posted
    found = some.repartition(*key).sortWithinPartitions(*key).mapInArrow(_edges(TRIPLES, distance, limit + 1), "a long, b long")
    if not split:
        return found
    # Long lists are dealt by two bytes more.
    whole = posted.join(long, key, "left_semi").select("at", "fingerprint").distinct()
    inside = F.array(*[F.array(*[F.lit(i) for i, five in enumerate(FIVES) if set(t) <= set(five)]) for t in TRIPLES])
    wanted = whole.select("fingerprint", F.explode(F.element_at(inside, F.col("at") + 1)).alias("at")).distinct()
    masks = F.array(*[F.lit(_mask(f)).cast("long") for f in FIVES])
    dealt = wanted.select("at", F.col("fingerprint").bitwiseAND(F.element_at(masks, F.col("at") + 1)).alias("bytes"), "fingerprint")
    more = dealt.repartition(*key).sortWithinPartitions(*key).mapInArrow(_edges(FIVES, distance, probe_from), "a long, b long")
    return found.unionByName(more)


def near_duplicates(docs: DataFrame, size: int = 3, distance: int = 3, limit: int = LIMIT, probe_from: int = PROBED) -> DataFrame:
    """Each row of ``docs``: doc_id, fingerprint (16 hexadecimal digits) and
    component_id, the smallest doc_id that links reach."""
    marked = materialize(fingerprints(docs, size), "simhash-marks")
    values = materialize(marked.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "simhash-values")
    roots = connected(edges(values, distance, limit, probe_from), "simhash-components")
    rooted = values.join(roots, F.col("fingerprint") == F.col("node"), "left").select("fingerprint", "least", F.coalesce("root", "fingerprint").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of = rooted.join(least, "root").select("fingerprint", "component_id")
    shown = F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("shown")
    out = marked.join(of, "fingerprint").select("doc_id", shown, "component_id")
    return out.withColumnRenamed("shown", "fingerprint")
