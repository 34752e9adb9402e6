"""N-gram Jaccard join by signature trees (operator 2).

A document's set holds the 64-bit hashes of its distinct shingles. Documents
with equal sets form a class; only classes are joined.

1. A sketch of fixed size counts all shingles (an upper bound for each), which
   gives one order, rare shingles first, for the whole corpus.
2. Two sets that reach the threshold share a shingle among the first
   ``n - ceil(share * n) + 1`` of each, so classes meet in a block for each
   such shingle that two or more classes have.
3. A block's members form a signature tree: each node holds the union (and
   intersection) of its members' token bitmaps and their range of sizes. The
   tree is traversed against itself; a pair of nodes is dropped if the largest
   overlap that it allows is too small. A large set would fill its bitmap, so
   its bitmap is of a sample: the tokens whose hash is 0 modulo a power of 4,
   512 or more of them. Two samples that differ in over ``limit(share)`` of their
   tokens are not of one candidate pair (a pair at the threshold is lost with
   a chance of at most ``LOSS``, 1e-15, at every share). What is left joins members to
   candidate groups.
4. The members of each candidate group come together with their whole sets; a
   second traversal verifies pairs exactly, but for pairs that earlier links
   already connect.

Blocks of more than ``chunk`` members, and groups of more than ``GROUP_TOKENS``
shingles, are cut into chunks, and each pair of chunks is a block of its own,
so no task holds more than two chunks and no pair is missed. Every link is
decided by the exact sizes of the sets' overlap and union.

Nulls: a null text has no shingles and is linked with nothing; a null doc_id
is a document whose component is that of its class, and never the smallest.
Repeated rows are documents of the same class. Extra columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from culedger.llm import arrays
from culedger.llm.common import connected, materialize, row_keys

#: Counters of the sketch, and the stripes that they are summed in.
SKETCH_BITS, STRIPES = 18, 64
#: Bits of a class's token bitmap.
BITMAP = 2048
#: Sets of up to so many tokens go into their bitmap whole.
WHOLE = 2048
#: Of the larger sample, how much two samples may differ at least, and the
#: chance that a pair at the threshold differs by more.
DIFFER, LOSS = 0.36, 1e-15
#: Shingles of a candidate group that are verified at once, at most twice.
GROUP_TOKENS = 2_000_000
SIGNATURE = ("level", "drawn", "bitmap", "drawn2", "bitmap2")
#: Words of bitmaps that are compared at once.
PAIR_WORDS = 1 << 18
#: Children of a node of the tree.
FAN = 16


def shingle_sets(data: np.ndarray, offs: np.ndarray, size: int, fold: bool) -> list[np.ndarray]:
    """The ascending distinct shingle hashes of each text."""
    starts, ends, first = arrays.words(data, offs)
    hashes = arrays.hash_words(data, starts, ends, fold)
    grams = arrays.windows(hashes, size)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= size:
            own = grams[a : b - size + 1]
            out.append(np.unique(own))
        elif b > a:
            out.append(arrays.windows(hashes[a:b], b - a) ^ np.uint64(b - a))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def _class_id(s: np.ndarray) -> int:
    """A 64-bit fingerprint of a set, as a signed number."""
    with np.errstate(over="ignore"):
        total = arrays.mix(s).sum(dtype=np.uint64) + np.uint64(len(s)) * np.uint64(arrays.BASE)
    return int(arrays.mix(np.asarray([total], np.uint64)).view(np.int64)[0])


def sketch(docs: DataFrame, size: int, fold: bool, text: str = "text") -> np.ndarray:
    """Counts of all shingles by the top bits of their hash: an array of fixed
    size, summed in Spark."""
    width = 1 << (SKETCH_BITS - 6)

    def count(batches):
        total = np.zeros(1 << SKETCH_BITS, np.int64)
        for b in batches:
            for _, _, data, offs in arrays.groups(b.column(0)):
                starts, ends, _ = arrays.words(data, offs)
                grams = arrays.windows(arrays.hash_words(data, starts, ends, fold), size)
                total += np.bincount((grams >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=len(total))
                del data, offs, starts, ends, grams
            del b
            arrays.give_back()
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array(range(STRIPES), pa.int32()), pa.array([x.tobytes() for x in total.reshape(STRIPES, width)], pa.binary())], ["stripe", "counts"])

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, np.int64) for x in table.column("counts").to_pylist())
        return pa.table({"stripe": table.column("stripe")[:1], "counts": pa.array([total.tobytes()], pa.binary())})

    parts = docs.select(F.col(text).cast("binary")).mapInArrow(count, "stripe int, counts binary")
    out = np.zeros((STRIPES, width), np.int64)
    for r in parts.groupBy("stripe").applyInArrow(add, "stripe int, counts binary").collect():
        out[r["stripe"]] = np.frombuffer(bytes(r["counts"]), np.int64)
    return out.ravel()


def _ceil(share: int, n):
    return -((-share * n) // 100)


class _Tree:
    """Levels of nodes over members in order; level 0 are the members."""

    def __init__(self, some: np.ndarray, every: np.ndarray, sizes: np.ndarray, share: int):
        self.share = share
        low, high = sizes, sizes
        slack = sizes - np.bitwise_count(every).sum(axis=1, dtype=np.int64)
        self.levels = [(some, every, low, high, slack)]
        while len(low) > FAN:
            cut = np.arange(0, len(low), FAN)
            some, every = np.bitwise_or.reduceat(some, cut, axis=0), np.bitwise_and.reduceat(every, cut, axis=0)
            low, high, slack = np.minimum.reduceat(low, cut), np.maximum.reduceat(high, cut), np.maximum.reduceat(slack, cut)
            self.levels.append((some, every, low, high, slack))

    def alive(self, level: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether the nodes' members may reach the threshold; a bounded number
        of bitmap words are compared at once."""
        step = max(1, PAIR_WORDS // self.levels[level][0].shape[1])
        if len(i) > step:
            return np.concatenate([self.alive(level, i[k : k + step], j[k : k + step]) for k in range(0, len(i), step)])
        some, every, low, high, slack = self.levels[level]
        fits = (100 * high[i] >= self.share * low[j]) & (100 * high[j] >= self.share * low[i])
        i, j = i[fits], j[fits]
        least = -((-self.share * (low[i] + low[j])) // (100 + self.share))  # 100 o >= share (a + b - o)
        common = np.bitwise_count(some[i] & some[j]).sum(axis=1, dtype=np.int64) + np.minimum(slack[i], slack[j])
        left = high[i] - np.bitwise_count(every[i] & ~some[j]).sum(axis=1, dtype=np.int64)
        right = high[j] - np.bitwise_count(every[j] & ~some[i]).sum(axis=1, dtype=np.int64)
        fits[fits] = (common >= least) & (left >= least) & (right >= least)
        return fits

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """The pairs of leaf nodes (level 1, or members of a small block) that
        the dual traversal leaves, i <= j."""
        level = len(self.levels) - 1
        i, j = np.triu_indices(len(self.levels[level][2]))
        while True:
            keep = self.alive(level, i, j) | (i == j)
            i, j = i[keep], j[keep]
            if level <= 1:
                return i, j
            level -= 1
            n = len(self.levels[level][2])
            step = np.arange(FAN)
            a = (i[:, None, None] * FAN + step[None, :, None] + 0 * step[None, None, :]).ravel()
            b = (j[:, None, None] * FAN + step[None, None, :] + 0 * step[None, :, None]).ravel()
            ok = (a < n) & (b < n) & (a <= b)
            i, j = a[ok], b[ok]


def groups_of(bits: np.ndarray, sizes: np.ndarray, share: int, verify=None, sampled: np.ndarray | None = None) -> np.ndarray:
    """For each member the first member of its group: members connected by
    pairs that the bitmaps allow and, if given, ``verify(i, js)`` confirms.
    Every member is compared with all that it isn't connected to yet. Bitmaps
    of members that are ``sampled`` bound nothing and are for ``verify``."""
    n = len(sizes)
    every = bits
    if sampled is not None and sampled.any():
        bits, every = bits.copy(), bits.copy()
        bits[sampled], every[sampled] = ~np.uint64(0), 0
    tree = _Tree(bits, every, sizes, share)
    root = np.full(n, -1, np.int64)
    if len(tree.levels) > 1:
        a, b = tree.pairs()
        both = np.concatenate([a, b]), np.concatenate([b, a])
        order = np.argsort(both[0], kind="stable")
        near, cut = both[1][order], np.searchsorted(both[0][order], np.arange(len(tree.levels[1][2]) + 1))
    left = n
    for seed in range(n):
        if root[seed] >= 0:
            continue
        root[seed] = seed
        left -= 1
        queue = [seed]
        while queue and left:
            i = queue.pop()
            if len(tree.levels) > 1:
                nodes = np.unique(near[cut[i // FAN] : cut[i // FAN + 1]])
                js = (nodes[:, None] * FAN + np.arange(FAN)).ravel()
                js = js[js < n]
                js = js[root[js] < 0]
            else:
                js = np.flatnonzero(root < 0)
            if not len(js):
                continue
            js = js[tree.alive(0, np.full(len(js), i), js)]
            if verify is not None and len(js):
                js = js[verify(i, js)]
            root[js] = seed
            left -= len(js)
            queue += js.tolist()
    return root


def _bitmap(s: np.ndarray, bits: int = BITMAP) -> np.ndarray:
    out = np.zeros(bits // 64, np.uint64)
    at = s & np.uint64(bits - 1)
    np.bitwise_or.at(out, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
    return out


def _level(n: int) -> int:
    """The power of 4 that a set of n tokens is sampled by."""
    level = 0
    while n >> 2 * level > WHOLE:
        level += 1
    return level


def _sample(s: np.ndarray, level: int) -> np.ndarray:
    return s[(s >> np.uint64(40)) & np.uint64(4**level - 1) == 0] if level else s


def _signatures(s: np.ndarray, share: int) -> dict:
    """A set's bitmap, and the one that sets of the next level compare it by
    if such sets may be within reach."""
    n, level = len(s), _level(len(s))
    own = _sample(s, level)
    out = {"level": level, "drawn": len(own), "bitmap": _bitmap(own).tobytes(), "drawn2": None, "bitmap2": None}
    if 100 * n >= share * (WHOLE << 2 * level):
        up = _sample(s, level + 1)
        out |= {"drawn2": len(up), "bitmap2": _bitmap(up).tobytes()}
    return out


def limit(share: int) -> float:
    """How much of the larger sample two samples may differ.

    A pair at the threshold has m tokens of its union in the sample, m being of
    mean WHOLE / 4 or more, and each differs with chance q = 1 - share. Over a
    share x of the m differ with a chance of exp(-m KL(x, q)) at most, which
    over all m is exp(-WHOLE / 4 (1 - exp(-KL))). The larger sample has m (1 -
    x / 2) tokens or more. Infinite, so that nothing is dropped, where no x
    reaches LOSS."""
    q, asked = 1 - share / 100, 1 + 4 * math.log(LOSS) / WHOLE
    if q <= 0:
        return DIFFER
    if q >= asked:
        return math.inf

    def enough(x: float) -> bool:
        return x * math.log(x / q) + (1 - x) * math.log((1 - x) / (1 - q)) >= -math.log(asked)

    low, high = q, 1.0
    for _ in range(50):
        x = (low + high) / 2
        low, high = (low, x) if x == 1 or enough(x) else (x, high)
    return max(DIFFER, 2 * high / (2 - high))


def _alike(level: np.ndarray, drawn: np.ndarray, bits: np.ndarray, drawn2: np.ndarray, bits2: np.ndarray, share: int):
    """For ``groups_of``: which of the members js may be linked to i, by their
    samples. Members without a sample in common stay."""
    most = limit(share)

    def alike(i, js):
        top = np.maximum(level[i], level[js])
        out = np.ones(len(js), bool)
        for up in range(2):  # whether i is compared by its next level
            with_ = np.flatnonzero((top == level[i] + up) & (top > 0))
            if not len(with_):
                continue
            j = js[with_]
            down = level[j] < top[with_]
            a, na = (bits2[i], drawn2[i]) if up else (bits[i], drawn[i])
            b, nb = np.where(down[:, None], bits2[j], bits[j]), np.where(down, drawn2[j], drawn[j])
            known = (na >= 0) & (nb >= 0)
            differ = np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64)
            out[with_] = ~known | (differ <= most * np.maximum(na, nb))
        return out

    return alike


def _runs(batches, keys: int):
    """(table, [(start, end), ...]): the whole blocks among batches that are
    sorted by the first ``keys`` columns. A block is two chunks at most."""
    rest = None
    for b in batches:
        t = pa.Table.from_batches([b])
        t = t if rest is None else pa.concat_tables([rest, t]).combine_chunks()
        if not t.num_rows:
            continue
        change = np.zeros(t.num_rows, bool)
        for k in range(keys):
            c = np.asarray(t.column(k))
            change[1:] |= c[1:] != c[:-1]
        at = [0, *np.flatnonzero(change).tolist()]
        yield t, list(zip(at[:-1], at[1:], strict=True))
        rest = t.slice(at[-1])
    if rest is not None:
        yield rest, [(0, rest.num_rows)]


def _chunked(rows: DataFrame, member: str, chunk: int) -> DataFrame:
    """``rows`` with columns c1, c2: a block for each pair of chunks of a key
    that is larger than ``chunk`` (column m), else the block (0, 0)."""
    parts = F.when(F.col("m") > chunk, F.ceil(F.col("m") / chunk)).otherwise(1).cast("int")
    own = rows.withColumn("parts", parts).withColumn("c", F.pmod(F.xxhash64(F.col(member), F.lit(5)), F.col("parts")).cast("int"))
    out = own.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return out.withColumn("c1", F.least("c", "o")).withColumn("c2", F.greatest("c", "o")).drop("parts", "c", "o", "m")


def _keyed(docs: DataFrame, doc_id: str, text: str) -> list:
    """The columns key and key2, which tell rows apart by id and text."""
    return [c.alias(n) for c, n in zip(row_keys(F.col(doc_id).cast("long"), F.col(text)), ("key", "key2"), strict=True)]


def classes(docs: DataFrame, size: int, share: int, fold: bool, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Rows (doc_id, key, key2, class, n, prefix, and the signature) for each document;
    class is null for a document without shingles. Written to the shared
    folder."""
    shared = docs.sparkSession.sparkContext.broadcast(sketch(docs, size, fold, text))

    def run(batches):
        schema = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("key2", pa.int64()), ("class", pa.int64()), ("n", pa.int64()), ("prefix", pa.list_(pa.int64())), ("level", pa.int32()), ("drawn", pa.int32()), ("bitmap", pa.binary()), ("drawn2", pa.int32()), ("bitmap2", pa.binary())])
        counts = shared.value
        for b in batches:
            for i, j, data, offs in arrays.groups(b.column(3)):
                ids, ns, prefixes, maps = [], [], [], []
                for s in shingle_sets(data, offs, size, fold):
                    n = len(s)
                    p = n - _ceil(share, n) + 1 if n else 0
                    rank = counts[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                    head = s[np.lexsort((s, rank))[:p]]
                    ids.append(_class_id(s) if n else None)
                    ns.append(n)
                    prefixes.append(head.view(np.int64))
                    maps.append(_signatures(s, share) if n else {})
                yield pa.RecordBatch.from_arrays([*[b.column(k).slice(i, j - i) for k in range(3)], pa.array(ids, pa.int64()), pa.array(ns, pa.int64()), pa.array(prefixes, pa.list_(pa.int64())), *[pa.array([m.get(x) for m in maps], schema.field(x).type) for x in SIGNATURE]], schema=schema)
                del data, offs, prefixes, maps
            del b
            arrays.give_back()

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), *_keyed(docs, doc_id, text), F.col(text).cast("binary").alias("text"))
    return materialize(rows.mapInArrow(run, "doc_id long, key long, key2 long, class long, n long, prefix array<long>, level int, drawn int, bitmap binary, drawn2 int, bitmap2 binary"), "sets")


def candidates(reps: DataFrame, share: int, chunk: int) -> DataFrame:
    """Edges (a, b) between classes that a signature tree could not tell
    apart: within each block, every member to the first of its group."""
    def run(batches):
        done = set()
        for t, at in _runs(batches, 3):
            cls, n = np.asarray(t.column("class")), np.asarray(t.column("n"))
            blank = bytes(BITMAP // 8)
            maps, maps2 = (np.frombuffer(b"".join(x or blank for x in t.column(k).to_pylist()), np.uint64).reshape(len(n), -1) for k in ("bitmap", "bitmap2"))
            level, drawn = np.asarray(t.column("level")), np.asarray(t.column("drawn"))
            drawn2 = np.asarray(t.column("drawn2").combine_chunks().fill_null(-1) if isinstance(t.column("drawn2"), pa.ChunkedArray) else t.column("drawn2").fill_null(-1))
            a, b = [], []
            for x, y in at:
                if y - x < 2:
                    continue
                order = x + np.lexsort((*maps[x:y, :2].T, n[x:y]))
                alike = _alike(level[order], drawn[order], maps[order], drawn2[order], maps2[order], share)
                root = groups_of(maps[order], n[order], share, alike, level[order] > 0)
                moved = np.flatnonzero(root != np.arange(y - x))
                a += cls[order][moved].tolist()
                b += cls[order][root[moved]].tolist()
            new = [e for e in zip(a, b, strict=True) if e not in done]
            if len(done) < 200_000:
                done.update(new)
            if new:
                yield pa.RecordBatch.from_arrays([pa.array([e[0] for e in new], pa.int64()), pa.array([e[1] for e in new], pa.int64())], ["a", "b"])
            del t, maps, maps2
            arrays.give_back()

    tokens = reps.select("class", "n", F.explode("prefix").alias("token"))
    shared = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    rows = _chunked(tokens.join(shared, "token"), "class", chunk)
    rows = rows.join(reps.select("class", *SIGNATURE), "class").select("token", "c1", "c2", "class", "n", *SIGNATURE)
    rows = rows.repartition("token", "c1", "c2").sortWithinPartitions("token", "c1", "c2")
    return rows.mapInArrow(run, "a long, b long").distinct()


def verified(docs: DataFrame, reps: DataFrame, groups: DataFrame, size: int, share: int, fold: bool, tokens: int, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Edges (a, b) between classes of a candidate group, decided by the whole
    sets: every class to the first that it is connected to in its block."""
    def run(batches):
        for t, at in _runs(batches, 3):
            cls = np.asarray(t.column("class"))
            a, b = [], []
            for x, y in at:
                if y - x < 2:
                    continue
                _, only = np.unique(cls[x:y], return_index=True)
                own = [np.frombuffer(s, np.uint64) for s in t.column("hashes").slice(x, y - x).take(pa.array(only)).to_pylist()]
                n = np.array([len(s) for s in own])
                order = np.argsort(n, kind="stable")
                own, n = [own[k] for k in order], n[order]

                def verify(i, js, own=own, n=n):
                    out = np.zeros(len(js), bool)
                    for k in range(0, len(js), 256):  # a bounded number of sets at once
                        part = js[k : k + 256]
                        flat = np.concatenate([own[j] for j in part])
                        hit = own[i][np.minimum(np.searchsorted(own[i], flat), len(own[i]) - 1)] == flat
                        both = np.add.reduceat(hit, np.concatenate([[0], np.cumsum(n[part])[:-1]]), dtype=np.int64)
                        out[k : k + 256] = 100 * both >= share * (n[i] + n[part] - both)
                    return out

                width = max(BITMAP, 1 << min(17, int(4 * n[-1]).bit_length()))
                root = groups_of(np.array([_bitmap(s, width) for s in own]), n, share, verify)
                moved = np.flatnonzero(root != np.arange(len(root)))
                names = cls[x:y][only][order]
                a += names[moved].tolist()
                b += names[root[moved]].tolist()
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
            del t
            arrays.give_back()

    members = groups.withColumnRenamed("node", "class").join(reps.select("class", "rep", "n"), "class")
    many = members.groupBy("root").agg(F.sum("n").alias("m"))
    rows = _chunked(members.join(many, "root"), "class", tokens)
    rows = rows.groupBy("class", "rep").agg(F.collect_list(F.struct("root", "c1", "c2")).alias("blocks")).select("class", "blocks", "rep.key", "rep.key2")
    # One of the rows that repeat an id and a text; the rest goes before it moves.
    once = Window.partitionBy("key", "key2").orderBy("key")
    texts = docs.select(*_keyed(docs, doc_id, text), F.col(text).cast("binary").alias("text")).withColumn("copy", F.row_number().over(once)).where("copy = 1")
    plain = rows.join(texts, ["key", "key2"]).select("class", "blocks", "text")

    def hashed(batches):
        schema = pa.schema([("root", pa.int64()), ("c1", pa.int32()), ("c2", pa.int32()), ("class", pa.int64()), ("hashes", pa.binary())])
        for b in batches:
            for i, j, data, offs in arrays.groups(b.column(2)):
                part = b.slice(i, j - i)
                out, held = [], 0
                for c, blocks, s in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), shingle_sets(data, offs, size, fold), strict=True):
                    for x in blocks:
                        out.append({**x, "class": c, "hashes": s.tobytes()})
                        held += s.nbytes
                        if held > arrays.GROUP_BYTES:
                            yield pa.RecordBatch.from_pylist(out, schema)
                            out, held = [], 0
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema)
                del data, offs, part, out
            del b
            arrays.give_back()

    out = plain.mapInArrow(hashed, "root long, c1 int, c2 int, class long, hashes binary")
    out = out.repartition("root", "c1", "c2").sortWithinPartitions("root", "c1", "c2")
    return out.mapInArrow(run, "a long, b long").distinct()


def components(docs: DataFrame, size: int, share: int, fold: bool, chunk: int, text: str, doc_id: str) -> DataFrame:
    """Rows (doc_id, key, key2, n_shingles, root) for each document; equal roots are
    one component, and a null root is a document without shingles."""
    rows = classes(docs, size, share, fold, text, doc_id)
    named = rows.where("class is not null")
    reps = materialize(named.groupBy("class").agg(F.min(F.struct("doc_id", "key", "key2")).alias("rep"), *[F.first(x).alias(x) for x in ("n", "prefix", *SIGNATURE)]), "classes")
    groups = connected(candidates(reps, share, chunk), "candidates")
    links = connected(verified(docs, reps, groups, size, share, fold, GROUP_TOKENS * chunk // 2048, text, doc_id), "links")
    out = rows.select("doc_id", "key", "key2", "class", F.col("n").alias("n_shingles")).join(links, F.col("class") == F.col("node"), "left")
    return out.select("doc_id", "key", "key2", "n_shingles", F.coalesce("root", "class").alias("root"))


def join(docs: DataFrame, size: int = 4, share: int = 85, fold: bool = True, chunk: int = 2048, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Rows (doc_id, n_shingles, component_id), one for each document: two
    documents link when 100 * overlap >= share * union of their sets of
    ``size``-word shingles (``fold``: A-Z count as a-z); component_id is the
    smallest doc_id that links reach."""
    rows = materialize(components(docs, size, share, fold, chunk, text, doc_id), "joined")
    smallest = rows.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    out = rows.join(smallest, "root", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, size: int = 4, share: int = 85, fold: bool = True, chunk: int = 2048, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One document of each component: the one with the smallest id, null ids
    last. Documents without shingles all stay."""
    rows = materialize(components(docs, size, share, fold, chunk, text, doc_id), "joined")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key", "key2")).alias("first")
    both = ["key", "key2"]
    kept = rows.where("root is not null").groupBy("root").agg(first).select("first.key", "first.key2", F.lit(True).alias("once"))
    kept = kept.unionByName(rows.where("root is null").select(*both, F.lit(False).alias("once")).distinct())
    own = [f"c{i}" for i in range(len(docs.columns))]  # the input may use any name
    at = dict(zip(docs.columns, own, strict=True))
    wide = docs.toDF(*own)
    keyed = wide.select(*own, *_keyed(wide, at[doc_id], at[text])).join(kept, both)
    once = keyed.where("once").dropDuplicates(both)
    return once.unionByName(keyed.where("not once")).select(own).toDF(*docs.columns)
