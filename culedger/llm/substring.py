"""Substring dedup by seed and extend (operator 7).

A repeat is a run of ``size`` words or more that an earlier document (one with
a smaller id) holds as well. Each word that lies in a repeat is removed;
repeats are judged on the input, not on what is left.

1. Seeds: of the hashes of all runs of ``size // 2`` words, winnowing keeps the
   least of every ``size - size // 2 + 1`` in a row, so any two texts that
   share ``size`` words share a kept seed inside them. Seeds that two documents
   or more hold are joined by hash.
2. Extension: around each shared seed the windows of ``size`` words that hold
   it are hashed, to the left and to the right as far as the threshold asks.
   The smallest document id of each window is an aggregate, so a passage that
   thousands of documents share makes a row for each, never a pair.
3. Windows that an earlier document holds merge into maximal repeats, and the
   text is put together again from the words outside.

Whole copies of an earlier document are found by one fingerprint first and
need no seeds. Words are compared by 64-bit hashes.

Nulls: a null text has no words; a null doc_id counts as larger than all.
Rows with the same id never remove words from each other. Extra columns are
not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from culedger.llm import arrays
from culedger.llm.common import materialize

LAST = 2**63 - 1


def _extreme(x: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` over every ``width`` consecutive values."""
    done, out = 1, x
    while done * 2 <= width:
        out = pick(out[:-done], out[done:])
        done *= 2
    rest = width - done
    return pick(out[: len(out) - rest], out[rest:]) if rest else out


def winnow(hashes: np.ndarray, first: np.ndarray, size: int) -> np.ndarray:
    """Positions of the kept seeds among the words of consecutive texts."""
    k = size // 2
    width = size - k + 1
    grams = arrays.windows(hashes, k)
    if len(grams) < width:
        return np.empty(0, np.int64)
    least = _extreme(grams, width, np.minimum)  # by window of ``size`` words
    inside = np.zeros(len(least), bool)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        inside[a : max(a, b - size + 1)] = True
    least[~inside] = 0
    pad = np.zeros(width - 1, np.uint64)
    return np.flatnonzero(_extreme(np.concatenate([pad, least, pad]), width, np.maximum) == grams)


def _texts(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    ident = F.col(doc_id).cast("long")
    return docs.select(ident.alias("doc_id"), F.xxhash64(ident, F.col(text)).alias("key"), F.col(text).cast("binary").alias("text"))


def seeds(texts: DataFrame, size: int) -> DataFrame:
    """Rows (ord, key, n, whole, seeds, at) for each document."""
    def run(batches):
        for b in batches:
            for i, j, data, offs in arrays.groups(b.column(2)):
                starts, ends, first = arrays.words(data, offs)
                hashes = arrays.hash_words(data, starts, ends)
                at = winnow(hashes, first, size)
                grams = arrays.windows(hashes, size // 2)[at].view(np.int64) if len(at) else at
                cut = np.searchsorted(at, first)
                whole = [int(arrays.windows(hashes[a:b], b - a).view(np.int64)[0]) if b > a else 0 for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
                lists = [pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(x, t)) for x, t in ((grams, pa.int64()), (at - np.repeat(first[:-1], np.diff(cut)), pa.int32()))]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i).fill_null(LAST), b.column(1).slice(i, j - i), pa.array(np.diff(first)), pa.array(whole, pa.int64()), *lists], ["ord", "key", "n", "whole", "seeds", "at"])

    return texts.select("doc_id", "key", "text").mapInArrow(run, "ord long, key long, n long, whole long, seeds array<long>, at array<int>")


def extend(texts: DataFrame, spots: DataFrame, size: int) -> DataFrame:
    """Rows (ord, key, starts, hashes): the windows around each document's
    shared seeds."""
    k = size // 2

    def run(batches):
        for b in batches:
            found = b.column(2).to_pylist()
            for i, j, data, offs in arrays.groups(b.column(3)):
                starts, ends, first = arrays.words(data, offs)
                grams = arrays.windows(arrays.hash_words(data, starts, ends), size)
                out = []
                for at, a, e in zip(found[i:j], first[:-1].tolist(), first[1:].tolist(), strict=True):
                    mark = np.zeros(max(0, e - a - size + 1) + 1, np.int64)
                    p = np.asarray(at, np.int64)
                    np.add.at(mark, np.clip(p - (size - k), 0, len(mark) - 1), 1)
                    np.add.at(mark, np.clip(p + 1, 0, len(mark) - 1), -1)
                    s = np.flatnonzero(np.cumsum(mark)[:-1] > 0)
                    out.append((s, grams[a + s].view(np.int64)))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), b.column(1).slice(i, j - i), pa.array([x for x, _ in out], pa.list_(pa.int32())), pa.array([x for _, x in out], pa.list_(pa.int64()))], ["ord", "key", "starts", "hashes"])

    rows = spots.join(texts.select("key", "text"), "key").dropDuplicates(["key"]).select("ord", "key", "at", "text")
    return rows.mapInArrow(run, "ord long, key long, starts array<int>, hashes array<long>")


def repeats(docs: DataFrame, size: int = 50, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Rows (key, whole, starts): the documents with repeats; ``whole``: every
    word goes, else the words under the windows at ``starts`` go."""
    texts = _texts(docs, text, doc_id)
    rows = materialize(seeds(texts, size), "seeds")
    first = rows.where(F.col("n") >= size).groupBy("whole", "n").agg(F.min("ord").alias("first"), F.min("key").alias("low"), F.max("key").alias("high"))
    copies = rows.join(first.where("low != high"), ["whole", "n"]).where("ord > first").select("key").distinct()
    copies = materialize(copies, "copies")
    own = rows.join(copies, "key", "left_anti").select("ord", "key", F.explode(F.arrays_zip("seeds", "at")).alias("s")).select("ord", "key", "s.seeds", "s.at")
    shared = own.groupBy("seeds").agg(F.min("key").alias("low"), F.max("key").alias("high")).where("low != high").select("seeds")
    spots = own.join(shared, "seeds").groupBy("key", "ord").agg(F.collect_list("at").alias("at"))
    found = materialize(extend(texts, spots, size), "windows")
    each = found.select("ord", "key", F.explode(F.arrays_zip("hashes", "starts")).alias("w")).select("ord", "key", F.col("w.hashes").alias("hash"), F.col("w.starts").alias("start"))
    earliest = each.groupBy("hash").agg(F.min("ord").alias("first"), F.max("ord").alias("last")).where("first < last").select("hash", "first")
    late = each.join(earliest, "hash").where("ord > first").groupBy("key").agg(F.sort_array(F.collect_list("start")).alias("starts"))
    return late.select("key", F.lit(False).alias("whole"), "starts").unionByName(copies.select("key", F.lit(True).alias("whole"), F.array().cast("array<int>").alias("starts")))


def clean(docs: DataFrame, size: int = 50, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Rows (doc_id, n_words, n_removed, removed, kept), one for each document:
    ``removed`` are the maximal repeats as [start, end) word ranges, ``kept``
    the words left, joined by one space."""
    found = materialize(repeats(docs, size, text, doc_id), "repeats")
    rows = _texts(docs, text, doc_id).join(found, "key", "left").select("doc_id", "text", "whole", "starts")

    def run(batches):
        schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("removed", pa.list_(pa.list_(pa.int32()))), ("kept", pa.string())])
        for b in batches:
            out, held = [], 0
            for ident, t, whole, starts in zip(*[b.column(k).to_pylist() for k in range(4)], strict=True):
                own = (t or b"").split()  # at the six ASCII blanks
                n, spans, kept = len(own), [], own
                if whole:
                    spans, kept = [[0, n]], []
                elif starts:
                    s = np.unique(np.asarray(starts))
                    head = np.flatnonzero(np.concatenate([[True], np.diff(s) > size]))
                    spans = [[int(s[x]), int(s[y - 1]) + size] for x, y in zip(head, [*head[1:], len(s)], strict=True)]
                    kept, at = [], 0
                    for x, y in spans:
                        kept += own[at:x]
                        at = y
                    kept += own[at:]
                out.append({"doc_id": ident, "n_words": n, "n_removed": n - len(kept), "removed": spans, "kept": b" ".join(kept).decode("utf-8", "replace")})
                held += len(t or b"")
                if held > arrays.GROUP_BYTES:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out, held = [], 0
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)

    return rows.mapInArrow(run, "doc_id long, n_words long, n_removed long, removed array<array<int>>, kept string")
