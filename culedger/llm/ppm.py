"""Language-model scoring by partial matching (operator 8).

The model is a trie of byte contexts up to order 3 over the training texts:
each text is read as its UTF-8 bytes and an end symbol, after three start
symbols that are never predicted. A symbol that a context hasn't seen escapes
to the context one byte shorter (escape count: distinct symbols seen, method
C), and symbols of the longer context are excluded there; below order 0 the
symbols left are equally likely.

A longer context's symbols are all symbols of the shorter one as well, so what
is excluded depends on the longer context alone, and the code length of a
4-gram follows from a few sums over the counts. Spark holds the trie as tables
of counts, one for each order, and joins them to a table (gram, log10 p).

Texts are dealt into blocks of about ``block_bytes``. A block sends up the
counts of its own grams and words and gets back the values of just those, so
neither the trie nor the vocabulary is ever broadcast or held whole.

Beside it a unigram model of lower-case words with added halves is scored.
Words and counts are exact up to 64-bit hashes of words.

Nulls: a null text is an empty one (its end symbol is scored); a null doc_id
belongs to the training rows. Repeated rows are scored and learnt each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from culedger.llm import arrays
from culedger.llm.common import materialize

ORDER = 3
#: Bytes that UTF-8 never uses stand for a text's start and end.
START, END = 0xFE, 0xFF
#: Symbols that can be predicted: 256 byte values and the end.
ALPHABET = 257
WORD_KIND, GRAM_KIND = 0, 1
#: The end of a text, as a word.
END_WORD = np.uint64(0x656E646F66746578)


def grams(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The 4-grams of texts in order, and the number of grams before each."""
    n = len(offs) - 1
    wide = ORDER + 1
    s = np.empty(len(data) + wide * n, np.uint32)
    at = offs[:-1] + wide * np.arange(n)
    body = np.ones(len(s), bool)
    for k in range(ORDER):
        s[at + k], body[at + k] = START, False
    last = offs[1:] + wide * np.arange(1, n + 1) - 1
    s[last], body[last] = END, False
    s[body] = data
    out = s[ORDER:].copy()
    for k in range(1, wide):
        out |= s[ORDER - k : len(s) - k] << np.uint32(8 * k)
    body[last] = True
    return out[body[ORDER:]], offs + np.arange(n + 1)


def blocks(docs: DataFrame, block_bytes: int, text: str, doc_id: str) -> DataFrame:
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    count = max(1, -(-int(total) // block_bytes))
    ident = F.col(doc_id).cast("long")
    held = F.coalesce(F.crc32(ident.cast("string").cast("binary")) % 5 == 1, F.lit(False))
    return docs.select(F.pmod(F.xxhash64(ident, F.col(text)), F.lit(count)).cast("int").alias("block"), ident.alias("doc_id"), held.alias("held_out"), F.col(text).cast("binary").alias("text"))


def _counted(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(np.concatenate(parts) if parts else np.empty(0, np.uint64), return_counts=True)


def _words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of texts, each text closed by its end, and the
    number of words before each text."""
    starts, ends, first = arrays.words(data, offs)
    hashes = arrays.hash_words(data, starts, ends, fold=True)
    return np.insert(hashes, first[1:], END_WORD), first + np.arange(len(first))


def counts(rows: DataFrame) -> DataFrame:
    """Rows (block, kind, item, n): each block's words and grams with their
    counts in training texts, 0 for those of other texts only."""
    def run(table: pa.Table) -> pa.Table:
        found = {WORD_KIND: {}, GRAM_KIND: {}}
        held = np.asarray(table.column("held_out").combine_chunks())
        for i, j, data, offs in arrays.groups(table.column("text").combine_chunks()):
            for kind, (items, first) in ((WORD_KIND, _words(data, offs)), (GRAM_KIND, grams(data, offs))):
                learnt = np.repeat(~held[i:j], np.diff(first))
                for flag in (True, False):
                    part = items[learnt == flag]
                    if len(part):
                        found[kind].setdefault(flag, []).append(np.unique(part, return_counts=True))
        out = []
        for kind, by_flag in found.items():
            items = [x for parts in by_flag.values() for x, _ in parts]
            if not items:
                continue
            n = np.concatenate([c * flag for flag, parts in by_flag.items() for _, c in parts])
            names, at = np.unique(np.concatenate(items), return_inverse=True)
            out.append(pa.table({"block": pa.array(np.full(len(names), table.column("block")[0].as_py()), pa.int32()), "kind": pa.array(np.full(len(names), kind), pa.int32()), "item": names.astype(np.uint64).view(np.int64), "n": np.bincount(at, n, len(names)).astype(np.int64)}))
        return pa.concat_tables(out)

    return rows.groupBy("block").applyInArrow(run, "block int, kind int, item long, n long")


def code_lengths(counted: DataFrame) -> DataFrame:
    """(item, value): log10 of the probability of each 4-gram's last symbol
    after its first three, from rows (item, c) with training counts c."""
    def tail(k: int) -> int:
        return (1 << 8 * (k + 1)) - 1

    levels = {ORDER: counted.where("c > 0").select(F.col("item").alias("g"), "c")}
    for k in range(ORDER - 1, -1, -1):
        levels[k] = levels[k + 1].groupBy(F.col("g").bitwiseAND(tail(k)).alias("g")).agg(F.sum("c").alias("c"))
    levels = {k: materialize(x, f"order{k}") for k, x in levels.items()}
    out = counted.select("item")
    for k in range(ORDER, -1, -1):
        level = levels[k].select("g", "c", F.shiftright("g", 8).alias("ctx"))
        own = level.groupBy("ctx").agg(F.sum("c").alias(f"n{k}"), F.count(F.lit(1)).alias(f"t{k}"))
        if k:
            shorter = levels[k - 1].select(F.col("g").alias("sg"), F.col("c").alias("sc"))
            hidden = level.join(shorter, F.col("g").bitwiseAND(tail(k - 1)) == F.col("sg")).groupBy("ctx").agg(F.sum("sc").alias(f"x{k}"))
            own = own.join(hidden, "ctx")
        own = own.withColumnRenamed("ctx", f"ctx{k}")
        gram = F.col("item").bitwiseAND(tail(k))
        out = out.join(level.select(F.col("g").alias(f"g{k}"), F.col("c").alias(f"c{k}")), gram == F.col(f"g{k}"), "left")
        out = out.join(own, F.shiftright(gram, 8) == F.col(f"ctx{k}"), "left")
    return out.select("item", _value(ORDER).alias("value"))


def _value(k: int) -> Column:
    """log10 p at order k and below, for a symbol that no longer context has."""
    zero = F.lit(0).cast("long")
    if k < 0:
        return -F.log10(F.lit(float(ALPHABET)) - F.coalesce(F.col("t0"), zero))
    hidden = F.coalesce(F.col(f"x{k + 1}"), zero) if k < ORDER else zero
    gone = F.coalesce(F.col(f"t{k + 1}"), zero) if k < ORDER else zero
    left = F.col(f"t{k}") - gone
    whole = (F.col(f"n{k}") - hidden + left).cast("double")
    escape = F.when(F.col(f"n{k}").isNull() | (left <= 0), F.lit(0.0)).otherwise(F.log10(left / whole))
    return F.when(F.col(f"c{k}").isNotNull(), F.log10(F.col(f"c{k}") / whole)).otherwise(escape + _value(k - 1))


def score(docs: DataFrame, block_bytes: int = 16 << 20, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Rows (doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score, n_bytes), one for each document."""
    rows = blocks(docs, block_bytes, text, doc_id)
    counted = materialize(counts(rows), "counts")
    of = {k: counted.where(F.col("kind") == k) for k in (WORD_KIND, GRAM_KIND)}
    words = materialize(of[WORD_KIND].groupBy("item").agg(F.sum("n").alias("c")), "words")
    size, kinds = words.where("c > 0").agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    size, kinds = int(size), int(kinds)
    known = words.select("item", F.log10((F.col("c") + 0.5) / F.lit(size + 0.5 * (kinds + 1))).alias("value"), (F.col("c") > 0).alias("known"))
    lengths = materialize(code_lengths(of[GRAM_KIND].groupBy("item").agg(F.sum("n").alias("c"))), "lengths")
    values = of[WORD_KIND].select("block", "kind", "item").join(known, "item").unionByName(of[GRAM_KIND].select("block", "kind", "item").join(lengths.withColumn("known", F.lit(True)), "item"))
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, n_bytes long"

    def run(texts: pa.Table, values: pa.Table) -> pa.Table:
        table = {}
        kind = np.asarray(values.column("kind"))
        for k in (WORD_KIND, GRAM_KIND):
            own = values.filter(pa.array(kind == k))
            item = np.asarray(own.column("item")).view(np.uint64)
            order = np.argsort(item)
            table[k] = item[order].astype(np.uint64 if k == WORD_KIND else np.uint32), np.asarray(own.column("value"))[order], np.asarray(own.column("known"))[order]
        out = []
        for i, j, data, offs in arrays.groups(texts.column("text").combine_chunks()):
            part = texts.slice(i, j - i)
            items, first = _words(data, offs)
            at = np.searchsorted(table[WORD_KIND][0], items)
            base = np.add.reduceat(table[WORD_KIND][1][at], first[:-1])
            n_known = np.add.reduceat(table[WORD_KIND][2][at], first[:-1], dtype=np.int64)
            items, begin = grams(data, offs)
            at = np.searchsorted(table[GRAM_KIND][0], items)
            total = np.add.reduceat(table[GRAM_KIND][1][at], begin[:-1])
            out.append(pa.table({"doc_id": part.column("doc_id"), "held_out": part.column("held_out"), "n_tokens": np.diff(first), "n_known": n_known, "train_tokens": np.full(j - i, size), "base_score": base, "score": total, "n_bytes": np.diff(offs)}))
        return pa.concat_tables(out)

    return rows.groupBy("block").cogroup(values.groupBy("block")).applyInArrow(run, schema)
