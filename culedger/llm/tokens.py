"""Token-ID / binary output (operator 4).

Format of a data set in a folder (all numbers little-endian):

* ``shard-NNNNN.bin``: token ids of the shard's documents, one flat array of
  unsigned integers (16 bits if every id fits, else 32);
* ``shard-NNNNN.off``: unsigned 64-bit offsets, one more than documents, in
  ids from the shard's first;
* ``shard-NNNNN.doc``: signed 64-bit document ids (the least value for null);
* ``manifest``: Parquet rows (shard, name, n_docs, n_tokens, base, width);
  ``base`` is the number of ids in all shards before, a prefix sum.

Documents stand in ascending id order, null ids first, over all shards; rows
with the same id are ordered by their ids' bytes, so reruns agree. Null texts
count as empty. Every document ends with the end id. An empty table makes a
manifest without rows. Extra columns are not stored.

Each shard is written by one task under a name of its own and then renamed, so
a task that is run again leaves one whole copy. The folder must be one that
all executors see.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import sys
import types
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from culedger.llm import arrays

NULL_ID = -(2**63)
#: Words and pieces of words together that a worker keeps the ids of. They stay
#: in its memory when other operators' tasks run in it.
CACHE_WORDS = 400_000
#: Words that are encoded at once: the library's results are far larger than
#: their ids.
BATCH_WORDS = 4096
#: Marks that may close a word.
MARKS = b".,;:!?#$%&*|"
#: Fixed value: the words of a tokenizer that parts letters, digits and marks.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Fixed value: letters (in UTF-8) that compose with none of each other and that
#: are one letter in lower case: those of ASCII, Latin-1 and Latin Extended-A.
LETTERS = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]|\xc4[\x80-\xaf\xb2-\xbf]|\xc5[\x80-\x88\x8a-\xbf])+")
#: Fixed value: the mark of a token that closes a word.
CLOSING = "</w>"
#: Texts are encoded in groups of about so many bytes.
GROUP_BYTES = 4 << 20


def _worker_store(name: str) -> dict:
    """A dict that outlives a task in a Python worker that Spark uses again."""
    home = sys.modules.setdefault("culedger_worker_store", types.ModuleType("culedger_worker_store"))
    return home.__dict__.setdefault(name, {})


def word_wise(tokenizer_json: str) -> list[bytes] | None:
    """Whether a text's ids are those of its blank-parted words in turn, and
    those of a word's closing marks apart from the rest, as the tokenizer file
    shows: its normalizer composes characters (which never reach across a blank
    or an ASCII mark), makes runs of blanks one blank and lower-cases; its first
    pre-tokenizer keeps runs of letters, digits one by one, and runs of marks,
    and drops blanks; nothing is added, cut or padded around a text; and its
    added tokens hold no blank and take none along. If so, the added tokens'
    contents in lower case, else None."""
    t = json.loads(tokenizer_json)
    added = t.get("added_tokens") or []
    plain = all(not (a["lstrip"] or a["rstrip"] or a["single_word"] or a["normalized"]) and a["content"] and not re.search(r"\s", a["content"]) for a in added)
    if not plain or any(t.get(k) for k in ("truncation", "padding", "post_processor")):
        return None
    steps = (t.get("normalizer") or {}).get("normalizers")
    if steps != [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]:
        return None
    parts = (t.get("pre_tokenizer") or {}).get("pretokenizers") or []
    split = {"type": "Split", "pattern": {"Regex": WORD_PATTERN}, "behavior": "Removed", "invert": True}
    rest = [p for p in parts[1:] if not (p.get("type") == "ByteLevel" and not p.get("add_prefix_space") and not p.get("use_regex"))]
    if parts[:1] != [split] or rest or (t.get("model") or {}).get("dropout"):
        return None
    return [a["content"].encode().lower() for a in added]


def closing(tokenizer_json: str) -> np.ndarray | None:
    """For each id of a tokenizer that :func:`word_wise` holds for, whether it
    closes a word, if each word of LETTERS alone has one such id, its last, as
    the file shows: its second and last pre-tokenizer makes bytes of the words,
    each of which has a token, with and without the mark, and no added token is
    a part of such a word. Else None."""
    t = json.loads(tokenizer_json)
    model, vocab = t["model"], t["model"]["vocab"]
    if model.get("type") != "BPE" or model.get("end_of_word_suffix") != CLOSING or model.get("continuing_subword_prefix") or model.get("ignore_merges"):
        return None
    if len(t["pre_tokenizer"]["pretokenizers"]) != 2 or any(LETTERS.fullmatch(a["content"].encode()) for a in t.get("added_tokens") or []):
        return None
    from tokenizers.pre_tokenizers import ByteLevel

    if not all(c in vocab and c + CLOSING in vocab for c in ByteLevel.alphabet()):
        return None
    out = np.zeros(max(vocab.values()) + 1, bool)
    out[[i for token, i in vocab.items() if token.endswith(CLOSING)]] = True
    return out


def _pieces(word: bytes, added: re.Pattern | None) -> tuple[bytes, bytes]:
    """A word in lower case without its closing marks, and those. Only ASCII is
    lower-cased (beyond it, case and composition don't commute), and a word that
    would then hold an added token is left as it is."""
    head = word.rstrip(MARKS)
    low = head.lower()
    if not head[-1:].isalnum() or (added and added.search(low)):
        return word, b""
    return (low if head.isascii() else head), word[len(head) :]


def _encoder(tokenizer_json: str, width: int):
    """A function from texts (bytes) to ids (bytes), which the library works
    out. Where :func:`word_wise` holds, words and their pieces are encoded, each
    once while there is room to keep it; else whole texts are. Where
    :func:`closing` holds too, words of letters are encoded many as one text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    store = _worker_store(f"{width} {hashlib.sha256(tokenizer_json.encode()).hexdigest()}")
    if "tokenizer" not in store:
        from tokenizers import Tokenizer

        added = word_wise(tokenizer_json)
        store |= {"tokenizer": Tokenizer.from_str(tokenizer_json), "added": added, "closing": None if added is None else closing(tokenizer_json), "words": {b"": b""}}
    kind, added, closes = f"<u{width}", store["added"], store["closing"]

    def library(texts: list[bytes]) -> list[np.ndarray]:
        found = store["tokenizer"].encode_batch_fast([t.decode("utf-8", "replace") for t in texts], add_special_tokens=False)
        return [np.asarray(e.ids, kind) for e in found]

    def encoded(texts: list[bytes]) -> list[bytes]:
        return [x.tobytes() for x in library(texts)]

    if added is None:
        return encoded
    look = re.compile(b"|".join(map(re.escape, added))) if added else None

    def lettered(words: list[bytes]) -> list[bytes]:
        (ids,) = library([b" ".join(words)])
        ends = ((np.flatnonzero(closes[ids]) + 1) * width).tolist()
        ids = ids.tobytes()
        return [ids[i:j] for i, j in zip([0, *ends], ends)]

    def learn(pieces: list[bytes], how) -> None:
        for i in range(0, len(pieces), BATCH_WORDS):
            part = pieces[i : i + BATCH_WORDS]
            store["words"].update(zip(part, how(part), strict=True))

    def encode(texts: list[bytes]) -> list[bytes]:
        known = store["words"]
        split = pc.ascii_split_whitespace(pa.array(texts, pa.binary()).view(pa.string()))  # at the six ASCII blanks
        words = split.values.view(pa.binary()).dictionary_encode()
        # No word holds a blank, so joining and splitting makes a list of them.
        one = pa.ListArray.from_arrays(pa.array([0, len(words.dictionary)], pa.int32()), words.dictionary)
        distinct = pc.binary_join(one, b" ")[0].as_py().split(b" ") if len(words) else []
        found = list(map(known.get, distinct))
        new = [w for w, x in zip(distinct, found, strict=True) if x is None]
        pairs = [_pieces(w, look) for w in new]
        # A piece is a word too, with the same ids, so both are kept in one place.
        asked = set(chain.from_iterable(pairs)).difference(known)
        plain = list(filter(LETTERS.fullmatch, asked)) if closes is not None else []
        learn(plain, lettered)
        learn(list(asked.difference(plain)), encoded)
        fresh = [known[a] + known[b] for a, b in pairs]
        known.update(zip(new, fresh, strict=True))
        own = iter(fresh)
        ids = pa.array([next(own) if x is None else x for x in found], pa.large_binary()).take(words.indices)
        for w in list(islice(reversed(known), max(0, len(known) - CACHE_WORDS))):
            del known[w]
        if not len(ids):
            return [b""] * len(texts)
        # The ids of all words stand one after the other, so those of a text do.
        _, at, joined = ids.buffers()
        at = np.frombuffer(at, np.int64)[split.offsets].tolist()
        return [joined[i:j].to_pybytes() if j > i else b"" for i, j in zip(at, at[1:])]

    return encode


def _groups(sizes: list[int]) -> Iterator[tuple[int, int]]:
    start = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > GROUP_BYTES:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def encode(docs: DataFrame, tokenizer_json: str, end_id: int, width: int, bounds: list[int], text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Rows (shard, doc_id, ids binary, end id included)."""
    sc = docs.sparkSession.sparkContext
    shared = sc.broadcast(tokenizer_json)
    cuts = np.asarray(bounds, np.int64)
    end = np.asarray([end_id], f"<u{width}").tobytes()

    def run(batches):
        encoder = _encoder(shared.value, width)
        for b in batches:
            texts, ids = b.column(1).fill_null(b""), b.column(0)
            for i, j in _groups(pc.binary_length(texts).to_pylist()):
                coded = [x + end for x in encoder(texts.slice(i, j - i).to_pylist())]
                own = ids.slice(i, j - i)
                at = np.searchsorted(cuts, np.asarray(own.fill_null(NULL_ID)), side="left")
                yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), own, pa.array(coded, pa.binary())], ["shard", "doc_id", "ids"])
                del coded, own, at
            del b, texts, ids
            arrays.give_back()

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(run, "shard int, doc_id long, ids binary")


def qualified(spark: SparkSession, folder: str) -> str:
    """``folder`` with its scheme: a path without one is in Spark's default file
    system, not on the disk of whichever machine opens it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def _local(folder: str) -> str:
    return folder.removeprefix("file://") if folder.startswith("file://") else folder.removeprefix("file:")


def _store(folder: str):
    """The Arrow file system and path of a folder's URI."""
    from pyarrow import fs

    if "://" in folder and not folder.startswith("file:"):
        return fs.FileSystem.from_uri(folder)
    return fs.LocalFileSystem(), _local(folder)


def _writer(folder: str, width: int):
    def run(batches):
        store, base = _store(folder)
        store.create_dir(base, recursive=True)
        shard, n, total, mark, out = None, 0, 0, "", {}

        def close():
            for x in out.values():
                x.close()
            for kind in out:
                store.move(f"{base}/.{mark}{kind}", f"{base}/shard-{shard:05d}{kind}")
            return pa.RecordBatch.from_pylist([{"shard": shard, "name": f"shard-{shard:05d}", "n_docs": n, "n_tokens": total, "width": width}], schema)

        schema = pa.schema([("shard", pa.int32()), ("name", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("width", pa.int32())])
        for b in batches:
            for at, doc, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                if at != shard:
                    if shard is not None:
                        yield close()
                    shard, n, total, mark = at, 0, 0, uuid.uuid4().hex
                    out = {kind: store.open_output_stream(f"{base}/.{mark}{kind}") for kind in (".bin", ".off", ".doc")}
                    out[".off"].write(np.asarray([0], "<u8").tobytes())
                n, total = n + 1, total + len(ids) // width
                out[".bin"].write(ids)
                out[".off"].write(np.asarray([total], "<u8").tobytes())
                out[".doc"].write(np.asarray([NULL_ID if doc is None else doc], "<i8").tobytes())
        if shard is not None:
            yield close()

    return run


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int, text: str = "text", doc_id: str = "doc_id", shard_bytes: int = 64 << 20) -> DataFrame:
    """Encode ``docs`` with the tokenizer file and write them to ``folder``;
    returns the manifest. ``shard_bytes``: text bytes for each shard, about."""
    spark = docs.sparkSession
    folder = qualified(spark, folder)
    with open(tokenizer, encoding="utf-8") as f:
        model = f.read()
    from tokenizers import Tokenizer

    size = max(Tokenizer.from_str(model).get_vocab_size(with_added_tokens=True), end_id + 1)
    width = 2 if size <= 1 << 16 else 4
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    shards = max(1, -(-int(total) // shard_bytes))
    cuts = []
    if shards > 1:
        found = docs.agg(F.percentile_approx(F.col(doc_id).cast("long"), [i / shards for i in range(1, shards)], 10 * shards)).first()[0]
        cuts = sorted(set(found or []))
    rows = encode(docs, model, end_id, width, cuts, text, doc_id)
    rows = rows.repartitionById(len(cuts) + 1, F.col("shard")).sortWithinPartitions("shard", F.asc_nulls_first("doc_id"), "ids")
    done = rows.mapInArrow(_writer(folder, width), "shard int, name string, n_docs long, n_tokens long, width int")
    done.write.parquet(f"{folder}/parts")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row for each shard
    spark.read.parquet(f"{folder}/parts").withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))).coalesce(1).write.parquet(f"{folder}/manifest")
    return manifest(spark, folder)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema("shard int, name string, n_docs long, n_tokens long, width int, base long").parquet(f"{folder}/manifest")


def _open(folder: str, name: str, kind: str, dtype: str) -> np.ndarray:
    """A file of the data set, mapped into memory where it is a local file."""
    store, base = _store(folder)
    path = f"{base}/{name}{kind}"
    if store.type_name == "local":
        return np.memmap(path, dtype, "r") if os.path.getsize(path) else np.empty(0, dtype)
    with store.open_input_file(path) as f:
        return np.frombuffer(f.read(), dtype)


def read(spark: SparkSession, folder: str, tokens: bool = False) -> DataFrame:
    """The documents of a data set from its files: (doc_id, start, n_tokens,
    ids_crc32) and, if asked for, ``ids`` array<long>. ``start`` counts the ids
    of all documents before; the checksum is that of the ids as 32-bit
    integers."""
    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                ids = _open(folder, row["name"], ".bin", f"<u{row['width']}")
                off = _open(folder, row["name"], ".off", "<u8").astype(np.int64)
                doc = np.array(_open(folder, row["name"], ".doc", "<i8"))
                step = 4096
                for i in range(0, len(doc), step):
                    d, o = doc[i : i + step], off[i : i + step + 1]
                    own = [ids[p:q] for p, q in zip(o[:-1], o[1:], strict=True)]
                    cols = [pa.array(d, mask=d == NULL_ID), pa.array(o[:-1] + row["base"]), pa.array(np.diff(o)), pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in own], pa.int64())]
                    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                    if tokens:
                        cols.append(pa.array([x.astype(np.int64) for x in own], pa.list_(pa.int64())))
                        names.append("ids")
                    yield pa.RecordBatch.from_arrays(cols, names)

    folder = qualified(spark, folder)
    rows = manifest(spark, folder)
    n = max(1, rows.count())
    return rows.repartition(n, "shard").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * tokens)
