"""Operators 11 to 13 against plain versions, and on odd rows and empty tables."""

import collections
import functools
import hashlib
import re
import zlib

import brute
import numpy as np
import pytest
import xxhash

from culedger.llm import collocations, conversations, queries, simhash

SF = "/root/testdata/sf0.001"


def by(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


# 11 --------------------------------------------------------------------------

BLANKS = " \t\n\x0b\x0c\r"


def cheapest(rows):
    """(cost, audit) by trying every edit; rows: (initial, must go, truncated)."""
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    @functools.cache
    def best(i, q, inserts):
        ways = [(0, "")] if i == len(rows) and q in ("", "a") else []
        if inserts < 3:
            for x in "ua":
                if (q, x) in after:
                    c, t = best(i, after[q, x], inserts + 1)
                    ways.append((c + 2, "I" + t))
        if i < len(rows):
            initial, gone, cut = rows[i]
            c, t = best(i + 1, q, 0)
            ways.append((c + 3, "D" + t))
            if not gone:
                if (q, initial) in after:
                    c, t = best(i + 1, after[q, initial], 0)
                    ways.append((c + cut, "K" + t))
                for x in "ua":
                    if (q, x) in after:
                        c, t = best(i + 1, after[q, x], 0)
                        ways.append((c + 2 + cut, "R" + t))
        return min(ways, default=(10**9, "~"))

    return best(0, "", 0)


def audited(rows):
    """{conv_id: the contract's columns} of (conv_id, turn, role, text)."""
    held = lambda x: " " if x is None else str(x)
    out, convs = {}, collections.defaultdict(list)
    for conv, turn, role, text in rows:
        convs[conv]
        role, text = held(role), held(text)
        code = zlib.crc32(f"{held(conv)}:{held(turn)}".encode()) % 20
        if code == 0:
            continue
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        convs[conv] += [(turn, "user" if code == 4 else role, text)] * (2 if code == 3 else 1)
    for conv, own in convs.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, kinds, count = set(), [], collections.Counter()
        for _, role, text in own:
            solid = text.rstrip(BLANKS)
            fault = "blank" if not solid else "duplicate" if (role, text) in seen else "" if solid[-1] in ".!?" else "truncated"
            seen.add((role, text))
            count[fault] += 1
            kinds.append((role[:1], fault in ("blank", "duplicate"), int(fault == "truncated")))
        turns = [t for t, _, _ in own if t is not None]
        cost, audit = cheapest(tuple(kinds))
        length = sum(x != "D" for x in audit)
        roles = (["s"] if length % 2 else []) + ["user", "assistant"] * (length // 2)
        kept, at = [], iter(own)
        for x in audit:
            row = next(at) if x != "I" else None
            if x != "D":
                role = roles[len(kept)]
                kept.append(f"{row[1]}:{row[2]}" if x == "K" else f"{role}:{row[2] if row else ''}")
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = dict(conv_id=conv, gaps=gaps, blank=count["blank"], duplicate=count["duplicate"], truncated=count["truncated"], illegal=illegal, cost=cost, audit=audit, repaired_sha256=hashlib.sha256("\n".join(kept).encode()).hexdigest())
    return out


@pytest.fixture(scope="module")
def talks(spark):
    """Conversations of every kind, from a fixed seed."""
    rng = np.random.default_rng(11)
    roles, texts = ["user", "assistant", "system", "tool", "ua", "", None, "User"], ["Yes.", "Go on!", "and then", "", " \t\n", None, "Why? ", "a.b", "été.\r\n"]
    rows = []
    for conv in range(250):
        p = [0.4, 0.35, 0.1] + [0.03] * 5
        for turn in range(int(rng.integers(1, 9))):
            role = roles[rng.choice(8, p=p)]
            text = texts[rng.integers(len(texts))]
            if text and rng.random() < 0.6:
                text = f"{turn} {text}"
            rows.append((conv, None if rng.random() < 0.03 else int(turn + (rng.random() < 0.1)), role, text))
    rows += [(None, 1, "user", "Lost?"), (None, None, "assistant", "Found."), (None, 2, "user", None)]
    rows += [(2**62 + 1, 0, "system", "One."), (-5, None, None, None)]
    return rows


TALK = "conv_id long, turn long, role string, text string"


def test_conversations_equal_the_plain_version(spark, talks):
    got = by(conversations.audit(spark.createDataFrame(talks, TALK)), "conv_id")
    assert got == audited(talks)


def test_conversations_of_the_table(spark):
    table = spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text")
    assert by(queries.op11_conversation_repair(spark, SF), "conv_id") == audited([tuple(r) for r in table.collect()])


def test_conversations_that_spill_and_span_batches_are_repaired_alike(spark, talks):
    """One conversation of thousands of rows, with tiny spools, blocks and
    Arrow batches, gives what it gives in memory."""
    rng = np.random.default_rng(3)
    roles = ["user", "assistant", "system", "tool"]
    rows = [(7, i, roles[rng.choice(4, p=[0.45, 0.4, 0.05, 0.1])], f"{i % 900} {'.' if rng.random() < 0.8 else ''}") for i in range(3000)]
    df = spark.createDataFrame(rows + [(8, 0, "user", "Hi.")], TALK)
    whole = by(conversations.digest(conversations.repair(df)), "conv")
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "37")
    try:
        small = by(conversations.digest(conversations.repair(df, spool=500, block=64)), "conv")
    finally:
        spark.conf.set(key, before)
    assert small == whole and len(whole["7"]["audit"]) >= 3000
    assert whole["8"]["audit"] == "KI" and whole["8"]["cost"] == 2


def test_repair_gives_the_edited_rows(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "assistant", "Hello."), (1, 2, "user", "Well"), (1, 2, "user", "Well"), (1, 3, "assistant", " ")]
    got = [(r.edit, r.fault, r.role, r.text) for r in conversations.repair(spark.createDataFrame(rows, TALK)).collect()]
    assert got == [("K", "", "system", "Be kind."), ("I", "", "user", ""), ("K", "", "assistant", "Hello."), ("D", "truncated", "user", "Well"), ("D", "duplicate", "user", "Well"), ("D", "blank", "assistant", " ")]


def test_conversations_empty_table_and_extra_columns(spark):
    wide = spark.createDataFrame([(1, 0, "user", "Hi.", "x", 3)], TALK + ", conv string, copy int")
    assert conversations.audit(wide).count() == 1
    assert conversations.audit(wide.limit(0)).count() == 0


# 12 --------------------------------------------------------------------------


def simhashed(docs, size=3, distance=3):
    """[(doc_id, fingerprint, component_id)] by comparing all pairs."""
    marks = []
    for i, text in docs:
        w = brute.words(brute.fold(text))
        grams = [" ".join(w[k : k + size]) for k in range(max(1, len(w) - size + 1))] if w else []
        hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        marks.append((i, sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))))
    root = {f: f for _, f in marks}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in root:
        for b in root:
            if a < b and (a ^ b).bit_count() <= distance:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    least = {}
    for i, f in marks:
        if i is not None:
            least[find(f)] = min(i, least.get(find(f), i))
    return sorted(((i, f"{f:016x}", least.get(find(f))) for i, f in marks), key=str)


def tripled(df):
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in df.collect()), key=str)


def test_simhash_equals_all_pairs_on_the_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert tripled(queries.op12_simhash(spark, SF)) == simhashed(docs)


def near_texts():
    base = [f"word{i}" for i in range(120)]
    docs = []
    for i in range(90):
        w = list(base)
        for k in range(i % 5):
            w[(i * 7 + k * 31) % 120] = f"x{i}-{k}"
        docs.append((1000 - i, " ".join(w)))
    return docs + [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "one  two\tthree"), (8, "Été là ﬂ É"), (None, "one"), (None, " ".join(base)), (9, " ".join(f"l{i % 977}" for i in range(30_000)))]


@pytest.mark.parametrize("limit,probe_from", [(8192, 4096), (2, 4096), (2, 3)])
def test_simhash_near_copies_by_short_long_and_probed_lists(spark, limit, probe_from):
    docs = near_texts()
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as bytes", "'x' as fingerprint", "0 as least")
    assert tripled(simhash.near_duplicates(df, limit=limit, probe_from=probe_from)) == simhashed(docs)


def test_simhash_of_an_empty_table(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_triples_cover_every_linked_pair():
    for five in simhash.FIVES:
        assert any(set(t) <= set(five) for t in simhash.TRIPLES)


def test_linked_lists_equal_all_pairs():
    rng = np.random.default_rng(5)
    values = np.unique(np.concatenate([rng.integers(0, 1 << 24, 300), 5 ^ (1 << rng.integers(0, 24, 100))]).astype(np.uint64)) | np.uint64(0xABCDE << 24)
    root = np.arange(len(values))
    for i in range(len(values)):
        for j in range(i):
            if int(values[i] ^ values[j]).bit_count() <= 3:
                root[root == max(root[i], root[j])] = min(root[i], root[j])
    assert (simhash.tallied(values, 3) == root).all()
    assert (simhash.probed(values, (0, 1, 2), 3) == root).all()


# 13 --------------------------------------------------------------------------


def mined(docs, least=10, top=2000):
    """[(lang, rank, phrase, a, l, r, n, score)] from counts of all phrases."""
    f, n = collections.Counter(), collections.Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", brute.fold(text)):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i : i + k])] += 1
    found = collections.defaultdict(list)
    inside = collections.Counter()
    for (lang, p), a in f.items():
        if len(p) == 3 and a >= least:
            for q in (p[:2], p[1:]):
                inside[lang, q] = max(inside[lang, q], a)
    for (lang, p), a in f.items():
        if len(p) > 1 and a >= least and not (len(p) == 2 and 100 * inside[lang, p] >= 50 * a):
            cuts = [(10**6 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
            s, k = min(cuts)
            found[lang].append((-s, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    out = []
    for lang, own in found.items():
        for rank, (s, a, p, left, right) in enumerate(sorted(own)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def phrases(df):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect())


def test_collocations_equal_counted_phrases_on_the_table(spark):
    docs = [(r.lang, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = phrases(queries.op13_collocations(spark, SF))
    assert got == mined(docs) and len(got) > 100


@pytest.mark.parametrize("size", [1, 40, 1_000_000])
def test_collocations_do_not_depend_on_the_shards(spark, size):
    rng = np.random.default_rng(13)
    vocabulary = ["New", "york", "city", "Été", "the", "a-b", "the", "the"]
    texts = [" ".join(rng.choice(vocabulary, 30)).replace("a-b the", "a-b, the") for _ in range(40)]
    docs = [("en" if i % 3 else None, t) for i, t in enumerate(texts)] + [("en", None), ("fr", ""), ("fr", " .,\n"), ("en", "the\tthe \x0b the"), ("en", "z " * 5000), ("é", "x\x00y " * 12)]
    df = spark.createDataFrame(docs, "lang string, text string").selectExpr("*", "1 as w1", "'q' as phrase", "2 as n").repartition(3)
    got = phrases(collocations.mine(df, least=4, size=size))
    assert got == mined(docs, least=4)


def test_collocations_rank_and_cut(spark):
    docs = [("en", "b a. " * 12 + "a b. " * 12 + "c d e. " * 11)]
    df = spark.createDataFrame(docs, "lang string, text string")
    assert phrases(collocations.mine(df, top=2)) == mined(docs, top=2)
    assert collocations.mine(df.limit(0)).count() == 0


def test_bidirectional_index_counts_every_short_phrase():
    rng = np.random.default_rng(1)
    s = np.append(rng.integers(0, 5, 400), 0).astype(np.int32)
    index = collocations.BiIndex(s)
    wanted = np.array([False] + [True] * 4)
    pairs = index.pairs(wanted)
    text = s.tolist()
    two = collections.Counter(x for x in zip(text, text[1:]) if 0 not in x)
    three = collections.Counter(x for x in zip(text, text[1:], text[2:]) if 0 not in x)
    assert dict(zip(zip(pairs[0].tolist(), pairs[1].tolist()), pairs[2].tolist())) == two
    which, third, count = index.triples(pairs)
    assert dict(zip(zip(pairs[0][which].tolist(), pairs[1][which].tolist(), third.tolist()), count.tolist())) == three
