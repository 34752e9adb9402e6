"""Rows that operators must live with: digits and letters of every script,
look-alikes of control tokens, nulls side by side, unclosed tags, long pages and
many rows without an id."""

import json
import random
import re
import time
import tracemalloc

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from culedger.llm import decontam, jaccard, lines, mixing, pii, queries, secret_scan, tokens
from culedger.llm.common import fresh_path

# 10 --------------------------------------------------------------------------

PATTERNS = {"local": frozenset("abc.0123456789"), "domain": re.compile(pii.DOMAIN)}


def test_digits_of_every_script_are_no_numbers(spark):
    rng = random.Random(10)
    alphabet = "².①٣४𝟘५.:-+@() \t0123456789abcdefXYZé漢"
    texts = ["².a@b.c.co see", "²³.¹.٤.5", "+1 ²³ 555 0199", "::²", "1.2.3.² 10.0.0.٣"]
    texts += ["".join(rng.choice(alphabet) for _ in range(80)) + " ².a@b.co" for _ in range(150)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert pii.report(pii.find(df)).count() == len(texts)


# 4 ---------------------------------------------------------------------------

LOOK_ALIKES = ["<|STARTOFTEXT|>abc", "<|EndOfText|>x.", "<|endoftext|>x.", "a<|StartOfText|>", "<|endoftext|>", "J̌ T̈. H̱! W̊X, Å. Y̊1.", "İstanbul. ΣΑΣ. ΑΣ, ΌΣ.", "it's. IT'S! don'T'.", "KK. Å.", "x́.", "Hello world, two words.", "a  b \x1c c\x85d", "1٠.", ""]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_are_those_of_whole_texts(spark, name):
    path = queries.vocabulary_path(name)
    rng = random.Random(4)
    parts = LOOK_ALIKES + [" ", "\n", ".", "'S", "É", "é", "A1", "<|", "|>", "ß", "ﬃ", "😀", "漢"]
    texts = LOOK_ALIKES + ["".join(rng.choice(parts) for _ in range(12)) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    folder = fresh_path(spark, "test-look-alikes")
    tokens.write(df, folder, path, 1)
    tokenizer = Tokenizer.from_file(path)
    got = {r["doc_id"]: r["ids"] for r in tokens.read(spark, folder, tokens=True).collect()}
    for i, t in enumerate(texts):
        assert got[i] == tokenizer.encode(t, add_special_tokens=False).ids + [1], t


def test_words_are_encoded_apart_only_where_the_file_allows():
    def of(name):
        with open(queries.vocabulary_path(name), encoding="utf-8") as f:
            return f.read()

    assert tokens.word_wise(of("word_bpe_49k.json")) == [b"<|startoftext|>", b"<|endoftext|>"]
    assert tokens.word_wise(of("byte_bpe_50k.json")) is None
    assert tokens.word_wise(of("word_bpe_49k.json").replace('"NFC"', '"NFKC"')) is None


def test_words_of_letters_are_encoded_many_at_once(monkeypatch):
    """Finding F1 of round 3: the library took most of its time for each call's
    own work, a word a call."""
    with open(queries.vocabulary_path(), encoding="utf-8") as f:
        model = f.read()
    store, whole = {}, Tokenizer.from_str(model)
    monkeypatch.setattr(tokens, "_worker_store", lambda name: store)
    encode = tokens._encoder(model, 2)

    class Counting:
        texts = 0

        def encode_batch_fast(self, batch, **options):
            self.texts += len(batch)
            return whole.encode_batch_fast(batch, **options)

    store["tokenizer"] = counting = Counting()
    letters = [c for c in map(chr, range(0x250)) if tokens.LETTERS.fullmatch(c.encode())]
    assert letters == [c for c in map(chr, range(0x180)) if c.isalpha() and c not in "ªµºİıŉ"]
    rng = random.Random(4)
    words = list(dict.fromkeys(letters + ["".join(rng.choice(letters) for _ in range(rng.randint(2, 12))) for _ in range(9000)]))
    texts = [" ".join(words[i : i + 50]).encode() for i in range(0, len(words), 50)]
    texts += [b"", b" ", b"\n a\x0b\x0cb\t\r ", b"\x1c\x1dx\x85 \xc3 \xc3\xa9\xff.", "\u2003É x́ é\u0301".encode()]
    expected = [whole.encode(t.decode("utf-8", "replace"), add_special_tokens=False).ids for t in texts]
    for _ in range(2):
        assert [np.frombuffer(x, "<u2").tolist() for x in encode(texts)] == expected
    assert encode([]) == [] and encode([b""]) == [b""] and encode([b" ", b""]) == [b"", b""]
    assert counting.texts < 20


def test_words_are_joined_only_where_the_file_shows_their_ends():
    with open(queries.vocabulary_path(), encoding="utf-8") as f:
        model = json.loads(f.read())
    added = {"id": 49408, "content": "abc", "single_word": False, "lstrip": False, "rstrip": False, "normalized": False, "special": True}
    assert tokens.closing(json.dumps(model)).sum() > 1000
    assert tokens.closing(json.dumps(model | {"added_tokens": [added]})) is None
    assert tokens.closing(json.dumps(model | {"pre_tokenizer": {"pretokenizers": model["pre_tokenizer"]["pretokenizers"][:1]}})) is None
    for change in ({"ignore_merges": True}, {"end_of_word_suffix": "g"}, {"continuing_subword_prefix": "##"}, {"type": "WordPiece"}, {"vocab": {k: i for k, i in model["model"]["vocab"].items() if k != "q</w>"}}):
        assert tokens.closing(json.dumps(model | {"model": model["model"] | change})) is None


# 1 ---------------------------------------------------------------------------


def mixed(spark, rows, names="doc_id long, text string, lang string, source string, n_chars long"):
    df = spark.createDataFrame(rows, names)
    return sorted(map(tuple, mixing.apply(df).collect()), key=str)


def test_mixing_keeps_rows_that_share_values(spark):
    rows = [(1, "a b c", "en", None, 5), (1, None, "en", "a b c", 0)]
    assert mixed(spark, rows) == [(1, "a b c", "en", None, 5)]  # no word is taken of the other
    rows = [(1, "a b c", "en", "s", 5), (1, "a b c", "fr", "s", 5)]
    assert mixed(spark, rows) == sorted(rows, key=str)
    rows = [(1, "a b", None, "s", 3), (1, "a b", "s", "s", 3), (None, "a b", "s", "s", 3), (None, "a b", "s", "s", 3)]
    assert mixed(spark, rows) == sorted(rows, key=str)


def test_mixing_leaves_other_columns_alone(spark):
    rows = [(i, f"w{i} x", "k", i, i, "s") for i in range(40)]
    names = "doc_id long, text string, __key string, row long, taken long, source string"
    assert mixed(spark, rows, names) == sorted(rows, key=str)


# 3 ---------------------------------------------------------------------------


def plain_lines(html):
    t = re.sub(lines.HIDDEN, "", html or "")
    t = re.sub(lines.BLOCKS, "\n", re.sub("[\r\n]+", " ", t))
    t = re.sub("<[^>]*>", "", t)
    for entity, char in lines.ENTITIES:
        t = t.replace(entity, char)
    return [x for x in (y.strip(" ") for y in t.split("\n")) if x]


def test_lines_of_tag_soup_equal_the_plain_pattern(spark):
    rng = random.Random(3)
    parts = ["<script x ", "<SCRIPT>", "</script>", "<style>", "</Style>", "<!--", "-->", "<!-->", "<!doctype ", "<p>", "</p >", "<br", "<", ">", "a", "b ", "\n", "", "", "<script", "&lt;", "scripts", "<scripts>", "é"]
    pages = ["".join(rng.choice(parts) for _ in range(rng.randint(0, rng.choice((40, 250))))) for _ in range(1500)]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(pages)] + [(-1, None)], "page_id long, html string")
    got = {r["page_id"]: r["lines"] for r in df.select("page_id", lines.html_lines(df["html"]).alias("lines")).collect()}
    assert got[-1] == []
    for i, p in enumerate(pages):
        assert got[i] == plain_lines(p), p


@pytest.mark.parametrize("unit", ["<script x ", "<!--", "<style ", "<!doctype ", "<p ", "<", "</script>", "-->", "<script>a</script>", "&lt;"])
@pytest.mark.parametrize("end", ["", ">", "-->", "</script>"])
def test_a_page_of_a_megabyte_takes_no_longer_than_its_length(spark, unit, end):
    df = spark.createDataFrame([(1, unit * (1_000_000 // len(unit)) + end)], "page_id long, html string")
    began = time.time()
    df.select(lines.html_lines(df["html"]).alias("lines")).write.format("noop").mode("overwrite").save()
    assert time.time() - began < 4


# 2 ---------------------------------------------------------------------------


def test_many_rows_without_an_id_are_joined(spark):
    base = [f"w{i}" for i in range(60)]
    texts = [" ".join([*base, f"own{i}"]) for i in range(10_000)]
    rows = [(None, t) for t in texts] + [(None, texts[0])] * 3 + [(5, texts[1]), (5, "something else entirely that is said once")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    began = time.time()
    got = jaccard.join(df).collect()
    assert time.time() - began < 120
    assert len(got) == len(rows)
    assert sum(r["component_id"] == 5 for r in got) == len(rows)
    assert all(r["n_shingles"] in (58, 4) for r in got)


def test_one_of_many_rows_without_an_id_stays(spark):
    base = " ".join(f"w{i}" for i in range(60))
    rows = [(None, f"{base} {i}", f"x{i}") for i in range(300)] + [(None, None, "y"), (None, "", "z"), (None, "", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, key string")
    got = jaccard.keep_one(df).collect()
    assert len(got) == 4 and got[0].asDict().keys() == {"doc_id", "text", "key"}
    assert sum(bool(r["text"]) for r in got) == 1


def test_keys_tell_nulls_apart(spark):
    from pyspark.sql import functions as F

    from culedger.llm.common import row_keys

    df = spark.createDataFrame([(1, None, "a"), (1, "a", None), (None, "a", None), (None, None, "a"), (None, None, None)], "i long, s string, t string")
    assert df.select(*row_keys(F.col("i"), F.col("s"), F.col("t"))).distinct().count() == 5
    assert np.unique([r[0] for r in df.select(row_keys(F.col("i"), F.col("s"))[0]).collect()]).size == 4


# 6, 9 ------------------------------------------------------------------------


def test_repeated_rows_are_scanned_each(spark):
    text = 'password = "S3cr3t-pa55!" and api_key = "04db9f1c7e2a4b6d8c0e04db9f1c7e2a4b6d8c0e"'
    df = spark.createDataFrame([(1, text), (1, text), (None, text)], "doc_id long, text string")
    found = secret_scan.scan(df).groupBy("doc_id", "row").count().collect()
    assert len(found) == 3 and len({r["count"] for r in found}) == 1


def test_decontamination_takes_any_column_name(spark):
    item = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    docs = spark.createDataFrame([(1, item, "k", "c"), (2, "clean text of its own", "k", "c"), (None, None, "k", "c")], "doc_id long, text string, key string, c0 string")
    got = decontam.remove(docs, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert got.columns == docs.columns and sorted(map(tuple, got.collect()), key=str) == [(2, "clean text of its own", "k", "c"), (None, None, "k", "c")]


def test_trees_learn_from_every_labelled_candidate(spark):
    """A form that only candidates with the greatest hashes have, past any cut."""
    base = spark.range(30_000).withColumn("late", F.col("id") >= 29_000)
    label = F.when(F.col("late"), 1).otherwise(F.col("id") % 2).cast("int")
    digits = F.when(F.col("late"), 11).when(F.col("id") % 2 == 1, 14).otherwise(5)
    features = F.array(F.lit(0.0), *[(digits if x == "digits" else F.lit(1)).cast("double") for x in pii.FEATURES[1:]])
    model, thresholds = pii.fit(base.select(label.alias("label"), features.alias("features"), F.col("id").alias("draw")), precision=0.98)
    asked = spark.createDataFrame([([0.0, *[11.0 if x == "digits" else 1.0 for x in pii.FEATURES[1:]]],), ([0.0, *[5.0 if x == "digits" else 1.0 for x in pii.FEATURES[1:]]],)], "features array<double>")
    late, clean = [r["probability"][1] for r in model.transform(asked.select(array_to_vector("features").alias("vector"))).collect()]
    assert late >= thresholds[0] >= 0.5 > clean
    assert thresholds[1] == 0.9  # a kind without labels


def test_thresholds_count_every_candidate_of_a_score(spark):
    """Held-out candidates that look alike share a score, so the threshold can't
    take the good ones of them alone."""
    base = spark.range(400)
    label, features = (F.col("id") % 8 != 4).cast("int"), F.array(*[F.lit(0.0)] * len(pii.FEATURES))
    rows = base.select(label.alias("label"), features.alias("features"), F.col("id").alias("draw"))
    _, thresholds = pii.fit(rows.union(rows.selectExpr("0", "transform(features, (x, i) -> if(i = 0, 0d, 9d))", "draw")), precision=0.98)
    assert thresholds[0] == 0.9


def test_words_and_their_pieces_share_one_bounded_store(monkeypatch):
    with open(queries.vocabulary_path(), encoding="utf-8") as f:
        model = f.read()
    monkeypatch.setattr(tokens, "_worker_store", lambda name, store={}: store)
    monkeypatch.setattr(tokens, "CACHE_WORDS", 100)
    encode = tokens._encoder(model, 2)
    texts = [" ".join(f"Word{i}, alpha{i} beta{i}!" for i in range(k, k + 10)).encode() for k in range(0, 100, 5)]
    whole = Tokenizer.from_str(model)
    for text in texts + texts:
        assert np.frombuffer(encode([text])[0], "<u2").tolist() == whole.encode(text.decode(), add_special_tokens=False).ids
    kept = [v for v in tokens._worker_store("").values() if isinstance(v, dict)]
    assert 50 < sum(map(len, kept)) <= 100


def test_a_large_block_is_compared_in_bounded_memory():
    """Near copies all stay, so the tree can't drop a pair of its nodes."""
    n = 8192
    bits = np.tile(np.arange(1, 33, dtype=np.uint64), (n, 1))
    tracemalloc.start()
    root = jaccard.groups_of(bits, np.full(n, 60), 85)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert not root.any() and peak < 60 << 20
