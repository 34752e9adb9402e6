"""The corpus pipeline stage by stage against plain versions."""

import zlib

import brute
import corpus_pipeline as cp
import numpy as np

from culedger.llm import mixing, queries
from culedger.llm.common import documents, materialize

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted((r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect())


def test_stages(spark):
    from tokenizers import Tokenizer

    docs = documents(spark, SF)
    seen = [docs]
    for name, stage in cp.STAGES:
        seen.append(materialize(stage(spark, seen[-1], SF), "test"))
        if name != cp.STAGES[-1][0]:
            assert seen[-1].columns == docs.columns
    start, good, single, clean, mixed, done = seen
    good_ids = {r["doc_id"] for r in queries.op5_quality_rules(spark, SF).where("kept").collect()}
    assert rows(good) == [x for x in rows(start) if x[0] in good_ids]
    component = brute.joined(rows(good), 5, 80)
    assert rows(single) == [x for x in rows(good) if component[x[0]][1] == x[0]]
    leaked = {r["doc_id"] for r in queries.op9_decontamination(spark, SF).where("contaminated").collect()}
    assert rows(clean) == [x for x in rows(single) if x[0] not in leaked]
    taken = {r["doc_id"]: r["taken"] for r in mixing.mix(clean).collect()}
    words = {}
    for i, t in rows(mixed):
        words[i] = words.get(i, 0) + len(brute.words(t))
    assert words == {i: n for i, n in taken.items() if n}
    tokenizer = Tokenizer.from_file(queries.vocabulary_path())
    want = sorted((i, zlib.crc32(np.array(tokenizer.encode(t, add_special_tokens=False).ids + [1], "<u4").tobytes())) for i, t in rows(mixed))
    assert sorted((r["doc_id"], r["ids_crc32"]) for r in done.collect()) == want
    assert sorted((r["doc_id"], r["ids_crc32"]) for r in cp.run(spark, SF).collect()) == want
