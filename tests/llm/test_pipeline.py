"""The pipeline, stage by stage, against plain Python."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import tiktoken

import corpus_pipeline
from casegrid.llm import bpe, mixing
from casegrid.session import materialize
from tests.llm import brute
from tests.llm.conftest import frame

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def test_stages(spark, documents):
    docs, seen = documents, {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = materialize(stage(spark, docs, ""))
        seen[name] = (before, docs)
        if name != "byte_bpe":
            assert docs.columns == COLUMNS
    before, after = map(rows_of, seen["quality_rules"])
    assert set(after) <= set(before) and all(not brute.quality(r[1])[5] for r in after)
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    clean = {r.doc_id for r in labels.filter("quality = 1").collect()}
    kept = {r[0] for r in after}
    assert all(brute.quality(r[1])[5] for r in before if r[0] in clean and r[0] not in kept)

    before, after = map(rows_of, seen["line_dedup"])
    want = [
        (r[0], text, r[2], r[3], len(text))
        for r, (_, _, text) in zip(before, brute.line_dedup([r[:2] for r in before]), strict=True)
    ]
    assert after == sorted(want, key=repr)

    before, after = map(rows_of, seen["ngram_jaccard"])
    groups = brute.components([r[:2] for r in before])
    assert after == [r for r, (_, c) in zip(before, groups, strict=True) if c == r[0]]

    before, after = seen["source_mix"]
    taken = {r.doc_id: r.repeats for r in mixing.mix(before).collect()}
    want = Counter({r: taken[r[0]] for r in rows_of(before)})
    assert Counter(rows_of(after)) == +want

    before, after = seen["byte_bpe"]
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for r in rows_of(before):
        ids = np.array(plain.encode_ordinary(r[1] or ""), "<u4").tobytes()
        want.append((r[0], len(ids) // 4, hashlib.sha256(ids).hexdigest(), brute.sha(r[1] or "")))
    assert sorted(tuple(r) for r in after.collect()) == sorted(want)


def test_messy_and_empty(spark, messy, empty):
    for docs in (messy, empty):
        for _, stage in corpus_pipeline.STAGES:
            docs = materialize(stage(spark, docs, ""))
    assert docs.count() == 0
    assert frame(spark, []).columns[:5] == COLUMNS
