"""Spelling variants, centroid clusters and SentencePiece pieces against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from casegrid.llm import centroids, pieces, spelling
from casegrid.llm import queries as bound
from casegrid.llm.common import Memo
from tests.llm import brute
from tests.llm.conftest import frame

MODEL = public_tokenizers.path(bound.MODEL)


# --- spelling variants ---------------------------------------------------------------

def plain_counts(rows):
    out = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(brute.LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(counts):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(out, key=repr)


COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def grouped(spark, counts):
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    return sorted((tuple(r) for r in spelling.group_variants(words).select(*COLUMNS).collect()), key=repr)


def test_word_counts(spark, messy, messy_rows):
    rows = [(r[0], r[1]) for r in messy_rows]
    got = {r.word: r.n for r in spelling.word_counts(messy).collect()}
    assert got == plain_counts(rows) and got
    # letters are deleted only where the checksum says so
    many = [(i, f"Grüßen{chr(97 + i % 5)} Über×all plain") for i in range(5000)]
    counts = {r.word: r.n for r in spelling.word_counts(frame(spark, many)).collect()}
    assert counts == plain_counts(many) and len(counts) > 8


def test_variants_equal_all_pairs(spark):
    draw = random.Random(5)
    words = {"".join(draw.choices("abcé", k=draw.randint(5, 7))) for _ in range(600)}
    counts = {w: draw.choice([3, 3, 4, 6, 12, 30, 90]) for w in sorted(words)}
    counts |= {"aaaaa": 3, "aaaab": 6, "aaabb": 12, "aabbb": 24, "abbbb": 48, "bbbbb": 96, "anagram": 9, "nagaram": 9}
    counts["x" * 3000], counts["x" * 3001] = 5, 10
    assert grouped(spark, counts) == plain_variants(counts)


def test_variants_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(spelling, "BLOCK", 3)
    counts = {f"word{a}{b}": 3 + (ord(a) * ord(b)) % 11 for a in "abcdefgh" for b in "abcdefgh"}
    assert grouped(spark, counts) == plain_variants(counts)


def test_ties_and_unusable_words(spark):
    counts = {"tiger": 3, "tigers": 8, "tiges": 8, "liger": 5}
    got = {r[0]: r for r in grouped(spark, counts)}
    assert got["tiger"][1:] == ("tigers", "tigers", 3, 3, 8) and got["liger"][1] is None
    words = spark.createDataFrame([(None, 5), ("solo", 1)], "word string, n long")
    assert [tuple(r) for r in spelling.group_variants(words).select(*COLUMNS).collect()] == [
        ("solo", None, "solo", 1, 0, None)
    ]


def test_long_chains_of_forms(spark):
    chain = ["a" * (40 - i) + "b" * i for i in range(40)]
    forms = spark.createDataFrame(list(zip(chain, chain[1:], strict=False)), "word string, form string")
    assert {r.root for r in spelling.roots(forms).collect()} == {chain[-1]}


# --- centroid clusters ---------------------------------------------------------------

def plain_clusters(rows, k, rounds):
    kept = []
    for vec_id, v in rows:
        if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v):
            kept.append((vec_id, [int(np.floor(256 * float(np.float32(x)))) for x in v]))
    digest = lambda i: hashlib.sha256(f"2:{i}".encode()).hexdigest()
    first = sorted(kept, key=lambda r: (r[0] is None, digest(r[0]), r[1]))[:k]
    cents = [list(x) for _, x in first]

    def assign():
        out = []
        for _, x in kept:
            d = [sum((a - b) ** 2 for a, b in zip(x, c, strict=True)) for c in cents]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        near = assign()
        for j in range(len(cents)):
            mine = [x for (_, x), (c, _) in zip(kept, near, strict=True) if c == j]
            if mine:
                cents[j] = [sum(col) // len(mine) for col in zip(*mine, strict=True)]
    near = assign()
    total, per = sum(d for _, d in near), Counter()
    for c, d in near:
        per[c] += d
    return sorted((
        (i, c, d, per[c], total, hashlib.sha256(",".join(map(str, cents[c])).encode()).hexdigest())
        for (i, _), (c, d) in zip(kept, near, strict=True)
    ), key=repr)


VECTORS = "vec_id long, embedding array<float>, cluster string, x string, distance string"


def vector_frame(spark, rows):
    return spark.createDataFrame([(i, v, "c", "x", "d") for i, v in rows], VECTORS)


def vector_rows():
    draw = np.random.default_rng(3)
    rows = [(i, draw.normal(size=64).astype(np.float32).tolist()) for i in range(60)]
    rows += [(7, rows[7][1]), (100, rows[3][1]), (None, rows[5][1]), (101, [0.0] * 64), (101, [0.0] * 64)]
    rows += [(200, None), (201, []), (202, [1.0] * 63), (203, [1.0] * 65), (204, [None] + [1.0] * 63)]
    rows += [(205, [float("nan")] + [1.0] * 63), (206, [float("-inf")] + [1.0] * 63), (207, [-1000.25] * 64)]
    return rows


@pytest.mark.parametrize("k", [3, 40, 500])
def test_clusters_equal_full_computation(spark, k):
    rows = vector_rows()
    got = centroids.cluster(vector_frame(spark, rows).repartition(4), k=k)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_clusters(rows, k, 5)


def test_vectors_beyond_exact_distances(spark):
    with pytest.raises(Exception, match="too large"):
        centroids.cluster(vector_frame(spark, [(1, [1e30] * 64)])).collect()


def test_no_vectors(spark):
    assert centroids.cluster(vector_frame(spark, [(1, None)])).collect() == []
    assert centroids.cluster(vector_frame(spark, [])).collect() == []


# --- pieces -----------------------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def encoder():
    return pieces.Encoder(pieces.read_model(MODEL))


def test_documents_equal_the_library(messy, messy_rows, library):
    def digests(text):
        ids = library.encode(text or "", add_eos=True)
        return len(ids), brute.sha(" ".join(map(str, ids))), brute.sha(library.decode(ids))

    got = pieces.encode_pieces(messy, MODEL)
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted((tuple(r) for r in got.select(*names).collect()), key=repr) == sorted(
        ((r[0], *digests(r[1])) for r in messy_rows), key=repr
    )
    row = pieces.encode_pieces(messy.filter("doc_id = 11"), MODEL, with_ids=True).first()
    assert row.ids == library.encode(messy_rows[11][1], add_eos=True)
    assert row.decoded == library.decode(row.ids)


def test_random_texts_equal_the_library(encoder, library):
    draw = random.Random(11)
    alphabet = "ab e  ▁▁thing\n\t\x00é日本語\U0001f600ſ<0x0A></s>' .,123 ﬁщ"
    texts = ["".join(draw.choices(alphabet, k=draw.randint(1, 60))) for _ in range(4000)]
    texts += ["", " ", "  ", "▁", "\n", "a" * 5000, " " * 5000, "ab" * 3000 + "\n" * 50, "word " * 3000]
    for text, ids in zip(texts, library.encode(texts, add_eos=True), strict=True):
        own = encoder.encode(text)
        assert own.tolist() == ids and encoder.decode(own) == library.decode(ids), text[:80]


def test_any_ids_decode_like_the_library(encoder, library):
    draw = random.Random(12)
    pool = [0, 1, 2, 3, 155, 200, 227, 229, 233, 258, 259, 260, 300, 400, 29871, 29872]
    for _ in range(4000):
        ids = draw.choices(pool, k=draw.randint(1, 8))
        assert encoder.decode(np.array(ids)) == library.decode(ids), ids


def tiny_model():
    """Pieces whose longest matches mislead, one that is never reached, a letter that is no piece."""
    words = ["a", "b", "c", "▁", "ab", "bc", "abc", "aab", "bcc", "cab", "▁a", "xb", "abcab"]
    return {
        "pieces": ["<unk>", "<s>", "</s>", *[f"<0x{i:02X}>" for i in range(256)], *words],
        "scores": [0.0] * 259 + [-5.0, -5.0, -5.0, -5.0, -3.0, -1.0, -9.0, -4.0, -4.0, -2.0, -1.0, -6.0, -7.0],
        "normal": [False] * 259 + [True] * len(words),
        "bytes": {i: i + 3 for i in range(256)}, "unknown": [0], "end": 2,
    }


def test_backtracking_equals_merging():
    own = pieces.Encoder(tiny_model())
    draw = random.Random(13)
    for _ in range(3000):
        unit = "".join(draw.choices("abcx▁", k=draw.randint(1, 14)))
        assert [own.text[i] for i in own.encode_unit(unit)] == pieces.merge(unit, own.ranks), unit
    # the letter without a piece of its own is spelled in bytes
    assert own.encode("x").tolist()[-2:] == [3 + ord("x"), 2]


def test_other_models_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    model.ParseFromString(open(MODEL, "rb").read())
    model.normalizer_spec.remove_extra_whitespaces = True
    (tmp_path / "other.model").write_bytes(model.SerializeToString())
    with pytest.raises(ValueError):
        pieces.read_model(str(tmp_path / "other.model"))


def test_memo_is_bounded():
    made = []
    memo = Memo(lambda key: made.append(key) or key * 2, 3, lambda key: key < 100)
    assert [memo[k] for k in (1, 2, 3, 4, 1, 200, 200)] == [2, 4, 6, 8, 2, 400, 400]
    assert made == [1, 2, 3, 4, 200, 200] and len(memo) <= 3 and 200 not in memo


def test_empty_tables(spark, empty):
    assert spelling.group_variants(spelling.word_counts(empty)).columns == COLUMNS
    assert spelling.group_variants(spelling.word_counts(empty)).count() == 0
    assert pieces.encode_pieces(empty, MODEL).collect() == []
    blank = pieces.encode_pieces(empty.select(F.lit(1).alias("doc_id"), "text"), MODEL)
    assert blank.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
