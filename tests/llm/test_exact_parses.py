"""Cross-parsing over segment cuts, fingerprints that grow, formats left out of training."""

import random

import numpy as np
import pytest

from casegrid.llm import fingerprint, language, secrets


def greedy(sample, text):
    """Phrases of the longest match, one after the other; an unknown character is one."""
    n = i = 0
    while i < len(text):
        j = i + 1
        while j < len(text) and text[i : j + 1] in sample:
            j += 1
        n, i = n + 1, j
    return n


@pytest.mark.parametrize("segment", [1, 3, 7, 16, 1024])
def test_phrases_over_cuts_are_exact(monkeypatch, segment):
    monkeypatch.setattr(language, "SEGMENT", segment)
    monkeypatch.setattr(language, "ALPHABET", 4)
    draw = random.Random(5)
    samples = {k: "".join(draw.choices("abcdé ", k=300)) for k in "xyz"}
    parser = language.CrossParser(samples)
    texts = ["".join(draw.choices("abcdeé ", k=draw.randint(0, 300))) for _ in range(120)]
    texts += [samples["x"] * 3, "", "a" * 100, (samples["y"][5:200] + "q") * 4]
    got = parser.phrases(parser.table(), [parser.codes(t) for t in texts])
    plain = {k: language.plain(v) for k, v in samples.items()}
    want = [[greedy(plain[k], language.plain(t)) for k in parser.languages] for t in texts]
    assert got.tolist() == want


def test_sample_has_a_bound_on_languages(spark, monkeypatch):
    monkeypatch.setattr(language, "LANGUAGES", 3)
    rows = [(i, f"text {i} of a language", f"l{i % 10 if i < 40 else 0}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert sorted(language.sample(docs, "text", "lang", "doc_id")) == ["l0", "l1", "l2"]


def test_likeness_of_many_phrases_is_near_the_exact_share(monkeypatch):
    draw = np.random.default_rng(1)
    letters = list("abcdefghijklmnop ")
    errors = []
    for n in (2_000, 20_000, 100_000):
        for share in (0.25, 0.5, 0.9):
            text = "".join(draw.choice(letters, n))
            other = text[: int(n * share)] + "".join(draw.choice(letters, n - int(n * share)))
            near = fingerprint.likeness(*fingerprint.parse([text, other]))
            with monkeypatch.context() as all_kept:
                all_kept.setattr(fingerprint, "KEPT", 10**9)
                exact = fingerprint.likeness(*fingerprint.parse([text, other]))
            errors.append(abs(near - exact))
    assert max(errors) < 0.08 and np.mean(errors) < 0.03


def test_fingerprints_grow_with_the_text():
    draw = np.random.default_rng(2)
    small, large = ("".join(draw.choice(list("abcdefgh "), n)) for n in (200, 50_000))
    a, b = fingerprint.parse([small, large])
    assert all(whole for _, whole in a[1]) and not any(whole for _, whole in b[1][:1])
    assert len(b[1][0][0]) > 4 * fingerprint.KEPT
    text = fingerprint.to_text(b).split(".")
    assert len(text[0]) == 16 and [len(t) for t in text[1:]] == [8 * len(names) for names, _ in b[1]]


#: Formats that the network is not trained on.
UNSEEN = (
    ("key ", "dop_v1_", "0123456789abcdefghij", 56, 56), ("use ", "SG.", secrets._ALNUM + "_-.", 60, 66),
    ("signed ", "", secrets._ALNUM + "+/", 44, 44), ("hook ", "whsec_", secrets._ALNUM, 32, 32),
)


def test_unseen_formats_are_found(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    detector = secrets.train(secrets.labelled_findings(docs, "text", "doc_id"))
    draw, found, total = random.Random(3), 0, 0
    plain = [
        "see https://www.example.com/some/path/index-2.html today", "id 123e4567-e89b-12d3-a456-426614174000 here",
        "on 2024-01-05T10.20.30 it was", "the file /usr/share/doc/readme-1.2.txt is", "call +44-20-7946-0958 now",
    ]
    for before, prefix, alphabet, least, most in UNSEEN:
        for _ in range(40):
            word = prefix + "".join(draw.choices(alphabet, k=draw.randint(least, most)))
            text = f"please {before}{word} and go on"
            seen = [secrets.windows(text, a, b) for a, _, b in secrets.token_spans(text, secrets.base_spans(text))]
            total += len(seen)
            found += int((detector.probabilities(seen) >= detector.thresholds["token"]).sum())
    assert total >= 100 and found >= 0.98 * total
    for text in plain:
        seen = [secrets.windows(text, a, b) for a, _, b in secrets.token_spans(text, secrets.base_spans(text))]
        assert not (detector.probabilities(seen) >= detector.thresholds["token"]).any(), text


def test_secret_net_learns_from_all_documents(spark, monkeypatch):
    """Every finding is in some shard, shards are bounded, and a rerun gives the same network."""
    monkeypatch.setattr(secrets, "SHARD", 500)
    monkeypatch.setattr(secrets, "EPOCHS", 2)
    letters = str.maketrans("0123456789", "GhIjKlMnOp")
    key = lambda i: f"{i * 7919:036d}".translate(letters)
    docs = spark.createDataFrame(
        [(i, f"login of user {i} is here today ghp_{key(i)} and id {i:014d} stays") for i in range(9000)],
        "doc_id long, text string",
    ).repartition(4)
    findings = secrets.labelled_findings(docs, "text", "doc_id")
    assert findings.own.select("window").filter("kind = 'token' and label = 1").distinct().count() == 9000
    one, two = (secrets.train(secrets.labelled_findings(d, "text", "doc_id")) for d in (docs, docs.repartition(3)))
    assert all((one.net.p[k] == two.net.p[k]).all() for k in one.net.p)
    assert one.thresholds == two.thresholds
