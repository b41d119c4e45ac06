"""Columns of the input whose names operators use themselves, and very long rows."""

import random
import time
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from casegrid.llm import chat, html_text, jaccard, lines, mixing, quality
from tests.llm.conftest import BODY, LINE, frame

FOLDER = "/root/testdata/sf0.01"
#: Working names of the operators, past and present.
NAMES = (
    "_doc _row _hash _split _keep _positions _id _source _copy _n _of _repeats _head _text _words _hashes "
    "_sorted _lines _stops _adjacent _exclamations _in in id hash split runs doc row copy n of key_id key_row "
    "key_of equals repeats h1 h2 last docs size h range whole rest extra node head comp least rows d1 d2 e pos "
    "key through target word_chars_ _hot".split()
)


@pytest.fixture(scope="module")
def plain(spark):
    rows = [(i, f"{BODY}\n{LINE}\nown line number {i} of a document" if i % 3 else BODY, "en", "ab"[i % 2]) for i in range(12)]
    rows += [(50, None), (51, ""), (52, "few words"), (3, f"{BODY}\n{LINE}\nanother text under a used id", "en", "a")]
    return frame(spark, rows).select("doc_id", "text", "lang", "source", "n_chars")


def named(df):
    return df.withColumns({n: F.concat(F.lit(f"{n}:"), F.xxhash64("text").cast("string")) for n in NAMES})


@pytest.mark.parametrize("stage", [fn for _, fn in corpus_pipeline.STAGES[:-1]], ids=[n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_stages_keep_columns_of_any_name(spark, plain, stage):
    docs = named(plain)
    got, want = stage(spark, docs, ""), stage(spark, plain, "")
    assert got.columns == docs.columns
    rows, bare = got.collect(), want.collect()
    assert sorted((tuple(r)[:5] for r in rows), key=repr) == sorted(map(tuple, bare), key=repr)
    before = {(r.doc_id, r.source, r.n_chars): set() for r in docs.collect()}
    for r in docs.collect():
        before[r.doc_id, r.source, r.n_chars].add(tuple(r[n] for n in NAMES))
    for r in rows:
        assert any(tuple(r[n] for n in NAMES) in kept for kept in before.values())
        assert all(r[n] is None or r[n].startswith(f"{n}:") for n in NAMES)


def test_operators_keep_columns_of_any_name(plain):
    docs = named(plain)
    for fn in (lines.dedup_lines, mixing.repeated, jaccard.first_of_groups, quality.quality):
        out = fn(docs)
        assert [c for c in out.columns if c in docs.columns] == docs.columns
        for r in out.select("text", *NAMES).collect():
            assert all(r[n] is None or r[n].startswith(f"{n}:") for n in NAMES), fn


def test_runs(spark):
    draw = random.Random(4)
    cases = [sorted(draw.sample(range(30), draw.randint(1, 30))) for _ in range(200)] + [[0], [29], list(range(30))]
    df = spark.createDataFrame([(c,) for c in cases], "p array<int>")
    for r in df.withColumn("runs", lines.runs_of(F.col("p"))).collect():
        at, dropped = 0, []
        for k, n in enumerate(r.runs):
            dropped += range(at, at + n) if k % 2 else []
            at += n
        assert dropped == r.p and all(n > 0 for n in r.runs[1:])


def test_a_document_of_many_lines(spark):
    shared = [f"a line that three documents hold, number {i}" for i in range(60_000)]
    mixed = "\n".join(x for i, line in enumerate(shared) for x in (line, f"{i}"))
    rows = [(1, mixed), (2, "\n".join(shared)), (3, "\n".join(shared))]
    start = time.time()
    got = {r.doc_id: r for r in lines.dedup_lines(frame(spark, rows)).collect()}
    assert time.time() - start < 60
    assert (got[1].n_lines, got[1].n_dropped) == (120_000, 60_000)
    assert got[1].kept_text == "\n".join(str(i) for i in range(60_000))
    assert got[2].kept_text == "" and got[3].n_dropped == 0


def test_a_conversation_of_many_turns(spark):
    n = 20_000
    turns = spark.range(n).select(
        F.lit(1).alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
        chat.text_part(F.concat(F.lit("text "), F.col("id").cast("string"))).alias("parts"),
    )
    start = time.time()
    row = chat.format_chat(turns).first()
    assert time.time() - start < 60
    said = [row.formatted[s.start : s.end] for s in row.loss_spans]
    assert said == [f"text {i}" for i in range(1, n, 2)]


# --- HTML --------------------------------------------------------------------------------


class Cutter(HTMLParser):
    """Block texts by the standard library's parser; `article` collects those inside one."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts, self.out, self.silent, self.depth, self.inside = [], [], 0, 0, []

    def flush(self):
        text = " ".join("".join(self.parts).split())
        if text:
            self.out.append(text)
            self.inside.append(self.depth > 0)
        self.parts = []

    def handle_starttag(self, tag, attrs):
        if tag in html_text.BLOCK_TAGS:
            self.flush()
        self.silent += tag in html_text.SILENT_TAGS and tag not in ("head",)
        self.depth += tag == "article"

    def handle_endtag(self, tag):
        if tag in html_text.BLOCK_TAGS:
            self.flush()
        self.silent -= tag in html_text.SILENT_TAGS and tag not in ("head",)
        self.depth -= tag == "article"

    def handle_data(self, data):
        if not self.silent:
            self.parts.append(data)


def cut(page):
    cutter = Cutter()
    cutter.feed(page)
    cutter.close()
    cutter.flush()
    return cutter


def test_blocks_equal_a_plain_cutter(spark):
    for r in spark.read.parquet(f"{FOLDER}/pages.parquet").select("html").collect():
        assert [b.text for b in html_text.blocks(r.html)] == cut(r.html).out


def test_share_of_kept_and_foreign_words(spark):
    """Main text of the given pages: what stands in their article element."""
    tree, kept, wanted, found = html_text.grow(html_text.LABELLED), 0, 0, 0
    for r in spark.read.parquet(f"{FOLDER}/pages.parquet").select("html").collect():
        plain = cut(r.html)
        want = " ".join(t for t, inside in zip(plain.out, plain.inside, strict=True) if inside).split()
        got = html_text.main_text(r.html, tree).split()
        wanted, found = wanted + len(want), found + len(got)
        kept += sum(1 for a, b in zip(want, got, strict=False) if a == b) if len(want) != len(got) else len(want)
    assert kept / wanted > 0.99 and kept / found > 0.99


def test_quotes_outside_values():
    tree = html_text.grow(html_text.LABELLED)
    text = "a plain sentence of an article that has words enough to be one of its paragraphs"
    for page in (
        f"<p title=don't>{text}</p><p>It's {text}</p>", f"<p title=\"don't\">{text}</p><p>It's {text}</p>",
        f"<p data-x='a \"b\" c'>{text}</p><p>It's {text}</p>", f"<p it's \"odd\">{text}</p><p>It's {text}</p>",
    ):
        assert html_text.main_text(page, tree) == f"{text} It's {text}", page
    assert html_text.main_text("<div><p>Short answer only.</p></div>", tree) == "Short answer only."


def test_link_lists_in_an_article():
    tree = html_text.grow(html_text.LABELLED)
    text = "words of a paragraph " * 8
    links = "".join(f"<li><a href=/{i}>Read more {i}</a></li>" for i in range(6))
    page = f"<article><p>{text}</p><ul>{links}</ul><p>{text}</p><p>One <a href=/x>linked</a> word more.</p></article>"
    got = html_text.main_text(page, tree)
    assert "Read more" not in got.replace("Read more 0", "") and got.endswith("One linked word more.")


@pytest.mark.parametrize("page", [
    "<div>" * 40_000 + "text", "<b>" * 40_000 + "text", "<div class=ad>x" * 40_000, "<i></b>" * 40_000,
    "<b><div>" + "<i>" * 40_000 + "</b>" * 40_000, "<div>" * 40_000 + "</p>" * 40_000, '<p a="' * 40_000,
])
def test_pages_of_many_open_elements(page):
    start = time.time()
    html_text.blocks(page)
    assert time.time() - start < 5
