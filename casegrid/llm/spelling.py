"""Spelling variants: words one inserted, deleted or replaced letter apart.

The letters of a word with their running numbers (the second `a` is an element
of its own) are a binary vector.  A replacement changes two of its elements, an
insertion or a deletion one.  PartEnum partitions the elements and enumerates
what is left without any two (any one) of the parts: two words of one length with
at most two different elements share such a signature exactly, and so do words of
neighbouring lengths with one.  Signatures meet in one equi-join; `levenshtein`
verifies inside it.  A signature also names the half of the word that the one
edit cannot have touched, so that words of the same letters in another order do
not crowd one key.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import lookup, lower_ascii

#: What is not part of a word.  Fixed value (after A-Z are lower-cased).
BREAK = "[^a-zÀ-ÿ]+"
#: Parts of the elements, and how many of them a pair may differ in: words of one
#: length, words of neighbouring lengths.
SAME, NEXT = (4, 2), (2, 1)
#: A key with more words is dealt out in blocks of about this many.
BLOCK = 2000


def word_counts(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", least_length: int = 5,
                least: int = 3, modulus: int = 97) -> DataFrame:
    """(word, n): words of all whole texts, a seeded share of them with one letter deleted.

    Where `modulus` divides the crc32 h of `doc_id:run`, code point h % length is
    deleted.  NULL and empty texts have no words; a NULL id counts as an empty
    one; repeated rows count again; other columns are ignored; an empty table
    gives no rows.
    """
    runs = docs.select(
        F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("doc"),
        F.explode(F.split(lower_ascii(F.col(text)), BREAK)).alias("run"),
    ).filter(F.char_length("run") >= least_length)
    h = F.crc32(F.concat("doc", F.lit(":"), "run"))
    at = (h % F.char_length("run")).cast("int")
    cut = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    word = F.when(h % modulus == 0, cut).otherwise(F.col("run"))
    return (
        runs.select(word.alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
        .filter((F.col("n") >= least) & (F.char_length("word") >= least_length))
    )


def _signatures(elements: Column, side: Column, rest: Column, tag: Column, parts: int, apart: int) -> list[Column]:
    """Key of every choice of parts that may differ, for one half of the word."""
    def part(p: int) -> Column:
        return F.array_join(F.filter(elements, lambda e: F.pmod(F.xxhash64(e), F.lit(parts)) == p), " ")

    of = [part(p) for p in range(parts)]
    return [
        F.xxhash64(tag, F.lit(i), side, rest, *[of[p] for p in kept])
        for i, kept in enumerate(combinations(range(parts), parts - apart))
    ]


def signatures(words: DataFrame) -> DataFrame:
    """(key, role, word, n): role 0 meets 0; 1, the longer word, meets 2, the shorter one.

    Words of one length come with their length as tag; words of neighbouring
    lengths with the greater length, so the shorter one knows where the longer
    one is halved.
    """
    word, length = F.col("word"), F.char_length("word")
    letters = F.array_sort(F.split(word, ""))
    elements = F.transform(
        letters, lambda c, i: F.concat(c, (i - F.array_position(letters, c) + 1).cast("string"))
    )
    rows = words.withColumns({"_length": length, "_elements": elements})
    length, elements = F.col("_length"), F.col("_elements")

    def keys(role: int, tag: Column, start: Column, spec: tuple[int, int], kind: str) -> Column:
        # the first half, and what follows it; the shorter word lacks one letter there
        half = F.floor(tag / 2).cast("int")
        sides = [("first", F.substr(word, F.lit(1), half)), ("last", F.substr(word, start))]
        found = [
            s for side, rest in sides
            for s in _signatures(elements, F.lit(f"{kind} {side}"), rest, tag, *spec)
        ]
        return F.transform(F.array(*found), lambda k: F.struct(k.alias("key"), F.lit(role).alias("role")))

    half, longer = F.floor(length / 2).cast("int"), F.floor((length + 1) / 2).cast("int")
    every = F.concat(
        keys(0, length, half + 1, SAME, "same"),
        keys(1, length, half + 1, NEXT, "next"),
        keys(2, length + 1, longer, NEXT, "next"),
    )
    return rows.select("word", "n", F.explode(every).alias("s")).select("s.key", "s.role", "word", "n")


def near_words(words: DataFrame) -> DataFrame:
    """(word, other, other_n): every pair one edit apart, in both directions."""
    one = F.count(F.lit(1))
    keyed = materialize(signatures(words))
    sizes = keyed.groupBy("key").agg(one.alias("size")).filter("size > 1")
    met = keyed.join(sizes, "key").withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
    left = met.filter("role < 2").select(
        "key", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int").alias("block"),
        F.col("role").alias("left"), "word", "n",
    )
    right = met.filter("role <> 1").select(
        "key", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        F.col("role").alias("right"), F.col("word").alias("other"), F.col("n").alias("other_n"),
    )
    wanted = F.when(F.col("left") == 0, (F.col("right") == 0) & (F.col("word") < F.col("other"))).otherwise(
        F.col("right") == 2
    )
    pairs = left.join(
        right,
        (left["key"] == right["key"]) & (left["block"] == right["block"]) & wanted
        & (F.levenshtein("word", "other", 1) == 1),
    ).select("word", "n", "other", "other_n").distinct()
    pairs = materialize(pairs)
    back = pairs.select(
        F.col("other").alias("word"), F.col("word").alias("other"), F.col("n").alias("other_n")
    )
    return pairs.select("word", "other", "other_n").unionByName(back)


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form) without cycles: every round doubles the steps taken."""
    at = materialize(forms.select("word", F.col("form").alias("at")))
    while True:
        total = at.count()
        asked = at.groupBy("at").agg(F.count(F.lit(1)).alias("asked"))
        following = at.select(F.col("word").alias("at"), F.col("at").alias("following")).join(asked, "at")
        moved = materialize(lookup(at, following, ["at"], "asked", total))
        at = moved.select("word", F.coalesce("following", "at").alias("at"))
        if not moved.filter("following is not null").limit(1).count():
            return at.select("word", F.col("at").alias("root"))


def group_variants(words: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of distinct words and their counts (word, n).

    Near words differ by one inserted, deleted or replaced code point.  The form is
    the near word of largest n (ties: smallest in code-point order) if that is at
    least twice the word's n; the root is where forms lead to in the end.  Words
    of any length are compared whole; NULL words are left out; an empty table
    gives no rows; other columns are ignored.
    """
    words = materialize(words.filter("word is not null").select("word", "n"))
    best = F.min(F.struct((-F.col("other_n")).alias("minus"), "other")).alias("best")
    near = near_words(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    has = -F.col("best.minus") >= 2 * F.col("n")
    found = materialize(
        words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(has, F.col("best.other")).alias("form"),
            F.when(has, -F.col("best.minus")).alias("form_n"),
        )
    )
    ends = roots(found.filter("form is not null").select("word", "form"))
    return found.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
