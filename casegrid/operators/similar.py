"""Similarity join for edit distance, in column functions.

Two texts are as alike as 1 - distance / length of the longer one.  From a least
likeness follow a window of lengths and a least number of shared characters:
with at most d edits, all but d characters of the longer text are in the other
one as well, each as often.  Characters with their running number are ordered
from rare to common; two texts that share t of them share at least two among the
first `length - t + 2` of each (prefix filter), or one among the first
`length - t + 1` where t is one.  So an equi-join on pairs of rare characters
finds all candidates, and `levenshtein` judges them inside the join.

Two texts meet under every pair of characters they share.  A key carries the rarer
characters of its text as bits; where both sides hold one more of them, the texts
meet under a rarer key too, and are judged there only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

#: Parts that the rows of one key are dealt out to, as every text may hold it.
SALT = 8
#: Words of 64 bits, and bits of a character: the first, second ... time it occurs.
#: Characters without a bit only let a pair be judged more than once.
WORDS, TIMES = 3, 4
_BITS = [f"_b{w}" for w in range(WORDS)]


def likeness(a: Column | str, b: Column | str) -> Column:
    """1 - edit distance / length of the longer text."""
    return F.lit(1.0) - F.levenshtein(a, b) / F.greatest(F.char_length(a), F.char_length(b))


def rare_first(texts: DataFrame, text: str) -> str:
    """The characters of the texts, from the one that the fewest texts hold on.

    Normalised texts have 37 characters; any other alphabet passes the driver as
    one row a character too.
    """
    held = texts.select(F.explode(F.array_distinct(F.split(text, ""))).alias("c")).filter("c <> ''")
    ranked = held.groupBy("c").agg(F.count(F.lit(1)).alias("n")).orderBy("n", "c")
    return "".join(r["c"] for r in ranked.collect())


def _bit(e: Column, word: int) -> Column:
    """The bit of a character and its running number, 0 where it has none in this word."""
    place = (F.ascii(e["c"]) - F.lit(0x4E00)) * F.lit(TIMES) + e["n"]
    mine = (place >= 64 * word) & (place < 64 * (word + 1)) & (e["n"] < TIMES)
    power = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(place, F.lit(64)).cast("int"))
    return F.when(mine, power).otherwise(F.lit(0).cast("long"))


def _keyed(rows: DataFrame, text: str, rank: str, least: float) -> DataFrame:
    """Rows once for each key of their text, with the key's name `_key` and its bits.

    Keys are pairs of the rarest characters, single ones where few need be shared.
    A character is renamed by its place in `rank`, so that sorting orders by
    rarity; what is not in `rank` comes first and meets nothing.  The bits are
    those of the characters before the last one of the key, but for its own.
    Each step is a column of its own: inside a lambda an expression would be
    worked out again for every element.
    """
    names = "".join(chr(0x4E00 + i) for i in range(len(rank)))
    none = F.lit(0).cast("long")
    size = F.size("_letters")
    # the margin keeps 0.55 * 20 from becoming 12; a smaller number shared only adds candidates
    shared = F.greatest(F.ceil(size * F.lit(least) - F.lit(1e-9)), F.lit(1)).cast("int")
    in_front = F.greatest(size - F.greatest(shared, F.lit(2)) + 2, F.lit(1))

    def element(c: Column, i: Column) -> Column:
        return F.struct(c.alias("c"), (i - F.array_position("_letters", c) + 1).cast("int").alias("n"))

    def named(e: Column) -> Column:
        return F.struct(
            F.concat(e["c"], e["n"].cast("string")).alias("name"),
            *[_bit(e, w).alias(f"b{w}") for w in range(WORDS)],
        )

    def before(i: Column, word: int) -> Column:
        return F.aggregate(F.slice("_own", 1, i), none, lambda acc, e: acc.bitwiseOR(e[f"b{word}"]))

    def with_before(e: Column, i: Column) -> Column:
        return F.struct(
            e["name"].alias("name"), *[e[f"b{w}"].alias(f"b{w}") for w in range(WORDS)],
            *[before(i, w).alias(f"f{w}") for w in range(WORDS)],
        )

    def key(name: Column, last: Column, own: Column | None) -> Column:
        return F.struct(name.alias("_key"), *[
            (last[f"f{w}"] if own is None else last[f"f{w}"].bitwiseAND(F.bitwise_not(own[f"b{w}"]))).alias(b)
            for w, b in enumerate(_BITS)
        ])

    steps = rows.filter(F.col(text) != "").withColumn(
        "_letters", F.array_sort(F.split(F.translate(text, rank, names), ""))
    ).withColumn("_elements", F.transform("_letters", element)).withColumns({
        "_own": F.transform(
            F.slice("_elements", 1, F.when(shared == 1, size).otherwise(F.least(in_front, size))), named
        ),
        "_pairs": F.least(in_front, size), "_single": shared == 1,
    }).withColumn("_all", F.transform("_own", with_before)).withColumn("_front", F.slice("_all", 1, F.col("_pairs")))
    pairs = F.flatten(F.transform(
        "_front", lambda a, i: F.transform(
            F.slice("_front", i + 2, F.col("_pairs")),
            lambda b: key(F.concat(a["name"], F.lit("|"), b["name"]), b, a),
        )
    ))
    single = F.transform("_all", lambda a: key(a["name"], a, None))
    keys = F.when(F.col("_single"), F.concat(single, pairs)).otherwise(pairs)
    return steps.select(*rows.columns, F.inline(keys))


def alike(
    texts: DataFrame, text_id: str, text: str, names: DataFrame, name: str, least: float,
    condition=None,
) -> DataFrame:
    """Every (text row, name row) at least `least` alike, with their likeness as `score`.

    A pair may come out more than once; group it.  `names` is the
    smaller side: it gives the order of the characters and is copied to the SALT
    parts that the keys of the texts are dealt out to.  The planner broadcasts it
    by its written size.  `condition` is one more column expression over both
    sides.  NULL and empty texts and names have no keys and match nothing.
    """
    if not 0 < least <= 1:
        raise ValueError("the least likeness lies between 0 (exclusive) and 1")
    rank = rare_first(names, name)
    theirs = [f"_n{b}" for b in _BITS]
    keyed_names = materialize(
        _keyed(names, name, rank, least).withColumnsRenamed(dict(zip(_BITS, theirs)))
    ).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    keyed = _keyed(texts, text, rank, least).withColumn(
        "_salt", F.pmod(F.xxhash64(text_id), F.lit(SALT)).cast("int")
    )
    both = [F.col(a).bitwiseAND(F.col(b)) for a, b in zip(_BITS, theirs)]
    rarest = both[0].bitwiseOR(both[1]).bitwiseOR(both[2]) == 0
    own, other = F.char_length(text), F.char_length(name)
    fits = F.least(own, other) >= F.greatest(own, other) * F.lit(least) - F.lit(1e-9)
    if condition is not None:
        fits = fits & condition
    return (
        keyed.join(keyed_names, ["_key", "_salt"]).filter(rarest & fits)
        .drop("_key", "_salt", *_BITS, *theirs)
        .withColumn("score", likeness(text, name))
        .filter(F.col("score") >= F.lit(least))
    )
