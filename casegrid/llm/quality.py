"""Quality rules: a threshold table compiled into one projection.

Every measure is a column expression over the whole text, every rule one
comparison, and the verdict one conjunction: no shuffle, no user function.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import GAP, whole, words

#: Common words of the four languages of the corpus.  Fixed value.
STOP_WORDS = (
    "a and are as at be by for from in is it of on or that the this to was with "
    "als auch auf das dem den der des die ein eine für im ist mit nicht sich und von zu "
    "au dans de du en est et la le les par pas pour que qui sur un une "
    "al como con del el las lo los no para por se su una y"
).split()
SYMBOLS = "#*$%&|<>"
REPEAT_WINDOW = 8


@dataclass(frozen=True)
class Rule:
    """A document fails if `measure` is below `least` or above `most`.

    The rule is asked of documents of `words` words or more only, because a
    ratio over a handful of words says nothing.
    """

    name: str
    measure: str
    least: float | None = None
    most: float | None = None
    words: int = 0


RULES = (
    Rule("symbols", "symbol_ratio", most=0.1),
    Rule("shouting", "exclamation_ratio", most=0.3),
    Rule("stop_words", "stop_word_ratio", least=0.04, words=30),
    Rule("repeated_words", "adjacent_ratio", most=0.3),
    Rule("duplicate_lines", "dup_line_ratio", most=0.5),
    Rule("long_words", "mean_word_chars", most=15.0),
)


def _repeat_positions(df: DataFrame) -> DataFrame:
    """n_repeat_words: words inside a window of eight that the text holds twice.

    A window is one 64-bit hash of its words.  Most texts have no repeated
    window, which a distinct count shows; only the others sort their windows.
    """
    n = F.size("_words")
    df = df.withColumn(
        "_hashes",
        F.when(n < REPEAT_WINDOW, F.array().cast("array<bigint>")).otherwise(
            F.transform(
                F.sequence(F.lit(1), F.greatest(n - (REPEAT_WINDOW - 1), F.lit(1))),
                lambda i: F.xxhash64(F.slice("_words", i, REPEAT_WINDOW)),
            )
        ),
    )
    df = df.withColumn(
        "_sorted",
        F.when(
            F.size(F.array_distinct("_hashes")) < F.size("_hashes"),
            F.sort_array(F.transform("_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    )
    last = F.size("_sorted") - 1
    at = lambda k: F.get("_sorted", k)["h"]
    repeated = F.filter(
        "_sorted",
        lambda e, k: ((k > 0) & (at(k - 1) == e["h"])) | ((k < last) & (at(k + 1) == e["h"])),
    )
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
    covered = F.aggregate(
        F.sort_array(F.transform(repeated, lambda e: e["i"])),
        start,
        lambda a, i: F.struct(
            (a["n"] + REPEAT_WINDOW + i - F.greatest(a["end"], i)).alias("n"),
            (i + REPEAT_WINDOW).alias("end"),
        ),
        lambda a: a["n"],
    )
    return df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long")))


#: Names of the ratios that rules can ask for.
RATIOS = (
    "symbol_ratio", "exclamation_ratio", "stop_word_ratio", "adjacent_ratio", "dup_line_ratio", "mean_word_chars",
)


def _measures() -> dict[str, Column]:
    per_word = lambda c: F.col(c) / F.greatest("n_words", F.lit(1))
    return {
        "symbol_ratio": per_word("n_symbols"),
        "exclamation_ratio": per_word("_exclamations"),
        "stop_word_ratio": per_word("_stops"),
        "adjacent_ratio": per_word("_adjacent"),
        "dup_line_ratio": F.col("n_dup_lines") / F.greatest("_lines", F.lit(1)),
        "mean_word_chars": per_word("word_chars"),
    }


def _passes(rule: Rule) -> Column:
    value, tests = F.col(rule.measure), []
    if rule.least is not None:
        tests.append(value < rule.least)
    if rule.most is not None:
        tests.append(value > rule.most)
    failed = tests[0] if len(tests) == 1 else tests[0] | tests[1]
    return ~((F.col("n_words") >= rule.words) & failed)


def quality(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Add counts, ratios, `base_failed` and `kept` to every row.

    A NULL or empty text has no words and fails; texts of any length are measured
    whole.  Repeated rows are judged each on its own; an empty table gives an
    empty one.  Columns of the input keep their values, whatever their names,
    unless they have the name of a measure, which is replaced.
    """
    drop = lambda chars: F.translate("_text", chars, "")
    n_chars = F.char_length("_text")
    has_word = lambda line: F.length(F.regexp_replace(line, GAP, "")) > 0
    made = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", *RATIOS,
            "base_failed", "kept"]
    # the input goes along under numbered names, so that no name of it can meet one made here
    held = {c: f"_in{i}" for i, c in enumerate(docs.columns) if c not in made}
    df = docs.select(whole(text).alias("_text"), *[F.col(f"`{c}`").alias(n) for c, n in held.items()])
    df = df.withColumns({
        "_words": words(F.col("_text")),
        "_split": F.filter(F.split("_text", "\n"), has_word),
    })
    df = _repeat_positions(df)
    stops = F.array(*(F.lit(w) for w in STOP_WORDS))
    df = df.withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.char_length(drop(" \t\n\x0b\x0c\r")).cast("long"),
        "n_symbols": (n_chars - F.char_length(drop(SYMBOLS))).cast("long"),
        "n_dup_lines": (F.size("_split") - F.size(F.array_distinct("_split"))).cast("long"),
        "_lines": F.size("_split"),
        "_exclamations": n_chars - F.char_length(drop("!")),
        "_stops": F.size(F.filter("_words", lambda w: F.lower(w).isin(STOP_WORDS))),
        "_adjacent": F.size(F.filter("_words", lambda w, i: (i > 0) & (F.get("_words", i - 1) == w))),
    })
    df = df.withColumns(_measures())
    base_failed = (F.col("n_words") < 20) | (
        F.lit(100) * F.col("n_repeat_words") > F.lit(30) * F.col("n_words")
    )
    verdict = _passes(rules[0]) if rules else F.lit(True)
    for rule in rules[1:]:
        verdict = verdict & _passes(rule)
    # Always true, but not deterministic to the optimizer: a filter on the result
    # is then not pushed below the arrays, where it would compute them per element.
    here = F.monotonically_increasing_id() >= 0
    df = df.withColumns({"base_failed": base_failed, "kept": ~base_failed & verdict & here})
    return df.select(*(F.col(n).alias(c) for c, n in held.items()), *made)
