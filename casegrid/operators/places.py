"""Free-text place -> city, district, barangay and position.

Rules run from cheap to dear on the *distinct* texts; each text stops at the
first rule that fits:

1. a named venue;
2. with a hint at the home city: the first keyword of an ordered list (0.95);
3. then a home district whose alias occurs in the text, or holds or is held by
   one of the text's tail phrases (0.90);
4. then a home district or barangay whose alias occurs in a tail phrase (0.85);
5. the best similarity per level, if it reaches the level's threshold;
6. with the hint: the home city at no less than 0.55;
7. else the better of district and city from 0.4 up.

Similarity is 1 for an alias inside the text, else the match ratio of longest
common blocks (`similarity="ratio"`, every text against every alias in bounded
blocks) or 1 - edit distance / longer length (`similarity="edit"`, a similarity
join in column functions, for tables of any size).
"""

from __future__ import annotations

from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.text import any_of, city_label, normalize_text, tail_phrases
from ..functions.text import district_from_keyword
from ..session import cut_lineage, materialize
from .gazetteer import contained_aliases
from .lookups import lookup
from .pairwise import block_count, compare_blocks
from .similar import alike

_TEXT_BLOCK = 2000
_ALIAS_BLOCK = 20_000
_PLACE = ["city", "district", "barangay", "latitude", "longitude", "level"]


def _letter_counts(texts) -> np.ndarray:
    return np.array(
        [np.bincount(np.frombuffer(t.encode("ascii"), np.uint8), minlength=128) for t in texts]
    )


def similarity_kernel(texts: pd.DataFrame, aliases: pd.DataFrame) -> pd.DataFrame:
    """Best alias per text and level: containment scores 1, else the match ratio.

    The letters two texts share bound their ratio from above.  Aliases are
    tried from the greatest bound down and left out once it cannot reach the
    best ratio so far, or a ratio that the level accepts; with the home hint any
    ratio may decide.  So the place that is accepted equals the full comparison.
    """
    # a barangay has no fallback: below its threshold it is never taken
    least = dict.fromkeys(K.LEVEL_THRESHOLDS, K.FALLBACK_THRESHOLD)
    least["barangay"] = K.LEVEL_THRESHOLDS["barangay"]
    table = aliases.sort_values(["ordinal", "alias"]).reset_index(drop=True)
    names, ordinals = table["alias"].tolist(), table["ordinal"].tolist()
    counts, lengths = _letter_counts(names), table["alias"].str.len().to_numpy()
    home = table["home"].to_numpy(dtype=bool)
    levels = {lv: np.flatnonzero(table["level"] == lv) for lv in table["level"].unique()}
    text_counts = _letter_counts(texts["norm"])
    out = []
    for t, own in zip(texts.itertuples(index=False), text_counts):
        matcher = SequenceMatcher(None, "", t.norm)
        bound = 2.0 * np.minimum(counts, own).sum(axis=1) / (lengths + len(t.norm))
        for level, members in levels.items():
            if t.hint:
                members = members[home[members]]
            inside = next((i for i in members if names[i] in t.norm), None)
            if inside is not None:
                out.append((t.norm, t.hint, level, 1.0, ordinals[inside]))
                continue
            best = (0.0, "")
            for i in members[np.argsort(-bound[members], kind="stable")]:
                if bound[i] == 0.0 or bound[i] < best[0] or not t.hint and bound[i] < least[level]:
                    break
                matcher.set_seq1(names[i])
                score = matcher.ratio()
                if score > best[0] or (score == best[0] > 0.0 and ordinals[i] < best[1]):
                    best = (score, ordinals[i])
            if best[0] > 0.0:
                out.append((t.norm, t.hint, level, *best))
    return pd.DataFrame(out, columns=["norm", "hint", "level", "score", "ordinal"])


def best_similar(texts: DataFrame, aliases: DataFrame) -> DataFrame:
    """(norm, hint, level, score, ordinal): best alias of each level."""
    texts, aliases = cut_lineage(texts), cut_lineage(aliases)
    tasks = texts.sparkSession.sparkContext.defaultParallelism
    parts = compare_blocks(
        texts, aliases, similarity_kernel,
        "norm string, hint boolean, level string, score double, ordinal string",
        block_count(texts.count(), _TEXT_BLOCK, 4 * tasks, 8),
        block_count(aliases.count(), _ALIAS_BLOCK),
        "norm", "alias",
    )
    least = F.min(F.struct((-F.col("score")).alias("s"), "ordinal"))
    return parts.groupBy("norm", "hint", "level").agg(least.alias("b")).select(
        "norm", "hint", "level", (-F.col("b.s")).alias("score"),
        F.col("b.ordinal").alias("ordinal"),
    )


def _venue(norm: Column, rules) -> Column:
    """Struct of the first venue rule that fits, else NULL."""
    none = F.lit(None).cast("string")
    picked = [
        F.when(
            norm.rlike(any_of(r["aliases"])),
            F.struct(
                F.lit(r["city"]).alias("city"), F.lit(r["district"]).alias("district"),
                none.alias("barangay"), F.lit(r["latitude"]).alias("latitude"),
                F.lit(r["longitude"]).alias("longitude"), F.lit(r["level"]).alias("level"),
                F.lit(r["score"]).alias("score"),
            ),
        )
        for r in rules
    ]
    return F.coalesce(*picked)


def _first(found: DataFrame, score: float, keep: list[str]) -> DataFrame:
    fields = ["ordinal", *_PLACE]
    return found.groupBy(*keep).agg(F.min(F.struct(*fields)).alias("p")).select(
        *keep, *[F.col(f"p.{c}").alias(c) for c in _PLACE], F.lit(score).alias("score")
    )


def match_distinct_texts(
    texts: DataFrame, raw: str, aliases: DataFrame, home_city=K.HOME_CITY,
    keywords=K.DISTRICT_KEYWORDS, venues=K.VENUE_RULES, similarity: str = "ratio",
) -> DataFrame:
    """One row per distinct text with the place it was matched to, if any."""
    if similarity not in ("ratio", "edit"):
        raise ValueError("similarity is 'ratio' or 'edit'")
    home = home_city.lower()
    words = [w for w, _ in keywords]
    is_home = F.lower("city") == home
    # rows: place fields of an alias entry
    entries = cut_lineage(aliases.withColumn("home", is_home))
    norm = F.col("norm")
    todo = cut_lineage(
        texts.select(F.col(raw).alias("raw"))
        .filter(F.col("raw").isNotNull())
        .distinct()
        .withColumn("norm", normalize_text("raw"))
        .filter(norm != "")
        .withColumns(
            {
                "tails": tail_phrases("raw"),
                "hint": F.contains(norm, F.lit(home)) | (
                    norm.rlike(any_of(words)) if words else F.lit(False)
                ),
                "venue": _venue(norm, venues) if venues else F.lit(None),
            }
        )
    )
    done = []
    if venues:
        done.append(todo.filter(F.col("venue").isNotNull()).select("raw", "venue.*"))
        todo = todo.filter(F.col("venue").isNull())
    todo = todo.drop("venue")

    def settle(found: DataFrame) -> None:
        nonlocal todo
        found = cut_lineage(found)
        done.append(found)
        todo = todo.join(found.select("raw"), "raw", "left_anti")

    home_districts = entries.filter(F.col("home") & (F.col("level") == "district"))
    if keywords:
        named = home_districts.filter(F.lower("district").isin([d.lower() for _, d in keywords]))
        by_name = cut_lineage(
            named.groupBy(F.lower("district").alias("_name"))
            .agg(F.min(F.struct("ordinal", *_PLACE)).alias("p"))
            .select("_name", *[F.col(f"p.{c}").alias(c) for c in _PLACE])
        )
        present = {r["_name"] for r in by_name.select("_name").collect()}  # <= keywords
        rules = [(w, d.lower()) for w, d in keywords if d.lower() in present]
        if rules:
            keyed = todo.filter("hint").withColumn(
                "_name", district_from_keyword("norm", "tails", rules)
            )
            settle(
                keyed.join(by_name, "_name")
                .select("raw", *_PLACE, F.lit(K.KEYWORD_SCORE).alias("score"))
            )

    # home district aliases: inside the text, or holding a tail phrase
    fields = ["ordinal", "alias", *_PLACE]
    hinted = todo.filter("hint").select("raw", "norm", "tails")
    inside = contained_aliases(
        hinted.select("raw", "norm"), "raw", "norm", home_districts.select(*fields)
    ).select("raw", "ordinal", *_PLACE)
    phrases = hinted.select(F.explode("tails").alias("alias")).distinct()
    holders = contained_aliases(
        home_districts.select(F.col("alias").alias("held_by"), "ordinal", *_PLACE),
        "held_by", "held_by", phrases,
    )
    around = (
        hinted.select("raw", F.explode("tails").alias("alias"))
        .join(holders, "alias").select("raw", "ordinal", *_PLACE)
    )
    settle(_first(inside.unionByName(around), K.DISTRICT_ALIAS_SCORE, ["raw"]))

    # home district and barangay aliases inside a tail phrase
    tails = todo.filter("hint").select("raw", F.explode("tails").alias("phrase"))
    units = entries.filter(F.col("home") & (F.col("level") != "city"))
    in_tail = contained_aliases(
        tails.select("phrase").distinct(), "phrase", "phrase", units.select(*fields)
    )
    settle(
        _first(
            tails.join(in_tail, "phrase").select("raw", "ordinal", *_PLACE),
            K.TAIL_ALIAS_SCORE, ["raw"],
        )
    )

    # similarity for what is left
    left = todo.select("raw", "norm", "hint")
    names = entries.select("ordinal", "level", "alias", "home")
    if similarity == "edit":
        picked = _edit_picks(left.select("norm", "hint").distinct(), names)
        done.append(_picked_places(left, picked, entries, home_city))
    else:
        scored = cut_lineage(best_similar(left.select("norm", "hint").distinct(), names))
        done.append(_by_similarity(left, scored, entries, home_city))
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def _edit_picks(texts: DataFrame, names: DataFrame) -> DataFrame:
    """(norm, ordinal, score): the accepted place of each text by edit distance.

    Levels are asked in order of acceptance, each at its own threshold, and a text
    that is settled goes no further; so the loose thresholds, whose joins find the
    most candidates, see only what the strict ones left.
    """
    todo, names = materialize(texts), materialize(names)
    allowed = ~F.col("hint") | F.col("home")
    inside = materialize(
        contained_aliases(todo, "norm", "norm", names).filter(allowed)
        .groupBy("norm", "level").agg(F.min("ordinal").alias("ordinal"))
        .withColumn("score", F.lit(1.0))
    )
    order = {"barangay": 0, "district": 1, "city": 2}
    rank = F.coalesce(*[F.when(F.col("level") == lv, F.lit(i)) for lv, i in order.items()])
    picked = []

    def settle(levels: tuple[str, ...], least: float, rows: DataFrame, by_score: bool = False) -> None:
        nonlocal todo
        of_levels = F.col("level").isin(*levels)
        found = alike(rows, "norm", "norm", names.filter(of_levels), "alias", least, allowed)
        found = found.select("norm", "level", "ordinal", "score").unionByName(
            inside.filter(of_levels).join(rows.select("norm"), "norm", "left_semi")
            .select("norm", "level", "ordinal", "score")
        )
        worse = (-F.col("score")).alias("worse")
        key = F.struct(worse, rank.alias("rank"), "ordinal") if by_score else F.struct(
            rank.alias("rank"), worse, "ordinal"
        )
        best = found.groupBy("norm").agg(F.min(key).alias("p"))
        best = materialize(best.select("norm", "p.ordinal", (-F.col("p.worse")).alias("score")))
        picked.append(best)
        todo = todo.join(best.select("norm"), "norm", "left_anti")

    limits = K.LEVEL_THRESHOLDS
    settle(("barangay",), limits["barangay"], todo)
    settle(("district",), limits["district"], todo)
    settle(("city",), limits["city"], todo)
    # a text with the home hint falls back on the home city instead
    settle(("district", "city"), K.FALLBACK_THRESHOLD, todo.filter(~F.col("hint")), by_score=True)
    out = picked[0]
    for part in picked[1:]:
        out = out.unionByName(part)
    return out


def _picked_places(
    left: DataFrame, picked: DataFrame, entries: DataFrame, home_city: str
) -> DataFrame:
    """Fields of the picked places; the home city for what the hint alone is left of."""
    places = entries.groupBy("ordinal").agg(*[F.first(c).alias(c) for c in _PLACE])
    found = left.join(picked, "norm").join(places, "ordinal").select(
        "raw", *_PLACE, F.round("score", 3).alias("score")
    )
    home = entries.filter(F.col("home") & (F.col("level") != "barangay")).agg(
        F.min(F.struct((F.col("level") != "city").alias("other"), "ordinal", *_PLACE)).alias("h")
    )
    forced = left.filter("hint").join(picked.select("norm"), "norm", "left_anti")
    # one row: the city's own entry, a district's where it has none, else NULL
    return found.unionByName(
        forced.join(F.broadcast(home)).select(
            "raw", F.lit(home_city).alias("city"), "h.district", "h.barangay", "h.latitude",
            "h.longitude", F.coalesce("h.level", F.lit("city")).alias("level"),
            F.lit(K.HOME_FLOOR_SCORE).alias("score"),
        )
    )


def _by_similarity(
    left: DataFrame, scored: DataFrame, entries: DataFrame, home_city: str
) -> DataFrame:
    levels = ("barangay", "district", "city")
    best = scored.groupBy("norm", "hint").agg(
        *[
            F.max(F.when(F.col("level") == lv, F.struct("score", "ordinal"))).alias(lv)
            for lv in levels
        ]
    )
    accepted = F.coalesce(
        *[
            F.when(F.col(f"{lv}.score") >= K.LEVEL_THRESHOLDS[lv], F.col(lv))
            for lv in levels
        ]
    )
    district_wins = F.coalesce(F.col("district.score"), F.lit(0.0)) >= F.coalesce(
        F.col("city.score"), F.lit(0.0)
    )
    better = F.when(district_wins, F.col("district")).otherwise(F.col("city"))
    fallback = F.when(better["score"] >= K.FALLBACK_THRESHOLD, better)
    home_entry = F.coalesce(F.col("city"), F.col("district"))
    home_score = F.greatest(F.coalesce(F.col("city.score"), F.lit(0.0)), F.lit(K.HOME_FLOOR_SCORE))
    forced = F.col("hint") & F.col("_accepted").isNull()
    pick = best.withColumn("_accepted", accepted).select(
        "norm", "hint", forced.alias("forced"),
        F.when(forced, home_entry["ordinal"])
        .otherwise(F.coalesce("_accepted", fallback)["ordinal"]).alias("ordinal"),
        F.round(
            F.when(forced, home_score)
            .otherwise(F.coalesce("_accepted", fallback)["score"]), 3
        ).alias("score"),
    )
    places = entries.groupBy("ordinal").agg(
        *[F.first(c).alias(c) for c in _PLACE]
    )
    matched = (
        left.join(pick, ["norm", "hint"], "left")
        .join(places, "ordinal", "left")
    )
    unmatched_home = F.col("hint") & F.col("ordinal").isNull()
    out = matched.withColumns(
        {
            "city": F.when(F.col("forced") | unmatched_home, home_city)
            .otherwise(F.col("city")),
            "level": F.when(unmatched_home, "city").otherwise(F.col("level")),
            "score": F.when(unmatched_home, K.HOME_FLOOR_SCORE).otherwise(F.col("score")),
        }
    )
    return out.filter(F.col("level").isNotNull()).select("raw", *_PLACE, "score")


def match_places(df: DataFrame, text: str, aliases: DataFrame, home_city=K.HOME_CITY, **kw):
    """Every row with its matched place; rows without one have level 'none'.

    Columns of the same names that the rows already have are replaced.
    """
    counts = materialize(
        df.filter(F.col(text).isNotNull()).groupBy(text).agg(F.count(F.lit(1)).alias("_asked"))
    )
    found = match_distinct_texts(counts, text, aliases, home_city, **kw)
    # every distinct text, matched or not, so that a frequent one is known as such
    named = materialize(counts.join(found.withColumnRenamed("raw", text), text, "left"))
    total = counts.agg(F.coalesce(F.sum("_asked"), F.lit(0))).first()[0]
    out = lookup(df.drop(*_PLACE, "score"), named, [text], "_asked", total, "left")
    return out.withColumns(
        {
            "city": city_label("city", home_city),
            "level": F.coalesce("level", F.lit("none")),
        }
    )

