"""Document fingerprints by locally consistent parsing.

A text is cut into phrases by deterministic coin tossing: every symbol gets a
small label from the lowest bit in which it differs from its left neighbour,
repeated until six labels are left; a phrase starts where a label is a local
maximum.  A phrase is named by a hash of its symbols, and the names are parsed
again, level on level, up to one name for the text.  A cut depends on a few
symbols around it only, so equal substrings have the same phrases inside,
wherever they stand.  The fingerprint keeps the name of the whole text and, for
two levels, the smallest phrase names, a number that grows with the phrases;
likeness estimates the share of phrases that two texts have in common.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions, whole

#: Levels whose phrase names are kept: all of them up to KEPT, of more of them the
#: smallest KEPT or SHARE of them, whichever is more.
LEVELS = (2, 3)
KEPT = 64
SHARE = 0.25
#: Characters that are parsed together.
CHUNK = 1 << 20
#: Ranges of document ids per shuffle partition.
RANGES_PER_PARTITION = 4


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _toss(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One round: 2 * (lowest differing bit) + that bit, against the left neighbour.

    Neighbours differ, and so do their labels.  The first symbol of a text is
    compared with its complement, so it has bit 0.
    """
    left = np.empty_like(x)
    left[1:] = x[:-1]
    left[first] = ~x[first]
    apart = x ^ left
    low = apart & (~apart + x.dtype.type(1))
    bit = np.bitwise_count(low - x.dtype.type(1)).astype(np.uint8)
    return bit * np.uint8(2) + ((x & low) != 0).astype(np.uint8)


def _fold_runs(x: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of one symbol become one symbol, named by symbol and length."""
    new = np.r_[True, (x[1:] != x[:-1]) | (doc[1:] != doc[:-1])]
    if new.all():
        return x, doc
    at = np.flatnonzero(new)
    length = np.diff(np.r_[at, len(x)]).astype(np.uint64)
    x = x[at]
    return np.where(length > 1, _mix(x + length * np.uint64(0x9E3779B97F4A7C15)), x), doc[at]


def next_level(x: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the phrases of names `x`, for many texts side by side."""
    x, doc = _fold_runs(x, doc)
    first = np.r_[True, doc[1:] != doc[:-1]]
    label = _toss(x, first)
    for _ in range(3):  # 128 labels, then 14, 8 and 6
        label = _toss(label, first)
    last = np.r_[first[1:], True]
    higher_left, higher_right = np.ones(len(x), bool), np.ones(len(x), bool)
    higher_left[1:] = label[1:] > label[:-1]
    higher_right[:-1] = label[:-1] > label[1:]
    start = first | (higher_left & (higher_right | last))
    at = np.flatnonzero(start)
    place = np.arange(len(x)) - np.repeat(at, np.diff(np.r_[at, len(x)]))
    named = _mix(x + place.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return _mix(np.add.reduceat(named, at)), doc[at]


def _smallest(x: np.ndarray, doc: np.ndarray, n: int) -> list[tuple[np.ndarray, bool]]:
    """The smallest distinct 32-bit names of each text, and whether these are all."""
    short = (x >> np.uint64(32)).astype(np.uint32)
    ends = np.searchsorted(doc, np.arange(n + 1))
    out = []
    for a, b in zip(ends[:-1], ends[1:], strict=True):
        names = np.unique(short[a:b])
        kept = max(KEPT, math.ceil(len(names) * SHARE))
        out.append((names[:kept], len(names) <= kept))
    return out


def parse(texts: list[str]) -> list[tuple[int, list[tuple[np.ndarray, bool]]]]:
    """(name of the text, smallest names per kept level and whether all are) of every text."""
    n = len(texts)
    points = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    x = np.concatenate(points).astype(np.uint64) if n else np.empty(0, np.uint64)
    doc = np.repeat(np.arange(n), [len(p) for p in points])
    roots, sketches, level = np.zeros(n, np.uint64), [], 0
    while len(x):
        level += 1
        x, doc = next_level(x, doc)
        if level in LEVELS:
            sketches.append(_smallest(x, doc, n))
        alone = np.r_[True, doc[1:] != doc[:-1]] & np.r_[doc[1:] != doc[:-1], True]
        roots[doc[alone]] = x[alone] ^ np.uint64(level)
        if level >= max(LEVELS):
            x, doc = x[~alone], doc[~alone]
    empty = [(np.empty(0, np.uint32), True)] * n
    sketches += [empty] * (len(LEVELS) - len(sketches))
    return [(int(roots[i]), [s[i] for s in sketches]) for i in range(n)]


def to_text(parsed) -> str:
    """Name of the text and, after a full stop each, the names kept of a level."""
    root, levels = parsed
    return f"{root:016x}" + "".join("." + names.astype(">u4").tobytes().hex() for names, _ in levels)


def likeness(a, b) -> float:
    """Mean over levels of the estimated share of common phrases; 1 for equal texts.

    The names of both texts together are known up to the last one kept of the
    text that kept fewer; the share among these is the estimate, and exact where
    all names were kept.
    """
    if a[0] == b[0]:
        return 1.0
    shares = []
    for (x, all_x), (y, all_y) in zip(a[1], b[1], strict=True):
        if len(x) and len(y):
            union = np.union1d(x, y)
            known = [names[-1] for names, whole in ((x, all_x), (y, all_y)) if not whole]
            if known:
                union = union[: np.searchsorted(union, min(known), side="right")]
            both = np.isin(union, x, assume_unique=True) & np.isin(union, y, assume_unique=True)
            shares.append(both.mean())
    return float(np.mean(shares)) if shares else 0.0


def fingerprints(texts: list[str]) -> list:
    """Parse in chunks of bounded size, a long text by itself."""
    out, held, size = [], [], 0
    for text in texts:
        if held and size + len(text) > CHUNK:
            out += parse(held)
            held, size = [], 0
        held.append(text)
        size += len(text)
    return out + parse(held)


def edited(text: str, following: str) -> str:
    """The last quarter replaced by as many characters from the start of the next text."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def _kernel():
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            if held is not None:
                batch = pd.concat([held, batch], ignore_index=True)
            held = batch.iloc[-1:]
            if len(batch) < 2:
                continue
            texts, guest = batch["text"].tolist(), batch["guest"].to_numpy()
            own = np.flatnonzero(~guest[:-1])  # the row after one of the range is its next document
            prints = fingerprints(texts)
            changed = [edited(texts[i], texts[i + 1]) for i in own]
            rows = []
            for i, text, other in zip(own, changed, fingerprints(changed), strict=True):
                rows.append((
                    batch["doc_id"].iat[i], len(texts[i]),
                    hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest(),
                    to_text(prints[i]), to_text(other),
                    likeness(prints[i], other), likeness(prints[i], prints[i + 1]),
                ))
            yield pd.DataFrame(rows, columns=names)

    return run


def with_next(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """Rows dealt out so that the next document follows each one.

    Ranges of ids are shuffled whole.  The first document of a range, a guest, is
    copied to the end of the range before it; the ranges and their first ids are
    as many as the partitions ask for, and broadcast.  NULL ids come last, as the
    largest number; documents with one id are in order of their text.
    """
    spark = docs.sparkSession
    number = F.coalesce(F.col(doc_id).cast("long"), F.lit(2**63 - 1))
    ids = docs.select(number.alias("id"), number.cast("double").alias("at"))
    n = partitions(spark) * RANGES_PER_PARTITION
    cuts = sorted(set(ids.approxQuantile("at", [i / n for i in range(1, n)], 0.2 / n)))
    ranges = Bucketizer(
        splits=[-float("inf"), *(cuts or [0.0]), float("inf")], inputCol="at", outputCol="range"
    )
    firsts = ranges.transform(ids).groupBy("range").agg(F.min("id").alias("id")).orderBy("range").collect()
    before = [
        (r["id"], firsts[i - 1]["range"]) for i, r in enumerate(firsts)
    ]  # the range before the first one is the last one
    guests = spark.createDataFrame(before, "first long, to double")
    rows = ranges.transform(
        docs.select(number.alias("id"), number.cast("double").alias("at"), whole(text).alias("text"))
    )
    rows = rows.join(F.broadcast(guests), rows["id"] == guests["first"], "left")
    places = F.array(
        F.struct(F.col("range"), F.lit(False).alias("guest")),
        F.struct(F.col("to").alias("range"), F.lit(True).alias("guest")),
    )
    dealt = rows.select(
        F.col("id").alias("doc_id"), "text",
        F.explode(F.when(F.col("to").isNull(), F.slice(places, 1, 1)).otherwise(places)).alias("p"),
    ).select("p.range", "p.guest", "doc_id", "text")
    return dealt.repartition(partitions(spark), "range").sortWithinPartitions(
        "range", "guest", "doc_id", "text"
    )


def fingerprint(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next.

    The edited text ends with the start of the next document in order of id; the
    first one follows the last.  NULL and empty texts have an empty fingerprint,
    and are like each other only.  An only document is its own next one; repeated
    rows follow each other; other columns are ignored; an empty table gives no rows.
    """
    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"
    )
    out = with_next(docs, text, doc_id).select("guest", "doc_id", "text").mapInPandas(_kernel(), schema)
    return out.withColumn("doc_id", F.when(F.col("doc_id") != 2**63 - 1, F.col("doc_id")))
