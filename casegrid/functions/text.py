"""Text expressions.  All of them stay inside the JVM."""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K

_EDGE_SPACE = r"^[\s\x1c-\x1f\x85\p{Z}]+|[\s\x1c-\x1f\x85\p{Z}]+$"


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Trim every kind of Unicode white space, not only blanks."""
    return F.regexp_replace(as_col(c), _EDGE_SPACE, "")


def any_of(words) -> str:
    """Regex that matches any of the literal words."""
    return "|".join(re.escape(w) for w in words)


@lru_cache(maxsize=1)
def _ascii_fold_tables() -> tuple[str, str, dict[str, str]]:
    """Compatibility folding derived from the Unicode database.

    Characters that fold to exactly one ASCII character go into a translate
    table; those that fold to several (ligatures, fractions, enclosed letters)
    into a map that is consulted only for texts that contain one of them.
    """
    src, dst, multi = [], [], {}
    for code in range(0x80, sys.maxunicode + 1):
        ch = chr(code)
        if not unicodedata.decomposition(ch):
            continue
        folded = unicodedata.normalize("NFKD", ch).encode("ascii", "ignore").decode()
        if len(folded) == 1 and code <= 0xFFFF:
            src.append(ch)
            dst.append(folded)
        elif folded:
            multi[ch] = folded
    return "".join(src), "".join(dst), multi


def _char_class(chars) -> str:
    """Regex class of the characters, written as ranges to keep matching cheap."""
    codes = sorted(map(ord, chars))
    starts = [x for i, x in enumerate(codes) if i == 0 or codes[i - 1] != x - 1]
    ends = [x for i, x in enumerate(codes) if i + 1 == len(codes) or codes[i + 1] != x + 1]
    return "[" + "".join(f"\\x{{{a:X}}}-\\x{{{z:X}}}" for a, z in zip(starts, ends)) + "]"


def ascii_fold(c) -> Column:
    """Decompose, then drop everything outside ASCII (é -> e, ﬁ -> fi, ß -> '')."""
    src, dst, multi = _ascii_fold_tables()
    c = as_col(c)
    single = F.translate(c, src, dst)
    # what is left outside ASCII is short, so the wide class below stays cheap
    left = F.regexp_replace(single, r"[\x00-\x7F]+", "")
    table = F.from_json(F.lit(json.dumps(multi)), "map<string,string>")
    spelled = F.array_join(
        F.transform(F.split(single, ""), lambda ch: F.coalesce(table[ch], ch)), ""
    )
    folded = F.regexp_replace(
        F.when(left.rlike(_char_class(multi)), spelled).otherwise(single), r"[^\x00-\x7F]+", ""
    )
    return F.when(c.rlike(r"^\p{ASCII}*$"), c).otherwise(folded)


def normalize_text(c) -> Column:
    """Canonical spelling used to compare places; NULL becomes ''."""
    c = F.lower(ascii_fold(c))
    c = F.regexp_replace(c, r"\bsta\.?\b", "santa")
    c = F.regexp_replace(c, r"\bmla\b", "manila")
    c = F.regexp_replace(c, r"[^0-9a-z]+", " ")
    c = F.replace(c, F.lit("brgy"), F.lit("barangay"))
    c = F.replace(c, F.lit("barangays"), F.lit("barangay"))
    return F.coalesce(F.trim(c), F.lit(""))


def capitalize_first(c) -> Column:
    """Trim, first character upper, the rest lower."""
    s = strip(c)
    return F.concat(F.upper(F.left(s, F.lit(1))), F.lower(F.substring(s, 2, 2**31 - 1)))


def title_case(c) -> Column:
    """Trim; every run of letters starts upper and goes on lower."""
    runs = F.regexp_extract_all(F.lower(strip(c)), F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    return F.array_join(
        F.transform(
            runs,
            lambda r: F.concat(F.upper(F.left(r, F.lit(1))), F.substring(r, 2, 2**31 - 1)),
        ),
        "",
    )


def first_segment(c) -> Column:
    """Text before the first comma, trimmed."""
    return strip(F.split_part(as_col(c), F.lit(","), F.lit(1)))


def _segments(c) -> Column:
    parts = F.transform(F.split(as_col(c), ","), strip)
    return F.filter(parts, lambda p: p != "")


def tail_phrases(c) -> Column:
    """Normalised last two and last one comma segments; empty ones dropped."""
    parts = _segments(c)
    two = F.array_join(F.slice(parts, F.greatest(F.size(parts) - 1, F.lit(1)), 2), " ")
    one = F.try_element_at(parts, F.lit(-1))
    phrases = F.array(normalize_text(two), normalize_text(one))
    return F.filter(phrases, lambda p: p != "")


def na_to_null(c, markers=K.NA_MARKERS, ignore_case: bool = False) -> Column:
    c = as_col(c)
    probe = F.lower(F.trim(c)) if ignore_case else c
    return F.when(~probe.isin(*markers), c)


def is_missing(c, marker: str = "na") -> Column:
    """NULL or the text marker, whatever its case and padding."""
    c = as_col(c)
    return c.isNull() | F.coalesce(F.lower(strip(c.cast("string"))) == marker, F.lit(False))


def keyword_match(
    c, include=K.INCLUDED_PLACE_WORDS, exclude=K.EXCLUDED_PLACE_WORDS
) -> Column:
    """True if no exclusion word and at least one inclusion word occurs."""
    text = F.lower(as_col(c))
    keep = text.rlike(any_of(include))
    if exclude:
        keep = ~text.rlike(any_of(exclude)) & keep
    return F.coalesce(keep, F.lit(False))


def first_keyword(c, words) -> Column:
    """First word of the ordered list that occurs in the text, else NULL."""
    text = as_col(c)
    return F.coalesce(*[F.when(F.contains(text, F.lit(w)), F.lit(w)) for w in words])


def city_from_text(
    c, words=K.CITY_WORDS, spellings=K.CITY_SPELLINGS, unknown="Other/Unknown"
) -> Column:
    """City named in a place text: first word of the ordered list wins."""
    c = as_col(c)
    text = F.regexp_replace(F.lower(c), r"city|\.", "")
    found = F.coalesce(
        *[
            F.when(F.contains(text, F.lit(w)), F.lit(spellings.get(w, w.title())))
            for w in words
        ],
        F.lit(unknown),
    )
    return F.when(is_missing(c), F.lit("Unknown")).otherwise(found)


def district_from_keyword(text, tails, rules=K.DISTRICT_KEYWORDS) -> Column:
    """District of the first keyword rule met in the text or a tail phrase."""
    text, tails = as_col(text), as_col(tails)

    def hit(word):
        return F.contains(text, F.lit(word)) | F.exists(
            tails, lambda p: F.contains(p, F.lit(word))
        )

    return F.coalesce(*[F.when(hit(w), F.lit(d)) for w, d in rules])


def city_label(city, home_city=K.HOME_CITY) -> Column:
    city = as_col(city)
    return (
        F.when(city.isNull(), "Other/Unknown")
        .when(F.lower(strip(city)) == home_city.lower(), f"{home_city} City")
        .otherwise(city)
    )


def popup_text(head, **lines) -> Column:
    """Popup body: bold head, then one 'Label: value' line per argument."""
    parts = [F.concat(F.lit("<b>"), as_col(head), F.lit("</b><br>"))]
    for label, c in lines.items():
        value = F.coalesce(as_col(c).cast("string"), F.lit("nan"))
        parts.append(F.concat(F.lit(f"{label.replace('_', ' ')}: "), value, F.lit("<br>")))
    return F.concat(*parts)
