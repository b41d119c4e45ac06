"""Nested place reference -> flat tables, and exact containment of its aliases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import as_col, normalize_text, strip
from ..session import materialize
from .lookups import lookup

_RANGE = r"^(\d+)\s*(?:[-–]|to)\s*(\d+)$"
_CONNECTOR = r"(?i)\band\b|[,&/]"

#: Longest piece of a word that texts and aliases are joined on.
GRAM = 4
#: Parts that the rows of one piece are dealt out to, as every text may hold it.
SALT = 8
#: Up to so many pieces, reading a text once for each costs less than cutting it up.
FEW_PIECES = 64
#: Aliases that may be sent to every executor whatever the planner's threshold.
FEW_ALIASES = 100_000


# --- range texts ----------------------------------------------------------------

def expand_ranges(entry) -> Column:
    """Array of unit names a range text stands for.

    'Barangays 1-3 and 7' -> Barangay 1, 2, 3 and 7.  Parts that start with no
    digit are dropped; a text without any usable part stands for itself.
    """
    text = strip(entry)
    spelled = F.regexp_replace(text, r"(?i)brgys?", "Barangay")
    spelled = F.regexp_replace(spelled, r"(?i)barangays?", "Barangay")

    def clean(part: Column) -> Column:
        part = F.regexp_replace(strip(part), r"(?i)^(barangay|brgy)\s*", "")
        part = F.replace(part, F.lit("."), F.lit(" "))
        return strip(F.regexp_replace(part, r"\s+", " "))

    def names(part: Column) -> Column:
        lo = F.regexp_extract(part, _RANGE, 1).try_cast("bigint")
        hi = F.regexp_extract(part, _RANGE, 2).try_cast("bigint")
        none = F.array().cast("array<string>")
        numbered = F.transform(
            F.sequence(lo, hi), lambda n: F.concat(F.lit("Barangay "), n.cast("string"))
        )
        return (
            F.when(part.rlike(_RANGE), F.when(lo <= hi, numbered).otherwise(none))
            .when(part.rlike(r"^\d"), F.array(F.concat(F.lit("Barangay "), F.upper(part))))
            .otherwise(none)
        )

    parts = F.filter(F.split(spelled, _CONNECTOR), lambda p: strip(p) != "")
    found = F.flatten(F.transform(F.transform(parts, clean), names))
    return F.when(text == "", F.array().cast("array<string>")).otherwise(
        F.when(F.size(found) > 0, found).otherwise(F.array(text))
    )


# --- flattening -----------------------------------------------------------------

def flatten_districts(gaz: DataFrame) -> DataFrame:
    """One row per city and district; cities without districts stay."""
    return gaz.select(
        "city_pos", "city",
        F.col("coordinates").alias("city_coordinates"),
        F.posexplode_outer("districts").alias("district_pos", "d"),
    ).select(
        "city_pos", "city", "city_coordinates", "district_pos",
        F.col("d.name").alias("district"),
        F.col("d.barangay_range").alias("barangay_range"),
        F.coalesce("d.coordinates", "city_coordinates").alias("coordinates"),
        F.col("d.barangays").alias("barangays"),
        F.col("d.barangay_list").alias("barangay_list"),
    )


def district_coordinates(gaz: DataFrame, city: str) -> DataFrame:
    """district -> position of one city."""
    flat = flatten_districts(gaz.filter(F.col("city") == city))
    return flat.filter(F.col("district").isNotNull()).select(
        "district",
        F.col("coordinates.latitude").alias("latitude"),
        F.col("coordinates.longitude").alias("longitude"),
    )


def flatten_units(gaz: DataFrame) -> DataFrame:
    """One row per barangay, range texts expanded, first spelling kept.

    Text entries are expanded and take the district's position; object entries
    keep their name and own position.
    """
    flat = flatten_districts(gaz).filter(F.col("district").isNotNull())
    unit = "array<struct<name:string,coordinates:struct<latitude:double,longitude:double>>>"
    texts = F.flatten(
        F.transform(
            F.coalesce("barangays", F.array().cast("array<string>")),
            lambda e: F.transform(
                expand_ranges(e),
                lambda n: F.struct(n.alias("name"), F.col("coordinates").alias("coordinates")),
            ),
        )
    )
    objects = F.transform(
        F.coalesce("barangay_list", F.array().cast(unit)),
        lambda e: F.struct(
            strip(e["name"]).alias("name"),
            F.coalesce(e["coordinates"], F.col("coordinates")).alias("coordinates"),
        ),
    )
    exploded = flat.select(
        "city_pos", "city", "district_pos", "district",
        F.posexplode(F.concat(texts.cast(unit), objects.cast(unit))).alias("unit_pos", "u"),
    ).filter(F.col("u.name") != "")
    key = F.lower("u.name")
    first = exploded.groupBy("city_pos", "city", "district_pos", "district", key.alias("_key")).agg(
        F.min(F.struct("unit_pos", "u")).alias("f")
    )
    return first.select(
        "city_pos", "city", "district_pos", "district",
        F.col("f.unit_pos").alias("unit_pos"),
        F.col("f.u.name").alias("barangay"),
        F.col("f.u.coordinates.latitude").alias("latitude"),
        F.col("f.u.coordinates.longitude").alias("longitude"),
    )


def place_entries(gaz: DataFrame) -> DataFrame:
    """All places with their aliases.

    ``ordinal`` sorts barangays before districts before cities and keeps the
    file order inside a level; it stands in for the position in the table.
    """
    def ordinal(rank, city, district=None, unit=None):
        pos = [F.lit(0) if p is None else F.coalesce(F.col(p).cast("bigint"), F.lit(0))
               for p in (city, district, unit)]
        return F.format_string("%d-%012d-%06d-%06d", F.lit(rank), *pos).alias("ordinal")

    def aliases(*forms):
        normal = F.transform(F.array(*forms), normalize_text)
        return F.array_distinct(F.filter(normal, lambda a: a != "")).alias("aliases")

    def join(*parts):
        return F.concat_ws(" ", *[as_col(p) for p in parts])

    none = F.lit(None).cast("string")
    cities = gaz.filter(F.col("city") != "").select(
        ordinal(2, "city_pos"), "city", none.alias("district"), none.alias("barangay"),
        F.col("coordinates.latitude").alias("latitude"),
        F.col("coordinates.longitude").alias("longitude"),
        F.lit("city").alias("level"),
        aliases(F.col("city"), join(F.lit("city of"), "city"), join("city", F.lit("city"))),
    )
    flat = flatten_districts(gaz.filter(F.col("city") != "")).filter(F.col("district") != "")
    districts = flat.select(
        ordinal(1, "city_pos", "district_pos"), "city", "district", none.alias("barangay"),
        F.col("coordinates.latitude").alias("latitude"),
        F.col("coordinates.longitude").alias("longitude"),
        F.lit("district").alias("level"),
        aliases(
            F.col("district"), join("district", "city"), join("city", "district"),
            F.col("barangay_range"),
        ),
    )
    units = flatten_units(gaz.filter(F.col("city") != "")).filter(F.col("district") != "")
    number = strip(F.replace(F.col("barangay"), F.lit("Barangay"), F.lit("")))
    has_number = number != ""

    def numbered(c):
        return F.when(has_number, c)

    barangays = units.withColumn("_number", number).select(
        ordinal(0, "city_pos", "district_pos", "unit_pos"), "city", "district", "barangay",
        "latitude", "longitude", F.lit("barangay").alias("level"),
        aliases(
            F.col("barangay"), join("barangay", "district"), join("barangay", "city"),
            numbered(join(F.lit("barangay"), "_number")),
            numbered(F.col("_number")),
            numbered(join("_number", "district")),
            numbered(join("_number", "city")),
        ),
    )
    return barangays.unionByName(districts).unionByName(cities)


def alias_table(gaz: DataFrame) -> DataFrame:
    """One row per place alias."""
    entries = place_entries(gaz)
    return entries.select(
        "ordinal", "level", "city", "district", "barangay", "latitude", "longitude",
        F.explode("aliases").alias("alias"),
    )


# --- containment ------------------------------------------------------------------

def _rarest_pieces(aliases: DataFrame) -> DataFrame:
    """Adds to each alias the piece of its words that the fewest aliases have.

    Every word of an alias lies inside one word of a text that contains it, and
    so does each of its pieces.  A piece that most aliases share, such as the
    start of "barangay", is then the key of none that has anything rarer.
    """
    named = aliases.withColumn("_pieces", _word_pieces(F.col("alias")))
    pieces = named.select("alias", F.explode("_pieces").alias("_gram")).distinct()
    counts = pieces.groupBy("_gram").agg(F.count("*").alias("_held_by"))
    rarest = (
        pieces.join(counts, "_gram")
        .groupBy("alias")
        .agg(F.min(F.struct("_held_by", -F.length("_gram"), "_gram")).alias("r"))
        .select("alias", F.col("r._gram").alias("_gram"))
    )
    return aliases.join(rarest, "alias").select(*aliases.columns, "_gram")


def _word_pieces(text: Column) -> Column:
    """Pieces of GRAM characters of every word, a shorter word as it is."""
    words = F.filter(F.array_distinct(F.split(text, " ")), lambda w: w != "")

    def of_word(word):
        starts = F.sequence(F.lit(1), F.greatest(F.length(word) - (GRAM - 1), F.lit(1)))
        return F.transform(starts, lambda i: F.substring(word, i, GRAM))

    return F.array_distinct(F.flatten(F.transform(words, of_word)))


def _grams(text: Column, lengths: list[int]) -> Column:
    """Distinct pieces of the given lengths from the distinct words of a text."""
    words = F.array_distinct(F.split(text, " "))

    def pieces(word):
        starts = F.sequence(F.lit(1), F.greatest(F.length(word), F.lit(1)))

        def of_length(q: int) -> Column:
            return F.transform(starts, lambda i: F.substring(word, i, q))

        return F.flatten(F.array(*[of_length(q) for q in lengths]))

    return F.array_distinct(F.flatten(F.transform(words, pieces)))


def contained_aliases(
    texts: DataFrame, text_id: str, text: str, aliases: DataFrame, merge: bool = False
) -> DataFrame:
    """Every (text, alias) with the normalised alias inside the normalised text.

    The rarest piece of each alias finds the candidates, the whole alias is checked
    on them.  The keyed aliases are written, so that their number is known.  If they
    have few pieces, each text is searched for each piece where it was read: one
    pass, nothing of a text is shuffled.  Otherwise the texts are written once under
    a row number, and an equi-join on the pieces of their words meets the aliases:
    broadcast if few, else in a shuffle in which each piece is dealt out to SALT
    parts and only the row number travels.  An alias without a word is contained in
    nothing.  `merge` asks for the shuffle whatever the number.
    """
    keyed = materialize(_rarest_pieces(aliases))
    sizes = (
        keyed.groupBy(F.length("_gram").alias("q"))  # 1..GRAM
        .agg(F.count("*").alias("aliases"), F.count_distinct("_gram").alias("pieces"))
        .collect()
    )
    few = sum(r.aliases for r in sizes) <= FEW_ALIASES and not merge
    if few and sum(r.pieces for r in sizes) <= FEW_PIECES:
        pieces = keyed.select("_gram").distinct()
        found = texts.join(
            F.broadcast(pieces), F.contains(F.col(text), F.col("_gram"))
        ).join(F.broadcast(keyed), "_gram")
    else:
        found = _candidates_by_piece(texts, text, keyed, [r.q for r in sizes], few)
    return found.filter(F.contains(F.col(text), F.col("alias"))).select(
        *texts.columns, *aliases.columns
    )


def _candidates_by_piece(
    texts: DataFrame, text: str, keyed: DataFrame, lengths: list[int], few: bool
) -> DataFrame:
    """Texts next to the aliases whose key is a piece of one of their words.

    A word is cut up once, in however many texts it is, and has one row with all its
    keys.  The size of a file says little about the rows in it, so what grows with
    the texts is never left to the planner's broadcast: words that many texts hold
    are broadcast, at most ten thousand, and all else is shuffled.
    """
    texts = materialize(texts.withColumn("_row", F.monotonically_increasing_id()))
    words = texts.select(
        "_row", F.explode(F.array_distinct(F.split(F.col(text), " "))).alias("_word")
    )
    cut = words.groupBy("_word").agg(F.count(F.lit(1)).alias("_asked")).select(
        "_word", "_asked",
        F.explode(_grams(F.col("_word"), sorted(lengths) or [GRAM])).alias("_gram"),
    )
    keys = keyed.select("_gram").distinct()
    keys = F.broadcast(keys) if few else keys.hint("merge")
    marked = materialize(
        cut.join(keys, "_gram").groupBy("_word").agg(
            F.first("_asked").alias("_asked"), F.collect_list("_gram").alias("_grams")
        )
    )
    total = marked.agg(F.sum("_asked")).first()[0] or 0
    held = lookup(words, marked.hint("merge"), ["_word"], "_asked", total)
    pieces = held.groupBy("_row").agg(
        F.array_distinct(F.flatten(F.collect_list("_grams"))).alias("_grams")
    )
    if few:
        met = texts.hint("merge").join(pieces, "_row").withColumn("_gram", F.explode("_grams"))
        return met.join(F.broadcast(keyed), "_gram")
    salt = F.pmod(F.xxhash64("_row"), F.lit(SALT)).alias("_salt")
    salted = keyed.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    candidates = pieces.select("_row", F.explode("_grams").alias("_gram"), salt).join(
        salted.hint("merge"), ["_gram", "_salt"]
    )
    return texts.hint("merge").join(candidates.drop("_gram", "_salt"), "_row")


def first_contained_alias(
    texts: DataFrame, text_id: str, text: str, aliases: DataFrame
) -> DataFrame:
    """The first alias in table order that occurs in each text."""
    fields = ["ordinal", *[c for c in aliases.columns if c != "ordinal"]]
    found = contained_aliases(texts, text_id, text, aliases)
    return (
        found.groupBy(text_id).agg(F.min(F.struct(*fields)).alias("a")).select(text_id, "a.*")
    )
