"""The gazetteer of classed names, and what is attached to a name: class, review flag, ignore list.

A gazetteer is a long table (language, class_id); the ignore list has a column language_lc, the
review list language and flag_reason. These are reference lists of some thousands of names; a list is
broadcast only after a count has shown that it is short.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiscope.functions.cleaning import APOSTROPHES, HYPHENS, W, let

TOKEN = rf"({W}+)"
#: A word and what stands after it, up to the next word.
UNIT = rf"{W}+[^{W[1:]}*"
#: Names up to which a list is broadcast; beyond, joins are left to the planner.
BROADCAST_NAMES = 200_000


def small(names: DataFrame, most: int = BROADCAST_NAMES) -> DataFrame:
    """names, broadcast if a count shows that there are few."""
    return F.broadcast(names) if names.limit(most + 1).count() <= most else names


def from_language_data(data: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(gazetteer, ignore list, review list) of the one-row JSON form."""
    classes = data.select(F.explode("lang_classes").alias("c", "names")).select(F.explode("names").alias("language"), F.col("c").cast("int").alias("class_id"))
    ignore = data.select(F.explode(F.transform("languages_to_ignore", F.lower)).alias("language_lc")).distinct()
    review = data.select(F.explode("possible_false_positive_languages").alias("language", "flag_reason"))
    return classes.distinct(), ignore, review


def to_language_data(gazetteer: DataFrame) -> DataFrame:
    """One row: class -> sorted names."""
    per_class = gazetteer.groupBy("class_id").agg(F.sort_array(F.collect_set("language")).alias("names"))
    return per_class.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("class_id").cast("string"), "names")))).alias("lang_classes"))


def drop_ignored(df: DataFrame, ignore: DataFrame, language: str = "language") -> DataFrame:
    return df.join(small(ignore.select(F.col("language_lc").alias("_lc")).distinct()), F.lower(F.col(language)) == F.col("_lc"), "left_anti")


def name_classes(gazetteer: DataFrame, last: bool = False) -> DataFrame:
    """One class for each name: the lowest, or the highest."""
    pick = F.max if last else F.min
    return gazetteer.groupBy("language").agg(pick("class_id").alias("class"))


def attach_class(names: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """names with their class; names that the gazetteer doesn't have go."""
    return names.join(small(name_classes(gazetteer)), "language")


def attach_class_or_hash(names: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """names with their class (the last one of several); others get a class by hash."""
    from lexiscope.functions.labels import hash_class

    return names.join(name_classes(gazetteer, last=True), "language", "left").withColumn("class", F.coalesce("class", hash_class(F.col("language"))))


def attach_review(names: DataFrame, review: DataFrame) -> DataFrame:
    listed = review.groupBy("language").agg(F.min("flag_reason").alias("flag_reason"))
    return names.join(small(listed), "language", "left").withColumn("needs_review", F.col("flag_reason").isNotNull())


def build_detections(names: DataFrame, gazetteer: DataFrame, review: DataFrame, ignore: DataFrame) -> DataFrame:
    """names without ignored and unknown ones, with class, needs_review and flag_reason."""
    return attach_review(attach_class(drop_ignored(names, ignore), gazetteer), review)


def match_key(text):
    """Lower case, with one apostrophe and one hyphen for all their variants."""
    variants, plain = APOSTROPHES[1:] + HYPHENS[1:], "'" * len(APOSTROPHES[1:]) + "-" * len(HYPHENS[1:])

    def one(t):  # plain searches cost far less than to go through every character
        return F.when(reduce(or_, (F.contains(t, F.lit(v)) for v in variants)), F.translate(t, variants, plain)).otherwise(t)

    return let(F.lower(text), one)


def guarded_pattern(language):
    """A Java pattern for a name: its variants of apostrophes and hyphens, any case, no word character at its sides."""
    quoted = F.regexp_replace(language, r"([\\\[\](){}.*+?^$|])", r"\\\\$1")
    quoted = F.regexp_replace(quoted, f"[{HYPHENS}]", f"[{HYPHENS}]")
    quoted = F.regexp_replace(quoted, f"[{APOSTROPHES}]", f"[{APOSTROPHES}]")
    return F.concat(F.lit(rf"(?iu)(?<!{W})"), quoted, F.lit(rf"(?!{W})"))


def keyed(gazetteer: DataFrame) -> DataFrame:
    """gazetteer with key, token (the first word of the key) and kind: how the name is matched.

    word: the name is one word; pairs: several words, with a word at both ends; text: anything else.
    """
    key = match_key(F.col("language"))
    token = F.nullif(F.regexp_extract(key, TOKEN, 1), F.lit(""))
    pairs = F.regexp_like(key, F.lit(rf"^{W}(.*{W})?\z"))
    kind = F.when(F.coalesce(token == key, F.lit(False)), "word").when(pairs, "pairs").otherwise("text")
    return gazetteer.withColumns({"key": key, "token": token, "kind": kind})
