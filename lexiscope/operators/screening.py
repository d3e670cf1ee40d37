"""Names in cleaned blocks: equi-joins on words, then a guard and the acronym veto.

Every block gives its distinct words, and its pairs of neighbouring words with what stands between
them. A name of one word matches by equality; a name of several words by its pairs: each pair of the
name must be found, at places that follow each other. Both go without their text. Names that begin or
end with something else than a word are looked up by their first word and confirmed in the text by
their guarded pattern; names without a word character are matched in a small side branch. So the work
is in proportion to the text, not to text times names.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiscope.functions.acronyms import count_acronym_places
from lexiscope.functions.cleaning import clean_blocks, paper_acronyms
from lexiscope.functions.labels import conflict_message
from lexiscope.operators.gazetteer import TOKEN, UNIT, build_detections, drop_ignored, guarded_pattern, keyed, match_key, small
from lexiscope.staging import written

#: These apostrophes are word characters themselves; blocks with one are confirmed on their own text.
MODIFIER_APOSTROPHES = "ʼʻʹʽ"


def _modified(text):
    return reduce(or_, (F.contains(text, F.lit(c)) for c in MODIFIER_APOSTROPHES))


def _probes(names: DataFrame) -> DataFrame:
    """(word, _unit, _next, language, class_id, kind, _n, _k) of keyed() names: by what words of a text they are looked up.

    Names of kind "pairs" have a row for each of their _n pairs, the others one for their first word.
    """
    key = F.col("key")
    words = names.select("language", "class_id", "kind", "token", F.regexp_extract_all(key, F.lit(TOKEN), F.lit(1)).alias("w"), F.regexp_extract_all(key, F.lit(UNIT), F.lit(0)).alias("u"))
    first = F.array(F.struct(F.col("token").alias("word"), F.lit(None).cast("string").alias("_unit"), F.lit(None).cast("string").alias("_next"), F.lit(0).alias("_k")))
    steps = F.transform(F.slice("w", 1, F.size("w") - 1), lambda w, k: F.struct(w.alias("word"), F.get("u", k).alias("_unit"), F.get("w", k + 1).alias("_next"), k.alias("_k")))
    each = F.when(F.col("kind") == "pairs", steps).otherwise(first)
    return words.select("language", "class_id", "kind", (F.size("w") - 1).alias("_n"), F.inline(each))


def word_hits(texts: DataFrame, names: DataFrame, keys: list[str], block: str) -> DataFrame:
    """(keys, language, class_id, _sure), a row each: keyed() names with a word found in texts, sure if their words alone decide.

    Every text is keyed, cut into words and looked up once. Not sure are names of kind "text", and all names in
    texts with one of MODIFIER_APOSTROPHES.
    """
    # told apart before words are made: a test of the text behind explode would run for every word
    keyed_texts = texts.select(*keys, _modified(F.col(block)).alias("_odd"), match_key(F.col(block)).alias("_key"))
    cut = keyed_texts.select(*keys, "_odd", F.regexp_extract_all("_key", F.lit(TOKEN), F.lit(1)).alias("word"), F.regexp_extract_all("_key", F.lit(UNIT), F.lit(0)).alias("unit"))
    after = F.slice("word", 2, F.greatest(F.size("word"), F.lit(1)))
    held = cut.select(*keys, "_odd", F.posexplode(F.arrays_zip("word", "unit", after.alias("next"))).alias("_at", "_p"))
    held = held.select(*keys, "_odd", "_at", "_p.word", "_p.unit", "_p.next")
    pairs, sure = F.col("kind") == "pairs", ~F.col("_odd") & (F.col("kind") != "text")
    meets = F.when(sure & pairs, (F.col("unit") == F.col("_unit")) & (F.col("next") == F.col("_next"))).otherwise(F.col("_k") == 0)
    met = held.join(small(_probes(names)), "word").where(meets)
    several = sure & pairs & (F.col("_n") > 1)
    rows = met.select(
        *keys, "language", "class_id", sure.alias("_sure"), F.when(several, F.col("_n")).alias("_wanted"), F.when(several, F.col("_at") - F.col("_k")).alias("_first")
    )
    found = rows.groupBy(*rows.columns).agg(F.count("*").alias("_found")).where("_wanted IS NULL OR _wanted = _found")
    return found.select(*keys, "language", "class_id", "_sure").distinct()


def pair_matches(texts: DataFrame, names: DataFrame, keys: list[str], block: str) -> DataFrame:
    """(keys, language, class_id) of names of several words in texts; names: see keyed(), those of kind "pairs"."""
    return word_hits(texts, names, keys, block).where("_sure").drop("_sure")


def match_names(blocks: DataFrame, gazetteer: DataFrame, keys: list[str], block: str = "block") -> DataFrame:
    """(keys, language, class_id), one row for each name and class that a block holds; keys identify blocks.

    Words go on without their text. Only names with something else than words at their ends meet the text again.
    """
    names = keyed(gazetteer)
    columns = [*keys, "language", "class_id"]
    texts = blocks.select(*keys, block)
    worded, wordless = names.where("token IS NOT NULL"), names.where("token IS NULL")
    # plain containment of the keys is much cheaper than the pattern and leaves it few texts
    near = F.contains(match_key(F.col(block)), match_key(F.col("language")))
    guard = near & F.regexp_like(F.col(block), guarded_pattern(F.col("language")))
    hits = word_hits(texts, worded, keys, block)
    again = texts
    if worded.where("kind = 'text'").isEmpty():  # then only these texts can have names that are not sure
        again = texts.where(_modified(F.col(block)))
    again = again.withColumn("_again", F.lit(False))
    # sure names meet no text: their side of the key is true, the texts' false
    same = F.col("_sure") == F.col("_again")
    for k in keys:
        same &= hits[k].eqNullSafe(again[k])
    found = hits.join(again, same, "left").where(F.col("_sure") | F.coalesce(guard, F.lit(False))).select(*(hits[k] for k in keys), "language", "class_id")
    if wordless.isEmpty():
        return found
    return found.union(texts.join(small(wordless), guard).select(*columns))  # names without any word character


def acronym_places(blocks: DataFrame, keys: list[str], block: str = "block") -> DataFrame:
    """(keys, _acronym, times): how often capital letters stand in parentheses as an acronym of the words before them.

    Only blocks with such parentheses are looked at, and no text goes on.
    """
    acronyms = F.array_distinct(F.regexp_extract_all(F.col(block), F.lit(r"\(\s*([A-Z]{2,10})\s*\)"), F.lit(1)))
    counted = F.transform(acronyms, lambda a: F.struct(a.alias("_acronym"), count_acronym_places(F.col(block), a).alias("times")))
    # a row for each one that counts: a filter behind the rows would be pushed below and count them again
    return blocks.where(F.contains(block, F.lit("("))).select(*keys, F.inline(F.filter(counted, lambda c: c["times"] > 0)))


def acronym_matches(matches: DataFrame, blocks: DataFrame, keys: list[str], block: str = "block") -> DataFrame:
    """(keys, language, times): matches that stand in parentheses as acronyms of the words before them, with their places."""
    own = matches.select(*keys, "language").distinct().withColumn("_acronym", F.upper(F.trim("language")))
    return acronym_places(blocks, keys, block).join(own, [*keys, "_acronym"]).select(*keys, "language", "times")


def without_acronyms(found: DataFrame, blocks: DataFrame, keys: list[str], block: str = "block") -> DataFrame:
    """found names (keys, language, class_id) that don't stand in parentheses as acronyms in their block."""
    places = acronym_places(blocks, keys, block).select(*keys, "_acronym")
    return found.withColumn("_acronym", F.upper(F.trim("language"))).join(places, [*keys, "_acronym"], "left_anti").drop("_acronym")


def detect(blocks: DataFrame, gazetteer: DataFrame, ignore: DataFrame, keys: list[str], block: str = "block") -> DataFrame:
    """(keys, language, class_id) of names in cleaned blocks, without ignored names and acronyms."""
    return without_acronyms(match_names(blocks, drop_ignored(gazetteer, ignore), keys, block), blocks, keys, block)


def warnings_of(found: DataFrame, blocks: DataFrame, paper_id: str, keys: list[str], block: str = "block") -> DataFrame:
    """(rule, language, acronym, paper_id), a row for each vetoed place of found names."""
    return acronym_matches(found, blocks, keys, block).select(
        F.lit("parenthetical_acronym_context").alias("rule"), "language", F.upper(F.trim("language")).alias("acronym"),
        F.col(paper_id).cast("string").alias("paper_id"), F.explode(F.expr("sequence(1, times)")).alias("_n"),
    ).drop("_n")


def screening_warnings(blocks: DataFrame, gazetteer: DataFrame, ignore: DataFrame, paper_id: str, keys: list[str], block: str = "block") -> DataFrame:
    """warnings_of() the names that blocks hold."""
    return warnings_of(match_names(blocks, drop_ignored(gazetteer, ignore), keys, block), blocks, paper_id, keys, block)


def screen(texts: DataFrame, gazetteer: DataFrame, ignore: DataFrame, review: DataFrame, keys: list[str], text: str = "text", acronyms: str | None = None) -> DataFrame:
    """Clean, detect and build detections: (keys, block_idx, language, class, needs_review, flag_reason), a row for each block and name."""
    rows = texts.select(*keys, text, *([acronyms] if acronyms else []))
    blocks = written(clean_blocks(rows, text, acronyms).drop("acronyms"), "blocks")  # read several times below
    names = detect(blocks, gazetteer, ignore, [*keys, "block_idx"]).select(*keys, "block_idx", "language")
    return build_detections(names, gazetteer, review, ignore)


def conflicts_of(acronyms: DataFrame, gazetteer: DataFrame, ignore: DataFrame, paper_id: str = "paper_id") -> DataFrame:
    """(paper_id, acronym, language, language_class, message) of a paper's acronyms that are names too."""
    names = drop_ignored(gazetteer, ignore).withColumn("acronym", F.upper("language"))
    return acronyms.join(small(names), "acronym").select(
        paper_id, "acronym", "language", F.col("class_id").alias("language_class"),
        conflict_message(F.col("acronym"), F.col("language")).alias("message"),
    )


def acronym_conflicts(papers: DataFrame, gazetteer: DataFrame, ignore: DataFrame, paper_id: str = "paper_id", text: str = "text") -> DataFrame:
    """conflicts_of() the acronyms that a paper's text defines."""
    return conflicts_of(papers.select(paper_id, F.explode(paper_acronyms(F.col(text))).alias("acronym")).distinct(), gazetteer, ignore, paper_id)
