"""Cleaning of paper text before screening: one Column function for each step, and the whole chain.

Word characters are letters, numbers and the underscore of any script, stated as an explicit class,
as the engine's own word class knows ASCII alone. Every step is a built-in expression but
Unicode normalisation, which runs in Python on the texts that it may change.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Characters that may be part of a language name.
APOSTROPHES = "'ʼʻʹʽ`"
HYPHENS = "-‐‑‒–—−"
NAME_EXTRAS = "()|!‡"

W = r"[\p{L}\p{N}_]"
#: A place between a word character and none, at either end.
START, END = rf"(?<!{W})(?={W})", rf"(?<={W})(?!{W})"
S = r"[\s\x1c-\x1f\x85\p{Z}]"
#: The same characters one by one.
SPACES = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
#: Characters that NFKC leaves as they are, whatever stands beside them: texts of these alone need no normalisation.
STABLE = (
    "\x00-\x7f\xa1-\xa7\xa9\xab-\xae\xb0\xb1\xb6\xb7\xbb\xbf-\u0131\u0134-\u013e\u0141-\u0148\u014a-\u017e\u0391-\u03a1\u03a3-\u03ce\u0400-\u0481\u048a-\u052f"
    "\u05d0-\u05ea\u0621-\u063a\u0641-\u064a\u0904-\u0939\u2010\u2012-\u2016\u2018-\u2023\u2030-\u2032\u2039-\u203b\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3"
)
#: A character that isn't one of these. Two ranges of them are told apart first, as the whole class takes a multiple of the time for each character.
UNSTABLE = rf"(?=[^\x00-\x7f\xbf-\u0131])[^{STABLE}]"

# What is removed, in order (name, pattern); Java syntax. The lists of commands, tokens and
# connectors, and the numbers of characters to look ahead, decide results.
_SMALL = "and|or|of|the|a|for|in|with|to"
YEAR = r"(?:19|20)\d{2}[a-z]?"
STEPS: dict[str, str] = {
    "affiliation_email_lines": rf"(?iu){START}email{S}*:{S}*[^\s]+@[^\s]+",
    "email_addresses": r"[^\s]+@[^\s]+\.[^\s]+",
    "col_assignment": rf"(?iu){START}col[@$\\]?{S}*=[^\S\n]*[^\n]+",
    "col_slice": rf"(?iu){START}col[@$\\]?{S}*\[[^\]]+\]",
    "col_math_marker": rf"(?iu){START}col[@$\\]+",
    "color_blocks": r"(?i)\{\\color[^{}]*\}|\\color\[[^\]]*\]\{[^{}]*\}|\\definecolor\[[^\]]*\]\{[^{}]*\}",
    "inline_math": r"\$[^$]+\$|\\\([^)]*\\\)|\\\[[^\]]*\\\]",
    "math_commands": (
        r"(?i)\\(?:math[a-zA-Z]+|frac|left|right|mathrm|mathbf|mathsf|mathtt|begin|end|color|definecolor"
        r"|text|operatorname|dots|ldots|cdots|vdots|ddots|quad|qquad"
        r"|hat|bar|tilde|vec|widehat|widetilde|overline|underline"
        rf"|sum|prod|int|oint|min|max|arg|log|exp|sin|cos|tan|lim|inf|sup)(?!{W})(?:\{{[^{{}}]*\}})?"
    ),
    "subscript_superscript": r"[_^]\{[^{}]*\}",
    "citation_author_year": rf"(?iu){START}{W}+{S}+et{S}+al\.?{S}*[(\[]{S}*{YEAR}{S}*[)\]]",
    "citation_parens": rf"(?iu)\((?=[^()]{{0,260}}{START}(?:et{S}+al(?:\.{START}|{END})|{YEAR}{END}))[^()]{{0,300}}\)",
    "citation_brackets": rf"(?iu)\[(?=[^\[\]]{{0,260}}{START}(?:et{S}+al(?:\.{START}|{END})|{YEAR}{END}))[^\[\]]{{0,300}}\]",
    "alnum_tokens": rf"(?<!{W})(?:\d+[a-zA-Z]+|[a-zA-Z]+\d+[a-zA-Z]*)(?!{W})",
    "standalone_numbers": rf"(?<!{W})\d+(?:\.\d+)?(?!{W})",
    "latex_artifacts": rf"(?iu){START}(?:rgb|named|definecolor|pgfstrokecolor|color){END}",
    "math_functions": rf"{START}[a-z]{{2,8}}{S}*\({S}*[A-Z]?{S}*\)",
}
#: Two words before the parenthesis decide, small words not counted; more of them would change nothing.
DEFINITION = rf"((?:(?!(?:{_SMALL})(?!{W}))[A-Za-z][a-z]*+{S}++(?:(?:{_SMALL}){S}++)*+){{2}})\(([A-Z]{{2,8}})\)"
#: What may hold a definition: an acronym in parentheses, and what stands before it up to a mark that no definition has.
DEFINED = r"\([A-Z]{2,8}\)"
DEFINING = rf"(?<![^().,;:])[^().,;:]*+{DEFINED}"
#: Fixed value: a function definition up to the next one, which only code steps change.
CODE = (
    rf"(?isu){START}def{S}+[A-Za-z_]{W}*{S}*\([^)]*\){S}*:.*?{START}return{END}.*?"
    rf"(?={START}def{S}+[A-Za-z_]{W}*{S}*\([^)]*\){S}*:|\z)"
)
#: A noncharacter that parts code from the rest of a block.
_PART = "\ufffe"
#: How many matches a step's report shows at most, where not all.
REPORTED = {"def_return_funcs": 5, "math_commands": 10, "subscript_superscript": 10, "standalone_numbers": 20}
HYPHENATED = rf"([A-Z][a-zA-Z0-9]*(?:-[A-Z][a-zA-Z0-9]*){{1,7}}){S}*\(([A-Z]{{2,8}})\)"
LOWER_HYPHENATED = rf"([a-z][a-z0-9]*(?:-[a-z][a-z0-9]*){{1,7}}){S}*\(([A-Z]{{2,8}})\)"
#: Words that show a language is meant, unless a hyphen stands before them.
CONTEXT = rf"(?i)(?<![{HYPHENS}]){START}(?:language|speakers?|dialect|corpus|script|words?|text|spoken|fluent|native){END}"
CONTEXT_CHARS = 60
NOT_KEPT = rf"[^\s\x1c-\x1f\x85\p{{Z}}\p{{L}}{re.escape(APOSTROPHES)}{re.escape(HYPHENS)}{re.escape(NAME_EXTRAS)}]"
_KEPT = rf"a-zA-Z\p{{L}}{re.escape(APOSTROPHES)}{re.escape(HYPHENS)}{re.escape(NAME_EXTRAS)}"
#: Runs of those and of white space, but for single spaces before what is kept, which are most of them and stay as they are.
BETWEEN = rf"(?! [{_KEPT}])[^{_KEPT}]++"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value made once however often body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


#: Rows go to Python some at a time, not as Arrow batches of thousands of texts.
_nfkc = F.udf(lambda text: text if text is None else unicodedata.normalize("NFKC", text), T.StringType(), useArrow=False)


def not_ascii(text: Column) -> Column:
    return F.octet_length(text) != F.length(text)


def nfkc(text: Column) -> Column:
    """NFKC; texts of stable characters alone stay in the engine."""
    odd = not_ascii(text) & F.regexp_like(text, F.lit(UNSTABLE))
    return F.coalesce(_nfkc(F.when(odd, text)), text)


def normalise(text: Column) -> Column:
    """NFKC, no-break spaces as spaces, and no space before the dot of "et al."."""
    return F.replace(F.replace(nfkc(text), F.lit("\xa0"), F.lit(" ")), F.lit("et al ."), F.lit("et al."))


#: What a block must hold (any of the texts, or of a class of characters) before a step's pattern can match: plain searches cost far less.
NEEDS: dict[str, tuple[str, ...]] = {
    "affiliation_email_lines": ("@",), "email_addresses": ("@",), "col_assignment": ("=",), "col_slice": ("[",), "col_math_marker": ("@", "$", "\\"),
    "color_blocks": ("\\",), "inline_math": ("$", "\\"), "math_commands": ("\\",), "subscript_superscript": ("{",),
    "citation_author_year": ("(", "["), "citation_parens": ("(",), "citation_brackets": ("[",), "math_functions": ("(",),
}
_NEEDED_CLASS = {"alnum_tokens": "[0-9]", "standalone_numbers": "[0-9]"}


def _may_match(name: str, block: Column) -> Column:
    if name in _NEEDED_CLASS:
        return F.regexp_like(block, F.lit(_NEEDED_CLASS[name]))
    if name == "latex_artifacts":
        return let(F.lower(block), lambda b: reduce(or_, (F.contains(b, F.lit(x)) for x in ("rgb", "named", "color"))))
    return reduce(or_, (F.contains(block, F.lit(x)) for x in NEEDS[name]))


def step(name: str) -> Callable[[Column], Column]:
    """The step that replaces each match of a pattern by a space."""
    return lambda block: let(block, lambda b: F.when(_may_match(name, b), F.regexp_replace(b, STEPS[name], " ")).otherwise(b))


strip_affiliation_emails = step("affiliation_email_lines")
strip_emails = step("email_addresses")
strip_col_assignments = step("col_assignment")
strip_col_slices = step("col_slice")
strip_col_markers = step("col_math_marker")
strip_color_blocks = step("color_blocks")
strip_inline_math = step("inline_math")
strip_math_commands = step("math_commands")
strip_scripts = step("subscript_superscript")
strip_author_year = step("citation_author_year")
strip_citation_parens = step("citation_parens")
strip_citation_brackets = step("citation_brackets")
strip_alnum_tokens = step("alnum_tokens")
strip_numbers = step("standalone_numbers")
strip_latex_artifacts = step("latex_artifacts")
strip_math_functions = step("math_functions")


def strip_code(block: Column) -> Column:
    """Column assignments, slices and markers."""
    return strip_col_markers(strip_col_slices(strip_col_assignments(block)))


def _may_hold_code(block: Column) -> Column:
    return let(F.lower(block), lambda b: F.contains(b, F.lit("def")) & F.contains(b, F.lit("return")))  # two plain searches leave out nearly all blocks


def strip_code_blocks(block: Column) -> Column:
    """The same inside function definitions alone: an assignment that ends with its function can't take what follows it on the line."""

    def stripped(b: Column) -> Column:
        marked = F.regexp_replace(F.translate(b, _PART, " "), f"({CODE})", f"{_PART}$1{_PART}")
        parts = F.transform(F.split(marked, _PART), lambda p, i: F.when(i % 2 == 1, strip_code(p)).otherwise(p))
        return F.when(_may_hold_code(b), F.array_join(parts, "")).otherwise(b)

    return let(block, stripped)


def split_blocks(text: Column) -> Column:
    """Blocks between empty lines, trimmed, without empty ones; CR LF CR LF is no break."""
    trimmed = F.transform(F.split(text, "\r?\n{2,}"), lambda b: trim_space(b))
    return F.filter(trimmed, lambda b: b != "")


def trim_space(text: Column) -> Column:
    return F.trim(text, F.lit(SPACES))


def squeeze_space(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, rf"{S}+", " "))


def replace_non_letters(text: Column) -> Column:
    """Everything that can't be part of a language name becomes a space, character by character."""
    return F.regexp_replace(text, NOT_KEPT, " ")


def _defining(text: Column) -> Column:
    """The parts of a text that may hold definitions, in a row; a definition has no parenthesis inside, so it lies in one of them."""
    return F.when(F.contains(text, F.lit("(")), F.array_join(F.regexp_extract_all(text, F.lit(DEFINING), F.lit(0)), "")).otherwise("")


def _acronyms(text: Column, *patterns: str) -> Column:
    found = lambda t: F.array_sort(F.array_distinct(F.concat(*(F.regexp_extract_all(t, F.lit(p), F.lit(2)) for p in patterns))))
    return let(let(text, _defining), lambda t: F.when(t != "", found(t)).otherwise(F.array().cast("array<string>")))


def defined_acronyms(text: Column) -> Column:
    """Acronyms that a normalised text defines after spaced or capital-hyphenated phrases, sorted."""
    return _acronyms(text, DEFINITION, HYPHENATED)


def paper_acronyms(text: Column) -> Column:
    """All acronyms that a text defines, in lower-case hyphenated phrases too; empty for null."""
    return _acronyms(normalise(F.coalesce(text, F.lit(""))), DEFINITION, HYPHENATED, LOWER_HYPHENATED)


def strip_definitions(block: Column) -> Column:
    """Parentheses of acronym definitions; the phrase stays."""
    both = lambda b: F.regexp_replace(F.regexp_replace(b, DEFINITION, "$1 "), HYPHENATED, "$1 ")
    return let(block, lambda b: F.when(F.contains(b, F.lit("(")) & F.regexp_like(b, F.lit(DEFINED)), both(b)).otherwise(b))


def _without(block: Column, acronym: Column) -> Column:
    parts = F.split(block, F.concat(F.lit(rf"(?<!{W})\Q"), acronym, F.lit(rf"\E(?!{W})")), -1)
    shows = lambda side: F.regexp_like(side, F.lit(CONTEXT))
    # an acronym has two characters at least, so this many parts make up the text around a place
    reach = CONTEXT_CHARS // 2 + 1

    def joined(p: Column) -> Column:
        before = lambda k: F.right(F.call_function("array_join", F.slice(p, F.greatest(k - reach + 1, F.lit(1)), F.least(k, F.lit(reach))), acronym), F.lit(CONTEXT_CHARS))
        after = lambda k: F.left(F.call_function("array_join", F.slice(p, k + 1, F.lit(reach)), acronym), F.lit(CONTEXT_CHARS))
        mark = lambda k: F.when(shows(before(k)) | shows(after(k)), acronym).otherwise(F.lit(" "))
        return F.array_join(F.transform(p, lambda x, k: F.when(k == 0, x).otherwise(F.concat(mark(k), x))), "")

    # a plain search leaves most blocks out
    return F.when(F.contains(block, acronym), let(parts, lambda p: F.when(F.size(p) > 1, joined(p)).otherwise(block))).otherwise(block)


def strip_acronyms(block: Column | str, acronyms: Column | str) -> Column:
    """Acronyms as words are replaced by a space, in order, but where a word that shows a language is meant stands near."""
    block, acronyms = (F.col(c) if isinstance(c, str) else c for c in (block, acronyms))
    return F.when(F.size(acronyms) > 0, F.aggregate(F.array_sort(acronyms), block, _without)).otherwise(block)


def strip_patterns(block: Column) -> Column:
    """All removals up to the acronyms, in order; code blocks come after addresses."""
    for name in STEPS:
        block = step(name)(block)
        if name == "email_addresses":
            block = strip_code_blocks(block)
    return block


def step_matches(block: Column) -> Column:
    """map(step -> what it removed from a block), each step seeing what the ones before left; steps without a match are left out.

    Long reports show their first matches (see REPORTED). acronym_catch has the acronyms that the block defines,
    replaced_chars the distinct characters that can't be part of a name in what is left.
    """
    none = F.array().cast("array<string>")

    def shown(name: str, found: Column) -> Column:
        return F.struct(F.lit(name).alias("key"), (F.slice(found, 1, REPORTED[name]) if name in REPORTED else found).alias("value"))

    def matches(pattern: str, b: Column) -> Column:
        return F.regexp_extract_all(b, F.lit(f"({pattern})"), F.lit(1))

    def report(names: list[str], b: Column, pairs: list[Column], acronyms: Column) -> Column:
        """The report from a step on, for the block as the steps before left it, which is made once."""
        if not names:
            replaced = F.array_sort(F.array_distinct(matches(NOT_KEPT, strip_definitions(b))))
            pairs = [*pairs, shown("acronym_catch", acronyms), shown("replaced_chars", replaced)]
            return F.map_from_entries(F.filter(F.array(*pairs), lambda p: F.size(p["value"]) > 0))
        name, *rest = names
        if name == "def_return_funcs":
            found, left = F.when(_may_hold_code(b), matches(CODE, b)).otherwise(none), strip_code_blocks(b)
        else:
            found, left = F.when(_may_match(name, b), matches(STEPS[name], b)).otherwise(none), step(name)(b)
        return let(left, lambda x: report(rest, x, [*pairs, shown(name, found)], acronyms))

    names = list(STEPS)
    names.insert(names.index("email_addresses") + 1, "def_return_funcs")
    return let(block, lambda b: report(names, b, [], defined_acronyms(b)))


def clean_blocks(df: DataFrame, text: str = "text", acronyms: str | None = None) -> DataFrame:
    """A row for each non-empty cleaned block: df's other columns, block_idx, block and the text's acronyms.

    acronyms: a column with acronyms that other parts of the paper define. Null or empty texts give no row.
    """
    rest = [c for c in df.columns if c not in (text, acronyms, "block_idx", "block", "acronyms")]
    given = F.coalesce(F.col(acronyms), F.array().cast("array<string>")) if acronyms else F.array().cast("array<string>")
    n = df.where(F.col(text) != "").withColumn("_n", normalise(F.col(text)))
    n = n.select(*rest, F.array_union(defined_acronyms(F.col("_n")), given).alias("acronyms"), F.posexplode(split_blocks(F.col("_n"))).alias("block_idx", "block"))
    n = n.withColumn("block", strip_definitions(strip_patterns(F.col("block"))))
    n = n.withColumn("block", strip_acronyms("block", "acronyms"))
    # exploded, so that a filter on the block isn't pushed below and makes it again
    clean = F.filter(F.array(F.trim(F.regexp_replace("block", BETWEEN, " "))), lambda b: b != "")
    return n.select(*rest, "acronyms", "block_idx", F.explode(clean).alias("block"))


def replaced_characters(blocks: DataFrame, block: str = "block") -> DataFrame:
    """(character, count) of what the whitelist replaces over all blocks."""
    return (
        blocks.select(F.explode(F.regexp_extract_all(block, F.lit(f"({NOT_KEPT})"), F.lit(1))).alias("character"))
        .groupBy("character").agg(F.count("*").alias("count"))
    )


def latin_letters(text: Column) -> Column:
    """Only ASCII letters and U+00C0 to U+00FF, other characters as spaces."""
    return F.regexp_replace(text, "[^A-Za-zÀ-ÿ]", " ")
