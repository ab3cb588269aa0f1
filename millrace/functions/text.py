"""Scalar text functions as column expressions."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space of Unicode, spelled out: quicker than a class that asks for each character's properties. Fixed values.
WIDE_BLANK = r"\t-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
BLANK = rf"[\x20{WIDE_BLANK}]"
BLANKS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Without white space (Unicode's) at either end."""
    return F.trim(col(c), F.lit(BLANKS))


def truthy(*columns: Column | str, default: str | None = "") -> Column:
    """The first string that is neither null nor empty."""
    return F.coalesce(*[F.nullif(col(c), F.lit("")) for c in columns], F.lit(default))


def truthy_array(*columns: Column | str) -> Column:
    """The first array that is neither null nor empty; the empty array failing that."""
    first = [F.when(F.size(col(c)) > 0, col(c)) for c in columns]
    return F.coalesce(*first, F.filter(col(columns[0]), lambda _: F.lit(False)), F.array().cast("array<string>"))


def line_ends(c: Column | str) -> Column:
    """CR LF and CR to LF."""
    return F.replace(F.replace(col(c), F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))


def clean(c: Column | str) -> Column:
    """Line ends to LF, stripped; null to the empty text."""
    return F.coalesce(strip(line_ends(c)), F.lit(""))


def clean_squeezed(c: Column | str) -> Column:
    """As ``clean``, and runs of four or more LF to three."""
    return F.coalesce(strip(F.regexp_replace(line_ends(c), r"\n{4,}", "\n\n\n")), F.lit(""))


def _nfkc(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))


def nfkc(c: Column | str) -> Column:
    """NFKC form. Only texts with non-ASCII characters go to Python."""
    return F.coalesce(F.pandas_udf(_nfkc, "string")(F.when(col(c).rlike(r"[^\x00-\x7f]"), col(c))), col(c))


def hash_key(c: Column | str, unicode_forms: bool = True) -> Column:
    """The key by which texts count as equal: NFKC, lower case, white space squeezed, then punctuation dropped, stripped."""
    text = F.lower(nfkc(c) if unicode_forms else col(c))
    return strip(F.regexp_replace(F.regexp_replace(text, rf"{BLANK}{{2,}}|[{WIDE_BLANK}]", " "), r"[^a-zA-Z0-9_\s\p{L}\p{N}]", ""))


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is evaluated once, however often it is used, within lambdas too."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _runs(parts: Column, n: int, sep: str) -> Column:
    """Distinct runs of n elements of an array of strings, joined."""

    def of(p: Column) -> Column:
        joined = F.transform(F.sequence(F.lit(0), F.size(p) - n), lambda i: F.concat_ws(sep, *[F.get(p, i + k) for k in range(n)]))
        return F.when(F.size(p) >= n, F.array_distinct(joined)).otherwise(F.array().cast("array<string>"))

    return let(parts, of)


def char_ngrams(c: Column | str, n: int = 3) -> Column:
    """Distinct runs of n characters; none if the text is shorter."""
    return _runs(F.filter(F.split(col(c), ""), lambda x: x != ""), n, "")


def words(c: Column | str) -> Column:
    return F.filter(F.split(col(c), rf"{BLANK}+"), lambda w: w != "")


def word_ngrams(c: Column | str, n: int = 1) -> Column:
    """Distinct runs of n words, space-joined."""
    return _runs(words(c), n, " ")


def shingles(key: Column | str) -> Column:
    """Character 3-grams and word 2-grams of a hash key."""
    return let(col(key), lambda k: F.array_union(char_ngrams(k, 3), word_ngrams(k, 2)))


# Difficulty words in the order in which they are tried, and bounds of ratings.
EASY = ("easy", "0", "beginner", "1")
MEDIUM = ("medium", "1", "2", "intermediate")
HARD = ("hard", "3", "4", "5", "difficult", "expert", "2", "competition")
EASY_RATING, MEDIUM_RATING = 1200, 2000


def difficulty(c: Column | str) -> Column:
    """easy, medium, hard or unknown from a word or a rating."""
    s = F.lower(col(c).cast("string"))
    whole = F.when(s.rlike(r"^\s*[+-]?[0-9]+\s*$"), F.try_to_number(F.regexp_replace(s, r"[\s+]", ""), F.lit("S999999999999999999")))
    rating = F.when(whole <= EASY_RATING, "easy").when(whole <= MEDIUM_RATING, "medium").otherwise("hard")
    return F.when(s.isin(*EASY), "easy").when(s.isin(*MEDIUM), "medium").when(s.isin(*HARD), "hard").when(whole.isNotNull(), rating).otherwise("unknown")


def tag_list(c: Column | str, kind: str) -> Column:
    """Tags as an array: a string is split at commas, null is empty."""
    if kind == "string":
        parts = F.transform(F.split(col(c), ","), strip)
        return F.when(F.coalesce(col(c), F.lit("")) != "", parts).otherwise(F.array().cast("array<string>"))
    return F.coalesce(col(c), F.array().cast("array<string>"))


EXAMPLES = "array<struct<input:string,output:string>>"


def _as_list(v: Column) -> Column:
    """A JSON value (variant) as an array of texts: strings as they are, other values as JSON, a single value alone."""
    return F.coalesce(
        F.try_variant_get(v, "$", "array<string>"),
        F.when(F.try_variant_get(v, "$", "string").isNotNull(), F.array(F.try_variant_get(v, "$", "string"))),
    )


def _falsy_json(v: Column) -> Column:
    text = F.to_json(v)
    return v.isNull() | text.isin('""', "[]", "{}", "null", "0", "false")


def _part(v: Column, first: str, second: str) -> Column:
    a, b = F.try_variant_get(v, f"$.{first}", "variant"), F.try_variant_get(v, f"$.{second}", "variant")
    return F.when(~_falsy_json(a), a).otherwise(F.when(~_falsy_json(b), b))


def pair_up(inputs: Column, outputs: Column) -> Column:
    """Examples of two arrays, as many as the shorter has, stripped, five at most."""
    n = F.least(F.size(inputs), F.size(outputs), F.lit(5))
    both = F.zip_with(F.slice(inputs, 1, 5), F.slice(outputs, 1, 5), lambda a, b: F.struct(strip(a).alias("input"), strip(b).alias("output")))
    return F.when(n > 0, F.slice(both, F.lit(1), F.greatest(n, F.lit(0)))).otherwise(F.array().cast(EXAMPLES))


def examples_of_json(c: Column | str) -> Column:
    """Examples of JSON text: {inputs|input, outputs|output} or [{input|stdin, output|stdout}]; anything else has none.

    Nested lists and objects keep their JSON form.
    """
    v = F.try_parse_json(col(c))
    none = F.array().cast(EXAMPLES)
    is_list, is_object = col(c).rlike(r"^\s*\["), col(c).rlike(r"^\s*\{")
    of_object = pair_up(F.coalesce(_as_list(_part(v, "inputs", "input")), F.array().cast("array<string>")), F.coalesce(_as_list(_part(v, "outputs", "output")), F.array().cast("array<string>")))
    items = F.filter(F.try_variant_get(v, "$", "array<variant>"), lambda x: F.to_json(x).startswith("{"))
    text = lambda x, a, b: strip(F.coalesce(F.try_variant_get(_part(x, a, b), "$", "string"), F.lit("")))
    of_list = F.transform(items, lambda x: F.struct(text(x, "input", "stdin").alias("input"), text(x, "output", "stdout").alias("output")))
    return F.when(v.isNull(), none).when(is_object, of_object).when(is_list, F.slice(F.coalesce(of_list, none), 1, 5)).otherwise(none)


def solutions_of_json(c: Column | str) -> Column:
    """Solutions of text: JSON lists of strings or of {solution|code|content}, {solution: [...]}; text that isn't JSON is one.

    A JSON scalar has none; blank text neither.
    """
    v = F.try_parse_json(col(c))
    none = F.array().cast("array<string>")
    alone = F.when(strip(c) != "", F.array(col(c))).otherwise(none)
    langs, sols = F.try_variant_get(v, "$.language", "array<string>"), F.try_variant_get(v, "$.solution", "array<string>")
    of_object = F.slice(F.coalesce(sols, none), F.lit(1), F.greatest(F.least(F.size(F.coalesce(langs, none)), F.size(F.coalesce(sols, none))), F.lit(0)))

    def pick(x: Column) -> Column:
        own = [F.nullif(F.try_variant_get(x, f"$.{k}", "string"), F.lit("")) for k in ("solution", "code", "content")]
        shown = F.to_json(x)
        return F.when(shown.startswith("{"), F.coalesce(*own)).when(shown.startswith('"'), F.try_variant_get(x, "$", "string"))

    of_list = F.filter(F.transform(F.try_variant_get(v, "$", "array<variant>"), pick), lambda s: s.isNotNull())
    shown = F.to_json(v)
    return F.when(col(c).isNull(), none).when(v.isNull(), alone).when(shown.startswith("{"), of_object).when(shown.startswith("["), F.coalesce(of_list, none)).otherwise(none)


def any_of(c: Column | str, parts: Sequence[str]) -> Column:
    """Whether a text has any of some plain parts."""
    found = F.lit(False)
    for p in parts:
        found = found | F.contains(col(c), F.lit(p))
    return found


def size_text(n: Column | str) -> Column:
    """A number of units as readable text: 1.23B, 4.50M, 6.70K or as it is."""
    x = col(n).cast("double")
    return F.when(x >= 1e9, F.format_string("%.2fB", x / 1e9)).when(x >= 1e6, F.format_string("%.2fM", x / 1e6)).when(x >= 1e3, F.format_string("%.2fK", x / 1e3)).otherwise(x.cast("long").cast("string"))


def gigabytes(n: Column | str) -> Column:
    return col(n).cast("double") / F.lit(1024.0**3)


def alias(c: Column | str, names: dict[str, str]) -> Column:
    """A name by its short form; unknown names as they are."""
    if not names:
        return col(c)
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in names.items() for x in kv]), col(c)), col(c))
