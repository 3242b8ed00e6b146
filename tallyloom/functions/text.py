"""Column expressions on text: tokens, n-grams, hashtags, keywords."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Patterns and words that decide the results.
NON_LETTERS = r"[^\p{L}]+"
HASHTAG = r"#[\p{L}\p{N}_]+"
QUAKE_WORDS = ("terremoto", "temblor", "sismo", "quake")
COUNT_WIDTH = 10


def bind(value: Column, use) -> Column:
    """``use`` applied to a value that is computed once per row.

    An expression used in several places, above all inside a lambda, would be
    computed for each of them; a lambda variable is not.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def with_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a costly column that is computed once per row.

    Filters and later columns read the output of a generator; over a plain
    projection the optimizer may copy the expression into each of them.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def words(text: Column) -> Column:
    """Runs of letters, lower-cased after the split, empties dropped."""
    pieces = F.filter(F.split(text, NON_LETTERS), lambda w: w != "")
    return F.transform(pieces, F.lower)


def space_pieces(text: Column, drop_trailing: bool = False) -> Column:
    """Split on single spaces, case and empty pieces kept.

    ``drop_trailing`` leaves out the empty pieces at the end; a text of
    nothing but spaces then yields no piece at all.
    """
    if drop_trailing:
        bare = F.regexp_replace(text, r" +$", "")
        no_piece = (bare == "") & (text != "")
        return F.when(~no_piece, F.split(bare, " ")).otherwise(F.array().cast("array<string>"))
    return F.split(text, " ")


def ngrams(tokens: Column, n: int) -> Column:
    """Every run of ``n`` neighbouring tokens joined by a space, in order."""
    if n < 1:
        raise ValueError("n must be at least 1")

    def runs(t: Column) -> Column:
        starts = F.when(F.size(t) >= n, F.sequence(F.lit(1), F.size(t) - (n - 1)))
        return F.transform(
            F.coalesce(starts, F.array().cast("array<int>")),
            lambda i: F.array_join(F.slice(t, i, n), " "),
        )

    return bind(tokens, runs)


def hashtags(text: Column) -> Column:
    """All hashtags of the lower-cased text, repeats kept."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"({HASHTAG})"), 1)


def contains_any(text: Column, keywords=QUAKE_WORDS) -> Column:
    """True once if any keyword occurs, whatever the case."""
    quoted = "|".join(re.escape(k.lower()) for k in keywords)
    return F.lower(text).rlike(quoted)


def zero_padded(count: Column, width: int = COUNT_WIDTH) -> Column:
    """Left-pad with zeros; a number that is already wider stays whole."""
    digits = count.cast("string")
    return F.when(F.length(digits) >= width, digits).otherwise(F.lpad(digits, width, "0"))


def spanish_stem(word: Column) -> Column:
    """A lower-cased Spanish word by the published light stemming rules: accents off, then one plural or gender ending.

    Words of fewer than five letters stay as they are.
    """
    plain = F.translate(word, "àáâäòóôöèéêëùúûüìíîï", "aaaaooooeeeeuuuuiiii")

    def cut(p: Column) -> Column:
        def ends(*endings: str) -> Column:
            return F.right(p, F.lit(len(endings[0]))).isin(*endings)

        def less(n: int) -> Column:
            return F.left(p, F.length(p) - n)

        return (F.when(ends("o", "a", "e"), less(1)).when(ends("eses"), less(2))
                .when(ends("ces"), F.concat(less(3), F.lit("z"))).when(ends("os", "as", "es"), less(2)).otherwise(p))

    return F.when(F.length(word) < 5, word).otherwise(bind(plain, cut))


def between(text: Column, opening: str, closing: str) -> Column:
    """The text after the first ``opening`` up to the next ``closing``, else null."""
    start = F.instr(text, opening)
    rest = F.substring(text, start + len(opening), F.length(text))
    end = F.instr(rest, closing)
    return F.when((start > 0) & (end > 0), F.substring(rest, F.lit(1), end - 1))


def quoted_literal(line: Column, language: str = "es") -> Column:
    """The literal of an RDF line, inner quotes unescaped; null if there is none."""
    opening, closing = ' "', f'"@{language} .'
    start, end = F.instr(line, opening), F.instr(line, closing)
    body = F.substring(line, start + len(opening), end - start - len(opening))
    return F.when((start > 1) & (end > start), F.replace(body, F.lit('\\"'), F.lit('"')))


def tail_text(text: Column, first: int) -> Column:
    """Whitespace-separated fields from position ``first`` (0-based) on, space-joined."""
    parts = F.filter(F.split(text, r"\s+"), lambda p: p != "")
    left = F.greatest(F.size(parts) - first, F.lit(0))
    return F.array_join(F.slice(parts, F.lit(first + 1), left), " ")
