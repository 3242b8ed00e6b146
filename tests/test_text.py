"""Column expressions on text, fields and credits."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyloom.functions import credits as CR
from tallyloom.functions import fields as L
from tallyloom.functions import text as X


def one(spark, expr, value):
    return spark.createDataFrame([(value,)], "v string").select(expr(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize("text, want", [
    ("Ça va? L'été 2024, ÑANDÚ!", ["ça", "va", "l", "été", "ñandú"]), ("", []), ("123 -- 4", []), ("a", ["a"])])
def test_words(spark, text, want):
    assert one(spark, X.words, text) == want


@pytest.mark.parametrize("text, kept, trimmed", [
    (" a  b  ", ["", "a", "", "b", "", ""], ["", "a", "", "b"]), ("", [""], [""]), ("  ", ["", "", ""], [])])
def test_space_pieces(spark, text, kept, trimmed):
    assert one(spark, X.space_pieces, text) == kept
    assert one(spark, lambda c: X.space_pieces(c, True), text) == trimmed


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(tokens=st.lists(st.sampled_from(["a", "b", "cc"]), max_size=8), n=st.integers(1, 5))
def test_ngrams(spark, tokens, n):
    got = one(spark, lambda c: X.ngrams(X.words(c), n), "\n".join(tokens))
    assert got == [" ".join(tokens[i:i + n]) for i in range(len(tokens) - n + 1)]
    assert len(got) == max(0, len(tokens) - n + 1)


def test_ngrams_need_a_word():
    with pytest.raises(ValueError):
        X.ngrams(F.array(), 0)


def test_hashtags(spark):
    assert one(spark, X.hashtags, "#Sismo! x#ñu_1 ## #a#B #a") == ["#sismo", "#ñu_1", "#a", "#b", "#a"]


def test_keywords_are_literal_and_ignore_case(spark):
    assert one(spark, X.contains_any, "Gran TERREMOTO hoy")
    assert not one(spark, X.contains_any, "nada")
    assert not one(spark, lambda c: X.contains_any(c, ["a.c"]), "abc")


@pytest.mark.parametrize("n, want", [("7", "0000000007"), ("1234567890", "1234567890"), ("123456789012", "123456789012")])
def test_padding_never_cuts(spark, n, want):
    assert one(spark, lambda c: X.zero_padded(c.cast("bigint")), n) == want


@pytest.mark.parametrize("text, want", [("x {ep} {b}", "ep"), ("x {}", ""), ("x {open", None), ("} {a}", "a"), ("", None)])
def test_between(spark, text, want):
    assert one(spark, lambda c: X.between(c, "{", "}"), text) == want


def test_quoted_literal(spark):
    line = '<s> <p> "dice \\"hola\\" y"@es .'
    assert one(spark, X.quoted_literal, line) == 'dice "hola" y'
    assert one(spark, X.quoted_literal, '<s> <p> "x"@en .') is None


def test_tail_text(spark):
    assert one(spark, lambda c: X.tail_text(c, 2), " a b\tc   d ") == "c d"
    assert one(spark, lambda c: X.tail_text(c, 5), "a b") == ""


def test_times(spark):
    assert one(spark, L.event_seconds, "1970-01-02 00:00:01") == 86401
    assert one(spark, L.event_seconds, "soon") is None
    assert one(spark, lambda c: L.time_text(c.cast("bigint")), "86401") == "1970-01-02 00:00:01"


def test_tab_line_writes_nulls(spark):
    row = spark.createDataFrame([("a", None)], "x string, y int").select(L.tab_line("x", "y").alias("l")).first()
    assert row["l"] == "a\tnull"


@pytest.mark.parametrize("text, want", [
    ("Plan 9 (1959)  [Cop]  <7>", ("Plan 9", 1959, None, "THEATRICAL_MOVIE", None, 7, "Cop")),
    ('"Show" (2001) {Pilot (#1.1)}  [Self]', ("Show", 2001, None, "TV_SERIES", "Pilot (#1.1)", None, "Self")),
    ('"Mini" (1999) (mini) {One}', ("Mini", 1999, None, "TV_MINI_SERIES", "One", None, None)),
    ("Same (2005/VIII) (V)", ("Same", 2005, "VIII", "VIDEO_MOVIE", None, None, None)),
    ("Game (2010) (VG)  <x>", ("Game", 2010, None, "VIDEO_GAME", None, None, None)),
    ("Later (????/II) (TV)", ("Later", None, "II", "TV_MOVIE", None, None, None)),
    ("Two (1999) Years (2003) (TV)", ("Two (1999) Years", 2003, None, "TV_MOVIE", None, None, None)),
    ("No year here", None),
])
def test_credits(spark, text, want):
    got = one(spark, CR.parse_credit, text)
    assert (None if got is None else tuple(got)) == want


def test_credit_line(spark):
    line = one(spark, lambda c: CR.format_credit(CR.parse_credit(c)), "Same (2005/VIII) (V)  [Cop]  <7>")
    assert line == "Same\t(2005)\t:VIDEO_MOVIE:#VIII#\t<7>\t[Cop]"


def test_light_spanish_stems(spark):
    words = {"libros": "libr", "casas": "cas", "luces": "luz", "intereses": "interes", "canción": "cancion", "canciones": "cancion",
             "árbol": "arbol", "niña": "niña", "niñas": "niñ", "grande": "grand", "sol": "sol", "mesas": "mes", "gatos": "gat", "": "",
             "feliz": "feliz", "felices": "feliz", "aéreo": "aere", "veces": "vez"}
    frame = spark.createDataFrame([(w,) for w in words], "w string")
    got = {r["w"]: r["s"] for r in frame.select("w", X.spanish_stem(F.col("w")).alias("s")).collect()}
    assert got == words
    assert spark.createDataFrame([(None,)], "w string").select(X.spanish_stem(F.col("w"))).first()[0] is None
