"""Titles, wiki text and identifiers."""

from __future__ import annotations

import functools
import re
import sys
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .dates import let

# What a page title replaces, in order; later rules see what earlier ones made.
TITLE_REPLACEMENTS = (
    (":", "-"), ("/", "-"), ("\\", "-"), ("<", "-"), (">", "-"), ("''", '"'), ("[", "("), ("]", ")"),
    ("{", "("), ("}", ")"), ("#", "-"), ("|", "-"), ("�", "’"), ("_", " "),
)
TITLE_LENGTH = 181
# Sequences that wiki text must not hold, removed in order.
RESERVED_WIKITEXT = ("|", "=", "[[", "]]", "{{", "}}", "''")
# Code points that statement values must not hold.
BAD_CHARACTERS = "\ufeff\u200e\u200f\ufffe\uffff"
# What does not count at the ends of compared texts.
TRIMMED = " \t\r\n.,;:!?\"'`‘’“”()[]{}<>-‐‑‒–—…/\\|"
# Wiki magic words and what they stand for.
MAGIC_WORDS = {"{{!}}": "|", "{{=}}": "=", "{{((}}": "{{", "{{))}}": "}}", "{{!(}}": "{|", "{{)!}}": "|}"}
VALUE_LENGTH, CHUNK_LENGTH = 1499, 1500
WHITE = r"(?U)\s+"


def strip(c: Column) -> Column:
    """Without white space of any script at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def rstrip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)\s+$", "")


def break_query_pattern(title: Column) -> Column:
    """Titles with both & and = look like query strings to a title filter."""
    return F.when(title.contains("&") & title.contains("="), F.translate(title, "&=", "+-")).otherwise(title)


@functools.cache
def _capitals() -> tuple[str, str]:
    """Letters, and the capital of each where that is one code point."""
    found = {"ß": "ẞ"}
    for c in map(chr, range(sys.maxunicode + 1)):
        for one in (c.upper(), c.title()):
            if len(one) == 1 and one != c and c not in found:
                found[c] = one
                break
            if one == c:
                break
    return "".join(found), "".join(found.values())


def capital(letter: Column) -> Column:
    """A letter in upper case, always one code point: ß becomes ẞ, and ligatures, whose capitals are several, stay."""
    return F.translate(letter, *_capitals())


def page_title(title: Column, identifier: Column, suffix: Column, page: Column | None = None) -> Column:
    """The title of an item's page: cut, cleaned, first letter in upper case, identifier and page number added."""
    out = break_query_pattern(rstrip(F.substring(title, 1, TITLE_LENGTH)))
    for old, new in TITLE_REPLACEMENTS:
        out = F.replace(out, F.lit(old), F.lit(new))
    out = F.regexp_replace(out, r"\p{Cf}|\p{Cc}", " ")
    out = F.trim(F.regexp_replace(out, WHITE, " "))
    out = F.concat(capital(F.substring(out, 1, 1)), F.substring(out, 2, TITLE_LENGTH * 2))
    number = F.lit("") if page is None else F.when(F.coalesce(page, F.lit("")) != "", F.concat(F.lit(" (page "), page, F.lit(")"))).otherwise("")
    return F.concat(out, F.lit(" - DPLA - "), identifier, number, suffix)


def id_in_title(title: Column) -> Column:
    return F.nullif(F.regexp_extract(title, r"- DPLA - ([0-9a-f]{32})", 1), F.lit(""))


def page_in_title(title: Column) -> Column:
    """The page number before the last extension, or null."""
    return F.nullif(F.regexp_extract(title, r"\(page (\d+)\)(?=\.[^.]*$|$)", 1), F.lit("")).cast("int")


def extension(title: Column) -> Column:
    """Lower-case text after the last dot; empty without a dot."""
    return F.when(title.contains("."), F.lower(F.substring_index(title, ".", -1))).otherwise("")


def escape_parameter(value: Column) -> Column:
    return F.replace(value, F.lit("="), F.lit("{{=}}"))


def escape_wiki(value: Column) -> Column:
    for token in RESERVED_WIKITEXT:
        value = F.replace(value, F.lit(token), F.lit(""))
    return value


def join_escaped(values: Column) -> Column:
    return F.array_join(F.transform(values, escape_wiki), "; ")


def slug(name: Column) -> Column:
    return F.regexp_replace(F.replace(F.lower(name), F.lit(" "), F.lit("-")), "[^a-z0-9-]", "")


def canonical_title(title: Column) -> Column:
    return F.trim(F.regexp_replace(title, r"[\s_]+", " "))


def statement_value(text: Column) -> Column:
    """Bad code points dropped, runs of control characters one space, ends stripped; null and empty become empty."""
    out = F.translate(F.coalesce(text, F.lit("")), BAD_CHARACTERS, "")
    # printable ASCII without a space at an end is as it should be
    return F.when(text.rlike(r"^[!-~](?:[ -~]*[!-~])?\z"), text).otherwise(strip(F.regexp_replace(out, r"[\x00-\x1F\x7F-\x{9F}]+", " ")))


@F.pandas_udf(T.StringType())
def nfc(values: pd.Series) -> pd.Series:
    return values.map(lambda v: unicodedata.normalize("NFC", v), na_action="ignore")


@F.pandas_udf(T.StringType())
def casefolded(values: pd.Series) -> pd.Series:
    return values.map(str.casefold, na_action="ignore")


def magic_unescaped(value: Column) -> Column:
    """Magic words replaced in one pass, so that what a replacement makes is not replaced again: each word first becomes a
    code point that no text holds.  (No word can begin inside another.)"""
    marks = [chr(0xFDD0 + i) for i in range(len(MAGIC_WORDS))]
    for mark, word in zip(marks, MAGIC_WORDS, strict=True):
        value = F.replace(value, F.lit(word), F.lit(mark))
    for mark, plain in zip(marks, MAGIC_WORDS.values(), strict=True):
        value = F.replace(value, F.lit(mark), F.lit(plain))
    return value


def _case_folded(value: Column) -> Column:
    """Only texts beyond ASCII leave the JVM."""
    plain = value.rlike(r"^[\x00-\x7F]*$")
    return F.when(plain, F.lower(value)).otherwise(casefolded(F.when(~plain, value)))


def _trimmed(value: Column) -> Column:
    return F.regexp_replace(F.trim(value, F.lit(TRIMMED)), WHITE, " ")


def folded(value: Column) -> Column:
    """For comparing: magic words undone, punctuation at both ends dropped, white space collapsed, case folded; null is
    empty."""
    return _case_folded(_trimmed(magic_unescaped(F.coalesce(value, F.lit("")))))


def folded_parts(value: Column, delimiter: str = "; ") -> Column:
    """The parts of a joined value, each as for comparing; empty ones are left out."""
    parts = F.split(_case_folded(magic_unescaped(F.coalesce(value, F.lit("")))), re.escape(delimiter), -1)
    return F.filter(F.transform(parts, _trimmed), lambda x: x != "")


def cut_value(value: Column) -> Column:
    """At most VALUE_LENGTH characters, without white space at the end; null is empty."""
    return rstrip(F.substring(F.coalesce(value, F.lit("")), 1, VALUE_LENGTH))


def ellipsis(value: Column, limit: int) -> Column:
    """The first ``limit`` characters, with a note of the length where there are more; null is empty."""
    note = F.concat(F.substring(value, 1, limit), F.lit("... [truncated, "), F.length(value).cast("string"), F.lit(" chars total]"))
    return F.when(F.length(value) > limit, note).otherwise(F.coalesce(value, F.lit("")))


def chunks(value: Column, limit: int = CHUNK_LENGTH) -> Column:
    """Greedy parts of at most ``limit`` characters that join to the text; a cut never lies beside white space unless
    nothing else is left of it."""

    def step(state: Column, _: Column) -> Column:
        rest = state["rest"]
        window = F.substring(rest, 1, limit + 1)

        def cut(own: Column) -> Column:
            return F.struct(F.substr(rest, F.length(own) + 1).alias("rest"), F.concat(state["parts"], F.array(own)).alias("parts"))

        good = F.regexp_extract(window, r"(?sU)^(.*\S)\S", 1)
        last = F.struct(F.lit("").alias("rest"), F.when(rest == "", state["parts"]).otherwise(F.concat(state["parts"], F.array(rest))).alias("parts"))
        return F.when(F.length(rest) > limit, let(let(good, lambda g: F.when(g == "", F.substring(window, 1, limit)).otherwise(g)), cut)).otherwise(last)

    # two parts that follow each other are longer than the limit together
    turns = F.sequence(F.lit(1), 2 * F.ceil(F.length(value) / limit) + 2)
    start = F.struct(value.alias("rest"), F.array().cast("array<string>").alias("parts"))
    return F.when(F.length(value) > limit, F.aggregate(turns, start, step)["parts"]).otherwise(F.array(value))


def series_letter(n: Column) -> Column:
    """1 -> A, 26 -> Z, 27 -> AA, up to ZZZ."""
    letter = lambda x: F.chr(F.lit(65) + x)
    one, two = n - 1, n - 27
    three = n - 703
    return (
        F.when(n <= 26, letter(one))
        .when(n <= 702, F.concat(letter(F.floor(two / 26)), letter(two % 26)))
        .otherwise(F.concat(letter(F.floor(three / 676)), letter(F.floor(three / 26) % 26), letter(three % 26)))
    )


def is_item_id(c: Column) -> Column:
    return F.coalesce(c.rlike("(?i)^[0-9a-f]{32}$"), F.lit(False))


def is_entity_id(c: Column) -> Column:
    return F.coalesce(c.rlike(r"^Q\d+$"), F.lit(False))


def is_junk_value(c: Column) -> Column:
    bare = strip(c)
    return F.length(bare).between(1, 2) & ~bare.rlike(r"[\p{L}\p{N}]")


def multi_value_subset(value: Column, canonical: Column, delimiter: str = "; ") -> Column:
    """Whether the folded parts of one joined value are all among those of another that has several."""
    mine, theirs = folded_parts(value, delimiter), folded_parts(canonical, delimiter)
    return F.coalesce(canonical.contains(delimiter) & (F.size(mine) > 0) & (F.size(F.array_except(mine, theirs)) == 0), F.lit(False))
