"""SQL text normalization: literals become '?', so one statement shape has one
fingerprint, and its SHA-256 is the shape's hash.

A statement is read as tokens from left to right: comments, quoted strings,
backtick names, numbers, words, blanks and single characters, whichever starts
first. So a comment mark inside a string is text, a quote inside a comment is a
comment, and `--` opens a comment only before a blank. Two patterns do that,
one for comments and one for literals: each takes, from where the last match
ended, all tokens that stay and then the token that goes, and puts the former
back. Possessive quantifiers keep that linear, without stack for long texts.
"""
from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from rowlog.functions.images import once

# An escaped quote or backslash never ends a string, so it may go beforehand.
_ESCAPES = r"""\\['"\\]"""
_COMMENT = r"/\*(?s:.*?)(?:\*/|\z)|--(?=\s|\z)[^\r\n]*+|#[^\r\n]*+"
_QUOTED = r"""[xXbBnN]?+'[^']*+'?+|"[^"]*+"?+"""
_NAME = "`[^`]*+`?+"
_NUMBER = (
    r"0[xX][0-9a-fA-F]++(?![\w$])|0[bB][01]++(?![\w$])"
    r"|[0-9]++(?:\.[0-9]*+)?+(?:[eE][+-]?+[0-9]++)?+(?![\w$])|(?<![\w$`.])\.[0-9]++(?:[eE][+-]?+[0-9]++)?+"
)
_IN_WORD = r"[\w$\x{80}-\x{10FFFF}&&[^\s]]"
_WORD = f"{_IN_WORD}++"
# The last one: digits before a dot that belongs to no number (`1.5x`).
_LITERAL = f"(?:{_QUOTED}|{_NUMBER}|[0-9]++(?:[eE][0-9]++)?+(?!{_IN_WORD}))"
# Tokens that stay, as many as there are, before a comment; then before a literal.
_TO_COMMENT = rf"""\G((?:'[^']*+'?+|"[^"]*+"?+|{_NAME}|[^'"`/#-]++|(?!{_COMMENT})[/#-])*+)(?:{_COMMENT})"""
_TO_LITERAL = rf"\G((?:(?!{_LITERAL})(?:{_NAME}|{_WORD}|\s++|(?s:.)))*+){_LITERAL}"


def _has(*marks):
    """A text holds one of some marks: a byte search, where the pattern that
    follows would step through the text."""
    return lambda v: reduce(or_, (F.contains(v, F.lit(m)) for m in marks))


def _comma(v: Column) -> Column:
    """Some comma has a blank before it, or none behind it."""
    return F.contains(v, F.lit(" ,")) | F.contains(F.replace(v, F.lit(", "), F.lit("")), F.lit(","))


def _in(v: Column) -> Column:
    return _has("in(", "in (")(F.lower(v))


_BLANKS = "\t\n\x0b\f\r"

# What follows on the short normalized text, in this order. Each
# pattern matches one item of a list at a time, and is used on texts that may
# hold one.
_TIDY = (
    (_has("??"), r"\?{2,}+", "?"),  # adjacent strings are one literal
    (_has("  "), " {2,}+", " "),
    (_comma, r" ?, ?", ", "),
    (_has("( "), r"\( ", "("),
    (_has(" )"), r" \)", ")"),
    (_has("-?", "- ?"), r"([(,=<>] ?)- ?\?", "$1?"),  # negative numbers
    (_in, r"(?i)\bIN ?\([?, ]++\)", "IN (...)"),
    (_has("?), ("), r"(?<=\?\)), \([?, ]++\)", ""),  # further rows of VALUES
)


def _replaced(c: Column, may: Callable[[Column], Column], pattern: str, repl: str) -> Column:
    return once(c, lambda v: F.when(may(v), F.regexp_replace(v, pattern, repl)).otherwise(v))


def fingerprint(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    out = _replaced(c, _has("\\"), _ESCAPES, "")
    out = _replaced(out, _has("/*", "--", "#"), _TO_COMMENT, "$1 ")
    out = F.translate(F.regexp_replace(out, _TO_LITERAL, "$1?"), _BLANKS, " " * len(_BLANKS))
    for step in _TIDY:
        out = _replaced(out, *step)
    return F.trim(out)


def query_hash(fp) -> Column:
    fp = F.col(fp) if isinstance(fp, str) else fp
    return F.sha2(fp, 256)
