"""Regular expressions given in Python's dialect, run by the JVM.

A rule pattern is text. Before it reaches a plan it is checked with `re`, spelled
for Java, and reduced to a set of words of which every match contains at least one
(its anchors), so that a cheap substring test can stand before the regex.
"""

import re
import warnings
from functools import lru_cache

from pyspark.errors import PySparkException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

with warnings.catch_warnings():
    warnings.simplefilter("ignore", DeprecationWarning)
    import sre_parse

# Python counts these control characters as blanks, Java does not.
_EXTRA_BLANKS = "\\x1c-\\x1f"


_NAMED = re.compile(r"\(\?P=(\w+)\)")


def pattern_error(pattern: str | None) -> str | None:
    """Why a pattern cannot be used, or None."""
    if pattern is None:
        return "no pattern"
    try:
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            re.compile(pattern)
    except (re.error, RecursionError, OverflowError) as error:
        return str(error)
    return None


def to_java(pattern: str) -> str:
    """Spell a Python pattern for Java where the two dialects differ."""
    out, in_class, i = [], False, 0
    while i < len(pattern):
        pair = pattern[i : i + 2]
        ch = pattern[i]
        step = 1
        if ch == "\\":
            step = 2
            if pair == "\\Z":
                out.append("\\z")
            elif pair == "\\s":
                out.append("\\s" + _EXTRA_BLANKS if in_class else "[\\s" + _EXTRA_BLANKS + "]")
            elif pair == "\\S" and not in_class:
                out.append("[^\\s" + _EXTRA_BLANKS + "]")
            else:
                out.append(pair)
        elif not in_class and pattern.startswith("(?P<", i):
            step = 4
            out.append("(?<")
        elif not in_class and (named := _NAMED.match(pattern, i)):
            step = len(named[0])
            out.append(f"\\k<{named[1]}>")
        elif in_class and (ch == "[" or pair == "&&"):
            out.append("\\" + ch)
        else:
            if ch == "[":
                in_class = True
                # A bracket right after the opening one is an ordinary character.
                lead = "^" if pattern[i + 1 : i + 2] == "^" else ""
                step = 1 + len(lead)
                out.append(ch + lead)
                if pattern[i + step : i + step + 1] == "]":
                    out.append("\\]")
                    step += 1
                i += step
                continue
            if ch == "]":
                in_class = False
            out.append(ch)
        i += step
    return "".join(out)


def with_flags(pattern: str, ignore_case: bool, multiline: bool, unicode: bool) -> str:
    flags = ("i" if ignore_case else "") + ("m" if multiline else "")
    if unicode:
        flags += "uU" if ignore_case else "U"
    return (f"(?{flags})" if flags else "") + to_java(pattern)


def matches_empty(pattern: str) -> bool:
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        return sre_parse.parse(pattern).getwidth()[0] == 0


def _words(parsed) -> list[frozenset[str]]:
    """Word sets in reading order; each match contains a word of every set."""
    found, run = [], []

    def close():
        if run:
            found.append(frozenset(["".join(run)]))
            run.clear()

    for op, arg in parsed:
        if op is sre_parse.LITERAL:
            run.append(chr(arg))
            continue
        close()
        if op is sre_parse.SUBPATTERN and not arg[1] and not arg[2]:
            found.extend(_words(arg[3]))
        elif op in (sre_parse.MAX_REPEAT, sre_parse.MIN_REPEAT) and arg[0] > 0:
            found.extend(_words(arg[2]))
        elif op is sre_parse.BRANCH:
            sides = [_best(_words(side)) for side in arg[1]]
            if all(sides):
                found.append(frozenset().union(*sides))
    close()
    return found


def _best(sets: list[frozenset[str]]) -> frozenset[str]:
    return max(sets, key=lambda s: (min(map(len, s)), -len(s)), default=frozenset())


@lru_cache(maxsize=4096)
def anchors(pattern: str) -> tuple[str, ...]:
    """Lower-case ASCII words, one of which is in every ASCII match; () if none is certain."""
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        words = _best([s for s in _words(sre_parse.parse(pattern)) if "".join(s).isascii()])
    return tuple(sorted(w.lower() for w in words)) if len(words) <= 8 else ()


@lru_cache(maxsize=4096)
def _runs_on_jvm(java: str) -> bool:
    try:
        SparkSession.active().range(1).select(F.rlike(F.lit("x"), F.lit(java))).collect()
        return True
    except PySparkException:
        return False


def jvm_accepts(patterns: list[str]) -> list[bool]:
    """Which Java patterns compile; one probe for all of them, single probes only on failure."""
    try:
        probe = [F.rlike(F.lit("x"), F.lit(p)).alias(f"p{i}") for i, p in enumerate(patterns)]
        if probe:
            SparkSession.active().range(1).select(*probe).collect()
        return [True] * len(patterns)
    except PySparkException:
        return [_runs_on_jvm(p) for p in patterns]
