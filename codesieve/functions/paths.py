"""Path columns: name, extension, depth, language, glob matching."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from codesieve import vocab
from codesieve.functions.literals import literal_map


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def extension(path: Column) -> Column:
    """Last suffix with its dot, in lower case; '' for dot files and trailing dots."""
    return F.lower(F.regexp_extract(file_name(path), r"(?s)^.+(\.[^.]+)$", 1))


def language(path: Column) -> Column:
    known = F.try_element_at(literal_map(vocab.EXTENSION_LANGUAGE), extension(path))
    return F.coalesce(known, F.lit(vocab.UNKNOWN_LANGUAGE))


def depth(path: Column) -> Column:
    """Number of directories above the file."""
    return F.size(F.split(path, "/")) - 1


def short_path(path: Column) -> Column:
    """Parent directory and file name."""
    return F.substring_index(path, "/", -2)


def glob_regex(glob: str) -> str:
    """Anchored regex for a glob that is compared with the last parts of a path."""
    out, i = [], 0
    while i < len(glob):
        ch = glob[i]
        close = glob.find("]", i + 2) if ch == "[" else -1
        if ch == "*":
            out.append("[^/]*")
        elif ch == "?":
            out.append("[^/]")
        elif close > 0:
            body = glob[i + 1 : close].replace("\\", "\\\\").replace("[", "\\[").replace("&", "\\&")
            out.append("[^" + body[1:] + "]" if body[0] == "!" else "[" + body + "]")
            i = close
        else:
            out.append("\\" + ch if not (ch.isalnum() or ch in "_/ ") else ch)
        i += 1
    return "(?s)(^|/)" + "".join(out).replace("[^/]*[^/]*", "[^/]*") + "\\z"


def any_glob(path: Column, globs: list[str]) -> Column:
    return F.rlike(path, F.lit("|".join(glob_regex(g) for g in globs))) if globs else F.lit(False)
