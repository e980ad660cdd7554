"""Text functions as column expressions, with the semantics of Python's str and re."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Clean-up rules applied in this order, and the character replacements of the final normalisation.
CLEANUP = [(r"\n\s*\d+\s*\n", "\n"), (r"\n{3,}", "\n\n"), (r"[ \t]+\n", "\n")]
QUOTES_FROM, QUOTES_TO, DELETED = "‘’“”–— ", "''\"\"-- ", "\x00�"
BLANKS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
HASH_CHARS, HASH_HEX, EMBED_CHARS = 500, 12, 400


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def let(x: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of the value of ``x``, which is found once however often the body uses it."""
    return F.get(F.transform(F.array(x), body), F.lit(0))


def strip(x: Column | str) -> Column:
    """str.strip(): Unicode white space at both ends."""
    # from either end, as an expression for both would look at every blank in between
    return F.reverse(F.ltrim(F.reverse(F.ltrim(_c(x), F.lit(BLANKS))), F.lit(BLANKS)))


def clean(x: Column | str, rules: Sequence[tuple[str, str]] = CLEANUP) -> Column:
    """The clean-up rules in order, then strip. Own rules replace the default ones; [] only strips."""
    out = _c(x)
    for pattern, by in rules:
        out = F.regexp_replace(out, f"(?dU){pattern}", by)
    return strip(out)


def normalize(x: Column | str) -> Column:
    """Plain quotes, dashes and spaces; no NUL or replacement characters; runs of blanks and blank lines collapsed."""
    out = F.translate(_c(x), QUOTES_FROM + DELETED, QUOTES_TO)
    return strip(F.regexp_replace(F.regexp_replace(out, r"[ \t]+", " "), r"\n{3,}", "\n\n"))


def entity_key(x: Column | str) -> Column:
    return F.lower(strip(x))


def question_key(x: Column | str) -> Column:
    """Lower case, no punctuation, single spaces."""
    bare = F.regexp_replace(F.lower(strip(x)), r"(?U)[^\p{L}\p{N}_\s]", "")
    return strip(F.regexp_replace(bare, r"(?U)\s+", " "))


def hash_id(x: Column | str) -> Column:
    """The first hex digits of the md5 of the first code points."""
    return F.substring(F.md5(F.encode(F.substring(_c(x), 1, HASH_CHARS), "UTF-8")), 1, HASH_HEX)


def embedding_text(x: Column | str, limit: int = EMBED_CHARS) -> Column:
    out = F.translate(F.substring(_c(x), 1, limit), DELETED, "  ")
    return F.when(strip(out) == "", F.lit("empty")).otherwise(out)


def cut_at_sentence(x: Column | str, most: int, least: int) -> Column:
    """Over ``most`` characters: cut there, and back to the last full stop if that lies behind ``least``."""
    x = _c(x)
    head = F.substring(x, 1, most)
    back = F.locate(".", F.reverse(head))
    stop = F.length(head) - back  # 0-based place of the last full stop
    return F.when(F.length(x) <= most, x).otherwise(F.when((back > 0) & (stop > least), F.substring(head, F.lit(1), stop + 1)).otherwise(head))


def cut_to_full_stop(x: Column | str, most: int = 1500) -> Column:
    """Over ``most`` characters: up to the last full stop within, or all of them, and a full stop."""
    x = _c(x)
    head = F.substring(x, 1, most)
    upto = F.regexp_extract(head, r"(?s)^(.*)\.", 1)
    return F.when(F.length(x) <= most, x).otherwise(F.concat(F.when(F.locate(".", head) > 0, upto).otherwise(head), F.lit(".")))


def split_clean(x: Column | str, sep: str) -> Column:
    """Parts between separators, stripped, without empty ones."""
    return F.filter(F.transform(F.split(_c(x), sep), strip), lambda p: p != "")


def longest(parts: Column | str) -> Column:
    """The longest string, the first on ties; null for none."""
    return F.aggregate(_c(parts), F.lit(None).cast("string"), lambda best, s: F.when(best.isNull() | (F.length(s) > F.length(best)), s).otherwise(best))


def distinct_ignoring_case(parts: Column | str) -> Column:
    """First of each spelling, in order."""
    parts = _c(parts)
    return F.filter(parts, lambda s, i: F.array_position(F.transform(parts, entity_key), entity_key(s)) == i + 1)


def pick(key: Column | str, choices: int) -> Column:
    """A repeatable choice by content: 0 .. choices - 1."""
    return F.pmod(F.conv(F.substring(F.md5(F.encode(_c(key), "UTF-8")), 1, 8), 16, 10).cast("long"), F.lit(choices).cast("long")).cast("int")


def choose(key: Column | str, templates: Sequence[Column]) -> Column:
    return F.element_at(F.array(*templates), pick(key, len(templates)) + 1)


def fill(template: str, **values: Column) -> Column:
    """``template`` with {name} replaced by columns."""
    import re

    parts = [values[p[1:-1]] if p.startswith("{") else F.lit(p) for p in re.split(r"(\{\w+\})", template) if p]
    return F.concat(*parts)


def replace_first(x: Column | str, old: str | Column, new: str | Column) -> Column:
    x, old, new = _c(x), F.lit(old) if isinstance(old, str) else old, F.lit(new) if isinstance(new, str) else new
    at = F.instr(x, old)
    return F.when(at > 0, F.overlay(x, new, at, F.length(old))).otherwise(x)


def first_description(x: Column | str) -> Column:
    return strip(F.split(_c(x), "<SEP>")[0])


def context_of(x: Column | str) -> Column:
    """The last level named in a leading [Livre: ...] context; empty without one."""
    inner = F.regexp_extract(_c(x), r"(?iu)\[Livre\s*:\s*([^\]]+)\]", 1)
    last = strip(F.element_at(F.split(inner, ">"), -1))
    return strip(F.element_at(F.split(last, ":"), -1))


def context_prefix(levels: Sequence[str]) -> Column:
    """"[Livre: a > Titre: b]" and a blank line, of the levels that are set; empty if none is."""
    parts = [F.when(F.coalesce(F.col(n), F.lit("")) != "", F.concat(F.lit(n.replace("_", "-").capitalize() + ": "), F.col(n))) for n in levels]
    path = F.concat_ws(" > ", *parts)
    return F.when(path == "", F.lit("")).otherwise(F.concat(F.lit("["), path, F.lit("]\n\n")))


def reason_bucket(x: Column | str) -> Column:
    return F.trim(F.substring_index(_c(x), "(", 1))


def label(x: Column | str, most: int = 40, keep: int = 37) -> Column:
    x = _c(x)
    return F.when(F.length(x) >= most, F.concat(F.substring(x, 1, keep), F.lit("..."))).otherwise(x)


def shorten(x: Column | str, most: int = 300) -> Column:
    x = _c(x)
    return F.when(F.length(x) > most, F.concat(F.substring(x, 1, most), F.lit("..."))).otherwise(x)
