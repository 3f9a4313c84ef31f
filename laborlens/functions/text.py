"""Text columns: skill extraction, cleaning and delimited lists."""

from __future__ import annotations

import re
from collections.abc import Sequence
from itertools import groupby

from pyspark.sql import Column, functions as F

WORD = r"[\p{L}\p{N}_]"


def _is_word(char: str) -> bool:
    return char.isalnum() or char == "_"


def _bounds(term: str, boundary: str) -> tuple[str, str]:
    strict = boundary == "lookaround"
    head = f"(?<!{WORD})" if strict or _is_word(term[0]) else f"(?<={WORD})"
    tail = f"(?!{WORD})" if strict or _is_word(term[-1]) else f"(?={WORD})"
    return head, tail


def vocabulary_pattern(vocabulary: Sequence[str], boundary: str = "word") -> str:
    """One alternation over the lower-cased vocabulary, for lower-cased text.

    ``boundary='word'`` places a word boundary at both ends. For a term that ends
    in a symbol (``C++``) a boundary exists only before a word character, so such
    a term does not match before a space. ``boundary='lookaround'`` asks only that
    no word character touches the term, which finds those terms as well.
    The boundaries are spelt as Unicode look-arounds because the meaning of
    ``\\b`` outside ASCII depends on the Java version.
    """
    if boundary not in ("word", "lookaround"):
        raise ValueError(f"unknown boundary {boundary!r}")
    runs = []
    for (head, tail), terms in groupby((t.lower() for t in vocabulary), key=lambda t: _bounds(t, boundary)):
        runs.append(f"{head}(?:{'|'.join(re.escape(t) for t in terms)}){tail}")
    return "(" + "|".join(runs) + ")"


def _can_overlap(vocabulary: Sequence[str]) -> bool:
    """Whether two terms could claim the same stretch of a text.

    Then a left-to-right scan reports one of them only, and the terms cannot be
    looked up independently.
    """

    def joined(left: str, right: str) -> bool:
        return _is_word(left) and _is_word(right)

    terms = {t.lower() for t in vocabulary}
    for a in terms:
        for i in range(len(a)):
            if i and joined(a[i - 1], a[i]):
                continue
            rest = a[i:]
            for b in terms - {a}:
                short, long = sorted((rest, b), key=len)
                if long.startswith(short) and (len(short) == len(long) or not joined(short[-1], long[len(short)])):
                    return True
    return False


def extract_skills(text: Column | str, vocabulary: Sequence[str], boundary: str = "word") -> Column:
    """Distinct canonical vocabulary terms found in the whole text; NULL text gives [].

    Single words are found by intersecting the words of the text with the
    vocabulary, which costs the same for ten terms or ten thousand. Terms with
    spaces or symbols are tested by substring first and by pattern only on a hit.
    A vocabulary whose terms can overlap is scanned with one alternation instead.
    """
    names: dict[str, str] = {}
    for term in vocabulary:
        names.setdefault(term.lower(), term)
    # the long s is the one letter that ignores case without being lower-cased to its partner
    folded = F.lower(F.translate(_column(text), "ſ", "s"))
    canonical = F.create_map(*[F.lit(part) for pair in names.items() for part in pair])

    def named(hits: Column) -> Column:
        return F.transform(hits, lambda hit: F.element_at(canonical, hit))

    if _can_overlap(vocabulary):
        hits = F.regexp_extract_all(folded, F.lit(vocabulary_pattern(vocabulary, boundary)), 1)
        found = named(F.array_distinct(hits))
    else:
        words = [t for t in names if all(_is_word(c) for c in t)]
        phrases = [t for t in names if t not in words]
        tokens = F.split(folded, f"[^{WORD[1:]}+")
        parts = []
        if words:
            parts.append(named(F.array_intersect(tokens, F.array(*[F.lit(w) for w in words]))))
        if phrases:
            parts.append(F.array_compact(F.array(*[
                F.when(folded.contains(t) & folded.rlike(vocabulary_pattern([t], boundary)), F.lit(names[t]))
                for t in phrases
            ])))
        found = F.concat(*parts)
    return F.coalesce(found, F.array().cast("array<string>"))


def joined_text(*columns: Column | str) -> Column:
    """Columns joined by one space; NULL parts are left out."""
    return F.concat_ws(" ", *[_column(c) for c in columns])


def clean_text(column: Column | str) -> Column:
    return F.lower(F.trim(_column(column)))


def split_list(column: Column | str, separator: str = ",") -> Column:
    """Delimited text as an array of trimmed, non-blank items; blank text gives NULL."""
    text = _column(column)
    items = F.array_remove(F.split(F.trim(text), rf"\s*{re.escape(separator)}\s*"), "")
    return F.when(F.trim(text) != "", items)


def join_list(column: Column | str, separator: str = ",") -> Column:
    """Sorted distinct items as delimited text."""
    return F.array_join(F.array_sort(F.array_distinct(_column(column))), separator)


def first_n(column: Column | str, n: int) -> Column:
    return F.slice(_column(column), 1, n)


def shorten(column: Column | str, length: int) -> Column:
    return F.left(_column(column), F.lit(length))


def month_key(column: Column | str) -> Column:
    """The ``yyyy-MM`` head of an ISO date text."""
    return F.substring(_column(column), 1, 7)


def fill_template(template: str, column: Column | str) -> Column:
    """``{}`` in the template replaced by the column, as in 'Senior {} Engineer'."""
    return F.format_string(template.replace("%", "%%").replace("{}", "%s"), _column(column))


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value
