"""Column expressions that clean one value. All run inside Spark, none in Python.

Bad text yields null instead of an error: casts, dates and divisions use the
``try_`` forms, since ANSI mode would end the job on the first dirty cell.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F


def any_of(patterns: Sequence[str]) -> str:
    """A case-insensitive regex that matches any of the patterns as a substring."""
    return "(?i)" + "|".join(patterns)


def first_of(names: Sequence[str]) -> str:
    """A regex whose group 1 is the leftmost of the plain names in a text, the earlier
    listed one where two start at the same place. Grouping them by first letter lets
    the search skip every position that none of them can start at."""
    by_initial: dict[str, list[str]] = {}
    for name in names:
        by_initial.setdefault(name[0], []).append(name[1:])
    branches = [f"{initial}(?:{'|'.join(rest)})" for initial, rest in by_initial.items()]
    return f"(?=[{''.join(by_initial)}])({'|'.join(branches)})"


def filled(col: Column) -> Column:
    """True when the text holds more than blanks; null and blank are False."""
    return F.coalesce(F.trim(col.cast("string")) != "", F.lit(False))


def filled_list(col: Column) -> Column:
    """True when a JSON list cell is neither blank nor the literal ``[]``."""
    return filled(col) & (F.trim(col) != "[]")


def number(col: Column) -> Column:
    """Plain decimal text to double; blank and other text ("NaN", "5d") become null."""
    text = col.cast("string")
    plain = text.rlike(r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$")
    return F.when(plain, text.try_cast("double"))


def day(col: Column, fmt: str = "yyyy-MM-dd") -> Column:
    """Text to date; blank and malformed text become null."""
    return F.try_to_date(col, fmt)


def lookup(mapping: Mapping[str, object]) -> Column:
    """A fixed mapping as a literal map; build it once and use it for several columns."""
    return F.create_map(*[F.lit(part) for pair in mapping.items() for part in pair])


def relabel(col: Column, mapping: Mapping[str, object], default: Column | None = None) -> Column:
    """Look a value up in a fixed mapping; a miss gives ``default``, else the value itself."""
    return F.coalesce(lookup(mapping)[col], col if default is None else default)


def keep_labels(col: Column, keep: Sequence[str], other: str = "Other") -> Column:
    return F.when(col.isin(list(keep)), col).otherwise(F.lit(other))


def canonical_label(col: Column, synonyms: Mapping[str, str], unknown: str) -> Column:
    """Null or blank to ``unknown``, known spellings (any case) merged, the rest as is."""
    named = F.coalesce(lookup(synonyms)[F.lower(col)], col)
    return F.when(~filled(col), F.lit(unknown)).otherwise(named)


def first_match(col: Column, rules: Sequence[tuple[str, str]], default: str) -> Column:
    """Label of the first rule whose regex is found in the lower-cased text."""
    text = F.lower(col)
    label = F.lit(default)
    for pattern, name in reversed(rules):
        label = F.when(text.rlike(pattern), F.lit(name)).otherwise(label)
    return label


def keep_between(col: Column, low: float, high: float) -> Column:
    return F.when(col.between(low, high), col)


def band(col: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the right-closed interval ``(edge, next edge]`` holding the value."""
    label = F.lit(None).cast("string")
    for low, high, name in reversed(list(zip(edges[:-1], edges[1:], labels, strict=True))):
        label = F.when((col > low) & (col <= high), F.lit(name)).otherwise(label)
    return label


def name_key(col: Column, suffix: str) -> Column:
    """Spelling-blind company key: letters and digits only, one trailing suffix dropped."""
    return F.regexp_replace(F.regexp_replace(F.lower(col), "[^a-z0-9]", ""), suffix, "")


def or_label(col: Column, label: str) -> Column:
    return F.coalesce(col, F.lit(label))


def url_like(col: Column, pattern: str) -> Column:
    """Whether a name reads like a web address; null stays null."""
    return col.rlike(pattern)


def has_item(items: Column, item: str) -> Column:
    """Whether a list holds the item as written; a null or empty list holds nothing."""
    return F.coalesce(F.exists(items, lambda x: x.eqNullSafe(F.lit(item))), F.lit(False))


def text_list(col: Column) -> Column:
    """JSON list text to a set of strings, nulls left out; text not starting with ``[`` is empty."""
    parsed = F.array_compact(F.from_json(col, "array<string>"))
    return F.coalesce(
        F.array_distinct(F.when(F.startswith(col, F.lit("[")), parsed)),
        F.array().cast("array<string>"),
    )


def share(part: Column, whole: Column, digits: int) -> Column:
    """``part`` in percent of ``whole``, null where the whole is zero."""
    return F.round(F.try_divide(100.0 * part, whole), digits)
