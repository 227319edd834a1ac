"""One state label per posting from free text and half-filled state columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from jobstrata.functions.cells import filled, first_of, lookup


@dataclass(frozen=True)
class PlaceRules:
    capital_pattern: str
    capital_label: str
    names: Sequence[str]
    code_in_text: str
    codes: Mapping[str, str]
    cities: Sequence[tuple[str, str]]
    unresolved: str
    # Accept codes from text or the state column only if they are known.
    validate: bool = False


def state_of(text: Column, state: Column, state_name: Column, rules: PlaceRules) -> Column:
    """First source that answers: capital pattern, name in text, code in text,
    state column, a valid state name, city list. Codes end up as names.

    ``coalesce`` stops at the first answer, and every pattern is written so that
    it is searched for once, not once to test and again to extract.
    """
    names, codes = list(rules.names), list(rules.codes)
    named = lookup(rules.codes)

    def full(label: Column) -> Column:
        return F.coalesce(named[F.upper(label)], label)

    def fixed(label: str) -> Column:
        return F.lit(rules.codes.get(label.upper(), label))

    def found(pattern: str) -> Column:
        return F.regexp_extract_all(text, F.lit(pattern), F.lit(1))

    def known(label: Column) -> Column:
        return label.isin(names) | F.upper(label).isin(codes)

    if rules.validate:
        by_code = F.transform(
            found(rules.code_in_text), lambda c: F.when(c.isin(names + codes), full(c))
        )
        by_state = F.when(known(state), full(state))
    else:
        by_code = F.transform(found(rules.code_in_text), full)
        by_state = F.when(filled(state), full(state))
    by_state_name = F.when(
        state_name.isin(names) | F.upper(F.trim(state_name)).isin(codes),
        full(F.trim(state_name)),
    )
    return F.coalesce(
        F.when(text.rlike(rules.capital_pattern), fixed(rules.capital_label)),
        F.get(F.transform(found(first_of(names)), full), F.lit(0)),
        F.get(by_code, F.lit(0)),
        by_state,
        by_state_name,
        *[F.when(text.rlike("(?i)" + p), fixed(label)) for p, label in rules.cities],
        fixed(rules.unresolved),
    )


def nationwide(location: Column, pattern: str) -> Column:
    """Whether a free-text location names the whole country or no place at all to go to;
    a null or blank one names nothing."""
    return F.coalesce(location.rlike(pattern), F.lit(False))
