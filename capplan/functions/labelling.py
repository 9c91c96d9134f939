"""Ordered first-match classification, on columns or on a word of facts.

Rules are lists of ``(label, predicates that must all hold)``. ``label`` evaluates them
on the record's columns. Where the same records are labelled again for every simulated
run, ``facts`` evaluates each atom once per record into one bit of an integer, and
``label_of_facts`` decides the rules by masks: a few machine instructions per row,
however long the code lists behind the atoms are.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from itertools import product

from pyspark.sql import Column
from pyspark.sql import functions as F

from capplan.functions.vocabulary import ATOMS, alternatives, condition

Rule = tuple[str, tuple[str, ...]]

_BIT: dict[str, int] = {name: 1 << position for position, name in enumerate(ATOMS)}


def _first_match(pairs: Iterable[tuple[str, str]], otherwise: str | None) -> Column:
    """Label of the first condition that is true; ``otherwise`` (or NULL) if none is."""
    branches = " ".join(f"WHEN {test} THEN '{name}'" for name, test in pairs)
    default = "" if otherwise is None else f" ELSE '{otherwise}'"
    return F.expr(f"CASE {branches}{default} END")


def label(rules: Sequence[Rule], otherwise: str | None = None) -> Column:
    """Label of an ordered rule list over the record's columns."""
    return _first_match([(name, condition(*needed)) for name, needed in rules], otherwise)


def atoms_of(names: Iterable[tuple[str, ...]]) -> tuple[str, ...]:
    """Every atom the given conjunctions of predicates depend on, in vocabulary order."""
    used = {atom for needed in names for way in alternatives(*needed) for atom in way}
    return tuple(atom for atom in ATOMS if atom in used)


def facts(atoms: Iterable[str]) -> Column:
    """BIGINT with the bit of each given atom that is true; unknown counts as not true."""
    bits = [f"CASE WHEN {ATOMS[atom]} THEN {_BIT[atom]}L ELSE 0L END" for atom in atoms]
    return F.expr(" | ".join(bits) or "0L")


def _mask_test(word: str, needed: Iterable[str]) -> str:
    masks = [sum(_BIT[atom] for atom in way) for way in alternatives(*needed)]
    return " OR ".join(f"({word} & {mask}L) = {mask}L" for mask in masks)


def holds(word: str, *names: str) -> Column:
    """Whether the word of facts in column ``word`` satisfies all the named predicates."""
    return F.expr(_mask_test(word, names))


def label_of_facts(word: str, rules: Sequence[Rule], otherwise: str | None = None) -> Column:
    """Label of an ordered rule list over the word of facts in column ``word``."""
    return _first_match([(name, _mask_test(word, needed)) for name, needed in rules], otherwise)


def product_rules(dimensions: Sequence[Mapping[str, str]]) -> tuple[Rule, ...]:
    """One rule per combination of the dimensions, label parts joined by ``_``.

    A dimension maps a label part to the predicate that decides it.
    """
    return tuple(
        ("_".join(part for part, _ in combination), tuple(name for _, name in combination))
        for combination in product(*(dimension.items() for dimension in dimensions))
    )
