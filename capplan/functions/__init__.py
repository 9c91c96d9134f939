"""Column-level building blocks: fixed code values, predicates and labels."""

from capplan.functions.labelling import facts, holds, label, label_of_facts, product_rules
from capplan.functions.vocabulary import PREDICATES, predicate

__all__ = ["PREDICATES", "facts", "holds", "label", "label_of_facts", "predicate", "product_rules"]
