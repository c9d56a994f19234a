"""Predicates on terms and rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that make a term worthless. The empty word stands for stray blanks.
DROP_WORDS = ["", "you", "have", "work"]


def is_single_non_ascii(term: Column) -> Column:
    """One word only, and not plain ASCII (more bytes than characters)."""
    return ~F.contains(term, F.lit(" ")) & (F.octet_length(term) != F.char_length(term))


def has_drop_word(term: Column) -> Column:
    """Any blank-separated word is a drop word."""
    return F.arrays_overlap(F.split(term, " ", -1), F.array(*[F.lit(word) for word in DROP_WORDS]))


def is_numeric(term: Column) -> Column:
    """Unicode number characters only."""
    return term.rlike(r"^\p{N}+\z")


def is_admissible(term: Column) -> Column:
    """Worth comparing with the dictionary."""
    return ~(is_single_non_ascii(term) | has_drop_word(term) | is_numeric(term))


def has_empty_section(*sections: Column) -> Column:
    """Any of the sections is the empty string."""
    empty = F.lit(False)
    for section in sections:
        empty = empty | (section == "")
    return empty


def is_digits(label: Column) -> Column:
    """A label made of digits only."""
    return label.rlike(r"^\d+\z")
