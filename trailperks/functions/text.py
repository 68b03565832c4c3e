"""Text rules of the exploration: addresses, labels, postcodes, number formatting."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from trailperks import labels as L

# Separators that count as blanks when names are compared.
SEPARATORS = "-'"


def strip_blanks(text: Column) -> Column:
    """Remove all white space at both ends, not only spaces."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def address_postcode(address: Column) -> Column:
    """Postcode in front of the town at the end of an address; NULL without one."""
    return F.nullif(F.regexp_extract(address, L.ADDRESS_PATTERN, 1), F.lit(""))


def address_town(address: Column) -> Column:
    """Town after the postcode, else the last comma-separated part."""
    matched = F.nullif(F.regexp_extract(address, L.ADDRESS_PATTERN, 2), F.lit(""))
    last_part = F.element_at(F.split(address, ","), -1)
    return strip_blanks(F.coalesce(matched, last_part))


def department(postcode: Column) -> Column:
    return F.substring(postcode, 1, 2)


def department_label(code: Column) -> Column:
    label = F.lit(L.DEPARTMENT_OTHER)
    for number, name in L.DEPARTMENT_NAMES.items():
        label = F.when(code == number, name).otherwise(label)
    return label


def folded_name(name: Column) -> Column:
    """A name for comparison: collated, so accents and case do not matter; hyphens and apostrophes are blanks."""
    return F.collate(F.trim(F.translate(name, SEPARATORS, " " * len(SEPARATORS))), "UNICODE_CI_AI")


def postcode_listed(postcode: Column, codes: Column) -> Column:
    """Whether a postcode is in a pipe-separated list; NULL when the list is unknown."""
    listed = F.array_contains(F.split(codes, r"\|"), postcode)
    return F.when(codes.isNotNull(), F.coalesce(listed, F.lit(False)))


def grouped_digits(amount: Column) -> Column:
    """A whole number with a space between thousands."""
    return F.replace(F.format_number(amount, 0), F.lit(","), F.lit(" "))


def euros(amount: Column) -> Column:
    return F.concat(grouped_digits(amount), F.lit(" €"))
