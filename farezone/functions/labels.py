"""Company labels (P11-P15) as SQL text of built-in expressions."""

from __future__ import annotations

from farezone import config as C
from farezone.functions.text import literal


def license_to_company(code: str, mapping: dict | None = None) -> str:
    """Licence code -> company name; unknown codes pass through unchanged."""
    mapping = C.LICENSE_COMPANY if mapping is None else mapping
    pairs = ", ".join(f"{literal(k)}, {literal(v)}" for k, v in mapping.items())
    return f"coalesce(map({pairs})[{code}], {code})"


def strip_spaces(company: str) -> str:
    return f"replace({company}, ' ', '')"


def upper_label(company: str) -> str:
    """``no_hv`` -> ``FHV``, then upper-case."""
    return f"upper(CASE WHEN {company} = {literal(C.TRADITIONAL_TAG)} THEN {literal(C.TRADITIONAL_LABEL)} ELSE {company} END)"


def label_company(company: str) -> str:
    """:func:`upper_label` without spaces."""
    return strip_spaces(upper_label(company))


def to_sector(company: str) -> str:
    """The four high-volume companies -> ``HVFHV``; others unchanged."""
    hv = ", ".join(map(literal, C.HV_COMPANIES))
    return f"CASE WHEN {company} IN ({hv}) THEN {literal(C.HV_SECTOR_LABEL)} ELSE {company} END"
