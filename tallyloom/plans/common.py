"""Rules that several provider mappings share."""

from __future__ import annotations

from collections.abc import Iterable

from tallyloom.operators.mapping import Constant, Rules


def same(rule: object, *targets: str) -> dict[str, object]:
    """One rule for several columns."""
    return dict.fromkeys(targets, rule)


def vendor(name: str) -> Rules:
    return same(
        Constant(name), "InvoiceIssuerName", "HostProviderName", "ServiceProviderName"
    )


def direct(columns: Iterable[str]) -> Rules:
    """Columns the feed already names as the dataset does."""
    return {name: name for name in columns}


# Fixed values shared by the mappings.
AI_SERVICE = Constant("AI / LLM")
US_DOLLAR = Constant("USD")
REGULAR = Constant("Regular")
USAGE = Constant("Usage")
USAGE_BASED = Constant("Usage-Based")
