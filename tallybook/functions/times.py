"""Instants.  All of them are timestamps in a UTC session."""

from __future__ import annotations


def second(x: str) -> str:
    """Instant with second precision."""
    return f"date_trunc('second', cast({x} as timestamp))"


def epoch_seconds(x: str) -> str:
    return f"unix_seconds(cast({x} as timestamp))"


def from_millis(x: str) -> str:
    """Epoch milliseconds, as number or text, to an instant."""
    return f"timestamp_millis(cast({x} as bigint))"


def second_from_millis(x: str) -> str:
    return f"date_trunc('second', {from_millis(x)})"


def from_iso(x: str) -> str:
    """ISO-8601 text with millisecond precision; malformed text raises."""
    return f"date_trunc('millisecond', to_timestamp({x}))"


def from_iso_or_null(x: str) -> str:
    """ISO-8601 text with microsecond precision; malformed text gives NULL."""
    return f"try_to_timestamp({x})"


def minute(x: str) -> str:
    return f"date_trunc('minute', {x})"


def berlin(x: str) -> str:
    """Wall time in Berlin, for display only."""
    return f"convert_timezone('UTC', 'Europe/Berlin', cast({x} as timestamp_ntz))"
