"""Which headers leave with a message."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.envelope import NATIVE_HEADERS_PRESENT

# Headers that never leave.
NEVER = ["id", "timestamp", "deliveryAttempt", NATIVE_HEADERS_PRESENT]

DEFAULT_PATTERNS = ["*"]


def _regex(pattern: str) -> str:
    return "^" + ".*".join(re.escape(part) for part in pattern.split("*")) + "$"


def passes(name: Column, patterns: Sequence[str] = DEFAULT_PATTERNS) -> Column:
    """Whether a header name is let out. Patterns are tried in order and the first match decides;
    one that starts with `!` keeps its matches in, and a name no pattern matches stays in."""
    decision = F.when(name.isin(NEVER), False)
    for pattern in patterns:
        keep_in = pattern.startswith("!")
        decision = decision.when(name.rlike(_regex(pattern.removeprefix("!"))), not keep_in)
    return decision.otherwise(False)


def outbound_headers(patterns: Sequence[str] = DEFAULT_PATTERNS, headers: Column | str = "headers") -> Column:
    return F.map_filter(headers, lambda name, value: passes(name, patterns) & value.isNotNull())
