"""Text helpers: column-name normalisation, Unicode trim, tier and alias
classification."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from casaflow.schemas import TIER_PATTERNS, TIER_UNKNOWN


def _is_upper(ch: str) -> bool:
    return "A" <= ch <= "Z"


def _is_lower(ch: str) -> bool:
    return "a" <= ch <= "z"


def snake_case(name: str) -> str:
    """CamelCase -> snake_case (``RegionID`` -> ``region_id``).

    An underscore goes before an ASCII capital that starts a capitalised word
    (capital followed by a lower-case letter, not at the start), and before a
    capital that follows a lower-case letter or a digit; then everything is
    lower-cased.
    """
    out = []
    n = len(name)
    for i, ch in enumerate(name):
        if i > 0 and _is_upper(ch):
            nxt = name[i + 1] if i + 1 < n else ""
            prev = name[i - 1]
            if _is_lower(nxt) or _is_lower(prev) or prev.isdigit():
                out.append("_")
        out.append(ch)
    return "".join(out).lower()


# Unicode whitespace plus the ASCII separators \x1c-\x1f, i.e. exactly the
# characters Python's str.strip() removes.
_WS = r"[\s\x{1c}-\x{1f}]"
_TRIM_RE = rf"(?U)^{_WS}+|{_WS}+$"


def trim_all(c: Column | str) -> Column:
    """Strip leading/trailing whitespace of every Unicode kind.

    Spark's ``trim`` removes only the space character; this keeps the cleaning
    semantics of a Python ``strip``. Nulls stay null, empty stays empty.
    """
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(c, _TRIM_RE, "")


def tier_from_path(path: Column | str, patterns=TIER_PATTERNS,
                   unknown: str = TIER_UNKNOWN) -> Column:
    """Classify a source file name into a home tier; first matching substring wins."""
    path = F.col(path) if isinstance(path, str) else path
    expr = None
    for needle, tier in patterns:
        cond = path.contains(needle)
        expr = F.when(cond, tier) if expr is None else expr.when(cond, tier)
    return expr.otherwise(unknown)


def replace_values(c: Column | str, mapping: dict[str, str]) -> Column:
    """Replace whole values from a (small, fixed) mapping; others unchanged.

    Compiles to a CASE expression, so it stays in generated code. A mapping
    that grows with the data belongs in a join instead.
    """
    c = F.col(c) if isinstance(c, str) else c
    if not mapping:
        return c
    expr = None
    for k, v in mapping.items():
        expr = F.when(c == k, v) if expr is None else expr.when(c == k, v)
    return expr.otherwise(c)
