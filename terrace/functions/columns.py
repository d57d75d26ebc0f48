"""Column expressions used by the layer operators. All of them run inside the JVM."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: accepted postal codes of the United States
# (ddddd, ddddd-dddd and ddddd-).
POSTAL_US = {"united states": "^[0-9]{5}(-[0-9]{4})?$|^[0-9]{5}-?$"}


_LITERAL_PATTERNS = 8


def coordinate(name: str) -> Column:
    """Text to double; blank and malformed text both become NULL."""
    return F.col(name).try_cast("double")


def coordinate_malformed(name: str) -> Column:
    """True where text is there but is no number."""
    return F.coalesce((F.trim(name) != "") & coordinate(name).isNull(), F.lit(False))


def masked(name: str, salt: str = "") -> Column:
    """SHA-256 hex digest; NULL stays NULL. A salt makes short values unguessable.

    The salt is a literal of the plan, so it shows in `explain` and in event logs. Set
    `spark.sql.redaction.string.regex` to a pattern that matches it, or keep those logs as
    close as the salt.
    """
    value = F.concat(F.lit(salt), F.col(name)) if salt else F.col(name)
    return F.sha2(value, 256)


def present(name: str) -> Column:
    return F.col(name).isNotNull()


def any_present(names: Iterable[str]) -> Column:
    found = F.lit(False)
    for name in names:
        found = found | present(name)
    return found


def bad_postal(
    patterns: Mapping[str, str] = POSTAL_US, country: str = "country", postal: str = "postal_code"
) -> Column:
    """True where a code breaks the pattern of its country.

    A missing code, a missing country and a country without a pattern are not
    flagged. A few patterns are literals, compiled once per task. A longer table is one
    map literal, so that the generated code does not grow with it; `rlike` keeps the
    pattern it used last, which suits rows stored by country.
    """
    if len(patterns) > _LITERAL_PATTERNS:
        pairs = [F.lit(x) for pair in patterns.items() for x in pair]
        own = F.element_at(F.create_map(*pairs), F.col(country))
        return F.coalesce(~F.rlike(F.col(postal), own), F.lit(False))
    flag = F.lit(False)
    for name, pattern in patterns.items():
        flag = flag | ((F.col(country) == name) & ~F.col(postal).rlike(pattern))
    return F.coalesce(flag, F.lit(False))


def percentage(part: str, whole: str) -> Column:
    """Share in percent, rounded half-up to 2 places in decimal arithmetic, as double."""
    share = F.col(part) * F.lit(100.0).cast("decimal(4,1)") / F.nullif(F.col(whole), F.lit(0))
    return F.round(share, 2).cast("double")
