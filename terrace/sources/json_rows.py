"""Nested JSON records to rows and columns, by paths that open arrays."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EVERY = "[*]"
_STEP = re.compile(r"\['([^'\"]+)'\]|\.([A-Za-z_]\w*)|\[(\*)\]")


def row_path_steps(path: str) -> list[str]:
    """`$['a'][*].b` as its steps; `[*]` is every element of an array."""
    steps = [name or plain or EVERY for name, plain, _ in _STEP.findall(path)]
    if not path.startswith("$") or not steps or _STEP.sub("", path[1:]):
        raise ValueError(f"not a row path: {path}")
    return steps


def _opened(paths: Mapping[str, list[str]]) -> list[list[str]]:
    """The steps of the arrays to open, outermost first: each must lie within the one before, as
    arrays side by side would be multiplied."""
    found = {tuple(steps[: k + 1]) for steps in paths.values() for k, step in enumerate(steps) if step == EVERY}
    chain = sorted(found, key=len)
    for outer, inner in zip(chain, chain[1:]):
        if inner[: len(outer)] != outer:
            raise ValueError(f"arrays {''.join(outer)} and {''.join(inner)} lie side by side; map them apart")
    return [list(c) for c in chain]


def _json_path(steps: Sequence[str]) -> str:
    return "$" + "".join(f'["{name}"]' for name in steps)


def _unused(df: DataFrame, name: str) -> str:
    taken = {c.lower() for c in df.columns}
    while any(f"{name}{k}".lower() in taken for k in range(10)):
        name += "_"
    return name


def map_json_rows(
    df: DataFrame,
    column: str,
    mapping: Mapping[str, str],
    rest: str | None = None,
    keep_empty: bool = True,
    positions: Sequence[str] = (),
) -> DataFrame:
    """One row per element of the innermost array of `mapping` (path -> text column); a mapping
    without `[*]` keeps the rows as they are.

    Fields above an array are repeated on its rows. A record whose array is missing, empty or no
    array is one row with NULLs, or none with `keep_empty=False`. Text that is no JSON, a missing
    field and a NULL one are NULL; numbers, booleans, objects and inner arrays become their JSON
    text. `positions` names columns for the places in the opened arrays, from 0. `rest` names a
    VARIANT column of the innermost object's fields that are not mapped as a whole.

    The text is parsed once, into a VARIANT; nothing but its parts is kept.
    """
    paths = {path: row_path_steps(path) for path in mapping}
    chain = _opened(paths)
    if len(positions) > len(chain):
        raise ValueError(f"{len(positions)} positions for {len(chain)} opened arrays")
    value, place = _unused(df, "_value"), _unused(df, "_place")
    out = df.withColumn(f"{value}0", F.try_parse_json(F.col(f"`{column}`")))
    explode = F.posexplode_outer if keep_empty else F.posexplode
    for level, steps in enumerate(chain, 1):
        within = steps[len(chain[level - 2]) if level > 1 else 0 : -1]
        array = F.try_variant_get(f"{value}{level - 1}", _json_path(within), "array<variant>")
        out = out.select("*", explode(array).alias(f"{place}{level}", f"{value}{level}"))

    def field(steps: list[str]) -> Column:
        level = steps.count(EVERY)
        own = steps[len(chain[level - 1]) if level else 0 :]
        return F.try_variant_get(f"{value}{level}", _json_path(own), "string")

    columns = {out_name: field(paths[path]) for path, out_name in mapping.items()}
    columns |= {name: F.col(f"{place}{level}") for level, name in enumerate(positions, 1)}
    if rest:
        depth = len(chain[-1]) if chain else 0
        whole = {steps[depth] for steps in paths.values() if steps.count(EVERY) == len(chain) and len(steps) == depth + 1}
        fields = F.try_variant_get(f"{value}{len(chain)}", "$", "map<string,variant>")
        columns[rest] = F.to_variant_object(F.map_filter(fields, lambda k, _: ~k.isin(*whole) if whole else F.lit(True)))
    kept = [c for c in df.columns if c not in columns]
    return out.select(*[F.col(f"`{c}`") for c in kept], *[c.alias(name) for name, c in columns.items()])


def read_json_rows(
    spark: SparkSession, path: str, mapping: Mapping[str, str], multi_line: bool = True, **options: object
) -> DataFrame:
    """Files of one JSON document each, or one per line, as the rows of `map_json_rows`."""
    text = spark.read.text(path, wholetext=multi_line)
    return map_json_rows(text, "value", mapping, **options).drop("value")
