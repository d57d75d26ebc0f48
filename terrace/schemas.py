"""Column sets of the layers and where a run of each layer is stored."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def struct_of(names: str, types: dict[str, DataType] | None = None) -> StructType:
    """Nullable schema from a blank-separated name list; string unless typed."""
    types = types or {}
    return StructType([StructField(n, types.get(n, StringType()), True) for n in names.split()])


# The field names of the source records and of each layer.
ENTITY_FIELDS = (
    "id name category street city state postal_code country longitude latitude phone website_url"
)
COPY_FIELDS = (
    "id name category address_1 address_2 address_3 city state_province postal_code country "
    "longitude latitude phone website_url state street"
)
GOLD_DIMS = ("name", "category", "state", "country", "city")
TEXT_FIELDS = ("name", "category", "city", "state", "country")
CONTACT_FIELDS = ("phone", "website_url")
COORDINATES = ("longitude", "latitude")
BRONZE_TS = "ts_load_timestamp"
SILVER_TS = "ts_loadtimestamp_silver"
GOLD_TS = "ts_loadtimestamp_gold"

_COORDINATE_TYPES = {c: DoubleType() for c in COORDINATES}

RAW = struct_of(ENTITY_FIELDS)
LANDING = struct_of(COPY_FIELDS)
ENTITY = struct_of(ENTITY_FIELDS, _COORDINATE_TYPES)
BRONZE = struct_of(f"{ENTITY_FIELDS} {BRONZE_TS}", {**_COORDINATE_TYPES, BRONZE_TS: TimestampType()})
SILVER = struct_of(
    f"{ENTITY_FIELDS} {BRONZE_TS} {SILVER_TS}",
    {**_COORDINATE_TYPES, BRONZE_TS: TimestampType(), SILVER_TS: TimestampType()},
)
SILVER_EXPECTED = struct_of(f"{ENTITY_FIELDS} updated_at created_at")
GOLD = struct_of(
    f"{' '.join(GOLD_DIMS)} entity_count {GOLD_TS}",
    {"entity_count": LongType(), GOLD_TS: TimestampType()},
)


@dataclass(frozen=True)
class Entity:
    """What the loads must know of an entity table.

    `source` maps a column to the name of its source field, where they differ.
    `recency` names further columns, with types, that all layers but gold keep: the
    larger they are, in this order, the newer is the record.
    """

    fields: tuple[str, ...] = tuple(ENTITY_FIELDS.split())
    key: tuple[str, ...] = ("id",)
    text: tuple[str, ...] = TEXT_FIELDS
    contact: tuple[str, ...] = CONTACT_FIELDS
    coordinates: tuple[str, ...] = COORDINATES
    masked: tuple[str, ...] = ("phone",)
    dims: tuple[str, ...] = GOLD_DIMS
    partition: str = "state"
    country: str = "country"
    postal: str = "postal_code"
    source: Mapping[str, str] = field(default_factory=dict)
    recency: Mapping[str, DataType] = field(default_factory=dict)

    def _struct(self, **stamps: DataType) -> StructType:
        types = {c: DoubleType() for c in self.coordinates} | dict(self.recency) | stamps
        return struct_of(" ".join([*self.fields, *self.recency, *stamps]), types)

    @property
    def read_fields(self) -> StructType:
        """The source's own names, all as text."""
        return struct_of(" ".join(self.source.get(c, c) for c in [*self.fields, *self.recency]))

    @property
    def plain(self) -> StructType:
        return self._struct()

    @property
    def bronze(self) -> StructType:
        return self._struct(**{BRONZE_TS: TimestampType()})

    @property
    def silver(self) -> StructType:
        return self._struct(**{BRONZE_TS: TimestampType(), SILVER_TS: TimestampType()})

    @property
    def gold(self) -> StructType:
        types = {"entity_count": LongType(), GOLD_TS: TimestampType()}
        return struct_of(" ".join([*self.dims, *types]), types)

    def renamed(self, rows: DataFrame) -> DataFrame:
        """Source names to column names; other columns stay. A field that the source
        lacks is an error, not a column of NULLs."""
        wanted = [self.source.get(c, c) for c in [*self.fields, *self.recency]]
        absent = [c for c in wanted if c not in rows.columns]
        if absent:
            raise ValueError(f"the source has no field {', '.join(absent)}")
        named = {self.source.get(c, c): c for c in [*self.fields, *self.recency]}
        return rows.select(*[F.col(f"`{c}`").alias(named.get(c, c)) for c in rows.columns])


@dataclass(frozen=True)
class Layout:
    """All storage paths of a lake. A run never overwrites another run's folder."""

    root: str

    def layer(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def run(self, name: str, run_id: str) -> str:
        return f"{self.layer(name)}/run_id={run_id}"
