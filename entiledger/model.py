"""The data model: enumerations, declared tables and change-log layouts.

A *thing* is an entity type. Each thing has an append-only change-log table in
which many versions share one ``n_id`` and the highest ``log_id`` is the newest.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Enumeration members with their codes.
STATUS_CODES = {"draft": 1, "stage": 2, "production": 3}
ACTION_CODES = {"create": 1, "modify": 2, "delete": 3}

# First surrogate key of a migration, sentinel for a bad foreign
# key, defaults of a migrated id map, schema prefix of legacy table names.
FIRST_N_ID = 1000
BAD_KEY_SENTINEL = 666
DEFAULT_MAP_TYPE = "person"
DEFAULT_CONFIDENCE = 1.0
MAIN_DATABASE = "main"
LEGACY_PREFIX = "ontology."
SHORT_LOAD_ROWS = 10

# The four log columns of a legacy table.
LOG_COLUMNS = ("created_by", "updated_by", "created_ts", "updated_ts")

# Names looked for when legacy tables are enumerated. Order matters,
# and the spellings are kept because they decide which tables are found.
THINGS = (
    "actor", "app", "artist", "brand", "category", "category_hierarchy",
    "company", "division", "eduction_level", "entity_type", "ethnicity",
    "franchise", "gender", "generation", "genre", "has_children",
    "household_size", "marital_status", "political_affiliation", "product",
    "property_value", "region", "residence", "space", "sport", "sport_league",
    "sport_team", "sport_team_league", "state", "theatre_tite", "ticker",
    "time", "time_table", "time_type", "title", "venue", "yearly_income",
)
VENDORS = (
    "alligator", "android", "brand", "ios", "cheetah", "ferret",
    "ferret_retailer", "genre", "koala", "mockingbird", "monkey", "moose",
    "natterjack", "panther", "peacock", "platypus", "porcupine", "stork",
    "stork_ios_android", "swan", "tapir", "value_koala", "concert_venue",
)
ACTIONS = ("map", "fuzzymatch", "import", "exp", "history")

# Declared column type -> (Spark type, DDL type).
COLUMN_TYPES = {
    "string30": (T.StringType(), "VARCHAR(30)"),
    "string200": (T.StringType(), "VARCHAR(200)"),
    "varchar": (T.StringType(), "STRING"),
    "int": (T.IntegerType(), "INT"),
    "double": (T.DoubleType(), "DOUBLE"),
}


@dataclass(frozen=True)
class ColumnSpec:
    """One declared column beyond the standard ones."""

    name: str
    data_type: str
    foreign_table: str | None = None

    def types(self) -> tuple[T.DataType, str]:
        """Spark type and DDL type; a foreign key holds a 64-bit id."""
        if self.data_type not in COLUMN_TYPES:
            raise ValueError(f"column {self.name}: unknown type {self.data_type!r}")
        if self.foreign_table is not None:
            return T.LongType(), "BIGINT"
        return COLUMN_TYPES[self.data_type]


@dataclass(frozen=True)
class TableSpec:
    """One declared entity table, with the vendors whose id maps it takes over."""

    name: str
    columns: tuple[ColumnSpec, ...] = field(default_factory=tuple)
    vendors: tuple[str, ...] = field(default_factory=tuple)


# Columns of the fixed tables as (name, Spark type, DDL type).
_LONG = (T.LongType(), "BIGINT")
_S30 = (T.StringType(), "VARCHAR(30)")
_S200 = (T.StringType(), "VARCHAR(200)")
_ENUM = (T.StringType(), "STRING")

THING_COLUMNS = [("n_id", *_LONG), ("thing", *_S30)]
VENDOR_COLUMNS = [("v_id", *_LONG), ("vendor", *_S30), ("database", *_S30)]
BRIDGE_COLUMNS = [("old_id", *_LONG), ("thing", *_S30), ("n_id", *_LONG)]
TICKET_COLUMNS = [
    ("ticket", T.StringType(), "STRING"),
    ("first_n_id", *_LONG),
    ("first_log_id", *_LONG),
]
#: Up to which log id the foreign keys of a table are new ids.
LINK_COLUMNS = [
    ("table_name", T.StringType(), "STRING"),
    ("log_id", *_LONG),
    ("use_sentinel", T.BooleanType(), "BOOLEAN"),
]
#: Up to which log id the newest versions kept beside a table are whole.
UPTO_COLUMNS = [
    ("table_name", T.StringType(), "STRING"),
    ("log_id", *_LONG),
    ("folded", T.BooleanType(), "BOOLEAN"),
]
MAP_EXTRAS = [
    ("ext_id", *_S200),
    ("map_type", *_S30),
    ("confidence", T.FloatType(), "FLOAT"),
]


def log_columns(
    extras: list[tuple[str, T.DataType, str]],
    use_vid: bool = False,
    use_name: bool = False,
) -> list[tuple[str, T.DataType, str]]:
    """Change-log layout: keys, then log columns, then data columns."""
    keys = [("log_id", *_LONG), ("n_id", *_LONG)]
    if use_vid:
        keys.append(("v_id", *_LONG))
    logs = [
        ("action", *_ENUM),
        ("created_ts", T.TimestampNTZType(), "TIMESTAMP_NTZ"),
        ("created_by", *_S30),
        ("status", *_ENUM),
    ]
    name = [("name", *_S200)] if use_name else []
    return keys + logs + name + extras


def entity_columns(spec: TableSpec) -> list[tuple[str, T.DataType, str]]:
    """Change-log layout of one declared entity table."""
    return log_columns([(c.name, *c.types()) for c in spec.columns], use_name=True)


def name_map_columns() -> list[tuple[str, T.DataType, str]]:
    """Change-log layout of the vendor id map."""
    return log_columns(MAP_EXTRAS, use_vid=True)


def struct_type(columns: list[tuple[str, T.DataType, str]]) -> T.StructType:
    """Column list as a Spark schema."""
    return T.StructType([T.StructField(name, kind) for name, kind, _ in columns])


def ddl(columns: list[tuple[str, T.DataType, str]]) -> str:
    """Column list as the body of a CREATE TABLE statement."""
    return ", ".join(f"`{name}` {text}" for name, _, text in columns)
