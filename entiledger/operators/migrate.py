"""Migration of legacy tables into change logs with new surrogate keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import cached_property, reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from entiledger.model import (
    DEFAULT_CONFIDENCE,
    DEFAULT_MAP_TYPE,
    FIRST_N_ID,
    MAIN_DATABASE,
    SHORT_LOAD_ROWS,
    TableSpec,
)
from entiledger.operators.ids import dense_ids, next_id
from entiledger.operators.joins import id_join, lookup_join


def id_column(df: DataFrame, thing: str) -> str:
    """Id column of a legacy table."""
    if f"{thing}_id" not in df.columns:
        raise ValueError(f"table of {thing}: no column {thing}_id")
    return f"{thing}_id"


def name_column(df: DataFrame, thing: str) -> str:
    """Name column of a legacy table: the first that carries the thing's name."""
    for column in df.columns:
        if column in (thing, f"{thing}_name"):
            return column
    raise ValueError(f"table of {thing}: no column {thing} or {thing}_name")


def extra_columns(df: DataFrame, spec: TableSpec) -> list[str]:
    """Declared columns that the legacy table has, in declared order."""
    return [c.name for c in spec.columns if c.name in df.columns]


def _require(df: DataFrame, table: str, columns: Sequence[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"table {table}: missing columns {', '.join(missing)}")


def legacy_rows(df: DataFrame, thing: str, extras: Sequence[str] = ()) -> DataFrame:
    """Legacy table under common names: old_id, name, t_updated_ts, t_updated_by."""
    _require(df, thing, ["updated_ts", "updated_by"])
    return df.select(
        F.col(id_column(df, thing)).cast("long").alias("old_id"),
        F.col(name_column(df, thing)).alias("name"),
        F.col("updated_ts").alias("t_updated_ts"),
        F.col("updated_by").alias("t_updated_by"),
        *extras,
    )


def first_by_rank(
    df: DataFrame, column: str, rows: int = SHORT_LOAD_ROWS
) -> DataFrame:
    """Rows whose rank by the column is within ``rows``; ties at the end are kept.

    A row ranks within ten when its value is not above the tenth smallest. That
    value comes from a top-k over the one column, and the comparison reaches the
    scan, so no row is sorted or moved.
    """
    smallest = df.select(column).where(F.col(column).isNotNull()).orderBy(column)
    last = smallest.limit(rows).agg(F.max(column)).scalar()
    return df.where(F.col(column) <= last)


def created_log(
    rows: DataFrame, extras: Sequence[str], log_id: Column, ts: str, by: str
) -> DataFrame:
    """Numbered legacy rows as the first, drafted versions of new entities."""
    return rows.select(
        log_id.cast("long").alias("log_id"),
        "n_id",
        F.lit("create").alias("action"),
        F.col(ts).alias("created_ts"),
        F.col(by).alias("created_by"),
        F.lit("draft").alias("status"),
        "name",
        *extras,
    )


@dataclass(frozen=True)
class MigratedThing:
    """The three outputs of one migrated legacy table."""

    log: DataFrame
    bridge: DataFrame
    registry: DataFrame


def migrate_thing(
    df: DataFrame,
    thing: str,
    start: int = FIRST_N_ID,
    extras: Sequence[str] = (),
    short_load: bool = False,
) -> MigratedThing:
    """Number a legacy table by its id and derive log, bridge and registry rows.

    ``bridge`` and ``registry`` read only the id column. All three agree because
    the numbers depend on the ids alone.
    """
    rows = legacy_rows(df, thing, extras)
    if short_load:
        rows = first_by_rank(rows, "old_id")
    numbered = dense_ids(rows, "old_id", "n_id", start)
    bridge = dense_ids(rows.select("old_id"), "old_id", "n_id", start).select(
        "old_id", F.lit(thing).alias("thing"), "n_id"
    )
    log = created_log(
        numbered, extras, F.col("n_id") - start + 1, "t_updated_ts", "t_updated_by"
    )
    return MigratedThing(log, bridge, bridge.select("n_id", "thing"))


def map_rows(df: DataFrame, thing: str, table: str) -> DataFrame:
    """Id-map table under common names: old_id, ext_id, m_updated_ts, m_updated_by."""
    _require(df, table, ["ext_id", "updated_ts", "updated_by"])
    return df.select(
        F.col(id_column(df, thing)).cast("long").alias("old_id"),
        F.col("ext_id").cast("string").alias("ext_id"),
        F.col("updated_ts").alias("m_updated_ts"),
        F.col("updated_by").alias("m_updated_by"),
    )


def join_thing_and_map(
    things: DataFrame,
    maps: DataFrame,
    short_load: bool = False,
) -> DataFrame:
    """Legacy rows with each of their map rows; map rows of no thing are dropped."""
    if short_load:
        things = first_by_rank(things, "old_id")
    return lookup_join(maps, things, "old_id", "inner", ["ext_id"])


def map_constants(map_type: str = DEFAULT_MAP_TYPE) -> dict[str, str | float]:
    """Columns that hold the same value in all migrated rows of a name map."""
    return {
        "action": "create",
        "status": "draft",
        "map_type": map_type,
        "confidence": DEFAULT_CONFIDENCE,
    }


def name_map_log(
    maps: DataFrame,
    bridge: DataFrame,
    keys: Sequence[str],
    v_id: Column,
    map_type: str = DEFAULT_MAP_TYPE,
    vendors: DataFrame | None = None,
) -> DataFrame:
    """Map rows as name-map log rows with new ids; map rows of no thing are dropped.

    ``bridge`` holds exactly the migrated things, so this one join both looks up
    the new id and drops orphans. The log id is given when the rows are appended.
    ``vendors`` has the vendor ids by ``vendor``, a column of the map rows; they are joined
    after the lookup, so that they need not be shuffled for it.
    """
    joined = lookup_join(maps, bridge, list(keys), "inner", ["ext_id"])
    if vendors is not None:
        joined = joined.join(vendors, "vendor")
    fixed = map_constants(map_type)
    return joined.select(
        "n_id",
        v_id.cast("long").alias("v_id"),
        F.lit(fixed["action"]).alias("action"),
        F.col("m_updated_ts").alias("created_ts"),
        F.col("m_updated_by").alias("created_by"),
        F.lit(fixed["status"]).alias("status"),
        "ext_id",
        F.lit(fixed["map_type"]).alias("map_type"),
        F.lit(fixed["confidence"]).cast("float").alias("confidence"),
    )


def unbridged(
    things: DataFrame, bridge: DataFrame, keys: Sequence[str] = ("old_id",)
) -> DataFrame:
    """Rows whose old id a bridge for these things lacks; a migration needs none."""
    return id_join(things, bridge.select(*keys), list(keys), "left_anti")


def assign_vendor_ids(
    registry: DataFrame, wanted: DataFrame, order: Sequence[str] = ("vendor",)
) -> tuple[DataFrame, DataFrame]:
    """Vendor ids, and the registry rows to append for vendors not yet known.

    Looks a vendor up in the main database only and takes the lowest id if there
    are several. New ids follow the highest one. ``wanted`` has one row per vendor
    and is small by nature, like the list of declared vendors it comes from: one task
    numbers them.
    """
    known = (
        registry.where(F.col("database") == MAIN_DATABASE)
        .groupBy("vendor")
        .agg(F.min("v_id").alias("v_id"))
    )
    start = next_id(registry, "v_id", 1)
    place = F.row_number().over(Window.orderBy(*order))
    added = wanted.join(known, "vendor", "left_anti").select(
        (start + place - 1).cast("long").alias("v_id"),
        "vendor",
        F.lit(MAIN_DATABASE).alias("database"),
    )
    found = known.join(wanted, "vendor", "left_semi")
    ids = found.select("vendor", "v_id").unionByName(added.select("vendor", "v_id"))
    return ids, added


def _map_tables(
    legacy: Mapping[str, DataFrame], spec: TableSpec, vendors: Sequence[str]
) -> list[tuple[str, str]]:
    """Map tables of a thing as (vendor, table), last listed vendor first."""
    named = [(v, f"map_{spec.name}_{v}") for v in reversed(vendors)]
    return [(v, table) for v, table in named if table in legacy and v in spec.vendors]


def legacy_ids(
    legacy: Mapping[str, DataFrame], things: Sequence[str], short_load: bool = False
) -> DataFrame:
    """Old ids of several legacy tables, with each thing's place in ``things``."""
    ids = []
    for place, thing in enumerate(things):
        rows = legacy_rows(legacy[thing], thing).select("old_id")
        if short_load:
            rows = first_by_rank(rows, "old_id")
        ids.append(
            rows.select(
                F.lit(place).alias("thing_ord"), F.lit(thing).alias("thing"), "old_id"
            )
        )
    return reduce(DataFrame.unionByName, ids)


def repeated_ids(ids: DataFrame) -> DataFrame:
    """Things that use an old id more than once, with the number of such ids."""
    per_id = ids.groupBy("thing", "old_id").agg(F.count(F.lit(1)).alias("n"))
    return per_id.where(F.col("n") > 1).groupBy("thing").agg(F.count("n").alias("ids"))


def number_things(
    legacy: Mapping[str, DataFrame],
    things: Sequence[str],
    start: int = FIRST_N_ID,
    short_load: bool = False,
) -> DataFrame:
    """Bridge of several legacy tables, numbered through in the order of ``things``."""
    ids = legacy_ids(legacy, things, short_load)
    numbered = dense_ids(ids, "old_id", "n_id", start, "thing_ord")
    return numbered.select("old_id", "thing", "n_id")


def number_new_things(
    ids: DataFrame, bridge: DataFrame, start: int | Column
) -> DataFrame:
    """Bridge rows for the legacy ids that a bridge lacks, numbered from ``start``.

    ``ids`` comes from :func:`legacy_ids`; numbers follow its order of things and ids.
    """
    lacking = unbridged(ids, bridge, ["thing", "old_id"])
    numbered = dense_ids(lacking, "old_id", "n_id", start, "thing_ord", keys=ids)
    return numbered.select("old_id", "thing", "n_id")


@dataclass(frozen=True)
class Migration:
    """A whole migration: the bridge, and plans for everything that joins it."""

    legacy: Mapping[str, DataFrame]
    specs: Mapping[str, TableSpec]
    things: list[str]
    vendors: Sequence[str]
    bridge: DataFrame
    start: int | None = None
    short_load: bool = False

    @cached_property
    def _starts(self) -> dict[str, int]:
        """First new id of each thing: all of them counted by one job, when first asked."""
        ids = legacy_ids(self.legacy, self.things, self.short_load)
        counted = ids.groupBy("thing").agg(F.count(F.lit(1)).alias("n")).collect()
        sizes = {r["thing"]: r["n"] for r in counted}
        ends = accumulate((sizes.get(t, 0) for t in self.things), initial=self.start)
        return dict(zip(self.things, ends, strict=False))

    def _own(self, thing: str) -> tuple[DataFrame, int | Column]:
        """Bridge rows of one thing and its first new id.

        If none are stored, they are numbered without the other things.
        """
        if self.start is None:
            own = self.bridge.where(F.col("thing") == thing).select("old_id", "n_id")
            return own, own.agg(F.min("n_id")).scalar()
        first = self._starts[thing]
        ids = legacy_ids(self.legacy, [thing], self.short_load).select("old_id")
        return dense_ids(ids, "old_id", "n_id", first), first

    def registry(self) -> DataFrame:
        """Rows of the thing registry."""
        return self.bridge.select("n_id", "thing")

    def log(self, thing: str) -> DataFrame:
        """Log rows of one thing; both sides of the join are unique on the old id."""
        df = self.legacy[thing]
        extras = extra_columns(df, self.specs[thing])
        own, first = self._own(thing)
        return created_log(
            legacy_rows(df, thing, extras).join(own, "old_id"),
            extras,
            F.col("n_id") - first + 1,
            "t_updated_ts",
            "t_updated_by",
        )

    def lacking_log(self, thing: str, ids: DataFrame, log: DataFrame, first_log_id: int) -> DataFrame:
        """Log rows of one thing's entities that a log lacks, numbered by their new ids.

        ``ids`` has the old ids to migrate. Only ids are compared and numbered; the wide rows
        are shuffled once, and not at all where the log lacks nothing.
        """
        df = self.legacy[thing]
        extras = extra_columns(df, self.specs[thing])
        rows = legacy_rows(df, thing, extras)
        known = self.bridge.where(F.col("thing") == thing).select("old_id", "n_id")
        own = id_join(known, ids.select("old_id"), "old_id", "left_semi")
        if not log.isEmpty():
            own = id_join(own, log.select("n_id"), "n_id", "left_anti")
            if own.isEmpty():
                rows = rows.where(F.lit(False))
        numbered = dense_ids(own, "n_id", "log_id", first_log_id, keys=known)
        return created_log(
            id_join(rows, numbered, "old_id"),
            extras,
            F.col("log_id"),
            "t_updated_ts",
            "t_updated_by",
        )

    def map_tables(self) -> list[tuple[str, str, str]]:
        """Declared id maps as (thing, vendor, table) in the order of their visit."""
        return [
            (thing, vendor, table)
            for thing in self.things
            for vendor, table in _map_tables(
                self.legacy, self.specs[thing], self.vendors
            )
        ]

    def vendor_ids(self, registry: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Ids of the vendors with id maps, and the registry rows to append."""
        seen = list(dict.fromkeys(vendor for _, vendor, _ in self.map_tables()))
        listed = F.array(*[F.lit(v) for v in seen]).cast("array<string>")
        wanted = registry.sparkSession.range(0, 1, 1, 1).select(
            F.posexplode(listed).alias("visit", "vendor")
        )
        return assign_vendor_ids(registry, wanted, ["visit"])

    def name_map(self, vendor_ids: DataFrame) -> DataFrame | None:
        """Name-map rows of all id maps, through one join for each thing; None without any map.

        A thing's map rows so look their new ids up by the old id alone, and only among the
        thing's own bridge rows.
        """
        visits = self.map_tables()
        if not visits:
            return None
        seen = list(dict.fromkeys(thing for thing, _, _ in visits))
        parts = [self._thing_map(t, [v for v in visits if v[0] == t], vendor_ids) for t in seen]
        return reduce(DataFrame.unionByName, parts)

    def _thing_map(
        self, thing: str, visits: list[tuple[str, str, str]], vendor_ids: DataFrame
    ) -> DataFrame:
        """Name-map rows of one thing's id maps."""
        maps = reduce(
            DataFrame.unionByName,
            [
                map_rows(self.legacy[table], thing, table).select(
                    F.lit(vendor).alias("vendor"), "*"
                )
                for _, vendor, table in visits
            ],
        )
        # One row per declared vendor: always small enough to broadcast.
        return name_map_log(
            maps, self._own(thing)[0], ["old_id"], F.col("v_id"), vendors=F.broadcast(vendor_ids)
        )


def migrate_all(
    legacy: Mapping[str, DataFrame],
    specs: Sequence[TableSpec],
    things: Sequence[str],
    vendors: Sequence[str],
    start: int = FIRST_N_ID,
    short_load: bool = False,
    bridge: DataFrame | None = None,
) -> Migration:
    """Plan the migration of every legacy thing that is declared.

    ``bridge`` may be the stored result of :func:`number_things`; otherwise it is
    planned here.
    """
    declared = {spec.name: spec for spec in specs}
    chosen = [t for t in things if t in legacy and t in declared]
    if not chosen:
        raise ValueError("no legacy table is declared")
    if bridge is not None:
        return Migration(legacy, declared, chosen, vendors, bridge)
    bridge = number_things(legacy, chosen, start, short_load)
    return Migration(legacy, declared, chosen, vendors, bridge, start, short_load)
