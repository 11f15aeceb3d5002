"""Jobs over a database of change-log tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entiledger.model import (
    ACTION_CODES,
    ACTIONS,
    FIRST_N_ID,
    LINK_COLUMNS,
    STATUS_CODES,
    THINGS,
    TICKET_COLUMNS,
    VENDORS,
    TableSpec,
    entity_columns,
    struct_type,
)
from entiledger.operators.audit import (
    column_rules,
    schema_difference,
    validation_report,
)
from entiledger.operators.ids import first_free, numbered_once, row_ids, rows_to_add
from entiledger.operators.joins import id_join
from entiledger.operators.keys import integrity_report, remap_foreign_keys
from entiledger.operators.load import Load, Series, load_series, series_of
from entiledger.operators.migrate import (
    legacy_ids,
    map_constants,
    migrate_all,
    number_new_things,
    repeated_ids,
    unbridged,
)
from entiledger.operators.versions import amplify, query_log
from entiledger.plans.newest import add_newest, drop_newest, keep_newest, newest_rows
from entiledger.sources.catalog import catalog_of
from entiledger.sources.files import read_load_series
from entiledger.sources.tables import (
    aligned,
    append_rows,
    foreign_keys,
    key_properties,
    stored_keys,
    stored_lengths,
    table_layouts,
)

_ROW_NO = "_row_no"


class LoadRejected(ValueError):
    """Raised when a single load refers to ids it must not change."""


class IntegrityError(ValueError):
    """Raised when staged rows break the rules of their table; nothing is published.

    ``violations`` lists (table, rule, column, number).
    """

    def __init__(self, violations: list[tuple[str, str, str, int]]):
        listed = "; ".join(f"{t}.{c}: {n} rows break {r}" for t, r, c, n in violations)
        super().__init__(listed)
        self.violations = violations


def check(
    legacy: Mapping[str, DataFrame],
    spark: SparkSession,
    things: Sequence[str] = THINGS,
    vendors: Sequence[str] = VENDORS,
    actions: Sequence[str] = ACTIONS,
) -> DataFrame:
    """Validation report of the legacy tables, in report order."""
    report = validation_report(
        legacy, catalog_of(spark, legacy), list(things), list(vendors), list(actions)
    )
    return report.orderBy("position").drop("position")


def check_columns(
    legacy: Mapping[str, DataFrame],
    spark: SparkSession,
    things: Sequence[str] = THINGS,
    vendors: Sequence[str] = VENDORS,
    actions: Sequence[str] = ACTIONS,
) -> DataFrame:
    """Column rules of the legacy tables, that of the external id included."""
    catalog = catalog_of(spark, legacy)
    rules = column_rules(catalog, list(things), list(vendors), list(actions))
    return rules.orderBy("position").drop("position")


def compare_schema(
    legacy: Mapping[str, DataFrame], spark: SparkSession, declared: DataFrame
) -> DataFrame:
    """Legacy columns that the declared schema leaves out."""
    return schema_difference(catalog_of(spark, legacy), declared)


def _number_missing(
    ids: DataFrame, spark: SparkSession, database: str
) -> DataFrame:
    """Complete the registry and the bridge for the given legacy ids; the bridge.

    The registry grows first, so that no load can take the numbers, and a job that
    stops in between leaves unused ids.
    """
    bridge_table, registry_table = (
        f"`{database}`.`{t}`" for t in ("old_new_bridge", "thing")
    )
    bridge, registry = spark.table(bridge_table), spark.table(registry_table)
    start = first_free(FIRST_N_ID, registry.select("n_id"), bridge.select("n_id"))
    # Written once: the registry and the bridge both take them from there.
    numbered = _stage(spark, database, "old_new_bridge", number_new_things(ids, bridge, start))
    numbers = bridge.select("n_id", "thing").unionByName(numbered.select("n_id", "thing"))
    append_rows(id_join(numbers, registry, "n_id", "left_anti"), registry_table)
    # The bridge is stored by thing; one thing may be far larger than the others.
    append_rows(numbered.hint("rebalance", "thing"), bridge_table)
    _unstage(spark, database, ["old_new_bridge"])
    spark.catalog.refreshTable(bridge_table)
    bridge = spark.table(bridge_table)
    if not unbridged(ids, bridge, ["thing", "old_id"]).isEmpty():
        raise ValueError(f"{database}: the bridge lacks ids of the legacy tables")
    return bridge


def _watermark(spark: SparkSession, database: str, table: str):
    """(log_id, use_sentinel): up to where a table's foreign keys are new ids, or None."""
    if not spark.catalog.tableExists(f"`{database}`.`key_link`"):
        return None
    links = spark.table(f"`{database}`.`key_link`").where(F.col("table_name") == table)
    last = links.agg(F.max("log_id").alias("log_id"), F.max("use_sentinel").alias("use_sentinel"))
    found = last.first()
    return None if found.log_id is None else found


def _raise_watermark(
    spark: SparkSession, database: str, table: str, log_id: int, use_sentinel: bool
) -> None:
    """Rows up to a log id have new keys. Said before they are written, so that no stop in
    between leaves new keys to be taken for old ones."""
    row = spark.createDataFrame([(table, log_id, use_sentinel)], struct_type(LINK_COLUMNS))
    append_rows(row.coalesce(1), f"`{database}`.`key_link`")


def _next_log_id(spark: SparkSession, database: str, table: str) -> int:
    """First log id above those that are stored and those that were reserved."""
    linked = _watermark(spark, database, table)
    free = first_free(1, spark.table(f"`{database}`.`{table}`").select("log_id"))
    return free if linked is None else max(free, linked.log_id + 1)


def _stage(spark: SparkSession, database: str, table: str, rows: DataFrame) -> DataFrame:
    """Rows written beside a table in its columns, but without its limits of length."""
    staged = f"`{database}`.`{table}_staged`"
    target = spark.table(f"`{database}`.`{table}`")
    spark.sql(f"DROP TABLE IF EXISTS {staged}")
    packed = aligned(rows, target).write.option("compression", "zstd")
    packed.saveAsTable(staged, format="parquet")
    spark.catalog.refreshTable(staged)
    return spark.table(staged)


def audit(
    spark: SparkSession,
    database: str,
    table: str,
    rows: DataFrame,
    new_things: DataFrame | None = None,
    old_keys: bool = False,
    numbered: bool = False,
) -> DataFrame:
    """Rules that rows of a table must keep, with the number of violations of each.

    Log ids are there and used once; ids are registered, for an entity log as its own
    thing; states, actions and lengths are within their bounds; foreign keys are ids of
    their thing, or with ``old_keys`` legacy ids. ``new_things`` are registered with the
    rows. Keys that are null break no rule. ``numbered``: each row is known to have a log
    id of its own, so that rule is left out.
    """
    name = f"`{database}`.`{table}`"
    registry = spark.table(f"`{database}`.`thing`")
    if new_things is not None:
        registry = registry.unionByName(new_things)
    bridge = spark.table(f"`{database}`.`old_new_bridge`")
    if table == "name_map":
        valid = {"n_id": registry.select("n_id")}
        valid["v_id"] = spark.table(f"`{database}`.`vendor`").select("v_id")
    else:
        valid = {"n_id": registry.where(F.col("thing") == table).select("n_id")}
        for column, foreign in stored_keys(spark, name).items():
            known, key = (bridge, "old_id") if old_keys else (registry, "n_id")
            valid[column] = known.where(F.col("thing") == foreign).select(key)
    return integrity_report(
        rows,
        [] if numbered else ["log_id"],
        ["log_id", "n_id"],
        stored_lengths(spark, name),
        {"action": list(ACTION_CODES), "status": list(STATUS_CODES)},
        {c: keys.distinct().hint("merge") for c, keys in valid.items() if c in rows.columns},
    )


def _broken(spark, database, table, rows, **options) -> list[tuple[str, str, str, int]]:
    """Violations by staged rows; at most one row for each rule comes back."""
    report = audit(spark, database, table, rows, **options).where("violations > 0")
    return [(table, r.rule, r.column_name, r.violations) for r in report.collect()]


def _publish(
    spark: SparkSession, database: str, staged: Mapping[str, DataFrame], again: bool = False
) -> None:
    """Move staged rows into their tables, and into the newest versions kept of them.

    ``again``: the rows of a repeated load, whose log ids may not be the highest.
    """
    for table, rows in staged.items():
        if not rows.isEmpty():
            append_rows(rows, f"`{database}`.`{table}`")
        add_newest(spark, database, table, rows if again else None)
    _unstage(spark, database, list(staged))


def _unstage(spark: SparkSession, database: str, tables: Sequence[str]) -> None:
    for table in tables:
        spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{table}_staged`")


def fill(
    legacy: Mapping[str, DataFrame],
    spark: SparkSession,
    database: str,
    specs: Sequence[TableSpec],
    things: Sequence[str] = THINGS,
    vendors: Sequence[str] = VENDORS,
    short_load: bool = False,
) -> None:
    """Migrate what the change-log tables lack of the legacy tables.

    Legacy ids that the bridge lacks get the next free numbers; logs get the entities and
    the name map the rows that they do not have yet, copies of a row counted. So a first
    migration fills empty tables, one that stopped goes on, one with new legacy rows adds
    these, also after loads and after foreign keys were remapped: then the rows come in
    with new keys. One without new rows does nothing. A legacy table whose ids are
    missing or repeated stops the migration before it writes; rows that break a rule of
    their table stop it before any of them is published.
    """
    declared = {spec.name: spec for spec in specs}
    chosen = [t for t in things if t in legacy and t in declared]
    plan_ids = legacy_ids(legacy, chosen, short_load)
    # At most one row per thing comes back.
    repeated = {r["thing"] for r in repeated_ids(plan_ids).collect()}
    without = plan_ids.where(F.col("old_id").isNull()).select("thing").distinct()
    if repeated or not without.isEmpty():
        names = ", ".join(sorted(repeated | {r["thing"] for r in without.collect()}))
        raise ValueError(f"ids missing or used more than once in: {names}")
    bridge = _number_missing(plan_ids, spark, database)
    plan = migrate_all(legacy, specs, things, vendors, bridge=bridge)
    broken, staged, linked = [], {}, {}
    for thing in plan.things:
        log = spark.table(f"`{database}`.`{thing}`")
        own = plan_ids.where(F.col("thing") == thing)
        rows = plan.lacking_log(thing, own, log, _next_log_id(spark, database, thing))
        linked[thing] = _watermark(spark, database, thing)
        if linked[thing] is not None:
            keys = foreign_keys(declared[thing])
            keys = {c: table for c, table in keys.items() if c in rows.columns}
            tables = list(table_layouts(specs))
            rows = remap_foreign_keys(rows, keys, bridge, tables, linked[thing].use_sentinel)
        staged[thing] = rows = _stage(spark, database, thing, rows)
        # Legacy keys may well be wrong: the remap tells, and flags them.
        wrong = _broken(spark, database, thing, rows.drop(*foreign_keys(declared[thing])))
        broken.extend(wrong)
    if plan.map_tables():
        vendor_table, map_table = (f"`{database}`.`{t}`" for t in ("vendor", "name_map"))
        append_rows(plan.vendor_ids(spark.table(vendor_table))[1], vendor_table)
        vendor_ids, _ = plan.vendor_ids(spark.table(vendor_table))
        stored = spark.table(map_table).drop("log_id")
        lacking = rows_to_add(aligned(plan.name_map(vendor_ids), stored), stored, map_constants())
        first = _next_log_id(spark, database, "name_map")
        stage = partial(_stage, spark, database, "name_map")
        staged["name_map"] = rows = row_ids(lacking, "log_id", first, stage)
        once = numbered_once(rows, "log_id")
        broken.extend(_broken(spark, database, "name_map", rows, numbered=once))
    if broken:
        _unstage(spark, database, list(staged))
        raise IntegrityError(broken)
    for thing, state in linked.items():
        last = spark.table(f"`{database}`.`{thing}_staged`").agg(F.max("log_id")).first()[0]
        if state is not None and last is not None:
            _raise_watermark(spark, database, thing, last, state.use_sentinel)
    _publish(spark, database, staged)


def connect_foreign_keys(
    spark: SparkSession,
    database: str,
    spec: TableSpec,
    specs: Sequence[TableSpec],
    use_sentinel: bool = False,
) -> DataFrame:
    """Entity log with its foreign keys remapped through the stored bridge.

    Rows up to the watermark of an earlier remap stay as they are.
    """
    bridge = spark.table(f"`{database}`.`old_new_bridge`")
    log = spark.table(f"`{database}`.`{spec.name}`")
    done = _watermark(spark, database, spec.name)
    tables = list(table_layouts(specs))
    flags = [f"bad_{c}" for c in foreign_keys(spec)]
    old = log if done is None else log.where(F.col("log_id") > done.log_id).drop(*flags)
    linked = remap_foreign_keys(old, foreign_keys(spec), bridge, tables, use_sentinel)
    if done is None:
        return linked
    kept = log.where(F.col("log_id") <= done.log_id)
    return kept.unionByName(linked, allowMissingColumns=True)


def store_foreign_keys(
    spark: SparkSession,
    database: str,
    spec: TableSpec,
    specs: Sequence[TableSpec],
    use_sentinel: bool = False,
) -> str:
    """Put the remapped entity log in the table's place; returns its name.

    Queries, loads and amplification go on with the new keys and their ``bad_`` flags.
    The log as it was stays as ``<name>_unlinked``. A watermark tells up to which log id
    the keys are new; fills, loads and amplification raise it with the rows they write,
    so a second remap takes only rows that something else appended with old keys, and
    does nothing if there are none. A job that stopped on the way is finished by the next
    call. Newest versions that are kept beside the table are taken anew; if the job stops
    before that, queries read the log until ``keep_newest`` is called again.
    """
    names = {k: f"{spec.name}{k}" for k in ("", "_unlinked", "_linked")}
    name, kept, fresh = (f"`{database}`.`{n}`" for n in names.values())
    there = {t.name for t in spark.catalog.listTables(database)}
    watched = False
    layout = ", ".join(f"`{c}` {kind}" for c, _, kind in LINK_COLUMNS)
    spark.sql(f"CREATE TABLE IF NOT EXISTS `{database}`.`key_link` ({layout}) USING parquet")

    def last(table: str) -> int:
        return first_free(1, spark.table(table).select("log_id")) - 1

    if names[""] in there:
        done = _watermark(spark, database, spec.name)
        if done is None and names["_unlinked"] in there:
            # Remapped before there were watermarks.
            _raise_watermark(spark, database, spec.name, last(kept), use_sentinel)
            done = _watermark(spark, database, spec.name)
        if done is not None:
            if last(name) <= done.log_id:
                return name
            use_sentinel = done.use_sentinel
        linked = connect_foreign_keys(spark, database, spec, specs, use_sentinel)
        columns = dict.fromkeys(linked.columns, "BOOLEAN")
        columns |= {c: kind for c, _, kind in entity_columns(spec)}
        body = ", ".join(f"`{c}` {kind}" for c, kind in columns.items())
        keys = key_properties(foreign_keys(spec))
        spark.sql(f"DROP TABLE IF EXISTS {fresh}")
        spark.sql(f"CREATE TABLE {fresh} ({body}) USING parquet {keys}")
        append_rows(linked, fresh)
        # A sentinel is no id of any thing, and is meant to be there.
        checked = spark.table(fresh).drop(*(foreign_keys(spec) if use_sentinel else ()))
        wrong = _broken(spark, database, spec.name, checked)
        if wrong:
            spark.sql(f"DROP TABLE {fresh}")
            raise IntegrityError(wrong)
        spark.sql(f"DROP TABLE IF EXISTS {kept}")
        watched = drop_newest(spark, database, spec.name)
        spark.sql(f"ALTER TABLE {name} RENAME TO {kept}")
    # While the table has no name, so that no stop leaves new keys under an old watermark.
    _raise_watermark(spark, database, spec.name, last(fresh), use_sentinel)
    spark.sql(f"ALTER TABLE {fresh} RENAME TO {name}")
    if watched:
        keep_newest(spark, database, spec.name)
    return name


def _first_numbers(
    spark: SparkSession, database: str, table: str, ticket: str | None
) -> tuple[int, int, bool]:
    """First new n_id and log_id of a load, and whether its ticket was used before."""
    tickets = f"`{database}`.`load_ticket`"
    if ticket is not None:
        used = spark.table(tickets).where(F.col("ticket") == ticket).first()
        if used is not None:
            return used.first_n_id, used.first_log_id, True
    registry = spark.table(f"`{database}`.`thing`")
    numbers = (
        first_free(FIRST_N_ID, registry.select("n_id")),
        _next_log_id(spark, database, table),
    )
    if ticket is not None:
        row = spark.createDataFrame([(ticket, *numbers)], struct_type(TICKET_COLUMNS))
        append_rows(row.coalesce(1), tickets)
    return *numbers, False


def _check_own(log: DataFrame, rows: DataFrame, ticket: str) -> None:
    """Raise if log ids of a repeated load hold rows of another entity or name."""
    told = [c for c in ("n_id", "name") if c in rows.columns]
    mine = rows.select("log_id", *[F.col(c).alias(f"_{c}") for c in told])
    there = log.select("log_id", *told)
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in told]
    if not mine.join(there, "log_id").where(~reduce(Column.__and__, same)).isEmpty():
        raise ValueError(f"another load took the numbers of ticket {ticket}: use a new ticket")


def load(
    spark: SparkSession,
    database: str,
    table: str,
    batches: Sequence[DataFrame] | Series,
    row_no: str,
    ticket: str | None = None,
) -> Load:
    """Append batches of changes to an entity log.

    Ids of new things are stored first. Should the job stop there, those ids stay
    unused and the next load takes higher ones. A single rejected batch raises; in
    a series the rejected batches are left out and reported in ``errors``. The rows are
    staged and audited first; if one breaks a rule of the table, nothing is published.
    Foreign keys are new ids once those of the table are remapped, legacy ids before.

    A ``ticket`` names the load: one that is called again with it, after it stopped at
    any point or was done, takes the same numbers and adds only the rows that are not
    there yet. If another load took these numbers, because the first call stopped before it
    wrote any row and was not repeated at once, it raises. One writer at a time.
    """
    name, registry_name = f"`{database}`.`{table}`", f"`{database}`.`thing`"
    start, first_log_id, again = _first_numbers(spark, database, table, ticket)
    registry, log = spark.table(registry_name), spark.table(name)
    series = batches if isinstance(batches, Series) else series_of(batches)
    planned = load_series(
        series, registry, table, row_no, FIRST_N_ID, first_log_id, start
    )
    if len(series.creates) == 1 and not planned.errors.isEmpty():
        raise LoadRejected(f"{table}: the load has ids or a status that it must not have")
    repeated = series.rows.groupBy("batch_no", row_no).count().where(F.col("count") > 1)
    if (twice := repeated.first()) is not None:
        raise ValueError(f"batch {twice.batch_no}: a {row_no} is used more than once")
    rows = planned.rows.select(*[c for c in planned.rows.columns if c in log.columns])
    things = planned.new_things
    if again:
        _check_own(log, rows, ticket)
        things = things.join(registry, "n_id", "left_anti")
        rows = rows.join(log.select("log_id"), "log_id", "left_anti")
    linked = _watermark(spark, database, table)
    staged = _stage(spark, database, table, rows)
    wrong = _broken(
        spark, database, table, staged, new_things=things, old_keys=linked is None
    )
    if wrong:
        _unstage(spark, database, [table])
        raise IntegrityError(wrong)
    append_rows(things, registry_name)
    last = first_log_id + planned.logged - 1
    if linked is not None and last > linked.log_id:
        _raise_watermark(spark, database, table, last, linked.use_sentinel)
    _publish(spark, database, {table: staged}, again)
    return planned


def load_files(
    spark: SparkSession,
    database: str,
    table: str,
    paths: Sequence[str],
    schema: T.StructType | str,
    fmt: str = "csv",
) -> Load:
    """Load files in the given order, each as one batch in the order of its rows.

    With an ``n_id`` in the schema the files modify entities, else they create them. All
    files are read by one scan, however many there are.
    """
    rows = read_load_series(spark, paths, schema, fmt, _ROW_NO)
    series = Series(rows, ["n_id" not in rows.columns] * len(paths))
    return load(spark, database, table, series, _ROW_NO)


def query(
    spark: SparkSession,
    database: str,
    table: str,
    status: str | None = None,
    action: str | None = None,
    n_id: int | None = None,
    latest: bool = False,
) -> DataFrame:
    """Versions of a table's entities, oldest first.

    The newest ones come from what ``keep_newest`` keeps of the table, if it does.
    """
    whole = spark.table(f"`{database}`.`{table}`")
    log = newest_rows(spark, database, table) if latest else whole
    return query_log(log, status, action, n_id, latest)


def add_versions(
    spark: SparkSession, database: str, table: str, copies: int, own_name: bool = False
) -> None:
    """Append synthetic versions of every row of a table."""
    name = f"`{database}`.`{table}`"
    log = spark.table(name)
    linked = _watermark(spark, database, table)
    if linked is not None:
        span = log.agg(F.count("log_id").alias("n"), F.max("log_id").alias("high")).first()
        last = (span.high or 0) + max(copies, 0) * span.n
        _raise_watermark(spark, database, table, last, linked.use_sentinel)
    append_rows(amplify(log, copies, own_name, own_name), name)
    add_newest(spark, database, table)
