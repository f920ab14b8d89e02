"""The two stages: landing files to raw tables, raw tables to typed tables."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Protocol

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sluice.functions.columns import free_name, none_null, quoted, quoted_all
from sluice.operators.changes import COMMIT_VERSION, drop_feed_columns, keep_changes
from sluice.operators.conform import conform, source_names
from sluice.operators.keys import latest_per_key
from sluice.operators.reports import load_summary
from sluice.plans.contract import check_evolution
from sluice.plans.registry import Dataset, Layout, shared_places
from sluice.sources.bronze import BronzeTable
from sluice.sources.csv_files import FEW_LISTING_TASKS, POSITION, ROW_ORDER, SOURCE_FILE, UNFIT, own_session
from sluice.sources.silver import SilverState, SilverTable
from sluice.streaming.ingest import start_ingest

logger = logging.getLogger(__name__)

LOADED = "loaded"
UP_TO_DATE = "up_to_date"
EMPTY = "empty"
SKIPPED = "skipped"
FAILED = "failed"

# In one load, files modified later win, then later names, and in a file later lines: the same
# row whatever micro-batches, and so versions, the files fell into.
ARRIVAL = (*ROW_ORDER, COMMIT_VERSION)

# Dates and timestamps without a zone of their own are read in this one.
TIME_ZONE = "UTC"

# What Parquet takes of the bytes of CSV text, about; only for the first guess of a table's size.
PARQUET_SHARE = 0.5


class DuplicateKeyError(ValueError):
    """A load holds a key more than once, and the dataset says that is an error."""


@dataclass(frozen=True)
class Status:
    """What became of one dataset in one stage.

    Of a load also: contract columns that no file had, values per column that could not be
    read, and NULLs per column declared not nullable.
    """

    dataset: str
    state: str
    detail: str = ""
    version: int | None = None
    rows: int | None = None
    error: BaseException | None = None
    absent: tuple[str, ...] = ()
    unreadable: Mapping[str, int] = field(default_factory=dict)
    null_violations: Mapping[str, int] = field(default_factory=dict)


class TypedStore(Protocol):
    """A typed table: what loads and readers need of it. ``SilverTable`` is the one that comes with it."""

    def exists(self) -> bool: ...

    def read(self) -> DataFrame: ...

    def view_sql(self) -> str | None: ...

    def state(self) -> SilverState | None: ...

    def has_rows(self, state: SilverState | None) -> bool: ...

    def write_full(self, state, rows, keys, raw_version, size, shuffled_by_key, check) -> int: ...

    def merge(self, state, rows, keys, raw_version, keep, shuffled_by_key, check) -> int: ...

    def log_empty(self, state: SilverState, raw_version: int) -> None: ...


#: Makes the typed table of a dataset.
Store = Callable[[SparkSession, Dataset, Layout], TypedStore]


def typed_table(spark: SparkSession, dataset: Dataset, layout: Layout) -> TypedStore:
    root = layout.typed_of(dataset)
    if dataset.bucket_bytes is None:
        return SilverTable(spark, root)
    return SilverTable(spark, root, bucket_bytes=dataset.bucket_bytes)


def raise_failures(statuses: Sequence[Status]) -> None:
    """Fail the job if a dataset failed; the others have run all the same."""
    failed = [status for status in statuses if status.state == FAILED]
    if failed:
        names = ", ".join(status.dataset for status in failed)
        raise RuntimeError(f"failed: {names}") from failed[0].error


def _isolated(
    spark: SparkSession, work: Callable[[Dataset], Status], datasets: Sequence[Dataset], at_once: int
) -> list[Status]:
    """Run each dataset on its own, some at the same time: an error stays with its dataset.

    Datasets that would write to the same place are refused, all of them.
    """
    shared = shared_places(datasets)

    def guarded(dataset: Dataset) -> Status:
        if dataset.name in shared:
            return Status(dataset.name, FAILED, shared[dataset.name], error=ValueError(shared[dataset.name]))
        try:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", dataset.name)
            return work(dataset)
        except Exception as error:
            logger.exception("dataset %s failed", dataset.name)
            return Status(dataset.name, FAILED, str(error), error=error)

    if not datasets:
        return []
    with ThreadPoolExecutor(min(at_once, len(datasets))) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(guarded), dataset) for dataset in datasets]
        return [future.result() for future in started]


def run_bronze(
    spark: SparkSession, datasets: Sequence[Dataset], layout: Layout, at_once: int = 8
) -> list[Status]:
    """Take up the new files of every dataset, several datasets at a time."""
    session = own_session(spark, FEW_LISTING_TASKS)

    def work(dataset: Dataset) -> Status:
        bronze = BronzeTable(session, layout.raw_of(dataset))
        before = bronze.latest_version()
        start_ingest(
            session,
            layout.landing_of(dataset),
            bronze.root,
            layout.checkpoint_of(dataset),
            dataset.csv_options,
            dataset.max_files,
            dataset.max_file_age,
            layout.cleaning_of(dataset),
        ).awaitTermination()
        after = bronze.latest_version()
        return Status(dataset.name, UP_TO_DATE if after == before else LOADED, version=after)

    return _isolated(session, work, datasets, at_once)


def run_silver(
    spark: SparkSession,
    datasets: Sequence[Dataset],
    layout: Layout,
    at_once: int = 4,
    time_zone: str = TIME_ZONE,
    store: Store = typed_table,
    namespace: str | None = None,
) -> list[Status]:
    """Bring every typed table up to its raw table, several datasets at a time.

    ``time_zone`` holds for the run, which has a session of its own, whatever the given one's is.
    ``store`` makes the typed table
    of a dataset; another one may stand in for the one that comes with the library. With
    ``namespace`` the views of the tables in this schema of the catalog follow: each is made or
    made anew as part of the run, also after one that loaded and then failed to.
    """
    session = own_session(spark, {**FEW_LISTING_TASKS, "spark.sql.session.timeZone": time_zone})

    def work(dataset: Dataset) -> Status:
        status = load_silver(session, dataset, layout, store)
        if namespace and status.state in (LOADED, UP_TO_DATE, EMPTY):
            refresh_view(session, store(session, dataset, layout), namespace, dataset.typed_name)
        return status

    if namespace:
        create_namespace(session, namespace)
    return _isolated(session, work, datasets, at_once)


def load_silver(
    spark: SparkSession,
    dataset: Dataset,
    layout: Layout,
    store: Store = typed_table,
) -> Status:
    """Merge the raw versions that came after the last load into the typed table."""
    contract = dataset.contract
    if contract is None or not contract.fields:
        return Status(dataset.name, SKIPPED, "no contract")
    if not contract.keys:
        return Status(dataset.name, SKIPPED, "no primary key")
    problems = contract.problems()
    if problems:
        raise ValueError("; ".join(problems))

    bronze = BronzeTable(spark, layout.raw_of(dataset))
    head = bronze.head()  # fixed first: what is committed later waits for the next run
    if head is None:
        return Status(dataset.name, SKIPPED, "no raw table")
    bronze.assert_versioned(head)
    upto = head.version

    silver = store(spark, dataset, layout)
    state = silver.state()
    merging = silver.has_rows(state)
    after = state.raw_version if merging else None
    if merging:
        check_evolution(state.schema, state.keys, contract, state.ever)
        if state.raw_version >= upto:
            return Status(dataset.name, UP_TO_DATE, version=upto)

    window = bronze.window(after, upto)
    if not sum(entry.rows for entry in window):
        if merging:
            silver.log_empty(state, upto)
        return Status(dataset.name, EMPTY, version=upto)

    present = source_names([name for entry in window for name in entry.columns], contract, dataset.ignore_case)
    absent = tuple(name for name in contract.names if name not in present)
    raw = keep_changes(bronze.read_changes(after, upto, head)) if merging else bronze.read_upto(upto, head)
    rows, counts, check = incoming(raw, dataset)
    if merging:
        keep = absent if dataset.keep_when_missing else ()
        count = silver.merge(state, rows, contract.keys, upto, keep, shuffled_by_key=True, check=check)
    else:
        size = int(PARQUET_SHARE * sum(entry.bytes for entry in window))
        count = silver.write_full(state, rows, contract.keys, upto, size, shuffled_by_key=True, check=check)
    return _loaded(dataset, upto, count, absent, counts.get)


def _loaded(dataset: Dataset, version: int, rows: int, absent: tuple[str, ...], counts: Mapping) -> Status:
    fields = dataset.contract.fields
    unreadable = {f.name: counts[f"unreadable {i}"] or 0 for i, f in enumerate(fields) if f"unreadable {i}" in counts}
    nulls = {f.name: counts[f"null {i}"] or 0 for i, f in enumerate(fields) if f"null {i}" in counts}
    unreadable = {name: n for name, n in unreadable.items() if n}
    nulls = {name: n for name, n in nulls.items() if n}
    parts = [f"not in the files: {', '.join(absent)}"] if absent else []
    for what, found in (("unreadable values", unreadable), ("NULL but declared not to be", nulls)):
        if found:
            parts.append(f"{what}: {', '.join(f'{name} ({n})' for name, n in found.items())}")
    detail = "; ".join(parts)
    if detail:
        logger.warning("dataset %s: %s", dataset.name, detail)
    return Status(
        dataset.name, LOADED, detail, version, rows, absent=absent, unreadable=unreadable, null_violations=nulls
    )


def incoming(raw: DataFrame, dataset: Dataset) -> tuple[DataFrame, Observation, Callable[[], None]]:
    """Raw rows to typed rows, each key once; rows with a NULL key all stay.

    With the counts that come along when the rows are computed, and a check to run then.
    """
    contract = dataset.contract
    source = source_names(raw.columns, contract, dataset.ignore_case)
    kept = {name: free_name(f"_raw{i}", contract.names, raw.columns) for i, name in enumerate(source)}
    raw = raw.withColumns({kept[name]: quoted(column).isNotNull() for name, column in source.items()})
    typed = conform(raw, contract, dataset.strict, dataset.ignore_case, carry=(*ARRIVAL, *kept.values()))
    counts = Observation()
    wanted = [F.count(F.lit(1)).alias("rows")]
    for i, f in enumerate(contract.fields):
        if f.name in source:
            wanted.append(F.count_if(quoted(kept[f.name]) & quoted(f.name).isNull()).alias(f"unreadable {i}"))
        if not f.nullable:
            wanted.append(F.count_if(quoted(f.name).isNull()).alias(f"null {i}"))
    typed = typed.observe(counts, *wanted).select(*quoted_all([*contract.names, *ARRIVAL]))
    if dataset.on_duplicate == "latest":
        unique = latest_per_key(typed, contract.keys, order=ARRIVAL, row_id=ARRIVAL)
        return unique.select(*quoted_all(contract.names)), counts, lambda: None

    copies = free_name("_copies", contract.names, ARRIVAL)
    unique = latest_per_key(typed, contract.keys, order=ARRIVAL, row_id=ARRIVAL, copies=copies)
    seen = Observation()
    repeated = none_null(contract.keys) & (quoted(copies) > 1)
    unique = unique.observe(seen, F.max(F.when(repeated, F.struct(*quoted_all(contract.keys)))).alias("key"))

    def check() -> None:
        key = seen.get["key"]
        if key is not None:
            shown = key.asDict() if hasattr(key, "asDict") else key
            raise DuplicateKeyError(f"a load of {dataset.name} holds the same key more than once, such as {shown}")

    return unique.select(*quoted_all(contract.names)), counts, check


def read_typed(spark: SparkSession, dataset: Dataset, layout: Layout, store: Store = typed_table) -> DataFrame:
    return store(spark, dataset, layout).read()


def read_raw(spark: SparkSession, dataset: Dataset, layout: Layout) -> DataFrame:
    bronze = BronzeTable(spark, layout.raw_of(dataset))
    upto = bronze.latest_version()
    if upto is None:
        raise ValueError(f"{bronze.root} holds no table")
    return drop_feed_columns(bronze.read_upto(upto)).drop(*POSITION)


def read_unfit(spark: SparkSession, dataset: Dataset, layout: Layout) -> DataFrame:
    """Lines of the raw table that have more or fewer cells than their file's header: file and line."""
    bronze = BronzeTable(spark, layout.raw_of(dataset))
    upto = bronze.latest_version()
    if upto is None:
        raise ValueError(f"{bronze.root} holds no table")
    unfit = bronze.read_upto(upto).filter(F.col(UNFIT).isNotNull())
    return unfit.select(F.col(SOURCE_FILE).alias("file"), F.col(UNFIT).alias("line"))


def summarize(
    spark: SparkSession, datasets: Sequence[Dataset], layout: Layout, store: Store = typed_table
) -> DataFrame:
    """Row count of every typed table that exists."""
    tables = [(d.name, store(spark, d, layout)) for d in datasets]
    counts = [load_summary(table.read(), name) for name, table in tables if table.exists()]
    if not counts:
        return spark.createDataFrame([], "dataset string, row_count long")
    union = counts[0]
    for count in counts[1:]:
        union = union.unionByName(count)
    return union


def create_namespace(spark: SparkSession, namespace: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {marked(namespace)}")


def marked(name: str) -> str:
    """A name of one or more parts as SQL takes it, whatever signs it holds; dots part the parts."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def refresh_view(spark: SparkSession, table: TypedStore, namespace: str, name: str) -> bool:
    """Make or replace the view of the catalog on a typed table; whether there is one to look at."""
    text = table.view_sql()
    if text is None:
        return False
    view = f"{marked(namespace)}.`{name.replace('`', '``')}`"
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS {text}")
    return True


def register_views(
    spark: SparkSession,
    datasets: Sequence[Dataset],
    layout: Layout,
    namespace: str | None = None,
    store: Store = typed_table,
) -> list[str]:
    """Views on the typed tables as they are now, for SQL; names of the views made.

    Without ``namespace`` they are views of the session, to be made anew after a load. With it they
    are views of the catalog, in this schema, which is made if it is not there; ``run_silver`` with
    the same ``namespace`` keeps them current.
    """
    if namespace:
        create_namespace(spark, namespace)
    made = []
    for dataset in datasets:
        table = store(spark, dataset, layout)
        if namespace:
            if refresh_view(spark, table, namespace, dataset.typed_name):
                made.append(f"{namespace}.{dataset.typed_name}")
        elif table.exists():
            table.read().createOrReplaceTempView(dataset.typed_name)
            made.append(dataset.typed_name)
    return made
