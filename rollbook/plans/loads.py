"""Feed loads and the run that chains them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rollbook import schemas
from rollbook.functions.staging import stage, staging_scope
from rollbook.operators import rules as R
from rollbook.operators.clean import coerce, conform, drop_missing, fit_lengths, rename
from rollbook.operators.keys import assign_ids, insert_absent, next_id
from rollbook.plans.commands import NextIds, Outcome, Tables, load_grades
from rollbook.sources.feeds import ORDER, SURPLUS, read_grades, read_people
from rollbook.sources.store import TableStore

_PEOPLE = {
    "first_name": "first_name",
    "last_name": "last_name",
    "email": "email",
    "dob": "date_of_birth",
    "major": "major",
    SURPLUS: SURPLUS,
    ORDER: ORDER,
}


@dataclass(frozen=True)
class Sources:
    """Where a run finds its feeds; None leaves a feed out.

    The catalog is a frame (course_name, course_code, credits and ``feed_order``),
    as catalogs come in many forms.
    """

    people: str | list[str] | None = None
    catalog: DataFrame | None = None
    grades: str | list[str] | None = None
    grades_json_lines: bool = False
    people_multi_line: bool = False


@dataclass(frozen=True)
class LoadReport:
    """What a run did: refused rows and rows (metric, rows) by feed."""

    rejected: dict[str, DataFrame]
    counters: dict[str, dict[str, int]]


def _refuse(rejected: DataFrame, what: str) -> None:
    first = rejected.select(F.array_join(R.REASONS, ",").alias("why")).first()
    if first is not None:
        raise ValueError(f"{what} feed refused: {first['why']}")


def _insert(
    tables: Tables, table: str, batch: DataFrame, order: list[str], next_ids: NextIds = None
) -> tuple[dict[str, DataFrame], DataFrame]:
    pk, keys = schemas.PRIMARY_KEYS[table], schemas.UNIQUE_KEYS[table]
    inserted, _ = insert_absent(tables[table], batch, keys, order)
    start = next_ids[table] if next_ids else next_id(tables[table], pk)
    added = conform(assign_ids(inserted, pk, start, order), schemas.TABLES[table])
    grown = conform(tables[table], schemas.TABLES[table]).unionByName(added)
    return {**tables, table: grown}, added


def _observed(df: DataFrame, metric: str, seen: dict[str, Observation]) -> DataFrame:
    """The frame, with its rows counted by whatever job first reads it to the end."""
    seen[metric] = Observation()
    return df.observe(seen[metric], F.count(F.lit(1)).alias("rows"))


def _counters(seen: dict[str, Observation], added: DataFrame) -> DataFrame:
    """Rows (metric, rows) of one load, from the job that wrote its batch; only the written new rows are counted anew.

    ``processed`` counts the rows offered to the target, conflicting ones
    included; ``inserted`` only those that entered it.
    """
    rows = {metric: found.get["rows"] for metric, found in seen.items()}
    rows["inserted"] = added.count()
    rows["skipped"] = rows["processed"] - rows["inserted"]
    return added.sparkSession.createDataFrame([*rows.items()], "metric string, rows bigint")


def clean_people(feed: DataFrame) -> DataFrame:
    """People rows with an email, under the table's column names, still text."""
    kept = drop_missing(feed, ["email"])
    return rename(kept, {k: v for k, v in _PEOPLE.items() if k in feed.columns})


def load_people(
    tables: Tables,
    feed: DataFrame,
    order: tuple[str, ...] = (ORDER,),
    strict: bool = True,
    next_ids: NextIds = None,
) -> tuple[Outcome, DataFrame]:
    """Insert people whose email is new, the first row of an email winning.

    Returns the outcome and the load counters.
    """
    people = clean_people(feed)
    checks = [*R.table_rules("students", people.columns), R.real_date("date_of_birth")]
    if SURPLUS in people.columns:
        checks.append(R.Rule("surplus_fields", F.col(SURPLUS).isNull()))
    _, rejected = R.apply_rules(people, checks)
    if strict:
        _refuse(rejected, "people")
    seen: dict[str, Observation] = {}
    counted = _observed(clean_people(_observed(feed, "extracted", seen)), "kept", seen)
    valid = counted.where(R.passes(checks)).drop(SURPLUS)
    batch = fit_lengths(coerce(valid, schemas.STUDENTS), schemas.MAX_LENGTH["students"])
    grown, added = _insert(tables, "students", _observed(batch, "processed", seen), list(order), next_ids)
    return Outcome(grown, {"students": added}, rejected), _counters(seen, added)


def load_catalog(
    tables: Tables,
    feed: DataFrame,
    order: tuple[str, ...] = (ORDER,),
    strict: bool = True,
    next_ids: NextIds = None,
) -> tuple[Outcome, DataFrame]:
    """Insert courses whose code is new.

    Credits are judged as text, so a word or a fraction is refused and not lost
    by the cast.
    """
    checks = [*R.table_rules("courses", feed.columns), R.whole_number("credits")]
    _, rejected = R.apply_rules(feed, checks)
    if strict:
        _refuse(rejected, "catalog")
    seen: dict[str, Observation] = {}
    counted = _observed(_observed(feed, "extracted", seen), "kept", seen)
    whole = F.col("credits").try_cast("decimal(10,0)").try_cast("int")
    batch = fit_lengths(counted.where(R.passes(checks)).withColumn("credits", whole), schemas.MAX_LENGTH["courses"])
    grown, added = _insert(tables, "courses", _observed(batch, "processed", seen), list(order), next_ids)
    return Outcome(grown, {"courses": added}, rejected), _counters(seen, added)


def seed_rows(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """The starting student and course."""
    students = spark.createDataFrame(
        schemas.SEED_STUDENTS, "first_name string, last_name string, email string, major string"
    )
    courses = spark.createDataFrame(schemas.SEED_COURSES, "course_name string, course_code string, credits int")
    return students, courses


def seed(tables: Tables, spark: SparkSession) -> dict[str, DataFrame]:
    """Insert the starting rows where their keys are absent."""
    students, courses = seed_rows(spark)
    grown, _ = _insert(tables, "students", students, ["email"])
    grown, _ = _insert(grown, "courses", courses, ["course_code"])
    return grown


def run_loads(
    spark: SparkSession,
    sources: Sources,
    store: TableStore,
    as_of: Column | str | None = None,
    strict: bool = True,
    batch: str = "",
) -> LoadReport:
    """People, then catalog, then grades, published as one new state.

    Any error before the publish leaves the stored state as it was.  Rejected
    rows are set aside in the store and returned per feed together with the
    load counters.  Each feed is parsed once and written in columns; several
    passes follow.  A named batch that has been published is not loaded again.
    """
    if batch and store.has_batch(batch):
        return LoadReport({}, {})
    batch = batch or f"load-{store.version() + 1}"
    ids = store.next_ids()

    def people(tables: Tables) -> tuple[Outcome, DataFrame]:
        feed = stage(read_people(spark, sources.people, multi_line=sources.people_multi_line))
        return load_people(tables, feed, strict=strict, next_ids=ids)

    def catalog(tables: Tables) -> tuple[Outcome, DataFrame]:
        return load_catalog(tables, stage(sources.catalog), strict=strict, next_ids=ids)

    def grades(tables: Tables) -> tuple[Outcome, DataFrame]:
        feed = stage(read_grades(spark, sources.grades, json_lines=sources.grades_json_lines))
        done = load_grades(tables, feed, as_of, strict, next_ids=ids)
        read = feed.agg(F.count(F.lit(1)).alias("rows")).select(F.lit("extracted").alias("metric"), "rows")
        return done, read.unionByName(done.counters())

    steps = [
        (name, step)
        for name, step, given in (
            ("people", people, sources.people),
            ("catalog", catalog, sources.catalog),
            ("grades", grades, sources.grades),
        )
        if given is not None
    ]
    with staging_scope(spark):
        tables = store.read()
        added: dict[str, DataFrame] = {}
        rejected: dict[str, DataFrame] = {}
        counters: dict[str, dict[str, int]] = {}
        for name, step in steps:
            outcome, counted = step(tables)
            tables = outcome.tables
            added.update(outcome.added)
            counters[name] = {r["metric"]: r["rows"] for r in counted.collect()}
            rejected[name] = store.set_aside(outcome.rejected, name, batch)
        store.publish(append=added, batch=batch)
    return LoadReport(rejected, counters)
