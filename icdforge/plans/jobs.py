"""End-to-end loads of release files into dimension tables (J1-J4).

One Spark job per load, whatever the number of releases: the manifest picks
the files, one scan per layout reads all of them in parallel, rows are
standardised and staged as Parquet by release in the shared checkpoint folder
(a lost executor never re-reads half a load), counted while they are written,
checked there, and published by
the table action (:mod:`icdforge.plans.sinks`).  The staged copy is removed at
the end.  A file that is not Windows-1252 text (UTF-8, torn; told from the bytes
of all its lines) is rejected whole, with its page as the reason.  The table is not touched when a check fails; rejected lines and all
violations are kept in tables of their own, one slice per load.

With ``store_dir`` the rows go to a versioned store instead of a catalog table
(:mod:`icdforge.plans.snapshots`): the same actions and checks, published as one
commit on top of the snapshot that the checks have read.  There the action
``REFRESH`` loads only releases whose file is new or changed: every release of a
snapshot keeps its file's length, time of change and digest; a file whose length
and time are the same is not read at all, one whose digest is the same is not
parsed, and the other releases stay as they are.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import quality, releases, tables
from ..operators.clean import rename_columns
from ..session import checkpoint_dir
from ..sources.codepage import EMPTY, READABLE, code_pages
from ..sources.lines import FILE_NAME, read_lines
from ..sources.parse import RAW, REASON, split_rejects
from . import sinks
from .pipeline import layout_for, standardize
from .snapshots import Release, Snapshot, SnapshotStore, release_key

log = logging.getLogger(__name__)

REJECT_DDL = f"{FILE_NAME} STRING, CMS_Fiscal_Year INT, raw STRING, reason STRING"
CHECK_DDL = "check_name STRING, row_key STRING, detail STRING"


class LoadCheckError(RuntimeError):
    """``report``: violations by check; every one of them is a row of
    ``check_table`` (``load_id``)."""

    def __init__(self, message: str, report: dict, check_table: str | None = None):
        super().__init__(message)
        self.report = report
        self.check_table = check_table


@dataclass
class LoadResult:
    table: str
    rows: int
    rejects: int
    releases: list
    #: the release files that were parsed
    files: tuple[str, ...] = ()


@dataclass(frozen=True)
class SourceFile:
    path: str
    length: int
    modified: int  # ms


def resolve_files(spark: SparkSession, source_dir: str, names: Iterable[str]) -> dict[str, SourceFile]:
    """Map manifest file names to files in ``source_dir``, matching names
    case-insensitively (release names differ in case between sources).

    The folder is listed by Spark itself (``binaryFile`` source without the
    content column, so no file content is read); only the manifest's files
    reach the driver.  Two files whose names differ in case only raise."""
    if source_dir is None:
        raise ValueError("source_dir is required")
    names = list(names)
    listed = spark.read.format("binaryFile").load(source_dir).select("path", "length", F.unix_millis("modificationTime").alias("modified"))
    base = F.lower(F.element_at(F.split("path", "/"), -1))
    found: dict[str, list[SourceFile]] = {}
    for r in listed.filter(base.isin(sorted({n.lower() for n in names}))).collect():  # a few per release
        found.setdefault(r["path"].rsplit("/", 1)[-1].lower(), []).append(SourceFile(*r))
    twice = sorted(f.path for v in found.values() if len(v) > 1 for f in v)
    if twice:
        raise ValueError(f"release files whose names differ in case only: {twice}")
    missing = [n for n in names if n.lower() not in found]
    if missing:
        raise FileNotFoundError(f"release files not found in {source_dir}: {missing}")
    return {n: found[n.lower()][0] for n in names}


def resolve_paths(spark: SparkSession, source_dir: str, names: Iterable[str]) -> dict[str, str]:
    """The paths of :func:`resolve_files`."""
    return {n: f.path for n, f in resolve_files(spark, source_dir, names).items()}


def _scan(spark: SparkSession, paths: dict[str, str], files: list[str], manifest_df: DataFrame, kind: str, version: int | None) -> DataFrame:
    """Scan the files of one layout and standardise them."""
    lines = read_lines(spark, sorted({paths[n] for n in files}), header=layout_for(kind, version).header)
    # names on disk may differ in case: map them back to the manifest's names
    name_map = spark.createDataFrame([(n.lower(), n) for n in files], "_lower STRING, _mname STRING")
    lines = (
        lines.withColumn("_lower", F.lower(F.col(FILE_NAME)))
        .join(F.broadcast(name_map), "_lower", "left")
        .select("value", F.coalesce("_mname", FILE_NAME).alias(FILE_NAME))
    )
    return standardize(lines, manifest_df, kind, version)


def _inspect(spark: SparkSession, paths: dict[str, str]) -> dict[str, tuple[str, str]]:
    """Code page and digest of files; one narrow pass over their lines, one row
    per file reaches the driver.  A file without a line has the digest of none."""
    if not paths:
        return {}
    pages = code_pages(spark, sorted(set(paths.values()))).select(FILE_NAME, "code_page", "digest")
    seen = {r[0].lower(): (r[1], r[2]) for r in pages.collect()}  # one row per release file
    return {name: seen.get(name.lower(), ("ascii", EMPTY)) for name in paths}


def _reject_files(rows: DataFrame, wrong: dict[str, str]) -> DataFrame:
    """All rows of wrong files become rejects."""
    reason = F.lit(None).cast("string")
    for name, page in wrong.items():
        reason = F.when(F.col(FILE_NAME) == name, f"code_page:{page}").otherwise(reason)
    return rows.withColumn(REASON, F.coalesce(reason, F.col(REASON))) if wrong else rows


def _counts(spec: tables.TableSpec, mce: bool, years: Iterable[int]) -> list:
    """What a load has to know of its rows before it publishes, as aggregates:
    good rows (in all and per release), rejects, good rows with a NULL in a NOT
    NULL column, with text over its column's limit and (MCE) with another version
    than their release."""
    good = F.col(REASON).isNull()

    def n(cond, name):
        return F.coalesce(F.sum(F.when(cond, 1).otherwise(0)), F.lit(0)).cast("long").alias(name)

    any_null = F.lit(False)
    for c in spec.not_null():
        any_null = any_null | F.col(c).isNull()
    too_long = F.lit(False)
    for c, lim in spec.limits().items():
        too_long = too_long | (F.length(F.col(c)) > lim)
    out = [n(good, "good"), n(~good, "rejects"), n(good & any_null, "nulls"), n(good & too_long, "lengths")]
    out += [n(good & (F.col("CMS_Fiscal_Year") == fy), f"good_{fy}") for fy in sorted(set(years))]
    if mce:
        out.append(n(good & ~F.col("ICD_Version").eqNullSafe(F.col("Release_ICD_Version")), "version_mismatch"))
    return out


def _stage(rows: DataFrame, counts: list) -> tuple[DataFrame, str, dict[str, int]]:
    """Write the standardised rows by release to the shared folder; ``counts``
    are observed by the write itself (Spark counts each partition once, whatever
    tasks are repeated), so no pass over the staged rows is needed for them."""
    spark = rows.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/icdforge-load-{uuid.uuid4().hex}"
    seen = Observation()
    rows.observe(seen, *counts).write.partitionBy("CMS_Fiscal_Year").parquet(path)
    return spark.read.schema(rows.schema).parquet(path).select(*rows.columns), path, dict(seen.get)


def _unstage(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def _violations(rows: DataFrame, spec: tables.TableSpec, kept: DataFrame | None, totals: dict) -> DataFrame:
    """Every violation of the rows as (check_name, row_key, detail); the NULL
    and length checks run only if the staging write counted any."""

    def entry(name: str, df: DataFrame, keys: list[str], *detail: str) -> DataFrame:
        said = F.to_json(F.struct(*detail)) if detail else F.lit(None).cast("string")
        return df.select(F.lit(name).alias("check_name"), F.to_json(F.struct(*keys)).alias("row_key"), said.alias("detail"))

    keys = list(spec.keys)
    out = entry("duplicate_keys", quality.key_violations(rows, keys), keys, "n_rows")
    if kept is not None:
        out = out.unionByName(entry("keys_already_in_table", quality.key_collisions(rows, kept, keys), keys))
    if totals.get("nulls"):
        out = out.unionByName(entry("nulls", quality.null_violations(rows, spec.not_null(), keys), keys, "column_name"))
    if totals.get("lengths"):
        found = quality.length_violations(rows, spec.limits(), keys)
        out = out.unionByName(entry("lengths", found, keys, "column_name", "max_length", "actual_length"))
    return out


def _load(
    spark: SparkSession,
    *,
    kind: str,
    spec: tables.TableSpec,
    manifest_df: DataFrame,
    source_dir: str,
    table: str | None,
    schema: str | None,
    action: str,
    which: str,
    field_names: dict | None,
    reject_table: str | None,
    max_rejects: int,
    check_table: str | None = None,
    load_id: str | None = None,
    store_dir: str | None = None,
) -> LoadResult:
    target = table or spec.default_name
    store = SnapshotStore(spark, store_dir) if store_dir else None
    base = store.current() if store else None
    action = store.check_action(action, base) if store else sinks.check_action(spark, target, action, schema)
    chosen = releases.select_versions(manifest_df, which)
    rel_rows = [tuple(r) for r in chosen.select("ICD_Version", "CMS_Fiscal_Year", FILE_NAME).orderBy("CMS_Fiscal_Year").collect()]  # one row per release
    if not rel_rows:
        raise ValueError("no releases selected")
    found = resolve_files(spark, source_dir, sorted({f for _, _, f in rel_rows}))  # the folder is listed once
    name = store.root if store else sinks.qualified(target, schema)
    known = dict(base.releases) if action == "REFRESH" and base else {}
    touched = {f for v, y, f in rel_rows if not _same_stamp(known.get(release_key(v, y)), found[f])}
    inspected = _inspect(spark, {f: found[f].path for f in touched})
    sources = {f: {"file": f, "length": found[f].length, "modified": found[f].modified, "digest": inspected[f][1]} for f in touched}
    if known:
        stay = {k for k in (release_key(v, y) for v, y, f in rel_rows if f not in touched or _same_digest(known.get(release_key(v, y)), sources[f])) if k in known}
        rel_rows = [r for r in rel_rows if release_key(*r[:2]) not in stay]
        if not rel_rows:
            return LoadResult(name, 0, 0, [])
        chosen = chosen.filter(F.struct("ICD_Version", "CMS_Fiscal_Year").isin([F.struct(F.lit(v), F.lit(y)) for v, y, _ in rel_rows]))
    used = sorted({f for _, _, f in rel_rows})
    paths = {f: found[f].path for f in used}
    files = {v: sorted({f for w, _, f in rel_rows if kind == "mce" or w == v}) for v in ([None] if kind == "mce" else sorted({v for v, _, _ in rel_rows}))}
    frames = [_scan(spark, paths, names, chosen if v is None else chosen.filter(F.col("ICD_Version") == v), kind, v) for v, names in files.items()]
    code_name = [k for k in spec.keys if k.endswith("Code")][-1]
    if kind == "desc" and code_name != "Diagnosis_Code":
        frames = [f.withColumnRenamed("Diagnosis_Code", code_name) for f in frames]
    rows = frames[0]
    for f in frames[1:]:
        rows = rows.unionByName(f)

    # a refresh reads some of the files, so it does not replace another load's slice
    refreshed = f"-refresh-{base.number + 1}" if known else ""
    load_id = load_id or f"{schema + '.' if schema else ''}{target}-{which}{refreshed}"
    rejects = reject_table or sinks.qualified(f"{target}_rejects", schema)
    checks = check_table or sinks.qualified(f"{target}_checks", schema)
    wrong = {f: inspected[f][0] for f in used if inspected[f][0] not in READABLE}
    staged, path, totals = _stage(_reject_files(rows, wrong), _counts(spec, kind == "mce", [y for _, y, _ in rel_rows]))
    try:
        return _check_and_publish(
            spark, staged, totals, kind=kind, spec=spec, target=target, schema=schema, action=action, field_names=field_names, code_name=code_name,
            rejects=rejects, checks=checks, load_id=load_id, max_rejects=max_rejects, rel_rows=rel_rows, store=store, base=base, sources=sources,
        )
    finally:
        _unstage(spark, path)


def _same_stamp(release: Release | None, file: SourceFile) -> bool:
    was = release.source if release else None
    return was is not None and (was["length"], was["modified"]) == (file.length, file.modified)


def _same_digest(release: Release | None, source: dict) -> bool:
    return release is not None and release.source is not None and release.source["digest"] == source["digest"]


def _check_and_publish(
    spark: SparkSession, rows: DataFrame, totals: dict[str, int], *, kind: str, spec: tables.TableSpec, target: str, schema: str | None, action: str,
    field_names: dict | None, code_name: str, rejects: str, checks: str, load_id: str, max_rejects: int, rel_rows: list,
    store: SnapshotStore | None = None, base: Snapshot | None = None, sources: dict[str, dict] | None = None,
) -> LoadResult:
    good, bad = split_rejects(rows)
    # rejected lines are recorded whatever the checks say (the error file)
    n_bad = totals["rejects"]
    bad = bad.select(F.col(FILE_NAME), F.col("CMS_Fiscal_Year").cast("int"), F.col(RAW).alias("raw"), F.col(REASON).alias("reason"))
    if n_bad or spark.catalog.tableExists(rejects):
        sinks.record(spark, bad if n_bad else bad.limit(0), rejects, load_id, REJECT_DDL)
    found = None
    if kind == "mce":
        if totals["version_mismatch"]:
            keys = F.to_json(F.struct(*spec.keys))
            found = quality.version_mismatches(good).select(
                F.lit("version_mismatch").alias("check_name"), keys.alias("row_key"),
                F.to_json(F.struct(FILE_NAME, "ICD_Version", "Release_ICD_Version")).alias("detail"),
            )
        good = good.drop("Release_ICD_Version")
    good = good.drop(FILE_NAME)
    out_spec = spec.renamed(field_names or {})
    good = rename_columns(good.select(*spec.names), field_names)

    name = store.root if store else sinks.qualified(target, schema)
    kept = None
    if store:
        stay = store.kept(action, base, rel_rows)
        kept = store.rows_of(replace(base, releases=stay)) if stay else None
    elif sinks.table_exists(spark, target, schema) and action in ("APPEND", "DELETE_ICD9", "DELETE_ICD10"):
        kept = spark.table(name)
        if action != "APPEND":
            drop_v = 9 if action == "DELETE_ICD9" else 10
            kept = kept.filter(F.col(out_spec.partition_by[0]) != drop_v)
    violations = _violations(good, out_spec, kept, totals)
    violations = violations if found is None else violations.unionByName(found)
    report = {}
    if sinks.record(spark, violations, checks, load_id, CHECK_DDL):
        report = {r["check_name"]: r["count"] for r in spark.table(checks).filter(F.col("Load_Id") == load_id).groupBy("check_name").count().collect()}
    if report:
        raise LoadCheckError(f"load into {name} failed its checks: {report}; rows in {checks}", report, checks)
    if n_bad > max_rejects:
        raise LoadCheckError(f"{n_bad} rejected rows (max {max_rejects}), kept in {rejects}", {"rejects": n_bad}, rejects)

    have = {(v, fy) for v, fy, _ in rel_rows if totals[f"good_{fy}"]}
    sort_col = (field_names or {}).get(code_name, code_name)
    if store:
        store.publish(good, out_spec, action, base, load_id, sort_col, {release_key(v, fy): sources[f] for v, fy, f in rel_rows})
    else:
        sinks.publish(spark, good, target, out_spec, action, schema, sort_col=sort_col, releases=have)
    log.info("loaded %s rows into %s (%s rejects)", totals["good"], name, n_bad)
    return LoadResult(name, totals["good"], n_bad, [r[:2] for r in rel_rows], tuple(sorted({f for _, _, f in rel_rows})))


def load_diagnosis(
    spark: SparkSession,
    source_dir: str,
    table: str | None = None,
    schema: str | None = None,
    action: str = "DROP_CREATE",
    which: str = "ALL",
    field_names: dict | None = None,
    reject_table: str | None = None,
    max_rejects: int = 0,
    check_table: str | None = None,
    load_id: str | None = None,
    store_dir: str | None = None,
    releases_=releases.DIAGNOSIS_RELEASES,
) -> LoadResult:
    """Diagnosis code descriptions (ICD-9 quoted-bar and ICD-10 order files)."""
    return _load(
        spark, kind="desc", spec=tables.DIAGNOSIS, manifest_df=releases.manifest(spark, releases_),
        source_dir=source_dir, table=table, schema=schema, action=action, which=which,
        field_names=field_names, reject_table=reject_table, max_rejects=max_rejects,
        check_table=check_table, load_id=load_id, store_dir=store_dir,
    )


def load_procedure(
    spark: SparkSession,
    source_dir: str,
    table: str | None = None,
    schema: str | None = None,
    action: str = "DROP_CREATE",
    which: str = "ALL",
    field_names: dict | None = None,
    reject_table: str | None = None,
    max_rejects: int = 0,
    check_table: str | None = None,
    load_id: str | None = None,
    store_dir: str | None = None,
    releases_=releases.PROCEDURE_RELEASES,
) -> LoadResult:
    """Procedure code descriptions; same layouts and rules as diagnoses."""
    return _load(
        spark, kind="desc", spec=tables.PROCEDURE, manifest_df=releases.manifest(spark, releases_),
        source_dir=source_dir, table=table, schema=schema, action=action, which=which,
        field_names=field_names, reject_table=reject_table, max_rejects=max_rejects,
        check_table=check_table, load_id=load_id, store_dir=store_dir,
    )


def load_poa_exempt(
    spark: SparkSession,
    source_dir: str,
    table: str | None = None,
    schema: str | None = None,
    action: str = "DROP_CREATE",
    which: str = "ALL",
    reject_table: str | None = None,
    max_rejects: int = 0,
    check_table: str | None = None,
    load_id: str | None = None,
    store_dir: str | None = None,
    releases_=releases.POA_EXEMPT_RELEASES,
) -> LoadResult:
    """POA-exempt diagnosis lists; ICD-9 codes get their period."""
    return _load(
        spark, kind="poa", spec=tables.POA_EXEMPT, manifest_df=releases.manifest(spark, releases_),
        source_dir=source_dir, table=table, schema=schema, action=action, which=which,
        field_names=None, reject_table=reject_table, max_rejects=max_rejects,
        check_table=check_table, load_id=load_id, store_dir=store_dir,
    )


def load_mce_edits(
    spark: SparkSession,
    source_dir: str,
    table: str | None = None,
    schema: str | None = None,
    action: str = "DROP_CREATE",
    which: str = "ALL",
    reject_table: str | None = None,
    max_rejects: int = 0,
    check_table: str | None = None,
    load_id: str | None = None,
    store_dir: str | None = None,
    releases_=releases.MCE_RELEASES,
) -> LoadResult:
    """MCE simple code edits (one layout for both ICD versions)."""
    return _load(
        spark, kind="mce", spec=tables.MCE_EDITS, manifest_df=releases.mce_manifest(spark, releases_),
        source_dir=source_dir, table=table, schema=schema, action=action, which=which,
        field_names=None, reject_table=reject_table, max_rejects=max_rejects,
        check_table=check_table, load_id=load_id, store_dir=store_dir,
    )
