"""Releases over several years: chains of deltas, release fingerprints and
validity spans of codes.

Every operator is one scan of its tables and one exchange by code or release;
per code at most one entry a release is held, and release lists are manifests
(one row per release), so they are broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import quality
from .joins import lookup_join

VER, FY = "ICD_Version", "CMS_Fiscal_Year"


# ------------------------------------------------------------ chains of deltas

def _chain_error(code_col: str, what: str) -> Column:
    return F.raise_error(F.concat_ws(" ", F.lit(f"{what}:"), F.col(VER).cast("string"), F.col(code_col)))


def compose_deltas(delta: DataFrame, code_col: str, from_fy: int | None = None, to_fy: int | None = None) -> DataFrame:
    """One delta per ICD version from the deltas of consecutive releases, from
    the release ``from_fy`` to ``to_fy`` (default: all).

    Folded per code: the first entry says what the code was, the last what it
    became, so both are map-side combined and no list is kept.  A code that was
    added and deleted again, or came back as it was, has no entry."""
    if from_fy is not None:
        delta = delta.filter(F.col("From_FY") >= from_fy)
    if to_fy is not None:
        delta = delta.filter(F.col("To_FY") <= to_fy)
    span = delta.groupBy(VER).agg(F.min("From_FY").alias("From_FY"), F.max("To_FY").alias("To_FY"))  # one row per version
    entry = F.struct("Change", "Old_Desc", "New_Desc")
    per = delta.groupBy(VER, code_col).agg(F.min_by(entry, "From_FY").alias("a"), F.max_by(entry, "From_FY").alias("z"))
    was, became = F.col("a.Change") != "added", F.col("z.Change") != "deleted"
    change = F.when(was & became, F.when(~F.col("a.Old_Desc").eqNullSafe(F.col("z.New_Desc")), F.lit("revised"))).when(was, F.lit("deleted")).when(became, F.lit("added"))
    out = per.join(F.broadcast(span), VER).select(
        VER, "From_FY", "To_FY", code_col, change.alias("Change"), F.when(was, F.col("a.Old_Desc")).alias("Old_Desc"), F.when(became, F.col("z.New_Desc")).alias("New_Desc"))
    return out.filter("Change IS NOT NULL")


def rebuild_releases(newest: DataFrame, delta: DataFrame, pairs: DataFrame, code_col: str, desc_col: str = "Code_Desc_Long") -> DataFrame:
    """Every earlier release from the newest one of each ICD version and the
    deltas between consecutive releases alone.

    ``newest``: rows (version, code, description) of the last ``To_FY`` of
    ``pairs``.  One exchange by code brings its newest row and its changes (at
    most one a pair) together; going back, a release holds the code as the next
    change after it says, and as the newest release does where none follows.
    Changes that contradict each other or the newest release, two changes of a
    code in one pair and two newest rows of a code fail the query."""
    none = F.lit(None).cast("string")
    steps = delta.select(VER, code_col, F.struct("From_FY", "To_FY", "Change", "Old_Desc", "New_Desc").alias("_step"), F.lit(0).alias("_in"), none.alias("_now"))
    empty = F.lit(None).cast(steps.schema["_step"].dataType)
    both = steps.unionByName(newest.select(VER, code_col, empty.alias("_step"), F.lit(1).alias("_in"), F.col(desc_col).alias("_now")))
    per = both.groupBy(VER, code_col).agg(F.sort_array(F.collect_list("_step")).alias("_steps"), F.sum("_in").alias("_rows"), F.max("_now").alias("_now"))
    last = F.try_element_at("_steps", F.lit(-1))
    has = F.size("_steps") > 0
    ends = F.when(F.col("_rows") > 1, _chain_error(code_col, "two newest rows of a code")).when(
        has & ((last["Change"] == "deleted") == (F.col("_rows") == 1)), _chain_error(code_col, "the last change contradicts the newest release")).when(
        has & (last["Change"] != "deleted") & ~last["New_Desc"].eqNullSafe(F.col("_now")), _chain_error(code_col, "the last description is not the newest release's"))
    near = F.expr("""exists(sequence(0, size(_steps) - 2), i -> size(_steps) > 1 and (
      _steps[i].From_FY = _steps[i + 1].From_FY or (_steps[i].Change = 'deleted') <> (_steps[i + 1].Change = 'added')
      or (_steps[i].Change <> 'deleted' and not _steps[i].New_Desc <=> _steps[i + 1].Old_Desc)))""")
    links = F.when(F.when(F.size("_steps") > 1, near).otherwise(False), _chain_error(code_col, "changes contradict each other"))
    checked = per.withColumn("_rows", F.coalesce(ends.cast("long"), links.cast("long"), F.col("_rows")))
    earlier = pairs.groupBy(VER).agg(F.sort_array(F.collect_set("From_FY")).alias("_releases"))  # one row per version
    every = checked.join(F.broadcast(earlier), VER).select(VER, code_col, "_steps", "_rows", "_now", F.explode("_releases").alias(FY))
    after = F.expr(f"try_element_at(filter(_steps, s -> s.From_FY >= {FY}), 1)")
    every = every.withColumn("_next", after)
    held = F.when(F.col("_next").isNotNull(), F.col("_next.Change") != "added").otherwise(F.col("_rows") == 1)
    return every.filter(held).select(VER, FY, code_col, F.when(F.col("_next").isNotNull(), F.col("_next.Old_Desc")).otherwise(F.col("_now")).alias(desc_col))


# -------------------------------------------------------- release fingerprints

#: hexadecimal digits of a row's digest in each of the four sums
LANE_DIGITS = 15


def release_fingerprints(dim: DataFrame, row_cols: Sequence[str]) -> DataFrame:
    """One row per release: n_rows and four sums over its rows' digests.

    Sums do not depend on the order of rows, count repeated rows as often as
    they occur and are combined map-side; releases with different multisets of
    rows agree with a chance of about 2 ** -240.  Values are told from each
    other and from null by their lengths."""
    parts = [F.coalesce(F.concat(F.length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("n")) for c in row_cols]
    digest = F.sha2(F.concat(*parts).cast("binary"), 256)
    rows = dim.select(VER, FY, digest.alias("_d"))
    lanes = [F.sum(F.conv(F.substring("_d", 1 + LANE_DIGITS * k, LANE_DIGITS), 16, 10).cast("decimal(38,0)")).alias(f"Sum_{k + 1}") for k in range(4)]
    return rows.groupBy(VER, FY).agg(F.count("*").alias("n_rows"), *lanes)


def identical_releases(fingerprints: DataFrame, pairs: DataFrame, dim: DataFrame | None = None, row_cols: Sequence[str] = ()) -> DataFrame:
    """Per pair of consecutive releases: row counts and whether they hold the
    same rows, from the stored fingerprints (one row per release) alone.

    With ``dim`` the pairs whose fingerprints agree are settled by the full
    multiset comparison, which reads only the releases of those pairs; a
    fingerprint that agrees by accident or is stale then reads as N.  A release
    without rows has no fingerprint; it is identical to another such release."""
    sums = ["n_rows", *(f"Sum_{k}" for k in range(1, 5))]
    side = lambda p, fy: fingerprints.select(F.col(VER), F.col(FY).alias(fy), F.struct(*sums).alias(p))
    both = pairs.join(side("_old", "From_FY"), [VER, "From_FY"], "left").join(side("_new", "To_FY"), [VER, "To_FY"], "left")
    both = both.select(VER, "From_FY", "To_FY", *(F.coalesce(F.col(f"{s}.n_rows"), F.lit(0)).alias(n) for s, n in (("_old", "n_old"), ("_new", "n_new"))), F.col("_old").eqNullSafe(F.col("_new")).alias("_same"))
    if dim is None:
        return both.select(VER, "From_FY", "To_FY", "n_old", "n_new", F.when(F.col("_same"), "Y").otherwise("N").alias("Is_Identical"))
    old = both.filter("_same").select(VER, F.col("From_FY").alias(FY), "From_FY", "To_FY", F.lit("old").alias("_side"))
    new = both.filter("_same").select(VER, F.col("To_FY").alias(FY), "From_FY", "To_FY", F.lit("new").alias("_side"))
    tagged = dim.join(F.broadcast(old.unionByName(new)), [VER, FY])  # two rows per pair of releases
    differ = quality.multiset_difference_counts(tagged, [VER, "From_FY", "To_FY"], list(row_cols)).filter("n_only_old + n_only_new > 0")
    said = both.join(differ, [VER, "From_FY", "To_FY"], "left")
    return said.select(VER, "From_FY", "To_FY", "n_old", "n_new", F.when(F.col("_same") & F.col("n_only_old").isNull(), "Y").otherwise("N").alias("Is_Identical"))


# ------------------------------------------------------------- validity spans

def code_spans(codes: DataFrame, manifest_df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Runs of consecutive releases in which a code is held: ``keys``, version,
    From_FY, To_FY, Valid_From, Valid_To, n_releases.

    Releases are numbered in the manifest (broadcast, one row per release), so
    a missing release of the calendar is no gap.  One exchange brings a code's
    releases together, at most one entry a release; a run begins where the entry
    before has another number than the one before, and ends likewise.  Repeated
    rows of a release count once."""
    order = Window.partitionBy(VER).orderBy(FY)
    cal = manifest_df.select(VER, FY, "Effective_Date", "End_Date").distinct().withColumn("no", F.row_number().over(order))
    own = [VER, *keys]
    rows = codes.select(*own, FY).join(F.broadcast(cal), [VER, FY])
    per = rows.groupBy(*own).agg(F.sort_array(F.collect_set(F.struct("no", FY, "Effective_Date", "End_Date"))).alias("_r"))
    first = F.expr("filter(_r, (x, i) -> i = 0 or x.no - _r[i - 1].no > 1)")
    last = F.expr("filter(_r, (x, i) -> i = size(_r) - 1 or _r[i + 1].no - x.no > 1)")
    runs = per.select(*own, F.explode(F.arrays_zip(first.alias("a"), last.alias("z"))).alias("_run"))
    return runs.select(
        *own, F.col(f"_run.a.{FY}").alias("From_FY"), F.col(f"_run.z.{FY}").alias("To_FY"), F.col("_run.a.Effective_Date").alias("Valid_From"), F.col("_run.z.End_Date").alias("Valid_To"),
        (F.col("_run.z.no") - F.col("_run.a.no") + 1).cast("int").alias("n_releases"))


def invalid_reasons(used: DataFrame, spans: DataFrame, keys: Sequence[str], headers: DataFrame | None = None, salt: Sequence[str] = (), span_rows: int | None = None) -> DataFrame:
    """Rows of ``used`` (``keys``, version, fiscal year, ...) whose code is not
    valid in their release, with ``Reason``: header_code (``headers`` holds the
    code in that release: a heading, not a billable code), never_valid,
    not_yet (valid later only), no_longer (valid before only) or suspended
    (before and after).

    The lookup has one row per code with its spans, at most one a release, and
    is joined like other code tables: broadcast up to a counted size, salted
    beyond it, so a code that a third of all rows use is spread."""
    own = [VER, *keys]
    per = spans.select(*own, F.struct("From_FY", "To_FY").alias("_span"), F.lit(None).cast("int").alias("_head"))
    if headers is not None:
        per = per.unionByName(headers.select(*own, F.lit(None).cast(per.schema["_span"].dataType).alias("_span"), F.col(FY).cast("int").alias("_head")))
    table = per.groupBy(*own).agg(F.sort_array(F.collect_set("_span")).alias("_spans"), F.collect_set("_head").alias("_heads"))
    seen = lookup_join(used, table, own, "left", salt or own, span_rows)
    valid = F.expr(f"exists(_spans, s -> {FY} between s.From_FY and s.To_FY)")
    reason = F.when(F.expr(f"array_contains(_heads, {FY})"), "header_code").when(F.coalesce(F.size("_spans"), F.lit(0)) < 1, "never_valid").when(
        F.expr(f"{FY} < try_element_at(_spans, 1).From_FY"), "not_yet").when(F.expr(f"{FY} > try_element_at(_spans, -1).To_FY"), "no_longer").otherwise("suspended")
    return seen.filter(~F.coalesce(valid, F.lit(False))).withColumn("Reason", reason).drop("_spans", "_heads")
