"""Robust multivariate outliers of text statistics (DataFrame functions only).

Per language and source, a minimum-covariance-determinant estimate of location
and scatter is fitted to transformed statistic vectors, and documents far from
it by Mahalanobis distance are rejected, besides those a base rule rejects.

Statistics cover whole texts and stay in one row: word arrays, window hashes
and their duplicates are array expressions, nothing is exploded or shuffled.
The estimate takes three deterministic starts around the coordinate-wise medians
with the quartiles' spreads: no correlation, the correlation of squashed (tanh)
standardised values, and that of their directions.  Each takes ``start_steps``
concentration steps: distances under the current estimate, the ``h`` share of
nearest rows, their mean and covariance.  The start with the smallest determinant
goes on until the determinants of all groups stay, at most ``steps`` times.  Quantiles come from counts on a fixed
grid (exactly mergeable, so reruns agree and a hot group is combined before
its shuffle); only one row per group ever moves on.  Each scatter matrix gets a
fixed ridge, so statistics that are constant in a group stay harmless.

A source with fewer than ``min_rows`` fitted rows is judged by the estimate over
all rows of its language, and where these are too few by the one over all rows of
the table; only a table of fewer rows gives no verdict and keeps them.

A dense cluster of alike outliers that makes up about a fifth of a group or more
may hold the estimate; spread-out outliers are told up to the share 1 - ``h``.

Defined results: null or empty text has zero words and fails the base rule;
null language or source is a value of its own; repeated rows are separate rows;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BLANKS, WORD, keeping_names, materialize, text_of, value_key

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: ridge (a standard deviation) of each transformed statistic, see ``_vector``;
#: each is small enough for its statistic to reach the cutoff by itself (a share
#: of repeated words is at most 0.5 after the base rule)
RIDGE = (0.5, 0.08, 0.15, 0.4, 0.05)


@dataclass(frozen=True)
class RobustSpec:
    #: share of a group's rows that the determinant is minimised over
    h: float = 0.75
    #: makes that share's covariance consistent for normal data in 5 dimensions
    consistency: float = 1.41
    #: concentration steps of each start, and at most of the chosen one
    start_steps: int = 2
    steps: int = 12
    #: change of half the log determinant below which a group has settled
    settled: float = 1e-3
    min_rows: int = 60
    #: squared distance beyond which a row is rejected (chi-square, 5 degrees, about 1 - 1e-6)
    cutoff: float = 36.0


def statistics(docs: DataFrame, prefix: str = "") -> DataFrame:
    """``docs`` with the five statistics of its whole texts, as long columns."""
    p = prefix
    bare = F.btrim(text_of("text"), F.lit(BLANKS))
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[\x20\x09-\x0D]+"))
    lines = F.filter(F.split(text_of("text"), "\n"), lambda x: x.rlike(WORD))
    no_longs = F.array().cast("array<bigint>")
    d = docs.withColumns({"__words": words, "__lines": lines})
    window = lambda i: F.xxhash64(F.get("__words", i), F.get("__words", i + 1), F.get("__words", i + 2))
    d = d.withColumn("__wins", F.when(F.size("__words") >= 3, F.transform(F.sequence(F.lit(0), F.size("__words") - 3), window)).otherwise(no_longs))
    # positions are only looked at in texts with a repeated window; neighbours in sorted order share the hash
    pairs = F.array_sort(F.transform("__wins", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
    d = d.withColumn("__sorted", F.when(F.size(F.array_distinct("__wins")) < F.size("__wins"), pairs).otherwise(F.array().cast("array<struct<x:bigint,i:int>>")))
    same = lambda x, j: F.coalesce(F.get("__sorted", j)["x"] == x["x"], F.lit(False))
    d = d.withColumn("__twice", F.transform(F.filter("__sorted", lambda x, j: ((j > 0) & same(x, j - 1)) | same(x, j + 1)), lambda x: x["i"]))
    return d.withColumns({
        f"{p}n_words": F.size("__words").cast("long"),
        f"{p}word_chars": F.length(F.array_join("__words", "")).cast("long"),
        f"{p}n_symbols": F.length(F.regexp_replace(text_of("text"), r"[^#*$%&|<>]+", "")).cast("long"),
        f"{p}n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        f"{p}n_repeat_words": F.size(F.array_distinct(F.flatten(F.transform("__twice", lambda i: F.array(i, i + 1, i + 2))))).cast("long"),
    }).drop("__words", "__lines", "__wins", "__sorted", "__twice")


def base_failed(prefix: str = "") -> Column:
    n, r = F.col(f"{prefix}n_words"), F.col(f"{prefix}n_repeat_words")
    return (n < 50) | (100 * r > 50 * n)


def _vector(prefix: str = "") -> list[Column]:
    """Transformed statistics: log length, log mean word length, log symbols
    per hundred words, log repeated lines, share of repeated words."""
    n, chars, symbols, lines, repeats = (F.col(f"{prefix}{s}").cast("double") for s in STATS)
    some = F.greatest(n, F.lit(1.0))
    return [F.log(some), F.log(F.greatest(chars, F.lit(1.0)) / some), F.log1p(100 * symbols / some), F.log1p(lines), repeats / some]


P = len(RIDGE)
LOWER = [(i, j) for i in range(P) for j in range(i + 1)]


def _factor(params: DataFrame, keys: list[str]) -> DataFrame:
    """``keys``, the centre m<i> and the lower Cholesky factor l<i><j> of the ridged matrix c<i><j>."""
    for i, j in LOWER:
        v = F.col(f"c{i}{j}")
        for k in range(j):
            v = v - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
        params = params.withColumn(f"l{i}{j}", F.sqrt(F.greatest(v, F.lit(RIDGE[i] ** 2 / 4))) if i == j else v / F.col(f"l{j}{j}"))
    return params.select(*keys, *(f"m{i}" for i in range(P)), *(f"l{i}{j}" for i, j in LOWER))


def _log_det() -> Column:
    """Half the log of the determinant, from the factor."""
    return sum((F.log(f"l{i}{i}") for i in range(P)), F.lit(0.0))


def _distance(rows: DataFrame) -> DataFrame:
    """Adds d2, the squared Mahalanobis distance of x0.. under m, l."""
    for i in range(P):
        v = F.col(f"x{i}") - F.col(f"m{i}")
        for j in range(i):
            v = v - F.col(f"l{i}{j}") * F.col(f"y{j}")
        rows = rows.withColumn(f"y{i}", v / F.col(f"l{i}{i}"))
    return rows.withColumn("d2", sum((F.col(f"y{i}") * F.col(f"y{i}") for i in range(P)), F.lit(0.0)))


def _grid_quantiles(cells: DataFrame, keys: list[str], at: dict[str, float]) -> DataFrame:
    """Per key, the smallest cell whose cumulative count reaches each share.
    ``cells``: keys and ``cell``; counts are combined before the shuffle."""
    counts = cells.groupBy(*keys, "cell").agg(F.count("*").alias("n"))
    w = Window.partitionBy(*keys)
    ahead = counts.withColumns({"cum": F.sum("n").over(w.orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)), "all": F.sum("n").over(w)})
    return ahead.groupBy(*keys).agg(*(F.min(F.when(F.col("cum") >= F.col("all") * q, F.col("cell"))).alias(name) for name, q in at.items()))


def group_keys(rows: DataFrame, spec: RobustSpec) -> DataFrame:
    """(lkey, skey) -> gkey, the group that judges its rows: the source's own,
    else all of the language, else all of the table (null if even that has too
    few rows), and ``feeds``, the groups that its rows are fitted in."""
    n = materialize(rows.filter(~F.col("failed")).groupBy("lkey", "skey").agg(F.count("*").alias("n")), "robust-counts")
    whole = n.agg(F.sum("n").alias("n")).first()["n"] or 0
    langs = n.groupBy("lkey").agg(F.sum("n").alias("all"), F.min("n").alias("least"))
    n = n.join(langs, "lkey")
    source = F.concat_ws("/", F.lit("s"), F.length("lkey"), "lkey", "skey")
    lang, table = F.concat_ws("/", F.lit("l"), "lkey"), F.lit("t")
    last = table if whole >= spec.min_rows else F.lit(None).cast("string")
    own, wide = F.col("n") >= spec.min_rows, F.col("all") >= spec.min_rows
    gkey = F.when(own, source).when(wide, lang).otherwise(last)
    lacking = not n.filter(~wide).isEmpty()  # some language needs the table's estimate
    feeds = F.array_compact(F.array(F.when(own, source), F.when(wide & (F.col("least") < spec.min_rows), lang), last if lacking else F.lit(None).cast("string")))
    return n.select("lkey", "skey", gkey.alias("gkey"), feeds.alias("feeds"))


def fit(rows: DataFrame, spec: RobustSpec = RobustSpec()) -> tuple[DataFrame, DataFrame]:
    """(groups, params) from ``rows``: lkey, skey, failed, x0..x4.  One row per
    language and source, and per group: centre m<i> and factor l<i><j>."""
    groups = materialize(group_keys(rows, spec), "robust-groups")
    fitted = materialize(rows.filter(~F.col("failed")).join(groups, ["lkey", "skey"]).select(F.explode("feeds").alias("gkey"), *(f"x{i}" for i in range(P))), "robust-vectors")

    params = materialize(_starts(fitted), "robust-start")
    for k in range(spec.start_steps):
        params = _concentrate(fitted, params, ["gkey", "start"], spec, f"start{k}")
    ends = F.struct(*(f"m{i}" for i in range(P)), *(f"l{i}{j}" for i, j in LOWER))
    params = materialize(params.groupBy("gkey").agg(F.min_by(ends, F.struct(_log_det(), "start")).alias("p")).select("gkey", "p.*"), "robust-best")
    for k in range(spec.steps):
        nxt = _concentrate(fitted, params, ["gkey"], spec, f"step{k}")
        was, now = params.select("gkey", _log_det().alias("was")), nxt.select("gkey", _log_det().alias("now"))
        change = was.join(now, "gkey").agg(F.max(F.abs(F.col("was") - F.col("now")))).first()[0]
        params = nxt
        if (change or 0.0) <= spec.settled:
            break
    return groups, params


def _starts(fitted: DataFrame) -> DataFrame:
    """(gkey, start, m<i>, l<i><j>): the three starts of every group."""
    step = 0.01
    cells = fitted.select("gkey", F.explode(F.array(*(F.struct(F.lit(i).alias("dim"), F.round(F.col(f"x{i}") / step).cast("long").alias("cell")) for i in range(P)))).alias("e")).select("gkey", "e.dim", "e.cell")
    q = _grid_quantiles(cells, ["gkey", "dim"], {"lo": 0.25, "mid": 0.5, "hi": 0.75})
    wide = q.groupBy("gkey").agg(*(F.max(F.when(F.col("dim") == i, F.col(c))).alias(f"{c}{i}") for i in range(P) for c in ("lo", "mid", "hi")))
    spread = lambda i: F.sqrt(F.pow((F.col(f"hi{i}") - F.col(f"lo{i}")) * (step / 1.349), 2) + RIDGE[i] ** 2)
    middle = materialize(wide.select("gkey", *((F.col(f"mid{i}") * step).alias(f"m{i}") for i in range(P)), *(spread(i).alias(f"s{i}") for i in range(P))), "robust-middle")

    z = fitted.join(middle, "gkey").withColumns({f"z{i}": (F.col(f"x{i}") - F.col(f"m{i}")) / F.col(f"s{i}") for i in range(P)})
    z = z.withColumn("norm", F.greatest(F.sqrt(sum((F.col(f"z{i}") * F.col(f"z{i}") for i in range(P)), F.lit(0.0))), F.lit(1e-9)))
    z = z.select("gkey", *(F.tanh(f"z{i}").alias(f"t{i}") for i in range(P)), *((F.col(f"z{i}") / F.col("norm")).alias(f"u{i}") for i in range(P)))
    both = z.groupBy("gkey").agg(*(F.covar_pop(f"t{i}", f"t{j}").alias(f"t{i}{j}") for i, j in LOWER), *(F.avg(F.col(f"u{i}") * F.col(f"u{j}")).alias(f"u{i}{j}") for i, j in LOWER))

    def scatter(i: int, j: int, of: str | None) -> Column:
        if i == j:
            return F.col(f"s{i}") * F.col(f"s{j}")
        size = F.sqrt(F.col(f"{of}{i}{i}") * F.col(f"{of}{j}{j}")) if of else F.lit(0.0)
        return F.when(size > 1e-12, F.col(f"{of}{i}{j}") / size * F.col(f"s{i}") * F.col(f"s{j}")).otherwise(0.0) if of else F.lit(0.0)

    each = [F.struct(F.lit(k).alias("start"), *(scatter(i, j, of).alias(f"c{i}{j}") for i, j in LOWER)) for k, of in enumerate((None, "t", "u"))]
    starts = middle.join(both, "gkey").select("gkey", *(f"m{i}" for i in range(P)), F.explode(F.array(*each)).alias("e")).select("*", "e.*")
    return _factor(starts, ["gkey", "start"])


def _concentrate(fitted: DataFrame, params: DataFrame, keys: list[str], spec: RobustSpec, name: str) -> DataFrame:
    """One concentration step of every estimate in ``params``."""
    far = _distance(fitted.join(params, "gkey")).withColumn("cell", F.floor(F.log2(F.col("d2") + 1e-6) * 64))
    near = materialize(_grid_quantiles(far.select(*keys, "cell"), keys, {"most": spec.h}), f"robust-near-{name}")
    inside = far.join(near, keys).filter("cell <= most")
    moments = inside.groupBy(*keys).agg(*(F.avg(f"x{i}").alias(f"m{i}") for i in range(P)), *(F.covar_pop(f"x{i}", f"x{j}").alias(f"v{i}{j}") for i, j in LOWER))
    nxt = moments.select(*keys, *(f"m{i}" for i in range(P)), *(
        (F.col(f"v{i}{j}") * spec.consistency + (RIDGE[i] ** 2 if i == j else 0.0)).alias(f"c{i}{j}") for i, j in LOWER))
    return materialize(_factor(nxt, keys), f"robust-{name}")


def judge(docs: DataFrame, spec: RobustSpec = RobustSpec(), prefix: str = "") -> DataFrame:
    """``docs`` (with statistics under ``prefix``, lang and source) plus
    ``<prefix>base_failed``, ``<prefix>distance`` (squared; null: no verdict)
    and ``<prefix>kept``.  ``docs`` should be a written table: it is read for
    the fit and again for the verdict."""
    p = prefix
    keyed = docs.withColumns({"__l": value_key("lang"), "__s": value_key("source"), f"{p}base_failed": base_failed(p)})
    x = {f"x{i}": v for i, v in enumerate(_vector(p))}
    rows = keyed.select(F.col("__l").alias("lkey"), F.col("__s").alias("skey"), F.col(f"{p}base_failed").alias("failed"), *(v.alias(k) for k, v in x.items()))
    groups, params = fit(rows, spec)
    # one row per language and source: its group's estimate
    table = groups.join(params, "gkey")
    table = table.select(F.col("lkey").alias("__l"), F.col("skey").alias("__s"), *(F.col(f"m{i}").alias(f"__m{i}") for i in range(P)), *(F.col(f"l{i}{j}").alias(f"__l{i}{j}") for i, j in LOWER))
    out = keyed.join(materialize(table, "robust-table"), ["__l", "__s"], "left")
    y: list[str] = []
    for i, v in enumerate(_vector(p)):
        v = v - F.col(f"__m{i}")
        for j in range(i):
            v = v - F.col(f"__l{i}{j}") * F.col(f"__y{j}")
        out = out.withColumn(f"__y{i}", v / F.col(f"__l{i}{i}"))
        y.append(f"__y{i}")
    distance = sum((F.col(c) * F.col(c) for c in y), F.lit(0.0))
    out = out.withColumn(f"{p}distance", distance).withColumn(f"{p}kept", ~F.col(f"{p}base_failed") & (F.coalesce(F.col(f"{p}distance"), F.lit(0.0)) <= spec.cutoff))
    return out.select(*docs.columns, f"{p}base_failed", f"{p}distance", f"{p}kept")


def robust_rules(docs: DataFrame, spec: RobustSpec = RobustSpec()) -> DataFrame:
    """doc_id, the statistics, base_failed, distance and kept per document."""
    narrow = statistics(docs.select("doc_id", "text", "lang", "source")).drop("text")
    return judge(materialize(narrow, "quality-stats"), spec).drop("lang", "source")


@keeping_names
def quality_documents(docs: DataFrame, spec: RobustSpec = RobustSpec()) -> DataFrame:
    """The documents that are kept, with the columns of ``docs``."""
    table = materialize(statistics(docs, "__q_"), "quality-docs")
    return judge(table, spec, "__q_").filter("__q_kept").select(*docs.columns)
