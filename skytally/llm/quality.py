"""Quality rules: base limits, then robust multivariate outliers for each language and source.

Four statistics of a text become a vector of rates. For each language and source the
minimum-covariance-determinant estimate of centre and covariance is sought from several starts by
concentration steps: take the three quarters of rows that lie nearest to the present estimate, estimate
again from them, until the determinant falls no more; of the ends, the one with the least determinant
stands. The same is done for each language as a whole, and a source's estimate is drawn
towards its language's the more the fewer rows it has; languages never share an estimate. After
a reweighting step, a row is rejected when its Mahalanobis distance is beyond what the estimate
and the number of rows behind it allow. Everything is DataFrame functions; the text is read once.

Quantiles come from counts of narrow classes of values, which add up in any order: results do not depend on how rows are
spread over tasks, and no task gets more than a row for each class of a group.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skytally.llm.rows import matching
from skytally.session import stage

SPACE = " \t\n\x0b\x0c\r"
SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

#: Names of the vector's parts, and the least standard deviation assumed for each. Most texts have no symbol and no
#: repeated line at all, so that a covariance without a floor would be singular and call any first symbol an outlier.
#: Each part can pass the cut by itself: repeats, 0.3 at most after the base limits, from 0.2873 on where nothing repeats.
PARTS = {"length": 0.045, "symbols": 0.04, "lines": 0.08, "repeats": 0.05}
#: Share of the rows that a concentration step keeps.
SHARE = 0.75
#: Makes the covariance of the nearest three quarters that of all, for four normal variables.
CONSISTENCY = 1.487
#: 97.5 % of the chi-squared distribution with four degrees of freedom: what the reweighting step keeps.
REWEIGHT = 11.143
#: Rejected beyond this squared distance where the estimate rests on very many rows; see :func:`_kept` for few.
CUT = 33.0
#: So many rows of the language count in the estimate of each of its sources, besides the source's own.
PRIOR_ROWS = 100
#: Estimates that the concentration steps begin with, and steps of each at most; they end before, as a rule.
STARTS = ("spread", "bounded", "signs")
MOST_STEPS = 20
#: Width of the classes of values that quantiles are found by; squared distances have 64 classes for each factor of two.
CLASS = 1 / 1024
#: Copies of estimates, over all groups, that are made so that a group's rows can go to several tasks.
COPIES = 1_000_000


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once for each row."""
    return F.transform(F.array(value), then)[0]


def _repeated_words(words: Column, n: Column) -> Column:
    """Words that lie in a window found twice or more; windows are told apart by 64-bit hashes."""
    windows = F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(F.slice(words, i + 1, WINDOW)))

    def covered(hashes: Column) -> Column:
        in_order = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def starts(s: Column) -> Column:
            same = lambda j, k: F.coalesce(F.get(s, j)["h"] == F.get(s, k)["h"], F.lit(False))
            twice = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda j: same(j, j - 1) | same(j, j + 1))
            return F.sort_array(F.transform(twice, lambda j: F.get(s, j)["i"]))

        def length(p: Column) -> Column:
            zero = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last"))
            step = lambda a, x: F.struct(
                (a["n"] + F.least(F.lit(WINDOW), x - a["last"])).alias("n"), x.alias("last")
            )
            return F.aggregate(p, zero, step, lambda a: a["n"])

        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), let(let(in_order, starts), length)).otherwise(0)

    return F.when(n >= WINDOW, let(windows, covered)).otherwise(0)


def base_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without its text, with the columns of :data:`BASE` (long) and ``base_failed``.

    A NULL text has no words. Columns of ``docs`` with these names are replaced.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    others = [c for c in docs.columns if c != text_col and c.lower() not in (*BASE, "base_failed")]
    trimmed = F.btrim(text, F.lit(SPACE))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACES))
    split = docs.select(*others, text.alias("__text"), words.alias("__words"))
    lines = F.filter(F.split("__text", "\n"), lambda line: F.btrim(line, F.lit(SPACE)) != "")
    n = F.size("__words")
    counted = split.select(
        *others,
        n.alias("n_words"),
        F.length(F.translate("__text", SPACE, "")).alias("word_chars"),
        (F.length("__text") - F.length(F.translate("__text", SYMBOLS, ""))).alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines"),
        _repeated_words(F.col("__words"), n).alias("n_repeat_words"),
    )
    counted = counted.withColumns({c: F.col(c).cast("long") for c in BASE})
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return counted.withColumn("base_failed", failed)


def _cells(table: DataFrame, lang_col: str, source_col: str) -> DataFrame:
    """Adds ``cell``: language ``l`` and source ``s``. No source's name is empty: that stands for the whole language."""
    name = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null"))
    return table.withColumn("cell", F.struct(name(lang_col).alias("l"), name(source_col).alias("s")))


def _of_language(by_cell: DataFrame, columns: list[str]) -> DataFrame:
    """Adds to each cell the ``columns`` of its language, named ``of_*``."""
    whole = by_cell.where("cell.s = ''").select(F.col("cell.l").alias("l"), *[F.col(c).alias(f"of_{c}") for c in columns])
    return by_cell.withColumn("l", F.col("cell.l")).join(whole, "l").drop("l")


def _salted_join(rows: DataFrame, small: DataFrame, keys: list[str], salts: int) -> DataFrame:
    """Inner join in which the rows of one key go to several tasks; ``small`` has few rows for each key."""
    salted = small.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return rows.withColumn("salt", F.pmod("spread", F.lit(salts)).cast("int")).join(salted, [*keys, "salt"]).drop("salt")


def _salts(cells: DataFrame) -> int:
    """Tasks that the rows of a cell are dealt to: as many as a shuffle has, if there are not very many cells."""
    partitions = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(partitions, COPIES // max(1, cells.count())))


def _quantiles(rows: DataFrame, groups: list[str], value: Column, number: Column, shares: list[float]) -> DataFrame:
    """``groups`` and ``values``: for each share the largest value of the class up to which so many rows lie.

    ``number`` is the number of a value's class and rises with it.
    """
    counts = rows.groupBy(*groups, number.cast("long").alias("class")).agg(F.count("*").alias("n"), F.max(value).alias("top"))
    upto = F.sum("n").over(Window.partitionBy(*groups).orderBy("class"))
    total = F.sum("n").over(Window.partitionBy(*groups))
    placed = counts.select(*groups, "class", "top", upto.alias("upto"), total.alias("total"))
    found = [F.min(F.when(F.col("upto") >= s * F.col("total"), F.struct("class", "top")))["top"] for s in shares]
    return placed.groupBy(*groups).agg(F.array(*found).alias("values"))


def _by_class(value: Column) -> Column:
    return F.floor(value / CLASS)


def _estimates(rows: DataFrame, groups: list[str]) -> DataFrame:
    """Mean and covariance of the parts for each group, as columns ``m_*`` and ``c_*_*``, and the number of ``rows``."""
    parts = list(PARTS)
    means = [F.avg(p).alias(f"m_{p}") for p in parts]
    covs = [F.covar_pop(p, q).alias(f"c_{p}_{q}") for i, p in enumerate(parts) for q in parts[: i + 1]]
    return rows.groupBy(*groups).agg(*means, *covs, F.count("*").alias("rows"))


def _factored(estimates: DataFrame, scale: float) -> DataFrame:
    """Scales the covariance and adds ``f_*_*``, its Cholesky factor with the floors added to the diagonal, and the
    logarithm of the determinant, ``log_det``."""
    parts = list(PARTS)
    out = estimates.withColumns({c: scale * F.col(c) for c in estimates.columns if c.startswith("c_")})
    for i, p in enumerate(parts):
        for j, q in enumerate(parts[: i + 1]):
            entry = F.col(f"c_{p}_{q}")
            rest = entry - sum((F.col(f"f_{p}_{r}") * F.col(f"f_{q}_{r}") for r in parts[:j]), F.lit(0.0))
            if i == j:
                # The floor bounds the pivot too: rounding can't make it negative.
                value = F.sqrt(F.greatest(rest, F.lit(0.0)) + PARTS[p] ** 2)
            else:
                value = rest / F.col(f"f_{q}_{q}")
            out = out.withColumn(f"f_{p}_{q}", value)
    return out.withColumn("log_det", 2 * sum((F.ln(f"f_{p}_{p}") for p in parts), F.lit(0.0)))


def _distance(rows: DataFrame, factors: DataFrame, salts: int, *more: str) -> DataFrame:
    """Adds ``d2``, the squared Mahalanobis distance from the cell's centre, and the columns ``more`` of ``factors``."""
    parts = list(PARTS)
    used = [c for c in factors.columns if c[:2] in ("m_", "f_")]
    out = _salted_join(rows, factors.select("cell", *used, *more), ["cell"], salts)
    for i, p in enumerate(parts):
        rest = F.col(p) - F.col(f"m_{p}") - sum((F.col(f"f_{p}_{q}") * F.col(f"z_{q}") for q in parts[:i]), F.lit(0.0))
        out = out.withColumn(f"z_{p}", rest / F.col(f"f_{p}_{p}"))
    squares = sum((F.col(f"z_{p}") * F.col(f"z_{p}") for p in parts), F.lit(0.0))
    return out.withColumn("d2", squares).select(*rows.columns, "d2", *more)


def _starts(table: DataFrame, salts: int) -> DataFrame:
    """A centre and a covariance for each ``cell`` and ``start``.

    All three have the median as centre and half of what lies between the 16th and 84th percent as spreads. They differ in
    the correlations: none; those of the deviations bounded by a hyperbolic tangent; those of their directions.
    """
    parts = list(PARTS)
    long = table.select("cell", F.explode(F.create_map(*[x for p in parts for x in (F.lit(p), F.col(p))])).alias("part", "x"))
    found = _quantiles(long, ["cell", "part"], F.col("x"), _by_class(F.col("x")), [0.16, 0.5, 0.84])
    of = lambda p, i: F.max(F.when(F.col("part") == p, F.col("values")[i]))
    centres = [of(p, 1).alias(f"m_{p}") for p in parts]
    spreads = [((of(p, 2) - of(p, 0)) / 2).alias(f"s_{p}") for p in parts]
    places = stage(found.groupBy("cell").agg(*centres, *spreads), "quality-places")
    z = {p: (F.col(p) - F.col(f"m_{p}")) / F.sqrt(F.col(f"s_{p}") * F.col(f"s_{p}") + PARTS[p] ** 2) for p in parts}
    shaped = _salted_join(table, places, ["cell"], salts).select("cell", *[z[p].alias(f"z_{p}") for p in parts])
    norm = F.sqrt(sum((F.col(f"z_{p}") * F.col(f"z_{p}") for p in parts), F.lit(0.0)))
    shaped = shaped.withColumn("norm", norm)
    ways = {"bounded": lambda p: F.tanh(f"z_{p}"), "signs": lambda p: F.when(F.col("norm") > 0, F.col(f"z_{p}") / F.col("norm")).otherwise(0.0)}
    pairs = [(p, q) for i, p in enumerate(parts) for q in parts[: i + 1]]
    covs = [F.covar_pop(way(p), way(q)).alias(f"{name}_{p}_{q}") for name, way in ways.items() for p, q in pairs]
    shapes = places.join(shaped.groupBy("cell").agg(*covs), "cell")
    starts = []
    for number, name in enumerate(STARTS):
        columns = [F.col(f"m_{p}") for p in parts]
        for p, q in pairs:
            spread = F.col(f"s_{p}") * F.col(f"s_{q}")
            if p != q:
                both = F.sqrt(F.col(f"{name}_{p}_{p}") * F.col(f"{name}_{q}_{q}")) if name in ways else None
                spread = spread * (F.coalesce(F.try_divide(F.col(f"{name}_{p}_{q}"), both), F.lit(0.0)) if name in ways else 0.0)
            columns.append(spread.alias(f"c_{p}_{q}"))
        starts.append(F.struct(F.lit(number).alias("start"), *columns))
    return shapes.select("cell", F.explode(F.array(*starts)).alias("x")).select("cell", "x.*")


def concentrated(table: DataFrame, salts: int) -> DataFrame:
    """Ends of the concentration steps for each ``cell`` and ``start``: estimates, factors, ``log_det`` and ``steps``.

    The covariance is that of the nearest rows, scaled to what it is for all, with the floors added; the steps go by the
    determinant of this. A step takes the rows up to the class in which the share of :data:`SHARE` is reached. A start
    ends with the step that does not lower its determinant; that step's estimate does not count.
    """
    groups = ["cell", "start"]
    pairs = [f"{p}_{q}" for i, p in enumerate(PARTS) for q in list(PARTS)[: i + 1]]
    moments = [*[f"m_{p}" for p in PARTS], *[f"c_{x}" for x in pairs], *[f"f_{x}" for x in pairs]]
    first = _factored(_starts(table, salts), 1.0).withColumns({"rows": F.lit(0).cast("long"), "steps": F.lit(0), "open": F.lit(True)})
    state = stage(first.select(*groups, *moments, "log_det", "rows", "steps", "open"), "quality-starts")
    for step in range(1, MOST_STEPS + 1):
        near = _distance(table, state.where("open"), salts, "start")
        number = F.floor(F.log2(F.greatest("d2", F.lit(1e-12))) * 64)
        reach = _quantiles(near, groups, F.col("d2"), number, [SHARE]).select(*groups, F.col("values")[0].alias("reach"))
        half = _salted_join(near, reach, groups, salts).where("d2 <= reach")
        new = _factored(_estimates(half, groups), CONSISTENCY)
        renamed = new.select(*groups, F.struct(*moments, "log_det", "rows").alias("new"))
        both = state.join(renamed, groups, "left")
        # The starts themselves are not estimates by the nearest rows: the first step always counts.
        better = F.coalesce(F.col("new.log_det") < F.col("log_det") - 1e-9, F.lit(False)) | ((F.col("steps") == 0) & F.col("new").isNotNull())
        fields = [F.when(better, F.col(f"new.{c}")).otherwise(F.col(c)).alias(c) for c in (*moments, "log_det", "rows")]
        state = stage(both.select(*groups, *fields, F.when(better, step).otherwise(F.col("steps")).alias("steps"), (F.col("open") & better).alias("open")), "quality-step")
        if state.where("open").isEmpty():
            break
    return state


def robust_estimates(table: DataFrame) -> DataFrame:
    """Centre, covariance and factor for each ``cell`` of rows with a spreading number ``spread`` and :data:`PARTS`."""
    salts = _salts(table.select("cell").distinct())
    ends = concentrated(table, salts)
    rest = [c for c in ends.columns if c not in ("cell", "open")]
    least = ends.groupBy("cell").agg(F.min_by(F.struct(*rest), F.struct("log_det", "start")).alias("x")).select("cell", "x.*")
    factors = stage(least.drop("start", "steps"), "quality-least")
    inside = _distance(table, factors, salts).where(F.col("d2") <= REWEIGHT)
    # A cell whose rows all lie outside keeps the estimate it has.
    last = _factored(_estimates(inside, ["cell"]), 1.0)
    return stage(last.unionByName(factors.join(last, "cell", "left_anti").select(*last.columns)), "quality-final")


def robust_outliers(table: DataFrame) -> DataFrame:
    """Adds ``d2`` to such rows."""
    estimates = robust_estimates(table)
    return _distance(table, estimates, _salts(estimates))


def _drawn(estimates: DataFrame, shifts: DataFrame) -> DataFrame:
    """Estimates of the cells, drawn towards their language's as if that stood for :data:`PRIOR_ROWS` rows.

    That a source's few rows lie apart does not widen its covariance: two odd rows of four would excuse each other.
    ``of_rows`` is the number of rows behind the language's estimate. ``shift`` is where the language's centre of
    lengths lies as the cell counts them.
    """
    parts = list(PARTS)
    moments = [c for c in estimates.columns if c[:2] in ("m_", "c_")]
    both = _of_language(estimates, [*moments, "rows"]).where("cell.s <> ''").join(shifts.select("cell", "shift"), "cell")
    own = F.col("rows") / (F.col("rows") + PRIOR_ROWS)
    theirs = {p: F.col(f"of_m_{p}") + (F.col("shift") if p == "length" else F.lit(0.0)) for p in parts}
    out = [(own * F.col(f"m_{p}") + (1 - own) * theirs[p]).alias(f"m_{p}") for p in parts]
    for i, p in enumerate(parts):
        for q in parts[: i + 1]:
            c = f"c_{p}_{q}"
            out.append((own * F.col(c) + (1 - own) * F.col(f"of_{c}")).alias(c))
    return stage(_factored(both.select("cell", *out, "of_rows"), 1.0), "quality-drawn")


def _kept(d2: Column, rows: Column) -> Column:
    """Whether a normal vector lies beyond ``d2`` at least as often as beyond :data:`CUT` when all is known.

    The distance from an estimate by ``rows`` rows follows Hotelling's law: that of F with 4 and ``rows`` - 4 degrees
    of freedom, whose tail has a closed form. The fewer the rows, the farther it reaches; four or fewer reject nothing.
    """
    n = rows.cast("double")
    half = F.greatest(n - 4, F.lit(0.0)) / 2
    y = 1 / (1 + d2 * n / F.greatest(n * n - 1, F.lit(1.0)))
    return half * F.ln(y) + F.log1p(half * (1 - y)) >= math.log1p(CUT / 2) - CUT / 2


def judge(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source"
) -> DataFrame:
    """One row per document: its id, the statistics of :data:`BASE`, ``base_failed``, ``d2``, ``kept``, ``row_hash``.

    ``base_failed``: fewer than 20 words, or more than 30 % of the words in repeated windows; such rows take no part
    in the estimates and have no ``d2``. NULL language or source is a group of its own. A language of few rows
    rejects nothing beyond the base limits. Repeated rows are judged alike; so are rows with a NULL id. An empty table gives an empty table. ``row_hash`` hashes id and text.
    """
    inner = docs.select(
        F.col(id_col).alias("id"),
        F.col(lang_col).alias("lang"),
        F.col(source_col).alias("source"),
        F.xxhash64(id_col, text_col).alias("row_hash"),
        F.col(text_col).alias("text"),
    )
    table = stage(base_statistics(inner), "quality-statistics")
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    good = table.where(~F.col("base_failed")).withColumn("spread", F.xxhash64("row_hash", "id"))
    good = stage(_cells(good, "lang", "source"), "quality-rows")
    views = good.withColumn("cell", F.explode(F.array("cell", F.struct(F.col("cell.l").alias("l"), F.lit("").alias("s")))))
    # The mean word length of a short text scatters more; it is drawn towards the cell's centre accordingly.
    log_length = F.ln(F.greatest(F.col("word_chars"), F.lit(1)) / n)
    half = _quantiles(views, ["cell"], log_length, _by_class(log_length), [0.5])
    sizes = views.groupBy("cell").agg(F.count("*").alias("rows"))
    middles = stage(half.join(sizes, "cell").select("cell", F.col("values")[0].alias("middle"), "rows"), "quality-middle")
    total = F.col("rows") + PRIOR_ROWS
    centre = (F.col("rows") * F.col("middle") + PRIOR_ROWS * F.col("of_middle")) / total
    centres = _of_language(middles, ["middle"]).select("cell", centre.alias("centre"), (F.col("of_middle") - centre).alias("shift"))
    centres = stage(centres, "quality-centre")
    salts = _salts(centres)
    vectors = _salted_join(views, centres.drop("shift"), ["cell"], salts).withColumns(
        {
            "length": (log_length - F.col("centre")) * F.sqrt(n / (n + 60)),
            "symbols": F.log1p(F.col("n_symbols") / n),
            "lines": F.log1p(F.col("n_dup_lines") * 10 / n) * F.sqrt(n / (n + 60)),
            "repeats": F.col("n_repeat_words") / n,
        }
    )
    vectors = stage(vectors.drop("centre"), "quality-vectors")
    drawn = _drawn(robust_estimates(vectors), centres)
    judged = _distance(vectors.where("cell.s <> ''"), drawn, salts, "of_rows")
    judged = judged.select(*table.columns, "d2", _kept(F.col("d2"), F.col("of_rows")).alias("kept"))
    failed = table.where("base_failed").withColumns({"d2": F.lit(None).cast("double"), "kept": F.lit(False)})
    return judged.unionByName(failed).withColumnRenamed("id", id_col).drop("lang", "source")


def keep_good(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source"
) -> DataFrame:
    """The rows of ``docs`` that :func:`judge` keeps, unchanged."""
    return matching(docs, judge(docs, id_col, text_col, lang_col, source_col).where("kept"), id_col, text_col)
