"""Quality rules: fixed limits, and robust outliers of each language and source.

A document's statistics are transformed to a vector. For each language and source the minimum
covariance determinant is estimated: starting from medians and median deviations, the part of the
documents nearest to the centre gives a new mean and covariance, again and again. A document far from
its group's centre by Mahalanobis distance is rejected. All of it is DataFrame work: quantiles are
exact over values on a grid, so a group's state stays small and the result never depends on how rows
are spread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockyard.llm.common import WHITE, stored

# Base limits.
LEAST_WORDS, MOST_REPEATED_PERCENT = 50, 50

# The part of a group that its estimate rests on, and how often it is chosen anew.
CORE, STEPS = 0.75, 3
# No direction of a group counts as narrower than this, in the units of the vector below.
LEAST_SPREAD = (0.12, 0.05, 0.2, 0.2)
# Squared distance beyond which a document is rejected (one in 10,000 of a normal group), and the
# median of the squared distance in a normal group, with four dimensions.
CUT, MIDDLE = 23.51, 3.3567
GRID = 256


def statistics(df: DataFrame, text: Column) -> DataFrame:
    """`df` with counts of `text`: n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words."""
    out = df.withColumn("text", F.coalesce(text, F.lit("")))
    out = out.withColumn("w", F.expr(f"filter(split(text, '{WHITE}'), w -> w != '')".replace("\\", "\\\\")))
    lines = r"filter(split(text, '\n'), l -> l rlike '[^\\x20\\x09-\\x0D]')"
    out = out.withColumn("lines", F.expr(lines)).withColumn("n_words", F.size("w").cast("long"))
    triples = "transform(slice(w, 1, greatest(size(w) - 2, 0)), (x, i) -> xxhash64(x, w[i + 1], w[i + 2]))"
    out = out.withColumn("h", F.expr(triples))
    out = out.withColumn(
        "s",
        F.expr(
            "case when size(array_distinct(h)) < size(h) "
            "then array_sort(transform(h, (x, i) -> struct(x as x, i as i))) end"
        ),
    )
    twice = "filter(s, (e, i) -> coalesce(e.x = get(s, i - 1).x, false) or coalesce(e.x = get(s, i + 1).x, false))"
    covered = f"size(array_distinct(flatten(transform({twice}, e -> array(e.i, e.i + 1, e.i + 2)))))"
    white = F.regexp_count("text", F.lit("[\\x20\\x09-\\x0D]"))
    return out.select(
        *df.columns,
        "n_words",
        (F.length("text") - white).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        F.expr("size(lines) - size(array_distinct(lines))").cast("long").alias("n_dup_lines"),
        F.expr(f"case when s is null then 0 else {covered} end").cast("long").alias("n_repeat_words"),
    )


def vector() -> list[Column]:
    """Word length, symbols, repeated lines and repeated words, each on a scale where spreads are alike."""
    def part(of: str, all_: str) -> Column:
        return F.sqrt(F.col(of) / F.greatest(F.col(all_), F.lit(1)))

    return [
        F.log((F.col("word_chars") + 1) / F.greatest(F.col("n_words"), F.lit(1))),
        part("n_symbols", "word_chars"),
        part("n_dup_lines", "n_lines"),
        part("n_repeat_words", "n_words"),
    ]


N = len(LEAST_SPREAD)
KEYS = ("lang", "source")


def _middle(values: Column, at: float = 0.5) -> Column:
    """An exact quantile over a grid of values."""
    return F.percentile(F.round(values * GRID), at) / GRID


def _joined(rows: DataFrame, groups: DataFrame) -> DataFrame:
    named = groups.select(*[F.col(k).alias(f"g_{k}") for k in KEYS], *[c for c in groups.columns if c not in KEYS])
    same = F.lit(True)
    for key in KEYS:
        same = same & F.col(key).eqNullSafe(F.col(f"g_{key}"))
    return rows.join(named, same).drop(*[f"g_{k}" for k in KEYS])


def _triangle(cov) -> list[list[Column]]:
    """The lower triangle L with L L' = the covariance."""
    low: list[list[Column]] = []
    for i in range(N):
        row: list[Column] = []
        for j in range(i + 1):
            rest = cov(i, j)
            for k in range(j):
                rest = rest - (low[j][k] if j < i else row[k]) * row[k]
            row.append(F.sqrt(F.greatest(rest, F.lit(1e-9))) if i == j else rest / low[j][j])
        low.append(row)
    return low


def _distance(rows: DataFrame) -> DataFrame:
    """`rows`, joined with their group's centre m0.. and triangle l00.., with the squared distance d2."""
    total = F.lit(0.0)
    for i in range(N):
        value = F.col(f"x{i}") - F.col(f"m{i}")
        for k in range(i):
            value = value - F.col(f"l{i}{k}") * F.col(f"z{k}")
        rows = rows.withColumn(f"z{i}", value / F.col(f"l{i}{i}"))
        total = total + F.col(f"z{i}") * F.col(f"z{i}")
    return rows.withColumn("d2", total).drop(*[f"z{i}" for i in range(N)])


def _estimate(rows: DataFrame) -> DataFrame:
    """Centre and triangle of each group, from `rows` with x0..x3."""
    middles = stored(rows.groupBy(*KEYS).agg(*[_middle(F.col(f"x{i}")).alias(f"m{i}") for i in range(N)]), "middles")
    away = [F.abs(F.col(f"x{i}") - F.col(f"m{i}")) for i in range(N)]
    spreads = _joined(rows, middles).groupBy(*KEYS).agg(
        *[F.first(f"m{i}").alias(f"m{i}") for i in range(N)],
        *[(_middle(away[i]) * 1.4826).alias(f"s{i}") for i in range(N)],
    )
    columns = [F.col(f"m{i}") for i in range(N)]
    for i in range(N):
        for j in range(i + 1):
            at = F.sqrt(F.col(f"s{i}") * F.col(f"s{i}") + LEAST_SPREAD[i] ** 2) if i == j else F.lit(0.0)
            columns.append(at.alias(f"l{i}{j}"))
    model = stored(spreads.select(*KEYS, *columns), "model")
    for _ in range(STEPS):
        measured = _distance(_joined(rows, model))
        # Whole steps of the logarithm keep the quantile's state small.
        step = F.floor(F.log1p("d2") * 64)
        limits = stored(measured.groupBy(*KEYS).agg(F.percentile(step, CORE).alias("limit")), "limits")
        core = _joined(measured.select(*KEYS, *[f"x{i}" for i in range(N)], step.alias("step")), limits)
        core = core.filter("step <= limit")
        # Sums in whole grid steps, so that their order does not matter.
        whole = [F.round(F.col(f"x{i}") * GRID).cast("long") for i in range(N)]
        sums = core.groupBy(*KEYS).agg(
            F.count("*").alias("n"),
            *[F.sum(whole[i]).alias(f"t{i}") for i in range(N)],
            *[F.sum(whole[i] * whole[j]).alias(f"t{i}{j}") for i in range(N) for j in range(i + 1)],
        )

        def cov(i: int, j: int) -> Column:
            product = F.col(f"t{i}{j}") / F.col("n") - F.col(f"t{i}") / F.col("n") * (F.col(f"t{j}") / F.col("n"))
            return product / (GRID * GRID) + (LEAST_SPREAD[i] ** 2 if i == j else 0.0)

        sums = sums.select(
            *KEYS,
            *[(F.col(f"t{i}") / F.col("n") / GRID).alias(f"m{i}") for i in range(N)],
            *[cov(i, j).alias(f"c{i}{j}") for i in range(N) for j in range(i + 1)],
        )
        low = _triangle(lambda i, j: F.col(f"c{i}{j}"))
        chosen = [low[i][j].alias(f"l{i}{j}") for i in range(N) for j in range(i + 1)]
        model = stored(sums.select(*KEYS, *[f"m{i}" for i in range(N)], *chosen), "model")
    # Groups wider than the core suggests have their distances scaled down; none are scaled up.
    measured = _distance(_joined(rows, model))
    scale = F.least(F.lit(1.0), F.lit(MIDDLE) / F.greatest(_middle(F.col("d2")), F.lit(1e-9)))
    return _joined(model, stored(measured.groupBy(*KEYS).agg(scale.alias("scale")), "scales"))


def judged(
    df: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
) -> DataFrame:
    """Every row of `df` as a struct `row`, with its statistics, `base_failed`, `distance` and `kept`.

    A null text is empty, fails the base rules and has distance null. A null language or source is one
    of its own. A group of one document, or of equal ones, has distance 0. Repeated rows count each.
    """
    row = F.struct(*[F.col(c) for c in df.columns])
    known = df.select(
        row.alias("row"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source"), F.col(text_col).alias("of")
    )
    counted = statistics(known, F.col("of")).drop("of")
    return _verdicts(counted)


def _verdicts(counted: DataFrame) -> DataFrame:
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    rows = stored(
        counted.withColumn("base_failed", failed).withColumns({f"x{i}": x for i, x in enumerate(vector())}), "statistics"
    )
    model = stored(_estimate(rows.filter("NOT base_failed").select(*KEYS, *[f"x{i}" for i in range(N)])), "estimate")
    good = _distance(_joined(rows.filter("NOT base_failed"), model))
    good = good.withColumn("distance", F.sqrt(F.col("d2") * F.col("scale")))
    good = good.withColumn("kept", F.col("distance") * F.col("distance") <= CUT)
    bad = rows.filter("base_failed").withColumn("distance", F.lit(None).cast("double")).withColumn("kept", F.lit(False))
    columns = [c for c in counted.columns if c not in KEYS] + ["base_failed", "distance", "kept"]
    return good.select(*columns).unionByName(bad.select(*columns))


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def quality(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **columns) -> DataFrame:
    """One row per document: its counts, `base_failed`, and `kept`."""
    others = {columns.get("lang_col", "lang"), columns.get("source_col", "source")}
    slim = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *sorted(others))
    known = slim.select(
        "doc_id",
        "text",
        F.col(columns.get("lang_col", "lang")).alias("lang"),
        F.col(columns.get("source_col", "source")).alias("source"),
    )
    counted = statistics(known.withColumnRenamed("text", "of"), F.col("of")).drop("of")
    return _verdicts(counted).select("doc_id", *COUNTS, "base_failed", "kept", "distance")


def good_documents(df: DataFrame, **columns) -> DataFrame:
    """The rows that stay, with all columns of `df`."""
    return judged(df, **columns).filter("kept").select("row.*")
