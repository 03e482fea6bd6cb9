"""Quality rules as robust multivariate outliers, per language and source.

DataFrame functions only. Statistics of each text become a vector of transformed
shares; a minimum-covariance-determinant (MCD) estimate of every group gives centre
and scatter that junk does not pull, and a text whose Mahalanobis distance is far
beyond the bulk of its group is rejected.

The estimate starts from medians and quartiles and takes concentration steps (the
heart of FAST-MCD): distances of all rows, the nearest share of them, their mean and
covariance. Sums are exact integers and the nearest share is cut at a cell of a
histogram of distances, so results do not depend on how rows are dealt. All documents
take part in every step; a group is a row of parameters, not a task.
"""

from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipyard.functions.columns import bind, with_once
from clipyard.session import materialize

SPACE = " \t\n\x0b\x0c\r"
MIN_WORDS = 50
MAX_REPEAT = 50  # hundredths of the words

#: Vector of a text, from its statistics.
FEATURES = ("word_length", "symbols", "capitals", "repeats", "dup_lines")
P = len(FEATURES)
#: Vectors are kept as integers of this many steps a unit.
SCALE = 4096
#: Share of a group that the estimate rests on, and the chi-square quantile of it (5 degrees).
NEAR, NEAR_CHI2 = 0.75, 6.6257
#: Smallest standard deviation of each feature: values this close are no difference. A
#: repeated line or phrase is common in clean text, so those two are held loosely.
FLOORS = {"word_length": 0.05, "symbols": 0.03, "capitals": 0.05, "repeats": 0.3, "dup_lines": 0.3}
#: Features held so loosely in the joint distance that none can reject; each is also judged
#: alone, by the group's own spread with this smallest deviation and chi-square 0.999 (1 degree).
ALONE = {"repeats": 0.2, "dup_lines": 0.2}
ALONE_CUTOFF = 10.828
STEPS = 6
#: Squared distance beyond which a text is rejected: a bulk with long tails stays inside.
CUTOFF = 200.0
#: The same before the scaling of ``fit``: chi-square 0.999 (20.515, 5 degrees) over the share
#: 0.707 of its variance that the nearest NEAR of a normal group has. Where most rows are copies
#: the scale has no bound; texts this close by FLOORS alone stay.
FLOOR_CUTOFF = 29.0
#: Rows a group needs for an estimate of its own; smaller groups of a language are pooled,
#: and languages that are still too small once more. A pool under MIN_FIT rejects nothing.
MIN_GROUP = 200
MIN_FIT = 4 * (P + 1)
_CELLS = 16  # histogram cells per doubling of the squared distance


def words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, r"[\x20\x09-\x0D]+")
    )


def repeated_words(tokens: Column) -> Column:
    """Words in runs of three that are found twice or more, the first ones included."""

    def count(runs):
        def covered(ordered):
            twice = F.filter(
                ordered,
                lambda e, k: (e["g"] == F.get(ordered, k + 1)["g"])
                | ((k > 0) & (e["g"] == F.get(ordered, F.greatest(k - 1, F.lit(0)))["g"])),
            )
            places = F.transform(twice, lambda e: F.array(e["i"], e["i"] + 1, e["i"] + 2))
            return F.size(F.array_distinct(F.flatten(places)))

        placed = F.transform(runs, lambda g, i: F.struct(g.alias("g"), i.alias("i")))
        return F.when(F.size(F.array_distinct(runs)) == F.size(runs), 0).otherwise(
            bind(F.sort_array(placed), covered)
        )

    def build(t):
        runs = F.transform(
            F.sequence(F.lit(0), F.size(t) - 3), lambda i: F.xxhash64(F.get(t, i), F.get(t, i + 1), F.get(t, i + 2))
        )
        return F.when(F.size(t) < 4, 0).otherwise(bind(runs, count))

    return bind(tokens, build)


def with_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_lines, n_capitals, base_failed``; columns of these names are replaced."""
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "base_failed")
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    cut = with_once(docs.drop(*names), _w=words(text), _l=lines)
    counted = with_once(
        cut,
        n_words=F.size("_w").cast("bigint"),
        word_chars=F.length(F.array_join("_w", "")).cast("bigint"),
        n_symbols=F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("bigint"),
        n_dup_lines=(F.size("_l") - F.size(F.array_distinct("_l"))).cast("bigint"),
        n_repeat_words=repeated_words(F.col("_w")).cast("bigint"),
        n_lines=F.size("_l").cast("bigint"),
        n_capitals=F.length(F.regexp_replace(text, r"\P{Lu}+", "")).cast("bigint"),
    ).drop("_w", "_l")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))
    return counted.withColumn("base_failed", failed)


def _features() -> dict[str, Column]:
    """Transformed shares, as integers: a logarithm and square roots even out the spread."""

    def share(part, whole):
        return F.sqrt(F.col(part) / F.greatest(F.col(whole), F.lit(1)))

    values = {
        "word_length": F.log(F.greatest(F.col("word_chars"), F.lit(1)) / F.greatest(F.col("n_words"), F.lit(1))),
        "symbols": share("n_symbols", "word_chars"),
        "capitals": share("n_capitals", "word_chars"),
        "repeats": share("n_repeat_words", "n_words"),
        "dup_lines": share("n_dup_lines", "n_lines"),
    }
    return {name: F.round(values[name] * SCALE).cast("bigint") for name in FEATURES}


def with_group(stats: DataFrame, lang_col: str, source_col: str) -> DataFrame:
    """Adds ``_lang, _source``, the group whose estimate a row is held against.

    Counted over all rows that pass the base rules. A pool is written as ``*``.
    """
    rows = stats.withColumns(
        {"_lang": F.coalesce(lang_col, F.lit("")), "_source": F.coalesce(source_col, F.lit(""))}
    )
    sizes = rows.filter("not base_failed").groupBy("_lang", "_source").count()
    own = F.when(F.col("count") >= MIN_GROUP, F.col("_source")).otherwise(F.lit("*"))
    pooled = sizes.withColumn("_pool", own)
    of_pool = pooled.groupBy("_lang", "_pool").agg(F.sum("count").alias("_n"))
    named = pooled.join(of_pool, ["_lang", "_pool"]).select(
        "_lang",
        "_source",
        F.when(F.col("_n") >= MIN_GROUP, F.col("_lang")).otherwise(F.lit("*")).alias("_to_lang"),
        "_pool",
    )
    named = materialize(named, "outlier_groups")
    return (
        rows.join(named, ["_lang", "_source"], "left")
        .withColumns({"_lang": F.coalesce("_to_lang", F.lit("*")), "_source": F.coalesce("_pool", F.lit("*"))})
        .drop("_to_lang", "_pool")
    )


_KEY = ["_lang", "_source"]
_PAIRS = list(combinations_with_replacement(range(P), 2))


def _distance() -> Column:
    """Squared distance from the row's features and the parameters ``m_i``, ``w_i_j``."""
    total = F.lit(0.0)
    for i in range(P):
        z = sum(
            (F.col(f"w_{i}_{j}") * (F.col(FEATURES[j]) / SCALE - F.col(f"m_{j}")) for j in range(i + 1)), F.lit(0.0)
        )
        total = total + z * z
    return total


def _start(rows: DataFrame) -> DataFrame:
    """Medians and quartile ranges of each group as first centre and scatter."""
    quartiles = rows.groupBy(*_KEY).agg(
        F.sum("copies").alias("n"),
        *[F.percentile(name, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias(name) for name in FEATURES],
    )
    columns = [*_KEY, "n"]
    for i, name in enumerate(FEATURES):
        q = [F.get(name, F.lit(k)) / SCALE for k in range(3)]
        spread = F.greatest((q[2] - q[0]) / 1.349, F.lit(FLOORS[name]))
        columns.append(q[1].alias(f"m_{i}"))
        columns += [(1 / spread if i == j else F.lit(0.0)).alias(f"w_{i}_{j}") for j in range(i + 1)]
        columns += [F.pow((q[2] - q[0]) / 1.349, F.lit(2)).alias(f"v_{i}")] if name in ALONE else []
    return quartiles.select(*columns)


def _near_cell(measured: DataFrame) -> DataFrame:
    """Per group the histogram cell of the distance up to which NEAR of its rows lie."""
    from pyspark.sql import Window

    cells = measured.groupBy(*_KEY, "_cell").count()
    upto = Window.partitionBy(*_KEY).orderBy("_cell")
    whole = Window.partitionBy(*_KEY)
    run = cells.withColumns({"_upto": F.sum("count").over(upto), "_all": F.sum("count").over(whole)})
    return run.filter(F.col("_upto") >= F.lit(NEAR) * F.col("_all")).groupBy(*_KEY).agg(F.min("_cell").alias("_cut"))


def _estimate(near: DataFrame) -> DataFrame:
    """Mean and inverse Cholesky factor of each group's nearest rows."""
    sums = [F.count(F.lit(1)).alias("k")]
    sums += [F.sum(FEATURES[i]).alias(f"s_{i}") for i in range(P)]
    sums += [F.sum(F.col(FEATURES[i]) * F.col(FEATURES[j])).alias(f"s_{i}_{j}") for i, j in _PAIRS]
    table = near.groupBy(*_KEY).agg(F.first("_cut").alias("_cut"), *sums)
    table = table.withColumns({f"m_{i}": F.col(f"s_{i}") / F.col("k") / SCALE for i in range(P)})
    spreads = [f"v_{i}" for i, name in enumerate(FEATURES) if name in ALONE]
    cov = {}
    for i, j in _PAIRS:
        c = F.col(f"s_{i}_{j}") / F.col("k") / SCALE / SCALE - F.col(f"m_{i}") * F.col(f"m_{j}")
        if i == j and FEATURES[i] in ALONE:
            cov[f"v_{i}"] = F.greatest(c, F.lit(0.0))
        cov[f"c_{j}_{i}"] = c + FLOORS[FEATURES[i]] ** 2 if i == j else c
    table = table.withColumns(cov)
    for i in range(P):  # Cholesky, a column at a time
        for j in range(i, P):
            rest = F.col(f"c_{j}_{i}") - sum((F.col(f"l_{j}_{k}") * F.col(f"l_{i}_{k}") for k in range(i)), F.lit(0.0))
            table = table.withColumn(f"l_{j}_{i}", F.sqrt(rest) if i == j else rest / F.col(f"l_{i}_{i}"))
    for j in range(P):  # inverse of the lower triangle, a column at a time
        for i in range(j, P):
            if i == j:
                value = 1 / F.col(f"l_{i}_{i}")
            else:
                value = -sum((F.col(f"l_{i}_{k}") * F.col(f"w_{k}_{j}") for k in range(j, i)), F.lit(0.0)) / F.col(f"l_{i}_{i}")
            table = table.withColumn(f"w_{i}_{j}", value)
    return table.select(*_KEY, "_cut", *[f"m_{i}" for i in range(P)], *[f"w_{i}_{j}" for i in range(P) for j in range(i + 1)], *spreads)


def _far_alone() -> Column:
    """Is a feature of ALONE far above the group's centre by itself?"""
    far = F.lit(False)
    for i, name in enumerate(FEATURES):
        if name in ALONE:
            above = F.greatest(F.col(name) / SCALE - F.col(f"m_{i}"), F.lit(0.0))
            far = far | (above * above > ALONE_CUTOFF * (F.col(f"v_{i}") + ALONE[name] ** 2))
    return far


def fit(rows: DataFrame, steps: int = STEPS) -> DataFrame:
    """Parameters per ``_lang, _source`` of ``rows`` (a stored table of features, one row a
    distinct text with its number of ``copies``): copies do not hide how other texts vary.

    The last row of numbers is scaled so that NEAR of the group lies within the
    chi-square quantile. Parameters are written after each step; their table is as
    small as the list of groups, and Spark joins it by that size.
    """
    spread = lambda table: F.floor(F.log2(_distance() + 1e-6) * _CELLS).cast("int")
    params = materialize(_start(rows), "outlier_start")
    counts = params.select(*_KEY, "n")
    for _ in range(steps):
        measured = rows.join(params, _KEY).withColumn("_cell", spread(rows)).select(*_KEY, *FEATURES, "_cell")
        cuts = materialize(_near_cell(measured), "outlier_cuts")
        near = measured.join(cuts, _KEY).filter("_cell <= _cut")
        params = materialize(_estimate(near), "outlier_step")
    measured = rows.join(params.drop("_cut"), _KEY).withColumn("_cell", spread(rows)).select(*_KEY, "_cell")
    scale = _near_cell(measured).select(*_KEY, (F.lit(NEAR_CHI2) / F.pow(F.lit(2.0), (F.col("_cut") + 1) / _CELLS)).alias("_scale"))
    return materialize(params.drop("_cut").join(scale, _KEY).join(counts, _KEY), "outlier_params")


def judge(
    docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
    carry: list[str] | None = None, steps: int = STEPS, cutoff: float = CUTOFF,
) -> DataFrame:
    """Statistics, ``base_failed``, ``distance`` and ``kept`` for every row of ``docs``.

    The columns ``carry`` of ``docs`` (all by default, the text included) come along.
    ``kept`` is false where the base rules fail (fewer than 50 words, or over half the
    words in repeated runs of three) and where the squared distance from the group's
    centre is over ``cutoff`` and, unscaled, over FLOOR_CUTOFF, or where repeated words or lines
    alone are far above the group's. Features that vary less
    than FLOORS count as equal, so neither a group of copies nor other texts beside
    them are a fault. A null text counts as empty, null languages and
    sources as empty strings. ``distance`` is null where the base rules fail and in
    pools too small to tell. An empty table gives no rows.
    """
    carry = list(docs.columns) if carry is None else carry
    needed = list(dict.fromkeys([*carry, lang_col, source_col, text_col]))
    stats = with_statistics(docs.select(*needed), text_col)
    keep = [*dict.fromkeys([c for c in carry if c in stats.columns]), *[c for c in (lang_col, source_col) if c not in carry]]
    extra = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "base_failed"]
    stats = materialize(stats.select(*[c for c in keep if c not in extra], *extra, F.xxhash64(text_col).alias("_text_key"), *[v.alias(f"_f_{n}") for n, v in _features().items()]), "statistics")
    grouped = with_group(stats, lang_col, source_col)
    features = [F.col(f"_f_{n}").alias(n) for n in FEATURES]
    rows = grouped.filter("not base_failed").select(*_KEY, "_text_key", *features)
    rows = rows.groupBy(*_KEY, "_text_key", *FEATURES).agg(F.count(F.lit(1)).alias("copies"))
    rows = materialize(rows.drop("_text_key"), "features")
    params = fit(rows, steps)
    judged = grouped.withColumns({n: F.col(f"_f_{n}") for n in FEATURES}).join(params, _KEY, "left")
    judged = with_once(judged, _floored=F.when(~F.col("base_failed") & (F.col("n") >= MIN_FIT), _distance()))
    result = judged.withColumn("distance", F.col("_floored") * F.col("_scale"))
    far = (F.col("distance") > cutoff) & (F.col("_floored") > FLOOR_CUTOFF)
    far = far | (F.col("_floored").isNotNull() & _far_alone())
    result = result.withColumn("kept", ~F.col("base_failed") & ~F.coalesce(far, F.lit(False)))
    return result.select(*[c for c in carry if c not in extra + ["distance", "kept"]], *extra, "distance", "kept")
