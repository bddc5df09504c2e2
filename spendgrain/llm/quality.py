"""Quality rules: robust multivariate outliers among documents of one language and source.

Each text is described by five transformed statistics. Per language and source, the minimum covariance
determinant estimate is searched by concentration steps from two starts, the medians and quartile ranges of the group and
those of its language: the three quarters of the documents nearest to the centre give the next centre and covariance, a fixed
number of times, and the estimate with the smaller determinant counts. Few documents say little about their group, so an
estimate leans on the language's, the less the more documents there are; groups of all sizes are judged by one rule.
A document whose squared Mahalanobis distance exceeds the cutoff is rejected.

A step adds up counts, sums and products at (language, source, distance bin), which combine before the
shuffle, so no group meets in one task and results don't depend on partitioning.

Defined results: NULL and empty texts have no words and fail the base rule. NULL languages and sources are
groups of their own. A language with one document has no outlier. A very long text is one row. Repeated rows are judged alike and all stay. An empty table gives no rows. Other columns are not
looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spendgrain.llm.common import WORD, cut, n_words

SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5
#: Number of statistics.
P = 5
#: Share of a group that an estimate rests on, and the factor that makes its covariance that of the
#: whole under a normal distribution: 0.75 / F(chi2_7, q) where q is the 0.75 quantile of chi2_5.
HALF, FACTOR = 0.75, 1.41
#: Variances that are added, so that statistics which most documents share exactly stay comparable.
FLOORS = (0.1, 0.05, 0.1, 0.1, 0.1)
#: Documents like those of its language that each group is taken to have besides its own.
PRIOR = 10
#: Squared deviations that are too many: the quantile of chi-square with five degrees that 1.4 in 10**9 exceed.
CUTOFF = 50.0


def _bound(value: Column, use) -> Column:
    """use(value) with the value worked out once per row."""
    return F.transform(F.array(value), use)[0]


def repeated_words(words: Column) -> Column:
    """Words inside windows of five words that occur twice or more in the text, the first included."""
    n = F.size(words) - (WINDOW - 1)
    hashes = F.when(n > 0, _bound(F.transform(words, lambda w: F.xxhash64(w)), lambda h: F.transform(
        F.sequence(F.lit(0), F.size(h) - WINDOW),
        lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)]),
    )))

    def covered(ordered: Column) -> Column:
        """ordered: (hash, place), sorted. Places whose neighbour has the same hash are of repeated windows."""
        def same(x: Column, i: Column) -> Column:
            before = F.coalesce(F.get(ordered, i - 1)["h"] == x["h"], F.lit(False))
            return before | F.coalesce(F.get(ordered, i + 1)["h"] == x["h"], F.lit(False))

        places = F.sort_array(F.transform(F.filter(ordered, same), lambda x: x["i"]))
        step = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("end"))
        return F.aggregate(places, step, lambda a, i: F.struct(
            (a["n"] + F.lit(WINDOW) - F.greatest(a["end"] - i, F.lit(0))).alias("n"), (i + WINDOW).alias("end")
        ))["n"]

    def count(h: Column) -> Column:
        placed = F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(
            _bound(F.sort_array(placed), covered)
        )

    return F.when(n > 0, _bound(hashes, count)).otherwise(F.lit(0).cast("long"))


def text_statistics(documents: DataFrame) -> DataFrame:
    """doc_id, lang, source, the counts of the contract, n_lines and base_failed."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))
    rows = documents.select(
        "doc_id", "lang", "source", text.alias("text"),
        F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "").alias("words"),
    )
    rows = rows.select(
        "doc_id", "lang", "source",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.regexp_replace("text", r"[\x20\x09-\x0D]+", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        _bound(lines, lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("d"))).alias("lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return rows.select(
        "doc_id", "lang", "source", "n_words", "word_chars", "n_symbols",
        (F.col("lines.n") - F.col("lines.d")).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        F.col("lines.n").cast("long").alias("n_lines"),
        failed.alias("base_failed"),
    )


def vector(rows: DataFrame) -> DataFrame:
    """Adds x0 to x4, rounded to 1/1024, so that medians need bounded memory."""
    words = F.greatest("n_words", F.lit(1))
    parts = [
        F.log1p("n_words"),
        F.log(F.greatest("word_chars", F.lit(1)) / words),
        F.sqrt(F.col("n_symbols") / F.greatest("word_chars", F.lit(1))),
        F.sqrt(F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1))),
        F.sqrt(F.col("n_repeat_words") / words),
    ]
    return rows.withColumns({f"x{i}": F.round(x * 1024) / 1024 for i, x in enumerate(parts)})


def _whitening(rows: DataFrame, covariance: dict[tuple[int, int], Column]) -> DataFrame:
    """group, m0.., w_i_j: the inverse of the covariance's Cholesky factor, and spread, the logarithm of its determinant; one row per group."""
    for (i, j), value in covariance.items():
        rows = rows.withColumn(f"c_{i}_{j}", value)
    c, low = (lambda i, j: F.col(f"c_{max(i, j)}_{min(i, j)}")), (lambda i, j: F.col(f"l_{i}_{j}"))
    for j in range(P):
        for i in range(j, P):
            rest = c(i, j)
            for k in range(j):
                rest = rest - low(i, k) * low(j, k)
            rows = rows.withColumn(f"l_{i}_{j}", F.sqrt(F.greatest(rest, F.lit(1e-9))) if i == j else rest / low(j, j))
    for j in range(P):
        for i in range(j, P):
            done = F.lit(1.0 if i == j else 0.0)
            for k in range(j, i):
                done = done - low(i, k) * F.col(f"w_{k}_{j}")
            rows = rows.withColumn(f"w_{i}_{j}", done / low(i, i))
    spread = F.lit(0.0)
    for j in range(P):
        spread = spread + F.log(low(j, j))
    rows = rows.withColumn("spread", spread)
    keep = ["spread"] + [f"m{i}" for i in range(P)] + [f"w_{i}_{j}" for i in range(P) for j in range(i + 1)]
    return rows.select("n", F.col("lang").alias("g_lang"), F.col("source").alias("g_source"), *keep)


def start(rows: DataFrame, by_language: bool = False) -> DataFrame:
    """Medians, and quartile ranges as if normal, without correlation; of each group, or for each group those of its language."""
    groups = rows.groupBy("lang", "source").agg(F.count("*").alias("n"))
    quarters = [F.percentile(f"x{i}", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias(f"q{i}") for i in range(P)]
    if by_language:
        quartiles = rows.groupBy(F.col("lang").alias("of_lang")).agg(*quarters)
        quartiles = groups.join(quartiles, F.col("lang").eqNullSafe(F.col("of_lang")))
    else:
        quartiles = rows.groupBy("lang", "source").agg(F.count("*").alias("n"), *quarters)
    quartiles = quartiles.withColumns({f"m{i}": F.col(f"q{i}")[1] for i in range(P)})
    zero = F.lit(0.0)
    spread = {i: F.pow((F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349, F.lit(2)) + F.lit(FLOORS[i] ** 2) for i in range(P)}
    return _whitening(quartiles, {(i, j): spread[i] if i == j else zero for i in range(P) for j in range(i + 1)})


def with_distance(rows: DataFrame, estimate: DataFrame) -> DataFrame:
    """Adds d2, the squared Mahalanobis distance to the row's group."""
    same = F.col("lang").eqNullSafe(F.col("g_lang")) & F.col("source").eqNullSafe(F.col("g_source"))
    joined = rows.join(estimate, same, "left")
    d2 = F.lit(0.0)
    for i in range(P):
        z = F.lit(0.0)
        for j in range(i + 1):
            z = z + F.col(f"w_{i}_{j}") * (F.col(f"x{j}") - F.col(f"m{j}"))
        d2 = d2 + z * z
    return joined.select(*rows.columns, F.col("n").alias("group_n"), d2.alias("d2"))


def concentrate(rows: DataFrame, estimate: DataFrame) -> DataFrame:
    """The next estimate, from the HALF of each group that is nearest to the centre, up to one bin."""
    bin = F.floor(F.log1p("d2") * 64)
    sums = [F.sum(f"x{i}").alias(f"s{i}") for i in range(P)]
    products = [F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"p_{i}_{j}") for i in range(P) for j in range(i + 1)]
    binned = with_distance(rows, estimate).groupBy("lang", "source", bin.alias("bin")).agg(F.count("*").alias("k"), *sums, *products)
    group = Window.partitionBy("lang", "source")
    nearer = group.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    binned = binned.withColumn("nearer", F.coalesce(F.sum("k").over(nearer), F.lit(0))).withColumn("n", F.sum("k").over(group))
    near = binned.where(F.col("nearer") < F.col("n") * HALF).groupBy("lang", "source", "n").agg(
        F.sum("k").alias("h"),
        *[F.sum(f"s{i}").alias(f"s{i}") for i in range(P)],
        *[F.sum(f"p_{i}_{j}").alias(f"p_{i}_{j}") for i in range(P) for j in range(i + 1)],
    )
    return _whitening(*_shrunk(near))


def _shrunk(near: DataFrame) -> tuple[DataFrame, dict[tuple[int, int], Column]]:
    """near: h, s_i, p_i_j, the sums over the nearest documents of each group. Means and covariances to which the language adds PRIOR
    documents like its own, and a group's own count by the square of h / (h + PRIOR) each: a group of few documents is judged by its
    language, a large one by itself, and none by what is only its own outlier; for its language it counts by h / (h + PRIOR)."""
    names = ["h", *[f"s{i}" for i in range(P)], *[f"p_{i}_{j}" for i in range(P) for j in range(i + 1)]]
    trust = F.col("h") / (F.col("h") + PRIOR)
    language = near.groupBy(F.col("lang").alias("of_lang")).agg(*[F.sum(trust * F.col(c)).alias(f"all_{c}") for c in names])
    both = near.join(language, F.col("lang").eqNullSafe(F.col("of_lang")))
    share = trust * trust
    weight = share * F.col("h") + PRIOR

    def mixed(name: str) -> Column:
        return (share * F.col(name) + PRIOR * F.col(f"all_{name}") / F.col("all_h")) / weight

    both = both.withColumns({f"m{i}": mixed(f"s{i}") for i in range(P)})
    return both, {
        (i, j): FACTOR * (mixed(f"p_{i}_{j}") - F.col(f"m{i}") * F.col(f"m{j}")) + (FLOORS[i] ** 2 if i == j else 0.0)
        for i in range(P) for j in range(i + 1)
    }


def least_spread(rows: DataFrame, steps: int) -> DataFrame:
    """For each group the estimate of smallest determinant of those that concentration leads to from both starts."""
    found = None
    for by_language in (False, True):
        estimate = cut(start(rows, by_language))
        for _ in range(steps):
            estimate = cut(concentrate(rows, estimate))
        estimate = estimate.withColumn("origin", F.lit(int(by_language)))
        found = estimate if found is None else found.unionByName(estimate)
    whole = F.struct("spread", "origin", *[c for c in found.columns if c not in ("spread", "origin", "g_lang", "g_source")])
    return cut(found.groupBy("g_lang", "g_source").agg(F.min(whole).alias("e")).select("g_lang", "g_source", "e.*"))


def judge(documents: DataFrame, steps: int = 4, cutoff: float = CUTOFF) -> DataFrame:
    """Returns doc_id, the counts, base_failed, distance (squared; NULL where the base rule failed)
    and kept. cutoff is in squared deviations, a chi-square quantile with five degrees for documents that are normal."""
    rows = cut(vector(text_statistics(documents)))
    estimate = least_spread(rows.where("NOT base_failed"), steps)
    far = F.col("d2") > cutoff
    judged = with_distance(rows, estimate)
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & ~F.coalesce(far, F.lit(False))).alias("kept"),
        F.when(~F.col("base_failed"), F.round("d2", 4)).alias("distance"),
        "lang", "source",
    )
