"""Quality rules whose cutoffs keep a guarantee on good documents.

Each rule rejects a document when a rate of its text exceeds a cutoff. The
cutoffs come from a fixed ladder, lax to strict. Labelled good documents of a
stratum (a language) decide how far down the rules may go, all rules together: a document goes if any
rule fires, so what is tested is the union.

A quarter of the labelled texts, the pilot, puts the steps of all ladders in one order, those first that reject
fewest good pilot texts. The rest tests them in this order: step t is taken if the exact binomial test,
P(at most k of n good texts rejected | rate ``rejected``) <= level, shows that the rules with all steps up
to t reject at most that share of good documents. The order does not depend on the texts tested and the tests end at
the first failure, so a stratum needs no correction for its many tests (fixed sequence); between strata the level is divided by
their number (Bonferroni). So with probability 1 - ``risk`` the rules reject at most ``rejected`` of the good
documents in every stratum. Copies of a text count once, as they are no independent trials. Too few labels: no step passes and the rules are off.

Everything is DataFrame expressions; hashes of eight-word windows are built by
doubling, so each word costs three hash steps, and windows are ranked only in texts that hold a repeat.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlight.llm.storage import Workspace

WHITE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

# Rates and their ladders of cutoffs, lax to strict.
LADDERS = {
    "symbol_rate": (1.0, 0.5, 0.3, 0.2, 0.15, 0.1, 0.07, 0.05, 0.03, 0.02, 0.01),
    "upper_rate": (0.8, 0.6, 0.5, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2),
    "exclaim_rate": (1.0, 0.5, 0.3, 0.2, 0.15, 0.1, 0.07, 0.05, 0.03, 0.02, 0.01),
    "dup_line_rate": (0.9, 0.7, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.05),
    "repeat_rate": (0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.07, 0.05, 0.02),
    "word_length": (20.0, 16.0, 14.0, 12.0, 11.0, 10.0, 9.5, 9.0, 8.5, 8.0, 7.5, 7.0),
}
PILOT = 4  # one text in so many puts the steps in order
TAIL_TERMS = 4096  # of a binomial sum; what lies below is bounded by a geometric series

FEATURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _own(name: str) -> str:
    return f"_quality_{name}"


def _removed(text: Column, characters: str) -> Column:
    return F.char_length(text) - F.char_length(F.translate(text, characters, ""))


def with_features(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds ``_quality_`` columns to every row: the five counts, the rates of LADDERS and a hash of the text."""
    text, words, n = F.col(_own("text")), F.col(_own("words")), F.col(_own("n_words"))
    trimmed = F.btrim(text, F.lit(WHITE))
    rows = docs.withColumn(_own("text"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    rows = rows.withColumn(
        _own("words"),
        F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+")),
    ).withColumn(_own("n_words"), F.size(words).cast("long"))
    rows = rows.withColumn(_own("h1"), F.when(n >= 8, F.transform(words, lambda w: F.xxhash64(w))))
    for name, half, step in (("h2", "h1", 1), ("h4", "h2", 2), ("h8", "h4", 4)):
        h = F.col(_own(half))
        kept = F.size(h) - step
        rows = rows.withColumn(
            _own(name), F.zip_with(F.slice(h, 1, kept), F.slice(h, step + 1, kept), lambda a, b: F.xxhash64(a, b))
        )
    hashes, ranked, repeats = F.col(_own("h8")), F.col(_own("ranked")), F.col(_own("repeats"))
    repeated = F.size(F.array_distinct(hashes)) < F.size(hashes)
    rows = rows.withColumn(
        _own("ranked"),
        F.when(repeated, F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))),
    ).withColumn(
        _own("repeats"),
        F.array_sort(
            F.transform(
                F.filter(
                    ranked,
                    lambda s, k: F.coalesce(F.get(ranked, k - 1)["h"] == s["h"], F.lit(False))
                    | F.coalesce(F.get(ranked, k + 1)["h"] == s["h"], F.lit(False)),
                ),
                lambda s: s["i"],
            )
        ),
    )
    covered = F.aggregate(
        F.transform(repeats, lambda p, k: F.least(F.lit(8), F.coalesce(F.get(repeats, k + 1) - p, F.lit(8)))),
        F.lit(0),
        lambda a, b: a + b,
    )
    lines = F.col(_own("lines"))
    rows = rows.withColumn(
        _own("lines"), F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(WHITE)) != "")
    )
    counts = {
        "word_chars": F.char_length(F.translate(text, WHITE, "")),
        "n_symbols": _removed(text, SYMBOLS),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": F.coalesce(covered, F.lit(0)),
    }
    rows = rows.withColumns({_own(k): c.cast("long") for k, c in counts.items()})

    def rate(part: Column, whole: Column) -> Column:
        return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))

    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    rates = {
        "symbol_rate": rate(F.col(_own("n_symbols")), n),
        "upper_rate": rate(_removed(text, letters), F.col(_own("word_chars"))),
        "exclaim_rate": rate(_removed(text, "!"), n),
        "dup_line_rate": rate(F.col(_own("n_dup_lines")), F.size(lines)),
        "repeat_rate": rate(F.col(_own("n_repeat_words")), n),
        "word_length": rate(F.col(_own("word_chars")), n),
    }
    rows = rows.withColumns({_own(k): c for k, c in rates.items()} | {_own("text_hash"): F.xxhash64(text)})
    return rows.drop(*(_own(k) for k in ("text", "words", "h1", "h2", "h4", "h8", "ranked", "repeats", "lines")))


def _log_factorial(n: Column) -> Column:
    """log n!, by Stirling's series at n + 10 and ten steps back; exact to double precision at any size."""
    x = n + 11.0
    series = (x - 0.5) * F.log(x) - x + 0.9189385332046727 + 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5)
    for i in range(1, 11):
        series = series - F.log(n + i)
    return series


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X ~ Bin(n, p), by summing terms downwards from k; above the mean it is taken as 1.

    Each term is less than the one before by a factor that falls, so what follows the last one that is
    summed is at most a geometric series, which is added: never too small, and exact to double precision in practice.
    """
    n, k = n.cast("double"), k.cast("double")
    q = 1.0 - p
    steps = F.sequence(F.lit(0), F.least(k, F.lit(float(TAIL_TERMS))).cast("int"))
    first = _log_factorial(n) - _log_factorial(k) - _log_factorial(n - k) + k * F.log(F.lit(p)) + (n - k) * F.log(F.lit(q))

    def factor(i: Column) -> Column:
        return (k - i) / (n - k + i + 1) * (q / p)

    # The factor is 0 after the term for no success at all.
    total = F.aggregate(
        steps,
        F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"), F.lit(0.0).alias("factor")),
        lambda s, i: F.struct(
            (s["term"] * factor(i)).alias("term"), (s["sum"] + s["term"] * factor(i)).alias("sum"), factor(i).alias("factor")
        ),
        lambda s: s["sum"] + s["term"] * s["factor"] / (1 - s["factor"]),
    )
    return F.when(k >= n * p, F.lit(1.0)).otherwise(F.least(F.exp(first) * total, F.lit(1.0)))


def _steps_taken(features: DataFrame, good: DataFrame, id_col: str, stratum_col: str, rejected: float, risk: float) -> DataFrame:
    """``(stratum, rule, step, position, n, k, taken)`` for every step of every stratum, in the order tested."""
    texts = features.select(F.col(id_col).alias("_id"), F.col(stratum_col).cast("string").alias("stratum"), F.col(_own("text_hash")).alias("hash"),
                            *[F.col(_own(r)).alias(r) for r in LADDERS])
    texts = texts.join(good, F.col("_id") == F.col("_label_id"), "left_semi")
    # Copies of a text have the same rates.
    texts = texts.groupBy("stratum", "hash").agg(*[F.max(r).alias(r) for r in LADDERS])
    pilot = F.pmod(F.xxhash64(F.lit("pilot"), "hash"), F.lit(PILOT)) == 0

    def first_step(rule: str, ladder: tuple[float, ...]) -> Column:
        """The first step of a ladder that rejects a text; all later steps of that ladder do too."""
        step = F.size(F.filter(F.array(*map(F.lit, ladder)), lambda cutoff: cutoff >= F.col(rule)))
        return F.struct(F.lit(rule).alias("rule"), step.alias("step"))

    firsts = F.array(*[first_step(rule, ladder) for rule, ladder in LADDERS.items()])
    texts = texts.select("stratum", "hash", pilot.alias("pilot"), firsts.alias("firsts"))
    sizes = texts.groupBy("stratum").agg(F.count_if(~F.col("pilot")).alias("n"))
    sizes = sizes.withColumn("strata", F.count("*").over(Window.partitionBy()))  # a row per stratum
    ladders = F.array(*[
        F.struct(F.lit(rule).alias("rule"), F.lit(step).alias("step"), F.lit(cutoff).alias("cutoff"))
        for rule, ladder in LADDERS.items() for step, cutoff in enumerate(ladder)
    ])
    steps = sizes.select("stratum", "n", "strata", F.inline(ladders))

    def same(a: str, b: str) -> Column:
        return F.col(f"{a}.stratum").eqNullSafe(F.col(f"{b}.stratum")) & (F.col(f"{a}.rule") == F.col(f"{b}.rule")) & (F.col(f"{a}.step") == F.col(f"{b}.step"))

    rejecting = texts.select("stratum", "hash", "pilot", F.inline("firsts"))
    piloted = rejecting.where("pilot").groupBy("stratum", "rule", "step").agg(F.count("*").alias("c"))
    up_to = Window.partitionBy("stratum", "rule").orderBy("step")
    ranked = steps.alias("s").join(piloted.alias("p"), same("s", "p"), "left").select("s.*", F.coalesce("p.c", F.lit(0)).alias("c"))
    ranked = ranked.withColumn("cost", F.sum("c").over(up_to))
    chain = ranked.withColumn("position", F.row_number().over(Window.partitionBy("stratum").orderBy("cost", "step", "rule"))).drop("c", "cost")
    # A text falls at the first position of the chain that rejects it.
    tested = rejecting.where("NOT pilot").alias("t").join(chain.alias("c"), same("t", "c")).select("t.stratum", "t.hash", "c.position")
    falls = tested.groupBy("stratum", "hash").agg(F.min("position").alias("position")).groupBy("stratum", "position").agg(F.count("*").alias("fallen"))
    here = F.col("c.stratum").eqNullSafe(F.col("f.stratum")) & (F.col("c.position") == F.col("f.position"))
    counted = chain.alias("c").join(falls.alias("f"), here, "left").select("c.*", F.coalesce("f.fallen", F.lit(0)).alias("fallen"))
    so_far = Window.partitionBy("stratum").orderBy("position")
    counted = counted.withColumn("k", F.sum("fallen").over(so_far))
    passed = binomial_tail(F.col("k"), F.col("n"), rejected) <= F.lit(risk) / F.col("strata")
    return counted.withColumn("passed", passed).withColumn("taken", F.every("passed").over(so_far))


def choose_cutoffs(
    features: DataFrame,
    labels: DataFrame,
    id_col: str,
    stratum_col: str,
    label_id_col: str,
    good_col: str,
    rejected: float,
    risk: float,
) -> DataFrame:
    """One row per stratum: the strictest cutoff each rule has earned, null where none.

    A document labelled more than once counts as good if all its labels say so.
    """
    good = (
        labels.where(F.col(good_col).isNotNull() & F.col(label_id_col).isNotNull())
        .groupBy(F.col(label_id_col).alias("_label_id"))
        .agg(F.min(good_col).alias("_good"))
        .where("_good = 1")
    )
    steps = _steps_taken(features, good, id_col, stratum_col, rejected, risk)
    return steps.groupBy("stratum").agg(
        *[F.min(F.when(F.col("taken") & (F.col("rule") == r), F.col("cutoff"))).alias(_own(f"cutoff_{r}")) for r in LADDERS]
    ).withColumnRenamed("stratum", _own("cutoff_stratum"))


def judge(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    stratum_col: str = "lang",
    label_id_col: str = "doc_id",
    good_col: str = "quality",
    rejected: float = 0.01,
    risk: float = 0.05,
    keep_columns: list[str] | None = None,
) -> DataFrame:
    """The kept columns (default: the id) with the counts, ``base_failed`` and ``kept`` as ``_quality_`` columns.

    Every row is judged, repeated rows alike. A null or empty text has no
    words, so the base rule rejects it; a null stratum is a stratum of its own; without labels only the base
    rule acts; columns that are not asked for are dropped, and of those
    asked for older ones of the result's names are replaced.
    """
    kept = list(dict.fromkeys([id_col, *(keep_columns or [])]))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"),
        F.col(f"`{text_col}`").alias("text"),
        F.col(f"`{stratum_col}`").cast("string").alias(_own("stratum")),
        F.col(f"`{id_col}`").alias("id"),
    )
    measured = with_features(rows, "text").drop("text")
    table = Workspace(docs.sparkSession, "quality").write(measured, "features")
    cutoffs = choose_cutoffs(table, labels, "id", _own("stratum"), label_id_col, good_col, rejected, risk)
    judged = table.join(cutoffs, F.col(_own("stratum")).eqNullSafe(F.col(_own("cutoff_stratum"))), "left")
    n = F.col(_own("n_words"))
    base = (n < 20) | (100 * F.col(_own("n_repeat_words")) > 30 * n)
    over = F.lit(False)
    for rule in LADDERS:
        over = over | F.coalesce(F.col(_own(rule)) > F.col(_own(f"cutoff_{rule}")), F.lit(False))
    found = {_own(f): F.col(_own(f)) for f in FEATURES} | {_own("base_failed"): base, _own("kept"): ~base & ~over}
    return judged.select(
        *[F.col("row")[c].alias(c) for c in kept if c not in found], *[c.alias(name) for name, c in found.items()]
    )
