"""Quality rules with risk-controlled cutoffs. DataFrame functions only."""

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeline.llm.common import fresh, stage

WINDOW_WORDS = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
FALSE_REJECTION = 0.05  # share of good documents that all rules together may reject
MISTAKE = 0.05  # probability that some stratum's share is larger
GOOD_WEIGHT = 20  # bad documents that one good document is worth when a cutoff is chosen
_WORD = r"[^\x20\x09-\x0D]+"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: what is compared with a cutoff, each from 0 to 1000
SHARES = ("symbol_share", "dup_line_share", "repeat_share", "upper_share")
RESULTS = (*COUNTS, *SHARES, "base_failed", "kept")


def _repeat_words(sorted_windows: str) -> Column:
    """Words covered by windows whose hash has an equal neighbour in the sorted array."""
    all_windows = F.col(sorted_windows)

    def start(window: Column, at: Column) -> Column:
        before = (at > 0) & (F.get(all_windows, at - 1)["hash"] == window["hash"])
        after = F.get(all_windows, at + 1)["hash"] == window["hash"]
        return F.when(before | F.coalesce(after, F.lit(False)), window["at"])

    starts = F.sort_array(F.array_compact(F.transform(all_windows, start)))
    zero = F.struct(F.lit(-WINDOW_WORDS).alias("last"), F.lit(0).alias("words"))
    return F.aggregate(
        starts,
        zero,
        lambda found, at: F.struct(
            at.alias("last"), (found["words"] + F.least(F.lit(WINDOW_WORDS), at - found["last"])).alias("words")
        ),
        lambda found: found["words"],
    )


def with_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the columns of COUNTS and SHARES, from whole texts; null has no word."""
    names = [c for c in docs.columns if c.lower() not in (*COUNTS, *SHARES)]
    text, words, hashes, lines, windows, upper, n_lines = (
        fresh(docs, f"_{n}") for n in ("text", "words", "hashes", "lines", "windows", "upper", "n_lines")
    )
    rows = docs.select(*names, F.coalesce(F.col(text_col), F.lit("")).alias(text))
    rows = rows.withColumns(
        {
            words: F.regexp_extract_all(text, F.lit(_WORD), F.lit(0)),
            lines: F.filter(F.split(text, "\n"), lambda line: line.rlike(_WORD)),
            "n_symbols": F.length(F.regexp_replace(text, "[^#*$%&|<>]+", "")).cast("long"),
            upper: F.length(F.regexp_replace(text, r"\P{Lu}+", "")),
        }
    )
    rows = rows.withColumns(
        {
            "n_words": F.size(words).cast("long"),
            "word_chars": F.length(F.array_join(words, "")).cast("long"),
            n_lines: F.size(lines),
            "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
            hashes: F.transform(words, lambda w: F.xxhash64(w)),
        }
    ).drop(words, lines, text)
    last = F.size(hashes) - WINDOW_WORDS
    hashed = F.transform(F.sequence(F.lit(1), last + 1), lambda i: F.xxhash64(F.slice(hashes, i, WINDOW_WORDS)))
    rows = rows.withColumn(windows, F.when(last >= 0, hashed)).drop(hashes)
    # most texts repeat no window: only those that do are sorted
    repeats = F.size(F.array_distinct(windows)) < F.size(windows)
    paired = F.transform(windows, lambda h, i: F.struct(h.alias("hash"), i.alias("at")))
    rows = rows.withColumn(windows, F.when(repeats, F.sort_array(paired)))
    rows = rows.withColumn("n_repeat_words", F.coalesce(_repeat_words(windows), F.lit(0)).cast("long"))

    def share(part: str, whole: str) -> Column:
        ratio = F.floor(F.col(part) * 1000 / F.greatest(F.col(whole), F.lit(1)))
        return F.least(ratio, F.lit(1000)).cast("int")

    rows = rows.withColumns(
        {
            "symbol_share": share("n_symbols", "word_chars"),
            "dup_line_share": share("n_dup_lines", n_lines),
            "repeat_share": share("n_repeat_words", "n_words"),
            "upper_share": share(upper, "word_chars"),
        }
    )
    return rows.select(*names, *COUNTS, *SHARES)


def allowed_rejections(n: Column, risk: float, log_mistake: Column) -> Column:
    """The most rejections among ``n`` good documents that still bound the true rate by ``risk``.

    That is the largest k at which a binomial (n, risk) count is at most k with a
    probability of at most the allowed mistake: the exact (Clopper-Pearson) upper
    bound is then within ``risk``. -1 if even k = 0 doesn't show it. Sums are of
    logarithms, so that no term of a large n underflows.
    """
    odds = math.log(risk) - math.log1p(-risk)
    term0 = n * F.lit(math.log1p(-risk))
    zero = F.struct(
        term0.cast("double").alias("term"), F.lit(float("-inf")).alias("total"), F.lit(-1).cast("long").alias("k")
    )

    def step(found: Column, i: Column) -> Column:
        term = F.when(i == 0, found["term"]).otherwise(
            found["term"] + F.log((n - i + 1) / F.greatest(i, F.lit(1))) + F.lit(odds)
        )
        top = F.greatest(term, found["total"])
        total = top + F.log(F.exp(term - top) + F.exp(found["total"] - top))
        return F.struct(
            term.alias("term"),
            total.alias("total"),
            F.when(total <= log_mistake, i.cast("long")).otherwise(found["k"]).alias("k"),
        )

    counts = F.sequence(F.lit(0).cast("long"), F.floor(n * F.lit(risk)).cast("long"))
    return F.aggregate(counts, zero, step, lambda found: found["k"])


def fit_cutoffs(
    counted: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    stratum_col: str = "lang",
    false_rejection: float = FALSE_REJECTION,
    mistake: float = MISTAKE,
) -> DataFrame:
    """(stratum, one column per share): the cutoffs above which a document is rejected.

    Labels (doc_id, quality) with quality 1 are good, 0 bad; of several for a document
    the lowest counts, null tells nothing. Half of the labelled documents, by a hash of
    the id, choose a cutoff; the other half is the holdout. In each stratum, a cutoff is
    certified if the exact binomial bound on its false rejections, from the holdout, is
    within ``false_rejection`` divided by the number of rules. Rejections only grow as
    a cutoff falls, so cutoffs are tested in that order and the tests of one rule need
    no correction; those of all rules and strata share ``mistake`` (Bonferroni). Of
    the certified cutoffs the one with most bad documents less GOOD_WEIGHT times the
    good ones it rejects is taken; the greatest of equals. No certified cutoff, or none
    that gains, leaves null: the rule then rejects nothing there.
    """
    label = labels.groupBy(F.col("doc_id").alias("_id")).agg(F.min("quality").alias("_good"))
    rows = counted.select(F.col(id_col).alias("_id"), F.col(stratum_col).alias("stratum"), *SHARES)
    rows = rows.withColumn("stratum", F.coalesce(F.col("stratum").cast("string"), F.lit("")))
    rows = rows.join(label.filter("_good is not null"), "_id")
    values = F.explode(F.array(*[F.struct(F.lit(s).alias("rule"), F.col(s).alias("value")) for s in SHARES]))
    holdout = F.pmod(F.xxhash64("_id", F.lit("holdout")), F.lit(2)) == 1
    good = F.col("_good") > 0
    told = rows.select("stratum", holdout.alias("held"), good.alias("good"), values.alias("v"))
    counts = told.groupBy("stratum", F.col("v.rule").alias("rule"), F.col("v.value").alias("value")).agg(
        F.count_if(F.col("held") & F.col("good")).alias("held_good"),
        F.count_if(~F.col("held") & F.col("good")).alias("tune_good"),
        F.count_if(~F.col("held") & ~F.col("good")).alias("tune_bad"),
    )
    counts = stage(counts, "cutoff-counts")  # at most 1001 rows a rule and stratum
    strata = counts.select("stratum").distinct().count()
    if not strata:
        return counts.groupBy("stratum").agg(*[F.lit(None).cast("int").alias(s) for s in SHARES])
    log_mistake = F.lit(math.log(mistake / (strata * len(SHARES))))

    # rejected: the rows of greater values, so that the cutoff of a row is its value
    above = Window.partitionBy("stratum", "rule").orderBy(F.col("value").desc())
    above = above.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("stratum", "rule")
    rejected = {c: F.coalesce(F.sum(c).over(above), F.lit(0)) for c in ("held_good", "tune_good", "tune_bad")}
    tested = counts.select(
        "stratum",
        "rule",
        "value",
        F.sum("held_good").over(whole).alias("n"),
        rejected["held_good"].alias("lost"),
        (rejected["tune_bad"] - GOOD_WEIGHT * rejected["tune_good"]).alias("gain"),
    )
    sizes = tested.select("stratum", "rule", "n").distinct()
    bound = allowed_rejections(F.col("n"), false_rejection / len(SHARES), log_mistake)
    sizes = sizes.select("stratum", "rule", bound.alias("allowed"))
    certified = tested.join(sizes, ["stratum", "rule"]).filter("lost <= allowed and gain > 0")
    best = certified.groupBy("stratum", "rule").agg(F.max_by("value", F.struct("gain", "value")).alias("cutoff"))
    return best.groupBy("stratum").agg(
        *[F.max(F.when(F.col("rule") == s, F.col("cutoff"))).alias(s) for s in SHARES]
    )


def quality_verdicts(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    stratum_col: str = "lang",
    keep_text: bool = True,
    **risk,
) -> DataFrame:
    """``docs`` with COUNTS, SHARES, base_failed and kept; without the text, if so asked.

    base_failed: under MIN_WORDS words, or over MAX_REPEAT_PERCENT percent of the words
    in repeated windows. kept: not base_failed, and no share above its stratum's cutoff.
    A null stratum is one of its own, null and empty texts fail, repeated rows are
    judged alike, an unlabelled stratum has no cutoffs, and an empty table gives an
    empty one. Columns named like a result are replaced.
    """
    counted = with_counts(docs, text_col)
    counted = stage(counted if keep_text else counted.drop(text_col), "counted")
    cutoffs = fit_cutoffs(counted, labels, id_col, stratum_col, **risk)
    stratum = fresh(counted, "_stratum")
    cutoffs = stage(cutoffs.select(F.col("stratum").alias(stratum), *[F.col(s).alias(f"{stratum}_{s}") for s in SHARES]), "cutoffs")
    rows = counted.join(cutoffs, F.coalesce(F.col(stratum_col).cast("string"), F.lit("")) == F.col(stratum), "left")
    repeats = 100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    failed = (F.col("n_words") < MIN_WORDS) | repeats
    over = [F.coalesce(F.col(s) > F.col(f"{stratum}_{s}"), F.lit(False)) for s in SHARES]
    rejected = over[0] | over[1] | over[2] | over[3]
    names = [c for c in counted.columns if c.lower() not in RESULTS[-2:]]
    return rows.select(*names, failed.alias("base_failed"), (~failed & ~rejected).alias("kept"))
