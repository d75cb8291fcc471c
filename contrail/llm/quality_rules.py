"""Quality rules whose cutoffs are certified on labelled documents.

Each rule rejects documents whose measure exceeds a cutoff. The cutoff is picked
per stratum from a fixed grid with labelled documents as the holdout: a cutoff
qualifies only if the exact binomial test rejects "the rule loses more than its
share of the allowed false rejections". The error level is divided by the number
of (stratum, rule, cutoff) tests, the allowed rate by the number of rules, so with
the stated confidence *no* stratum loses more than ``max_false_rejection`` of its
good documents to all rules together. Among qualifying cutoffs the one with the
largest surplus of rejected bad over rejected good documents is used, the most
lenient of equals; a stratum without enough labels keeps everything.

Everything is a DataFrame expression: texts are read once and stay in their
partition, later steps work on a few numbers per document.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.columns import SPACE, let, split_words
from contrail.session import cut_lineage

MAX_FALSE_REJECTION = 0.05
CONFIDENCE = 0.95
# rule -> (count, denominator); a measure is the count per 1,000 of the denominator
RULES = {
    "symbols": ("n_symbols", "n_words"),
    "exclamations": ("n_exclamations", "n_words"),
    "capitals": ("n_capitals", "word_chars"),
    "duplicate_lines": ("n_dup_lines", "n_lines"),
    "repeated_words": ("n_repeat_words", "n_words"),
}
CUTOFFS = (20, 50, 100, 150, 200, 300, 400, 500, 600, 700, 800, 900, 1000, 1500, 2000)
DIGEST = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "base_failed", "kept")


def repeated_window_words(words: Column, size: int = 3) -> Column:
    """Words inside a window of ``size`` words that the text holds twice or more."""
    def positions(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(pairs, lambda p: F.sort_array(F.transform(
            F.filter(p, lambda e, k: F.coalesce(e.h == F.get(p, k - 1).h, F.lit(False))
                     | F.coalesce(e.h == F.get(p, k + 1).h, F.lit(False))), lambda e: e.i)))

    def covered(starts: Column) -> Column:
        empty = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-size).alias("last"))
        return F.aggregate(starts, empty, lambda a, x: F.struct(
            (a.n + F.least(F.lit(size), x - a.last)).alias("n"), x.alias("last")), lambda a: a.n)

    def windows(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(w) - size),
                           lambda i: F.xxhash64(*(w[i + k] for k in range(size))))

    def any_repeated(hashes: Column) -> Column:
        return let(F.sort_array(hashes), lambda s: F.exists(
            F.sequence(F.lit(1), F.size(s)), lambda i: s[i - 1] == F.get(s, i)))

    # most texts repeat no window; only the others need positions
    return let(words, lambda w: F.when(F.size(w) < size, F.lit(0).cast("long")).otherwise(
        let(windows(w), lambda h: F.when(any_repeated(h), covered(positions(h)))
            .otherwise(F.lit(0).cast("long")))))


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with one struct column ``q`` of counts over the whole text."""
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "")
    counts = let(split_words(body), lambda w: let(lines, lambda x: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        F.regexp_count(body, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count(body, F.lit("!")).cast("long").alias("n_exclamations"),
        F.regexp_count(body, F.lit(r"\p{Lu}")).cast("long").alias("n_capitals"),
        F.size(x).cast("long").alias("n_lines"),
        (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        repeated_window_words(w).alias("n_repeat_words"))))
    return docs.withColumn("q", counts)


def base_failed(q: str = "q") -> Column:
    """Too short, or more than half of the words in repeated windows."""
    return (F.col(f"{q}.n_words") < 50) | (
        100 * F.col(f"{q}.n_repeat_words") > 50 * F.col(f"{q}.n_words"))


def measure(rule: str, q: str = "q") -> Column:
    count, base = RULES[rule]
    return F.when(F.col(f"{q}.{base}") > 0, F.expr(f"{q}.{count} * 1000 div {q}.{base}")).otherwise(
        F.lit(0).cast("long"))


def _log_gamma(x: Column) -> Column:
    """Stirling's series after moving the argument up by eight."""
    y = x + 8
    shift = sum((F.log(x + i) for i in range(1, 8)), F.log(x))
    series = 1 / (12 * y) - 1 / (360 * y ** 3) + 1 / (1260 * y ** 5) - 1 / (1680 * y ** 7)
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series - shift


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) of a binomial variable for k below its mean, else 1.

    Starts at the largest term and goes down until terms cannot matter, so the
    work grows with the square root of ``n``.
    """
    top = (_log_gamma(n + 1.0) - _log_gamma(k + 1.0) - _log_gamma(n - k + 1.0)
           + k * math.log(p) + (n - k) * math.log(1 - p))
    steps = F.least(k, F.ceil(12 * F.sqrt(n * p)) + 30).cast("int")
    down = F.aggregate(
        F.sequence(F.lit(0), steps),
        F.struct(F.lit(1.0).alias("term"), F.lit(0.0).alias("total")),
        lambda a, i: F.struct(
            (a.term * F.greatest(k - i, F.lit(0)) / (n - (k - i) + 1) * ((1 - p) / p)).alias("term"),
            (a.total + a.term).alias("total")),
        lambda a: a.total)
    return F.when(k >= n * p, F.lit(1.0)).otherwise(F.exp(top) * down)


def certified_cutoffs(measures: DataFrame, labels: DataFrame, *, stratum: str = "lang",
                      max_false_rejection: float = MAX_FALSE_REJECTION,
                      confidence: float = CONFIDENCE) -> DataFrame:
    """Rows (stratum, rule, cutoff, n_good, good_rejected, bad_rejected), at most one per rule.

    ``measures`` has doc_id, the stratum, ``q`` and ``th``, a hash of the text. Trials are
    independent only if nothing counts twice: an id counts once, however often its row is
    repeated (the text of the smallest hash, if it has several), and so does a text within
    a stratum, however many ids hold it. Labels of one document or of one text that disagree
    count as bad; rows with a null id or label are not used.
    """
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        F.min("quality").alias("quality"))
    values = F.array(*(F.struct(F.lit(r).alias("rule"), F.least(measure(r), F.lit(max(CUTOFFS) + 1))
                                .alias("value")) for r in RULES))
    # per stratum, rule and value: a small histogram of good and bad documents
    once = (measures.where(~base_failed())
            .select("doc_id", F.struct("th", F.coalesce(F.col(stratum), F.lit("")).alias("stratum"),
                                       values.alias("values")).alias("m"))
            .join(known, "doc_id").groupBy("doc_id").agg(F.min("m").alias("m"), F.min("quality").alias("quality")))
    histogram = (once.groupBy("m.stratum", "m.th").agg(F.min("quality").alias("quality"), F.min("m.values").alias("values"))
                 .select("stratum", "quality", F.inline("values"))
                 .groupBy("stratum", "rule", "value")
                 .agg(F.sum((F.col("quality") == 1).cast("long")).alias("good"),
                      F.sum((F.col("quality") == 0).cast("long")).alias("bad")))
    histogram = cut_lineage(histogram)
    totals = histogram.groupBy("stratum", "rule").agg(F.sum("good").alias("n_good"))
    tests = histogram.agg(F.countDistinct("stratum")).first()[0] * len(RULES) * len(CUTOFFS)
    share = max_false_rejection / len(RULES)
    rejected = (histogram
                .withColumn("cutoff", F.explode(F.filter(
                    F.array(*(F.lit(c) for c in CUTOFFS)), lambda c: c < F.col("value"))))
                .groupBy("stratum", "rule", "cutoff")
                .agg(F.sum("good").alias("good_rejected"), F.sum("bad").alias("bad_rejected"))
                .join(totals, ["stratum", "rule"]))
    tail = binomial_tail(F.col("good_rejected").cast("double"), F.col("n_good").cast("double"), share)
    return (rejected.where("bad_rejected > good_rejected")
            .where(tail <= (1 - confidence) / max(tests, 1))
            .groupBy("stratum", "rule")
            .agg(F.max(F.struct((F.col("bad_rejected") - F.col("good_rejected")).alias("gain"),
                                "cutoff", "n_good", "good_rejected", "bad_rejected")).alias("best"))
            .select("stratum", "rule", "best.cutoff", "best.n_good", "best.good_rejected",
                    "best.bad_rejected"))


def judged(measures: DataFrame, cutoffs: DataFrame, stratum: str = "lang") -> DataFrame:
    """``measures`` with ``base_failed`` and ``kept``; one row in, one row out."""
    limits = cutoffs.groupBy(F.col("stratum").alias("q_stratum")).agg(
        *(F.min(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"q_{r}") for r in RULES))
    joined = measures.join(limits, F.coalesce(F.col(stratum), F.lit("")) == F.col("q_stratum"), "left")
    over = F.lit(False)
    for rule in RULES:
        over = over | F.coalesce(measure(rule) > F.col(f"q_{rule}"), F.lit(False))
    return (joined.withColumn("base_failed", base_failed())
            .withColumn("kept", ~F.col("base_failed") & ~over)
            .drop("q_stratum", *(f"q_{r}" for r in RULES)))


def quality_digest(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """One row per document: its counts, ``base_failed`` and ``kept``.

    Null texts have no words and fail the base rule; repeated rows each get their
    row; an empty table gives an empty result; other columns are ignored. A null
    stratum is a stratum of its own.
    """
    stratum = options.get("stratum", "lang")
    narrow = cut_lineage(measured(docs.select("doc_id", stratum, "text")).withColumn("th", F.md5("text")).drop("text"))
    result = judged(narrow, certified_cutoffs(narrow, labels, **options), stratum)
    return result.select("doc_id", *(F.col(f"q.{c}") for c in DIGEST[1:-2]), *DIGEST[-2:])


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their own columns.

    The measured rows are written once and read for the cutoffs and for the result.
    """
    stratum = options.get("stratum", "lang")
    wide = cut_lineage(measured(docs.select(F.struct("*").alias("row"), "doc_id", stratum, "text"))
                       .withColumn("th", F.md5("text")).drop("text"))
    cutoffs = certified_cutoffs(wide.select("doc_id", stratum, "q", "th"), labels, **options)
    return judged(wide, cutoffs, stratum).where("kept").select("row.*")
