"""Quality rules on documents and on the hosts they come from.

Each document is measured and tested against two rules.  Failures are counted by host; the
failure rate of a host is shrunk towards that of all hosts by a beta prior fitted to how much
the hosts differ beyond chance, so a host with few documents is judged mostly by the prior, and
where hosts do not differ, all are judged alike.  The verdict goes by the lower bound of a host's
rate.  One above the rate of all hosts makes a suspect host, whose documents are held to stricter
limits; one above ``max_rate`` too, a rejected one, which loses all its documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from orderline_kpi.llm.common import filled, words
from orderline_kpi.sources.scratch import WorkArea

SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\x0b\x0c\r"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Limits for documents of suspect hosts.
STRICT_MIN_WORDS = 100
STRICT_MAX_REPEAT_PERCENT = 25
STRICT_MAX_SYMBOL_PERCENT = 10


def _covered(starts: Column, width: int) -> Column:
    """How many positions windows of one width cover that begin at ``starts``, in ascending order."""
    steps = F.zip_with(
        starts, F.slice(starts, F.lit(2), F.greatest(F.size(starts) - 1, F.lit(0))),
        lambda a, b: F.least(F.coalesce(b - a, F.lit(width)), F.lit(width)),
    )
    return F.aggregate(steps, F.lit(0), lambda total, step: total + step)


def measure(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """``docs`` with the measures of each text.

    ``n_words``: words between white space.  ``word_chars``: code points in them.
    ``n_symbols``: characters of ``SYMBOLS``.  ``n_dup_lines``: lines that have a word and equal
    an earlier line.  ``n_repeat_words``: words in three-word windows that occur at least
    twice in the text.  All are 0 for a null or empty text.  Columns of ``docs`` that have
    the name of a measure are replaced.
    """
    text = filled(F.col(text_column))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return (
        docs.withColumns({
            "__words": words(text), "__lines": lines,
            "word_chars": F.char_length(F.translate(text, WHITE, "")).cast("long"),
            "n_symbols": (F.char_length(text) - F.char_length(F.translate(text, SYMBOLS, ""))).cast("long"),
        })
        .withColumns({
            "n_words": F.size("__words").cast("long"),
            "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
            "__windows": F.when(F.size("__words") > 3, F.transform(
                F.sequence(F.lit(0), F.size("__words") - 3),
                lambda i: F.xxhash64(
                    F.get("__words", i), F.get("__words", i + 1), F.get("__words", i + 2)),
            )),
        })
        .withColumn("__pairs", F.when(
            F.size(F.array_distinct("__windows")) < F.size("__windows"),
            F.sort_array(F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ))
        .withColumn("__starts", F.sort_array(F.transform(F.filter(
            "__pairs",
            lambda pair, k: (pair["h"] == F.get("__pairs", k + 1)["h"])
            | ((k > 0) & (pair["h"] == F.get("__pairs", k - 1)["h"])),
        ), lambda pair: pair["i"])))
        .withColumn("n_repeat_words", F.coalesce(_covered(F.col("__starts"), 3), F.lit(0)).cast("long"))
        .drop("__words", "__lines", "__windows", "__pairs", "__starts")
    )


def fails(n_words: Column, n_repeat_words: Column) -> Column:
    """True for a document with too few words or too many in repeated windows."""
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words)


def host_failures(measured: DataFrame, host_column: str) -> DataFrame:
    """Documents and failed documents of each host; rows without a host are one host."""
    return measured.groupBy(F.col(host_column).alias("host")).agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum(F.col("base_failed").cast("long")).alias("n_failed"))


def fails_strictly(n_words: Column, n_repeat_words: Column, n_symbols: Column, word_chars: Column) -> Column:
    """True for a document that a suspect host loses: short, repetitive, or with many symbols among its characters."""
    return (
        (n_words < STRICT_MIN_WORDS) | (100 * n_repeat_words > STRICT_MAX_REPEAT_PERCENT * n_words)
        | (100 * n_symbols > STRICT_MAX_SYMBOL_PERCENT * word_chars)
    )


def host_prior(hosts: DataFrame) -> DataFrame:
    """One row: ``mean``, the failure rate of all documents, and ``spread``, how far hosts differ beyond chance.

    Of a prior Beta(a, b), ``mean`` is a / (a + b) and ``spread`` 1 / (a + b + 1).  Both are fitted by moments
    in which a host counts by its documents; what a binomial draw makes rates vary is taken out.  ``spread`` is 0
    for hosts that vary no more than that, or a single host, and at most 1/2, a prior of one document.
    """
    sums = hosts.agg(
        F.count(F.lit(1)).alias("k"), F.sum("n_docs").alias("n"), F.sum("n_failed").alias("f"),
        F.sum(F.col("n_docs").cast("double") * F.col("n_docs")).alias("nn"),
        F.sum(F.col("n_failed").cast("double") * F.col("n_failed") / F.col("n_docs")).alias("ff"),
    ).select("k", "n", "nn", "ff", (F.col("f") / F.col("n")).alias("mean"))
    chance = F.col("k") - 1
    varied = (F.col("ff") - F.col("n") * F.col("mean") * F.col("mean")) / F.nullif(
        F.col("mean") * (1 - F.col("mean")), F.lit(0.0))
    spread = (varied - chance) / F.nullif(F.col("n") - F.col("nn") / F.col("n") - chance, F.lit(0.0))
    return sums.select(
        "mean", F.least(F.greatest(F.coalesce(spread, F.lit(0.0)), F.lit(0.0)), F.lit(0.5)).alias("spread"))


def host_verdicts(hosts: DataFrame, max_rate: float, deviations: float = 3.0) -> DataFrame:
    """Hosts with ``shrunk_rate``, its lower bound ``least_rate``, and whether they are ``suspect`` or ``rejected``.

    ``shrunk_rate`` is the mean of a host's posterior, ``least_rate`` lies ``deviations`` standard deviations of it
    lower.  Without a spread between hosts both are the rate of all, and no host is suspect.
    """
    prior = host_prior(hosts)
    mean, spread = prior.select("mean").scalar(), prior.select("spread").scalar()
    shrunk = (spread * F.col("n_failed") + mean * (1 - spread)) / (spread * F.col("n_docs") + (1 - spread))
    deviation = F.sqrt(spread * F.col("shrunk_rate") * (1 - F.col("shrunk_rate")) / (spread * F.col("n_docs") + 1))
    return hosts.withColumn("shrunk_rate", shrunk).withColumn(
        "least_rate", F.col("shrunk_rate") - deviations * deviation
    ).withColumn("suspect", F.col("least_rate") > mean).withColumn(
        "rejected", F.col("suspect") & (F.col("least_rate") > max_rate))


def apply_rules(
    docs: DataFrame, columns: list[str] | None = None, host_column: str = "source",
    text_column: str = "text", max_rate: float = 0.5,
) -> DataFrame:
    """``columns`` of ``docs`` (all by default) with the measures, ``base_failed``, ``host_rate``, ``kept``.

    A row is kept unless it fails itself, its host is rejected, or its host is suspect and the row
    fails the stricter limits.  Rows without a host are one host.  Repeated rows are judged
    one by one; null and empty texts fail.  Columns that have one of the new names are
    replaced.  An empty table gives an empty result.
    """
    work = WorkArea(docs.sparkSession, "quality-rules")
    new = {*MEASURES, "base_failed", "host_rate", "kept"}
    columns = [c for c in columns or docs.columns if c not in new]
    measured = measure(
        docs.select(*columns, F.col(host_column).alias("__host"), F.col(text_column).alias("__text")), "__text")
    measured = work.table(measured.withColumn(
        "base_failed", fails(F.col("n_words"), F.col("n_repeat_words"))).drop("__text"), "measured")
    hosts = work.table(host_failures(measured, "__host"), "hosts")
    verdicts = host_verdicts(hosts, max_rate).select("host", "shrunk_rate", "suspect", "rejected")
    strict = fails_strictly(*[F.col(c) for c in ("n_words", "n_repeat_words", "n_symbols", "word_chars")])
    return measured.join(verdicts, F.col("__host").eqNullSafe(F.col("host")), "left").select(
        *columns, *MEASURES, "base_failed", F.col("shrunk_rate").alias("host_rate"),
        (~(F.col("base_failed") | F.col("rejected") | (F.col("suspect") & strict))).alias("kept"),
    )
