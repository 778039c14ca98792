"""Quality rules with verdicts on whole hosts, in DataFrame functions only.

Every text is measured and judged by a few base rules. Failures are counted per host; the
failure rate of a host is drawn towards the mean of all hosts by a beta prior whose
parameters come from the hosts themselves (method of moments), so that a host of one
bad document is not condemned and a large bad one is. The verdict goes back to the documents.

Defined results: a null or blank text has no words and fails; a null host is a host of its own;
repeated rows count as often as they occur; an empty table gives no rows; other columns are carried whatever their
names, except that those of the names of results are replaced. Memory follows the longest single text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kelpline.llm.tables import BLANKS, staged
from kelpline.operators.lookups import lookup_join

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: A host with a higher shrunken failure rate loses all its documents.
MAX_HOST_RATE = 0.5
RESULTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
#: Host rates are summed in millionths, so that sums do not depend on the order of rows.
SCALE = 1_000_000


def _repeated_words(words: Column, n: Column) -> Column:
    """Words inside three-word windows that occur twice or more: sort the windows of a text, keep
    those equal to a neighbour, and add up what each covers beyond the one before."""
    at = lambda i, k: F.get(words, i + k)
    windows = F.transform(
        F.sequence(F.lit(0), n - 3),
        lambda i: F.struct(F.concat_ws(" ", at(i, 0), at(i, 1), at(i, 2)).alias("w"), i.alias("i")),
    )
    return F.when(n >= 3, F.sort_array(windows))


def _equal(rows: Column, i: Column, window: Column) -> Column:
    return F.coalesce(F.get(rows, i)["w"] == window, F.lit(False))


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the measures of the text: ``n_words``, ``word_chars``, ``n_symbols``,
    ``n_dup_lines``, ``n_repeat_words`` (all long)."""
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n", -1), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    found = docs.withColumns({"_words": F.array_remove(F.split(body, BLANKS + "+", -1), ""), "_lines": lines})
    found = found.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(F.translate(body, " \t\n\x0b\x0c\r", "")).cast("long"),
            "n_symbols": (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        }
    )
    found = found.withColumn("_windows", _repeated_words(F.col("_words"), F.size("_words"))).drop("_words", "_lines")
    rows = F.col("_windows")
    repeated = F.filter(rows, lambda x, i: _equal(rows, i - 1, x["w"]) | _equal(rows, i + 1, x["w"]))
    found = found.withColumn("_places", F.sort_array(F.transform(repeated, lambda x: x["i"]))).drop("_windows")
    places = F.col("_places")
    covers = F.transform(places, lambda x, i: F.when(i == 0, F.lit(3)).otherwise(F.least(F.lit(3), x - F.get(places, i - 1))))
    total = F.aggregate(covers, F.lit(0).cast("long"), lambda a, x: a + x)
    return found.withColumn("n_repeat_words", F.coalesce(total, F.lit(0).cast("long"))).drop("_places")


def base_rules() -> dict[str, Column]:
    """Rule name to the condition under which a measured document fails it."""
    return {
        "too_short": F.col("n_words") < MIN_WORDS,
        "repetitive": 100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"),
    }


def judge_hosts(measured: DataFrame, host: str, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """Per host: documents, failures (all and per rule), the shrunken rate, and the verdict."""
    rules = base_rules()
    hosts = staged(
        measured.groupBy(F.col(host).alias("host")).agg(
            F.count("*").alias("n_docs"),
            F.sum(F.col("base_failed").cast("long")).alias("n_failed"),
            *[F.sum(rule.cast("long")).alias(f"n_{name}") for name, rule in rules.items()],
        )
    )
    rate = F.floor(F.col("n_failed") * SCALE / F.col("n_docs")).cast("decimal(38,0)")
    # three numbers, however many hosts
    n, r, rr = (float(x or 0) for x in hosts.agg(F.count("*"), F.sum(rate), F.sum(rate * rate)).first())
    mean = r / n / SCALE if n else 0.0
    spread = (rr / n / SCALE / SCALE if n else 0.0) - mean * mean
    if spread <= 0:
        # all rates are equal: nothing tells hosts apart
        shrunk = F.lit(mean)
    else:
        # the prior weighs one document at least
        weight = max(mean * (1 - mean) / spread - 1, 1.0)
        shrunk = (F.col("n_failed") + F.lit(mean * weight)) / (F.col("n_docs") + F.lit(weight))
    found = hosts
    found = found.withColumn("rate", shrunk)
    return found.withColumn("rejected", F.col("rate") > max_rate)


def quality_rules(
    docs: DataFrame, host: str = "source", text: str = "text", max_rate: float = MAX_HOST_RATE, with_text: bool = True
) -> DataFrame:
    """``docs`` (without the text, if not ``with_text``) with the measures, ``base_failed`` and ``kept``.

    The texts are measured once, into a staged table; only the hosts are aggregated.
    """
    carried = [c for c in docs.columns if c.lower() not in RESULTS and (with_text or c != text)]
    wrapped = docs.select(F.struct(F.lit(0), *carried).alias("_doc"), F.col(host).alias("host"), F.col(text).alias("text"))
    failed = F.lit(False)
    for rule in base_rules().values():
        failed = failed | rule
    measured = staged(measure(wrapped).drop("text").withColumn("base_failed", failed))
    bad = staged(judge_hosts(measured, "host", max_rate).where("rejected").select(F.struct("host").alias("_host"), F.lit(True).alias("_bad")))
    # a struct of the host, so that a null host meets a null host
    judged = lookup_join(measured.withColumn("_host", F.struct("host")), bad, ["_host"])
    judged = judged.withColumn("kept", ~F.col("base_failed") & F.col("_bad").isNull())
    return judged.select(*[F.col("_doc")[c].alias(c) for c in carried], *RESULTS)
