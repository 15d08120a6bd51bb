"""Host-level quality rules, in DataFrame functions only.

Every document is measured and fails its base rules or not. Failures are summed by host; a host's failure rate is
shrunk towards the rate of all rows by a beta prior whose strength is fitted to the hosts' spread (by moments, less what
sampling alone spreads), and documents of hosts whose shrunk rate exceeds ``host_rate`` are rejected with those that
fail themselves.

Words are runs of anything but ASCII white space. Null texts are empty and fail for want of words; null hosts are a
host of their own. Texts of any length are measured whole, in arrays that one text fills. Repeated lines and windows are
compared within one text; windows by their 64-bit hash. Repeated rows count each. An empty table gives an empty result.
Only the key, the host and the text are read, so other columns may have any name. Host counts are pre-aggregated, and the
verdicts join documents' narrow rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, let, text_of

SYMBOLS = "#*$%&|<>"


def repeated_words(words: Column, window: int = 8) -> Column:
    """Words inside windows that are found twice or more, the first included.

    Window hashes are sorted with their places only where some hash repeats; places of repeated windows, sorted,
    cover ``window`` words each less what the next one covers again.
    """
    n = F.size(words)

    def joined(step: int):
        last = lambda h: F.greatest(F.size(h) - step, F.lit(1))
        return lambda h: F.transform(F.sequence(F.lit(1), last(h)), lambda i: F.xxhash64(F.get(h, i - 1), F.get(h, i - 1 + step)))

    one = F.transform(words, lambda w: F.xxhash64(w))
    hashes, step = one, 1
    while step < window:
        # Twice as many words in each hash: a window's is that of its halves.
        hashes = let(hashes, joined(step))
        step *= 2

    def covered(h: Column) -> Column:
        pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        places = let(
            pairs,
            lambda s: F.sort_array(
                F.transform(
                    F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda k: (F.get(s, k)["h"] == F.get(s, k - 1)["h"]) | (F.get(s, k)["h"] == F.get(s, k + 1)["h"])),
                    lambda k: F.get(s, k)["i"],
                )
            ),
        )
        return let(places, lambda p: F.aggregate(F.sequence(F.lit(0), F.size(p) - 1), F.lit(0).cast("long"), lambda t, k: t + F.coalesce(F.least(F.lit(window), F.get(p, k + 1) - F.get(p, k)), F.lit(window)).cast("long")))

    repeated = let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(F.lit(0).cast("long")))
    return F.when(n > window, repeated).otherwise(F.lit(0).cast("long"))


def measured(docs: DataFrame, host: str = "source", key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: ``key``, host and the base measures with base_failed."""
    t = F.col("text")
    lines = F.filter(F.split(t, "\n"), lambda line: line.rlike(WORD))
    words = F.regexp_extract_all(t, F.lit(WORD), 0)
    rows = docs.select(F.col(key).alias(key), F.col(host).alias("host"), text_of(text).alias("text"))
    rows = rows.select(
        key,
        "host",
        F.length(F.regexp_replace(t, f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        let(words, lambda w: F.struct(F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"), repeated_words(w).alias("n_repeat_words"))).alias("w"),
    ).select(key, "host", "w.n_words", "w.word_chars", "n_symbols", "n_dup_lines", "w.n_repeat_words")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return rows.withColumn("base_failed", failed)


def host_verdicts(rows: DataFrame, host_rate: float = 0.5) -> DataFrame:
    """Per host of ``rows(host, base_failed)``: rows, failures, the shrunk rate and host_kept.

    Hosts weigh as many rows as they have: of N rows in H hosts, m is the share that fails, v the weighted variance of the hosts'
    rates, and q the sum of the squared shares of rows. Rows that fail independently alone give v / m(1 - m) an expectation of
    (H - 1) / N, and rows of a host that all agree one of 1 - q; where between these it lies is the correlation r
    of a host's rows. The prior's strength is 1 / r - 1: at least 1, and 1000 where hosts don't differ by more than chance.
    """
    hosts = rows.groupBy("host").agg(F.count("*").alias("n_docs"), F.count_if("base_failed").alias("n_failed"))
    n, failed = F.col("n_docs").cast("double"), F.col("n_failed").cast("double")
    sums = hosts.agg(F.count("*").alias("h"), F.sum(n).alias("n"), F.sum(n * n).alias("nn"), F.sum(failed).alias("f"), F.sum(failed * failed / n).alias("ff"))
    sums = sums.select("h", "n", (F.col("nn") / F.col("n") / F.col("n")).alias("q"), (F.col("f") / F.col("n")).alias("m"), (F.col("ff") / F.col("n")).alias("p2"))
    chance, spread = (F.col("h") - 1) / F.col("n"), F.try_divide(F.col("p2") - F.col("m") * F.col("m"), F.col("m") * (1 - F.col("m")))
    r = F.try_divide(spread - chance, 1 - F.col("q") - chance)
    strength = F.when(r > 0, F.least(F.lit(1000.0), F.greatest(F.lit(1.0), 1 / r - 1))).otherwise(F.lit(1000.0))
    prior = sums.select("m", strength.alias("strength"))
    shrunk = (F.col("n_failed") + F.col("m") * F.col("strength")) / (F.col("n_docs") + F.col("strength"))
    out = hosts.crossJoin(F.broadcast(prior)).withColumn("shrunk_rate", shrunk)
    return out.select("host", "n_docs", "n_failed", "shrunk_rate", (F.col("shrunk_rate") <= host_rate).alias("host_kept"))


def judge(docs: DataFrame, host: str = "source", host_rate: float = 0.5, staged=lambda df: df) -> DataFrame:
    """Per row of ``docs``: the measures, base_failed, the host's shrunk_rate and kept. ``staged`` may write the measures once."""
    rows = staged(measured(docs, host))
    verdicts = host_verdicts(rows, host_rate).withColumnRenamed("host", "of_host")
    out = rows.join(verdicts, rows["host"].eqNullSafe(verdicts["of_host"]))
    return out.withColumn("kept", ~F.col("base_failed") & F.col("host_kept")).drop("of_host", "host_kept", "n_docs", "n_failed")
