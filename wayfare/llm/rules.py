"""Quality rules whose failures are judged by host.

Every text is measured once. Failures of each rule are summed by host, and a host's rate is shrunk
towards the rate of all hosts by a beta prior whose strength is estimated from how much hosts
differ (method of moments). A host that fails any rule too often by its shrunk rate is rejected
with all its documents; single documents are rejected by the base rules alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.llm.common import free_names, mix64, releasing, small_batches, staged
from wayfare.llm.neardup import HASHES

# The rules, as SQL over the measures of a document.
FEW_WORDS = "n_words < 50"
REPETITION = "100 * n_repeat_words > 50 * n_words"
RULES = {
    "few_words": FEW_WORDS,
    "repetition": REPETITION,
    "symbols": "10 * n_symbols > n_words",
    "word_length": "word_chars < 3 * n_words or word_chars > 10 * n_words",
    "dup_lines": "10 * n_dup_lines > 3 * n_lines",
}
#: A host whose shrunk rate of failures of a rule is above this is rejected.
HOST_RATE = 0.5
#: Up to this many rejected hosts go to every executor; more are joined by a shuffle.
BROADCAST_HOSTS = 50_000
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def measure(text: str | None) -> tuple[int, ...]:
    """The measures of a text (null: as empty, all 0)."""
    data = (text or "").encode()
    words = data.split()
    n = len(words)
    repeated = 0
    if n >= 4:
        h = np.fromiter(map(HASHES.__getitem__, words), np.uint64, n)
        with np.errstate(over="ignore"):
            windows = mix64(h[:-2] + mix64(h[1:-1] + mix64(h[2:] + np.uint64(1))))
        _, which, counts = np.unique(windows, return_inverse=True, return_counts=True)
        often = counts[which] >= 2
        covered = np.zeros(n, bool)
        for k in range(3):
            covered[k : n - 2 + k] |= often
        repeated = int(covered.sum())
    lines = [line for line in data.split(b"\n") if line.strip()]
    white = len(data) - len(data.translate(None, b" \t\n\r\x0b\x0c"))
    symbols = len(data) - len(data.translate(None, b"#*$%&|<>"))
    return n, len(text or "") - white, symbols, len(lines) - len(set(lines)), repeated, len(lines)


@releasing
def _measure_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "text"):
        rows = [measure(t) for t in batch.column("text").to_pylist()]
        columns = [pa.array([r[k] for r in rows], pa.int64()) for k in range(len(MEASURES))]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("host"), *columns], ["doc_id", "host", *MEASURES])


def measured(docs: DataFrame, host: str = "source") -> DataFrame:
    """doc_id, host and the measures of each row's whole text."""
    kinds = ", ".join(f"{m} long" for m in MEASURES)
    return docs.select(F.col("doc_id").cast("long"), F.col(host).cast("string").alias("host"), "text").mapInArrow(
        _measure_batches, f"doc_id long, host string, {kinds}"
    )


def host_rates(measures: DataFrame) -> DataFrame:
    """One row per host: documents, and the shrunk failure rate of each rule."""
    hosts = measures.where("host is not null").groupBy("host").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(F.expr(f"if({rule}, 1L, 0L)")).alias(name) for name, rule in RULES.items()]
    )
    hosts = staged(hosts, "hosts")
    total = hosts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("hosts"), *[F.sum(name).alias(name) for name in RULES]).first()
    if not total["n"]:
        return hosts.select("host", "n", *[F.lit(0.0).alias(name) for name in RULES])
    mean = {name: total[name] / total["n"] for name in RULES}
    spread = hosts.agg(*[F.sum(F.col("n") * (F.col(name) / F.col("n") - mean[name]) ** 2).alias(name) for name in RULES]).first()
    return hosts.select("host", "n", *[_shrunk(name, mean[name], spread[name] / total["n"], total["hosts"] / total["n"]).alias(name) for name in RULES])


def strength(mean: float, spread: float, per_document: float) -> float:
    """Documents that the prior counts as: from the variance of host rates beyond that of chance."""
    chance = mean * (1 - mean)
    between = spread - chance * per_document
    return min(max(chance / between - 1, 1.0), 1e6) if between > 0 and chance > 0 else 1e6


def _shrunk(name: str, mean: float, spread: float, per_document: float) -> Column:
    k = strength(mean, spread, per_document)
    return (F.col(name) + k * mean) / (F.col("n") + k)


def rejected_hosts(measures: DataFrame, max_rate: float = HOST_RATE) -> DataFrame:
    """(host, rejected) of the hosts to be rejected; marked for broadcast behind a check of their number."""
    bad = host_rates(measures).where(F.greatest(*RULES) > max_rate).select("host", F.lit(True).alias("rejected"))
    bad = staged(bad, "rejected-hosts")
    return F.broadcast(bad) if bad.count() <= BROADCAST_HOSTS else bad


BASE_FAILED = f"({FEW_WORDS}) or ({REPETITION})"


def judged(docs: DataFrame, host: str = "source", max_rate: float = HOST_RATE) -> DataFrame:
    """doc_id, host and measures of every row with ``base_failed`` and ``kept``.

    Null and empty texts have no words and fail. Rows without a host are judged by the base rules
    alone; repeated rows are each judged and counted; an empty table gives no rows.
    """
    measures = staged(measured(docs, host), "measures")
    return (
        measures.join(rejected_hosts(measures, max_rate), "host", "left")
        .withColumn("base_failed", F.expr(BASE_FAILED))
        .withColumn("kept", ~F.col("base_failed") & F.col("rejected").isNull())
        .drop("rejected")
    )


def kept_documents(docs: DataFrame, host: str = "source", max_rate: float = HOST_RATE) -> DataFrame:
    """The documents that ``judged`` keeps, with their own columns.

    Texts are measured once for the hosts and once more where they are filtered, so that no text is shuffled.
    """
    bad = rejected_hosts(staged(measured(docs, host), "measures"), max_rate)

    @releasing
    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            found = [measure(t) for t in batch.column("text").to_pylist()]
            yield batch.filter(pa.array([m[0] >= 50 and 100 * m[4] <= 50 * m[0] for m in found], pa.bool_()))

    own = docs.mapInArrow(passing, docs.schema)
    (name,) = free_names(docs, "rejected_host")
    return own.join(bad.select(F.col("host").alias(name)), F.col(host).cast("string") == F.col(name), "left_anti")


SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws FROM d),
windows AS (SELECT r, unnest(range(1, len(ws) - 1)) AS i, ws FROM w WHERE len(ws) >= 3),
counted AS (SELECT r, i, count(*) OVER (PARTITION BY r, ws[i] || chr(10) || ws[i + 1] || chr(10) || ws[i + 2]) AS c FROM windows),
covered AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM counted WHERE c >= 2) GROUP BY r),
lines AS (SELECT r, unnest(string_split(t, chr(10))) AS l FROM d),
dups AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n FROM lines WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]') GROUP BY r),
m AS (
  SELECT doc_id, source, len(ws)::BIGINT AS n_words,
    length(array_to_string(ws, ''))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    coalesce(dups.n, 0)::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words, coalesce(n_lines, 0)::BIGINT AS n_lines
  FROM w LEFT JOIN covered USING (r) LEFT JOIN dups USING (r)),
hosts AS (SELECT source, count(*) AS n, {", ".join(f"count(*) FILTER (WHERE {rule}) AS {name}" for name, rule in RULES.items())} FROM m WHERE source IS NOT NULL GROUP BY source),
long AS (SELECT source, n, rule, f FROM hosts UNPIVOT (f FOR rule IN ({", ".join(RULES)}))),
means AS (SELECT rule, sum(f) / sum(n) AS mu, count(*) / sum(n) AS per_document FROM long GROUP BY rule),
spread AS (SELECT rule, any_value(mu * (1 - mu)) AS chance, any_value(mu) AS mu,
    sum(n * (f / n - mu) ** 2) / sum(n) - any_value(mu * (1 - mu) * per_document) AS between_hosts
  FROM long JOIN means USING (rule) GROUP BY rule),
prior AS (SELECT rule, mu, CASE WHEN between_hosts > 0 AND chance > 0 THEN least(greatest(chance / between_hosts - 1, 1.0), 1e6) ELSE 1e6 END AS k FROM spread),
bad AS (SELECT source FROM long JOIN prior USING (rule) GROUP BY source HAVING max((f + k * mu) / (n + k)) > {HOST_RATE})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, ({FEW_WORDS}) OR ({REPETITION}) AS base_failed,
  NOT (({FEW_WORDS}) OR ({REPETITION})) AND (source IS NULL OR source NOT IN (SELECT source FROM bad)) AS kept
FROM m
"""
