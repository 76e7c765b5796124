"""Host-level quality rules, in DataFrame functions only.

Each document gets its own measures and is held against RULES: two base rules that decide alone (too few words, too many
repeated ones) and two that are only signs (many symbols, many repeated lines: a technical page or a poem fails them
too).  Failures are added up by host and rule; a host's failure rate in each rule is shrunk towards that of all hosts with a
beta prior of that rule, whose two parameters come from the hosts themselves (method of moments over the hosts'
rates), so a host with few documents stays near the mean.  The host's verdict: it is rejected if its shrunk
rate of base failures exceeds REJECT; and a sign is held against its documents if the host's shrunk rate in that
sign exceeds SIGNS, so a document that fails a sign goes where the sign is the host's habit and stays where it is rare.
The verdict is joined back to the documents.

The measures are made once, without a shuffle, and written to the shared folder; what is shuffled afterwards is one
row for each host and task.  Verdicts of hosts with HOT rows or more are broadcast (rows / HOT verdicts at most), so
that no host's rows meet in one task; the others join by host.

Cases: a null text has no words and fails; a null host is a host of its own; a very long text is measured whole; an empty table gives an empty
result; repeated rows count each; ties don't arise; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise

SYMBOLS, SPACES = "#*$%&|<>", " \t\n\x0b\f\r"
WINDOW, LEAST_WORDS, MOST_REPEATED = 8, 20, 30
REJECT = 0.6
#: A document shows a sign with more symbols than a quarter of its words, or with more than 30 % of its lines repeated; a
#: host has the habit if its shrunk rate is above these.
SIGNS = {"symbols": 0.03, "lines": 0.02}
SYMBOLS_PER_WORD, REPEATED_LINES = 4, 30
RULES = ("base", "short", "repeats", *SIGNS)
HOT = 1_000_000


def words_of(text: Column) -> Column:
    one = F.translate(text, SPACES, " " * len(SPACES))
    return F.filter(F.split(one, " "), lambda w: w != "")


def measures(docs: DataFrame, host: str, keep: tuple[str, ...]) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(*keep, F.col(host).cast("string").alias("host"), text.alias("_t"))
    lines = F.filter(F.split("_t", "\n"), lambda x: F.length(F.translate(x, SPACES, "")) > 0)
    rows = rows.withColumns({"_w": F.transform(words_of(F.col("_t")), lambda w: F.xxhash64(w)), "_l": lines})
    rows = rows.select(
        *keep,
        "host",
        "_w",
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.translate("_t", SPACES, "")).cast("long").alias("word_chars"),
        (F.length("_t") - F.length(F.translate("_t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.size("_l").alias("_lines"),
    )
    # windows that occur again: first whether there are any, by a set; then sorted, only for texts that have some
    keys = F.when(F.col("n_words") > WINDOW, F.transform(F.sequence(F.lit(0), F.col("n_words").cast("int") - WINDOW), lambda i: F.xxhash64(*[F.get("_w", i + j) for j in range(WINDOW)])))
    rows = rows.withColumn("_k", keys)
    again = F.size(F.array_distinct("_k")) < F.size("_k")
    pairs = F.array_sort(F.transform("_k", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    rows = rows.withColumn("_p", F.when(again, pairs))
    twice = F.filter(
        F.transform("_p", lambda p, at: F.when((F.get("_p", at - 1)["h"] == p["h"]) | (F.get("_p", at + 1)["h"] == p["h"]), p["i"])),
        lambda i: i.isNotNull(),
    )
    rows = rows.withColumn("_s", F.sort_array(twice))
    covered = F.aggregate(
        F.transform("_s", lambda i, at: F.least(F.lit(WINDOW), F.coalesce(F.get("_s", at + 1) - i, F.lit(WINDOW)))),
        F.lit(0).cast("long"),
        lambda acc, x: acc + x,
    )
    rows = rows.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
    failed = {
        "short": F.col("n_words") < LEAST_WORDS,
        "repeats": 100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"),
        "symbols": SYMBOLS_PER_WORD * F.col("n_symbols") > F.col("n_words"),
        "lines": 100 * F.col("n_dup_lines") > REPEATED_LINES * F.col("_lines"),
    }
    rows = rows.select(*keep, "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", *[c.alias(f"failed_{r}") for r, c in failed.items()])
    return rows.withColumn("base_failed", F.col("failed_short") | F.col("failed_repeats"))


def priors(hosts: DataFrame) -> dict[str, tuple[float, float]]:
    """For each rule its beta prior as mean and strength, from one row of moments of the hosts' rates."""
    moments = [F.sum("n").alias("t"), F.avg(1 / F.col("n")).alias("u")]
    for r in RULES:
        moments += [F.sum(r).alias(f"f_{r}"), F.var_pop(F.col(r) / F.col("n")).alias(f"v_{r}")]
    row, out = hosts.agg(*moments).first(), {}
    for r in RULES:
        mean = max(1e-4, min(1 - 1e-4, row[f"f_{r}"] / row["t"])) if row["t"] else 0.5
        # the variance of the rates with sampling noise taken off; a + b = m (1 - m) / v - 1
        spread = max((row[f"v_{r}"] or 0.0) - mean * (1 - mean) * (row["u"] or 0.0), 1e-6)
        out[r] = mean, max(1.0, min(1e4, mean * (1 - mean) / spread - 1))
    return out


def host_verdicts(measured: DataFrame, reject: float = REJECT, signs: dict[str, float] | None = None) -> DataFrame:
    """For each host: rows, failures and shrunk failure rate of each rule, and the verdict."""
    own = {"base": "base_failed"} | {r: f"failed_{r}" for r in RULES[1:]}
    hosts = measured.groupBy("host").agg(F.count(F.lit(1)).alias("n"), *[F.count_if(c).alias(r) for r, c in own.items()])
    for r, (mean, strength) in priors(hosts).items():
        hosts = hosts.withColumn(f"rate_{r}", (F.col(r) + mean * strength) / (F.col("n") + strength))
    hosts = hosts.withColumn("host_rejected", F.col("rate_base") > reject)
    return hosts.withColumns({f"habit_{r}": F.col(f"rate_{r}") > least for r, least in (signs or SIGNS).items()})


def host_rules(docs: DataFrame, host: str = "source", keep: tuple[str, ...] = ("doc_id",), reject: float = REJECT, hot: int = HOT) -> DataFrame:
    """The columns of keep, the measures, base_failed, kept, host and host_rate (the shrunk rate of base failures)."""
    measured = materialise(measures(docs, host, keep), "host-rules")
    told = F.struct("rate_base", "host_rejected", *[f"habit_{r}" for r in SIGNS])
    key = lambda c: F.when(c.isNull(), "0").otherwise(F.concat(F.lit("1"), c))
    verdicts = materialise(host_verdicts(measured, reject).select(key(F.col("host")).alias("_host"), "n", told.alias("_told")), "host-verdicts")
    large = verdicts.filter(F.col("n") >= hot).select("_host", F.col("_told").alias("_large"))
    rows = measured.withColumn("_host", key(F.col("host"))).join(F.broadcast(large), "_host", "left")
    # a large host's rows have their verdict by now; they are dealt out by a key that no host has
    rows = rows.withColumn("_host", F.when(F.col("_large").isNull(), F.col("_host")).otherwise(F.concat(F.lit("2"), F.xxhash64(*keep))))
    out = rows.join(verdicts.filter(F.col("n") < hot).select("_host", "_told"), "_host", "left").withColumn("_told", F.coalesce("_large", "_told"))
    goes = F.col("base_failed") | F.col("_told.host_rejected")
    for r in SIGNS:
        goes = goes | (F.col(f"failed_{r}") & F.col(f"_told.habit_{r}"))
    return out.select(*keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~goes).alias("kept"), "host", F.col("_told.rate_base").alias("host_rate"))


#: The base measures in DuckDB's SQL; the host's verdict too.
SQL = f"""
WITH t AS (SELECT doc_id, source AS host, coalesce(text, '') AS x FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(x, '[\\x20\\x09-\\x0D]+'), lambda q: q <> '') AS ws,
      list_filter(string_split(x, chr(10)), lambda q: regexp_matches(q, '[^\\x20\\x09-\\x0D]')) AS ls FROM t),
k AS (SELECT *, len(ws) AS n, CASE WHEN len(ws) > {WINDOW - 1} THEN list_transform(range(1, len(ws) - {WINDOW - 2}), lambda i: array_to_string(ws[i:i + {WINDOW - 1}], ' ')) ELSE [] END AS ks FROM w),
u AS (SELECT doc_id, host, row_number() OVER () AS r, n, ws, ls, x, ks FROM k),
e AS (SELECT r, unnest(ks) AS h, generate_subscripts(ks, 1) AS i FROM u),
d AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, h) AS c FROM e) WHERE c > 1),
g AS (SELECT r, sum(least({WINDOW}, coalesce(nxt - i, {WINDOW}))) AS n_repeat FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt FROM d) GROUP BY r),
m AS (SELECT doc_id, host, CAST(n AS BIGINT) AS n_words, CAST(length(regexp_replace(x, '[\\x20\\x09-\\x0D]', '', 'g')) AS BIGINT) AS word_chars,
      CAST(length(x) - length(regexp_replace(x, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
      CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, len(ls) AS n_lines, CAST(coalesce(n_repeat, 0) AS BIGINT) AS n_repeat_words
      FROM u LEFT JOIN g USING (r)),
b AS (SELECT *, (n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words) AS base_failed,
      {SYMBOLS_PER_WORD} * n_symbols > n_words AS symbols, 100 * n_dup_lines > {REPEATED_LINES} * n_lines AS lines FROM m),
hs AS (SELECT host, rule, count(*) AS c, sum(failed::INT) AS f FROM (SELECT host, unnest(['base', 'symbols', 'lines']) AS rule, unnest([base_failed, symbols, lines]) AS failed FROM b) GROUP BY ALL),
p AS (SELECT rule, greatest(1e-4, least(1 - 1e-4, sum(f) / sum(c))) AS mu, var_pop(f / c) AS v, avg(1 / c) AS u FROM hs GROUP BY rule),
q AS (SELECT rule, mu, greatest(1.0, least(1e4, mu * (1 - mu) / greatest(v - mu * (1 - mu) * u, 1e-6) - 1)) AS s FROM p),
z AS (SELECT host, bool_or(rule = 'base' AND (f + mu * s) / (c + s) > {REJECT}) AS rejected, bool_or(rule = 'symbols' AND (f + mu * s) / (c + s) > {SIGNS['symbols']}) AS habit_symbols,
      bool_or(rule = 'lines' AND (f + mu * s) / (c + s) > {SIGNS['lines']}) AS habit_lines FROM hs JOIN q USING (rule) GROUP BY host)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT (base_failed OR rejected OR (symbols AND habit_symbols) OR (lines AND habit_lines)) AS kept
FROM b JOIN z ON b.host IS NOT DISTINCT FROM z.host
"""
