"""Quality rules whose thresholds adapt to language and source, by mergeable quantile sketches.

A sketch is a histogram over log-linear buckets of whole numbers: the leading ``1 + BITS`` binary
digits of a value name its bucket, so a quantile is off by 1/32 at most. Sketches merge by adding
counts, so they are ordinary partial aggregates and a hot source costs no more than any other;
a source with few documents takes its language's merged sketch, a rare language that of all.

A document passes a rule while its value lies within ``SPREAD`` quartile distances, and some
slack, of its group's quartiles. Everything is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staffflow.llm.common import BLANK, stored

SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8
SHORT, REPEAT_PERCENT = 20, 30
BITS = 5
SPREAD = 3
#: Documents of a source (or language) from which its own sketch counts.
ENOUGH = 100
#: Rules: value per million or thousand as a whole number, slack beyond the fences, whether low values fail too.
RULES = {
    "word_length": ("word_chars * 1000 DIV n_words", 1_000, True),
    "symbol_share": ("n_symbols * 1000000 DIV word_chars", 30_000, False),
    "capital_share": ("n_capitals * 1000000 DIV word_chars", 150_000, False),
    "dup_line_share": ("n_dup_lines * 1000000 DIV n_lines", 200_000, False),
    "repeat_share": ("n_repeat_words * 1000000 DIV n_words", 100_000, False),
}


def _repeated_words(windows: Column) -> Column:
    """Words inside windows (hashes, in order) that occur at least twice."""

    def covered(ordered: Column) -> Column:
        twice = F.filter(
            ordered,
            lambda x, k: F.coalesce(F.get(ordered, k - 1)["h"] == x["h"], F.lit(False))
            | F.coalesce(F.get(ordered, k + 1)["h"] == x["h"], F.lit(False)),
        )
        start = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last"))
        return F.aggregate(
            F.sort_array(F.transform(twice, lambda x: x["at"])),
            start,
            lambda a, at: F.struct((a["n"] + F.least(F.lit(WINDOW), at - a["last"])).alias("n"), at.alias("last")),
            lambda a: a["n"],
        )

    ordered = F.sort_array(F.transform(windows, lambda h, at: F.struct(h.alias("h"), at.alias("at"))))
    # the one-element array gives the sorted windows a name, so that they are sorted once
    repeated = F.get(F.transform(F.array(ordered), covered), 0)
    return F.when(F.size(F.array_distinct(windows)) < F.size(windows), repeated).otherwise(0)


def metrics(docs: DataFrame) -> DataFrame:
    """Counts of every document: doc_id, lang, source, n_words, n_lines and those the rules use."""
    text = F.coalesce(F.col("text"), F.lit(""))
    cut = docs.select(
        "doc_id", "lang", "source",
        F.array_remove(F.split(text, BLANK), "").alias("words"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.regexp_count(text, F.lit("[A-Z]")).cast("long").alias("n_capitals"),
    )
    count = F.greatest(F.size("words") - (WINDOW - 1), F.lit(1))

    def windows(hashes: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), count), lambda i: F.xxhash64(F.slice(hashes, i, WINDOW)))

    # the one-element array gives the word hashes a name: named by a column, they would be inlined
    # into the inner function and computed again for every window
    hashed = cut.withColumn("windows", F.get(F.transform(F.array(F.transform("words", lambda w: F.xxhash64(w))), windows), 0))
    return hashed.select(
        "doc_id", "lang", "source",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        "n_symbols", "n_capitals",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeated_words(F.col("windows")).cast("long").alias("n_repeat_words"),
    )


def bucket_of(value: Column) -> Column:
    """Bucket of a whole number from 0 on: itself below 2^(BITS+1), else exponent and leading digits."""
    shift = F.greatest(F.length(F.bin(value)) - (BITS + 1), F.lit(0))
    return (F.lit(1 << BITS) * shift + F.call_function("shiftright", value, shift)).cast("int")


def least_of(bucket: Column) -> Column:
    """The least value of a bucket."""
    shift = F.greatest(F.floor(bucket / (1 << BITS)).cast("int") - 1, F.lit(0))
    return F.call_function("shiftleft", (bucket - F.lit(1 << BITS) * shift).cast("long"), shift)


def sketches(values: DataFrame, keys: list[str]) -> DataFrame:
    """Merged sketches: keys, rule, bucket, n."""
    return values.groupBy(*keys, "rule", "bucket").agg(F.sum("n").alias("n"))


def quartiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """keys, rule, n (documents), q1, q3 of each sketch."""
    group = Window.partitionBy(*keys, "rule")
    upto = F.sum("n").over(group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
    counted = sketch.withColumn("upto", upto).withColumn("all", F.sum("n").over(group))
    value = least_of(F.col("bucket"))
    return counted.groupBy(*keys, "rule").agg(
        F.max("all").alias("n"),
        F.min(F.when(4 * F.col("upto") >= F.col("all"), value)).alias("q1"),
        F.min(F.when(4 * F.col("upto") >= 3 * F.col("all"), value)).alias("q3"),
    )


def thresholds(measured: DataFrame) -> DataFrame:
    """One row per language and source: the lower and upper threshold of each rule."""
    long = "stack({}, {}) AS (rule, value)".format(
        len(RULES), ", ".join(f"'{name}', {text.split(' DIV ')[0]} DIV greatest({text.split(' DIV ')[1]}, 1)" for name, (text, _, _) in RULES.items())
    )
    values = measured.filter("n_words > 0").selectExpr("lang", "source", long)
    base = values.groupBy("lang", "source", "rule", bucket_of(F.col("value")).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    base = stored(base)
    own = quartiles(base, ["lang", "source"])
    wide = quartiles(sketches(base, ["lang"]), ["lang"]).select(
        F.col("lang").alias("wide_lang"), F.col("rule").alias("wide_rule"), F.struct("n", "q1", "q3").alias("wide")
    )
    every = quartiles(sketches(base, []), []).select(F.col("rule").alias("any_rule"), F.struct("n", "q1", "q3").alias("every"))
    both = own.join(wide, F.col("lang").eqNullSafe(F.col("wide_lang")) & (F.col("rule") == F.col("wide_rule")))
    both = both.join(every, F.col("rule") == F.col("any_rule"))
    picked = (
        F.when(F.col("n") >= ENOUGH, F.struct("n", "q1", "q3"))
        .when(F.col("wide.n") >= ENOUGH, F.col("wide"))
        .otherwise(F.col("every"))
    )
    fences = both.select("lang", "source", "rule", picked.alias("s")).select(
        "lang", "source", "rule", "s.q1", "s.q3", (SPREAD * (F.col("s.q3") - F.col("s.q1"))).alias("reach")
    )
    return fences.groupBy("lang", "source").agg(
        *[F.max(F.when(F.col("rule") == r, F.col("q1") - F.col("reach") - slack)).alias(f"{r}_low") for r, (_, slack, low) in RULES.items() if low],
        *[F.max(F.when(F.col("rule") == r, F.col("q3") + F.col("reach") + slack)).alias(f"{r}_high") for r, (_, slack, _) in RULES.items()],
    )


def judge(docs: DataFrame) -> DataFrame:
    """The counts of every document, base_failed and kept; one row per input row.

    ``docs``: doc_id, text, lang, source. Null languages and sources are groups of their own. A
    null or empty text has no words and fails the base rule. Kept are documents that pass the
    base rule (SHORT words at least, REPEAT_PERCENT per cent repeated at most) and all rules; a
    value at a fence is within it. A text of any length is counted whole, rows that repeat are
    judged each, an empty table gives no rows, further columns are ignored.
    """
    measured = stored(metrics(docs.select("doc_id", "text", "lang", "source")))
    fences = stored(thresholds(measured)).withColumnsRenamed({"lang": "fence_lang", "source": "fence_source"})
    same = F.col("lang").eqNullSafe(F.col("fence_lang")) & F.col("source").eqNullSafe(F.col("fence_source"))
    joined = measured.join(fences, same, "left")
    base_failed = (F.col("n_words") < SHORT) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    within = F.lit(True)
    for rule, (text, _, low) in RULES.items():
        top, bottom = text.split(" DIV ")
        value = F.expr(f"{top} DIV greatest({bottom}, 1)")
        within &= value <= F.col(f"{rule}_high")
        if low:
            within &= value >= F.col(f"{rule}_low")
    kept = ~base_failed & F.coalesce(within, F.lit(False))
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"), kept.alias("kept"),
    )


def _sql() -> str:
    value = {r: f"{t.split(' DIV ')[0]} // greatest({t.split(' DIV ')[1]}, 1)" for r, (t, _, _) in RULES.items()}
    long = " UNION ALL ".join(f"SELECT lang, source, '{r}' AS rule, {v} AS v FROM m WHERE n_words > 0" for r, v in value.items())
    shift = f"greatest(length(bin(v)) - {BITS + 1}, 0)"
    least = f"((b - {1 << BITS} * greatest(b // {1 << BITS} - 1, 0)) << greatest(b // {1 << BITS} - 1, 0))"
    quart = (
        "SELECT {k} rule, any_value(every) AS n, min({least}) FILTER (4 * upto >= every) AS q1, min({least}) FILTER (4 * upto >= 3 * every) AS q3 "
        "FROM (SELECT *, sum(n) OVER (PARTITION BY {k} rule ORDER BY b) AS upto, sum(n) OVER (PARTITION BY {k} rule) AS every "
        "FROM (SELECT {k} rule, b, sum(n) AS n FROM sketch GROUP BY ALL)) GROUP BY ALL"
    )
    fence = []
    for r, (_, slack, low) in RULES.items():
        if low:
            fence.append(f"max(CASE WHEN rule = '{r}' THEN q1 - {SPREAD} * (q3 - q1) - {slack} END) AS {r}_low")
        fence.append(f"max(CASE WHEN rule = '{r}' THEN q3 + {SPREAD} * (q3 - q1) + {slack} END) AS {r}_high")
    within = " AND ".join(
        f"{value[r]} <= {r}_high" + (f" AND {value[r]} >= {r}_low" if low else "") for r, (_, _, low) in RULES.items()
    )
    return f"""
WITH raw AS (
  SELECT row_number() OVER () AS rn, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
cut AS (
  SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM raw),
grams AS (
  SELECT rn, i, array_to_string(words[i:i + {WINDOW - 1}], ' ') AS g
  FROM (SELECT rn, words, unnest(range(1, len(words) - {WINDOW - 2})) AS i FROM cut)),
twice AS (SELECT rn, i FROM (SELECT rn, i, count(*) OVER (PARTITION BY rn, g) AS c FROM grams) WHERE c > 1),
again AS (
  SELECT rn, sum(least({WINDOW}, coalesce(i - p, {WINDOW}))) AS n
  FROM (SELECT rn, i, lag(i) OVER (PARTITION BY rn ORDER BY i) AS p FROM twice) GROUP BY rn),
m AS (
  SELECT doc_id, lang, source, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(text, '{SYMBOLS}')) AS BIGINT) AS n_symbols,
    CAST(len(regexp_extract_all(text, '[A-Z]')) AS BIGINT) AS n_capitals,
    CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM cut LEFT JOIN again USING (rn)),
sketch AS (
  SELECT lang, source, rule, {1 << BITS} * {shift} + (v >> {shift}) AS b, count(*) AS n FROM ({long}) GROUP BY ALL),
own AS ({quart.format(k="lang, source,", least=least)}),
wide AS ({quart.format(k="lang,", least=least)}),
whole AS ({quart.format(k="", least=least)}),
picked AS (
  SELECT o.lang, o.source, o.rule,
    CASE WHEN o.n >= {ENOUGH} THEN o.q1 WHEN w.n >= {ENOUGH} THEN w.q1 ELSE a.q1 END AS q1,
    CASE WHEN o.n >= {ENOUGH} THEN o.q3 WHEN w.n >= {ENOUGH} THEN w.q3 ELSE a.q3 END AS q3
  FROM own o JOIN wide w ON o.lang IS NOT DISTINCT FROM w.lang AND o.rule = w.rule JOIN whole a ON o.rule = a.rule),
fences AS (SELECT lang, source, {", ".join(fence)} FROM picked GROUP BY lang, source),
judged AS (
  SELECT m.*, n_words < {SHORT} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words AS base_failed,
    coalesce({within}, false) AS fine
  FROM m LEFT JOIN fences f ON m.lang IS NOT DISTINCT FROM f.lang AND m.source IS NOT DISTINCT FROM f.source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND fine AS kept
FROM judged
"""


QUALITY_SQL = _sql()
