"""Rule-based quality filter: one Spark projection, no user functions (operator 5).

``RULES`` is a table of (name, ratio, lowest, highest).  :func:`compile_rules`
turns it into one boolean column over the measures of a text, so Catalyst sees
plain expressions; every measure is computed inside the row and nothing is
shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from homeledger.llm.shared import id_and_text

SPACE = "[\\\\x20\\\\x09-\\\\x0D]"
SYMBOLS = "#*$%&|<>"
# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in a is that for it as was with be by on at from are this or an "
    "der die das und ein eine nicht mit von zu den ist auf für im sich auch als dem "
    "le la les de des et un une en du que qui dans pour est par sur pas au avec "
    "el los las y del se una por con no para al lo su es como"
).split()
# name, ratio over the measures, lowest and highest value that passes (None: open)
RULES = (
    ("word_count", "n_words", 50, None),
    ("mean_word_length", "word_chars / n_words", 2.0, 15.0),
    ("symbols_per_word", "n_symbols / n_words", None, 0.1),
    ("stop_word_share", "n_stop_words / n_words", 0.02, None),
    ("alphabetic_word_share", "n_alpha_words / n_words", 0.7, None),
    ("upper_case_share", "n_upper / word_chars", None, 0.5),
    ("duplicate_line_share", "n_dup_lines / n_lines", None, 0.4),
    ("ellipsis_line_share", "n_ellipsis_lines / n_lines", None, 0.3),
)
# Words in 3-word windows found twice or more, laid out in order of position: each
# repeated window adds the words that the one before it does not already cover.
REPEATED = """
CASE WHEN size(ws) < 4 THEN 0L ELSE
  transform(array(sort_array(transform(sequence(0, size(ws) - 3),
              i -> struct(concat_ws(' ', ws[i], ws[i + 1], ws[i + 2]) AS g, i AS i)))), s ->
    transform(array(sort_array(transform(
        filter(s, (x, k) -> coalesce(get(s, k - 1).g = x.g, false) OR coalesce(get(s, k + 1).g = x.g, false)),
        x -> x.i))), p ->
      CAST(aggregate(transform(p, (at, k) -> least(3, coalesce(get(p, k + 1) - at, 3))), 0, (n, x) -> n + x) AS BIGINT)
    )[0])[0]
END
"""


def compile_rules(rules=RULES) -> Column:
    """AND of the rules; a ratio without a value (division by zero) fails its rule."""
    out = F.lit(True)
    for _, ratio, low, high in rules:
        x = F.try_divide(*ratio.split(" / ")) if " / " in ratio else F.col(ratio)
        if low is not None:
            out = out & F.coalesce(x >= F.lit(low), F.lit(False))
        if high is not None:
            out = out & F.coalesce(x <= F.lit(high), F.lit(False))
    return out


def _let(value: str, name: str, fields: dict[str, str]) -> Column:
    """struct of ``fields`` over ``value``, bound to ``name`` once.

    A lambda variable stays bound wherever the optimizer moves the expression
    (a filter on the result, say), so the words of a text are never cut again
    for every word.
    """
    return F.expr(f"transform(array({value}), {name} -> struct("
                  + ", ".join(f"{x} AS {k}" for k, x in fields.items()) + "))[0]")


def measures(docs: DataFrame) -> DataFrame:
    """Counts per text: words, characters, symbols, stop words, lines and repeats."""
    stop = ", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS)))
    words = _let(f"filter(split(text, '{SPACE}+'), w -> w <> '')", "ws", {
        "n_words": "CAST(size(ws) AS BIGINT)",
        "n_repeat_words": REPEATED,
        "n_stop_words": f"CAST(size(filter(ws, w -> lower(w) IN ({stop}))) AS BIGINT)",
        "n_alpha_words": "CAST(size(filter(ws, w -> w rlike '\\\\p{L}')) AS BIGINT)"})
    lines = _let("filter(split(text, '\\n'), l -> l rlike '[^\\\\x20\\\\x09-\\\\x0D]')", "ls", {
        "n_lines": "CAST(size(ls) AS BIGINT)",
        "n_dup_lines": "CAST(size(ls) - size(array_distinct(ls)) AS BIGINT)",
        "n_ellipsis_lines": "CAST(size(filter(ls, l -> endswith(rtrim(l), '...') OR endswith(rtrim(l), '…'))) AS BIGINT)"})
    chars = {"word_chars": f"length(regexp_replace(text, '{SPACE}+', ''))",
             "n_symbols": f"length(text) - length(translate(text, '{SYMBOLS}', ''))",
             "n_upper": "length(text) - length(regexp_replace(text, '[A-Z]', ''))"}
    return id_and_text(docs).select(
        "doc_id", words.alias("w"), lines.alias("l"),
        *[F.expr(f"CAST({x} AS BIGINT)").alias(k) for k, x in chars.items()]).select("doc_id", "w.*", "l.*", *chars)


def quality_rules(docs: DataFrame, rules=RULES) -> DataFrame:
    """Measures, ``base_failed`` and ``kept`` of every document.

    A null text counts as empty: all counts are 0 and ``base_failed`` is true.
    Null ids and repeated rows are kept as they are; an empty table gives an
    empty result; other columns are ignored, whatever their names.  Very long
    texts are measured whole inside their row.
    """
    base_failed = F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words")
    return (measures(docs).withColumn("base_failed", base_failed)
            .withColumn("kept", ~F.col("base_failed") & compile_rules(rules))
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "base_failed", "kept"))


def duck_sql(rules=RULES) -> str:
    """DuckDB twin over the view ``documents``."""
    stop = ", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS)))
    sp = "[\\x20\\x09-\\x0D]"
    ratio = lambda r: "{} * 1.0 / nullif({}, 0)".format(*r.split(" / ")) if " / " in r else r
    test = " AND ".join(f"coalesce({ratio(r)} {op} {v}, false)" for _, r, lo, hi in rules
                        for op, v in ((">=", lo), ("<=", hi)) if v is not None)
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS ws FROM d),
x AS (SELECT rid, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
g AS (SELECT rid, i, word || ' ' || lead(word) OVER o || ' ' || lead(word, 2) OVER o AS gram
      FROM x WINDOW o AS (PARTITION BY rid ORDER BY i)),
r AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, gram) AS n FROM g WHERE gram IS NOT NULL)
      WHERE n > 1),
rep AS (SELECT rid, count(DISTINCT i + k) AS n_repeat_words FROM r, (VALUES (0), (1), (2)) t(k) GROUP BY rid),
wc AS (SELECT rid, count(*) AS n_words, sum(length(word)) AS word_chars,
              count(*) FILTER (lower(word) IN ({stop})) AS n_stop_words,
              count(*) FILTER (regexp_matches(word, '\\p{{L}}')) AS n_alpha_words,
              sum(length(regexp_replace(word, '[^A-Z]', '', 'g'))) AS n_upper
       FROM x GROUP BY rid),
l AS (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d),
lc AS (SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines,
              count(*) FILTER (rtrim(line, ' ') LIKE '%...' OR rtrim(line, ' ') LIKE '%…') AS n_ellipsis_lines
       FROM l WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY rid),
m AS (SELECT doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
             coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
             coalesce(n_lines, 0) AS n_lines, coalesce(n_stop_words, 0) AS n_stop_words,
             coalesce(n_alpha_words, 0) AS n_alpha_words, coalesce(n_upper, 0) AS n_upper,
             coalesce(n_ellipsis_lines, 0) AS n_ellipsis_lines
      FROM d LEFT JOIN wc USING (rid) LEFT JOIN lc USING (rid) LEFT JOIN rep USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND {test} AS kept
FROM m"""
