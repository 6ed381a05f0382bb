"""Quality rules: a table of thresholds compiled into one projection of built-in functions.

``measures`` states every measure of a text as a Spark expression, ``RULES`` bounds some of them, and
``judged`` compiles both into projections: no user function, no shuffle, no second look at
the table. Words are ``[^\\x20\\x09-\\x0D]+``. Windows of 8 words are compared inside a document by
64-bit hashes of their words' 64-bit hashes.

Null, empty and blank texts have no words, fail the base rule and are not kept; measures per
word are 0 for them. Repeated rows are judged one by one, and no table size matters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.text import table

BLANK = r"[\x20\x09-\x0D]"
SYMBOL = r"[#*$%&|<>]"
WINDOW = 8

# The commonest function words of the languages the corpus is written in.
STOP_WORDS = (
    "the of and to in a is that it for was with on as by at be this are from or an "
    "der die das und in den von zu mit ist nicht ein eine auf für im sich auch als dem "
    "le la les de des du et un une en est que qui dans pour pas au sur il ne se "
    "el los las del y que en un una por con no para es lo al su se como más"
).split()

# (measure, least value allowed or None, greatest value allowed or None)
RULES = (
    ("n_words", 20, None),
    ("mean_word_chars", 1.5, 15),
    ("symbols_per_word", None, 0.3),
    ("dup_line_share", None, 0.3),
    ("repeat_share", None, 0.3),
    ("stop_share", 0.02, None),
    ("upper_share", None, 0.5),
)


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, even inside lambdas."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(hashes: Column) -> Column:
    """Words in 8-word windows that occur twice or more, of an array of word hashes."""

    def windows(h: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(h) - WINDOW)
        return F.transform(starts, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)]))

    def covered(w: Column) -> Column:
        placed = F.sort_array(F.transform(w, lambda x, i: F.struct(x.alias("w"), i.alias("i"))))

        def repeated(s: Column) -> Column:
            twin = F.filter(s, lambda x, j: (x["w"] == F.get(s, j - 1)["w"]) | (x["w"] == F.get(s, j + 1)["w"]))
            return F.sort_array(F.transform(twin, lambda x: x["i"]))

        start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto"))
        return F.aggregate(
            _let(placed, repeated), start,
            lambda s, p: F.struct((s["n"] + F.least(F.lit(WINDOW), p + WINDOW - s["upto"])).alias("n"),
                                  (p + WINDOW).alias("upto")),
            lambda s: s["n"])

    def of_windows(w: Column) -> Column:
        return F.when(F.size(F.array_distinct(w)) == F.size(w), 0).otherwise(covered(w))

    return F.when(F.size(hashes) <= WINDOW, 0).otherwise(
        _let(hashes, lambda h: _let(windows(h), of_windows))).cast("long")


def measures(text: Column) -> list[list[Column]]:
    """Layers of measures; a layer may use the columns of the one before."""
    text = F.coalesce(text, F.lit(""))
    words = F.filter(F.split("__text", BLANK + "+"), lambda w: w != "")
    lines = F.filter(F.split("__text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    n = F.col("n_words")

    def per_word(value: Column) -> Column:
        return F.when(n == 0, 0.0).otherwise(value / n)

    # Punctuation and symbols that trail a word don't hide it.
    stops = F.filter("__words", lambda w: F.lower(F.rtrim(w, F.lit(".,;:!?*#$%&|<>"))).isin(STOP_WORDS))
    upper = F.regexp_count("__text", F.lit(r"\p{Lu}"))
    letters = F.regexp_count("__text", F.lit(r"\p{L}"))
    return [
        [text.alias("__text")],
        [words.alias("__words"), lines.alias("__lines")],
        [
            F.size("__words").cast("long").alias("n_words"),
            (F.length("__text") - F.regexp_count("__text", F.lit(BLANK))).cast("long").alias("word_chars"),
            F.regexp_count("__text", F.lit(SYMBOL)).cast("long").alias("n_symbols"),
            (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
            F.size("__lines").cast("long").alias("n_lines"),
            _repeat_words(F.transform("__words", lambda w: F.xxhash64(w))).alias("n_repeat_words"),
            F.size(stops).cast("long").alias("n_stop_words"),
            upper.cast("long").alias("n_upper"),
            letters.cast("long").alias("n_letters"),
        ],
        [
            per_word(F.col("word_chars")).alias("mean_word_chars"),
            per_word(F.col("n_symbols")).alias("symbols_per_word"),
            per_word(F.col("n_repeat_words")).alias("repeat_share"),
            per_word(F.col("n_stop_words")).alias("stop_share"),
            F.when(F.col("n_lines") == 0, 0.0).otherwise(F.col("n_dup_lines") / F.col("n_lines")).alias("dup_line_share"),
            F.when(F.col("n_letters") == 0, 0.0).otherwise(F.col("n_upper") / F.col("n_letters")).alias("upper_share"),
        ],
    ]


def compiled(rules=RULES) -> Column:
    """One condition that holds where every rule does."""
    verdict = F.lit(True)
    for name, least, most in rules:
        if least is not None:
            verdict &= F.col(name) >= least
        if most is not None:
            verdict &= F.col(name) <= most
    return verdict


def judged(docs: DataFrame, rules=RULES) -> DataFrame:
    """``doc_id``, the measures, ``base_failed`` and ``kept`` for every row of ``docs``."""
    out = docs.select("doc_id", "text")
    for layer in measures(F.col("text")):
        out = out.select("*", *layer)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    out = out.drop("text", "__text", "__words", "__lines").withColumn("base_failed", failed)
    return out.withColumn("kept", ~F.col("base_failed") & compiled(rules))


def op7_quality(spark, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _sql() -> str:
    stops = ", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS)))
    rules = " AND ".join(
        part for name, least, most in RULES for part in (
            [f"{name} >= {least}"] * (least is not None) + [f"{name} <= {most}"] * (most is not None)))
    return rf"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS x,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls
  FROM documents),
g AS (SELECT doc_id, i, array_to_string(ws[i : i + 7], ' ') AS g
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM t WHERE len(ws) >= 8)),
r AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words
      FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p
            FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g) WHERE c > 1)
      GROUP BY doc_id),
m AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(length(x) - len(regexp_extract_all(x, '[\x20\x09-\x0D]')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(x, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, len(ls) AS n_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
         len(list_filter(ws, lambda w: lower(rtrim(w, '.,;:!?*#$%&|<>')) IN ({stops}))) AS n_stop,
         len(regexp_extract_all(x, '\p{{Lu}}')) AS n_upper, len(regexp_extract_all(x, '\p{{L}}')) AS n_letters
  FROM t LEFT JOIN r USING (doc_id)),
s AS (
  SELECT *, CASE WHEN n_words = 0 THEN 0 ELSE word_chars / n_words END AS mean_word_chars,
         CASE WHEN n_words = 0 THEN 0 ELSE n_symbols / n_words END AS symbols_per_word,
         CASE WHEN n_words = 0 THEN 0 ELSE n_repeat_words / n_words END AS repeat_share,
         CASE WHEN n_words = 0 THEN 0 ELSE n_stop / n_words END AS stop_share,
         CASE WHEN n_lines = 0 THEN 0 ELSE n_dup_lines / n_lines END AS dup_line_share,
         CASE WHEN n_letters = 0 THEN 0 ELSE n_upper / n_letters END AS upper_share,
         n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {rules} AS kept
FROM s
"""


SQL = _sql()
