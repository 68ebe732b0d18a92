"""Quality rules: a table of thresholds compiled into one projection of ratios, without user functions.

Every rule bounds one ratio of a text.  ``compile_rules`` turns the table into a column that holds the names of the broken rules,
so a rule can be changed or added without touching a plan.

Defined results: null text has no words and fails the base rules, as empty texts do; the windows of repeated words never cross
texts; texts of any length are counted whole; null and repeated ids are kept as they are, one row out for each row in; extra
columns are ignored whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = "\t\n\x0b\x0c\r "
SYMBOLS = "#*$%&|<>"
MARKS = ".,;:!?()\"'"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Frequent function words of the languages the rules are meant for.
STOP_WORDS = {
    "en": "the of and to in is that it was for on are as with be by this from or an at have not".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es".split(),
    "fr": "de la le et les des en un du une que est pour qui dans par plus pas au sur avec ne se".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al lo como".split(),
}
#: (rule, ratio, least, most); None leaves a side open.
RULES = (
    ("length", "n_words", 50, 100_000),
    ("word length", "chars_per_word", 2, 12),
    ("symbols", "symbols_per_word", None, 0.1),
    ("stop words", "stop_word_share", 0.05, None),
    ("repeated lines", "dup_line_share", None, 0.5),
)


def counts(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id and base counts of each text, in one pass without a shuffle.

    The row comes out of a generator: a filter on the counts or the verdict stays above it.  Below, the optimiser would put the
    definitions of ``words`` and ``sorted`` inside the lambdas that read them, to be computed again for every word.
    """
    given = documents.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    stop = sorted({w for words in STOP_WORDS.values() for w in words})
    bare = F.btrim("text", F.lit(SPACES))
    cut = given.select(
        "doc_id", "text",
        F.when(bare == "", F.expr("cast(array() as array<string>)")).otherwise(F.split(bare, r"[\x20\x09-\x0D]+")).alias("words"),
        F.filter(F.split("text", "\n"), lambda line: F.btrim(line, F.lit(SPACES)) != "").alias("lines"),
    )
    window = F.transform(
        F.sequence(F.lit(0), F.size("words") - 3),
        lambda i: F.struct(F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)).alias("h"), i.alias("i")))
    nothing = F.expr("cast(array() as array<struct<h:bigint,i:int>>)")
    plain = F.length(F.translate("text", SPACES, ""))
    counted = cut.select(
        "doc_id", F.size("words").cast("long").alias("n_words"), plain.cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("words", lambda w: F.translate(w, UPPER + MARKS, LOWER).isin(stop))).cast("long").alias("n_stop_words"),
        F.when(F.size("words") < 3, nothing).otherwise(F.sort_array(window)).alias("sorted"),
    )
    same = lambda k, j: F.coalesce(F.get("sorted", k)["h"] == F.get("sorted", j)["h"], F.lit(False))
    repeated = F.filter(F.sequence(F.lit(0), F.size("sorted") - 1), lambda k: same(k, k - 1) | same(k, k + 1))
    found = counted.withColumn(
        "starts", F.when(F.size("sorted") < 2, F.expr("cast(array() as array<int>)"))
        .otherwise(F.sort_array(F.transform(repeated, lambda k: F.get("sorted", k)["i"]))))
    covered = F.aggregate(
        "starts", F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda a, i: F.struct((i + 3).alias("end"), (a["n"] + i + 3 - F.greatest(i, a["end"])).alias("n")), lambda a: a["n"])
    row = F.struct(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", covered.cast("long").alias("n_repeat_words"),
        "n_lines", "n_stop_words")
    return found.select(F.inline(F.array(row)))


def ratios() -> dict[str, Column]:
    words, lines = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("n_lines"), F.lit(1))
    return {
        "n_words": F.col("n_words"), "chars_per_word": F.col("word_chars") / words, "symbols_per_word": F.col("n_symbols") / words,
        "stop_word_share": F.col("n_stop_words") / words, "dup_line_share": F.col("n_dup_lines") / lines,
    }


def compile_rules(rules=RULES) -> Column:
    """Names of the rules a row of counts breaks."""
    of, broken = ratios(), []
    for name, ratio, least, most in rules:
        low = of[ratio] < F.lit(least) if least is not None else F.lit(False)
        high = of[ratio] > F.lit(most) if most is not None else F.lit(False)
        broken.append(F.when(low | high, F.lit(name)))
    return F.array_compact(F.array(*broken))


def op6_quality_rules(documents: DataFrame) -> DataFrame:
    """Base counts, base verdict and verdict of the rule table for each document."""
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return counts(documents).withColumn("broken", compile_rules()).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base_failed.alias("base_failed"),
        (~base_failed & (F.size("broken") == 0)).alias("kept"))


def op6_sql() -> str:
    """The same for DuckDB."""
    stop = ", ".join(f"'{w}'" for w in sorted({w for words in STOP_WORDS.values() for w in words}))
    marks = MARKS.replace("'", "''")
    ratio = {
        "n_words": "n_words", "chars_per_word": "word_chars / greatest(n_words, 1)",
        "symbols_per_word": "n_symbols / greatest(n_words, 1)", "stop_word_share": "n_stop_words / greatest(n_words, 1)",
        "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    }
    sides = [f"{ratio[r]} >= {least}" for _, r, least, _ in RULES if least is not None]
    sides += [f"{ratio[r]} <= {most}" for _, r, _, most in RULES if most is not None]
    return rf"""
WITH given AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
cut AS (SELECT r, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM given),
spot AS (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM cut),
windows AS (SELECT r, i, count(*) OVER (PARTITION BY r, words[i], words[i + 1], words[i + 2]) AS n FROM spot),
covered AS (SELECT r, count(DISTINCT i + k) AS n FROM windows, (SELECT unnest([0, 1, 2]) AS k) WHERE windows.n > 1 GROUP BY r),
counted AS (SELECT doc_id, len(words)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
  length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, len(lines) AS n_lines,
  (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
  len(list_filter(words, lambda w: translate(w, '{UPPER}{marks}', '{LOWER}') IN ({stop}))) AS n_stop_words,
  coalesce(covered.n, 0)::BIGINT AS n_repeat_words FROM cut LEFT JOIN covered USING (r)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND {" AND ".join(sides)} AS kept FROM judged"""
