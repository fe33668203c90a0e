"""Quality rules: a table of thresholds compiled into one Spark projection, without user functions.

Metrics are SQL expressions over a text and its words and lines; a rule bounds one metric from below and above; a text is
kept if it passes the base rules and every rule of the table. Stop-word rules hold only where enough words were seen.

Defined results: a null text has no words and fails the base rules, like an empty one; rows, null ids and repeated rows pass
through one for one; extra columns do not matter; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, WORD

# Frequent function words of the languages at hand.
STOP_WORDS = {
    "en": "the of and to in a is that it for on with as at by from",
    "fr": "le la les de des du et en un une que qui dans pour par sur",
    "de": "der die das und in den von zu mit sich des auf ist im dem nicht",
    "es": "el la los las de del y en que un una por con para se lo",
}
SYMBOLS = "#*$%&|<>"
MIN_WORDS, REPEAT_PERCENT = 50, 50
INDEX_BITS = 20  # of a packed window: texts of more words, or whose shortened hashes clash, sort (hash, place) pairs


@dataclass(frozen=True)
class Rule:
    name: str
    metric: str
    least: float | None = None
    most: float | None = None


RULES = (
    Rule("mean_word_length", "word_chars / n_words", 2.0, 12.0),
    Rule("symbols_per_word", "n_symbols / n_words", None, 0.1),
    Rule("duplicate_lines", "n_dup_lines / n_lines", None, 0.3),
    Rule("repeated_words", "n_repeat_words / n_words", None, 0.5),
    Rule("stop_words", "n_stop_words / n_words", 0.03, None),
    Rule("shouting", "n_marks / n_words", None, 0.5),
)


def measures(text: str) -> dict[str, str]:
    """SQL of the base columns, each over the ones before it (the first three are arrays and go away)."""
    stops = ", ".join(f"'{w}'" for w in sorted({w for ws in STOP_WORDS.values() for w in ws.split()}))
    space = SPACE.replace("\\", "\\\\")
    mask = (1 << INDEX_BITS) - 1
    return {
        "words": f"filter(split({text}, '[{space}]+'), w -> w <> '')",
        "lines": f"filter(split({text}, '\\n'), l -> l rlike '[^{space}]')",
        "grams": "transform(slice(words, 1, greatest(size(words) - 2, 0)), (w, i) -> xxhash64(w, words[i + 1], words[i + 2]))",
        "n_words": "size(words)",
        "word_chars": "length(array_join(words, ''))",
        "n_lines": "size(lines)",
        "n_dup_lines": "size(lines) - size(array_distinct(lines))",
        "n_symbols": f"length({text}) - length(translate({text}, '{SYMBOLS}', ''))",
        "n_marks": f"length({text}) - length(translate({text}, '!', ''))",
        "n_stop_words": f"size(filter(words, w -> lower(w) in ({stops})))",
        # A window that is found twice shares its hash with a neighbour in sorted order; the low bits tell where it was.
        "packed": f"if(size(array_distinct(grams)) = size(grams), array(), sort_array(transform(grams, (g, i) -> (g & {~mask}) | i)))",
        "clash": f"size(grams) > {mask} or size(packed) > 0 and size(array_distinct(transform(packed, p -> p & {~mask}))) <> size(array_distinct(grams))",
        "pairs": "if(clash, sort_array(transform(grams, (g, i) -> struct(g as g, i as i))), array())",
        "found": "if(clash, "
        "filter(transform(pairs, (p, i) -> if(p.g = pairs[greatest(i - 1, 0)].g and i > 0 or p.g = pairs[least(i + 1, size(pairs) - 1)].g and i + 1 < size(pairs), cast(p.i as bigint), -1L)), p -> p >= 0), "
        f"filter(transform(packed, (p, i) -> if((p & {~mask}) = (packed[greatest(i - 1, 0)] & {~mask}) and i > 0 or (p & {~mask}) = (packed[least(i + 1, size(packed) - 1)] & {~mask}) and i + 1 < size(packed), p & {mask}, -1L)), p -> p >= 0))",
        "n_repeat_words": "if(size(found) = 0, 0, size(array_distinct(flatten(transform(found, p -> array(p, p + 1, p + 2))))))",
    }


def verdict(rules: tuple[Rule, ...]) -> Column:
    """True where every rule holds. A metric without a value (nothing to divide by) breaks no rule."""
    out = F.lit(True)
    for r in rules:
        over, under = r.metric.split(" / ")
        value = F.try_divide(F.col(over).cast("double"), F.col(under).cast("double"))
        for bound, holds in ((r.least, lambda v, b: v >= b), (r.most, lambda v, b: v <= b)):
            if bound is not None:
                out = out & F.coalesce(holds(value, F.lit(bound)), F.lit(True))
    return out


def rule_report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, ..., base_failed, kept): one row for each row."""
    out = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    todo = measures("text")
    arrays = {k: F.expr(todo[k]) for k in ("words", "lines")}
    out = out.select("id", "text", *[v.alias(k) for k, v in arrays.items()])
    out = out.select("*", F.expr(todo["grams"]).alias("grams"))
    long = lambda k: F.expr(todo[k]).cast("long").alias(k)
    out = out.select("id", "grams", *[long(k) for k in ("n_words", "word_chars", "n_lines", "n_dup_lines", "n_symbols", "n_marks", "n_stop_words")], F.expr(todo["packed"]).alias("packed"))
    out = out.select("*", F.expr(todo["clash"]).alias("clash"))
    out = out.select("*", F.expr(todo["pairs"]).alias("pairs"))
    out = out.select("*", F.expr(todo["found"]).alias("found"))
    out = out.select("id", "n_words", "word_chars", "n_lines", "n_dup_lines", "n_symbols", "n_marks", "n_stop_words", long("n_repeat_words"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    return out.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & verdict(rules))
