"""Line-first cleaning: rules judge each line, failures go, and documents that lose too much go too.

SQL expressions on the row's own text only, so nothing is shuffled. Lines are
judged by the rules below; a document is kept when it passes the base counts and
enough of its characters stand in lines that passed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

# White space that separates words, and the symbols that are counted.
SPACE = r"[\x20\x09-\x0D]"
SPACES = " \t\n\u000b\u000c\r"
SYMBOLS = "#*$%&|<>"
# Phrases of page furniture, as whole words.
BOILERPLATE = (r"(?i)(^|[^\p{L}])(cookie (policy|settings)|privacy policy|terms (of (use|service)|and conditions)|"
               r"enable javascript|click here|read more|sign (in|up)|log ?in|subscribe (now|to)|"
               r"skip to (main )?content|share (this|on)|lorem ipsum)([^\p{L}]|$)")


@dataclass(frozen=True)
class Rules:
    """Limits of the line rules and of the verdict; percentages are of characters or words."""

    symbol_percent: int = 10          # punctuation: symbols and exclamation marks among the characters
    separators: int = 3               # navigation: so many bars or arrows between words …
    words_per_separator: int = 4      # … and at most so many words for each
    boilerplate_words: int = 25       # boilerplate: phrases count in lines up to this length
    kept_percent: int = 50            # documents keep this much of their characters or go
    least_words: int = 10             # base: fewer words fail
    repeat_percent: int = 20          # base: words in repeated windows among the words
    window: int = 5


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def line_fails(line: Column, rules: Rules) -> Column:
    """Whether a line with words is dropped; one without words never is."""
    solid = F.length(_without(line, SPACES))
    symbols = F.length(line) - F.length(_without(line, SYMBOLS + "!"))
    words = F.length(line) - solid + 1
    bars = F.length(line) - F.length(_without(line, "|»›•"))
    punctuation = symbols * 100 > solid * rules.symbol_percent
    navigation = (bars >= rules.separators) & (bars * rules.words_per_separator >= words)
    boilerplate = (words <= rules.boilerplate_words) & line.rlike(BOILERPLATE)
    return (solid > 0) & (punctuation | navigation | boilerplate)


def _repeat_words(window: int) -> Column:
    """Words in the runs that begin at the sorted places ``__repeated``: each run adds those
    that the one before it did not cover."""
    added = F.transform("__repeated", lambda p, k: F.when(k == 0, window).otherwise(
        F.least(F.lit(window), p - F.get("__repeated", k - 1))))
    return F.aggregate(added, F.lit(0), lambda total, n: total + n)


def judged(docs: DataFrame, text: str = "text", rules: Rules = Rules()) -> DataFrame:
    """Adds the base counts, ``base_failed``, ``clean_text`` (the lines that passed), ``kept``.

    Runs of words found more than once are neighbours when the hashes of all runs
    are sorted with their places; texts without any, nearly all, are told by the
    number of distinct hashes. A null text has no words, like an empty one: it
    fails, and its clean text is empty. A very long text is judged whole, by sorts within its row.
    Repeated rows are judged alike; no rows give no rows; no other
    column is read, and columns with the names of the added ones are replaced.
    """
    whole, w = F.coalesce(F.col(text), F.lit("")), rules.window
    out = (docs
           .withColumn("__words", F.array_remove(F.split(whole, SPACE + "+"), ""))
           .withColumn("__runs", F.when(F.size("__words") >= w, F.transform(
               F.sequence(F.lit(0), F.size("__words") - w),
               lambda i: F.xxhash64(*(F.get("__words", i + k) for k in range(w))))))
           .withColumn("__ranked", F.when(
               F.size(F.array_distinct("__runs")) < F.size("__runs"),
               F.sort_array(F.transform("__runs", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
           .withColumn("__repeated", F.sort_array(F.transform(
               F.filter("__ranked", lambda r, k: r["h"].eqNullSafe(F.get("__ranked", k - 1)["h"])
                        | r["h"].eqNullSafe(F.get("__ranked", k + 1)["h"])), lambda r: r["i"])))
           .withColumn("__lines", F.split(whole, "\n", -1))
           .withColumn("__filled", F.filter("__lines", lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
           .withColumn("clean_text", F.array_join(F.filter("__lines", lambda x: ~line_fails(x, rules)), "\n"))
           .withColumn("n_words", F.size("__words").cast("long"))
           .withColumn("word_chars", F.length(_without(whole, SPACES)).cast("long"))
           .withColumn("n_symbols", (F.length(whole) - F.length(_without(whole, SYMBOLS))).cast("long"))
           .withColumn("n_dup_lines", (F.size("__filled") - F.size(F.array_distinct("__filled"))).cast("long"))
           .withColumn("n_repeat_words", F.coalesce(_repeat_words(w), F.lit(0)).cast("long")))
    failed = (F.col("n_words") < rules.least_words) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * rules.repeat_percent)
    left = F.length(_without(F.col("clean_text"), SPACES))
    return (out.withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & (left * 100 >= F.col("word_chars") * rules.kept_percent))
            .drop("__words", "__runs", "__ranked", "__repeated", "__lines", "__filled"))
