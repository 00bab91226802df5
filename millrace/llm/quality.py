"""Line-first quality rules, in built-in functions only.

Each line is judged by punctuation, navigation and boilerplate rules, failing lines
are removed, and a document that loses too much of its text is rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import SPACES, WORD, word_array, word_count

SYMBOLS = r"[#*$%&|<>]"
# Phrases of page furniture, lower case.
BOILERPLATE = (
    "all rights reserved", "cookie policy", "privacy policy", "terms of use", "terms of service", "javascript",
    "click here", "read more", "sign in", "log in", "subscribe", "lorem ipsum", "skip to content",
)
FEWEST_WORDS = 10
MOST_REPEATED_PERCENT = 20
WINDOW = 5
# A document is rejected if lines with more than this part of its words fail.
MOST_LOST = 0.3
_RULE_CHARACTER = SYMBOLS + r"|[{}\\_=~^]"
_SHORT = 160


def failing_line(line: Column) -> Column:
    """Whether a line fails: NULL never comes in, blank lines pass.

    Navigation: separators (``| > » ·``) make up a fourth of the words. Punctuation: in
    a line of several words a third end in doubled marks, or a tenth of the letters are
    rule characters. Shouting: five words or more without a small letter. Boilerplate: a
    short line with one of ``BOILERPLATE``. Cheap tests come first, as nearly every line
    of prose fails these.
    """
    words = F.regexp_count(line, F.lit(WORD))
    separators = F.regexp_count(line, F.lit(r"(?<!\S)[|>»·•](?!\S)"))
    marks = F.regexp_count(line, F.lit(r"(?:[!?]{2,}|" + SYMBOLS + r"{2,})(?!\S)"))
    symbols = F.regexp_count(line, F.lit(_RULE_CHARACTER))
    odd = line.rlike(r"[!?]{2}|[»·•]|" + _RULE_CHARACTER)
    navigation = (separators > 0) & (separators * 4 >= words)
    punctuation = (symbols * 10 > F.length(line)) | ((marks > 0) & (marks * 3 >= words) & (words >= 3))
    shouted = (line == F.upper(line)) & (line != F.lower(line)) & (words >= 5)
    furniture = (F.length(line) <= _SHORT) & F.lower(line).rlike("|".join(BOILERPLATE)) & (words <= 12)
    return (odd & (navigation | punctuation)) | shouted | furniture


def _repeated_words(words: Column, hashes: Column) -> Column:
    """Words inside windows whose hash comes at least twice.

    Sorted by (hash, place), equal windows are neighbours. The places of repeated
    windows, sorted again, each cover up to WINDOW words, less where the next is near.
    """
    size = F.size(hashes)
    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def repeated(pairs: Column) -> Column:
        def same(i: Column, j: Column) -> Column:
            return F.coalesce(F.get(pairs, i)["h"] == F.get(pairs, j)["h"], F.lit(False))

        found = F.filter(F.sequence(F.lit(0), size - 1), lambda i: same(i, i - 1) | same(i, i + 1))
        return F.sort_array(F.transform(found, lambda i: F.get(pairs, i)["i"]))

    def covered(places: Column) -> Column:
        gaps = F.transform(
            places, lambda p, i: F.least(F.coalesce(F.get(places, i + 1) - p, F.lit(WINDOW)), F.lit(WINDOW))
        )
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda total, gap: total + gap)

    # transform over a one-element array binds a value once, as a let would.
    places = F.transform(F.array(pairs), repeated)
    return F.transform(places, covered)[0]


def line_rules(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``df``: key, counts of words and repeats, ``base_failed``, ``kept``, ``cleaned``.

    ``cleaned`` is the text without its failing lines (NULL for NULL). NULL and empty
    texts have no words and fail. Rows with the same key are judged each for itself;
    other columns are ignored. Repeats are found by a 64-bit hash of five words.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    split = df.select(
        F.col(key).alias("key"), F.col(text).alias("text"), word_array(F.col(text)).alias("words"),
        F.split(body, "\n").alias("lines"),
    )
    word = F.col("words")
    starts = F.greatest(F.size("words") - (WINDOW - 1), F.lit(0))
    windows = F.transform(F.arrays_zip(*[F.slice(word, k + 1, starts) for k in range(WINDOW)]), lambda w: F.xxhash64(w))
    hashed = split.select(
        "*",
        F.size("words").cast("long").alias("n_words"),
        windows.alias("hashes"),
        F.filter("lines", lambda line: line.rlike(WORD)).alias("full"),
    )
    hashes = F.col("hashes")
    repeated = F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long"))
    failing = F.filter("full", failing_line)
    counted = hashed.select(
        "key", "text", "n_words", "lines", "full",
        F.length(F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), SPACES, "")).cast("long").alias("word_chars"),
        F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("full") - F.size(F.array_distinct("full"))).cast("long").alias("n_dup_lines"),
        repeated.otherwise(_repeated_words(word, hashes)).alias("n_repeat_words"),
        F.array_join(failing, "\n").alias("lost"),
    )
    failed = (F.col("n_words") < FEWEST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    )
    counted = counted.select("*", word_count(F.col("lost")).alias("n_lost_words"), failed.alias("base_failed"))
    cleaned = F.when(F.col("n_lost_words") == 0, F.col("text")).otherwise(
        F.array_join(F.filter("lines", lambda line: ~failing_line(line)), "\n")
    )
    kept = ~F.col("base_failed") & (F.col("n_lost_words") <= MOST_LOST * F.col("n_words"))
    return counted.select(
        F.col("key").alias(key), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", kept.alias("kept"), "n_lost_words", cleaned.alias("cleaned"),
    )
