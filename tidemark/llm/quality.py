"""Line-first cleaning of documents.

Every line with a word is judged by itself and goes if one rule fails:

* *symbols*: more than ``symbols_per_word`` characters of ``#*$%&|<>!{}\\^~`` per word;
* *navigation*: three separators (``|``, ``»``, ``›``, ``•``, ``·``) or more;
* *boilerplate*: a short line with a stock phrase (licence, cookies, scripts,
  rights, terms);
* *punctuation*: no sentence ends in it (closing quotes and brackets allowed)
  although it has ``open_words`` words or more.

The document is then rejected if more than ``max_lost`` of its word characters
went with the lines, or if the base rule fails: under 50 words, or more than half
of the words inside 3-word windows that the text holds twice or more.

DataFrame functions only: lines and words are arrays, and a document never
leaves its row.  Windows are compared by 64-bit hashes within one document.

Rules: null text is empty (no words: the base rule fails); rows that repeat are
judged each; extra columns pass through, one named like an output is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
LINE_SYMBOLS = r"#*$%&|<>!{}\^~"
SEPARATORS = "|»›•·"
STOCK = (r"(?i)all rights reserved|licen[sc]ed? under|public license|privacy policy|terms of (use|service)|cookie"
         r"|enable javascript|copyright|©|subscribe to|click here|sign (in|up)|log ?in")
SENTENCE_END = r"""[.!?…。！？]["'”’»)\]]*([\x20\x09-\x0D]|$)|[:;,][\x20\x09-\x0D]*$"""
OUTPUTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_lines_failed",
           "base_failed", "kept", "clean_text")


def _chars(c: Column, letters: str) -> Column:
    """How many characters of ``c`` are among ``letters``."""
    return F.length(c) - F.length(F.translate(c, letters, ""))


def _word_chars(c: Column) -> Column:
    return F.length(F.translate(c, SPACES, ""))


def line_fails(line: Column, symbols_per_word: float, open_words: int, stock_chars: int) -> Column:
    """True where a line with a word breaks a rule."""
    words = F.regexp_count(line, F.lit(WORD))
    return ((_chars(line, LINE_SYMBOLS) > symbols_per_word * words)
            | (_chars(line, SEPARATORS) >= 3)
            | ((F.length(line) <= stock_chars) & line.rlike(STOCK))
            | (~line.rlike(SENTENCE_END) & (words >= open_words)))


def word_windows(words: Column) -> Column:
    """Hashes of the 3-word windows of the array ``words``; null under three words."""
    n = F.size(words)
    h = F.transform(words, lambda w: F.xxhash64(w))
    pairs = F.zip_with(F.slice(h, 1, n - 1), F.slice(h, 2, n - 1), lambda a, b: F.xxhash64(a, b))
    return F.when(n >= 3, F.zip_with(F.slice(pairs, 1, n - 2), F.slice(h, 3, n - 2), lambda a, b: F.xxhash64(a, b)))


def repeat_words(windows: Column) -> Column:
    """Words inside windows that come twice or more."""
    n = F.size(windows)
    order = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    hits = F.zip_with(order, F.slice(order, 2, n), lambda a, b: F.when(a.h == b.h, F.array(a.i, b.i)))
    starts = F.sort_array(F.array_distinct(F.flatten(F.filter(hits, lambda x: x.isNotNull()))))
    # a window adds its words up to where the next one starts
    added = F.aggregate(starts, F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last")),
                        lambda acc, s: F.struct((acc.n + F.least(F.lit(3), s - acc.last)).cast("long").alias("n"), s.alias("last")))
    some = windows.isNotNull() & (F.size(F.array_distinct(windows)) < n)
    return F.when(some, added.n).otherwise(F.lit(0).cast("long"))


def clean_lines(docs: DataFrame, symbols_per_word: float = 0.5, open_words: int = 4, stock_chars: int = 200,
                max_lost: float = 0.5, min_words: int = 50) -> DataFrame:
    """``docs`` (text, ...) with the columns of OUTPUTS; clean_text is the text without failed lines."""
    docs = docs.drop(*[c for c in (*OUTPUTS, "_text", "_words", "_windows", "_lines", "_good") if c in docs.columns])
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    has_word = lambda x: x.rlike(WORD)
    out = docs.withColumn("_text", text)
    out = out.withColumns({"_words": F.regexp_extract_all("_text", F.lit(WORD), F.lit(0)), "_lines": F.split("_text", "\n")})
    out = out.withColumns({
        "_windows": word_windows(F.col("_words")),
        "n_words": F.size("_words").cast("long"),
        "_good": F.filter("_lines", lambda x: ~has_word(x) | ~line_fails(x, symbols_per_word, open_words, stock_chars)),
        "_lines": F.filter("_lines", has_word)})
    out = out.withColumns({
        "word_chars": _word_chars(F.col("_text")).cast("long"),
        "n_symbols": _chars(F.col("_text"), SYMBOLS).cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": repeat_words(F.col("_windows")),
        "n_lines": F.size("_lines").cast("long"),
        "n_lines_failed": (F.size("_lines") - F.size(F.filter("_good", has_word))).cast("long"),
        "clean_text": F.array_join("_good", "\n")})
    out = out.withColumn("base_failed", (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    left = _word_chars(F.col("clean_text"))
    out = out.withColumn("kept", ~F.col("base_failed") & (left >= (1 - max_lost) * F.col("word_chars")))
    return out.drop("_text", "_words", "_windows", "_lines", "_good")
