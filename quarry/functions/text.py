"""Text column expressions. All run inside the JVM (no Python per row)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values ---------------------------------------------------------
# Spark's default English stop-word list (StopWordsRemover.loadDefaultStopWords("english")),
# 181 words, in the order Spark ships them.
ENGLISH_STOP_WORDS = tuple(
    """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself
she her hers herself it its itself they them their theirs themselves what which who whom
this that these those am is are was were be been being have has had having do does did
doing a an the and but if or because as until while of at by for with about against
between into through during before after above below to from up down in out on off over
under again further then once here there when where why how all any both each few more
most other some such no nor not only own same so than too very s t can will just don
should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd they'd i'm
you're he's she's it's we're they're i've we've you've they've isn't aren't wasn't
weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't
mustn't can't couldn't cannot could here's how's let's ought that's there's what's
when's where's who's why's would
""".split()
)

# Whitespace as Java's ASCII \s: space, tab, newline, vertical tab, form feed, return.
WS_CLASS = r" \t\n\x0B\f\r"
# Characters the cleanser removes: everything but ASCII word characters and whitespace.
NON_WORD = r"[^0-9A-Za-z_" + WS_CLASS + r"]"
WS_RUN = r"[" + WS_CLASS + r"]{2,}"
WS_ONE = r"[" + WS_CLASS + r"]"
WS_SPLIT = r"[" + WS_CLASS + r"]+"
# Line break of a request or document body.
LINE_BREAK = r"\r?\n"
# The same classes in Java regex syntax, as Spark runs them. Without UNICODE_CHARACTER_CLASS,
# Java's \w is [a-zA-Z_0-9] and \s is [ \t\n\x0B\f\r], so these equal the explicit classes
# above (kept for engines whose \s differs) and run several times faster. Removing runs of
# non-word characters at once gives the same text as removing them one by one.
J_NON_WORD = r"[^\w\s]+"
J_WS_RUN = r"\s{2,}"
J_WS_ONE = r"\s"
J_WS_SPLIT = r"\s+"
# --------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lines(text) -> Column:
    """Split a text into its lines (``\\r?\\n``)."""
    return F.split(_c(text), LINE_BREAK)


def nonempty_multiword_lines(text) -> Column:
    """Lines that are not empty and contain a space, in order (reader filters)."""
    return F.filter(lines(text), lambda l: (l != F.lit("")) & l.contains(" "))


def cleanse(c) -> Column:
    """Trim spaces, drop every non-word non-space character, collapse whitespace runs."""
    return F.regexp_replace(F.regexp_replace(F.trim(_c(c)), J_NON_WORD, ""), J_WS_RUN, " ")


def tokens(c) -> Column:
    """Lower-case and split on single whitespace characters; empty tokens are dropped."""
    return F.filter(F.split(F.lower(_c(c)), J_WS_ONE), lambda w: w != F.lit(""))


def clean_tokens(c, stop_words=ENGLISH_STOP_WORDS) -> Column:
    """``drop_stop_words(tokens(cleanse(c)))`` in one regex pass and one split.

    Trimming and collapsing whitespace only change how many empty tokens a split
    yields, and empty tokens are dropped, so they are skipped here. Lower-casing
    comes after the removal of non-ASCII characters, as in the full chain.
    """
    parts = F.split(F.lower(F.regexp_replace(_c(c), J_NON_WORD, "")), J_WS_SPLIT)
    if stop_words:
        ws = sorted({w.lower() for w in stop_words})
        return F.filter(parts, lambda w: (w != F.lit("")) & ~w.isin(ws))
    return F.filter(parts, lambda w: w != F.lit(""))


def document_tokens(text, stop_words=ENGLISH_STOP_WORDS, multiword_lines: bool = False) -> Column:
    """All clean tokens of a text, in order, with one regex pass per text.

    ``multiword_lines`` leaves out the lines without a space, as the labelled-text reader does.

    Tokens never span a line break (it is whitespace), so joining the kept lines
    and tokenizing once equals tokenizing line by line.
    """
    body = F.array_join(nonempty_multiword_lines(text), "\n") if multiword_lines else _c(text)
    return clean_tokens(body, stop_words)


def drop_stop_words(arr, words=ENGLISH_STOP_WORDS) -> Column:
    """Remove stop words from a token array, keeping order and duplicates.

    Tokens are compared in lower case. More than ten literals turn ``isin`` into a
    hash-set lookup (Catalyst ``InSet``).
    """
    ws = sorted({w.lower() for w in words})
    return F.filter(_c(arr), lambda w: ~F.lower(w).isin(ws))


def s_stem(w) -> Column:
    """Plural 's' stemmer (Harman 1991) as a column expression.

    ies -> y (not after e or a); es -> e (not after a, e or o); s -> '' (not after u or s).
    """
    w = _c(w)
    n = F.length(w)
    return (
        F.when(w.endswith("ies") & ~w.endswith("eies") & ~w.endswith("aies"),
               F.concat(w.substr(F.lit(1), n - 3), F.lit("y")))
        .when(w.endswith("es") & ~w.endswith("aes") & ~w.endswith("ees") & ~w.endswith("oes"),
              w.substr(F.lit(1), n - 1))
        .when(w.endswith("s") & ~w.endswith("us") & ~w.endswith("ss"), w.substr(F.lit(1), n - 1))
        .otherwise(w)
    )


def ngrams(arr, n: int = 2) -> Column:
    """Word n-grams joined by a space (empty when fewer than ``n`` words).

    Built from ``zip_with`` over shifted copies so the word array is read a fixed
    number of times, not once per position.
    """
    a = _c(arr)
    grams = a
    for k in range(1, n):
        grams = F.zip_with(grams, F.slice(a, k + 1, 1 << 30), lambda x, y: F.concat_ws(" ", x, y))
    keep = F.greatest(F.size(a) - F.lit(n - 1), F.lit(0))
    return F.slice(grams, 1, keep)
