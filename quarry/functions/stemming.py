"""English Snowball ("Porter2") stemming as column expressions, from the published algorithm.

Each step is an expression of a word and its two regions. Steps use their input many
times, so they are never nested into one another: a table of words goes through one
projection a step (``stem_projection``), and inside arrays a step's result is bound by a
one-element ``transform`` (``stem``). Both stay in the JVM.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values of the algorithm ---------------------------------------------
R1_PREFIXES = ("gener", "commun", "arsen")
EXCEPTIONS = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli",
    "singly": "singl", "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas",
    "cosmos": "cosmos", "bias": "bias", "andes": "andes",
}
AFTER_1A = ("inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed")
STEP2 = [
    ("ization", "ize"), ("ational", "ate"), ("fulness", "ful"), ("ousness", "ous"), ("iveness", "ive"),
    ("tional", "tion"), ("biliti", "ble"), ("lessli", "less"), ("entli", "ent"), ("ation", "ate"),
    ("alism", "al"), ("aliti", "al"), ("ousli", "ous"), ("iviti", "ive"), ("fulli", "ful"),
    ("enci", "ence"), ("anci", "ance"), ("abli", "able"), ("izer", "ize"), ("ator", "ate"),
    ("alli", "al"), ("bli", "ble"), ("ogi", "og"), ("li", ""),
]
STEP3 = [
    ("ational", "ate"), ("tional", "tion"), ("alize", "al"), ("icate", "ic"), ("iciti", "ic"),
    ("ative", ""), ("ical", "ic"), ("ness", ""), ("ful", ""),
]
STEP4 = ["ement", "ance", "ence", "able", "ible", "ment", "ant", "ent", "ism", "ate", "iti", "ous",
         "ive", "ize", "ion", "al", "er", "ic"]
FIRST_REGION = "^[^aeiouy]*[aeiouy]+[^aeiouy]"
SHORT_END = "(^[aeiouy][^aeiouy]$)|([^aeiouy][aeiouy][^aeiouywxY]$)"
DOUBLE_END = "(bb|dd|ff|gg|mm|nn|pp|rr|tt)$"
# ------------------------------------------------------------------------------


def _cut(w: Column, n: int, add: str = "") -> Column:
    """``w`` without its last ``n`` letters, and ``add``."""
    left = w.substr(F.lit(1), F.length(w) - n)
    return F.concat(left, F.lit(add)) if add else left


def _from(w: Column, n: int, r: Column) -> Column:
    """Whether a suffix of ``n`` letters lies in the region that starts after ``r`` letters."""
    return F.length(w) - n >= r


def marked(word: Column) -> Column:
    """Without a leading apostrophe, with ``Y`` for a ``y`` that stands first or after a vowel."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(word, "^'", ""), "^y", "Y"), "([aeiouy])y", "$1Y")


def _region(w: Column, start: Column) -> Column:
    found = F.length(F.regexp_extract(w.substr(start + 1, F.length(w)), f"({FIRST_REGION})", 1))
    return F.when(found > 0, start + found).otherwise(F.length(w))


def region1(w: Column) -> Column:
    found = F.length(F.regexp_extract(w, f"^({'|'.join(R1_PREFIXES)})", 1))
    return F.when(found > 0, found).otherwise(_region(w, F.lit(0)))


def region2(w: Column, r1: Column) -> Column:
    return _region(w, r1)


def _step0(w: Column, r1: Column, r2: Column) -> Column:
    return F.regexp_replace(w, "('s'|'s|')$", "")


def _step1a(w: Column, r1: Column, r2: Column) -> Column:
    return (F.when(w.endswith("sses"), _cut(w, 2))
            .when(w.endswith("ied") | w.endswith("ies"), F.when(F.length(w) > 4, _cut(w, 2)).otherwise(_cut(w, 1)))
            .when(w.endswith("us") | w.endswith("ss"), w)
            .when(w.rlike("[aeiouy].+s$"), _cut(w, 1)).otherwise(w))


def _step1b_cut(w: Column, r1: Column, r2: Column) -> Column:
    """The word after its -ed or -ing is off, marked by a trailing ``~`` for the repairs of the next step."""
    stem = F.regexp_extract(w, "^(.*[aeiouy].*)(?:ingly|edly|ing|ed)$", 1)
    return (F.when(w.endswith("eedly"), F.when(_from(w, 5, r1), _cut(w, 5, "ee")).otherwise(w))
            .when(w.endswith("eed"), F.when(_from(w, 3, r1), _cut(w, 3, "ee")).otherwise(w))
            .when(stem != "", F.concat(stem, F.lit("~"))).otherwise(w))


def _step1b_repair(w: Column, r1: Column, r2: Column) -> Column:
    s = _cut(w, 1)
    short = (r1 >= F.length(w) - 1) & s.rlike(SHORT_END)
    return (F.when(~w.endswith("~"), w).when(s.rlike("(at|bl|iz)$"), F.concat(s, F.lit("e")))
            .when(s.rlike(DOUBLE_END), _cut(w, 2)).when(short, F.concat(s, F.lit("e"))).otherwise(s))


def _step1c(w: Column, r1: Column, r2: Column) -> Column:
    return F.regexp_replace(w, "^(.+[^aeiouy])[yY]$", "$1i")


def _first_suffix(w: Column, rules: list[tuple[str, Column, str]]) -> Column:
    """The first suffix that the word ends with decides: replaced if its condition holds."""
    out = None
    for suffix, holds, new in rules:
        then = F.when(holds, _cut(w, len(suffix), new)).otherwise(w)
        out = F.when(w.endswith(suffix), then) if out is None else out.when(w.endswith(suffix), then)
    return out.otherwise(w)


def _step2(w: Column, r1: Column, r2: Column) -> Column:
    more = {"ogi": w.endswith("logi"), "li": w.rlike("[cdeghkmnrt]li$")}
    return _first_suffix(w, [(s, _from(w, len(s), r1) & more.get(s, F.lit(True)), new) for s, new in STEP2])


def _step3(w: Column, r1: Column, r2: Column) -> Column:
    return _first_suffix(w, [(s, _from(w, len(s), r2 if s == "ative" else r1), new) for s, new in STEP3])


def _step4(w: Column, r1: Column, r2: Column) -> Column:
    more = {"ion": w.rlike("[st]ion$")}
    return _first_suffix(w, [(s, _from(w, len(s), r2) & more.get(s, F.lit(True)), "") for s in STEP4])


def _step5(w: Column, r1: Column, r2: Column) -> Column:
    e = _from(w, 1, r2) | (_from(w, 1, r1) & ~_cut(w, 1).rlike(SHORT_END))
    return F.when(w.endswith("e"), F.when(e, _cut(w, 1)).otherwise(w)).when(w.endswith("ll") & _from(w, 1, r2), _cut(w, 1)).otherwise(w)


BEFORE, AFTER = (_step0, _step1a), (_step1b_cut, _step1b_repair, _step1c, _step2, _step3, _step4, _step5)


def _whole(word: Column, early: Column, late: Column) -> Column:
    """The stem, given the word after step 1a and after the last step."""
    known = F.create_map(*[F.lit(x) for kv in EXCEPTIONS.items() for x in kv])
    return (F.when(F.length(word) <= 2, word).when(word.isin(list(EXCEPTIONS)), F.try_element_at(known, word))
            .when(early.isin(list(AFTER_1A)), early).otherwise(F.translate(late, "Y", "y")))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    return F.transform(F.array(value), body)[0]


def stem(word: Column) -> Column:
    """The stem of a lower-case English word; inside arrays or as a plain column."""
    def run(w: Column, r1: Column, r2: Column, steps: tuple, end: Callable[[Column], Column]) -> Column:
        return _let(steps[0](w, r1, r2), lambda x: run(x, r1, r2, steps[1:], end)) if steps else end(w)

    def of(w: Column) -> Column:
        return _let(region1(w), lambda r1: _let(region2(w, r1), lambda r2: run(
            w, r1, r2, BEFORE, lambda early: run(early, r1, r2, AFTER, lambda late: _whole(word, early, late)))))
    return _let(marked(word), of)


def stem_projection(df: DataFrame, word: str, out: str) -> DataFrame:
    """``df`` with the stem of ``word`` as ``out``: a projection a step, within generated code."""
    keep = [c for c in df.columns if c != out]
    d = df.select(*keep, marked(F.col(word)).alias("_w"))
    d = d.withColumn("_r1", region1(F.col("_w")))
    d = d.withColumn("_r2", region2(F.col("_w"), F.col("_r1")))
    for step in BEFORE:
        d = d.withColumn("_w", step(F.col("_w"), F.col("_r1"), F.col("_r2")))
    d = d.withColumn("_early", F.col("_w"))
    for step in AFTER:
        d = d.withColumn("_w", step(F.col("_w"), F.col("_r1"), F.col("_r2")))
    return d.select(*keep, _whole(F.col(word), F.col("_early"), F.col("_w")).alias(out))
