"""DuckDB twins of the column expressions, for the oracle queries."""

from __future__ import annotations

from quarry.functions import stemming as st
from quarry.functions import text as tf


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


STOP_LIST = "[" + ", ".join(q(w) for w in sorted(set(tf.ENGLISH_STOP_WORDS))) + "]"


def kept_lines(text: str) -> str:
    return (f"list_filter(regexp_split_to_array({text}, {q(tf.LINE_BREAK)}), "
            f"lambda x: x <> '' AND contains(x, ' '))")


def cleanse(c: str) -> str:
    return (f"regexp_replace(regexp_replace(trim({c}), {q(tf.NON_WORD)}, '', 'g'), "
            f"{q(tf.WS_RUN)}, ' ', 'g')")


def tokens(c: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({c}), {q(tf.WS_ONE)}), lambda x: x <> '')"


def drop_stop(arr: str) -> str:
    return f"list_filter({arr}, lambda x: NOT list_contains({STOP_LIST}, x))"


def line_words(line: str) -> str:
    return drop_stop(tokens(cleanse(line)))


def s_stem(w: str) -> str:
    return (f"CASE WHEN suffix({w}, 'ies') AND NOT suffix({w}, 'eies') AND NOT suffix({w}, 'aies') "
            f"THEN left({w}, length({w}) - 3) || 'y' "
            f"WHEN suffix({w}, 'es') AND NOT suffix({w}, 'aes') AND NOT suffix({w}, 'ees') "
            f"AND NOT suffix({w}, 'oes') THEN left({w}, length({w}) - 1) "
            f"WHEN suffix({w}, 's') AND NOT suffix({w}, 'us') AND NOT suffix({w}, 'ss') "
            f"THEN left({w}, length({w}) - 1) ELSE {w} END")


def hash_bucket(expr: str, n: int) -> str:
    return f"((('0x' || substr(md5(CAST({expr} AS VARCHAR)), 1, 8))::BIGINT) % {n})"


def seeded_hash(expr: str, seed: int) -> str:
    return f"(('0x' || substr(md5('{seed}:' || coalesce(CAST({expr} AS VARCHAR), '')), 1, 8))::BIGINT)"


def below(expr: str, seed: int, share: float) -> str:
    return f"({seeded_hash(expr, seed)} < {round(share * (1 << 32))})"


# documents -> (doc_id, lang, line_no, line) for kept lines
DOC_LINES = f"""
SELECT doc_id, lang, source, unnest(generate_series(1, len(ls))) AS line_no, unnest(ls) AS line
FROM (SELECT doc_id, lang, source, {kept_lines('text')} AS ls FROM documents)
"""

# documents -> (doc_id, lang, line_no, word_pos, word) after cleanse/tokenize/stop words
DOC_WORDS = f"""
SELECT doc_id, lang, line_no, unnest(generate_series(1, len(ws))) AS word_pos, unnest(ws) AS word
FROM (SELECT doc_id, lang, line_no, {line_words('line')} AS ws FROM ({DOC_LINES}))
"""

# documents -> (doc_id, lang, word): all words of the whole text
DOC_BAG = f"""
SELECT doc_id, lang, unnest({line_words('text')}) AS word FROM documents
"""


def porter2(words: str) -> str:
    """CTEs up to ``stems`` (word, stem) for the relation ``words`` (word): a step each."""
    def cut(n, add=""):
        return f"left(w, length(w) - {n})" + (f" || {q(add)}" if add else "")

    def region(start):
        found = f"length(regexp_extract(substr(w, {start} + 1), {q('(' + st.FIRST_REGION + ')')}, 1))"
        return f"CASE WHEN {found} > 0 THEN {start} + {found} ELSE length(w) END"

    def first_suffix(rules):
        return "CASE " + " ".join(f"WHEN suffix(w, {q(s)}) THEN CASE WHEN {c} THEN {cut(len(s), new)} ELSE w END" for s, c, new in rules) + " ELSE w END"

    def inside(s, r):
        return f"length(w) - {len(s)} >= {r}"

    prefixes = q(f"^({'|'.join(st.R1_PREFIXES)})")
    two = {"ogi": " AND suffix(w, 'logi')", "li": " AND regexp_matches(w, '[cdeghkmnrt]li$')"}
    short, double, off, fix = q(st.SHORT_END), q(st.DOUBLE_END), q("^(.*[aeiouy].*)(ingly|edly|ing|ed)$"), "left(w, length(w) - 1)"
    steps = {
        "a0": f"regexp_replace(w, {q(chr(40) + chr(39) + 's' + chr(39) + '|' + chr(39) + 's|' + chr(39) + ')$')}, '')",
        "a1": f"CASE WHEN suffix(w, 'sses') THEN {cut(2)} WHEN suffix(w, 'ied') OR suffix(w, 'ies') THEN "
              f"CASE WHEN length(w) > 4 THEN {cut(2)} ELSE {cut(1)} END WHEN suffix(w, 'us') OR suffix(w, 'ss') THEN w "
              f"WHEN regexp_matches(w, '[aeiouy].+s$') THEN {cut(1)} ELSE w END",
        "b0": f"CASE WHEN suffix(w, 'eedly') THEN CASE WHEN length(w) - 5 >= r1 THEN {cut(5, 'ee')} ELSE w END "
              f"WHEN suffix(w, 'eed') THEN CASE WHEN length(w) - 3 >= r1 THEN {cut(3, 'ee')} ELSE w END "
              f"WHEN regexp_matches(w, {off}) THEN regexp_extract(w, {off}, 1) || '~' ELSE w END",
        "b1": f"CASE WHEN NOT suffix(w, '~') THEN w WHEN regexp_matches({fix}, '(at|bl|iz)$') THEN {fix} || 'e' "
              f"WHEN regexp_matches({fix}, {double}) THEN {cut(2)} "
              f"WHEN r1 >= length(w) - 1 AND regexp_matches({fix}, {short}) THEN {fix} || 'e' ELSE {fix} END",
        "c0": r"regexp_replace(w, '^(.+[^aeiouy])[yY]$', '\1i')",
        "c2": first_suffix([(s, inside(s, "r1") + two.get(s, ""), new) for s, new in st.STEP2]),
        "c3": first_suffix([(s, inside(s, "r2" if s == "ative" else "r1"), new) for s, new in st.STEP3]),
        "c4": first_suffix([(s, inside(s, "r2") + (" AND regexp_matches(w, '[st]ion$')" if s == "ion" else ""), "") for s in st.STEP4]),
        "c5": f"CASE WHEN suffix(w, 'e') THEN CASE WHEN length(w) - 1 >= r2 OR (length(w) - 1 >= r1 AND NOT regexp_matches({fix}, {short})) "
              f"THEN {fix} ELSE w END WHEN suffix(w, 'll') AND length(w) - 1 >= r2 THEN {fix} ELSE w END",
    }
    known = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in st.EXCEPTIONS.items())
    after = "[" + ", ".join(map(q, st.AFTER_1A)) + "]"
    lead = q("^'")
    out = [rf"m0 AS (SELECT word, regexp_replace(regexp_replace(regexp_replace(word, {lead}, ''), '^y', 'Y'), '([aeiouy])y', '\1Y', 'g') AS w "
           f"FROM (SELECT DISTINCT word FROM {words}))",
           f"m1 AS (SELECT *, CASE WHEN regexp_matches(w, {prefixes}) THEN length(regexp_extract(w, {prefixes}, 1)) ELSE {region('0')} END AS r1 FROM m0)",
           f"m2 AS (SELECT *, {region('r1')} AS r2, CAST(NULL AS VARCHAR) AS early FROM m1)"]
    last = "m2"
    for name, step in steps.items():
        early = step if name == "a1" else "early"
        out.append(f"{name} AS (SELECT word, r1, r2, {early} AS early, {step} AS w FROM {last})")
        last = name
    out.append(f"stems AS (SELECT word, CASE WHEN length(word) <= 2 THEN word WHEN word IN ({', '.join(map(q, st.EXCEPTIONS))}) THEN CASE word {known} END "
               f"WHEN list_contains({after}, early) THEN early ELSE translate(w, 'Y', 'y') END AS stem FROM {last})")
    return ",\n".join(out)
