"""Input formats of the jobs, so existing files can be read as they are.

Schemas are DDL strings (no inference pass). The wide product schema is built from
a rule (``feat_1..feat_n``).
"""

from __future__ import annotations

# --- fixed values: input formats ------------------------------------------------------
SURVEY_SCHEMA = (
    "id INT, city STRING, salary INT, salary_delta INT, position STRING, experience DOUBLE, "
    "current_job_experience DOUBLE, programming_language STRING, specialization STRING, age INT, "
    "sex STRING, education STRING, university STRING, is_student BOOLEAN, english_level STRING, "
    "company_size STRING, company_type STRING, domain STRING"
)

# --- fixed values: survey vocabularies --------------------------------------------------
# English level -> ordinal (unknown, blank and null -> 0).
ENGLISH_LEVELS = {
    "элементарный": 1, "ниже среднего": 2, "средний": 3, "выше среднего": 4, "продвинутый": 5,
}
# Programming language slots in order; unknown, blank and null go to the "Other" slot (11).
LANGUAGE_SLOTS = [
    "1C", "APL", "C", "C#/.NET", "C++", "Delphi", "Flex/Flash/AIR", "Haskell", "Java", "JavaScript",
    "Objective-C", "Other", "Perl", "PHP", "Python", "Ruby/Rails", "Scala", "SQL", "Swift",
]
OTHER_LANGUAGE_SLOT = 11
# Positions kept by the role filter: titles containing ROLE_CONTAINS or equal to ROLE_EQUALS.
ROLE_CONTAINS = ("Engineer",)
ROLE_EQUALS = ("Technical Lead", "System Architect")
# -----------------------------------------------------------------------------------------


def product_schema(n_features: int = 93, with_target: bool = True) -> str:
    """``id INT, feat_1 INT .. feat_n INT[, target STRING]``."""
    cols = ["id INT"] + [f"feat_{i} INT" for i in range(1, n_features + 1)]
    if with_target:
        cols.append("target STRING")
    return ", ".join(cols)


def product_features(n_features: int = 93) -> list[str]:
    return [f"feat_{i}" for i in range(1, n_features + 1)]
