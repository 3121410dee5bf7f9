"""Column-level building blocks (``Column -> Column``) used by the operators."""

from quarry.functions.text import (  # noqa: F401
    ENGLISH_STOP_WORDS,
    cleanse,
    drop_stop_words,
    nonempty_multiword_lines,
    s_stem,
    tokens,
)
from quarry.functions.hashing import hash_bucket  # noqa: F401
