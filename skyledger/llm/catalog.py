"""The queries of the training-data operators, and their SQL where SQL can express them."""

from skyledger.llm import (  # noqa: F401  (each registers its queries)
    conversation_trie,
    decontaminate,
    language,
    licenses,
    near_dedup,
    neighbours,
    packing,
    phrases,
    sharding,
    substring_dedup,
    suffix_dedup,
    token_files,
    warc,
)
from skyledger.llm.common import ORACLE, QUERIES  # noqa: F401
