"""The registered queries of this subpackage."""

from windrow.llm import (  # noqa: F401
    bpe_bitmap,
    bpe_heap,
    chosen_path,
    exact_dedup,
    line_dedup,
    line_quality,
    phrase_mining,
    piece_language,
    positional_index,
    ranked_search,
    robust_rules,
    toxicity,
    warc,
)
from windrow.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
