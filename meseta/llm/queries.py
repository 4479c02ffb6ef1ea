"""All queries of this package; importing it registers them."""

from meseta.llm import (  # noqa: F401
    chat, decontamination, exact_dedup, mixing, near_dedup, packing, prefix_trie, quality_model, quality_rules, repeats,
    secret_scan, tokens, whitening)
from meseta.llm.registry import ORACLES, QUERIES  # noqa: F401
