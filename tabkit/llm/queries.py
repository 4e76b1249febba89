"""All registered queries of the subpackage: importing the modules registers them."""

from tabkit.llm import (  # noqa: F401
    byte_bpe,
    chat,
    fingerprints,
    jaccard,
    language,
    licenses,
    main_text,
    near_vectors,
    packing,
    quality,
    ranked_search,
    repair,
    token_counts,
)
from tabkit.llm.common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
