"""The registered queries of this subpackage."""
from llm import align, exact_dedup, jaccard, language, packing, phrases, pieces, preferences, quality, repeats, topk, toxicity, url_filter  # noqa: F401  (they register their queries)
from llm.common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
