"""All queries of this folder: importing it registers them."""

from panelkit.llm import decontamination, fill_middle, importance, jaccard_join, line_dedup, lm_scoring, packing, private_data, secret_scan, spelling, substring_dedup, suffix_dedup, topk_search  # noqa: F401
from panelkit.llm.registry import ORACLES, QUERIES  # noqa: F401
