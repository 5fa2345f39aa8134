"""The registered queries of this folder, and DuckDB SQL for those that SQL can express."""

from kinweave.llm.bpe import op1_bpe
from kinweave.llm.jaccard import op7_ngram_jaccard_join
from kinweave.llm.language import op2_language_id
from kinweave.llm.licenses import op4_license_scan
from kinweave.llm.packing import op9_best_fit_packing
from kinweave.llm.quality import op6_quality_rules
from kinweave.llm.recompress import op10_substring_dedup
from kinweave.llm.search import op3_topk_search
from kinweave.llm.sql import ORACLES
from kinweave.llm.toxicity import op5_toxicity
from kinweave.llm.urlfilter import op8_url_filter

QUERIES = {f.__name__: f for f in (op1_bpe, op2_language_id, op3_topk_search, op4_license_scan, op5_toxicity, op6_quality_rules, op7_ngram_jaccard_join, op8_url_filter, op9_best_fit_packing, op10_substring_dedup)}

__all__ = ["ORACLES", "QUERIES"]
