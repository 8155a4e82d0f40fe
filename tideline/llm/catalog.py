"""The queries of this subpackage and their SQL."""

from __future__ import annotations

import corpus_pipeline

from .decontaminate import op9_decontamination
from .langid import op8_language_id
from .licenses import OP5_SQL, op5_license_scan
from .lines import OP2_SQL, op2_line_dedup
from .near_dup import op1_near_dedup
from .packing import op6_best_fit_packing
from .periodic import op11_periodic_runs
from .pii import OP13_SQL, op13_pii
from .sharding import op4_sharding
from .spelling import op12_spelling_variants
from .substrings import op10_substring_dedup
from .topk import OP7_SQL, op7_exact_topk
from .warc import OP3_SQL, op3_warc

QUERIES = {
    "op1_near_dedup": op1_near_dedup,
    "op2_line_dedup": op2_line_dedup,
    "op3_warc": op3_warc,
    "op4_sharding": op4_sharding,
    "op5_license_scan": op5_license_scan,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_exact_topk": op7_exact_topk,
    "op8_language_id": op8_language_id,
    "op9_decontamination": op9_decontamination,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_pii": op13_pii,
    "pipeline": corpus_pipeline.run,
}
ORACLES = {
    "op2_line_dedup": OP2_SQL,
    "op3_warc": OP3_SQL,
    "op5_license_scan": OP5_SQL,
    "op7_exact_topk": OP7_SQL,
    "op13_pii": OP13_SQL,
}
