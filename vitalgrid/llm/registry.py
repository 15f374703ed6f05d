"""Queries of the text operators and their SQL."""

from __future__ import annotations

from vitalgrid.llm import decontamination, lexical_search, url_filters
from vitalgrid.llm.decontamination import op4_decontamination
from vitalgrid.llm.importance_resampling import op12_importance_resampling
from vitalgrid.llm.jaccard_join import op6_jaccard_join
from vitalgrid.llm.lexical_search import op11_lexical_search
from vitalgrid.llm.license_scan import op3_license_scan
from vitalgrid.llm.lm_scoring import op2_lm_scoring
from vitalgrid.llm.mixing import op8_mixing
from vitalgrid.llm.pii import op5_pii
from vitalgrid.llm.quality_classifier import op7_quality_classifier
from vitalgrid.llm.quality_rules import op1_quality_rules
from vitalgrid.llm.secret_scan import op13_secret_scan
from vitalgrid.llm.token_counts import op9_token_counts
from vitalgrid.llm.url_filters import op10_url_filters

QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_rules, op2_lm_scoring, op3_license_scan, op4_decontamination, op5_pii, op6_jaccard_join,
        op7_quality_classifier, op8_mixing, op9_token_counts, op10_url_filters,
        op11_lexical_search, op12_importance_resampling, op13_secret_scan,
    )
}

ORACLE_SQL: dict[str, str] = {"op4_decontamination": decontamination.OP4_SQL, "op10_url_filters": url_filters.OP10_SQL, "op11_lexical_search": lexical_search.OP11_SQL}
