"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from .audit import AUDIT_SQL, op13_audit
from .decontaminate import op3_decontaminate
from .language import op8_language
from .lines import op1_lines
from .pieces import op2_pieces
from .quality import op10_quality
from .runs import op12_runs
from .sharding import op7_sharding
from .simhash import op4_simhash
from .suffixes import op5_suffixes
from .tokens import op11_tokens
from .toxicity import op6_toxicity
from .urls import URL_SQL, op9_urls

QUERIES = {
    f.__name__: f
    for f in (op1_lines, op2_pieces, op3_decontaminate, op4_simhash, op5_suffixes, op6_toxicity, op7_sharding, op8_language, op9_urls, op10_quality, op11_tokens, op12_runs, op13_audit)
}
SQL: dict[str, str] = {"op9_urls": URL_SQL, "op13_audit": AUDIT_SQL}
