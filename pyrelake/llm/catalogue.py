"""The queries of this subpackage by name, and their SQL where SQL can express them."""

from __future__ import annotations

from . import op6_embeddings as op6
from . import op9_line_dedup as op9
from . import op12_spelling as op12
from . import op13_hard_negatives as op13
from .op1_quality import op1_quality
from .op2_token_files import op2_token_files
from .op3_pii import op3_pii
from .op4_bpe import op4_bpe
from .op5_simhash import op5_simhash
from .op7_decontamination import op7_decontamination
from .op8_token_counts import op8_token_counts
from .op10_language import op10_language
from .op11_toxicity import op11_toxicity

QUERIES = {
    "op1_quality": op1_quality,
    "op2_token_files": op2_token_files,
    "op3_pii": op3_pii,
    "op4_bpe": op4_bpe,
    "op5_simhash": op5_simhash,
    "op6_embeddings": op6.op6_embeddings,
    "op7_decontamination": op7_decontamination,
    "op8_token_counts": op8_token_counts,
    "op9_line_dedup": op9.op9_line_dedup,
    "op10_language": op10_language,
    "op11_toxicity": op11_toxicity,
    "op12_spelling": op12.op12_spelling,
    "op13_hard_negatives": op13.op13_hard_negatives,
}
ORACLE_SQL = {"op6_embeddings": op6.ORACLE_SQL, "op9_line_dedup": op9.ORACLE_SQL, "op12_spelling": op12.ORACLE_SQL, "op13_hard_negatives": op13.ORACLE_SQL}
