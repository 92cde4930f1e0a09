"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

import corpus_pipeline

from .chat import ORACLE_OP7, op7_chat_formatting
from .decontaminate import ORACLE_OP2, op2_benchmark_decontamination
from .language import op6_language_id
from .linededup import ORACLE_OP5, op5_line_dedup
from .neighbours import ORACLE_OP1, op1_embedding_near_dedup
from .packing import op12_best_fit_packing
from .pii import op8_pii_surrogates
from .pieces import op9_sentencepiece
from .prefixes import ORACLE_OP11, op11_prefix_trie
from .scoring import op10_lm_scoring
from .simhash import op3_simhash_near_dedup
from .toxicity import op4_toxicity
from .whitening import op13_embedding_whitening

QUERIES = {
    "op1_embedding_near_dedup": op1_embedding_near_dedup,
    "op2_benchmark_decontamination": op2_benchmark_decontamination,
    "op3_simhash_near_dedup": op3_simhash_near_dedup,
    "op4_toxicity": op4_toxicity,
    "op5_line_dedup": op5_line_dedup,
    "op6_language_id": op6_language_id,
    "op7_chat_formatting": op7_chat_formatting,
    "op8_pii_surrogates": op8_pii_surrogates,
    "op9_sentencepiece": op9_sentencepiece,
    "op10_lm_scoring": op10_lm_scoring,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_best_fit_packing": op12_best_fit_packing,
    "op13_embedding_whitening": op13_embedding_whitening,
    "pipeline": corpus_pipeline.run,
}

ORACLE = {
    "op1_embedding_near_dedup": ORACLE_OP1,
    "op2_benchmark_decontamination": ORACLE_OP2,
    "op5_line_dedup": ORACLE_OP5,
    "op7_chat_formatting": ORACLE_OP7,
    "op11_prefix_trie": ORACLE_OP11,
}
