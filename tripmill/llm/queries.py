"""The operators of this subpackage as queries on the given tables, and SQL for those that SQL can express."""

from __future__ import annotations

from tripmill.llm.chat import op9_chat_formatting
from tripmill.llm.cover_trees import op13_vector_codes
from tripmill.llm.fim import op12_fill_in_middle
from tripmill.llm.fingerprint import op4_content_chunks
from tripmill.llm.language import op2_language_id
from tripmill.llm.lexicon import op7_bpe_lexicon
from tripmill.llm.line_chunks import op5_line_chunks
from tripmill.llm.minhash import op6_minhash_near_dedup
from tripmill.llm.oracles import ORACLES as ORACLES
from tripmill.llm.packing import op3_best_fit_packing
from tripmill.llm.pieces import op11_piece_backtracking
from tripmill.llm.scoring import op8_lm_scoring
from tripmill.llm.token_files import op1_token_files
from tripmill.llm.vectors import op10_embedding_near_dedup

QUERIES = {
    "op1_token_files": op1_token_files,
    "op2_language_id": op2_language_id,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_content_chunks": op4_content_chunks,
    "op5_line_chunks": op5_line_chunks,
    "op6_minhash_near_dedup": op6_minhash_near_dedup,
    "op7_bpe_lexicon": op7_bpe_lexicon,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_chat_formatting": op9_chat_formatting,
    "op10_embedding_near_dedup": op10_embedding_near_dedup,
    "op11_piece_backtracking": op11_piece_backtracking,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_vector_codes": op13_vector_codes,
}
