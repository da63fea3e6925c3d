"""The queries of this subpackage and their SQL, for the entry module."""

from __future__ import annotations

from .decontaminate import op2_decontaminate
from .exact_dedup import OP3_SQL, op3_exact_dedup
from .jaccard_join import OP12_SQL, op12_jaccard_join
from .pieces_codec import op6_pieces
from .quality import op7_quality
from .ranked_search import OP11_SQL, op11_ranked_search
from .secret_scan import OP4_SQL, op4_secret_scan
from .simhash import op10_simhash
from .substring_dedup import OP5_SQL, op5_substring_dedup
from .suffix_dedup import OP8_SQL, op8_suffix_dedup
from .toxicity import op9_toxicity
from .vector_codes import OP13_SQL, op13_vector_codes
from .wavelet import op1_wavelet_tokens

QUERIES = {
    "op1_wavelet_tokens": op1_wavelet_tokens,
    "op2_decontaminate": op2_decontaminate,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_secret_scan": op4_secret_scan,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_pieces": op6_pieces,
    "op7_quality": op7_quality,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_toxicity": op9_toxicity,
    "op10_simhash": op10_simhash,
    "op11_ranked_search": op11_ranked_search,
    "op12_jaccard_join": op12_jaccard_join,
    "op13_vector_codes": op13_vector_codes,
}
SQL = {
    "op3_exact_dedup": OP3_SQL,
    "op4_secret_scan": OP4_SQL,
    "op5_substring_dedup": OP5_SQL,
    "op8_suffix_dedup": OP8_SQL,
    "op11_ranked_search": OP11_SQL,
    "op12_jaccard_join": OP12_SQL,
    "op13_vector_codes": OP13_SQL,
}
