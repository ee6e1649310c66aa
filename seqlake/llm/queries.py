"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from .op01_bpe import op1_bpe
from .op02_minhash import ORACLE_OP2, op2_minhash
from .op03_chat import ORACLE_OP3, op3_chat
from .op04_packing import op4_packing
from .op05_warc import ORACLE_OP5, op5_warc
from .op06_toxicity import op6_toxicity
from .op07_substring import op7_substring
from .op08_topk import ORACLE_OP8, op8_topk
from .op09_language import op9_language
from .op10_fingerprint import op10_fingerprint
from .op11_tokens import op11_tokens
from .op12_divergence import ORACLE_OP12, op12_divergence
from .op13_centroids import ORACLE_OP13, op13_centroids

QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_minhash": op2_minhash,
    "op3_chat": op3_chat,
    "op4_packing": op4_packing,
    "op5_warc": op5_warc,
    "op6_toxicity": op6_toxicity,
    "op7_substring": op7_substring,
    "op8_topk": op8_topk,
    "op9_language": op9_language,
    "op10_fingerprint": op10_fingerprint,
    "op11_tokens": op11_tokens,
    "op12_divergence": op12_divergence,
    "op13_centroids": op13_centroids,
}
ORACLE = {"op2_minhash": ORACLE_OP2, "op3_chat": ORACLE_OP3, "op5_warc": ORACLE_OP5, "op8_topk": ORACLE_OP8,
          "op12_divergence": ORACLE_OP12, "op13_centroids": ORACLE_OP13}
