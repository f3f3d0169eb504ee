"""The queries of this folder, and SQL for those whose answer SQL can express."""

from __future__ import annotations

from .fm import op7_fm
from .hamming import OP9_SQL, op9_multi_index
from .licenses import OP11_SQL, op11_setjoin
from .lsa import op4_latent
from .pieces import op10_pieces
from .pii import op2_semicrf
from .prefixes import OP13_SQL, op13_rollup
from .rules import op3_rules
from .segtree import op5_segtree
from .simhash import op6_simhash
from .urls import op8_rules
from .variants import OP12_SQL, op12_bitslice
from .warc import OP1_SQL, op1_warc

QUERIES = {
    "op1_warc": op1_warc,
    "op2_semicrf": op2_semicrf,
    "op3_rules": op3_rules,
    "op4_latent": op4_latent,
    "op5_segtree": op5_segtree,
    "op6_simhash": op6_simhash,
    "op7_fm": op7_fm,
    "op8_rules": op8_rules,
    "op9_multi_index": op9_multi_index,
    "op10_pieces": op10_pieces,
    "op11_setjoin": op11_setjoin,
    "op12_bitslice": op12_bitslice,
    "op13_rollup": op13_rollup,
}

ORACLES = {
    "op1_warc": OP1_SQL,
    "op9_multi_index": OP9_SQL,
    "op11_setjoin": OP11_SQL,
    "op12_bitslice": OP12_SQL,
    "op13_rollup": OP13_SQL,
}
