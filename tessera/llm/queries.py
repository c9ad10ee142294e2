"""The thin queries over whole tables, one an operator, and the SQL of those that SQL can express.

None of the ten has SQL: they hash with XXH64, sample by hash, learn, or run automata.  Their tests compare
them with brute force instead.
"""

from __future__ import annotations

from . import licenses, lm, mixing, neighbours, pieces, quality, repeats, sharding, simhash, topk

QUERIES = {
    "op1_pieces": pieces.op1_pieces,
    "op2_mixing": mixing.op2_mixing,
    "op3_lm": lm.op3_lm,
    "op4_topk": topk.op4_topk,
    "op5_quality": quality.op5_quality,
    "op6_repeats": repeats.op6_repeats,
    "op7_licenses": licenses.op7_licenses,
    "op8_sharding": sharding.op8_sharding,
    "op9_neighbours": neighbours.op9_neighbours,
    "op10_simhash": simhash.op10_simhash,
}
ORACLES: dict[str, str] = {}
