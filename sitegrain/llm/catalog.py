"""The queries of this subpackage and their SQL, as ``__spark_entry__`` takes them up."""

from __future__ import annotations

from sitegrain.llm.oracles import SQL
from sitegrain.llm.p1_canonical import p1_found, p1_unmatched
from sitegrain.llm.p2_residue import p2_found
from sitegrain.llm.p3_survivor import p3_found, p3_votes
from sitegrain.llm.p4_addresses import p4_found, p4_parsed
from sitegrain.llm.p5_names import p5_entities, p5_found
from sitegrain.llm.p6_body import p6_bodies, p6_found
from sitegrain.llm.p7_lookalike import p7_canonical, p7_found
from sitegrain.llm.p8_leaks import p8_found, p8_paraphrases
from sitegrain.llm.p9_mix import p9_mix, p9_shares
from sitegrain.llm.p10_spans import p10_found, p10_shares

QUERIES = {f.__name__: f for f in (p1_found, p1_unmatched, p2_found, p3_found, p3_votes, p4_found, p4_parsed, p5_found, p5_entities, p6_found, p6_bodies, p7_found, p7_canonical, p8_found, p8_paraphrases, p9_mix, p9_shares, p10_found, p10_shares)}
__all__ = ["QUERIES", "SQL"]
