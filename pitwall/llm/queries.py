"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from pitwall.llm.clusters import OP11_SQL, op11_bit_planes
from pitwall.llm.decontaminate import op5_suffix_arrays
from pitwall.llm.language import op8_zstd_dictionaries
from pitwall.llm.lines import OP4_SQL, op4_site_lines
from pitwall.llm.minhash import op3_minhash_lsh
from pitwall.llm.neighbours import op2_hnsw
from pitwall.llm.pieces import op7_pieces
from pitwall.llm.quality import op1_kneser_ney
from pitwall.llm.sharding import op9_external_shuffle
from pitwall.llm.suffixes import op10_front_coded_merge
from pitwall.llm.token_files import op13_token_ids
from pitwall.llm.tries import OP12_SQL, op12_z_fast_trie
from pitwall.llm.warc import OP6_SQL, op6_revisits

QUERIES = {
    "op1_kneser_ney": op1_kneser_ney,
    "op2_hnsw": op2_hnsw,
    "op3_minhash_lsh": op3_minhash_lsh,
    "op4_site_lines": op4_site_lines,
    "op5_suffix_arrays": op5_suffix_arrays,
    "op6_revisits": op6_revisits,
    "op7_pieces": op7_pieces,
    "op8_zstd_dictionaries": op8_zstd_dictionaries,
    "op9_external_shuffle": op9_external_shuffle,
    "op10_front_coded_merge": op10_front_coded_merge,
    "op11_bit_planes": op11_bit_planes,
    "op12_z_fast_trie": op12_z_fast_trie,
    "op13_token_ids": op13_token_ids,
}

SQL = {
    "op4_site_lines": OP4_SQL,
    "op6_revisits": OP6_SQL,
    "op11_bit_planes": OP11_SQL,
    "op12_z_fast_trie": OP12_SQL,
}
