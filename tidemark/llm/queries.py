"""The registered queries of this subpackage, and the SQL of those that SQL can state."""

from __future__ import annotations

from tidemark.llm.ann import op6_nearest_vectors
from tidemark.llm.decontaminate import op7_decontamination
from tidemark.llm.langid import op9_language_id
from tidemark.llm.licences import op10_licence_scan
from tidemark.llm.linededup import OP4_SQL, op4_line_dedup
from tidemark.llm.mixing import op2_source_mix
from tidemark.llm.neardup import op3_near_duplicates
from tidemark.llm.pieces import op11_sentencepiece
from tidemark.llm.revisits import OP1_SQL, op1_revisits
from tidemark.llm.shards import op5_histogram_shards
from tidemark.llm.tokencount import op8_token_counts
from tidemark.llm.variants import OP13_SQL, op13_spelling_variants
from tidemark.llm.whitening import op12_whitening

QUERIES = {
    "op1_revisits": op1_revisits,
    "op2_source_mix": op2_source_mix,
    "op3_near_duplicates": op3_near_duplicates,
    "op4_line_dedup": op4_line_dedup,
    "op5_histogram_shards": op5_histogram_shards,
    "op6_nearest_vectors": op6_nearest_vectors,
    "op7_decontamination": op7_decontamination,
    "op8_token_counts": op8_token_counts,
    "op9_language_id": op9_language_id,
    "op10_licence_scan": op10_licence_scan,
    "op11_sentencepiece": op11_sentencepiece,
    "op12_whitening": op12_whitening,
    "op13_spelling_variants": op13_spelling_variants,
}

SQL = {
    "op1_revisits": OP1_SQL,
    "op4_line_dedup": OP4_SQL,
    "op13_spelling_variants": OP13_SQL,
}
