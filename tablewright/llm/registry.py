"""The registered queries of this subpackage and the SQL that checks them where SQL can say it."""

from __future__ import annotations

import corpus_pipeline

from tablewright.llm.best_fit import op11_best_fit_packing
from tablewright.llm.exact_dedup import OP8_SQL, op8_exact_dedup
from tablewright.llm.fill_middle import OP12_SQL, op12_fill_in_middle
from tablewright.llm.licenses import op5_license_families
from tablewright.llm.merkle import OP13_SQL, op13_merkle_manifest
from tablewright.llm.mixing import op10_pfair_mixing
from tablewright.llm.near_dedup import op3_dart_minhash
from tablewright.llm.packing import op7_mixture_packing
from tablewright.llm.secrets import op6_secret_forest
from tablewright.llm.token_counts import op1_token_counts
from tablewright.llm.toxicity import op9_toxicity_cnn
from tablewright.llm.vector_search import OP4_SQL, op4_pivot_top_k
from tablewright.llm.web_archive import OP2_SQL, op2_arc_to_warc

QUERIES = {q.__name__: q for q in (
    op1_token_counts, op2_arc_to_warc, op3_dart_minhash, op4_pivot_top_k, op5_license_families, op6_secret_forest,
    op7_mixture_packing, op8_exact_dedup, op9_toxicity_cnn, op10_pfair_mixing, op11_best_fit_packing,
    op12_fill_in_middle, op13_merkle_manifest,
)}
QUERIES["pipeline"] = corpus_pipeline.run

SQL = {"op2_arc_to_warc": OP2_SQL, "op4_pivot_top_k": OP4_SQL, "op8_exact_dedup": OP8_SQL,
       "op12_fill_in_middle": OP12_SQL, "op13_merkle_manifest": OP13_SQL}
if corpus_pipeline.ORACLE_SQL:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
