"""Registered queries of the corpus operators: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from .hardnegatives import OP11_SQL, op11_hardnegatives
from .kdsearch import op7_search
from .lexical import OP12_SQL, op12_lexical
from .licenses import op5_licenses
from .linequality import op13_quality
from .merkle import op10_fingerprints
from .packing import op6_packing
from .repeats import op2_repeats
from .sentencepieces import op3_sentencepiece
from .sharding import op1_sharding
from .simhash import op9_simhash
from .toxicity import op4_toxicity
from .urlfilter import op8_urls


def pipeline(spark, sf_dir: str):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_repeats": op2_repeats,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_toxicity": op4_toxicity,
    "op5_licenses": op5_licenses,
    "op6_packing": op6_packing,
    "op7_search": op7_search,
    "op8_urls": op8_urls,
    "op9_simhash": op9_simhash,
    "op10_fingerprints": op10_fingerprints,
    "op11_hardnegatives": op11_hardnegatives,
    "op12_lexical": op12_lexical,
    "op13_quality": op13_quality,
    "pipeline": pipeline,
}

# DuckDB SQL where the question is SQL-expressible (the others need an
# iterative placement, a fitted model, a tokenizer, a hash or a byte-level
# step that DuckDB lacks; tests hold them against brute force)
ORACLE: dict[str, str] = {"op11_hardnegatives": OP11_SQL, "op12_lexical": OP12_SQL}
