"""The queries of this subpackage, and SQL for those that it can express."""

from __future__ import annotations

import corpus_pipeline
from schemaflow.llm import (
    bpe,
    hmm,
    merkle,
    minhash,
    packing,
    quality_bayes,
    quality_rules,
    secrets,
    sharding,
    spelling,
    topk,
    toxicity,
    vptree,
)

QUERIES = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_minhash": minhash.op2_minhash,
    "op3_topk": topk.op3_topk,
    "op4_quality_bayes": quality_bayes.op4_quality_bayes,
    "op5_bpe": bpe.op5_bpe,
    "op6_packing": packing.op6_packing,
    "op7_hmm": hmm.op7_hmm,
    "op8_secrets": secrets.op8_secrets,
    "op9_quality_rules": quality_rules.op9_quality_rules,
    "op10_sharding": sharding.op10_sharding,
    "op11_spelling": spelling.op11_spelling,
    "op12_vptree": vptree.op12_vptree,
    "op13_merkle": merkle.op13_merkle,
    "pipeline": corpus_pipeline.run,
}

ORACLES = {
    "op2_minhash": minhash.ORACLE,
    "op3_topk": topk.ORACLE,
    "op4_quality_bayes": quality_bayes.ORACLE,
    "op11_spelling": spelling.ORACLE,
    "op13_merkle": merkle.ORACLE,
}
