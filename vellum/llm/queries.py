"""The registered queries of the operators in this package, and their SQL."""

from __future__ import annotations

from vellum.llm import collocations, divergence, hyperminhash, language_id, line_dedup, media, neighbours, packing, quality, secret_scan, sentencepieces, simhash, toxicity

QUERIES = {
    "op1_secret_scan": secret_scan.op1_secret_scan,
    "op2_packing": packing.op2_packing,
    "op3_neighbours": neighbours.op3_neighbours,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_media": media.op5_media,
    "op6_simhash": simhash.op6_simhash,
    "op7_quality": quality.op7_quality,
    "op8_line_dedup": line_dedup.op8_line_dedup,
    "op9_language_id": language_id.op9_language_id,
    "op10_sentencepieces": sentencepieces.op10_sentencepieces,
    "op11_divergence": divergence.op11_divergence,
    "op12_collocations": collocations.op12_collocations,
    "op13_hyperminhash": hyperminhash.op13_hyperminhash,
}
ORACLES = {"op1_secret_scan": secret_scan.SQL, "op8_line_dedup": line_dedup.SQL, "op11_divergence": divergence.SQL, "op12_collocations": collocations.SQL, "op13_hyperminhash": hyperminhash.SQL}
