"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from ledgerline.llm import (bpe, conversations, embeddings, langid, lexical, licenses, lines, packing, pii, quality, search,
                            simhash, urlfilter)
from ledgerline.llm.common import table


def _on(name: str, operator):
    def run(spark, sf_dir):
        return operator(table(spark, sf_dir, name))

    return run


def _ranked(spark, sf_dir):
    return lexical.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_vector_packing": _on("documents", packing.pack_documents),
    "op2_simhash_gray": _on("documents", simhash.simhash_classes),
    "op3_feistel_pii": _on("documents", pii.pii_report),
    "op4_rank_order_langid": _on("documents", langid.language_id),
    "op5_block_max_search": _on("documents", search.search_self),
    "op6_gbt_url_filter": _on("pages", urlfilter.judge),
    "op7_patience_licenses": _on("documents", licenses.scan_licenses),
    "op8_backtracking_bpe": _on("documents", bpe.bpe_digests),
    "op9_pivot_embeddings": _on("embeddings", embeddings.near_duplicates),
    "op10_line_spread": _on("documents", lines.line_report),
    "op11_integer_dag_repair": _on("conversations", conversations.repair_report),
    "op12_hybrid_taat_daat": _ranked,
    "op13_weak_supervision": _on("documents", quality.quality_report),
}

# The others have a learned model, hashes or tokens that SQL cannot
# express; they are tested against brute force.
ORACLE = {"op10_line_spread": lines.ORACLE, "op12_hybrid_taat_daat": lexical.ORACLE}
