"""The registered queries of this package, one per operator, over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from daybook.llm import (
    html_text,
    langid,
    licenses,
    merkle,
    mixing,
    near_dups,
    packing,
    pieces,
    pii,
    posting_lists,
    quality,
    term_stages,
    weighted_sampling,
)
from daybook.llm.common import PIECE_MODEL, WORD_TOKENIZER
from daybook.llm.registry import QUERIES, SQL, query  # noqa: F401
from daybook.plans.registry import table
from daybook.session import checkpointed


@query("op9_best_fit_packing")
def op9_best_fit_packing(spark, folder):
    return packing.pack(table(spark, folder, "documents"), WORD_TOKENIZER)


@query("op5_language_codes")
def op5_language_codes(spark, folder):
    return langid.predict(table(spark, folder, "documents"))


@query("op1_source_mixing", mixing.mix_sql())
def op1_source_mixing(spark, folder):
    measured = checkpointed(mixing.leaf_columns(table(spark, folder, "documents")))
    return mixing.mix(measured, mixing.TREE)


@query("op3_posting_lists")
def op3_posting_lists(spark, folder):
    embeddings = table(spark, folder, "embeddings")
    return posting_lists.nearest(embeddings, F.col("vec_id") % 100 == 0)


@query("op4_contextual_pii")
def op4_contextual_pii(spark, folder):
    return pii.found(table(spark, folder, "documents"))


@query("op6_weighted_sampling")
def op6_weighted_sampling(spark, folder):
    return weighted_sampling.compared(table(spark, folder, "documents"))


@query("op8_block_tree_html")
def op8_block_tree_html(spark, folder):
    return html_text.extract(table(spark, folder, "pages"))


@query("op10_circulant_minhash")
def op10_circulant_minhash(spark, folder):
    return near_dups.grouped(table(spark, folder, "documents"), size=3, percent=85)


@query("op2_license_digests", licenses.scan_sql())
def op2_license_digests(spark, folder):
    return licenses.scanned(table(spark, folder, "documents"))


@query("op7_site_quality")
def op7_site_quality(spark, folder):
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return quality.rated(docs, labels, host=F.col("source"), path=F.col("lang"))


@query("op11_term_stages", term_stages.ranked_sql())
def op11_term_stages(spark, folder):
    return term_stages.ranked(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op12_merkle_blocks", merkle.manifest_sql())
def op12_merkle_blocks(spark, folder):
    return merkle.manifest(table(spark, folder, "documents"))


@query("op13_piece_agenda")
def op13_piece_agenda(spark, folder):
    return pieces.digests(table(spark, folder, "documents"), PIECE_MODEL)
