"""The operators over the given tables, one query each, and their SQL where SQL can say it."""

from __future__ import annotations

from . import (decontam, hnsw, htmltext, jaccard, langid, mixing, oracles, pii, repeats, secrets,
               toxicity, urlrules, warc, whitening)
from .common import table


def op1_spaced_seed_decontamination(spark, sf):
    return decontam.decontamination_report(table(spark, sf, "documents"),
                                           table(spark, sf, "benchmark"))


def op2_secret_markov(spark, sf):
    docs = table(spark, sf, "documents")
    return secrets.secret_report(docs, *secrets.fitted(docs))


def op3_site_style_tree(spark, sf):
    return htmltext.extract(table(spark, sf, "pages"))


def op4_warc_index_merge(spark, sf):
    return warc.archive_report(table(spark, sf, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_personal_data(spark, sf):
    docs = table(spark, sf, "documents")
    return pii.pii_report(docs, pii.train(docs))


def op6_language_bit_filters(spark, sf):
    docs = table(spark, sf, "documents")
    return langid.language_report(docs, langid.train(docs))


def op7_jaccard_prefix_join(spark, sf):
    return jaccard.jaccard_groups(table(spark, sf, "documents"))


def op8_hnsw_shards(spark, sf):
    return hnsw.nearest(table(spark, sf, "embeddings"))


def op9_hypergeometric_mix(spark, sf):
    return mixing.mix_report(table(spark, sf, "documents"))


def op10_toxic_spans(spark, sf):
    docs = table(spark, sf, "documents")
    return toxicity.toxicity_report(docs, toxicity.train(docs, table(spark, sf, "labels")))


def op11_embedding_whitening(spark, sf):
    return whitening.whitening_report(table(spark, sf, "embeddings"))


def op12_periodic_runs(spark, sf):
    return repeats.repeat_report(table(spark, sf, "documents"))


def op13_redirect_equivalence(spark, sf):
    return urlrules.judged(table(spark, sf, "pages"), urlrules.rule_table(spark))


QUERIES = {
    "op1_spaced_seed_decontamination": op1_spaced_seed_decontamination,
    "op2_secret_markov": op2_secret_markov,
    "op3_site_style_tree": op3_site_style_tree,
    "op4_warc_index_merge": op4_warc_index_merge,
    "op5_personal_data": op5_personal_data,
    "op6_language_bit_filters": op6_language_bit_filters,
    "op7_jaccard_prefix_join": op7_jaccard_prefix_join,
    "op8_hnsw_shards": op8_hnsw_shards,
    "op9_hypergeometric_mix": op9_hypergeometric_mix,
    "op10_toxic_spans": op10_toxic_spans,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_redirect_equivalence": op13_redirect_equivalence,
}

#: The others depend on trained models, on a random order or on an approximate index.
ORACLE_SQL: dict[str, str] = {
    "op4_warc_index_merge": oracles.OP4,
    "op7_jaccard_prefix_join": oracles.OP7,
    "op13_redirect_equivalence": oracles.OP13,
}
