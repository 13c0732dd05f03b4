"""Each operator, with its production parameters, on its whole table."""

from equifacts.llm import (
    conversation_sql, conversations, fingerprints, jaccard_join, language_id, licenses, mixing, packing, pii, quality_rules,
    secrets, simhash, tokenizer_alignment,
    toxicity)
from equifacts.llm.common import read

SQL: dict[str, str] = {"op12_conversation_repair": conversation_sql.SQL}


def op1_best_fit_packing(spark, folder):
    return packing.pack_apart(read(spark, folder, "documents"))


def op2_pii(spark, folder):
    return pii.report(read(spark, folder, "documents"))


def op3_toxicity(spark, folder):
    return toxicity.report(read(spark, folder, "documents"), read(spark, folder, "labels"))


def op4_secret_scan(spark, folder):
    return secrets.scan(read(spark, folder, "documents"))


def op5_language_id(spark, folder):
    return language_id.report(read(spark, folder, "documents"))


def op6_mixing(spark, folder):
    return mixing.report(read(spark, folder, "documents"))


def op7_quality_rules(spark, folder):
    return quality_rules.report(read(spark, folder, "documents"))


def op8_jaccard_join(spark, folder):
    return jaccard_join.join_report(read(spark, folder, "documents"))


def op9_fingerprints(spark, folder):
    return fingerprints.report(read(spark, folder, "documents"))


def op10_license_scan(spark, folder):
    return licenses.report(read(spark, folder, "documents"))


def op11_simhash(spark, folder):
    return simhash.near_duplicates(read(spark, folder, "documents"))


def op12_conversation_repair(spark, folder):
    return conversations.audit(conversations.damaged(read(spark, folder, "conversations")))


def op13_tokenizer_alignment(spark, folder):
    return tokenizer_alignment.report(read(spark, folder, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_best_fit_packing, op2_pii, op3_toxicity, op4_secret_scan, op5_language_id, op6_mixing, op7_quality_rules,
    op8_jaccard_join, op9_fingerprints, op10_license_scan, op11_simhash,
    op12_conversation_repair, op13_tokenizer_alignment)}
