"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from guildbook.llm import op1_pii, op2_warc, op3_outliers, op4_secrets, op5_substrings, op6_simhash, op7_embeddings, op8_bpe, op9_quality, op10_packing, op11_prefixes, op12_suffixes, op13_whitening

_QUERIES = {"op1_pii": op1_pii.op1_pii, "op2_warc": op2_warc.op2_warc, "op3_outliers": op3_outliers.op3_outliers, "op4_secrets": op4_secrets.op4_secrets, "op5_substrings": op5_substrings.op5_substrings, "op6_simhash": op6_simhash.op6_simhash, "op7_embeddings": op7_embeddings.op7_embeddings, "op8_bpe": op8_bpe.op8_bpe, "op9_quality": op9_quality.op9_quality, "op10_packing": op10_packing.op10_packing, "op11_prefixes": op11_prefixes.op11_prefixes, "op12_suffixes": op12_suffixes.op12_suffixes, "op13_whitening": op13_whitening.op13_whitening}
_SQL = {"op2_warc": op2_warc.SQL, "op5_substrings": op5_substrings.SQL, "op7_embeddings": op7_embeddings.SQL, "op11_prefixes": op11_prefixes.SQL, "op12_suffixes": op12_suffixes.SQL}


def _pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries():
    return _QUERIES | {"pipeline": _pipeline}


def oracle_sql():
    return dict(_SQL)
