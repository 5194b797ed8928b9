"""The queries of this subpackage and the SQL that gives the same rows, by name."""

from cairnfield.llm import ann_projection, embedding_dedup, filter_audit, language_id, license_scan, line_dedup, minhash_dedup, packing, personal_data, piece_sampling, toxicity, warc_index, whitening

QUERIES = {
    "op1_warc_index": warc_index.op1_warc_index,
    "op2_language_id": language_id.op2_language_id,
    "op3_minhash_dedup": minhash_dedup.op3_minhash_dedup,
    "op4_embedding_dedup": embedding_dedup.op4_embedding_dedup,
    "op5_line_dedup": line_dedup.op5_line_dedup,
    "op6_piece_sampling": piece_sampling.op6_piece_sampling,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_ann_projection": ann_projection.op8_ann_projection,
    "op9_packing": packing.op9_packing,
    "op10_license_scan": license_scan.op10_license_scan,
    "op11_filter_audit": filter_audit.op11_filter_audit,
    "op12_whitening": whitening.op12_whitening,
    "op13_pii": personal_data.op13_pii,
}

ORACLES = {
    "op1_warc_index": warc_index.ORACLE_SQL,
    "op3_minhash_dedup": minhash_dedup.ORACLE_SQL,
    "op5_line_dedup": line_dedup.ORACLE_SQL,
    "op10_license_scan": license_scan.oracle_sql(),
    "op11_filter_audit": filter_audit.ORACLE_SQL,
    "op13_pii": personal_data.oracle_sql(),
}
