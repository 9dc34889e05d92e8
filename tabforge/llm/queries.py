"""The registered queries of this package and their DuckDB SQL."""

from __future__ import annotations

from tabforge.llm import bpe_tree, html_tree, idcoder, langid, maxscore, packing, periodic, quality, resample, secrets, sharding, simhash, toxicity

QUERIES = {
    "op1_token_ids": idcoder.query,
    "op2_topk_search": maxscore.query,
    "op3_html_extraction": html_tree.query,
    "op4_bpe": bpe_tree.query,
    "op5_toxicity": toxicity.query,
    "op6_secret_scans": secrets.query,
    "op7_packing": packing.query,
    "op8_sharding": sharding.query,
    "op9_quality_rules": quality.query,
    "op10_simhash_dedup": simhash.query,
    "op11_importance_resampling": resample.query,
    "op12_language_id": langid.query,
    "op13_periodic_runs": periodic.query,
}

#: What SQL can't express (XXH64, CRC-32, components over fingerprints) is tested against brute force in tests/llm.
SQL = {"op2_topk_search": maxscore.SQL, "op9_quality_rules": quality.SQL, "op11_importance_resampling": resample.SQL}
