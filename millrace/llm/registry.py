"""The registered queries: name to query, name to equivalent SQL."""

from __future__ import annotations

from . import alignment, fingerprints, jaccard, mixing, neighbours, packing, periods, quality, scoring, secrets, sharding, toxicity, urls

QUERIES = {
    "op3_masked_likelihood": scoring.query,
    "op4_nn_descent": neighbours.query,
    "op6_toxicity_field": toxicity.query,
    "op2_secret_formats": secrets.query,
    "op5_jaccard_join": jaccard.query,
    "op1_resharding": sharding.query,
    "op7_best_fit_packing": packing.query,
    "op8_url_filter": urls.query,
    "op9_quality_divergence": quality.query,
    "op10_source_mixing": mixing.query,
    "op11_multiset_fingerprint": fingerprints.query,
    "op12_periodic_runs": periods.query,
    "op13_token_alignment": alignment.query,
}
ORACLES = {"op10_source_mixing": mixing.ORACLE, "op11_multiset_fingerprint": fingerprints.ORACLE}
