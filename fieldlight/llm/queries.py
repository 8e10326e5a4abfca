"""The queries of this subpackage, by name, and their SQL where SQL can express them."""

from __future__ import annotations

from fieldlight.llm import alignment, fingerprints, jaccard, licenses, manifest, media, mixing, neardup, packing, quality, secrets, sql, substring, toxicity


def queries() -> dict:
    return {
        "op1_substring": substring.op1_substring,
        "op2_secrets": secrets.op2_secrets,
        "op3_quality": quality.op3_quality,
        "op4_licenses": licenses.op4_licenses,
        "op5_mixing": mixing.op5_mixing,
        "op6_media": media.op6_media,
        "op7_packing": packing.op7_packing,
        "op8_toxicity": toxicity.op8_toxicity,
        "op9_neardup": neardup.op9_neardup,
        "op10_fingerprints": fingerprints.op10_fingerprints,
        "op11_manifest": manifest.op11_manifest,
        "op12_jaccard": jaccard.op12_jaccard,
        "op13_alignment": alignment.op13_alignment,
    }


def oracle_sql() -> dict[str, str]:
    return dict(sql.ORACLE_SQL)
