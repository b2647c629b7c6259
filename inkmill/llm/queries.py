"""The queries of this package and their SQL, for the driver's entry module."""

from __future__ import annotations

from inkmill.llm import audio, exact_dedup, language_id, packing, page_diff, piece_codec, pii, quality, simhash, suffix_dedup

QUERIES = {
    "op1_audio_features": audio.op1_audio_features,
    "op2_exact_dedup": exact_dedup.op2_exact_dedup,
    "op3_pii": pii.op3_pii,
    "op4_packing": packing.op4_packing,
    "op5_page_text": page_diff.op5_page_text,
    "op6_quality": quality.op6_quality,
    "op7_language_id": language_id.op7_language_id,
    "op8_suffix_dedup": suffix_dedup.op8_suffix_dedup,
    "op9_sentencepiece": piece_codec.op9_sentencepiece,
    "op10_simhash": simhash.op10_simhash,
}
SQL = {"op2_exact_dedup": exact_dedup.SQL}
