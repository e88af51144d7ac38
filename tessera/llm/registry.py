"""The queries of this subpackage and the SQL that some of them can be held against."""

from tessera.llm import html_extract, media, mixing, quality, sentencepiece_sampling, sharding, simhash, substring, token_files, warc

QUERIES = {
    "op1_html": html_extract.op1_html,
    "op2_sharding": sharding.op2_sharding,
    "op3_simhash": simhash.op3_simhash,
    "op4_substring": substring.op4_substring,
    "op5_media": media.op5_media,
    "op6_sentencepiece": sentencepiece_sampling.op6_sentencepiece,
    "op7_warc": warc.op7_warc,
    "op8_token_files": token_files.op8_token_files,
    "op9_mixing": mixing.op9_mixing,
    "op10_quality": quality.op10_quality,
    # Parts of op5 and op10 that SQL can express.
    "media_payloads": media.media_payloads,
    "quality_base": quality.quality_base,
}

ORACLE = {
    "op2_sharding": sharding.oracle(),
    "op4_substring": substring.oracle(),
    "op7_warc": warc.oracle(),
    "op9_mixing": mixing.oracle(),
    "media_payloads": media.payload_oracle(),
    "quality_base": quality.base_oracle(),
}
