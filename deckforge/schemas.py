"""Declared schemas. Nothing in deckforge infers a schema."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

S = StringType()

NOTE_ITEM = StructType([
    StructField("term", S), StructField("translation", S),
    StructField("nuance", S), StructField("example", S),
])
EXAMPLE = StructType([StructField("target", S), StructField("origin", S)])
SECTION = StructType([StructField("title", S), StructField("items", ArrayType(NOTE_ITEM))])
# --- fixed values: card bounds ------------------------------------------------
# examples 2..3, word_family 0..6, related_vocab 0..8, custom_sections 0..6,
# items per custom section 1..8.
EXAMPLES_MIN, EXAMPLES_MAX = 2, 3
WORD_FAMILY_MAX = 6
RELATED_VOCAB_MAX = 8
CUSTOM_SECTIONS_MAX = 6
SECTION_ITEMS_MIN, SECTION_ITEMS_MAX = 1, 8
# Side files (customization / blacklist) may hold at most 8,192 bytes.
SIDE_FILE_MAX_BYTES = 8192
# ------------------------------------------------------------------------------

# Deck configuration as it arrives (every field a string, unset = NULL or "").
RAW_CONFIG_FIELDS = [
    "origin_language", "target_language", "notes_language", "cefr_level",
    "text_model", "reasoning_effort", "audio_model", "audio_voice", "deck_name",
    "input_path", "output_path", "customization_path", "blacklist_path",
    "generate_audio", "minimal_cards", "overwrite_output",
]
RAW_CONFIG = StructType([StructField("deck_id", LongType())]
                        + [StructField(f, S) for f in RAW_CONFIG_FIELDS])

GENERATE_OUT = StructType([
    StructField("request_id", S), StructField("attempt", LongType()), StructField("body", S),
    StructField("code", S), StructField("error", S),
])
SYNTH_OUT = StructType([
    StructField("media_id", S), StructField("file_name", S), StructField("audio_model", S),
    StructField("audio_voice", S), StructField("content", BinaryType()), StructField("code", S),
    StructField("error", S),
])
