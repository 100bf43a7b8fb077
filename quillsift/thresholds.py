"""Limits and weights of the checks, equal to the published ones for equal results."""

MASKED_BODY, ORIGINAL_SUPPORT, SHARED_BLOCK_WORDS = 0.88, 0.55, 30
PRIMARY_WEIGHTS = {
    "exact_original_body": 1.0,
    "exact_results_section": 1.0,
    "substantial_shared_original_block": 0.85,
    "strong_masked_body_with_original_support": 0.75,
    "entity_normalized_template": 0.75,
    "distinctive_shared_text": 0.85,
    "masked_title_template_with_original_support": 0.65,
}
SECTION_SUPPORT = {"result": 0.20, "conclusion": 0.20, "background": 0.10, "method": 0.05}
SECTION_SUPPORT_OTHER, SECTION_SUPPORT_GATE, SUPPORT_CAP = 0.05, 0.75, 0.25
HIGH_PRIORITY, MEDIUM_PRIORITY = 0.85, 0.75
TITLE_MIN_WORDS, TITLE_MAX_BUCKET = 4, 50
FAMILY_EDGE, FAMILY_SIZE = 0.75, 3
NGRAM, MIN_SHARED_NGRAMS, MAX_NGRAM_BUCKET, MAX_BUCKET = 5, 3, 50, 50
SECTION_WEIGHTS = {"background": 0.1, "methods": 0.2, "results": 0.4, "conclusions": 0.3}
PERCENT_TOLERANCE = 1.0
TEMPLATE_MASKED, TEMPLATE_ORIGINAL, TEMPLATE_WORDS, TEMPLATE_PLACEHOLDERS = 0.88, 0.55, 30, 0.35
TEMPLATE_SECTION, LOCAL_MASKED, LOCAL_ORIGINAL, LOCAL_SEQUENCE = 0.88, 0.75, 0.60, 0.63
MODERATE_MASKED, MODERATE_ORIGINAL, MODERATE_GLOBAL, MODERATE_WORDS = 0.63, 0.54, 0.27, 60
LOCAL_GLOBAL_ORIGINAL, LOCAL_HIGH, RARE_TITLE_DF = 0.20, 0.85, 3
SENTENCE_WORDS, BLOCK_WORDS, SENTENCE_DF, MEDIUM_COVERAGE, HIGH_COVERAGE, LONE_COVERAGE = 10, 30, 10, 0.15, 0.30, 0.40
RARE_PHRASE_WORDS, RARE_PHRASE_DF, RARE_PHRASE_SIMILARITY = 10, 2, 0.57
NONSENSE_TOKENS, SIGNATURE_BUCKET = 8, 20
RULE_CONFIDENCE = {"strong": 0.98, "contextual": 0.85, "supporting": 0.55}
BATCH_TOKENS, BATCH_RECORDS, BATCH_ATTEMPTS = 7000, 8, 2
INACTIVE = ("candidate", "pending", "rejected", "uncertain", "validation_failed")
REVIEWABLE = ("candidate", "pending", "uncertain")
SEVERITIES = ("none", "low", "medium", "high")
CONFIDENCES = ("low", "medium", "high", "very_high")
