"""Fixed values of the domain: word lists, ordinals, categories, formats. They must be these for right results."""

from __future__ import annotations

# Ordinal words after cleanup and their numbers, in lookup order.
ORDINALS = [
    ("الحادي والعشرين", 21), ("الحادي عشر", 11), ("الثاني عشر", 12), ("الثالث عشر", 13), ("الرابع عشر", 14), ("الخامس عشر", 15),
    ("السادس عشر", 16), ("السابع عشر", 17), ("الثامن عشر", 18), ("التاسع عشر", 19), ("العشرون", 20), ("الاولي", 1), ("الاول", 1),
    ("الثانية", 2), ("الثاني", 2), ("الثالثة", 3), ("الثالث", 3), ("الرابعة", 4), ("الرابع", 4), ("الخامسة", 5), ("الخامس", 5),
    ("السادسة", 6), ("السادس", 6), ("السابعة", 7), ("السابع", 7), ("الثامنة", 8), ("الثامن", 8), ("التاسعة", 9), ("التاسع", 9),
    ("العاشرة", 10), ("العاشر", 10),
]

# Patterns of article markers in normalised text.
MARKER_ORDINALS = r"الحادي\s+والعشرين|الحادي\s+عشر[ة]?|الثاني\s+عشر[ة]?|الثالث\s+عشر[ة]?|الرابع\s+عشر[ة]?|الخامس\s+عشر[ة]?|السادس\s+عشر[ة]?|السابع\s+عشر[ة]?|الثامن\s+عشر[ة]?|التاسع\s+عشر[ة]?|العشرون|العاشر[ة]?|التاسع[ة]?|الثامن[ة]?|السابع[ة]?|السادس[ة]?|الخامس[ة]?|الرابع[ة]?|الثالث[ة]?|الثاني[ة]?|الاولي|الاول"
MARKER_LEAD = r"^#{0,6}[ \t]*[:؛.,\-()]{0,2}[ \t]*"
MARKER_DIGITS = r"[\d٠-٩۰-۹]"
MARKER_WORD = r"(?:مادة|ماده|المادة|الماده)"
MARKER_NOT_LAW = r"(?![ \t\n]*من\s+(?:هذا\s+|ذلك\s+)?(?:القانون|المشروع))"
MARKER_BIS = r"(?:\s*\)?\s*مكرر[ةا]?(?:\s+[أ-ي](?=[\s:\)]))?\s*\)?)?"
MARKER_ISSUANCE = rf"{MARKER_LEAD}\(\s*المادة\s+(?:{MARKER_ORDINALS})\s*\)"
MARKER_PAREN = rf"{MARKER_LEAD}{MARKER_WORD}\s*\(\s*{MARKER_DIGITS}+\s*\){MARKER_BIS}{MARKER_NOT_LAW}"
MARKER_PLAIN = rf"{MARKER_LEAD}{MARKER_WORD}\s+{MARKER_DIGITS}+(?!{MARKER_DIGITS})(?![ \t\n]*[،,]){MARKER_BIS}{MARKER_NOT_LAW}"

# Patterns of numbered headings and of abbreviated markers.
HEADING_ORDINALS = r"ال[أا]ول[ىة]?|الثاني[ة]?|الثالث[ة]?|الرابع[ة]?|الخامس[ة]?|السادس[ة]?|السابع[ة]?|الثامن[ة]?|التاسع[ة]?|العاشر[ة]?|الحادي\s+عشر[ة]?|الثاني\s+عشر[ة]?|الثالث\s+عشر[ة]?|الرابع\s+عشر[ة]?|الخامس\s+عشر[ة]?|السادس\s+عشر[ة]?|السابع\s+عشر[ة]?|الثامن\s+عشر[ة]?|التاسع\s+عشر[ة]?|العشرون|الحادي\s+والعشرون"
HEADING = rf"(?:الباب|الفصل|القسم|الكتاب|الفرع)\s+(?:{HEADING_ORDINALS}|\d+|[٠-٩]+)"
ABBREVIATED = r"(?<!\w)ما\s{0,3}(?=\d)(\d+|[٠-٩]+)"

# Categories of an article, and domains that a law may apply to.
CATEGORIES = ["تعريف", "حق", "التزام", "إجراء", "عقوبة", "تنظيمية", "انتقالية", "إصدار", "أخرى"]
OTHER = "أخرى"
DOMAINS = ["civil", "commercial", "criminal", "administrative", "employment", "family", "real_estate", "digital", "procedural"]

# Where a page's text begins and ends among a site's navigation.
CONTENT_STARTS = ["نص التشريع", "نص القانون", "نص اللائحة"]
FOOTERS = ["Creative Commons", "← قانون", "سياسة الخصوصية", "\nIcons and photos"]

# Thresholds, limits and prices.
CONFIDENCE, MIN_CHARS, DUPLICATE_HALF = 0.85, 200, 5
CHUNK_WORDS, OVERLAP_WORDS, SEMANTIC_SHARE = 250, 30, 0.85
BATCH_SIZE, OCR_PAGES, OCR_MIN_PAGES, OCR_CHARS_PER_PAGE, LOOKBACK = 150, 15, 10, 150, 40
PRICE_IN, PRICE_OUT, PRICE_IMAGE = 0.10, 0.40, 0.00258
ARTICLE_SCHEMA, RELEASE_SCHEMA, PIPELINE_VERSION = "1.1", "1.0", "1.1.0"

# Names and texts (for printf) of the issues of a split.
SPLIT_ISSUES = {
    "E001": ("MISSING_ARTICLE", "Article %d expected but not found in split output"),
    "E002": ("DUPLICATE_ARTICLE", "Article %d appears %d times: %s"),
    "E003": ("SEQUENCE_GAP", "Article %d missing and not in repealed_articles (neighbours present — likely a split error)"),
    "E004": ("EMPTY_BODY", "Article body is empty or near-empty (%d chars)"),
    "E005": ("OVERSIZED_ARTICLE", "Article %d has %d words (median=%d, ceiling=%d) — review manually: may be a merged split or a genuine long article"),
    "E006": ("ORPHAN_TEXT", "%d chars appear before the first article marker — unusually large preamble, check for missed markers"),
    "W001": ("OVER_COUNT", "Found %d articles but expected %d (%s of expected) — check for false marker matches"),
    "W002": ("UNDER_COUNT", "Found %d articles but expected %d (%s of expected) — possible missed markers"),
    "W003": ("ISSUANCE_MISMATCH", "No issuance articles found for a law with %d articles — ordinal marker patterns may not have matched"),
}

# Texts (for printf) of the issues of an enriched corpus.
CORPUS_ISSUES = {
    "V001": "Required field '%s' is missing or empty",
    "V002": "Invalid category '%s' — must be one of %s",
    "V003": "Stage 3 enrichment failed: %s",
    "V004": "is_repealed=%s but registry says %s",
    "V005": "keywords list is empty",
}

# The files of a release.
RELEASE_FILES = {"articles_json": "articles.json", "articles_jsonl": "articles.jsonl", "chunks_json": "chunks.json", "chunks_jsonl": "chunks.jsonl"}
