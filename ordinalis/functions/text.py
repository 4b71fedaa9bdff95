"""Text expressions: cleaning, emoji test, duration, phrase flags, length and importance."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Keyword replacements, applied in this order, case-sensitive.
# The class after "bagus" is Unicode letters, digits and underscore; plain \w is ASCII in Java.
KEYWORD_REPLACEMENTS = (
    ("push", "good"),
    ("Keep", "great"),
    (r"bagus[\p{L}\p{N}_]*", "good"),
    ("challenging", "troublesome"),
)

# Phrase patterns looked for in the developer's reply, any case.
REPLY_PATTERNS = {
    "has_5star": "5-star|5 stars|five-star|five stars",
    "has_issues": "issues|issue|problem",
    "has_sorry": "sorry|apologize",
    "has_transactions": "transactions",
    "has_thanks": "thanks",
    "has_bank_handle": "@BANK.co.id.",
    "has_phone": "08121214017",
}

# Single code points with the Unicode 14 Emoji property (hex), without digits,
# '#', '*' and the regional indicators.
EMOJI_CODE_POINTS = """
A9 AE 203C 2049 2122 2139 2194-2199 21A9-21AA 231A-231B 2328 23CF 23E9-23F3 23F8-23FA 24C2 25AA-25AB
25B6 25C0 25FB-25FE 2600-2604 260E 2611 2614-2615 2618 261D 2620 2622-2623 2626 262A 262E-262F 2638-263A
2640 2642 2648-2653 265F-2660 2663 2665-2666 2668 267B 267E-267F 2692-2697 2699 269B-269C 26A0-26A1 26A7
26AA-26AB 26B0-26B1 26BD-26BE 26C4-26C5 26C8 26CE-26CF 26D1 26D3-26D4 26E9-26EA 26F0-26F5 26F7-26FA 26FD
2702 2705 2708-270D 270F 2712 2714 2716 271D 2721 2728 2733-2734 2744 2747 274C 274E 2753-2755 2757
2763-2764 2795-2797 27A1 27B0 27BF 2934-2935 2B05-2B07 2B1B-2B1C 2B50 2B55 3030 303D 3297 3299 1F004
1F0CF 1F170-1F171 1F17E-1F17F 1F18E 1F191-1F19A 1F201-1F202 1F21A 1F22F 1F232-1F23A 1F250-1F251
1F300-1F321 1F324-1F393 1F396-1F397 1F399-1F39B 1F39E-1F3F0 1F3F3-1F3F5 1F3F7-1F4FD 1F4FF-1F53D
1F549-1F54E 1F550-1F567 1F56F-1F570 1F573-1F57A 1F587 1F58A-1F58D 1F590 1F595-1F596 1F5A4-1F5A5 1F5A8
1F5B1-1F5B2 1F5BC 1F5C2-1F5C4 1F5D1-1F5D3 1F5DC-1F5DE 1F5E1 1F5E3 1F5E8 1F5EF 1F5F3 1F5FA-1F64F
1F680-1F6C5 1F6CB-1F6D2 1F6D5-1F6D7 1F6DD-1F6E5 1F6E9 1F6EB-1F6EC 1F6F0 1F6F3-1F6FC 1F7E0-1F7EB 1F7F0
1F90C-1F93A 1F93C-1F945 1F947-1F9FF 1FA70-1FA74 1FA78-1FA7C 1FA80-1FA86 1FA90-1FAAC 1FAB0-1FABA
1FAC0-1FAC5 1FAD0-1FAD9 1FAE0-1FAE7 1FAF0-1FAF6
"""


def _emoji_class() -> str:
    """Regex character class over the table above; Java and RE2 read it alike."""
    parts = []
    for item in EMOJI_CODE_POINTS.split():
        parts.append("-".join(rf"\x{{{end}}}" for end in item.split("-")))
    return "[" + "".join(parts) + "]"


EMOJI_ONLY = rf"^{_emoji_class()}*\z"


def replace_keywords(text: Column) -> Column:
    for pattern, word in KEYWORD_REPLACEMENTS:
        text = F.regexp_replace(text, pattern, word)
    return text


def fill_null(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def is_emoji_only(raw: Column) -> Column:
    """True when every code point is an emoji; an empty or missing text counts as such."""
    return fill_null(raw).rlike(EMOJI_ONLY)


def clean_working_text(working: Column, raw: Column) -> Column:
    """Keyword replacement, null filling, then 'great' where the *raw* review is emoji only."""
    return F.when(is_emoji_only(raw), F.lit("great")).otherwise(fill_null(replace_keywords(working)))


def leading_days(duration: Column) -> Column:
    """The first whitespace-separated token as an integer, else null."""
    digits = F.regexp_extract(duration, r"^\s*([+-]?[0-9]+)(?=\s|$)", 1)
    return F.nullif(digits, F.lit("")).try_cast("bigint")


def contains(text: Column, pattern: str) -> Column:
    """0/1: the pattern occurs, ignoring case by Unicode rules; only LF ends a line."""
    return text.rlike(f"(?iud){pattern}").cast("int")


def phrase_flags(working: Column, reply: Column) -> list[Column]:
    flags = [contains(reply, pattern).alias(name) for name, pattern in REPLY_PATTERNS.items()]
    return [*flags, contains(working, r"\?").alias("has_question_mark")]


def importance(length: Column, thumbs: Column) -> Column:
    """ln(length + 1) * ln(thumbs + 1)."""
    return F.ln(length + 1) * F.ln(thumbs + 1)
