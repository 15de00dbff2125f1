"""Product text: categories and word counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricetide.functions.core import col

# Keyword groups in rule order; the first group with a hit names the category.
CATEGORY_WORDS = {
    "HOME_DECOR": ["DECORATION", "DECOR", "ORNAMENT", "CANDLE", "HOLDER", "FRAME", "MIRROR"],
    "KITCHEN": ["MUG", "CUP", "PLATE", "BOWL", "JAR", "BOTTLE", "KITCHEN", "STORAGE"],
    "STATIONERY": ["CARD", "WRAP", "PAPER", "PEN", "NOTEBOOK", "LABEL", "STAMP"],
    "GIFT": ["GIFT", "BOX", "PACK", "BAG", "WRAP", "RIBBON", "TAG"],
    "SEASONAL": ["CHRISTMAS", "XMAS", "EASTER", "HALLOWEEN", "HEART", "VALENTINE"],
    "TEXTILE": ["CUSHION", "BLANKET", "TOWEL", "FABRIC", "CLOTH", "BAG"],
    "GARDEN": ["GARDEN", "PLANT", "OUTDOOR", "BIRD"],
}
OTHER_CATEGORY = "OTHER"


def categorise(description) -> Column:
    text = F.upper(col(description))
    named = F.when(F.lit(False), F.lit(None).cast("string"))
    for name, words in CATEGORY_WORDS.items():
        named = named.when(text.rlike("|".join(words)), name)
    return named.otherwise(OTHER_CATEGORY)


def word_count(description) -> Column:
    """Words between white space; 0 for an empty or missing text."""
    words = F.filter(F.split(F.coalesce(col(description), F.lit("")), r"\s+"), lambda w: w != "")
    return F.size(words)


def category_label(english, original) -> Column:
    return F.coalesce(col(english), col(original), F.lit("unknown"))
