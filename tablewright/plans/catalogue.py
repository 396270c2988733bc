"""Column names of the catalogue table and the rules tied to them. All fixed values."""

from __future__ import annotations

from tablewright.operators.quality import RangeRule

RAW_PATTERN = "games_*.csv"
DERIVED_FILES = ("games_cleaned.csv", "games_engineered.csv")

RAW_COLUMNS = (
    "AppID", "Name", "Release date", "Price", "Windows", "Mac", "Linux", "Metacritic score",
    "Achievements", "Developers", "Publishers", "Categories", "Genres", "User score",
    "Score rank", "Positive", "Negative", "Estimated owners",
)
KEY = ("AppID",)
PLATFORMS = ("Windows", "Mac", "Linux")
RAW_NUMBERS = ("Price", "Metacritic score", "Achievements", "User score", "Score rank", "Positive",
               "Negative", "Estimated owners")
TEXTS = ("Name", "Developers", "Publishers", "Categories", "Genres")

SCORE_EDGES = (0, 50, 70, 80, 100)
SCORE_LABELS = ("Poor", "Fair", "Good", "Excellent")
PRICE_EDGES = (-0.01, 0, 9.99, 19.99, 49.99, float("inf"))
PRICE_LABELS = ("Free", "Budget", "Standard", "Premium", "AAA")
CATEGORIES = ("Metacritic_category", "Price_category")

# Output names of the z-scores. 'User score' gets its own name: 'User_score_normalized' is the
# score divided by ten, and the two differ by one blank only.
SCALED = {
    "Price": "Price_normalized",
    "Metacritic score": "Metacritic score_normalized",
    "User score": "user_score_z",
    "Positive": "Positive_normalized",
    "Negative": "Negative_normalized",
    "Review_ratio": "Review_ratio_normalized",
    "Achievements": "Achievements_normalized",
    "Days_since_release": "Days_since_release_normalized",
}

FINAL_COLUMNS = (
    "AppID", "Name", "Genres", "Release_year", "Days_since_release", "Platform_count", "Price",
    "Is_free", "Total_reviews", "Review_ratio", "Is_highly_rated", "Log_owners",
    "Has_achievements", "Log_total_reviews", "Genre_count",
)
LABEL = "Is_highly_rated"
NOT_FEATURES = ("AppID", "Name", "Genres")
NOT_PROFILED = ("AppID", "Is_free", "Has_achievements", "Is_highly_rated")

FEATURE_GROUPS = {
    "identifiers": ("AppID", "Name"),
    "temporal": ("Release_year", "Days_since_release"),
    "platform": ("Platform_count",),
    "reviews": ("Total_reviews", "Review_ratio", "Log_total_reviews"),
    "scores": ("Is_highly_rated",),
    "content": ("Log_owners", "Has_achievements", "Genre_count"),
    "price": ("Price", "Is_free"),
    "metadata": ("Genres",),
}

DESCRIPTIONS = {
    "AppID": "Unique id of the item",
    "Name": "Name of the item",
    "Genres": "Genres, separated by commas",
    "Release_year": "Year of release",
    "Days_since_release": "Days since release",
    "Platform_count": "Number of platforms, 0 to 3",
    "Price": "Price in USD",
    "Is_free": "1 if free",
    "Total_reviews": "Positive and negative reviews together",
    "Review_ratio": "Share of positive reviews",
    "Is_highly_rated": "1 if at least 30 reviews and 80 % positive",
    "Log_owners": "log1p of the estimated owners",
    "Has_achievements": "1 if the item has achievements",
    "Log_total_reviews": "log1p of the total reviews",
    "Genre_count": "Number of genres",
}

RANGE_RULES = (RangeRule("Price", 0), RangeRule("Metacritic score", 0, 100))
MOMENT_COLUMNS = ("Price", "Metacritic score", "User score", "Positive", "Negative",
                  "Days_since_release")
