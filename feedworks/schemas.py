"""Feed layouts (positional, all text) and target table schemas (K1)."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names of the three feeds, in file order.  Binding is by
# position; the header row of a feed is discarded.
USERS_COLUMNS = ["author_id", "author_name", "gender", "age", "followers_count",
                 "following_count", "user_followers", "user_following"]

RECIPES_COLUMNS = [
    "recipe_id", "recipe_name", "author_id", "author_name", "cook_time", "prep_time",
    "total_time", "date_published", "description", "recipe_category", "keywords",
    "recipe_ingredient", "aggregated_rating", "review_count", "calories", "fat_content",
    "saturated_fat_content", "cholesterol_content", "sodium_content", "carbohydrate_content",
    "fiber_content", "sugar_content", "protein_content", "recipe_servings", "recipe_yield",
    "recipe_instructions", "favorite_users",
]

REVIEWS_COLUMNS = ["review_id", "recipe_id", "author_id", "author_name", "rating",
                   "review_content", "date_submitted", "date_modified", "likes"]

CORRUPT_COLUMN = "_corrupt_record"


def raw_schema(columns: list[str], with_corrupt: bool = True) -> T.StructType:
    fields = [T.StructField(c, T.StringType(), True) for c in columns]
    if with_corrupt:
        fields.append(T.StructField(CORRUPT_COLUMN, T.StringType(), True))
    return T.StructType(fields)


USERS = T.StructType([
    T.StructField("author_id", T.IntegerType(), False),
    T.StructField("author_name", T.StringType(), False),
    T.StructField("gender", T.StringType(), True),
    T.StructField("age", T.IntegerType(), True),
    T.StructField("followers_count", T.IntegerType(), True),
    T.StructField("following_count", T.IntegerType(), True),
])

USER_FOLLOWERS = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("user_id", T.IntegerType(), False),
    T.StructField("follower_id", T.IntegerType(), False),
])

USER_FOLLOWING = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("user_id", T.IntegerType(), False),
    T.StructField("following_id", T.IntegerType(), False),
])

_NUTRITION = ["calories", "fat_content", "saturated_fat_content", "cholesterol_content",
              "sodium_content", "carbohydrate_content", "fiber_content", "sugar_content",
              "protein_content"]
RECIPE_INT_COLUMNS = ["review_count"] + _NUTRITION + ["recipe_servings"]

RECIPES = T.StructType(
    [T.StructField("recipe_id", T.IntegerType(), False),
     T.StructField("recipe_name", T.StringType(), False),
     T.StructField("author_id", T.IntegerType(), True),
     T.StructField("cook_time", T.StringType(), True),
     T.StructField("prep_time", T.StringType(), True),
     T.StructField("total_time", T.StringType(), True),
     T.StructField("date_published", T.DateType(), True),
     T.StructField("description", T.StringType(), True),
     T.StructField("recipe_category", T.StringType(), True),
     T.StructField("aggregated_rating", T.DecimalType(3, 1), True)]
    + [T.StructField(c, T.IntegerType(), True) for c in RECIPE_INT_COLUMNS]
    + [T.StructField("recipe_yield", T.StringType(), True),
       T.StructField("favorite_users", T.ArrayType(T.StringType()), True)])

KEYWORDS = T.StructType([
    T.StructField("keyword_id", T.LongType(), False),
    T.StructField("recipe_id", T.IntegerType(), False),
    T.StructField("keyword_text", T.StringType(), False),
])

RECIPE_INGREDIENTS = T.StructType([
    T.StructField("ingredient_id", T.LongType(), False),
    T.StructField("recipe_id", T.IntegerType(), False),
    T.StructField("ingredient_text", T.StringType(), False),
])

RECIPE_INSTRUCTIONS = T.StructType([
    T.StructField("instruction_id", T.LongType(), False),
    T.StructField("recipe_id", T.IntegerType(), False),
    T.StructField("step_order", T.IntegerType(), False),
    T.StructField("instruction_text", T.StringType(), False),
])

REVIEWS = T.StructType([
    T.StructField("review_id", T.IntegerType(), False),
    T.StructField("recipe_id", T.IntegerType(), True),
    T.StructField("author_id", T.IntegerType(), False),
    T.StructField("rating", T.IntegerType(), True),
    T.StructField("review_content", T.StringType(), True),
    T.StructField("date_submitted", T.DateType(), True),
    T.StructField("date_modified", T.DateType(), True),
])

REVIEW_LIKERS = T.StructType([
    T.StructField("like_id", T.LongType(), False),
    T.StructField("review_id", T.IntegerType(), False),
    T.StructField("liker_id", T.IntegerType(), False),
])

TARGETS = {
    "users": USERS, "user_followers": USER_FOLLOWERS, "user_following": USER_FOLLOWING,
    "recipes": RECIPES, "keywords": KEYWORDS, "recipe_ingredients": RECIPE_INGREDIENTS,
    "recipe_instructions": RECIPE_INSTRUCTIONS, "reviews": REVIEWS,
    "review_likers": REVIEW_LIKERS,
}

REJECTS = T.StructType([
    T.StructField("table", T.StringType(), True),
    T.StructField("key", T.StringType(), True),
    T.StructField("reject_reason", T.StringType(), True),
    T.StructField("record", T.StringType(), True),
    T.StructField("lines", T.IntegerType(), True),
])

PARTITION_COUNTS = T.StructType([
    T.StructField("table", T.StringType(), True),
    T.StructField("partition", T.IntegerType(), True),
    T.StructField("stage", T.StringType(), True),
    T.StructField("rows", T.LongType(), True),
])
