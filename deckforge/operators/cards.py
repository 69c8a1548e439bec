"""J4 request/response matching and F5-F7 card normalisation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_EMPTY_ITEMS = "array<struct<term:string,translation:string,nuance:string,example:string>>"
_EMPTY_SECTIONS = ("array<struct<title:string,items:array<struct<term:string,translation:string,"
                   "nuance:string,example:string>>>>")


def best_responses(checked: DataFrame, key: str = "request_id", order_col: str | None = None,
                   body_col: str = "body") -> DataFrame:
    """One checked response (see ``validate_cards``) per request: a valid one before any that isn't,
    then the first by ``order_col`` (attempt or time of receipt), then by body.

    The choice is made on a narrow key (validity, order, hash of the body), combined map-side, so a
    request answered many times never lands whole in one task and no body is sorted to choose."""
    order = F.col(order_col) if order_col else F.lit(0)
    rank = F.struct((~F.col("valid")).alias("bad"), order.alias("nth"), F.xxhash64(body_col).alias("h"))
    ranked = checked.withColumn("_rank", rank)
    first = ranked.groupBy(key).agg(F.min("_rank").alias("_first"))
    chosen = ranked.join(first, key).filter(F.col("_rank").eqNullSafe(F.col("_first")))
    return chosen.drop("_rank", "_first").dropDuplicates([key])


def match_responses(requests: DataFrame, checked: DataFrame, key: str = "request_id",
                    order_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(requests with their best checked response, unanswered requests)."""
    best = best_responses(checked, key, order_col)
    own = [c for c in best.columns if c == key or c not in requests.columns]
    matched = requests.join(best.select(*own), key)
    unanswered = requests.join(checked.select(key), key, "left_anti")
    return matched, unanswered


def normalize_cards(cards: DataFrame, card: str = "card", item_col: str = "item",
                    minimal_col: str = "minimal_cards", customization_col: str = "customization") -> DataFrame:
    """The card's source becomes the cleaned request item (it feeds the
    ids); custom sections are cleared unless the deck has customization lines;
    minimal decks lose every note list."""
    c = F.col(card)
    minimal = F.coalesce(F.col(minimal_col), F.lit(False))
    has_custom = F.size(F.coalesce(F.col(customization_col), F.array().cast("array<string>"))) > 0
    fixed = (c.withField("source", F.col(item_col))
             .withField("word_family", F.when(minimal, F.array().cast(_EMPTY_ITEMS)).otherwise(c["word_family"]))
             .withField("related_vocab", F.when(minimal, F.array().cast(_EMPTY_ITEMS)).otherwise(c["related_vocab"]))
             .withField("custom_sections", F.when(minimal | ~has_custom, F.array().cast(_EMPTY_SECTIONS))
                        .otherwise(c["custom_sections"])))
    return cards.withColumn(card, F.when(c.isNotNull(), fixed))
