"""Image address lists of product cards."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tradeloom.functions.numbers import as_column, strip

# Last volume of each of the first fifteen shards, the number of
# shards to try, the sizes, and the address form.
SHARD_LAST_VOLUME = (143, 287, 431, 719, 1007, 1061, 1115, 1169, 1313, 1601, 1655, 1919, 2045, 2189, 2405)
SHARDS_TO_TRY = 30
IMAGE_SIZES = ("c516x688", "big", "tm")
IMAGE_ADDRESS = "https://basket-%s.wbbasket.ru/vol%d/part%d/%d/images/%s/1.webp"


def image_url_list(value: Column | str) -> Column:
    """JSON list, a list printed with single quotes, or one address, as an array of text."""
    text = strip(as_column(value).cast("string"))
    listed = text.startswith("[") & text.endswith("]")
    as_json = F.from_json(text, "array<string>")
    swapped = F.from_json(F.translate(text, "'", '"'), "array<string>")
    parsed = F.when(listed, F.coalesce(F.when(~text.contains("'"), as_json), swapped, as_json))
    urls = F.coalesce(parsed, F.array(text))
    kept = F.filter(urls, lambda u: u.isNotNull() & (u != ""))
    return F.when(text != "", kept).otherwise(F.array().cast("array<string>"))


def ordered_image_urls(primary: Column | str, images: Column) -> Column:
    """Primary address first, then the rest without repeats."""
    lead = F.slice(image_url_list(primary), 1, 1)
    rest = F.coalesce(images, F.array().cast("array<string>"))
    lead = F.coalesce(lead, F.array().cast("array<string>"))
    return F.array_distinct(F.filter(F.concat(lead, rest), lambda u: u.isNotNull() & (u != "")))


def shard_of(volume: Column) -> Column:
    """Two-digit shard that holds a volume."""
    shard = F.lit(len(SHARD_LAST_VOLUME) + 1)
    for number, last in reversed(list(enumerate(SHARD_LAST_VOLUME, start=1))):
        shard = F.when(volume <= last, F.lit(number)).otherwise(shard)
    return F.lpad(shard.cast("string"), 2, "0")


def image_url_candidates(nm_id: Column | str) -> Column:
    """All addresses a card image may have, most likely first, without repeats."""
    card = as_column(nm_id).cast("bigint")
    volume = F.floor(card / 100000).cast("bigint")
    part = F.floor(card / 1000).cast("bigint")
    every = F.transform(F.sequence(F.lit(1), F.lit(SHARDS_TO_TRY)), lambda n: F.lpad(n.cast("string"), 2, "0"))
    shards = F.array_distinct(F.concat(F.array(shard_of(volume)), every))
    sizes = F.array(*[F.lit(size) for size in IMAGE_SIZES])
    urls = F.flatten(
        F.transform(
            shards,
            lambda shard: F.transform(
                sizes,
                lambda size: F.format_string(IMAGE_ADDRESS, shard, volume, part, card, size),
            ),
        )
    )
    return F.when(card > 0, urls).otherwise(F.array().cast("array<string>"))


def photo_urls(photos: Column) -> Column:
    """First usable size of each photo struct, without repeats."""
    picked = F.transform(
        photos,
        lambda p: F.coalesce(
            *[
                F.when(strip(p[size]) != "", strip(p[size]))
                for size in ("big", "c516x688", "c246x328", "tm", "square")
            ]
        ),
    )
    return F.coalesce(
        F.array_distinct(F.filter(picked, lambda u: u.isNotNull())),
        F.array().cast("array<string>"),
    )
