"""Mixing sources to target weights, with DataFrame functions only.

1. Targets: sources share all words by weight; a source stops at `cap` times its own words, the excess is shared again.
2. Sainte-Laguë: the words to take are cut into blocks of equal length, and the blocks are given to sources by the
   highest quotients target / (2k - 1). A source's blocks are given to its shards in the same way, by shard size. So
   every shard has an integer quota.
3. Selection: the rows of a shard form a ring of words in a seeded order. The quota is taken from a seeded block on,
   round the ring as often as needed.

Sources are split into shards of about `SHARD_ROWS` rows, so a source with most of the rows is many groups. Only the
tables with a row for each source or shard are ordered as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.session import stage

WEIGHTS = (5, 2, 1)
CAP = 3
BLOCK_WORDS = 16
SHARD_ROWS = 4096
SEED = 42


def ledger(docs: DataFrame, identity: str, source: str, size: Column) -> DataFrame:
    """The rows as the mix needs them: id, source and size, and their other columns in the struct `row`."""
    return docs.select(
        F.struct("*").alias("row"),
        F.col(identity).alias("id"),
        F.col(source).alias("source"),
        size.alias("size"),
    )


def _digest(*parts: Column) -> Column:
    """A seeded number below 2^32."""
    text = F.concat_ws(":", F.lit(str(SEED)), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def targets(per_source: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """Adds `place`, `weight` and `target` to a table of (source, source_size)."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    placed = per_source.withColumn("place", F.row_number().over(by_name))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("place") - 1) % len(weights) + 1).cast("int"))
    # Sources are full in the order of size / weight. If all before the k-th are full, the others share the rest at
    # `rate` words per weight; the first source that this does not overfill fixes the rate.
    fill = Window.orderBy(F.col("full") / F.col("weight"), "place")
    everything = Window.partitionBy()
    rated = (
        placed.withColumn("weight", weight.cast("long"))
        .withColumn("full", F.col("source_size") * cap)
        .withColumn("earlier", F.coalesce(F.sum("full").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("open", F.sum("weight").over(fill.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("words", F.sum("source_size").over(everything))
        .withColumn("rate", (F.col("words") - F.col("earlier")) / F.col("open"))
    )
    rate = F.max(F.when(F.col("full") >= F.col("rate") * F.col("weight"), F.col("rate"))).over(everything)
    return (
        rated.withColumn("fixed", rate)
        .withColumn(
            "target",
            F.coalesce(F.least(F.col("full").cast("double"), F.col("fixed") * F.col("weight")), F.col("full").cast("double")),
        )
        .select("source", "source_size", "shards", "place", "target")
    )


def apportion(df: DataFrame, within: list[str], share: str, seats: str, most: str, order: list[str], out: str) -> DataFrame:
    """Sainte-Laguë: gives `seats` to the rows of each `within` group in proportion to `share`, at most `most` a row.

    A divisor that gives all seats lies so near to shares / seats that a row's seats are known up to a few
    (half a seat for each row of the group, shared by all). Only these few compete by their quotients.
    """
    group = Window.partitionBy(*within)
    total, rows = F.sum(share).over(group), F.count(F.lit(1)).over(group)
    bounds = df.withColumn("_total", total).withColumn("_rows", rows)

    def exact(sign: int) -> Column:
        return F.when(F.col("_total") > 0, F.col(share) * (F.col(seats) + sign * F.col("_rows") / 2.0) / F.col("_total"))

    bounds = bounds.withColumn(
        "_sure", F.least(F.greatest(F.coalesce(F.ceil(exact(-1) - 0.5), F.lit(0)) - 1, F.lit(0)), F.col(most)).cast("long")
    ).withColumn("_last", F.least(F.coalesce(F.floor(exact(1) + 0.5), F.lit(0)) + 1, F.col(most)).cast("long"))
    contested = (
        bounds.withColumn("_left", F.col(seats) - F.sum("_sure").over(group))
        .where("_last > _sure")
        .withColumn("_seat", F.explode(F.sequence(F.col("_sure") + 1, F.col("_last"))))
        .withColumn("_quotient", F.col(share) / (2 * F.col("_seat") - 1))
    )
    rank = F.row_number().over(Window.partitionBy(*within).orderBy(F.col("_quotient").desc(), *order, "_seat"))
    won = (
        contested.withColumn("_rank", rank)
        .where("_rank <= _left")
        .groupBy(*within, *order)
        .agg(F.count(F.lit(1)).alias("_won"))
    )
    keys = list(dict.fromkeys([*within, *order]))
    return (
        bounds.join(won, keys, "left")
        .withColumn(out, F.col("_sure") + F.coalesce("_won", F.lit(0)))
        .drop("_total", "_rows", "_sure", "_last", "_won")
    )


def mix_plan(
    rows: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    cap: int = CAP,
    block_words: int = BLOCK_WORDS,
    shard_rows: int = SHARD_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """Tables of sources (place, target, shards) and of shards (quota of blocks, first block), for a `ledger`."""
    b = block_words
    counted = rows.groupBy("source").agg(
        F.sum("size").alias("source_size"),
        F.ceil(F.count(F.lit(1)) / F.lit(shard_rows)).cast("long").alias("shards"),
    )
    sources = stage(targets(counted, weights, cap), "mix-sources")
    shards = (
        rows.join(sources, rows["source"].eqNullSafe(sources["source"]))
        .groupBy("place", _shard().alias("shard"))
        .agg(F.sum("size").alias("shard_size"))
        .withColumn("blocks", F.ceil(F.col("shard_size") / F.lit(b)).cast("long"))
    )
    shards = stage(shards, "mix-shards")
    most = shards.groupBy("place").agg((F.sum("blocks") * cap).alias("most"))
    wanted = F.round(F.sum("source_size").over(Window.partitionBy()) / F.lit(b)).cast("long")
    quotas = apportion(
        sources.join(most, "place").withColumn("all", F.lit(0)).withColumn("wanted", wanted),
        ["all"], "target", "wanted", "most", ["place"], "source_quota",
    ).select("place", "source_quota")
    given = apportion(
        shards.join(quotas, "place").withColumn("most", F.col("blocks") * cap),
        ["place"], "shard_size", "source_quota", "most", ["shard"], "quota",
    )
    first = F.when(F.col("blocks") > 0, _digest(F.lit("first"), F.col("place"), F.col("shard")) % F.col("blocks"))
    return sources, stage(
        given.select("place", "shard", "blocks", "quota", F.coalesce(first, F.lit(0)).alias("first")), "mix-quotas"
    )


def _shard() -> Column:
    return _digest(F.lit("shard"), F.col("id")) % F.col("shards")


def place_rows(
    rows: DataFrame, sources: DataFrame, quotas: DataFrame, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """What the mix takes of each row of a `ledger`.

    Result: row, id, size, source_size, target (the source's), rounds (whole copies), parts (at most two word ranges
    [start, end) taken once more) and taken = rounds * size + the words of the parts.
    """
    b = block_words
    known = rows.join(sources, rows["source"].eqNullSafe(sources["source"])).drop(sources["source"])
    known = known.withColumn("shard", _shard()).join(quotas, ["place", "shard"])
    ring = Window.partitionBy("place", "shard").orderBy(_digest(F.lit("row"), F.col("id")), "id", "size")
    start = F.sum("size").over(ring.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    placed = (
        known.withColumn("start", start)
        .withColumn("rounds", F.when(F.col("blocks") > 0, F.floor(F.col("quota") / F.col("blocks"))).otherwise(0).cast("long"))
        .withColumn("more", F.col("quota") - F.col("rounds") * F.col("blocks"))
        .withColumn("end_block", F.col("first") + F.col("more"))
    )

    def part(low: Column, high: Column) -> Column:
        """Words of the row inside the words [low, high) of the ring."""
        begin, end = F.greatest(low - F.col("start"), F.lit(0)), F.least(high - F.col("start"), F.col("size"))
        return F.struct(begin.cast("long").alias("start"), F.greatest(end, begin).cast("long").alias("end"))

    parts = F.array(
        part(F.lit(0), F.greatest(F.col("end_block") - F.col("blocks"), F.lit(0)) * b),
        part(F.col("first") * b, F.least(F.col("end_block"), F.col("blocks")) * b),
    )
    return (
        placed.withColumn("parts", F.filter(parts, lambda p: p["end"] > p["start"]))
        .withColumn(
            "taken",
            F.col("rounds") * F.col("size")
            + F.aggregate("parts", F.lit(0).cast("long"), lambda n, p: n + p["end"] - p["start"]),
        )
        .select("row", "id", "size", "source_size", "target", "rounds", "parts", "taken")
    )


def mix(
    docs: DataFrame, identity: str, source: str, size: Column, carry: bool = False, **parameters
) -> DataFrame:
    """What is taken of each row, see `place_rows`. With `carry`, `row` holds the row's own columns, else it is null.

    Sizes are whole numbers, null counts as 0. A null source is a source, the last. Rows with equal ids are rows of
    their own; a source without words takes part with target 0. No rows give no rows. Reruns give equal results.
    """
    block = {"block_words": parameters.get("block_words", BLOCK_WORDS)}
    full = ledger(docs, identity, source, F.coalesce(size, F.lit(0)).cast("long"))
    slim = stage(full.drop("row"), "mix-ledger")
    sources, quotas = mix_plan(slim, **parameters)
    return place_rows(full if carry else slim.withColumn("row", F.lit(None)), sources, quotas, **block)


def mixed_texts(mixed: DataFrame, text: str, length: str = "n_chars") -> DataFrame:
    """The rows of the mix itself: each row `rounds` times, and once more with the words of its parts, if any.

    Columns are those of `row`; `length`, if there is such a column, is the length of the new text. The parts of a text
    are joined by a space and keep the gaps inside them.
    """
    words = F.regexp_extract_all(F.col(f"row.{text}"), F.lit(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"), F.lit(0))
    pieces = F.transform(
        "parts",
        lambda p: F.rtrim(F.array_join(F.slice(words, (p["start"] + 1).cast("int"), (p["end"] - p["start"]).cast("int")), "")),
    )
    taken_parts = F.aggregate("parts", F.lit(0).cast("long"), lambda n, p: n + p["end"] - p["start"])
    partial = F.when(taken_parts == F.col("size"), F.col(f"row.{text}")).otherwise(F.array_join(pieces, " "))
    copies = F.concat(
        F.array_repeat(F.col(f"row.{text}"), F.col("rounds").cast("int")),
        F.when(F.size("parts") > 0, F.array(partial)).otherwise(F.array().cast("array<string>")),
    )

    def column(field) -> Column:
        if field.name == text:
            return F.col("copy").alias(text)
        if field.name == length:
            return F.length("copy").cast(field.dataType).alias(length)
        return F.col(f"row.`{field.name}`").alias(field.name)

    copied = mixed.select("row", F.explode(copies).alias("copy"))
    return copied.select(*[column(f) for f in mixed.schema["row"].dataType.fields])
