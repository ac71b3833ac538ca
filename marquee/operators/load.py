"""Warehouse load: signature dedupe, list columns -> bridge tables, listing.

All steps are set operations over the whole fact table; nothing is looped
per file or per event on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedupe_by_key(df: DataFrame, key: str | list[str], order_by: list[str],
                  count_col: str | None = None) -> DataFrame:
    """Keep one row per ``key``: the first by ``order_by`` (a deterministic
    survivor, where a constant ORDER BY would leave it arbitrary).

    Written as ``min_by(row, order)`` aggregation rather than a ranking
    window: the aggregate is partial on the map side, so a signature that
    repeats a billion times shuffles one candidate per map task, not every
    copy.  ``count_col`` optionally reports how many copies there were.
    """
    keys = [key] if isinstance(key, str) else key
    others = [c for c in df.columns if c not in keys]
    aggs = [F.min_by(F.struct(*others), F.struct(*order_by)).alias("_r")]
    if count_col:
        aggs.append(F.count("*").alias(count_col))
    out = df.groupBy(*keys).agg(*aggs)
    return out.select(*keys, "_r.*", *([count_col] if count_col else []))


def bridge(df: DataFrame, id_col: str, list_col: str, value_name: str,
           value_type: str | None = None) -> DataFrame:
    """Array column -> distinct (id, value) bridge rows; empty/null lists vanish."""
    out = (df.filter(F.size(list_col) > 0)
             .select(F.col(id_col), F.explode(list_col).alias(value_name)))
    if value_type:
        out = out.withColumn(value_name, F.col(value_name).cast(value_type))
    return out.filter(F.col(value_name).isNotNull()).distinct()


def event_listing(event: DataFrame, venue: DataFrame, artist: DataFrame,
                  event_to_artist: DataFrame, event_ticket_price: DataFrame) -> DataFrame:
    """The analytical listing of the warehouse.

    Inputs use the warehouse column names: event(id, event_name, venue_id,
    start_date, end_date, gross_receipts_us, attendance), venue(id, name),
    artist(id, name), event_to_artist(event_id, artist_id),
    event_ticket_price(event_id, ticket_price).  Both bridges are aggregated
    per event *before* the join (the aggregates arrive hash-partitioned on
    event_id, so the join to them reuses that partitioning); events without a
    venue, an artist or a price drop out (inner joins), as in the listing.
    """
    names = (event_to_artist.join(artist.select(F.col("id").alias("artist_id"), "name"), "artist_id")
             .groupBy("event_id")
             .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("name", "artist_id"))),
                                           lambda s: s["name"]), ", ").alias("artists")))
    prices = (event_ticket_price.groupBy("event_id")
              .agg(F.array_join(F.transform(F.array_sort(F.collect_list("ticket_price")),
                                            lambda p: p.cast("string")), ", ").alias("ticket_prices")))
    return (event.withColumnRenamed("id", "event_id")
            .join(venue.select(F.col("id").alias("venue_id"), F.col("name").alias("venue")), "venue_id")
            .join(names, "event_id")
            .join(prices, "event_id")
            .orderBy("start_date", "event_id")
            .select("event_id", "event_name", "artists",
                    F.date_format("start_date", "MM/dd/yyyy").alias("start_date"),
                    F.date_format("end_date", "MM/dd/yyyy").alias("end_date"),
                    "venue", "ticket_prices",
                    F.col("gross_receipts_us").alias("gross_revenue"), "attendance"))


UNKNOWN = -1


def place_chain(venue: DataFrame, city: DataFrame, state: DataFrame, country: DataFrame) -> DataFrame:
    """Venue -> city -> state -> country: ids and names at every level; a gap
    is the Unknown member (-1), and so is every level above it."""
    def level(name: str, dim: DataFrame, up: str | None = None) -> DataFrame:
        d = dim.groupBy(F.col("id").alias(f"{name}_id")).agg(F.min("name").alias(f"{name}_name"), *([F.min(up).alias(f"_{up}")] if up else []))
        return d

    def climb(rows: DataFrame, name: str, dim: DataFrame, up: str | None = None) -> DataFrame:
        out = rows.join(level(name, dim, up), f"{name}_id", "left")
        known = F.col(f"{name}_name").isNotNull()
        out = out.withColumn(f"{name}_id", F.when(known, F.col(f"{name}_id")).otherwise(F.lit(UNKNOWN)))
        out = out.withColumn(f"{name}_name", F.coalesce(f"{name}_name", F.lit("Unknown")))
        return out.withColumnRenamed(f"_{up}", up) if up else out

    rows = venue.select(F.col("id").alias("venue_id"), F.col("name").alias("venue_name"), F.col("city_id"))
    rows = climb(rows, "city", city, "state_id")
    rows = climb(rows, "state", state, "country_id")
    rows = climb(rows, "country", country)
    return rows.select("venue_id", "venue_name", *[f"{n}_{c}" for n in ("city", "state", "country") for c in ("id", "name")])


def with_parent(artist: DataFrame) -> DataFrame:
    """Artists with the name of the artist that ``parent_id`` points to (null: none or unknown)."""
    parent = artist.groupBy(F.col("id").alias("parent_id")).agg(F.min("name").alias("parent_name"))
    return artist.join(parent, "parent_id", "left").select("id", "name", "parent_id", "parent_name")


def hierarchy(nodes: DataFrame) -> DataFrame:
    """(id, parent_id) of any depth -> (id, root_id, depth, reason).

    ``depth`` counts the steps up to the root.  A parent that does not exist
    makes the node a root with the reason ``no such parent``; nodes on or below
    a cycle have no root and the reason ``cycle``.  Pointers double each round:
    after k rounds all nodes up to depth 2^k know their root, and the round that
    settles no more node leaves the cycles.  Repeated ids count once (smallest parent).
    """
    from marquee.session import cut_lineage

    one = nodes.filter(F.col("id").isNotNull()).groupBy("id").agg(F.min("parent_id").alias("parent_id"))
    known = one.select(F.col("id").alias("parent_id"), F.lit(True).alias("_known"))
    d = one.join(known, "parent_id", "left")
    up = F.when(F.col("_known"), F.col("parent_id"))
    d = cut_lineage(d.select("id", F.coalesce(up, "id").alias("to"), up.isNotNull().cast("long").alias("depth"), up.isNull().alias("end"),
                             F.when(F.col("parent_id").isNotNull() & up.isNull(), F.lit("no such parent")).alias("reason")))
    left = d.filter("not end").count()
    while left:
        on = d.select(F.col("id").alias("to"), F.col("to").alias("_to"), F.col("depth").alias("_depth"), F.col("end").alias("_end"))
        d = cut_lineage(d.join(on, "to").select("id", F.col("_to").alias("to"), (F.col("depth") + F.when(F.col("end"), 0).otherwise(F.col("_depth"))).alias("depth"),
                                                (F.col("end") | F.col("_end")).alias("end"), "reason"))
        now = d.filter("not end").count()
        if now == left:
            break
        left = now
    return d.select("id", F.when(F.col("end"), F.col("to")).alias("root_id"), F.when(F.col("end"), F.col("depth")).alias("depth"),
                    F.when(F.col("end"), F.col("reason")).otherwise(F.lit("cycle")).alias("reason"))


def load_warehouse(curated: DataFrame, round_prices: bool = False, existing: DataFrame | None = None,
                   special_events: DataFrame | None = None, aliases: DataFrame | None = None) -> dict[str, DataFrame]:
    """Curated events -> event fact + bridge tables.

    Dedupe by signature (deterministic survivor: first file, then rank),
    surrogate event ids in signature order (range-partitioned dense ids),
    then the artist, promoter and ticket-price bridges (distinct pairs; empty
    lists vanish).  ``round_prices`` reproduces an integer cast of prices.
    With ``existing`` (an event table), events whose signature it holds are
    ignored and ids go on after its largest.  ``special_events`` (id, slug)
    gives ``special_event_id`` by the slug of the event name, after
    ``aliases`` (alias_slug, slug) have been applied; null otherwise.
    """
    from marquee.functions.text import slugify
    from marquee.operators.conform import dense_ids

    ev = dedupe_by_key(curated, "signature", ["file", "weekly_rank"])
    if existing is None:
        ev = dense_ids(ev, "signature", 0)
    else:
        top = existing.agg(F.coalesce(F.max("id"), F.lit(0)).alias("_max"))   # one row
        fresh = ev.join(existing.select("signature"), "signature", "left_anti")
        ev = dense_ids(fresh.crossJoin(F.broadcast(top)), "signature", F.col("_max")).drop("_max")
    slug = slugify("event_name")
    if special_events is None:
        ev = ev.withColumn("special_event_id", F.lit(None).cast("bigint"))
    else:
        ev = ev.withColumn("_slug", slug)
        if aliases is not None:
            named = aliases.select(F.col("alias_slug").alias("_slug"), F.col("slug").alias("_true")).dropDuplicates(["_slug"])
            ev = ev.join(named, "_slug", "left").withColumn("_slug", F.coalesce("_true", "_slug")).drop("_true")
        member = special_events.groupBy(F.col("slug").alias("_slug")).agg(F.min("id").cast("bigint").alias("special_event_id"))
        ev = ev.join(member, "_slug", "left").drop("_slug")
    event = ev.select("id", "signature", "weekly_rank", "venue_id", "event_name", "special_event_id", "start_date", "end_date",
                      "dates", "gross_receipts_us", "gross_receipts_canadian", "attendance", "capacity",
                      "num_shows", "num_sellouts", "schema_id", "source_id", "s3_uri")
    prices = ev.select("id", F.transform("ticket_prices",
                                         (lambda p: F.round(p).cast("decimal(8,2)")) if round_prices
                                         else (lambda p: p.cast("decimal(8,2)"))).alias("tp"))
    return {
        "event": event,
        "event_to_artist": bridge(ev, "id", "artist_ids", "artist_id").withColumnRenamed("id", "event_id"),
        "event_to_promoter": bridge(ev, "id", "promoters", "promoter_id").withColumnRenamed("id", "event_id"),
        "event_ticket_price": bridge(prices, "id", "tp", "ticket_price").withColumnRenamed("id", "event_id"),
    }


def grown(dims, members: dict[str, DataFrame]):
    """The dimensions with the new members of a curation run, as it returned them (``artists``, ``cities`` ...)."""
    from dataclasses import replace
    return replace(dims, **{name: getattr(dims, name).unionByName(new.select(*[c for c in getattr(dims, name).columns if c in new.columns]),
                                                                  allowMissingColumns=True) for name, new in members.items()})


def write_warehouse(tables: dict[str, DataFrame], dims, root: str) -> None:
    """Full refresh in order: dimensions, then events, then bridges, each a Parquet table below ``root``
    (``commit_warehouse`` makes the tables visible together)."""
    from dataclasses import fields
    for f in fields(dims):
        getattr(dims, f.name).write.mode("overwrite").parquet(f"{root}/{f.name}")
    for name in sorted(tables, key=lambda n: (n != "event", n)):
        tables[name].write.mode("overwrite").parquet(f"{root}/{name}")


def commit_warehouse(tables: dict[str, DataFrame], dims, root: str) -> int:
    """The warehouse as the next version of ``root``: all tables of a load are seen together, or none (``sources.versions``)."""
    from dataclasses import fields

    from marquee.sources import versions
    return versions.commit({**{f.name: getattr(dims, f.name) for f in fields(dims)}, **tables}, root)
