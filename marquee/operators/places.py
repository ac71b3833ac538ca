"""Location resolution against the city dimension, as joins over token windows.

``windows`` explodes each row's tokens into 1..3-token windows (bounded
fan-out: at most 3 rows per token); every lookup is then an equi-join
(exact composite key, unique slug) or a blocked fuzzy join (same state)
followed by a priority pick.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions import places, text
from marquee.operators import conform
from marquee.session import cut_lineage


def windows(df: DataFrame, key: str, tokens: str, max_n: int = 3) -> DataFrame:
    """(key, start, len, slug, text) for every window of up to ``max_n`` tokens."""
    g = df.select(key, F.explode(places.ngrams(tokens, max_n)).alias("_g"))
    return g.select(key, F.col("_g.start").alias("start"), F.col("_g.len").alias("len"),
                    F.col("_g.text").alias("text"), text.slugify(F.col("_g.text")).alias("slug"))


def city_in_venue(df: DataFrame, key: str, tokens: str, state: str, cities: DataFrame) -> DataFrame:
    """City named inside the venue tokens -> (key, city_id, city_hint).

    ``cities``: (id, slug, state_id).  Rules, in the original's order:
    exact (slug, state) over windows -- the *last* window start wins, the
    shortest window within it; if none, fuzzy on the slug (> 7 chars, <= 2
    edits) among the cities of that state -- the first city by id; then a
    slug naming exactly one city anywhere (last start, shortest) overrides
    an exact hit and fills a miss.  ``city_hint`` is the text of the last
    window whose slug names any city (advisory, no state needed).
    """
    g = df.select(key, F.col(state).alias("_state"), F.explode(places.ngrams(tokens, 3)).alias("_g"))
    g = g.select(key, "_state", F.col("_g.start").alias("start"), F.col("_g.len").alias("len"), F.col("_g.text").alias("text"),
                 text.slugify(F.col("_g.text")).alias("slug"))
    named = cities.groupBy("slug").agg(F.count("*").alias("_n"), F.min("id").alias("_id")) \
        .select("slug", F.lit(True).alias("_named"), F.when(F.col("_n") == 1, F.col("_id")).alias("unique_id"))
    exact = cities.groupBy("slug", F.col("state_id").alias("_state")).agg(F.min("id").alias("exact_id"))
    spelt = g.filter((F.length("slug") > 7) & F.col("_state").isNotNull()).select("slug", "_state").distinct()
    fuzzy = conform.fuzzy_candidates(spelt, "slug", ["_state"], cities.select("id", F.col("slug").alias("_cslug"), "state_id"),
                                     "_cslug", ["state_id"], max_dist=2, keep=["id"]) \
        .groupBy("slug", "_state").agg(F.min("id").alias("fuzzy_id"))
    w = g.join(named, "slug", "left").join(exact, ["slug", "_state"], "left").join(fuzzy, ["slug", "_state"], "left")
    late = F.struct(-F.col("start"), F.col("len"))

    def last(value: str, found: str | None = None):
        return F.min_by(value, F.when(F.col(found or value).isNotNull(), late))

    best = w.groupBy(key).agg(last("exact_id").alias("exact_id"), last("unique_id").alias("unique_id"),
                              F.min("fuzzy_id").alias("fuzzy_id"), last("text", "_named").alias("city_hint"))
    out = df.select(key, state).join(best, key, "left")
    has_state = F.col(state).isNotNull()
    city = (F.when(has_state & F.col("exact_id").isNotNull(), F.coalesce("unique_id", "exact_id"))
            .when(has_state & F.col("fuzzy_id").isNotNull(), F.col("fuzzy_id"))
            .otherwise(F.col("unique_id")))
    return out.select(key, city.alias("city_id"), "city_hint")


def city_after_venue(df: DataFrame, key: str, tokens: str, state: str, cities: DataFrame) -> DataFrame:
    """City in the tokens after the first venue-type word -> (key, city_id,
    city_index): with a state, exact (slug, state) then fuzzy on the *name*
    (>= 5 chars, <= 2 edits) in that state; without a state, a slug that
    names one city only.  Earliest window start first, longest first."""
    v = places.first_venue_type_pos(tokens)
    post = df.select(key, F.col(state).alias("_state"), v.alias("_v"),
                     F.slice(tokens, v + 1, F.greatest(F.size(tokens) - v, F.lit(0))).alias("_post")
                     ).filter(F.col("_v") > 0)
    # no window longer than the longest city name, and two words for two edits
    longest = cities.agg(F.max(F.size(F.split("name", r"\s+")))).first()[0] or 1
    w = windows(post, key, "_post", max_n=longest + 2).join(post.select(key, "_state", "_v"), key)
    early = ["start", ("len", "desc")]
    exact = w.filter(F.col("_state").isNotNull()).join(
        cities.select(F.col("id").alias("cid"), "slug", F.col("state_id").alias("_state")), ["slug", "_state"])
    exact = exact.select(key, "cid", "start", "len", "_v", F.lit(0).alias("rule"))
    fz = conform.fuzzy_candidates(w.filter(F.col("_state").isNotNull()).withColumn("_low", F.lower("text")),
                                  "_low", ["_state"],
                                  cities.select("id", F.lower("name").alias("lname"), "state_id"), "lname",
                                  ["state_id"], max_dist=2, min_len=5, keep=["id"])
    fz = fz.select(key, F.col("id").alias("cid"), "start", "len", "_v", F.lit(1).alias("rule"))
    uniq = conform.unique_members(cities, "slug", "id").withColumnRenamed("id", "cid")
    un = w.filter(F.col("_state").isNull()).join(uniq, "slug").select(key, "cid", "start", "len", "_v",
                                                                       F.lit(2).alias("rule"))
    best = conform.pick_first(exact.unionByName(fz).unionByName(un), [key], ["rule"] + early + ["cid"])
    return best.select(key, F.col("cid").alias("city_id"), (F.col("start") - 1 + F.col("_v")).cast("int")
                       .alias("city_index"))


def _new_ids(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """New members (one row per ``keys``, none of them known) -> ids after ``max(id)`` in key order."""
    c = new.withColumn("_order", F.concat_ws("|", *[F.col(k).cast("string") for k in keys]))
    base = existing.agg(F.coalesce(F.max("id"), F.lit(0)).alias("_max"))
    return conform.dense_ids(c.crossJoin(F.broadcast(base)), "_order", F.col("_max")).drop("_max", "_order")   # one row


def new_places(proposed: DataFrame, existing: DataFrame, block: str, min_len: int, len_on: str, free=None) -> tuple[DataFrame, DataFrame]:
    """Names proposed as new members of a block (a city of a state, a venue of a city) -> (spellings, members).

    ``proposed``: (name, block, _seen); ``existing``: (id, slug, block).  Names
    within two edits of one another are one member, named as it was seen first
    (``conform.collapse_near``); names for which ``free`` holds are not compared.
    ``spellings``: (block, name, slug of its member), ``members``: (id, name,
    slug, block) of those that do not exist yet.
    """
    free = F.lit(False) if free is None else free
    near = conform.collapse_near(proposed.filter(~free), "name", [block], ["_seen"], 2, min_len, len_on)
    alone = proposed.filter(free).select(block, "name").distinct().withColumn("kept", F.col("name"))
    spellings = near.unionByName(alone).withColumn("slug", text.slugify("kept")).filter("slug <> ''")
    first = spellings.join(proposed, [block, "name"]).groupBy("slug", block).agg(F.min_by("kept", F.struct("_seen", "name")).alias("name"))
    known = existing.select("slug", block).distinct()
    members = _new_ids(existing, first.join(known, ["slug", block], "left_anti"), ["slug", block])
    return spellings.select(block, "name", "slug"), members.select("id", "name", "slug", block)


def match_venues(d: DataFrame, key: str, venues: DataFrame, cities: DataFrame) -> DataFrame:
    """(key, venue_name, city_id, city_cand) -> (key, venue_id, matched_name).

    Exact slug first; otherwise, with a known city, a venue of that city
    whose name is within 2 edits (names > 7 chars; the highest id wins, as
    the last match of a scan in id order).  Among venues sharing the slug the
    first (by id) that is educational, in the same city, or in a city of the
    same name is taken."""
    rows = d.select(key, "venue_name", "city_id", "_cand").withColumn("_vslug", text.slugify("venue_name"))
    vs = venues.select(F.col("id").alias("vid"), F.col("name").alias("vname"), F.col("slug").alias("vslug"),
                       F.col("city_id").alias("vcity"))
    exact = rows.join(vs.select("vslug").distinct(), rows["_vslug"] == F.col("vslug"), "left_semi") \
        .select(key, F.col("_vslug").alias("kslug"))
    fz_src = rows.join(exact, key, "left_anti").filter(F.col("city_id").isNotNull() & (F.col("city_id") != -1)
                                                       & (F.length("venue_name") > 7))
    # a name stands for all its rows, and the highest id for all venues of its name in the city
    spelt = fz_src.select("venue_name", "city_id").distinct()
    called = vs.groupBy("vname", "vcity").agg(F.max_by("vslug", "vid").alias("kslug"), F.max("vid").alias("vid"))
    near = conform.fuzzy_candidates(spelt, "venue_name", ["city_id"], called, "vname", ["vcity"], max_dist=2, keep=["vid", "kslug"]) \
        .groupBy("venue_name", "city_id").agg(F.max_by("kslug", "vid").alias("kslug"), F.max("vid").alias("vid"))
    fz = fz_src.select(key, "venue_name", "city_id").join(near, ["venue_name", "city_id"]).groupBy(key).agg(F.max_by("kslug", "vid").alias("kslug"))
    keyed = rows.join(exact.unionByName(fz), key)
    # of the venues that share a slug each rule needs only the first: anywhere, in a city, in cities of a name
    first = F.min_by(F.struct("vid", "vname"), "vid")
    cn = cities.select(F.col("id").alias("vcity"), F.col("name").alias("_cand"))
    anywhere = vs.groupBy(F.col("vslug").alias("kslug")).agg(first.alias("_m0"), F.lit(True).alias("_ok0"))
    same_city = vs.groupBy(F.col("vslug").alias("kslug"), F.col("vcity").alias("city_id")).agg(first.alias("_m1"), F.lit(True).alias("_ok1"))
    same_name = vs.join(cn, "vcity").groupBy(F.col("vslug").alias("kslug"), "_cand").agg(first.alias("_m2"), F.lit(True).alias("_ok2"))
    edu = F.lit(False)
    for t in places.EDUCATIONAL_TOKENS:
        edu = edu | F.col("kslug").contains(t)
    cands = keyed.join(anywhere, "kslug").join(same_city, ["kslug", "city_id"], "left").join(same_name, ["kslug", "_cand"], "left")
    found = F.array_min(F.array_compact(F.array(F.when(edu, F.col("_m0")), "_m1", "_m2")))
    return (cands.filter(edu | F.col("_ok1") | F.col("_ok2")).select(key, found.alias("_f"))
            .groupBy(key).agg(F.min_by("_f", "_f.vid").alias("_m"))
            .select(key, F.col("_m.vid").alias("venue_id"), F.col("_m.vname").alias("matched_name")))


def curate_locations(events: DataFrame, key: str, location_col: str, cities: DataFrame, venues: DataFrame,
                     order: list[str] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Location cells -> (events + venue_id/venue_name/city_id/state_id,
    new cities, new venues).

    Order of the rules: tokens (hyphens split, noise dropped, venue-type
    spellings fixed) -> state after the venue -> city after the venue (a
    miss with a known state proposes a new city from the tail) -> state
    inside the venue -> city inside the venue -> venue isolation and typo
    repair -> city inside the venue again -> venue match -> new venue.
    Set-based and deterministic: each distinct cell is resolved once against the
    existing dimensions, new members are collected, spellings of one member
    brought together (in the order ``order`` of the events that hold them;
    default: by key), given ids once and joined back.
    """
    order = order or [key]
    cells = events.groupBy(F.col(location_col).alias("_loc")).agg(F.min(F.struct(*order)).alias("_seen"))
    d = cells.withColumn("_t", places.clean_location(places.split_hyphen_tokens(places.location_tokens("_loc"))))
    d = d.withColumn("_sa", places.state_after_venue("_t")).select(
        "_loc", "_seen", F.monotonically_increasing_id().alias("_row"), F.col("_sa.state_id").alias("state_id"), F.col("_sa.tokens").alias("_t"))
    # stages join the rows with something derived from them: lineage is cut where a stage is read more than once
    d = cut_lineage(d)
    d = d.join(city_after_venue(d, "_row", "_t", "state_id", cities), "_row", "left")
    v = places.last_venue_type_pos("_t")
    d = (d.withColumn("_cand", F.when(F.col("city_id").isNull(), places.city_candidate("_t")))
         .withColumn("_t", F.when(F.col("city_id").isNotNull(), F.slice("_t", 1, F.col("city_index")))
                     .when(v > 0, F.slice("_t", 1, v)).otherwise(F.col("_t"))))
    # state written inside the venue name (it proposes no city: the tail had none with a known state)
    d = d.withColumn("_proposes", F.col("city_id").isNull() & F.col("state_id").isNotNull() & (F.col("_cand") != ""))
    d = d.withColumn("_siv", F.when(F.col("state_id").isNull(), places.state_in_venue("_t")))
    d = (d.withColumn("_t", F.coalesce(F.col("_siv.tokens"), F.col("_t")))
         .withColumn("state_id", F.coalesce(F.col("state_id"), F.col("_siv.state_id"))).drop("_siv"))
    d = cut_lineage(d)
    # new cities: a tail after the venue word, with a known state
    low = F.lower("_cand")
    proposed = d.filter("_proposes").select(low.alias("name"), "state_id", "_seen")
    spelt, new_cities = new_places(proposed, cities, "state_id", 5, "kept")
    all_cities = cities.select("id", "name", "slug", "state_id").unionByName(
        new_cities.select("id", text.title_case("name").alias("name"), "slug", "state_id"))
    ids = all_cities.groupBy("slug", "state_id").agg(F.min("id").alias("_ncid"))
    named = spelt.join(ids, ["slug", "state_id"]).select(F.col("name").alias("_cname"), F.col("state_id").alias("_cstate"), "_ncid")
    d = d.join(named, F.col("_proposes") & (low == F.col("_cname")) & (F.col("state_id") == F.col("_cstate")), "left") \
        .withColumn("city_id", F.coalesce("city_id", "_ncid")).drop("_cname", "_cstate", "_ncid", "_proposes")

    def city_inside(df):
        civ = city_in_venue(df.filter(F.col("city_id").isNull()), "_row", "_t", "state_id", all_cities)
        return cut_lineage(df.join(civ.select("_row", F.col("city_id").alias("_civ")), "_row", "left")
                           .withColumn("city_id", F.coalesce("city_id", "_civ")).drop("_civ"))

    d = city_inside(d)
    d = d.withColumn("_t", places.correct_typos(places.isolate_venue("_t")))
    d = city_inside(d)
    d = d.withColumn("venue_name", F.array_join("_t", " "))
    d = cut_lineage(d.join(match_venues(d, "_row", venues, all_cities), "_row", "left"))
    # a venue is its slug in its city; -1 stands for an unknown city, whose venues are told apart by slug alone
    city = F.coalesce("city_id", F.lit(-1))
    missing = d.filter(F.col("venue_id").isNull() & (F.col("venue_name") != ""))
    spelt, new_venues = new_places(
        missing.select(F.col("venue_name").alias("name"), city.alias("city_id"), "_seen"),
        venues.withColumn("city_id", city), "city_id", 8, "folded", F.col("city_id") == -1)
    every = venues.select("slug", city.alias("city_id"), "id").unionByName(new_venues.select("slug", "city_id", "id")) \
        .groupBy("slug", "city_id").agg(F.min("id").alias("_nvid"))
    # spellings that came together go by the name of their member
    new_names = new_venues.select("slug", "city_id", F.col("name").alias("_nvname"))
    named = spelt.join(every, ["slug", "city_id"]).join(new_names, ["slug", "city_id"], "left") \
        .select(F.col("name").alias("_vname"), F.col("city_id").alias("_vcity"), "_nvid", "_nvname")
    d = (d.join(named, F.col("venue_id").isNull() & (F.col("venue_name") == F.col("_vname")) & (city == F.col("_vcity")), "left")
         .withColumn("venue_id", F.coalesce("venue_id", "_nvid"))
         .withColumn("venue_name", F.coalesce("matched_name", "_nvname", "venue_name")))
    d = d.select("_loc", "venue_id", "venue_name", "city_id", "state_id")
    state = d.groupBy("venue_id").agg(F.min("state_id").alias("state_id"))
    out = events.join(d, F.col(location_col).eqNullSafe(F.col("_loc")), "left").drop("_loc")
    return out, all_cities.join(new_cities.select("id"), "id", "left_semi"), new_venues.join(state, F.col("id") == F.col("venue_id"), "left") \
        .select("id", "name", "slug", "city_id", "state_id")
