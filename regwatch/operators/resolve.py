"""Matching of events to companies by name, blocked and weighed by rarity.

Names are sets of words; a word weighs ln(N / (1 + df)), at least 0. Scores are computed on word arrays inside the
join's projection, so a candidate pair costs no further shuffle. Every rank ends in company_number, so ties are settled.
events: entity_id, publisher, insert_date, business_name, address_line_1, postcode; companies: company_number,
company_name, address_line_1, postcode, date_of_creation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import address_density_key, company_name_norm, is_multi_word, operator_prefix, postcode_district, text
from ..params import DEFAULT, Params
from ..sources.scratch import settled

EVENT = ("entity_id", "insert_date")
#: The density key of a blank line and postcode.
NO_ADDRESS = "|"


def words_of(norm: Column) -> Column:
    """Distinct words of a normalised name, in order."""
    return F.array_sort(F.array_distinct(F.filter(F.split(norm, " "), lambda w: w != "")))


def word_idf(companies: DataFrame, name: str = "company_name") -> DataFrame:
    """word and weight, over the companies whose normalised name is not empty. A name is normalised once for all its companies."""
    names = companies.groupBy(F.col(name).alias("name")).agg(F.count("*").alias("bearers"))
    names = names.select(company_name_norm(F.col("name")).alias("norm"), "bearers").where("norm <> ''")
    total = names.agg(F.coalesce(F.sum("bearers"), F.lit(0)).alias("n"))
    df = names.select(F.explode(words_of(F.col("norm"))).alias("word"), "bearers").groupBy("word").agg(F.sum("bearers").alias("df"))
    return df.join(F.broadcast(total)).select("word", F.greatest(F.lit(0.0), F.log(F.col("n") / (1 + F.col("df")))).alias("weight"))


def bagged(df: DataFrame, norm: str, bag: str, idf: DataFrame) -> DataFrame:
    """df with ``bag``: the words of a normalised name with their weights, as sorted structs. Unseen words get the largest
    weight. The words are joined to the weights once for each distinct name."""
    return df.join(name_bags(df.select(F.col(norm).alias("norm")), idf).withColumnsRenamed({"norm": norm, "bag": bag}), norm, "left")


def name_bags(names: DataFrame, idf: DataFrame) -> DataFrame:
    """norm and bag of each distinct name of a table of norms."""
    top = idf.agg(F.coalesce(F.max("weight"), F.lit(0.0)).alias("top"))
    words = names.distinct().select("norm", F.explode(words_of(F.col("norm"))).alias("word"))
    return words.join(idf, "word", "left").join(F.broadcast(top)).groupBy("norm").agg(F.array_sort(F.collect_list(F.struct("word", F.coalesce("weight", "top").alias("weight")))).alias("bag"))


def weighted_names(df: DataFrame, name: Column, idf: DataFrame) -> DataFrame:
    """df with norm and bag of a name."""
    return bagged(df.withColumn("norm", company_name_norm(name)), "norm", "bag", idf)


def bag_weight(bag: Column) -> Column:
    return F.aggregate(F.coalesce(bag, F.array().cast("array<struct<word:string,weight:double>>")), F.lit(0.0), lambda a, x: a + x["weight"])


def name_similarity(norm_a: Column, bag_a: Column, norm_b: Column, bag_b: Column) -> Column:
    """Weight of the shared words over that of all words; 1 for equal names, 0 if either is empty."""
    sums = F.array(F.struct(bag_weight(F.array_intersect(bag_a, bag_b)).alias("shared"), (bag_weight(bag_a) + bag_weight(bag_b)).alias("both")))
    united = lambda x: x["both"] - x["shared"]
    ratio = F.transform(sums, lambda x: F.when((x["shared"] > 0) & (united(x) > 0), F.round(x["shared"] / united(x), 12)).otherwise(0.0))[0]
    return F.when((text(norm_a) == "") | (text(norm_b) == ""), 0.0).when(norm_a == norm_b, 1.0).otherwise(ratio)


def leading_words(bag: Column, total: Column, least: float) -> Column:
    """The heaviest words of a bag: those before which words of at most a (1 - least) part of its weight stand. Two bags
    whose score is ``least`` or more share one of these words of either."""
    ahead = lambda x, y: (y["weight"] > x["weight"]) | ((y["weight"] == x["weight"]) & (y["word"] < x["word"]))
    before = lambda x: F.aggregate(bag, F.lit(0.0), lambda a, y: a + F.when(ahead(x, y), y["weight"]).otherwise(0.0))
    return F.transform(F.filter(bag, lambda x: before(x) <= (1 - least) * total + 1e-9), lambda x: x["word"])


def name_keys(df: DataFrame, norm: str, bag: str, weight: str, least: float) -> DataFrame:
    """A row for each key of a name that is not empty: one of its leading words, or the whole name. Names whose score is
    ``least`` or more have a key in common. ``weight`` is added, the weight of the bag."""
    rows = df.where(f"{norm} <> ''").withColumn(weight, bag_weight(F.col(bag)))
    whole = F.array(F.concat(F.lit("="), F.col(norm)))
    return rows.withColumn("key", F.explode(F.concat(whole, leading_words(F.col(bag), F.col(weight), least))))


def address_density(companies: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """companies with the number of companies at their address, and whether that is high. Companies without any address
    share one key, so they get their one number apart from the join, which sorts: neither side goes through the driver."""
    keyed = companies.withColumn("density_key", address_density_key(F.col("address_line_1"), F.col("postcode")))
    some, none = keyed.where(F.col("density_key") != NO_ADDRESS), keyed.where(F.col("density_key") == NO_ADDRESS)
    n = F.count("*").alias("address_company_count")
    counted = some.join(some.groupBy("density_key").agg(n).hint("merge"), "density_key").unionByName(none.join(F.broadcast(none.agg(n))))
    return counted.withColumn("is_high_density_address", F.col("address_company_count") >= p.dense_address)


#: What a candidate tells of its company.
COMPANY = ("company_number", "company_name", "district", "density_key", "address_company_count", "is_high_density_address", "date_of_creation")


def named_companies(companies: DataFrame, p: Params = DEFAULT) -> DataFrame:
    rows = address_density(companies, p).withColumn("district", postcode_district(F.col("postcode")))
    return rows.select(*COMPANY, F.coalesce(company_name_norm(F.col("company_name")), F.lit("")).alias("company_norm"))


def prepared_companies(companies: DataFrame, idf: DataFrame, p: Params = DEFAULT) -> DataFrame:
    return bagged(named_companies(companies, p), "company_norm", "company_bag", idf)


def named_events(events: DataFrame, name: Column) -> DataFrame:
    key = F.when((text(F.col("address_line_1")) != "") & (text(F.col("postcode")) != ""), address_density_key(F.col("address_line_1"), F.col("postcode")))
    return events.select(*EVENT, postcode_district(F.col("postcode")).alias("event_district"), key.alias("event_key"), F.coalesce(company_name_norm(name), F.lit("")).alias("event_norm"))


def _prepared_events(events: DataFrame, name: Column, idf: DataFrame) -> DataFrame:
    return bagged(named_events(events, name), "event_norm", "event_bag", idf)


def spread(df: DataFrame, *by: str) -> DataFrame:
    """df over as many partitions as a shuffle has, however few bytes it is: its rows are few, but each meets many."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


def name_classes(companies: DataFrame, by: tuple, most: int, idf: DataFrame) -> DataFrame:
    """Each name of companies once (within ``by``, whose last is the norm), with its bag: ``members`` are its first companies
    by number, ``most`` of them, and ``first`` the least number."""
    nth = F.dense_rank().over(Window.partitionBy(*by).orderBy("company_number"))
    heads = companies.withColumn("__nth", nth).where(F.col("__nth") <= most)
    classes = heads.groupBy(*by).agg(F.array_sort(F.collect_set(F.struct(*(c for c in COMPANY if c not in by)))).alias("members"))
    return bagged(classes, by[-1], "company_bag", idf).withColumn("first", F.col("members")[0]["company_number"])


def _best(scored: DataFrame, of: tuple, number: str, most: int) -> DataFrame:
    """The first ``most`` of each by score and number, with that place."""
    w = Window.partitionBy(*of).orderBy(F.desc("score"), number)
    return scored.withColumn("place", F.dense_rank().over(w)).where(F.col("place") <= most)


def best_members(scored: DataFrame, classes: DataFrame, of: tuple, by: dict, most: int) -> DataFrame:
    """The best ``most`` companies of each event name, from scored classes (of, company_norm, first, score): every class has
    its first number in the order, so none behind the first ``most`` classes can give one. ``by`` renames the key of classes."""
    heads = _best(scored, of, "first", most).drop("place")
    members = classes.select(*by, "members").withColumnsRenamed(by)
    rows = heads.join(members, list(by.values())).select(*of, *(c for c in heads.columns if c not in (*of, "score", "first")), "score", F.explode("members").alias("m"))
    return _best(rows.select("*", "m.*").drop("m"), of, "company_number", most)


def priority() -> list[Column]:
    """Order of candidates: trusted address match, then closeness of creation to the event among those, then score."""
    trusted = F.col("address_matches_establishment") & ~F.col("is_high_density_address")
    close = F.when(trusted, -F.abs(F.datediff("date_of_creation", "insert_date"))).otherwise(0)
    return [trusted.desc(), F.coalesce(close.cast("double"), F.lit(float("-inf"))).desc(), F.col("name_similarity_score").desc(), F.col("company_number")]


CANDIDATE = [*EVENT, "company_number", "company_name", "name_similarity_score", "postcode_district", "address_company_count", "is_high_density_address", "match_strategy", "date_of_creation", "address_matches_establishment"]


def _ranked(rows: DataFrame, top: int) -> DataFrame:
    w = Window.partitionBy(*EVENT).orderBy(*priority())
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)


def _scored(pairs: DataFrame) -> DataFrame:
    """Pairs of an event and a company of its district as candidates."""
    return _candidates(pairs.withColumn("score", name_similarity(F.col("event_norm"), F.col("event_bag"), F.col("company_norm"), F.col("company_bag"))))


def _candidates(pairs: DataFrame, strategy: str = "district") -> DataFrame:
    rows = pairs.withColumn("name_similarity_score", F.round("score", 4)).withColumn("match_strategy", F.lit(strategy)).withColumn("postcode_district", F.col("district"))
    return rows.withColumn("address_matches_establishment", F.coalesce(F.col("event_key") == F.col("density_key"), F.lit(False))).select(*CANDIDATE)


def _once(rows: DataFrame, top: int) -> DataFrame:
    """The best of each event. A company that was found more than once stands side by side with itself, and counts once."""
    w = Window.partitionBy(*EVENT).orderBy(*priority())
    ranked = rows.withColumn("rank", F.dense_rank().over(w)).withColumn("__again", F.lag("company_number").over(w).eqNullSafe(F.col("company_number")))
    return ranked.where((F.col("rank") <= top) & ~F.col("__again")).drop("__again")


def heaviest_first(bag: Column) -> Column:
    """Words of a bag that weigh anything, with the weight of each and of all from it on (``rest``), the heaviest first."""
    words = F.reverse(F.array_sort(F.transform(F.filter(bag, lambda x: x["weight"] > 0), lambda x: F.struct(x["weight"].alias("weight"), x["word"].alias("word")))))
    empty = F.array().cast("array<struct<weight:double,word:string,rest:double>>")
    step = lambda s, x: F.struct((s["sum"] + x["weight"]).alias("sum"), F.concat(F.array(F.struct(x["weight"].alias("weight"), x["word"].alias("word"), (s["sum"] + x["weight"]).alias("rest"))), s["out"]).alias("out"))
    return F.aggregate(F.reverse(words), F.struct(F.lit(0.0).alias("sum"), empty.alias("out")), step, lambda s: s["out"])


WHOLE = "="
NAMED = ("event_district", "event_norm")


def _sharing(asked: DataFrame, keys: Column, classes: DataFrame, cell: tuple = ()) -> DataFrame:
    """Pairs of a name and a class of its district that have one of ``keys`` in common, each once: at the first of them.
    With ``cell``, columns of both, only what is equal in them is paired, and tasks get a like number of keys."""
    weighing = F.filter(F.coalesce("company_bag", F.array().cast("array<struct<word:string,weight:double>>")), lambda x: x["weight"] > 0)
    right = classes.where("company_norm <> ''").withColumn("theirs", F.concat(F.transform(weighing, lambda x: x["word"]), F.array(F.concat(F.lit(WHOLE), F.col("company_norm")))))
    right = right.drop("members").withColumn("key", F.explode("theirs")).withColumnRenamed("district", "event_district")
    left = asked.where("event_norm <> ''").withColumn("mine", keys).withColumn("key", F.explode("mine"))
    on = ["event_district", *cell, "key"]
    if cell:
        left, right = spread(left, *on), spread(right, *on).hint("merge")
    return left.join(right, on).where(F.get(F.array_intersect("mine", "theirs"), F.lit(0)) == F.col("key"))


def _pair_scores(pairs: DataFrame, digits: int) -> DataFrame:
    score = F.round(name_similarity(F.col("event_norm"), F.col("event_bag"), F.col("company_norm"), F.col("company_bag")), digits)
    return pairs.select(*NAMED, "company_norm", "first", score.alias("score"))


def district_candidates(events: DataFrame, companies: DataFrame, idf: DataFrame, p: Params = DEFAULT, first_words: int = 2, named: DataFrame | None = None) -> DataFrame:
    """The best companies of an event's district, whatever their score.

    A score depends on names alone, so names are compared, each once in a district, however many events and companies bear
    them. An event takes the best companies of its name by score and number, and those at its own address if they are few
    enough to be trusted. These come first and leave as many places fewer, so the former need no more than a full list.

    Not all pairs of names are scored. A company among the best has a word in common with the event (or its whole name), or
    scores 0 and is among the first numbers of its district. Words are taken heaviest first: companies that share none of an
    event's heaviest words score at most the weight of the words left over that of its name, so once the last of the best
    found so far scores more than that, the lighter words are not looked up. ``named``: ``named_companies``, if at hand.
    """
    most = p.top_candidates
    left = settled(named_events(events, F.col("business_name")).where("event_district is not null"))
    right = (settled(named_companies(companies, p)) if named is None else named).where("district is not null")
    names = spread(bagged(left.select(*NAMED).distinct(), "event_norm", "event_bag", idf), *NAMED)
    names = settled(names.withColumn("words", heaviest_first(F.col("event_bag"))).withColumn("weight", bag_weight(F.col("event_bag"))))
    classes = settled(name_classes(right, ("district", "company_norm"), most, idf))
    asked = spread(names, *NAMED)
    by_number = Window.partitionBy("district").orderBy("first")
    heads = classes.withColumn("__nth", F.dense_rank().over(by_number)).where(F.col("__nth") <= most).drop("members", "__nth")
    least = asked.join(heads, asked["event_district"] == heads["district"])
    spelt = F.coalesce("words", F.array().cast("array<struct<weight:double,word:string,rest:double>>"))
    leading = F.concat(F.transform(F.slice(spelt, 1, first_words), lambda x: x["word"]), F.array(F.concat(F.lit(WHOLE), F.col("event_norm"))))
    found = _pair_scores(least, 4).unionByName(_pair_scores(_sharing(asked, leading, classes), 4))
    early = settled(_best(found, NAMED, "first", most).drop("place"))
    by = {"district": "event_district", "company_norm": "company_norm"}
    # What a further company has to score: no less than the last of a full list.
    last = best_members(early, classes, NAMED, by, most).groupBy(*NAMED).agg(F.when(F.max("place") < most, 0.0).otherwise(F.min("score")).alias("floor"))
    open_ = asked.where(F.size("words") > first_words).join(last, list(NAMED), "left")
    lighter = F.filter(F.slice("words", first_words + 1, F.size("words")), lambda x: x["rest"] >= (F.coalesce("floor", F.lit(0.0)) - 1e-4) * F.col("weight"))
    late = _pair_scores(_sharing(open_, F.transform(lighter, lambda x: x["word"]), classes), 4)
    best = best_members(early.unionByName(late), classes, NAMED, by, most).drop("place", "company_norm")
    near = left.join(best.withColumn("district", F.col("event_district")), list(NAMED))
    there = left.join(right.where("not is_high_density_address"), (left["event_district"] == right["district"]) & (left["event_key"] == right["density_key"]))
    there = there.join(names.select(*NAMED, "event_bag"), list(NAMED)).join(classes.select("district", "company_norm", "company_bag"), ["district", "company_norm"])
    return _once(_candidates(near).unionByName(_scored(there)), p.top_candidates)


def blocks(rows: DataFrame, by: tuple, most: int = 256) -> DataFrame:
    """Rows of equal ``by`` put together, at most ``most`` of them in a ``block``: other columns become arrays. Rows are sorted
    over all tasks first, so those of one key need not meet in one task, however many they are."""
    rest = [c for c in rows.columns if c not in by]
    placed = rows.orderBy(*by, *rest).withColumn("block", F.expr(f"monotonically_increasing_id() div {most}"))
    held = placed.groupBy(*by, "block").agg(F.collect_list(F.struct(*rest)).alias("held"))
    return held.select(*by, "block", *(F.col(f"held.{c}").alias(c) for c in rest))


def _celled(held: DataFrame, cells: DataFrame, norm: str, own: str, other: str) -> DataFrame:
    """Each block in one of its own district's parts, and beside each part of the other side: a pair of blocks has one cell."""
    dealt = held.join(cells, "event_district").withColumn(own, F.pmod(F.xxhash64(norm, "block"), own))
    return dealt.withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1))).drop("block")


def _pair_rows(pairs: DataFrame, kept: tuple, digits: int) -> DataFrame:
    """``kept`` and score of the pairs of ``_sharing``: ``name_similarity``, from the weights of both bags and the keys in
    common. Most pairs have one key in common, whose weight is at hand; only for others the event's bag is gone through."""
    common = F.array_intersect("mine", "theirs")
    one = F.get("weights", F.array_position("mine", F.col("key")).cast("int") - 1)
    many = F.aggregate("event_bag", F.lit(0.0), lambda a, x: a + F.when(F.array_contains(common, x["word"]), x["weight"]).otherwise(0.0))
    # In a select of its own, so that it is computed once.
    both = pairs.select(*kept, "event_norm", "company_norm", "event_weight", "company_weight", F.when(F.size(common) == 1, one).otherwise(many).alias("shared"))
    united = F.col("event_weight") + F.col("company_weight") - F.col("shared")
    ratio = F.when((F.col("shared") > 0) & (united > 0), F.round(F.col("shared") / united, 12)).otherwise(0.0)
    return both.select(*kept, F.round(F.when(F.col("event_norm") == F.col("company_norm"), 1.0).otherwise(ratio), digits).alias("score"))


def district_similarity(events: DataFrame, companies: DataFrame, idf: DataFrame, p: Params = DEFAULT, digits: int = 9, cell: int = 50_000) -> DataFrame:
    """Every pair of an event and a company of its district whose names score more than 0.

    There are as many rows as such pairs, so what each costs is kept low: names are compared, in blocks of the events and of the
    companies that bear them, and the rows are written out of two blocks last, by the task that scored them. No pair is
    shuffled. A district is cut into cells of about ``cell`` events and as many companies, so that no key holds more than that.
    """
    left = settled(named_events(events, F.col("business_name")).where("event_district is not null and event_norm <> ''").select(*EVENT, *NAMED))
    norm = F.coalesce(company_name_norm(F.col("company_name")), F.lit("")).alias("company_norm")
    right = settled(companies.select("company_number", postcode_district(F.col("postcode")).alias("event_district"), norm).where("event_district is not null and company_norm <> ''"))
    parts = lambda rows, name: rows.groupBy("event_district").agg(F.ceil(F.count("*") / cell).alias(name))
    cells = settled(parts(left, "__row").join(parts(right, "__column"), "event_district"))
    names = bagged(settled(blocks(left, NAMED)), "event_norm", "event_bag", idf)
    classes = bagged(settled(blocks(right, ("event_district", "company_norm"))), "company_norm", "company_bag", idf)
    names = _celled(names, cells, "event_norm", "__row", "__column").withColumn("event_weight", bag_weight(F.col("event_bag")))
    classes = _celled(classes, cells, "company_norm", "__column", "__row").withColumn("company_weight", bag_weight(F.col("company_bag")))
    weighing = F.filter(F.coalesce("event_bag", F.array().cast("array<struct<word:string,weight:double>>")), lambda x: x["weight"] > 0)
    keys = F.concat(F.transform(weighing, lambda x: x["word"]), F.array(F.concat(F.lit(WHOLE), F.col("event_norm"))))
    pairs = _sharing(names.withColumn("weights", F.transform(weighing, lambda x: x["weight"])), keys, classes, ("__row", "__column"))
    # A filter on the score would have it computed twice. Events vary fastest, as numbers are cheaper to read than text.
    scored = _pair_rows(pairs, (*EVENT, "company_number"), digits).select(*EVENT, "company_number", F.explode(F.when(F.col("score") > 0, F.array("score"))).alias("score"))
    rows = scored.select(*EVENT, F.explode("company_number").alias("company_number"), "score")
    rows = rows.select("insert_date", "company_number", "score", F.posexplode("entity_id").alias("__at", "entity_id"))
    return rows.select("entity_id", F.get("insert_date", F.col("__at")).alias("insert_date"), "company_number", "score")


def national_classes(named: DataFrame, idf: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """The names of ``named_companies``, as both national channels read them."""
    return settled(name_classes(named.where("company_norm <> ''"), ("company_norm",), p.top_candidates, idf))


def national_candidates(events: DataFrame, companies: DataFrame, idf: DataFrame, p: Params = DEFAULT, name: Column | None = None, strategy: str = "national", classes: DataFrame | None = None) -> DataFrame:
    """Companies anywhere that share the first word and score enough.

    score = S / (A + B - S) and S <= min(A, B), so a score of t needs min(A, B) >= t max(A, B), and one of the heaviest
    words of either name in common. The join takes only pairs within both bounds, or of equal names. Names are compared,
    each once, however many events and companies bear them. ``classes``: ``national_classes``, if at hand.
    """
    first = lambda df, norm: df.withColumn("block", F.substring_index(norm, " ", 1))
    rows = settled(named_events(events, F.col("business_name") if name is None else name)).where("event_norm <> ''")
    classes = national_classes(named_companies(companies, p), idf, p) if classes is None else classes
    left = spread(bagged(rows.select("event_norm").distinct(), "event_norm", "event_bag", idf), "event_norm")
    left = name_keys(first(left, "event_norm"), "event_norm", "event_bag", "wa", p.national_score)
    right = name_keys(first(classes.drop("members"), "company_norm"), "company_norm", "company_bag", "wb", p.national_score)
    near = (F.least("wa", "wb") >= p.national_score * F.greatest("wa", "wb") - 1e-9) | (F.col("event_norm") == F.col("company_norm"))
    pairs = left.join(right, (left["block"] == right["block"]) & (left["key"] == right["key"]) & near)
    exact = name_similarity(F.col("event_norm"), F.col("event_bag"), F.col("company_norm"), F.col("company_bag"))
    scored = pairs.withColumn("score", exact).where(F.col("score") >= p.national_score).select("event_norm", "company_norm", "first", F.round("score", 4).alias("score")).distinct()
    best = best_members(scored, classes, ("event_norm",), {"company_norm": "company_norm"}, p.top_candidates).drop("place", "company_norm")
    # An address counts in the district alone.
    return _once(_candidates(rows.withColumn("event_key", F.lit(None).cast("string")).join(best, "event_norm"), strategy), p.top_candidates)


def operator_candidates(events: DataFrame, companies: DataFrame, idf: DataFrame, p: Params = DEFAULT, classes: DataFrame | None = None) -> DataFrame:
    """National candidates of the operator named before an '@'."""
    rows = events.withColumn("__prefix", operator_prefix(F.col("business_name"))).where("__prefix is not null")
    return national_candidates(rows, companies, idf, p, F.col("__prefix"), "operator-prefix", classes)


def all_candidates(events: DataFrame, companies: DataFrame, idf: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """The three channels, merged; companies are named once for all of them."""
    named = settled(named_companies(companies, p))
    classes = national_classes(named, idf, p)
    national, operator = (f(events, companies, idf, p, classes=classes) for f in (national_candidates, operator_candidates))
    return merge_candidates(district_candidates(events, companies, idf, p, named=named), national, operator, p)


def merge_candidates(district: DataFrame, national: DataFrame, operator: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """The three channels as one list for each event: a company once, at its best, ranks from 1."""
    rows = None
    for order, df in enumerate((district, national, operator)):
        part = df.drop("rank").withColumn("__order", F.lit(order))
        rows = part if rows is None else rows.unionByName(part)
    once = Window.partitionBy(*EVENT, "company_number").orderBy(*priority()[:3], "__order")
    rows = rows.withColumn("__rn", F.row_number().over(once)).where("__rn = 1").drop("__rn", "__order")
    return _ranked(rows, p.top_candidates)


def match_runs(candidates: DataFrame, events: DataFrame) -> DataFrame:
    """One row for each event: candidates found, best company and score; without any 0, null, null."""
    best = candidates.groupBy(*EVENT).agg(F.count("*").alias("candidates_found"), F.min_by("company_number", "rank").alias("best_company_number"), F.min_by("name_similarity_score", "rank").alias("best_score"))
    return events.select(*EVENT).distinct().join(best, list(EVENT), "left").na.fill(0, ["candidates_found"])


def distinct_prefixes(events: DataFrame) -> DataFrame:
    """Operator prefixes of the events' names, one for each normalised form: the spelling of the least entity_id."""
    rows = events.select("entity_id", operator_prefix(F.col("business_name")).alias("prefix")).where("prefix is not null")
    return rows.withColumn("prefix_norm", company_name_norm(F.col("prefix"))).groupBy("prefix_norm").agg(F.min_by("prefix", F.struct("entity_id", "prefix")).alias("prefix"))


def unsatisfied_prefixes(prefixes: DataFrame, hits: DataFrame, checks: DataFrame, as_of: Column, p: Params = DEFAULT) -> DataFrame:
    """Prefixes of several words without a national hit (hits: prefix_norm) and not checked lately."""
    lately = checks.where(F.datediff(as_of, "checked_date") < p.search_again_days)
    return prefixes.where(is_multi_word(F.col("prefix"))).join(hits, "prefix_norm", "left_anti").join(lately, "prefix_norm", "left_anti")


def accept_search_results(results: DataFrame, idf: DataFrame, p: Params = DEFAULT, dormant: str = "99999") -> DataFrame:
    """For each prefix the best active result (prefix, title, company_number, company_status, sic_codes) that scores
    enough and is not dormant."""
    live = results.where("company_status = 'active'").where(~F.coalesce(F.array_contains("sic_codes", dormant), F.lit(False)))
    # Titles of one spelling score alike: of these the least number is the best.
    rows = settled(live.groupBy("prefix", "title").agg(F.min("company_number").alias("company_number")))
    a = weighted_names(rows, F.col("prefix"), idf).withColumnsRenamed({"norm": "norm_a", "bag": "bag_a"})
    both = weighted_names(a, F.col("title"), idf)
    both = both.withColumn("score", name_similarity(F.col("norm_a"), F.col("bag_a"), F.col("norm"), F.col("bag"))).where(F.col("score") >= p.national_score)
    w = Window.partitionBy("prefix").orderBy(F.desc("score"), "company_number")
    return both.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").select("prefix", "company_number", "title", "score")


def events_to_match(inserts: DataFrame, matched: DataFrame, classifications: DataFrame, as_of: Column, force: bool = False, p: Params = DEFAULT) -> DataFrame:
    """INSERTs never matched, and UNKNOWN ones that are young enough to try again; all if forced."""
    if force:
        return inserts
    again = classifications.where((F.col("classification") == "UNKNOWN") & (F.datediff(as_of, "insert_date") <= p.recheck_days)).select(*EVENT)
    fresh = inserts.join(matched.select(*EVENT), list(EVENT), "left_anti")
    return fresh.unionByName(inserts.join(matched.select(*EVENT), list(EVENT), "left_semi").join(again, list(EVENT), "left_semi"))


