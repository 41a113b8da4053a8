"""Names to ids of reference tables: exact first, then by tiers, then fuzzy on what is left."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.functions import similarity as S
from quillspark.functions import text as T
from quillspark.sources.durable import kept


def two_way_semi(a: DataFrame, b: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Both sides without the keys that the other lacks."""
    return a.join(b, key, "left_semi"), b.join(a, key, "left_semi")


def map_lookup(df: DataFrame, column: str, mapping: DataFrame, source: str, target: str) -> DataFrame:
    """The column, mapped where the mapping knows it; a source that occurs twice counts once (smallest target)."""
    known = mapping.groupBy(F.col(source).alias(column)).agg(F.min(target).alias("mapped"))
    return df.join(known, column, "left").withColumn("resolved", F.coalesce("mapped", column)).drop("mapped")


def exact_union(left: DataFrame, name: str, right: DataFrame, names: list[str], id_: str) -> DataFrame:
    """(left, id) for names equal to any of the columns, without repeats: equi-joins instead of one with OR."""
    parts = [left.join(right.select(F.col(n).alias(name), id_), name) for n in names]
    return reduce(DataFrame.unionByName, parts).distinct()


def fuzzy_pairs(left: DataFrame, a: str, right: DataFrame, b: str, least: float, sort_tokens: bool = True) -> DataFrame:
    """Pairs of distinct texts with an indel similarity of `least` at least (0 to 100), with it as `sim`.

    The similarity bounds the ratio of the lengths, so texts meet only those of their own or a neighbouring length
    class: nothing is lost. Texts are deduplicated first; the rest of the bound is checked before the UDF runs.
    """
    form = (lambda c: S.sorted_tokens(F.col(c))) if sort_tokens else (lambda c: F.col(c))
    x = left.select(a).where(F.col(a).isNotNull()).distinct().withColumn("form_a", form(a))
    y = right.select(b).where(F.col(b).isNotNull()).distinct().withColumn("form_b", form(b))
    # 2 * min / (n + m) >= t bounds the longer length by min * (2 - t) / t: classes of that ratio, own and next ones
    ratio = (200.0 - least) / least
    at = lambda c: F.floor(F.log(F.greatest(F.length(c), F.lit(1)).cast("double")) / F.log(F.lit(max(ratio, 1.0001))) + 1e-9).cast("int")
    x = x.withColumn("size_class", F.explode(F.array(*[at("form_a") + d for d in (-1, 0, 1)])))
    y = y.withColumn("size_class", at("form_b"))
    met = x.join(y, "size_class").where(S.can_reach(F.col("form_a"), F.col("form_b"), least) | (F.col("form_a") == F.col("form_b")))
    return met.select(a, b, S.indel_ratio(F.col("form_a"), F.col("form_b")).alias("sim")).where(F.col("sim") >= least)


#: Texts asked for that meet one text at once.
ASKED = 256


def asked_pairs(asked: DataFrame, a: str, known: DataFrame, b: str) -> DataFrame:
    """(a, b): each text asked for with each known one; a set of questions against all rows, joined by the number of their block."""
    n = max(1, -(-asked.count() // ASKED))
    blocks = asked.select(F.col(a).alias("a"), F.pmod(F.xxhash64(a), F.lit(n)).alias("block")).groupBy("block").agg(F.collect_list("a").alias("of"))
    rows = known.select(F.col(b).alias("b"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))).alias("block"))
    return rows.join(blocks, "block").select(F.explode("of").alias("a"), "b")


def jaro_best_rows(asked: DataFrame, name: str, reference: DataFrame, column: str, scaling: float = 0.2) -> DataFrame:
    """Rows of the reference with the name that has the greatest Jaro-Winkler similarity with each name asked for, with asked and sim; of equal ones the name that sorts first. The name itself does not count."""
    pairs = asked_pairs(asked.select(name).distinct(), name, reference.select(column).where(F.col(column).isNotNull()).distinct(), column).where("a <> b")
    best = pairs.withColumn("sim", F.round(S.jaro_winkler_scaled(scaling)(F.col("a"), F.col("b")), 6))
    best = best.groupBy("a").agg(F.min_by("b", F.struct(-F.col("sim"), F.col("b"))).alias("b"), F.max("sim").alias("sim"))
    return reference.join(best.withColumnsRenamed({"a": "asked", "b": column}), column)


def canonical_sender(sender: Column, known: list[tuple[str, list[str]]]) -> Column:
    """The first of the known names of which it, or one of its other forms, has a Jaro-Winkler similarity of 0.9 at least; else the sender."""
    out = sender
    for name, forms in reversed(known):
        best = F.greatest(*[S.jaro_winkler_ratio(sender, F.lit(x)) for x in (name, *forms, name)])
        out = F.when(best >= 0.9, F.lit(name)).otherwise(out)
    return out


def _bare(name: Column) -> Column:
    return F.regexp_replace(name, "[#_\"']", "")


def sender_score(sender: Column, name: Column) -> Column:
    """Sorted-token similarity from 95, else partial similarity from 90, else 0; 0 if one is null. The partner's name counts in small letters, the sender as it is."""
    a, b = _bare(sender), _bare(F.lower(name))
    sorted_, part = S.token_sort_ratio(a, b), S.partial_ratio(a, b)
    return F.coalesce(F.when(sorted_ >= 95, sorted_).when(part >= 90, part), F.lit(0.0))


#: Characters of a gram of texts, and of texts with sorted tokens.
GRAM, SORTED_GRAM = 3, 5


def _pieces(text: Column, size: int) -> Column:
    """The distinct runs of `size` characters of a text; none of shorter texts."""
    places = F.when(F.length(text) >= size, F.sequence(F.lit(1), F.length(text) - size + 1)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(places, lambda i: F.substring(text, i, size)))


def _rarest(short: DataFrame, long: DataFrame, exact: bool) -> DataFrame:
    """(id, gram) of the rarest grams of each short text, one of which a long text has to have that contains it (exact) or is 90 % like it in part.

    90 % of a window leave at most a fifth of the m characters of the short text to edits, each of which costs three
    grams at most; as many grams as can be lost, and one more, are enough, and the rarest in the long texts meet fewest.
    """
    grams = short.select("id", F.explode(_pieces(F.col("form"), GRAM)).alias("gram"), F.length("form").alias("m"))
    seen = long.select(F.explode(_pieces(F.col("form"), GRAM)).alias("gram")).groupBy("gram").agg(F.count("*").alias("n"))
    ranked = grams.join(seen, "gram")  # grams that no long text has meet none
    lost = F.lit(1) if exact else F.least(3 * F.floor(F.col("m") / 5) + 1, F.col("m"))
    counted = ranked.groupBy("id", "m").agg(F.array_sort(F.collect_list(F.struct("n", "gram"))).alias("grams"), F.count("*").alias("known"))
    size = grams.groupBy("id").agg(F.count("*").alias("all"))
    # of the wanted rarest ones those that no long text has come first, and meet none
    wanted = counted.join(size, "id").withColumn("take", F.greatest(lost - (F.col("all") - F.col("known")), F.lit(0)).cast("int"))
    return wanted.select("id", F.explode(F.slice("grams", F.lit(1), F.col("take"))).alias("g")).select("id", "g.gram")


def _held(short: DataFrame, long: DataFrame, exact: bool) -> DataFrame:
    """(short, long) ids of forms that may have the partial similarity, the short one being no longer than the long one."""
    all_grams = long.select(F.col("id").alias("long"), F.explode(_pieces(F.col("form"), GRAM)).alias("gram"), F.length("form").alias("n"))
    met = _rarest(short, long, exact).join(short.select("id", F.length("form").alias("m")), "id").join(all_grams, "gram").where("m <= n").select(F.col("id").alias("short"), "long").distinct()
    tiny = short.where(F.length("form") < GRAM)  # are found whole, or not at all
    small = long.select(F.col("id").alias("long"), F.explode(F.concat(_pieces(F.col("form"), 1), _pieces(F.col("form"), 2))).alias("form"))
    return met.unionByName(tiny.join(small, "form").select(F.col("id").alias("short"), "long").distinct())


def _meeting(senders: DataFrame, names: DataFrame, exact: bool) -> DataFrame:
    """(sender, name) that may have a sender_score of 100 (exact), or any; both have id and form."""
    a, b = (_held(x, y, exact).select(F.col(x_is).alias("sender"), F.col(y_is).alias("name")) for x, y, x_is, y_is in ((senders, names, "short", "long"), (names, senders, "long", "short")))
    ordered = [d.select(F.col("id").alias(n), S.sorted_tokens(F.col("form")).alias("sorted")) for d, n in ((senders, "sender"), (names, "name"))]
    same = ordered[0].join(ordered[1], "sorted").select("sender", "name")
    parts = [a, b, same]
    if not exact:  # 95 % of sorted tokens that are not equal have five characters in a row in common
        x, y = (d.select(d.columns[0], F.explode(_pieces(F.col("sorted"), SORTED_GRAM)).alias("gram"), F.length("sorted").alias(f"n_{d.columns[0]}")) for d in ordered)
        near = x.join(y, "gram").where("200 * least(n_sender, n_name) >= 95 * (n_sender + n_name)")
        parts.append(near.select("sender", "name"))
    return reduce(DataFrame.unionByName, parts).distinct()


def resolve_sender(queries: DataFrame, partners: DataFrame, least: float = 90.0) -> DataFrame:
    """(sender, ids): partners whose name or full name equals the sender, else all with the greatest sender_score of both.

    queries has sender; partners has partner_id, partner_name, partner_full_name. Null senders are left out; the word
    for an unknown sender has no ids. No pair of a score of `least`, 90 at least, is lost: senders of score 100 are found
    first, by sorted tokens and by the rarest gram of the shorter text, and only the others meet more names.
    """
    wanted = queries.select("sender").where("sender is not null").distinct()
    known = wanted.where(F.col("sender") != T.UNKNOWN)
    exact = exact_union(known, "sender", partners, ["partner_name", "partner_full_name"], "partner_id")
    rest = known.join(exact, "sender", "left_anti").select(F.col("sender").alias("id"), _bare(F.col("sender")).alias("form"))
    of = partners.select("partner_id", F.explode(F.array("partner_name", "partner_full_name")).alias("name")).where("name is not null")
    names = kept(of.select("name").distinct().select(F.col("name").alias("id"), _bare(F.lower("name")).alias("form")))
    rest = kept(rest)

    def scored(senders: DataFrame, whole: bool) -> DataFrame:
        return _meeting(senders, names, whole).withColumn("sim", sender_score(F.col("sender"), F.col("name")))

    certain = kept(scored(rest, True).where("sim = 100").select("sender", "name"))
    met = scored(rest.join(certain.select(F.col("sender").alias("id")).distinct(), "id", "left_anti"), False).where(F.col("sim") >= least)
    best = met.withColumn("top", F.max("sim").over(Window.partitionBy("sender"))).where("sim = top").select("sender", "name")
    fuzzy = certain.unionByName(best).join(of, "name").select("sender", "partner_id").distinct()
    ids = exact.select("sender", "partner_id").unionByName(fuzzy).groupBy("sender").agg(F.array_sort(F.collect_set("partner_id")).alias("ids"))
    return wanted.join(ids, "sender", "left").withColumn("ids", F.coalesce("ids", F.array().cast("array<string>")))


def resolve_signer(queries: DataFrame, employees: DataFrame) -> DataFrame:
    """(query_id, ids) by tiers: surname within the sender's employees, then first initial, then middle initial.

    queries has query_id (unique), partner_ids, last, first, middle. A tier that finds none falls back to the one before it;
    one hit ends the search; a missing initial ends it too.
    """
    asks = ["partner_ids", "last", "first", "middle"]
    known = queries.select("query_id", F.xxhash64(*asks).alias("hash"), *asks)
    asked = kept(known.select("hash", *asks).distinct())  # equal questions are answered once
    e = employees.select("partner_id", "employee_id", F.lower("last_name").alias("l"), "first_name", "middle_name")
    hits = asked.withColumn("partner_id", F.explode("partner_ids")).withColumn("l", F.lower("last")).join(e, ["partner_id", "l"])
    initial = lambda c: F.upper(F.substring(c, 1, 1))
    hits = hits.withColumn("f", F.coalesce(initial("first") == initial("first_name"), F.lit(False)))
    hits = hits.withColumn("m", F.coalesce(F.col("f") & (initial("middle") == initial("middle_name")), F.lit(False)))
    of = lambda c: F.collect_set(F.when(F.col(c), F.col("employee_id"))).alias(f"of_{c}")
    tiers = hits.groupBy("hash", *asks).agg(F.collect_set("employee_id").alias("of_l"), of("f"), of("m"), F.sum(F.col("f").cast("int")).alias("n_f"), F.sum(F.col("m").cast("int")).alias("n_m"))
    ids = F.when(F.col("n_f") == 0, F.col("of_l")).when((F.col("n_f") == 1) | (F.col("n_m") == 0), F.col("of_f")).otherwise(F.col("of_m"))
    answers = kept(tiers.select("hash", *asks, F.array_sort(ids).alias("ids"))).alias("t")
    same = F.col("k.hash") == F.col("t.hash")
    for c in asks:
        same = same & F.col(f"k.{c}").eqNullSafe(F.col(f"t.{c}"))
    return known.alias("k").join(answers, same, "left").select("query_id", F.coalesce("ids", F.array().cast("array<string>")).alias("ids"))


def best_reference_row(pairs: DataFrame, query: str, how: str) -> DataFrame:
    """Of scored (query, row_id, org_sim, person_sim) rows the best by one of the published orders.

    multi_sim: product; org_first: organisation if any over 60, else person if any over 90, else person then organisation;
    signer_by_sender: best organisation, then person in it; sender_by_signer: the reverse.
    """
    w = Window.partitionBy(query)
    scored = pairs.withColumns({"any_org": F.max("org_sim").over(w) > 60, "any_person": F.max("person_sim").over(w) > 90})
    org_first = [F.col("org_sim").desc(), F.col("person_sim").desc(), F.col("row_id")]
    person_first = [F.col("person_sim").desc(), F.col("org_sim").desc(), F.col("row_id")]
    if how == "multi_sim":
        order = [(F.col("org_sim") * F.col("person_sim")).desc(), F.col("row_id")]
    elif how == "signer_by_sender":
        order = org_first
    elif how == "sender_by_signer":
        order = person_first
    else:
        a = F.when(F.col("any_org"), F.col("org_sim")).otherwise(F.col("person_sim"))
        b = F.when(F.col("any_org"), F.col("person_sim")).otherwise(F.col("org_sim"))
        order = [a.desc(), b.desc(), F.col("row_id")]
    return scored.withColumn("place", F.row_number().over(w.orderBy(*order))).where("place = 1").drop("place", "any_org", "any_person")


def top_persons(pairs: DataFrame, query: str, k: int = 5, least: float = 95.0) -> DataFrame:
    """The k best persons with at least that similarity, and the best one whatever it has."""
    placed = pairs.withColumn("place", F.row_number().over(Window.partitionBy(query).orderBy(F.col("person_sim").desc(), "row_id")))
    return placed.where((F.col("place") == 1) | ((F.col("place") <= k) & (F.col("person_sim") >= least)))


def four_ways(pairs: DataFrame, query: str) -> DataFrame:
    """One row a query: the row_id that each of the four orders takes, side by side. The pairs are read once, and each task keeps the best of its own."""
    org, person, row = F.col("org_sim"), F.col("person_sim"), F.col("row_id")
    first = lambda *order: F.min_by("row_id", F.struct(*[-c for c in order], row))
    best = pairs.groupBy(query).agg(
        first(org * person).alias("multi_sim"), first(org, person).alias("signer_by_sender"), first(person, org).alias("sender_by_signer"), F.max(org).alias("top_org")
    )
    org_first = F.when(F.col("top_org") > 60, F.col("signer_by_sender")).otherwise(F.col("sender_by_signer"))
    return best.select(query, "multi_sim", org_first.alias("org_first"), "signer_by_sender", "sender_by_signer")


def best_org_of_top_persons(pairs: DataFrame, query: str, k: int = 5, least: float = 95.0) -> DataFrame:
    """Of the top persons of each query the one with the best organisation."""
    w = Window.partitionBy(query).orderBy(F.col("org_sim").desc(), "place")
    return top_persons(pairs, query, k, least).withColumn("first", F.row_number().over(w)).where("first = 1").drop("first", "place")


def without(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Rows whose key the other frame lacks; those with a null key stay."""
    return df.join(other, key, "left_anti")


def contains(ids: Column, id_: Column) -> Column:
    return F.coalesce(F.array_contains(ids, id_), F.lit(False))
