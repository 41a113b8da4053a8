"""Further queries: whole-frame steps, choices among scored rows, boxes of pages, labels, cleaning rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.functions import dates as D
from quillspark.functions import text as T
from quillspark.operators import entities, evaluate, frames, layout, reference_data, resolve, search
from quillspark.operators.groups import first_per_group
from quillspark.plans.queries import COS, PAIRS, _asked, query
from quillspark.sources.readers import table

# --- whole frames -------------------------------------------------------------------------------------------------


@query("""SELECT doc_id, CASE WHEN lang = 'en' THEN '*' ELSE lang END AS filled, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE lang END AS emptied
    FROM documents WHERE lang IS NOT NULL AND length(text) BETWEEN 100 AND 2000""")
def fill_and_empty(spark, sf):
    """English made empty or null and filled; white space made null; texts of a range of sizes."""
    d = frames.sized(table(spark, sf, "documents").where("lang is not null"), "text", 100, 2000)
    d = d.select("doc_id", F.when(F.col("lang") != "en", F.col("lang")).when(F.col("doc_id") % 2 == 0, "").alias("filled"), F.when(F.col("doc_id") % 3 == 0, "  \n").otherwise(F.col("lang")).alias("emptied"))
    return frames.empty_to_null(frames.filled(d, {"filled": "*"}), "emptied")


@query("SELECT doc_id FROM (SELECT doc_id, row_number() OVER (ORDER BY md5('7:' || doc_id), doc_id) AS r FROM documents) WHERE r <= 100")
def paired_sample(spark, sf):
    """A sampling operator: 100 documents without replacement."""
    return frames.sampled(table(spark, sf, "documents").select("doc_id"), "doc_id", 100, 7)


@query("""SELECT c_custkey::VARCHAR AS c_custkey, s_suppkey::VARCHAR AS s_suppkey FROM (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS r FROM customer) FULL JOIN (SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey) AS r FROM supplier) USING (r)""")
def horizontal_concat(spark, sf):
    both = frames.side_by_side(table(spark, sf, "customer").select("c_custkey"), "c_custkey", table(spark, sf, "supplier").select("s_suppkey"), "s_suppkey")
    return both.select(*[F.col(c).cast("string").alias(c) for c in ("c_custkey", "s_suppkey")])


@query("SELECT p_partkey, r::BIGINT AS position FROM (SELECT p_partkey, row_number() OVER (ORDER BY p_partkey) - 1 AS r FROM part) WHERE r IN (0, 3, 17, 100)")
def positional_rows(spark, sf):
    return frames.rows_at(table(spark, sf, "part").select("p_partkey"), "p_partkey", [0, 3, 17, 100])


@query("SELECT event_type AS value, min(event_id) AS first, count(*) AS n FROM events WHERE event_type IS NOT NULL GROUP BY 1")
def unique_values(spark, sf):
    return frames.unique_in_order(table(spark, sf, "events"), "event_type", "event_id")


@query("SELECT array_to_string(list, '|') AS list, len(list)::INT AS size, n FROM (SELECT string_split(p_name, ' ') AS list, count(*) AS n FROM part WHERE p_name IS NOT NULL GROUP BY 1)")
def distinct_word_lists(spark, sf):
    lists = table(spark, sf, "part").where("p_name is not null").select(F.split("p_name", " ").alias("words"))
    return frames.distinct_lists(lists, "words").withColumn("list", F.array_join("list", "|"))


@query("""SELECT share::DOUBLE AS share, round(value, 4) AS value FROM (SELECT unnest([0.0, 0.25, 0.5, 0.75, 1.0]) AS share,
    unnest(quantile_cont(l_extendedprice::DOUBLE, [0.0, 0.25, 0.5, 0.75, 1.0])) AS value FROM lineitem)""")
def describe_quantiles(spark, sf):
    return frames.quantiles(table(spark, sf, "lineitem"), "l_extendedprice", [0.0, 0.25, 0.5, 0.75, 1.0]).withColumn("value", F.round("value", 4))


@query("SELECT share::DOUBLE AS share, value FROM (SELECT unnest([0.1, 0.5, 0.99]) AS share, unnest(quantile_cont(l_quantity::DOUBLE, [0.1, 0.5, 0.99])) AS value FROM lineitem)")
def describe_quantiles_ties(spark, sf):
    return frames.quantiles(table(spark, sf, "lineitem"), "l_quantity", [0.1, 0.5, 0.99])


@query("""SELECT count(l_quantity) AS n, round(min(l_quantity), 2)::DOUBLE AS low, round(avg(l_quantity), 4) AS mean, round(max(l_quantity), 2)::DOUBLE AS high, round(stddev_samp(l_quantity), 4) AS std FROM lineitem""")
def describe_summary(spark, sf):
    out = frames.summary(table(spark, sf, "lineitem"), "l_quantity")
    return out.select("n", *[F.round(F.col(c).cast("double"), d).alias(c) for c, d in (("low", 2), ("mean", 4), ("high", 2), ("std", 4))])


@query("""SELECT CASE WHEN toxic = 1 THEN 'toxic' WHEN quality = 1 THEN 'good' WHEN toxic IS NULL THEN 'unknown' ELSE 'poor' END AS status, count(*) AS n FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1""")
def status_counts(spark, sf):
    both = table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels").select("doc_id", "toxic", "quality"), "doc_id", "left")
    return frames.status_counts(both, {"toxic": F.col("toxic") == 1, "good": F.col("quality") == 1, "unknown": F.col("toxic").isNull()}, "poor")


@query("""SELECT quality, toxic, n FROM (SELECT *, row_number() OVER (ORDER BY n DESC, quality, toxic) AS r FROM (SELECT quality, toxic, count(*) AS n FROM labels WHERE quality IS DISTINCT FROM toxic GROUP BY 1, 2)) WHERE r <= 10""")
def error_frequency(spark, sf):
    return frames.error_frequency(table(spark, sf, "labels"), "quality", "toxic")


@query("SELECT DISTINCT o_orderkey, n_nationkey, n_name FROM (SELECT o_orderkey, unnest([o_custkey % 30, o_orderkey % 30, o_custkey % 30]) AS n_nationkey FROM orders) JOIN nation USING (n_nationkey)")
def reference_rows_of_ids(spark, sf):
    asked = table(spark, sf, "orders").select("o_orderkey", F.array(*[(F.col(c) % 30) for c in ("o_custkey", "o_orderkey", "o_custkey")]).alias("ids"))
    return frames.rows_of_ids(asked, "ids", table(spark, sf, "nation").select("n_nationkey", "n_name"), "n_nationkey").select("o_orderkey", "n_nationkey", "n_name")


#: Places of a vector.
PLACES = 64


@query(f"SELECT vec_id, {', '.join(f'round(embedding[{i + 1}]::DOUBLE, 6) AS v{i}' for i in range(PLACES))} FROM embeddings")
def wide_embeddings(spark, sf):
    w = frames.wide(table(spark, sf, "embeddings"), "embedding", PLACES, ("label",))
    return w.select("vec_id", *[F.round(F.col(f"v{i}").cast("double"), 6).alias(f"v{i}") for i in range(PLACES)])


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN (o_orderkey * 2)::VARCHAR END AS doubled, CASE WHEN o_orderkey % 5 = 0 THEN 'ValueError' END AS error FROM orders""")
def captured_errors(spark, sf):
    """A Python step that fails on every fifth row; its error is data."""
    rows = table(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 5 == 0, "no number").otherwise(F.col("o_orderkey").cast("string")).alias("raw"))
    return frames.captured(rows, "raw", lambda t: str(int(t) * 2), "doubled").select("o_orderkey", "doubled", "error")


@query("SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def rows_without(spark, sf):
    return resolve.without(table(spark, sf, "documents").select("doc_id"), table(spark, sf, "labels"), "doc_id")


# --- choices among scored rows ------------------------------------------------------------------------------------

#: Line items as candidates of an order: two similarities from 0 to 100.
SCORED = "SELECT l_orderkey AS q, l_linenumber AS row_id, max(l_quantity * 2)::DOUBLE AS org_sim, max(round(l_discount * 500 + l_quantity, 6))::DOUBLE AS person_sim FROM lineitem GROUP BY 1, 2"


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    person = F.round(F.col("l_discount") * 500 + F.col("l_quantity"), 6).cast("double")
    by = (F.col("l_orderkey").alias("q"), F.col("l_linenumber").alias("row_id"))
    return table(spark, sf, "lineitem").groupBy(*by).agg(F.max(F.col("l_quantity") * 2).cast("double").alias("org_sim"), F.max(person).alias("person_sim"))


@query(f"""WITH s AS (SELECT *, max(org_sim) OVER (PARTITION BY q) > 60 AS o FROM ({SCORED})), r AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY org_sim * person_sim DESC, row_id) AS a,
    row_number() OVER (PARTITION BY q ORDER BY CASE WHEN o THEN org_sim ELSE person_sim END DESC, CASE WHEN o THEN person_sim ELSE org_sim END DESC, row_id) AS b,
    row_number() OVER (PARTITION BY q ORDER BY org_sim DESC, person_sim DESC, row_id) AS c, row_number() OVER (PARTITION BY q ORDER BY person_sim DESC, org_sim DESC, row_id) AS d FROM s)
    SELECT q, max(row_id) FILTER (a = 1) AS multi_sim, max(row_id) FILTER (b = 1) AS org_first, max(row_id) FILTER (c = 1) AS signer_by_sender, max(row_id) FILTER (d = 1) AS sender_by_signer FROM r GROUP BY q""")
def four_way_lookup(spark, sf):
    return resolve.four_ways(_scored(spark, sf), "q")


@query(f"SELECT q, row_id, r::INT AS place FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY person_sim DESC, row_id) AS r FROM ({SCORED})) WHERE r = 1 OR (r <= 2 AND person_sim >= 60)")
def top_persons(spark, sf):
    return resolve.top_persons(_scored(spark, sf), "q", 2, 60.0).select("q", "row_id", "place")


@query(f"""SELECT q, row_id FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY org_sim DESC, r) AS b FROM
    (SELECT *, row_number() OVER (PARTITION BY q ORDER BY person_sim DESC, row_id) AS r FROM ({SCORED})) WHERE r = 1 OR (r <= 3 AND person_sim >= 50)) WHERE b = 1""")
def best_org_of_top_persons(spark, sf):
    return resolve.best_org_of_top_persons(_scored(spark, sf), "q", 3, 50.0).select("q", "row_id")


@query(f"""SELECT query_id, id, cos FROM (SELECT q.vec_id AS query_id, e.vec_id AS id, {COS} AS cos FROM embeddings q JOIN embeddings e ON q.vec_id % 50 = 0 AND q.vec_id <> e.vec_id AND q.label = e.label)""")
def cluster_search(spark, sf):
    """Search restricted to the query's cluster, here its label."""
    return search.within_cluster(*_asked(spark, sf), "label")


@query(f"""SELECT query_id, id, cos_place::INT AS cos_place, place::INT AS place FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY id % 7 DESC, cos_place) AS place
    FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY cos DESC, id) AS cos_place FROM ({PAIRS})) WHERE cos_place <= 30) WHERE place <= 10""")
def cross_top10(spark, sf):
    """The ten best by cross score of the 30 nearest; a stand-in replaces the cross-encoder."""
    return search.top_cross(search.nearest(*_asked(spark, sf), 30).drop("place"), F.col("id") % 7).select("query_id", "id", "cos_place", "place")


# --- pages and boxes ----------------------------------------------------------------------------------------------

#: Line items as pages of an order; orders with a key of 7 lack the first.
PAGED = "SELECT l_orderkey AS doc_id, (l_linenumber + (l_orderkey % 7 = 0)::INT)::INT AS page_num, l_quantity::DOUBLE AS \"Xmax\", 25.0::DOUBLE AS \"Ymax\" FROM lineitem"


def _paged(spark: SparkSession, sf: str) -> DataFrame:
    page = (F.col("l_linenumber") + (F.col("l_orderkey") % 7 == 0).cast("int")).cast("int")
    rows = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("doc_id"), page.alias("page_num"), F.col("l_quantity").cast("double").alias("Xmax"), F.lit(25.0).alias("Ymax"))
    return rows.withColumns({"file_pos": F.lit(0), "block_seq": F.lit(0), "line_seq": F.col("Xmax")})


@query(f"SELECT doc_id, 'no first page' AS reason, count(*) OVER () AS n FROM (SELECT doc_id FROM ({PAGED}) GROUP BY doc_id HAVING min(page_num) <> 1)")
def first_page_rejects(spark, sf):
    good, rejects = layout.split_rejects(_paged(spark, sf))
    n = rejects.agg(F.count("*").alias("n"))
    return rejects.join(good, "doc_id", "left_anti").join(F.broadcast(n))


@query(f"""SELECT doc_id, page_num, "Xmax" AS x FROM (SELECT *, first_value(floor("Xmax" / "Ymax")) OVER (PARTITION BY doc_id ORDER BY page_num, "Xmax" ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS f FROM ({PAGED}))
    WHERE floor("Xmax" / "Ymax") = f""")
def same_orientation(spark, sf):
    return layout.keep_orientation(_paged(spark, sf)).select("doc_id", "page_num", F.col("Xmax").alias("x"))


#: The best box of each page and class, by its score.
BOXES = """SELECT doc_id, page_num, cls, text, proba FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, page_num, cls ORDER BY proba DESC, text) AS r FROM (SELECT l_orderkey AS doc_id, l_linenumber AS page_num, ['text', 'signer', 'sender'][(l_partkey % 3 + 1)::INT] AS cls, l_returnflag AS text, l_discount::DOUBLE AS proba FROM lineitem)) WHERE r = 1"""


@query(f"""WITH b AS (SELECT *, min(page_num) FILTER (cls = 'signer') OVER (PARTITION BY doc_id) AS stop FROM ({BOXES})), k AS (SELECT * FROM b WHERE (stop IS NULL OR page_num <= stop) AND (page_num = 1 OR cls IN ('signer', 'text'))),
    m AS (SELECT doc_id, cls, CASE WHEN cls = 'text' THEN string_agg(text, ' ' ORDER BY page_num) ELSE arg_max(text, page_num) END AS text, CASE WHEN cls = 'text' THEN avg(proba) ELSE arg_max(proba, page_num) END AS proba FROM k GROUP BY doc_id, cls)
    SELECT doc_id, max(text) FILTER (cls = 'text') AS text, round(coalesce(max(proba) FILTER (cls = 'text'), 0), 6) AS text_proba, max(text) FILTER (cls = 'signer') AS signer, round(coalesce(max(proba) FILTER (cls = 'signer'), 0), 6) AS signer_proba,
    max(text) FILTER (cls = 'sender') AS sender, round(coalesce(max(proba) FILTER (cls = 'sender'), 0), 6) AS sender_proba FROM m GROUP BY doc_id""")
def merged_boxes(spark, sf):
    cls = F.get(F.array(*map(F.lit, ("text", "signer", "sender"))), (F.col("l_partkey") % 3).cast("int"))
    boxes = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("page_num"), cls.alias("cls"), F.col("l_returnflag").alias("text"), F.col("l_discount").cast("double").alias("proba"))
    boxes = first_per_group(boxes, ["doc_id", "page_num", "cls"], [F.col("proba").desc(), F.col("text")])
    flat = entities.flat_classes(entities.merge_pages(boxes), ["text", "signer", "sender"])
    return flat.select("doc_id", *[c for k in ("text", "signer", "sender") for c in (F.col(k), F.round(f"{k}_proba", 6).alias(f"{k}_proba"))])


@query(f"""SELECT doc_id, page_num, n, CASE WHEN n >= 40 THEN 'sender' ELSE 'other' END AS target FROM (SELECT *, max(n) OVER (PARTITION BY doc_id) AS top
    FROM (SELECT l_orderkey AS doc_id, 1 AS page_num, l_linenumber AS place, l_quantity::DOUBLE AS n FROM lineitem)) WHERE top >= 40""")
def marked_blocks(spark, sf):
    rows = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.lit(1).alias("page_num"), F.col("l_quantity").cast("double").alias("n"))
    return entities.marked(rows, F.col("n"), "sender", 40.0)


# --- cleaning rules, similarities ---------------------------------------------------------------------------------


@query("""SELECT partner_id, lower(name) AS partner_name FROM (SELECT s_suppkey AS partner_id, CASE s_suppkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'Тест' WHEN 2 THEN '12.5' WHEN 3 THEN s_name ELSE 'ОО' END AS name, s_suppkey % 2 AS kind FROM supplier)
    WHERE partner_id % 5 = 3 AND kind = 0""")
def clean_partners(spark, sf):
    """Suppliers as partners; every row twice; of five names only one kind stays."""
    k = F.col("s_suppkey") % 5
    name = F.when(k == 1, "Тест").when(k == 2, "12.5").when(k == 3, F.col("s_name")).when(k == 4, "ОО")
    p = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("partner_id"), name.alias("partner_name"), F.col("s_name").alias("partner_full_name"), (F.col("s_suppkey") % 2).alias("partner_type"), F.lit(False).alias("partner_not_available"))
    return reference_data.clean_partners(p.unionByName(p)).select("partner_id", "partner_name")


@query("""SELECT c_custkey, 'Орлов' AS last_name, 'А' AS first_name, 'Б' AS middle_name FROM customer WHERE c_custkey % 4 = 0 UNION ALL SELECT c_custkey, 'Ю', 'А', 'Б' FROM customer WHERE c_custkey % 4 = 1""")
def clean_employees(spark, sf):
    """Customers as employees whose names are stored the wrong way round; placeholders and single letters go."""
    k = F.col("c_custkey") % 4
    last = F.when(k == 0, "орлов-1").when(k == 1, "ю.").when(k == 2, "Подписант").otherwise("Щ")
    e = table(spark, sf, "customer").select("c_custkey", last.alias("last_name"), F.lit("борисович").alias("first_name"), F.lit("анна").alias("middle_name"))
    return reference_data.clean_employees(e)


JW = """j + 0.1 * (1 - j) * CASE WHEN a[1:4] = b[1:4] THEN 4 WHEN a[1:3] = b[1:3] THEN 3 WHEN a[1:2] = b[1:2] THEN 2 WHEN a[1] = b[1] THEN 1 ELSE 0 END"""


@query(f"""SELECT p_partkey, round(100 * ({JW}), 4) AS name, round(CASE WHEN p_size < 10 THEN 0 ELSE 100 * ({JW}) END, 4) AS sender FROM (SELECT *, jaro_similarity(a, b) AS j FROM (SELECT p_partkey, p_size, lower(p_name) AS a, lower(p_type) AS b FROM part))""")
def label_similarities(spark, sf):
    """Similarities that label blocks: of names, and of senders by the block's place."""
    ybot = F.when(F.col("p_size") < 10, 0.5).otherwise(0.9)
    out = table(spark, sf, "part").select("p_partkey", evaluate.name_similarity(F.upper("p_name"), F.col("p_type")).alias("name"), evaluate.sender_similarity(ybot, F.col("p_name"), F.col("p_type"), True).alias("sender"))
    return out.select("p_partkey", F.round("name", 4).alias("name"), F.round("sender", 4).alias("sender"))


@query(f"""WITH w AS (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS a FROM part), s AS (SELECT a, b, k, jaro_similarity(a, b) AS j FROM w, (SELECT unnest(['bolt', 'ring']) AS b, unnest([1, 2]) AS k))
    SELECT a AS word, coalesce(arg_min(b, k) FILTER ({JW} >= 0.9), a) AS known FROM s WHERE a <> '' GROUP BY a""")
def canonical_words(spark, sf):
    words = table(spark, sf, "part").select(F.explode(F.split("p_name", " ")).alias("word")).where("word <> ''").distinct()
    return words.select("word", resolve.canonical_sender(F.col("word"), [("bolt", []), ("ring", [])]).alias("known"))


@query(f"""WITH m AS (SELECT o_orderkey, month(o_orderdate) AS k FROM orders) SELECT o_orderkey, ({list(D.MONTHS)})[k] AS word, k::VARCHAR AS number, k::VARCHAR AS short FROM m""")
def month_words(spark, sf):
    """The month of each order as a word, the number of the word, and that of its first three letters, which are a short form."""
    o = table(spark, sf, "orders").select("o_orderkey", F.get(F.array(*map(F.lit, D.MONTHS)), F.month("o_orderdate") - 1).alias("word"))
    number = lambda c: F.coalesce(D.month_number(c).cast("string"), F.lit(""))
    return o.select("o_orderkey", "word", number(F.col("word")).alias("number"), number(F.substring("word", 1, 3)).alias("short"))


@query(f"""SELECT o_orderkey, day(o_orderdate) || ' ' || ({list(D.ENGLISH)})[month(o_orderdate)] || ' ' || year(o_orderdate) AS english FROM orders""")
def month_translation(spark, sf):
    """Dates with Russian months, with English ones."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", F.get(F.array(*map(F.lit, D.MONTHS)), F.month("o_orderdate") - 1).alias("word"))
    russian = F.concat_ws(" ", F.dayofmonth("o_orderdate").cast("string"), "word", F.year("o_orderdate").cast("string"))
    return o.select("o_orderkey", D.with_english_months(russian).alias("english"))


@query("""SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'О поставке товара ' || o_custkey WHEN 1 THEN 'Об оплате счёта' END AS subject FROM orders""")
def letter_subjects(spark, sf):
    k = F.col("o_orderkey") % 3
    body = F.when(k == 0, F.concat(F.lit("Исх. 12\nО поставке товара_"), F.col("o_custkey").cast("string"), F.lit("_\nПросим"))).when(k == 1, "Кому\nОб оплате счёта\t\nПросим").otherwise(F.concat(F.lit("О "), F.repeat(F.lit("товар "), 40)))
    return table(spark, sf, "orders").select("o_orderkey", T.subject(body).alias("subject"))


@query("""SELECT p_partkey, array_to_string(list_sort(map_keys(map_concat(MAP {'size': p_size}, MAP {'brand': p_size, 'size': 0}))), ',') AS keys, array_to_string(flatten([string_split(p_name, ' '), [p_type]]), '|') AS flat FROM part WHERE p_name IS NOT NULL AND p_type IS NOT NULL""")
def map_and_flatten(spark, sf):
    """Lists of lists as one list; a key added to a map, a known one replaced."""
    p = table(spark, sf, "part").where("p_name is not null and p_type is not null")
    more = frames.with_entries(F.create_map(F.lit("size"), F.col("p_size")), F.create_map(F.lit("brand"), F.col("p_size"), F.lit("size"), F.lit(0)))
    return p.select("p_partkey", F.array_join(F.array_sort(F.map_keys(more)), ",").alias("keys"), F.array_join(F.flatten(F.array(F.split("p_name", " "), F.array("p_type"))), "|").alias("flat"))


@query("""SELECT event_id, k FROM (SELECT event_id, (props->>'$.k')::BIGINT AS k, CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS kind FROM events) WHERE k IS NOT NULL AND kind IS NOT NULL""")
def complete_rows(spark, sf):
    """Rows without any null."""
    e = table(spark, sf, "events").select("event_id", F.get_json_object("props", "$.k").try_cast("bigint").alias("k"), F.when(F.col("event_type") != "error", F.col("event_type")).alias("kind"))
    return frames.without_nulls(e).select("event_id", "k")


@query("SELECT n_nationkey::VARCHAR AS key, n_name AS name, n_regionkey::INT AS region FROM nation")
def mapping_to_rows(spark, sf):
    """A JSON object of objects, made of the nations, back to rows."""
    n = table(spark, sf, "nation").select(F.to_json(F.map_from_arrays(F.array(F.col("n_nationkey").cast("string")), F.array(F.struct(F.col("n_name").alias("name"), F.col("n_regionkey").alias("region"))))).alias("raw"))
    return frames.rows_of_mapping(n, "raw", "name string, region int")


@query("""SELECT c_custkey, coalesce((SELECT o_orderkey FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = CASE WHEN c_mktsegment = 'BUILDING' THEN '1-URGENT' ELSE '5-LOW' END ORDER BY o_orderdate DESC, o_orderkey LIMIT 1), -1) AS last FROM customer""")
def correlated_lookup(spark, sf):
    """Of each customer the last order of a priority that its segment tells: a look-up for every row, as one join."""
    c = table(spark, sf, "customer").withColumn("wanted", F.when(F.col("c_mktsegment") == "BUILDING", "1-URGENT").otherwise("5-LOW"))
    out = frames.lookup(c, [("c_custkey", "o_custkey"), ("wanted", "o_orderpriority")], table(spark, sf, "orders"), "o_orderkey", [-F.unix_seconds(F.col("o_orderdate").cast("timestamp")), F.col("o_orderkey")], "last")
    return out.select("c_custkey", F.coalesce("last", F.lit(-1)).alias("last"))


@query("SELECT array_to_string(list, '|') AS list, len(list)::INT AS size, n FROM (SELECT string_split(p_name, ' ') AS list, count(*) AS n FROM part WHERE p_name IS NOT NULL GROUP BY 1) WHERE len(list) > 1")
def longer_word_lists(spark, sf):
    lists = table(spark, sf, "part").where("p_name is not null").select(F.split("p_name", " ").alias("words"))
    return frames.distinct_lists(lists, "words", 1).withColumn("list", F.array_join("list", "|"))
