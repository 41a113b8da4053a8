"""Layout, text, dates, entities and resolution on hand-made fixtures."""

import datetime

from pyspark.sql import functions as F

from quillspark.functions import dates as D
from quillspark.functions import text as T
from quillspark.operators import entities, layout, reference_data, resolve
from quillspark.sources import readers


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "t string").select(column(F.col("t"))).first()[0]


def block(text, y=0.7, font="Arial"):
    return {"text": text, "coords": [10.0, 100.0 * y, 90.0, 100.0 * y + 5], "font_name": font, "font_size_pt": 12.0}


def tree(spark, docs):
    rows = [(d, [{"id": "f", "order": 1, "extension": ".pdf", "pages": [{"page_num": n, "meta": m, "blocks": b} for n, m, b in pages]}]) for d, pages in docs.items()]
    return spark.createDataFrame(rows, readers.DOCUMENT_TREE)


PORTRAIT, LANDSCAPE = [0.0, 0.0, 80.0, 100.0], [0.0, 0.0, 100.0, 80.0]


def test_layout(spark):
    many = [block("ПЕРВАЯ СТРОКА\nВТОРАЯ СТРОКА\nтретья строка", font="X-Bold"), block("Иной блок текста", 0.5), block("И ещё один блок", 0.3), block("ab")]
    docs = tree(spark, {"a": [(1, PORTRAIT, many), (2, PORTRAIT, many), (4, PORTRAIT, many), (3, LANDSCAPE, many)], "b": [(2, PORTRAIT, many)], "c": [(1, PORTRAIT, many[:1])]})
    rows, rejects = layout.letter_features(docs)
    rows = rows.collect()
    assert [(r.doc_id, r.reason) for r in rejects.collect()] == [("b", "no first page")]
    assert {r.doc_id for r in rows} == {"a"} and {r.page_num for r in rows} == {1, 2} and len(rows) == 8
    first = min(rows, key=lambda r: (r.page_num, r.block_seq, r.line_seq))
    assert first.text == "ПЕРВАЯ СТРОКА ВТОРАЯ СТРОКА" and first.font_bold and first.xtop == first.ytop == 1.0 and first.distance_y == 0
    assert first.blocks_on_the_left == 0 and first.blocks_on_the_right == 3 and first.first_page


def test_consecutive_prefix(spark):
    pages = spark.createDataFrame([("a", p) for p in (1, 2, 4, 5)] + [("b", 2), ("c", 1)], "doc_id string, page_num int")
    assert sorted(map(tuple, layout.consecutive_prefix(pages).collect())) == [("a", 1), ("a", 2), ("c", 1)]


def test_texts(spark):
    assert one(spark, T.subject, "шапка О направлении_отчёта за год") == "О направлении отчёта за год" and one(spark, T.subject, "Отчёт") is None
    assert one(spark, T.outgoing_number, "исх. № 12/3 от") == "№ 12/3" and one(spark, T.outgoing_number, "нет") is None
    assert one(spark, T.is_filled, "№ 12") and not one(spark, T.is_filled, "№ ____")
    assert one(spark, T.trimmed_number, "№ 12-а н") == " 12-а " and one(spark, T.clean_number, "№ 7»—") == "7" and one(spark, T.clean_number, "№_") is None
    assert one(spark, T.clean_name, "ООО «Ромашка»") == "ооо  ромашка" and one(spark, T.clean_name, "«»") == one(spark, T.clean_name, None) == "не определён" and one(spark, T.unspaced, "П И С Ь М О") == "ПИСЬМО"
    assert one(spark, T.subject, "\tО направлении отчёта\n") == "О направлении отчёта"
    assert one(spark, T.format_fio, "Петр Александрович Иванов-") == "Александрович ИвановПетр" and one(spark, T.format_fio, "и Иванов") == "Иванов и"
    assert one(spark, T.format_fio, "12. иванов и. п.") == "Иванов И.П." and one(spark, T.format_fio, "а б в  г!") == "а б в г" and one(spark, T.format_fio, "") == ""
    assert one(spark, lambda c: T.format_fullname(c, True), "Иванов И.П.") == "И.П. Иванов"
    assert one(spark, T.format_fullname, "Директор Иванов И. П. (подпись)") == one(spark, T.format_fullname, "И.П.Иванов") == "И.П. Иванов" and one(spark, T.format_fullname, "Иванов") == "Иванов"
    assert one(spark, lambda c: T.format_fullname(c, False), "подписал И.П. Иванов") == "Иванов И.П."
    assert one(spark, T.without_placeholder, "И.О. Фамилия") == "И.О. Фамилия" and one(spark, T.without_placeholder, "Руководитель Р.Р.") is None and one(spark, T.longest_token, "аб где жз") == "где"


def test_dates(spark):
    assert one(spark, D.find_date, "от 12.03.2021 и 1 мая 2020").asDict() == {"text": " 12.03.2021", "start": 2, "end": 13}
    assert one(spark, D.find_date, "нет").asDict() == {"text": None, "start": -1, "end": -1}
    assert one(spark, D.parse_date, "«5» августа 2021 г.") == datetime.date(2021, 8, 5) and one(spark, D.parse_date, "5 Августа 2021") is None and one(spark, D.parse_date, "№5 сен 2021_") == datetime.date(2021, 9, 5) and one(spark, D.parse_date, "31.02.2021") is None
    assert one(spark, D.parse_date, "1.02.21") == datetime.date(2021, 2, 1)
    show = lambda c: D.rendered(D.dated(c, F.lit(False)))
    assert one(spark, show, "1.02.21") == "01.02.2021" and one(spark, show, "?") == D.UNKNOWN


def test_dates_of_replies(spark):
    """What stands around "от" behind "на №" is one space, across line breaks."""
    text = "На № 12\nот 01.02.2021 и далее, письмо зарегистрировано 03.04.2021"
    got = one(spark, lambda c: D.find_date(c, True), text)
    assert (got.text, got.start, got.end) == (" 03.04.2021", 24, 35)
    shares = spark.createDataFrame([("ёёаа\u00a0",)], "t string").select(*[c.alias(n) for n, c in T.char_shares(F.col("t")).items()]).first()
    assert (shares.is_cirillic, shares.is_space, shares.is_other) == (0.8, 0.2, 0.0)


def test_names(spark):
    assert one(spark, T.clean_signer, "и.п. ИВАНОВ") == "Иванов И.П." and one(spark, T.clean_signer, None) == "не определён"
    assert one(spark, T.filtered_words, " ООО «Ромашка-плюс» ") == ["ООО", "Ромашка", "плюс"] and one(spark, T.name_in, "от Иванов И.П. и") == "Иванов И.П."
    pair = lambda c: F.struct(*T.comparable_names(c, F.lit("Иванов И.П.")))
    assert tuple(one(spark, pair, "И.П. Иванов")) == ("И.П. Иванов", "И.П. Иванов") and tuple(one(spark, pair, "директор Иванова")) == ("директор", "Иванов")
    assert tuple(one(spark, pair, "x" * 51)) == ("x" * 51, "Иванов И.П.")


def test_similarities_of_names(spark):
    """Hits by Jaro-Winkler over 0.9; long texts and low blocks score 0; first known name over 0.9."""
    from quillspark.operators import evaluate

    got = one(spark, lambda c: evaluate.word_matches(c, F.lit("ромашка завод")), "ромашки «завод» иной")
    assert (got.precision, got.recall) == (0.667, 1.0) and tuple(one(spark, lambda c: evaluate.word_matches(c, F.lit("")), "а")) == (0.0, 0.0)
    sim = lambda c: evaluate.name_similarity(c, F.lit("MARTHA"))
    assert abs(one(spark, sim, "Marhta") - 96.1111) < 1e-3 and one(spark, sim, "m" * 51) == 0
    part = lambda y: lambda c: evaluate.sender_similarity(F.lit(y), c, F.lit("Завод"))
    assert one(spark, part(0.7), "ООО завод плюс") == 100 and one(spark, part(0.5), "завод") == 0
    known = [("ооо ромашка", ["ромашка"]), ("зао завод", [])]
    name = lambda c: resolve.canonical_sender(c, known)
    assert one(spark, name, "ромашки") == "ооо ромашка" and one(spark, name, "зао заводы") == "зао завод" and one(spark, name, "иное") == "иное"
    score = lambda c: resolve.sender_score(c, F.lit("ООО Завод"))
    assert one(spark, score, "завод #ооо") == 100 and one(spark, score, "ЗАВОД #ООО") == 0 and one(spark, score, "письмо ооо завод от") == 100 and one(spark, score, "ооо ромашка") == 0 and one(spark, score, None) == 0


def test_entities(spark):
    rows = [("a", 1, 0, "О поставке оборудования", 0.9, 0.1, 0.9, 0.2), ("a", 1, 1, "№ 17 от 02.03.2021", 0.8, 0.1, 0.8, 0.6), ("a", 1, 2, "ООО Завод", 0.7, 0.1, 0.7, 0.9), ("b", 1, 0, "пусто", 0.9, 0.1, 0.9, 0.1)]
    blocks = spark.createDataFrame(rows, "doc_id string, page_num int, block_seq int, text string, ybot double, xbot double, ytop double, proba double")
    out = entities.predict_entities(
        blocks, entities.predict_sender(blocks), entities.predict_signer(blocks), entities.predict_date(entities.date_candidates(blocks)),
        entities.predict_number(entities.number_candidates(blocks)), entities.predict_content(blocks),
    )
    got = {r.doc_id: r for r in out.collect()}
    assert got["a"].date == datetime.date(2021, 3, 2) and got["a"].number == "17" and got["a"].content == "О поставке оборудования"
    assert got["a"].sender == "№ 17 от 02.03.2021 ООО Завод" and got["a"].signer == "ООО Завод" and got["a"].all_classes and not got["b"].all_classes


def test_merge_pages(spark):
    rows = [("d", 1, "text", "a", 0.5), ("d", 2, "text", "b", 0.7), ("d", 2, "date", "x", 0.9), ("d", 2, "signer", "s", 0.6), ("d", 3, "text", "c", 0.9)]
    merged = entities.merge_pages(spark.createDataFrame(rows, "doc_id string, page_num int, cls string, text string, proba double"))
    out = entities.flat_classes(merged, ["text", "signer", "date"]).first()
    assert (out.text, round(out.text_proba, 6), out.signer, out.date, out.date_proba) == ("a b", 0.6, "s", None, 0.0)


def test_resolution(spark):
    partners = spark.createDataFrame(
        [("1", "ооо ромашка", "общество ромашка", 0, False), ("2", "ооо ромашки", None, 0, False), ("7", "ооо ромашкин", None, 0, None), ("3", "123", None, 0, False), ("4", "тест", None, 0, False), ("5", "зао завод", "ооо ромашка", 0, False), ("6", "x", None, 1, False)],
        "partner_id string, partner_name string, partner_full_name string, partner_type int, partner_not_available boolean",
    )
    clean = reference_data.clean_partners(partners)
    assert sorted(r.partner_id for r in clean.collect()) == ["1", "2", "5"]
    q = spark.createDataFrame([("ооо ромашка",), ("завод зао",), ("иное",), (None,)], "sender string")
    assert {r.sender: r.ids for r in resolve.resolve_sender(q, clean).collect()} == {"ооо ромашка": ["1", "5"], "завод зао": ["5"], "иное": []}
    assert sorted((r.partner_id, r.twin_id) for r in reference_data.twins(clean, 90).collect()) == [("1", "2"), ("2", "1")]
    e = spark.createDataFrame([("1", "a", "Иванов", "Пётр", "Ильич"), ("1", "b", "Иванов", "Павел", "Олегович"), ("1", "c", "Иванов", "Олег", None), ("2", "d", "Иванов", "Пётр", None)], "partner_id string, employee_id string, last_name string, first_name string, middle_name string")
    q = spark.createDataFrame([(1, ["1"], "Иванов", None, None), (2, ["1"], "Иванов", "П", None), (3, ["1"], "иванов", "п", "о"), (4, ["1", "2"], "Иванов", "О", "Я"), (5, [], "Иванов", "О", None), (6, ["1"], "Иванов", "Я", None)], "query_id long, partner_ids array<string>, last string, first string, middle string")
    assert {r.query_id: r.ids for r in resolve.resolve_signer(q, e).collect()} == {1: ["a", "b", "c"], 2: ["a", "b"], 3: ["b"], 4: ["c"], 5: [], 6: ["a", "b", "c"]}
    assert reference_data.clean_employees(e).where("employee_id = 'a'").first().first_name == "И"


def test_sources(spark, tmp_path):
    (tmp_path / "m.json").write_text('{"a": "x", "b": null, "c": "y"}', encoding="utf-8")
    assert sorted(map(tuple, readers.read_mapping(spark, str(tmp_path / "m.json")).collect())) == [("a", "x"), ("c", "y")]
    (tmp_path / "t.csv").write_bytes("id,name\n1,Завод\n".encode("windows-1251"))
    assert readers.read_csv(spark, str(tmp_path / "t.csv"), "id int, name string", "windows-1251").first().name == "Завод"
    files = spark.createDataFrame([("d", "1", 1, ".pdf"), ("d", "2", 2, ".PDF"), ("d", "3", 3, ".pdf"), ("d", "4", 4, ".doc")], "doc_id string, id string, `order` int, extension string")
    assert readers.last_pdf(files, files.where("id <> '3'").select("id")).first().id == "2"


def test_mapping_round_trip_and_files(spark, tmp_path):
    from quillspark.sources import readers

    rows = spark.createDataFrame([("а", "1"), ("б", "2"), (None, "3"), ("а", "0")], "source string, target string")
    readers.write_mapping(rows, str(tmp_path / "map"))
    assert sorted(map(tuple, readers.read_mapping(spark, str(tmp_path / "map")).collect())) == [("а", "0"), ("б", "2")]
    tree = spark.createDataFrame([("d", [("x", 2, ".pdf"), ("y", 1, ".doc")]), ("e", []), ("f", None)], "doc_id string, files array<struct<id string, `order` int, extension string>>")
    assert [tuple(r) for r in readers.nth_file(tree, 1).collect()] == [("d", "x", ".pdf")] and readers.nth_file(tree, 2).isEmpty()


def test_twins_counted_and_used(spark):
    from quillspark.operators import reference_data as R

    partners = spark.createDataFrame([("1", "ооо весна юг"), ("2", "весна ооо юг"), ("3", "завод"), ("4", "ооо весна юг")], "partner_id string, partner_name string")
    found = R.twins(partners)
    assert {r.partner_id: r.n_twins for r in R.twin_counts(partners, found).collect()} == {"1": 2, "2": 2, "3": 0, "4": 2}
    truth = spark.createDataFrame([("2",), ("3",)], "sender_id string")
    assert {r.twin_id for r in R.used_twins(found, truth).collect()} == {"2"} and {r.twin_id for r in R.unused_twins(found, truth).collect()} == {"1", "4"}


def test_quantiles_of_ties_nulls_and_nothing(spark):
    import numpy as np

    from quillspark.operators import frames

    values = [None, 3.0] + [1.0] * 50 + [float(x) for x in range(20)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    shares = [0.0, 0.1, 0.33, 0.5, 0.9, 1.0]
    got = {r.share: r.value for r in frames.quantiles(df, "v", shares, segments=5).collect()}
    assert all(abs(got[s] - np.quantile([v for v in values if v is not None], s)) < 1e-9 for s in shares)
    assert frames.quantiles(df.where("v < 0"), "v", shares).isEmpty()


def test_case_islands_of_odd_lists(spark):
    from quillspark.operators import layout

    rows = [(1, ["AB", "CD", "xx", "yy", "", "EF"]), (2, []), (3, None), (4, ["a"]), (5, ["A"] * 300 + ["b"] * 300)]
    got = {r.i: r.o for r in spark.createDataFrame(rows, "i int, l array<string>").select("i", layout.case_islands(F.col("l")).alias("o")).collect()}
    assert got == {1: ["AB CD", "xx yy ", "EF"], 2: [], 3: None, 4: ["a"], 5: [" ".join("A" * 300), " ".join("b" * 300)]}


def test_dates_and_names_are_worked_out_once(spark):
    """What is used more than once is bound, not written out again in each place."""
    from pyspark.sql import functions as F

    from quillspark.functions import dates as D
    from quillspark.functions import text as T

    df = spark.createDataFrame([("Иванов И. П.",)], "t string")
    plan = lambda c: df.select(c.alias("c"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan(D.rendered(D.dated(D.find_date(F.col("t"))["text"], F.lit(False)))).count("regexp_extract(") <= 20
    assert plan(T.clean_signer(F.col("t"))).count("regexp_replace(") <= 10
