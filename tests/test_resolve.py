"""Senders to ids: against a plain loop over all pairs, and the cases of capitals, the unknown sender, short and turned names."""

import random
import re

from pyspark.sql import functions as F

from quillspark.functions import similarity as S
from quillspark.functions import text as T
from quillspark.operators import resolve

PARTNER = "partner_id string, partner_name string, partner_full_name string"


def score(sender, name):
    if name is None:
        return 0
    a, b = (re.sub("[#_\"']", "", t) for t in (sender, name.lower()))
    whole = S.token_sort(a, b)
    return whole if whole >= 95 else part if (part := S.partial(a, b)) >= 90 else 0


def plain(sender, partners):
    if sender == "не определён":
        return []
    if equal := {i for i, *names in partners if sender in names}:
        return sorted(equal)
    scores = {i: max(score(sender, n) for n in names) for i, *names in partners}
    top = max(scores.values())
    return sorted(i for i, s in scores.items() if s == top >= 90)


def test_against_all_pairs(spark):
    for letters, seed in (("абвг", 1), ("абвгдежзиклмнопрст", 2)):
        r = random.Random(seed)
        word = lambda: "".join(r.choice(letters) for _ in range(r.randint(1, 8)))  # noqa: B023, E731
        name = lambda: " ".join(word() for _ in range(r.randint(1, 4)))  # noqa: B023, E731

        def edited(t):
            t = list(t)
            for _ in range(r.randint(0, 3)):  # noqa: B023
                i = r.randrange(len(t) + 1)  # noqa: B023
                t[i : i + r.randint(0, 1)] = r.choice(["", r.choice(letters)])  # noqa: B023
            return "".join(t)

        names = [name() for _ in range(100)]
        partners = [(str(i), n, None if r.random() < 0.5 else name()) for i, n in enumerate(names)]
        senders = [edited(r.choice(names)) for _ in range(100)] + [" ".join(reversed(r.choice(names).split())) for _ in range(20)] + [f"{name()} {r.choice(names)} {name()}" for _ in range(20)]
        got = {x.sender: x.ids for x in resolve.resolve_sender(spark.createDataFrame([(s,) for s in senders], "sender string"), spark.createDataFrame(partners, PARTNER)).collect()}
        want = {s: plain(s, partners) for s in senders}
        assert got == want and sum(map(bool, want.values())) > 60


def test_cases(spark):
    partners = [("1", "не определён отдел", None), ("2", "ООО Ромашка", None), ("3", "аб", None), ("4", "а б в г", None), ("5", "б", "полное имя"), ("6", "#_", None)]
    asked = ["ооо ромашка", "ООО РОМАШКА", "ООО Ромашка", "не определён", "аб в", "г в б а", "полное имя", "письмо полное имя от", None, "", "ромашка ооо"]
    got = {x.sender: x.ids for x in resolve.resolve_sender(spark.createDataFrame([(s,) for s in asked], "sender string"), spark.createDataFrame(partners, PARTNER)).collect()}
    assert got.pop("") in ([], ["6"]) and None not in got
    assert got == {"ооо ромашка": ["2"], "ООО РОМАШКА": [], "ООО Ромашка": ["2"], "не определён": [], "аб в": plain("аб в", partners), "г в б а": plain("г в б а", partners), "полное имя": ["5"], "письмо полное имя от": ["5"], "ромашка ооо": ["2"]}
    assert "3" in got["аб в"] and "4" in got["г в б а"]
    none = spark.createDataFrame([], PARTNER)
    assert all(x.ids == [] for x in resolve.resolve_sender(spark.createDataFrame([("x",)], "sender string"), none).collect())


def test_jaro_rows(spark):
    rows = spark.createDataFrame([(1, "MARTHA"), (2, "MARHTA"), (3, "MARHTA"), (4, None), (5, "other")], "id long, name string")
    got = resolve.jaro_best_rows(rows.where("id = 1").select("name"), "name", rows, "name").collect()
    assert sorted((x.id, round(x.sim, 4)) for x in got) == [(2, round(S.jaro_winkler("MARTHA", "MARHTA", 0.2), 4)), (3, round(S.jaro_winkler("MARTHA", "MARHTA", 0.2), 4))]


def test_glued_names(spark):
    f = lambda t, first=True: spark.createDataFrame([(t,)], "t string").select(T.format_fullname(F.col("t"), first)).first()[0]
    assert f("ИвановИ. И.") == "И.И. Иванов" and f("подписалИ.И. Иванов", False) == "Иванов И.И." and f("однаДругая") == "одна Другая" and f("А.Б. Семёнова", False) == "Семёнова А.Б."


def test_equal_questions_about_signers_are_answered_once(spark, monkeypatch):
    """Null names and lists are questions, too; every query has its answer."""
    from quillspark.operators import resolve

    seen = []
    monkeypatch.setattr(resolve, "kept", lambda df, real=resolve.kept: seen.append(real(df)) or seen[-1])
    staff = spark.createDataFrame([("p", f"e{i}", "Орлов", "АБ"[i % 2], "ВГ"[i // 2 % 2]) for i in range(6)] + [("q", "f", "орлов", None, None)], "partner_id string, employee_id string, last_name string, first_name string, middle_name string")
    kinds = [(["p"], "Орлов", "А", "В"), (["p"], "орлов", "Б", None), (["p", "q"], "Орлов", "Ю", "В"), (["q"], "Иной", "А", "В"), (None, "Орлов", "А", "В"), (["p"], None, None, None)]
    asked = spark.createDataFrame([(i, *kinds[i % 6]) for i in range(60)], "query_id long, partner_ids array<string>, last string, first string, middle string")
    got = {r.query_id: r.ids for r in resolve.resolve_signer(asked, staff).collect()}
    want = [["e0", "e4"], ["e1", "e3", "e5"], ["e0", "e1", "e2", "e3", "e4", "e5", "f"], [], [], []]
    assert got == {i: want[i % 6] for i in range(60)}
    assert seen[0].count() == 6
