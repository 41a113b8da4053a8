"""Each operator against a brute-force version, or on odd rows and empty tables."""

import hashlib
import os
import re
import sys
import zlib

import duckdb
import numpy as np
import pytest
import regex
import xxhash
from pyspark.sql import functions as F

from quillspark.llm import components, decontaminate, langid, licenses, line_dedup, phrases, pieces, pii, registry, simhash, telephony, toxicity
from quillspark.llm.common import table


def groups(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        parent[find(a)] = find(b)
    return [find(i) for i in range(n)]


def bits_of(hashes):
    counts = np.unpackbits(np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=int)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        new = [i]
        for j, d in enumerate(b, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[-1] + 1))
        row = new
    return row[-1]


def test_components(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = groups(202, links)
    assert set(got) == {x for link in links for x in link}
    assert all((got[a] == got[b]) == (want[a] == want[b]) for a in got for b in got)
    assert components.components(spark.createDataFrame([(1, 1), (None, 2)], "a long, b long")) is None


def test_licenses(spark, sf, odd, none):
    mit = next(iter(licenses.TEXTS["MIT"]))
    rows = [(1, mit.replace("2020 Holder", "1999 Someone Else").upper()), (2, mit + " more"), (3, "x\nReleased under the MIT Licence\ny"), (4, None)]
    got = {(r.doc_id, r.unit_no): r.license_id for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(1, -1): "MIT", (2, -1): None, (3, -1): None, (3, 1): "MIT", (4, -1): None}
    assert licenses.scan(odd).count() == 12 and licenses.scan(none).count() == 0 and licenses.scan_licenses(odd).count() == 12
    db = duckdb.connect()
    db.sql(f"create view documents as select * from '{sf}/documents.parquet'")
    want = db.sql(licenses.scan_sql()).fetchall()
    assert sorted(map(tuple, licenses.scan(table(spark, sf, "documents")).collect()), key=str) == sorted(want, key=str)


def test_whole_licenses(spark):
    """Whole texts of long licenses, and copies whose copyright lines have no year or reserve all rights."""
    folder = "/usr/share/common-licenses/"
    files = {"Apache-2.0": "Apache-2.0", "GPL-3": "GPL-3.0-only", "GPL-2": "GPL-2.0-only", "LGPL-2.1": "LGPL-2.1-only", "MPL-2.0": "MPL-2.0"}
    rows = [(i, open(folder + f).read()) for i, f in enumerate(files) if os.path.exists(folder + f)]
    want = {i: name for i, name in enumerate(files.values()) if i in dict(rows)}
    bsd, mit = licenses.TEXTS["BSD-3-Clause"][0], licenses.TEXTS["MIT"][0]
    rows += [(10, bsd.replace("Copyright (c) 2020, Holder", "Copyright (c) 1998, Holder\nAll rights reserved.")), (11, mit.replace("(c) 2020 Holder", "(c) Holder")), (12, mit.replace("Copyright (c) 2020", "©"))]
    got = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: r.license_id for r in got.collect()} == want | {10: "BSD-3-Clause", 11: "MIT", 12: "MIT"}


def luhn(d):
    return sum(x if i % 2 == 0 else x * 2 - 9 * (x > 4) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0


def test_pii_brute_force(spark, odd, none):
    """The text Feistel and its inverse in plain Python give the same pseudonyms."""

    def stream(kind, i, part):
        return hashlib.sha256(f"{pii.KEY}|{kind}|{i}|{part}".encode()).hexdigest()

    def shift(part, s):
        out = ""
        for i, c in enumerate(part):
            by = int(s[(i % 32) * 2 : (i % 32) * 2 + 2], 16)
            low, n = (48, 10) if c.isdigit() else (65, 26) if c.isupper() else (97, 26) if c.islower() else (0, 0)
            out += chr((ord(c) - low + by) % n + low) if n else c
        return out

    def text(value, kind):
        a, b = value[: len(value) // 2], value[len(value) // 2 :]
        for i in range(pii.ROUNDS):
            a, b = (shift(a, stream(kind, i, b)), b) if i % 2 == 0 else (a, shift(b, stream(kind, i, a)))
        return a + b

    cards = ["4111111111111111", "4040549990366437"]
    rows = [(1, f"{cards[0]} and {cards[1]}, again {cards[0]}; 4111111111111112"), (2, f"x {cards[1]} 10.1.2.3 2024-02-29 31.02.2024 078-05-1120"), (3, "le.42@mail6.example.com DE89370400440532013000"), (4, None), (5, "")]
    got = {r.doc_id: r for r in pii.pseudonymise(spark.createDataFrame(rows, "doc_id long, text string"), pii.KEY).collect()}
    out = [m for i in (1, 2) for m in re.findall(r"\d{16}", got[i].text)]
    assert out[0] == out[2] and out[1] == out[4] and out[3] == "4111111111111112" and len(set(out)) == 3
    assert all(luhn(x) for x in out if x != out[3])
    assert [out[0][:15], out[1][:15]] == [text(c[:15], "card") for c in cards]
    assert got[1].n_found == 3 and got[2].n_found == 4 and "31.02.2024" in got[2].text
    assert re.search(r" \d{1,3}(\.\d{1,3}){3} \d{4}-\d\d-\d\d 31", got[2].text)
    assert got[3].text.startswith(text("le.42", "email") + "@mail6.example.com DE")
    iban = got[3].text.split()[1]
    assert int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1
    assert got[4].text is None and got[5].text == "" and got[5].n_found == 0
    assert pii.pseudonymise(odd, pii.KEY).count() == 12 and pii.pseudonymise(none, pii.KEY).count() == 0


def test_pii_kinds(spark):
    """Mixed separators are no date and no card; pseudonyms are valid, differ for different values, and keep the format."""
    texts = ["01.01/2020 02.09/2021 3/08.2021", "1@x.com a@x.com B@x.com"] + [f"+1 ({a}) {b}-0{c}" for a in (212, 415, 999) for b in (200, 555) for c in (100, 199)]
    texts += [f"{a}.555.0199" for a in range(200, 260)] + ["115-555-0199 415-155-0199"] + ["DE89 3704 0044 0532 0130 00", "DE89 3704 0044 0532 0130 01", "DE89370400440532013000"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in pii.pseudonymise(rows, "a key of the test").collect()}
    assert got[0].text == texts[0] and got[0].n_found == 0 and got[1].n_found == 3 and all(a != b for a, b in zip(texts[1].split(), got[1].text.split(), strict=True))
    phones = [got[i].text for i, t in enumerate(texts) if re.search(r"\) |\.555\.", t)]
    assert len(set(phones)) == len(phones) == 72 and all(re.fullmatch(r"\+1 \([2-9]\d\d\) [2-9]\d\d-\d{4}|[2-9]\d\d\.[2-9]\d\d\.\d{4}", p) for p in phones)
    refused, printed, wrong, whole = (got[len(texts) - i] for i in (4, 3, 2, 1))
    assert refused.n_found == wrong.n_found == 0 and wrong.text == texts[-2] and printed.text.replace(" ", "") == whole.text != texts[-1]
    assert re.fullmatch(r"DE\d\d( \d{4}){4} \d\d", printed.text) and int("".join(str(int(c, 36)) for c in whole.text[4:] + whole.text[:4])) % 97 == 1


def quick_distance(a, b):
    """Edit distance by bit vectors."""
    if not a or not b:
        return max(len(a), len(b))
    where, full, top = {}, (1 << len(a)) - 1, 1 << (len(a) - 1)
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    up, down, out = full, 0, len(a)
    for c in b:
        hit = where.get(c, 0)
        d = (((hit & up) + up) ^ up) | hit | down
        more, less = down | ~(d | up), up & d
        out += bool(more & top) - bool(less & top)
        more, less = more << 1 | 1, less << 1
        up, down = (less | ~(d | more)) & full, more & d & full
    return out


def test_line_dedup_brute_force(spark, sf):
    """Against all pairs of edit similarity 0.8: no line is in a wrong group, and of the pairs 0.9 at least are in one group."""
    assert [quick_distance(*p) for p in (("kitten", "sitting"), ("", "ab"), ("abc", "abc"))] == [distance("kitten", "sitting"), 2, 0]
    docs = table(spark, sf, "documents")
    got = {(r.doc_id, r.line_no): (r.group_doc, r.group_line, r.kept) for r in line_dedup.judge_lines(docs).collect()}
    seen = []
    for r in docs.collect():
        for i, line in enumerate(r.text.split("\n")):
            if n := regex.sub(r"[^\p{L}\p{N}]+", " ", line.lower()).strip(" "):
                seen.append((r.doc_id, i, n))
    lines = sorted({s[2] for s in seen}, key=len)
    letters = sorted({c for n in lines for c in n})
    counts = np.array([[n.count(c) for c in letters] for n in lines])
    links, sizes = [], np.array(list(map(len, lines)))
    for i in range(len(lines)):
        j = np.arange(i + 1, np.searchsorted(sizes, sizes[i] / line_dedup.SIMILARITY + 1e-9, side="right"))
        apart = counts[j] - counts[i]
        least = np.maximum(np.maximum(apart, 0).sum(1), np.maximum(-apart, 0).sum(1))  # edits for the letters alone
        most = np.floor((1 - line_dedup.SIMILARITY + 1e-12) * sizes[j])
        links += [(i, int(k)) for k, m in zip(j[least <= most], most[least <= most], strict=True) if quick_distance(lines[i], lines[k]) <= m]
    true = dict(zip(lines, groups(len(lines), links), strict=True))
    own, first = {}, {}
    for d, i, n in sorted(seen):
        group = got[(d, i)][:2]
        assert own.setdefault(n, group) == group and got[(d, i)][2] == (group == (d, i))
        assert first.setdefault(group, (d, i, true[n])) == (*group, true[n])  # the first of a group is kept, and all are linked by some chain
    assert got.keys() == {(d, i) for d, i, _ in seen}
    assert len(links) > 40 and sum(own[lines[a]] == own[lines[b]] for a, b in links) >= 0.9 * len(links)


@pytest.mark.parametrize("n", [1, 3, 4, 5, 8, 12, 20, 40, 80, 160])
def test_line_dedup_recall(spark, n):
    """Lines of n words and copies with one letter changed: each pair is in one group, and no two pairs are."""
    draw = np.random.default_rng(n)
    word = lambda: "".join(draw.choice(list("abcdefghijklmnopqrstuvwxyz"), draw.integers(5, 9)))
    rows = []
    for k in range(25):
        words = [word() for _ in range(n)]
        other = list(words)
        at = int(draw.integers(n))
        other[at] = other[at][:2] + "0" + other[at][3:]
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(other))]
    got = {r.doc_id: r.group_doc for r in line_dedup.judge_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: i - i % 2 for i in range(50)}


def test_line_dedup_large_bucket(spark):
    """Near copies of one line are one group; a chain of edits is one, too, though its ends are not similar."""
    base = [f"word{i}" for i in range(80)]
    rows = [(k, " ".join(base[:k] + [f"new{k}"] + base[k + 1 :])) for k in range(40)] + [(99, "quite another line of text\n\n--\nLes.")]
    rows += [(100 + k, " ".join([f"item{i}" if i >= 6 * k else f"other{i}" for i in range(60)])) for k in range(9)]
    got = line_dedup.judge_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.group_doc for r in got if r.doc_id != 99} == {i: 0 if i < 40 else 100 for i, _ in rows if i != 99}
    assert sorted(r.line_no for r in got if r.doc_id == 99) == [0, 3]


def test_line_dedup_odd(spark, odd, none):
    out = line_dedup.drop_repeated_lines(odd).collect()
    assert len(out) == 12 and out[0].asDict().keys() == odd.first().asDict().keys()
    by = {}
    for r in out:
        by.setdefault(r.doc_id, []).append(r.text)
    assert by[1] == [None] and by[2] == [""] and by[3] == ["   \n "] and by[4][0].startswith("one two") and sorted(by[5]) == ["", "", "other words " * 4]
    assert sorted(map(str, by[None])) == ["None", "one two three four five six seven eight nine ten " * 3]
    assert line_dedup.drop_repeated_lines(none).count() == 0


def test_decontamination(spark, sf, odd, none):
    bench = table(spark, sf, "benchmark")
    item = bench.orderBy("item_id").first()
    raw, half = item.text, item.text[:90]
    edited = half[:20] + "#" + half[21:50] + half[51:]
    rows = [(1, "before " + raw.upper().replace(" ", "  ") + " after"), (2, "x " + half), (3, "x " + edited + " y"), (4, raw[:30]), (5, None), (6, ""), (None, raw)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in decontaminate.contaminated(docs, bench).where(f"item_id = {item.item_id}").collect()}
    assert set(got) == {1, 2, 3, None} and got[1].least_edits == 0 and got[1].n_found == got[1].n_segments and 1 <= got[3].least_edits <= 2
    assert sorted(r.doc_id for r in decontaminate.keep_clean(docs, bench).collect()) == [4, 5, 6]
    assert decontaminate.keep_clean(odd, bench).count() == 12 and decontaminate.contaminated(none, bench).count() == 0
    empty = spark.createDataFrame([(1, None)], "item_id long, text string")
    assert decontaminate.contaminated(docs, empty).count() == 0 and decontaminate.keep_clean(docs, empty).count() == 7
    two = [decontaminate.contaminated(docs, bench).count(), sum(1 for _ in decontaminate.shares(bench, 2000))]
    assert two[1] > 1


def test_decontamination_brute_force():
    random = np.random.default_rng(5)
    letters = np.array(list("abcdef "))
    text = "".join(random.choice(letters, 1500))
    items = [(i, "".join(random.choice(letters, 100))) for i in range(4)]
    body = list(items[1][1][20:100])
    for at in (5, 30, 50):
        body[at] = "z"
    text = text[:400] + "".join(body) + text[400:]
    index = decontaminate.build(items)
    raw = np.frombuffer(text.encode(), np.uint8)
    data, offsets, _ = decontaminate.normal(raw, np.array([0, len(raw)]))
    _, segment, edits, _ = decontaminate.regions(index, data, offsets)
    got = {}
    for s, e in zip(segment.tolist(), edits.tolist(), strict=True):
        got[s] = min(e, got.get(s, 99))
    want = {}
    for s, p in enumerate(index.segments):
        row = [0] * (len(data) + 1)
        for i, c in enumerate(p, 1):
            new = [i]
            for j, d in enumerate(data.tolist(), 1):
                new.append(min(row[j - 1] + (c != d), row[j] + 1, new[-1] + 1))
            row = new
        if min(row) <= index.edits[s]:
            want[s] = min(row)
    assert got == want and want


def test_decontamination_of_short_items():
    """Items of 1 to 19 bytes as whole words, and a tenth of edits in segments of any size, against all alignments."""
    def found(items, text):
        index = decontaminate.build(list(enumerate(items)))
        raw = np.frombuffer(text.encode(), np.uint8)
        data, offsets, _ = decontaminate.normal(raw, np.array([0, len(raw)]))
        _, segment, edits, _ = decontaminate.regions(index, data, offsets)
        best = {}
        for s, e in zip(segment.tolist(), edits.tolist(), strict=True):
            best[int(index.item_of[s])] = min(e, best.get(int(index.item_of[s]), 99))
        return best

    items = ["x", "ab", "cat", "Four", "nineteen bytes here", "日本語", "", "dog  house"]
    assert found(items, "the CAT saw four, nineteen  bytes here! これは日本語です; a dog house x") == dict.fromkeys((0, 2, 3, 4, 5, 7), 0)
    assert found(items, "concat fours abc nineteen bytes hereby xx dog houses") == {} and found(["a"], "") == {}
    draw = np.random.default_rng(4)
    for m in (20, 21, 23, 24, 30, 31, 32, 47, 63):
        item = "".join(draw.choice(list("abcdefghij"), m))
        for edits in range(m // 10 + 2):
            body = list(item)
            for at in draw.choice(np.arange(1, m - 1), edits, replace=False):
                body[at] = "z"
            got = found([item], "qqq " + "".join(body) + " qqq")
            assert got == ({0: edits} if edits <= m // 10 else {}), (m, edits)


def test_simhash_brute_force(spark, sf, odd, none):
    def fingerprint(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        return bits_of([xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]) if words else 0

    docs = table(spark, sf, "documents").collect()
    prints = np.array([fingerprint(r.text) for r in docs], np.uint64)
    links = [(i, j) for i in range(len(docs)) for j in np.flatnonzero(np.bitwise_count(prints[i] ^ prints[i + 1 :]) <= 2) + i + 1]
    root = groups(len(docs), links)
    low = {}
    for r, g in zip(docs, root, strict=True):
        low[g] = min(r.doc_id, low.get(g, r.doc_id))
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.group(table(spark, sf, "documents")).collect()}
    assert got == {r.doc_id: (f"{int(p):016x}", low[g]) for r, p, g in zip(docs, prints, root, strict=True)}
    out = {(r.doc_id, r.fingerprint): r.component_id for r in simhash.group(odd).collect()}
    assert out[(1, "0" * 16)] == out[(2, "0" * 16)] == out[(3, "0" * 16)] == 1 and out[(None, "0" * 16)] is None
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["1", "4", "5", "6", "7", "8", "None", "None"]
    assert simhash.group(none).count() == 0 and simhash.keep_one(none).count() == 0


def test_simhash_tiles(spark):
    """Small tiles and a dense group: the same components as all pairs."""
    random = np.random.default_rng(1)
    center = int(random.integers(1 << 62))
    prints = {center} | {center ^ (1 << int(a)) ^ (1 << int(b)) for a, b in random.integers(0, 63, (300, 2))} | {int(x) for x in random.integers(1 << 62, size=300)}
    prints = sorted(prints)
    edges = simhash.links(spark.createDataFrame([(p,) for p in prints], "fp long"), tile=16)
    got = [(r.a, r.b) for r in edges.collect()]
    at = {p: i for i, p in enumerate(prints)}
    array = np.array(prints, np.uint64)
    want = groups(len(prints), [(i, j) for i in range(len(prints)) for j in np.flatnonzero(np.bitwise_count(array[i] ^ array[i + 1 :]) <= 2) + i + 1])
    have = groups(len(prints), [(at[a], at[b]) for a, b in got])
    assert len({*zip(want, have, strict=True)}) == len(set(want)) == len(set(have)) and len(got) < 3000


def test_toxicity(spark, sf, odd, none):
    docs, labels = table(spark, "/root/testdata/sf0.1", "documents"), table(spark, "/root/testdata/sf0.1", "labels")
    rows = toxicity.score_toxicity(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    good, bad = rows.score[rows.toxic == 0].to_numpy(), rows.score[rows.toxic == 1].to_numpy()
    assert ((bad[:, None] > good) + 0.5 * (bad[:, None] == good)).mean() > 0.9
    one = toxicity.score_toxicity(odd, labels)
    assert one.count() == 12 and one.where("score between 0 and 1 and held_out is not null and predicted = cast(score >= 0.5 as int)").count() == 12
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in one.where("doc_id is not null").collect())
    assert toxicity.score_toxicity(none, labels).count() == 0
    assert toxicity.score_toxicity(odd, labels.where("false")).where("score = 0 and predicted = 0").count() == 12


def test_ftrl_brute_force():
    """The updates of a plain loop over coordinates; features of one text are those that it has in a batch of texts."""
    draw, model = np.random.default_rng(8), toxicity.Ftrl(6, l1=0.5)
    z, n = [0.0] * 65, [0.0] * 65

    def weight(i):
        if abs(z[i]) <= model.l1:
            return 0.0
        return -(z[i] - (model.l1 if z[i] > 0 else -model.l1)) / ((model.beta + n[i] ** 0.5) / model.alpha + model.l2)

    for _ in range(300):
        at, label = np.unique(draw.integers(0, 64, 7)), int(draw.integers(2))
        model.learn(at, label)
        own = {int(i): weight(int(i)) for i in [*at, 64]}
        g = 1 / (1 + np.exp(-sum(own.values()))) - label
        for i, w in own.items():
            z[i] += g - ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / model.alpha * w
            n[i] += g * g
    assert np.allclose(model.z, z) and np.allclose(model.n, n) and np.allclose(model.weights(), [weight(i) for i in range(65)]) and (model.weights() == 0).any()
    raw = [t.encode() for t in ("One two  one THREE", "", "é! two", "one two one three")]
    data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])
    text, found = toxicity.features(data, offsets)
    each = [sorted(toxicity.features(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[1].tolist()) for t in raw]
    assert [sorted(found[text == i].tolist()) for i in range(4)] == each and list(map(len, each)) == [10, 0, 3, 10] and each[0] == each[3]


def test_telephony(spark, odd, none):
    got = telephony.store_as_audio(odd).collect()
    texts = odd.collect()
    assert len(got) == len(texts) and telephony.store_as_audio(none).count() == 0
    by = {}
    for r in got:
        by.setdefault((r.n_bytes, r.payload_sha256), set()).add((r.media_sha256, r.feature, r.tail_crc32))
        tag, rate, samples = telephony.read_wav(bytes(r.media))
        assert (tag, rate, len(samples)) == (telephony.MU_LAW, 8000, r.payload_bytes) and r.payload_bytes % 576 == 0
        assert hashlib.sha256(samples).hexdigest() == r.payload_sha256 and zlib.crc32(samples[-32:]) == r.tail_crc32 and len(r.media) == r.media_bytes
        assert telephony.read_wav(bytes(r.resampled))[1] == 16000
    assert all(len(v) == 1 for v in by.values())
    assert {hashlib.sha256(telephony.payload(r.text)).hexdigest() for r in texts} == {r.payload_sha256 for r in got}
    assert telephony.MU[[0, 127, 128, 255]].tolist() == [-32124, 0, 32124, 0] and telephony.A[[0x55, 0xD5, 0x2A, 0xAA]].tolist() == [-8, 8, -32256, 32256]


def test_adpcm_brute_force():
    blocks = np.random.default_rng(0).integers(0, 256, (20, 36)).astype(np.uint8)
    got = telephony.decode_adpcm(blocks)
    for b, out in zip(blocks.tolist(), got.tolist(), strict=True):
        value = int.from_bytes(bytes(b[:2]), "little", signed=True)
        index, want = min(b[2], 88), [value]
        for byte in b[4:]:
            for code in (byte & 15, byte >> 4):
                step = int(telephony.STEP[index])
                change = (step >> 3) + (step if code & 4 else 0) + (step >> 1 if code & 2 else 0) + (step >> 2 if code & 1 else 0)
                value = max(-32768, min(32767, value - change if code & 8 else value + change))
                index = max(0, min(88, index + int(telephony.INDEX[code])))
                want.append(value)
        assert out == want


@pytest.mark.parametrize("patterns,documents", [(3000, 2000), (40, 7)])
def test_phrases_brute_force(spark, sf, monkeypatch, patterns, documents):
    monkeypatch.setattr(phrases, "PATTERNS", patterns)
    monkeypatch.setattr(phrases, "DOCUMENTS", documents)
    docs = table(spark, sf, "documents")
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in phrases.remove_repeats(docs, False).collect()}
    seen, want = set(), {}
    for r in docs.orderBy("doc_id").collect():
        words = r.text.encode().split()
        keep = [True] * len(words)
        for i in range(len(words) - 19):
            window = tuple(words[i : i + 20])
            if window in seen:
                keep[i : i + 20] = [False] * 20
            seen.add(window)
        kept = [w for w, k in zip(words, keep, strict=True) if k]
        want[r.doc_id] = (len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest())
    assert got == want


def test_phrases_odd(spark, odd, none):
    got = phrases.remove_repeats(odd).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append((r.n_words, r.n_removed))
    assert by[1] == [(0, 0)] and by[2] == [(0, 0)] and by[4] == [(30, 20)] and sorted(by[5]) == [(8, 0), (30, 30), (30, 30)]
    assert sorted(by[None]) == [(0, 0), (30, 30)] and by[8] == [(3000, 2980 + 19)] and phrases.remove_repeats(none).count() == 0


def test_pieces(spark, sf, odd, none):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    vocabulary = pieces.Vocabulary()
    plain, dropped = pieces.Encoder(vocabulary, 0, 0), pieces.Encoder(vocabulary, 0.1, 5)
    texts = [r.text for r in table(spark, sf, "documents").collect()] + ["  a  b ", "日本語\n\n", "   ", "é" * 50]
    varied = 0
    for t in texts:
        assert model.encode(t) == pieces.encode_text(plain, t).tolist()
        ids = pieces.encode_text(dropped, t, 3)
        assert pieces.decode_ids(dropped, ids) == t
        varied += ids.tolist() != model.encode(t)
    assert varied > 0.9 * len(texts) - 5
    for unit in {u for t in texts[:5] for u in re.findall(r" *[^ ]+", " " + t)}:
        for v in range(pieces.VARIANTS):
            dropped.forget()
            dropped.learn([unit], np.array([v]))
            assert dropped.pool.tolist() == pieces.segment(vocabulary, unit, 0.1, 5, v)
    out = pieces.encode(odd)
    assert out.count() == 12 and out.where("lossless and n_tokens = size(ids)").count() == 12 and out.where("n_tokens = 0").count() == 3
    assert pieces.encode(none).count() == 0


def test_pieces_draw_per_occurrence():
    """Every occurrence of a word is segmented by its own draw, and over many occurrences every merge is skipped somewhere."""
    vocabulary = pieces.Vocabulary()
    encoder, unit = pieces.Encoder(vocabulary, 0.1, 5), " international"
    skips = {}
    for doc in range(6):
        draws = [pieces.scramble((i * pieces.BASE + pieces.scramble((doc ^ 5) & pieces.M64)) & pieces.M64) for i in range(200)]
        assert pieces.encode_text(encoder, (unit * 200)[1:], doc).tolist() == [x for d in draws for x in pieces.segment(vocabulary, unit, 0.1, 5, d)]
        for d in draws:
            pieces.segment(vocabulary, unit, 0.1, 5, d, trace := [])
            for code, skipped in trace:
                skips.setdefault(code, []).append(skipped)
    common = [np.mean(s) for s in skips.values() if len(s) > 400]
    assert len(common) > 3 and all(0.05 < m < 0.16 for m in common)
    assert len({tuple(pieces.segment(vocabulary, unit, 0.1, 5, d)) for d in draws}) > pieces.VARIANTS


def test_language(spark, odd, none):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (rows.lang_pred == rows.lang).mean() > 0.97
    out = {r.doc_id: r for r in langid.identify(odd).collect()}
    assert out[1].lang_pred == out[2].lang_pred == out[3].lang_pred == "und" and out[1].score == 0 and out[4].lang_pred in ("en", "und")
    assert langid.identify(none).count() == 0 and langid.keep_identified(none).count() == 0 and langid.keep_identified(odd).columns == odd.columns
    assert langid.identify(odd.where("false").unionByName(odd).drop("lang").selectExpr("*", "cast(null as string) lang")).where("lang_pred = 'und'").count() == 12


def test_language_of_long_runs(spark):
    """A run of letters without spaces is read to its end, not judged by its beginning."""
    model = langid.train([("aa", "abba baab aba bab"), ("zz", "xyzz zyxx zxy yzx")] * 20)
    texts = ["abba" * 40 + "xyzz" * 400, "xyzz" * 40 + "abba" * 400, "abba" * 40]
    frame = langid._identified(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model)
    got = {r.doc_id: (r.lang_pred, r.score, r.n_words) for r in frame.collect()}
    assert [got[i][0] for i in range(3)] == ["zz", "aa", "aa"] and [got[i][2] for i in range(3)] == [28, 28, 3]
    assert abs(got[0][1] - 10 / 11) < 0.05 and abs(got[1][1] - 10 / 11) < 0.05


def test_mixed_languages_stay(spark):
    """The pipeline's first stage keeps a document in three languages in like parts; only what is `und` goes."""
    import corpus_pipeline

    docs = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text", "lang")
    by = {}
    for r in docs.where("lang is not null").orderBy("doc_id").limit(400).collect():
        by.setdefault(r.lang, []).extend(r.text.split()[:40])
    parts = [" ".join(words[:120]) for _, words in sorted(by.items())][:3]
    mixed = spark.createDataFrame([(-1, "\n".join(parts), None), (-2, "1234 ..", None), (-3, None, None)], docs.schema)
    assert len(parts) == 3
    score = {r.doc_id: r.score for r in langid.identify(docs.unionByName(mixed)).where("doc_id < 0").collect()}
    assert 0 < score[-1] < 0.5 and score[-2] == score[-3] == 0
    assert [r.doc_id for r in corpus_pipeline.language_id(spark, docs.unionByName(mixed), "").where("doc_id < 0").collect()] == [-1]


def test_forward_backward_brute_force():
    from itertools import product

    random = np.random.default_rng(3)
    emission, step = random.normal(size=(2, 4, 3)), random.normal(size=(3, 3))
    lengths = np.array([4, 3])
    both, moved = langid.forward_backward(emission, lengths, step)
    total = np.zeros((3, 3))
    for c, n in enumerate(lengths):
        ways = {w: np.exp(sum(emission[c, t, x] for t, x in enumerate(w)) + sum(step[a, b] for a, b in zip(w, w[1:], strict=False))) for w in product(range(3), repeat=int(n))}
        z = sum(ways.values())
        for t in range(n):
            for k in range(3):
                assert abs(sum(p for w, p in ways.items() if w[t] == k) / z - both[c, t, k]) < 1e-9
        for w, p in ways.items():
            for a, b in zip(w, w[1:], strict=False):
                total[a, b] += p / z
    assert np.allclose(total, moved)


def test_pipeline(spark, sf):
    import corpus_pipeline

    docs = table(spark, sf, "documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.count()
        docs = stage(spark, docs, sf)
        if n + 1 < len(names):
            assert docs.columns == table(spark, sf, "documents").columns
            docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert docs.count() <= before
    assert docs.where("lossless").count() == docs.count() > 100
    a, b = ({(r.doc_id, r.ids_sha256) for r in d.collect()} for d in (docs, corpus_pipeline.run(spark, sf)))
    assert a == b and len(names) == 5


def test_stages_on_odd_rows(spark, sf, odd, none):
    """Null, repeated, empty and long rows, clashing columns and an empty table: no stage fails, columns stay, and null ids or texts too where said."""
    import corpus_pipeline

    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd, sf)
        assert out.columns == odd.columns and stage(spark, none, sf).count() == 0, name
        got = sorted((str(r.doc_id), str(r.text)[:9]) for r in out.collect())
        if name == "language ID":
            assert ("1", "None") not in got and ("2", "") not in got  # no letter
        else:
            assert ("None", "None") in got
        if name in ("line dedup", "benchmark decontamination"):
            assert len(got) == 12
    assert corpus_pipeline.tokens(spark, odd, sf).where("lossless").count() == 12


def test_registered():
    assert [n.split("_")[0] for n in registry.queries()] == [f"op{i}" for i in range(1, 11)] and sys.modules["quillspark.llm"]


def test_line_similarity_brute_force(spark):
    """Whether two lines need at most a fifth of their length in edits, short and long, near the bound and far from it."""
    draw, rows = np.random.default_rng(1), []
    for n in (1, 4, 30, 200, 513, 900):
        for rate in (0, 0.02, 0.17, 0.2, 0.23, 0.5):
            a = "".join(draw.choice(list("abcdé "), n))
            b = "".join(c if draw.random() > rate else ("", "x", c + "y")[draw.integers(3)] for c in a)
            rows.append((a, b, bool(distance(a, b) <= int(0.2 * max(len(a), len(b)) + 1e-9))))
    pairs = spark.createDataFrame(rows, "a string, b string, want boolean")
    pairs = pairs.select("want", line_dedup.similar(pairs.a, pairs.b).alias("got"))
    assert pairs.where("got <> want or got is null").count() == 0 and {r.want for r in pairs.collect()} == {True, False}


@pytest.mark.parametrize("strong", [1.0, 6.0])
def test_language_id_whole_text_is_one_chain(strong):
    """Marginals of texts of up to 1,000 words, joined from pieces, equal those of one long chain each."""
    random = np.random.default_rng(3)
    langs = ["a", "b", "c", "d"]
    model = langid.Model(langs)
    model.step = random.normal(0, 2, (4, 4)) + 3 * np.eye(4)
    words = ["".join(w) for w in random.choice(list("abcdefghij"), (400, 4))]
    model.weights = random.normal(0, strong / 4, model.weights.shape).astype(np.float32)
    sizes = [1000, 1, langid.CHAIN, 2 * langid.CHAIN, 2 * langid.CHAIN + 1, 300, 0, 5, langid.CHAIN + 1]
    texts = [[words[i] for i in random.integers(0, len(words), n)] for n in sizes]
    text, _, got = langid.Tagger(model).marginals(texts)
    for i, ws in enumerate(texts):
        if ws:
            alone = np.stack([model.emission(w) for w in ws])[None].astype(float)
            want, _ = langid.forward_backward(alone, np.array([len(ws)]), model.step)
            assert np.allclose(got[text == i], want[0], atol=1e-8)


def test_line_dedup_spread_edits(spark):
    """Letters changed anywhere in a line (not in one word): what is found of 4 % is far from all, and no two pairs are one group."""
    draw = np.random.default_rng(8)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    rows = []
    for i in range(160):
        line = list(" ".join("".join(draw.choice(letters, draw.integers(4, 10))) for _ in range((6, 12, 25, 50)[i % 4])))
        rows.append((2 * i, "".join(line)))
        spots = [k for k, c in enumerate(line) if c != " "]
        for k in draw.choice(spots, max(1, len(line) // 25), replace=False):
            line[k] = draw.choice(letters)
        rows.append((2 * i + 1, "".join(line)))
    got = {r.doc_id: r.group_doc for r in line_dedup.judge_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(g in (i, i - i % 2) for i, g in got.items())
    assert sum(got[2 * i + 1] == 2 * i for i in range(160)) >= 0.6 * 160


def test_bounds_of_edits_hold(spark):
    import random

    from quillspark.llm import line_dedup

    draw = random.Random(5)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(draw.randint(3, 8)))
    rows = []
    for n in (3, 12, 40, 120):
        for changed in (0.0, 0.05, 0.2, 0.4, 1.0):
            a = [word() for _ in range(n)]
            rows.append((" ".join(a), " ".join(word() if draw.random() < changed else w for w in a)))
    pairs = spark.createDataFrame(rows, "a string, b string").withColumn("d", F.levenshtein("a", "b"))
    for wide in (True, False):
        told = pairs.withColumn("m", line_dedup.measured(F.col("a"), F.col("b"), F.lit(wide)))
        assert told.where("m.low > d or m.high < d").isEmpty()
    far = pairs.where("d > 0.4 * greatest(length(a), length(b)) + 1 and abs(length(a) - length(b)) <= floor(0.2 * greatest(length(a), length(b)))").withColumn("m", line_dedup.measured(F.col("a"), F.col("b"), F.lit(True)))
    assert far.count() and far.where("m.low <= 2 * floor(0.2 * greatest(length(a), length(b)))").isEmpty()


def test_line_far_from_a_group_does_not_meet_each_of_its_copies(spark, monkeypatch):
    from quillspark.llm import line_dedup

    rare = ["quellenwerk", "sonnenuhren", "werkstoffe", "nachtfalter"]
    order = lambda words: sorted(words, key=lambda w: spark.range(1).select(F.xxhash64(F.lit(w)).bitwiseAND(F.lit(line_dedup.LAST - 1))).first()[0])
    pool = order([f"wort{i:03d}x" for i in range(300)] + rare)
    low, rest = pool[:4], pool[4:]  # all lines have the words of the smallest hashes, so they meet in a bucket
    base = low + rest[:60]
    group = [" ".join(base[: 4 + i] + [rest[100 + i]] + base[5 + i :]) for i in range(40)]
    other = " ".join(rest[150:210] + low)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*group, " ".join(base), other])], "doc_id bigint, text string")
    met, plain = [], line_dedup.verified
    monkeypatch.setattr(line_dedup, "verified", lambda pairs, *more: met.append(pairs.count()) or plain(pairs, *more))
    kept = line_dedup.judge_lines(docs).where("kept").count()
    assert kept == 2 and sum(met) <= 45  # each with the leader; before, the other line met all copies, too


def test_line_dedup_meets_in_rounds(spark, monkeypatch):
    """Strays that are alike do not all meet: lines that one of them has linked are connected already."""
    from quillspark.llm import line_dedup

    shared = "keyword lighthouse mountain waterfall"
    few = lambda letters, n: [f"{a}{b}" for a in letters for b in "abcdefghij"][:n]
    leader = " ".join([shared, *few("stuvwx", 60)])
    rows = [(i, leader) for i in range(3)]
    for i in range(100):
        words = few("klmnopq", 60)
        words[i % 60] = f"{'yz'[i // 60]}{i % 10}"
        rows.append((10 + i, " ".join([shared, *words])))
    met, plain = [], line_dedup.verified
    monkeypatch.setattr(line_dedup, "verified", lambda pairs, *more: met.append(pairs.count()) or plain(pairs, *more))
    got = {r.doc_id: r.group_doc for r in line_dedup.judge_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: 0 if i < 10 else 10 for i, _ in rows}
    assert met[0] == 100 and sum(met[1:]) < 1500, met


def test_line_dedup_strays_meet_once(spark):
    """Lines that share several keys are one compared pair, not one for each key; none is lost."""
    kind = "key bigint, h bigint, size int, c bigint, stray boolean, low int, high int, turn int, keys array<bigint>"
    lines = {1: [10, 11, 12, 13], 2: [10, 11, 12, 13], 3: [11, 13], 4: [13], 5: [12, 10]}
    rows = [(key, h, 40, 1 if h == 5 else h, h not in (1, 5), 0, 40, 2, keys) for h, keys in lines.items() for key in keys]
    got = sorted((r.h_a, r.h_b, r.c_a, r.c_b) for r in line_dedup._met(2, spark.createDataFrame(rows, kind)).collect())
    want = [(a, b) for a in lines for b in lines if a < b and set(lines[a]) & set(lines[b]) and (a, b) != (1, 5)]
    assert got == [(a, b, 1 if a == 5 else a, 1 if b == 5 else b) for a, b in want]
    assert not line_dedup._met(1, spark.createDataFrame(rows, kind)).count()


def test_pieces_memory():
    """What an encoder takes for 40000 different words of 11 letters: 62 MB at most before nodes were made smaller, 49 after."""
    import tracemalloc

    encoder, random = pieces.Encoder(pieces.Vocabulary(), 0.1, 1, pieces.SMALL), np.random.default_rng(3)
    data = np.frombuffer((" " + " ".join("".join(w) for w in random.choice(list("abcdeiknorst"), (40_000, 11)))).encode(), np.uint8)
    tracemalloc.start()
    try:
        ids, at = encoder.encode(data, np.array([0, len(data)]), [1])
        assert tracemalloc.get_traced_memory()[1] < 55e6 and encoder.code.room.itemsize + 2 * encoder.next.room.itemsize == 16
    finally:
        tracemalloc.stop()
    assert encoder.decode(ids).tobytes() == data.tobytes() and at.tolist() == [0, len(ids)]
