import hashlib
import ipaddress
import random
import re
import time
import zlib
from collections import Counter
from datetime import date, datetime

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pairloom.llm import chat, decontaminate, lines, media, mixing, neardup, pii, quality, queries, secrets, sql, urls
from tests.conftest import SF, same_rows

DOCS = "doc_id long, text string, lang string, source string, n_chars long, line string, row string, `first` int"
rng = random.Random(5)
WORDS = ["".join(rng.choices("abcdefghijklmnop", k=6)) for _ in range(4000)]


def prose(n):
    return " ".join(rng.choices(WORDS, k=n))


@pytest.fixture(scope="module")
def hard(spark):
    """Nulls in every column, empty and very long texts, repeated rows, extra columns with clashing names."""
    long = prose(30_000)
    base = [(1, long), (1, long), (2, None), (3, ""), (None, "a b c"), (None, None), (4, "!!! ???"), (5, "one two three"), (6, "x\n\n\ny"), (7, "é" * 50_000)]
    return spark.createDataFrame([(i, t, None, None if i == 2 else "s", None, "x", None, 1) for i, t in base], DOCS).cache()


@pytest.mark.parametrize("name", sorted(sql.ORACLES))
def test_query_matches_sql(spark, duck, name):
    same_rows(queries.queries()[name](spark, SF), duck, sql.ORACLES[name])


def test_hard_rows_and_empty_tables(spark, hard):
    items = spark.createDataFrame([(1, None), (None, ""), (2, "one two"), (3, "u v w x y z")], "item_id long, text string")
    labels = spark.createDataFrame([(1, 1), (5, 0), (None, 1), (6, None)], "doc_id long, quality int")
    model = quality.train(hard, labels)
    for docs in (hard, hard.limit(0)):
        n = docs.count()
        assert secrets.find_secrets(docs).count() == n
        assert decontaminate.contained_items(docs, items).count() == 0
        assert decontaminate.clean_documents(docs, items).columns == docs.columns
        assert lines.drop_recurring_lines(docs).count() == n
        assert pii.pseudonymise_documents(docs, b"k").count() == n
        assert media.media_columns(docs).count() == n
        assert neardup.near_duplicates(docs).count() == n
        assert neardup.drop_near_duplicates(docs).columns == docs.columns
        assert quality.score(docs, model).where("score between 0 and 1").count() == n
        assert mixing.mix(docs).where("n_tokens <= 0").count() == 0
    pages = spark.createDataFrame([(1, None, None), (1, "no scheme", "x"), (None, "HTTP://A.com", "")], "page_id long, url string, html string")
    assert [r.verdict for r in urls.judge_urls(pages).collect()] == ["allow"] * 3
    assert urls.judge_urls(pages.limit(0)).count() == 0
    turns = spark.createDataFrame([(None, None, None, None), (1, 0, "user", "hi"), (1, 0, "user", "hi"), (2, 0, "user", "hi"), (2, 1, None, None)], "conv_id long, turn long, role string, text string")
    assert {(r.conv_id, r.n_turns) for r in chat.collapse_snapshots(turns).collect()} == {(None, 1), (2, 2)}
    assert chat.collapse_snapshots(turns.limit(0)).count() == 0


def test_trigram_queries():
    assert secrets.trigram_query("abcd") == ("and", "abc", "bcd")
    assert secrets.trigram_query("(abc|xyz)+q") == ("or", "abc", "xyz")
    assert secrets.trigram_query("[0-9a-f]{24,}") is True
    for r in secrets.RULES[:2] + secrets.RULES[3:]:
        assert secrets.trigram_query(r.pattern) is not True


def test_spans_by_brute_force(spark):
    key = "0123456789abcdef0123456789abcdef"
    texts = ["é😀 API_key = '" + key + "' x", "secret=token: abcdefg", "password:abc token=abcdef AKIA" + "A" * 20, "ghp_" + "a1" * 20 + " AKIAshort", None]
    found = secrets.find_secrets(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).select("doc_id", secrets.span_list(F.col("spans")).alias("s")).collect()
    for r in found:
        spans = [(m.start(), i, x.kind, m.end()) for i, x in enumerate(secrets.RULES) for m in re.finditer(x.pattern, texts[r.doc_id] or "") if len(m[x.group]) >= x.least]
        assert r.s == ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(spans))


def test_pseudonyms_keep_format_and_links():
    key = pii.Key(b"k")
    seen = set()
    for i in range(500):
        body = f"4{i:014d}"
        card = body + pii.luhn_digit(body)
        new = pii._card(card, key)
        assert len(new) == 16 and pii.luhn_digit(new[:-1]) == new[-1]
        seen.add(new)
    assert len(seen) == 500
    assert sorted(pii.permute(i, 1000, key, "t") for i in range(1000)) == list(range(1000))
    text = "Mail änn.12@mail.example.com, card 4539 1488 0343 6467, 4539148803436467, ip 10.0.0.255, on 2024-02-29 or 29.02.2024, call +1 (017) 555-7713; id 123-45-6789, bad 1234567890123456, 999.1.1.1, 2023-02-30"
    out, kinds = pii.pseudonymise(text, key)
    assert kinds == ["mail", "card", "card", "address", "date", "date", "phone", "id"]
    assert "@mail.example.com" in out and "+1 (" in out and out.endswith("bad 1234567890123456, 999.1.1.1, 2023-02-30")
    cards = re.search(r"card ([\d ]+), (\d+)", out)
    assert cards[1].replace(" ", "") == cards[2] != "4539148803436467"
    days = re.search(r"on (\S+) or (\S+),", out)
    d, m, y = days[2].split(".")
    assert days[1] == f"{y}-{m}-{d}" and date.fromisoformat(days[1])
    assert pii.pseudonymise(text, pii.Key(b"other"))[0] != out


def test_cards_and_accounts_next_to_figures_and_capitals():
    card, iban = "4539 1488 0343 6467", "ES91 2100 0418 4502 0005 1332"
    key = pii.Key(b"k")
    new_card, new_iban = pii._card(card, key), pii._account(iban, key)
    hyphens = card.replace(" ", "-")
    for text in (
        "{c} 12/27", "{c} 127", "{c} 1234", "12 {c}", "12 27 {c} 127 x", "0170 1234 {c}", "12-{h}", "{h}-127", "AB12 {c}", "{i} EUR", "{i} PAID NOW", "AB12 {i}", "{i} {c}", "{c} {c} 12/27", "{c}, {i}."
    ):
        out, kinds = pii.pseudonymise(text.format(c=card, h=hyphens, i=iban), key)
        assert out == text.format(c=new_card, h=new_card.replace(" ", "-"), i=new_iban), text
        assert len(kinds) == text.count("{")
    for text in ("1234 5678 9012 3456 7", "11 12 13 14 15 16 17 18 19 20 21", "ES91 2100 0418 4502 0005 1333 EUR"):
        assert pii.pseudonymise(text, key) == (text, [])


def test_classifier_on_held_out_rows(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    scored = quality.score(docs.select("doc_id", "text"), quality.train(docs, labels)).join(labels, "doc_id").where("crc32(cast(doc_id as string)) % 5 = 0")
    assert scored.selectExpr("avg(cast((score >= 0.3) = (quality = 1) as int))").first()[0] > 0.95


def test_signature_estimates_weighted_jaccard():
    keys = np.arange(1, 401, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    g = np.random.default_rng(1)
    a, b = g.integers(0, 9, 400), g.integers(0, 9, 400)
    truth = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    same = []
    for i in range(12):
        k = keys + np.uint64(i * 1_000_003)
        same.append((neardup.bag_minhash(k[a > 0], a[a > 0]) == neardup.bag_minhash(k[b > 0], b[b > 0])).mean())
    assert abs(np.mean(same) - truth) < 0.03


def test_near_copies_and_a_large_group(spark):
    base = prose(200).split()
    rows = [(i, " ".join(base)) for i in range(20)]
    for i in range(20, 80):
        w = list(base)
        w[rng.randrange(200)] = f"new{i}"
        rows.append((i, " ".join(w)))
    rows += [(i, prose(120)) for i in range(80, 120)]
    found = {r.doc_id: r.class_id for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(found[i] == 0 for i in range(80)) and all(found[i] == i for i in range(80, 120))


def test_classes_of_a_family_in_many_blocks_equal_brute_force(spark, monkeypatch):
    """Copies with 0 to 14 changed words: some link to the rest, some to a few, many to none; blocks of eight texts."""
    monkeypatch.setattr(neardup, "BLOCK", 4096)
    base, rows = prose(150).split(), []
    for i in range(90):
        w = list(base)
        for _ in range(i % 15):
            w[rng.randrange(150)] = rng.choice(WORDS[:40])
        rows.append((i, " ".join(w)))
    bags = [Counter(tuple(t.split()[k : k + 5]) for k in range(146)) for _, t in rows]
    common = {(i, j): (bags[i] & bags[j]).total() for i in range(90) for j in range(i)}
    links = [p for p, n in common.items() if n >= 0.8 * (292 - n) - 1e-9]
    least = list(range(90))
    for _ in range(90):
        for i, j in links:
            least[i] = least[j] = min(least[i], least[j])
    found = {r.doc_id: r.class_id for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [found[i] for i in range(90)] == least and 5 < len(set(least)) < 80


def test_media_round_trip(spark):
    texts = ["", "é" * 77, prose(3000), prose(3000)]
    texts[3] = texts[2]
    got = media.media_columns(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    for r in got:
        raw = texts[r.doc_id].encode()
        payload = raw + bytes(max(64, -(-len(raw) // 64) * 64) - len(raw))
        assert media.decode(bytes(r.media)) == payload and r.payload_sha256 == hashlib.sha256(payload).hexdigest()
        assert r.tail_crc32 == zlib.crc32(payload[-64:]) and list(r.times) == sorted(r.times)
    assert got[2].hashes == got[3].hashes and len(got[2].hashes) > 20


def test_aliases_share_a_block(spark):
    link = '<link rel="canonical" href="{}">'
    rows = [(1, "http://a.org/1", link.format("http://b.net/fr/2")), (2, "http://b.net/fr/2", ""), (3, "http://c.org/#x", '<meta http-equiv="refresh" content="0;url=http://a.org/1">'), (4, "http://d.org/", ""), (5, "http://e.org/", link.format("http://f.com/ok")), (6, "http://f.com/ok", link.format("http://b.net/es/"))]
    found = {r.page_id: r.verdict for r in urls.judge_urls(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found == {1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "allow"}


def test_line_templates(spark):
    rows = [(i, f"{prose(8)}\nserver node alpha failed job {rng.choice(WORDS)} after long wait today\nPage {i} of 9 here") for i in range(9)]
    out = lines.drop_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string")).orderBy("doc_id").collect()
    assert out[0].n_dropped == 0 and all(r.n_dropped == 2 and r.text == rows[r.doc_id][1].split("\n")[0] for r in out[1:])


def test_a_long_line_of_two_texts(spark):
    passage = prose(60)
    rows = [(1, f"{prose(30)}\n{passage}"), (2, f"{passage}\n{prose(40)}"), (3, prose(60)), (4, f"{prose(9)}\nx y"), (4, f"{prose(9)}\nx y")]
    out = lines.drop_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r.n_dropped for r in out] == [0, 1, 0, 0, 0]
    assert out[0].text == rows[0][1] and out[1].text == rows[1][1].split("\n")[1]


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ids, sizes = {r.doc_id for r in docs.collect()}, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == list(corpus_pipeline.COLUMNS), name
        sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0.5 * sizes[0]
    assert decontaminate.contained_items(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).count() == 0
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert mixed and {r.doc_id for r in mixed} <= ids


def brute_classes(texts):
    """The least place of each text's class, by comparing all pairs."""
    split = [re.findall(r"[^\W_]+", (t or "").lower()) for t in texts]
    bags = [Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter({(): 1}) for w in split]
    least = list(range(len(texts)))
    links = [(i, j) for i in range(len(texts)) for j in range(i) if (n := (bags[i] & bags[j]).total()) >= 0.8 * (bags[i].total() + bags[j].total() - n) - 1e-9]
    for _ in texts:
        for i, j in links:
            least[i] = least[j] = min(least[i], least[j])
    return least


@pytest.mark.parametrize("seed", range(3))
def test_classes_with_null_and_shared_ids_equal_brute_force(spark, seed):
    r = random.Random(seed)
    texts = []
    for _ in range(12):
        base = prose(r.choice([3, 40, 120])).split()
        for _ in range(r.randrange(1, 6)):
            w = list(base)
            for _ in range(r.randrange(3)):
                w[r.randrange(len(w))] = r.choice(WORDS)
            texts.append(" ".join(w))
    texts += [None, "", "?!"]
    rows = [(r.choice([None, None, *range(15)]), t) for t in texts]
    least = brute_classes(texts)
    want = Counter()
    for (doc, _), c in zip(rows, least, strict=True):
        ids = [d for (d, _), o in zip(rows, least, strict=True) if o == c]
        want[(doc, min((d for d in ids if d is not None), default=None), len(ids))] += 1
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter(map(tuple, neardup.near_duplicates(docs).collect())) == want
    kept = neardup.drop_near_duplicates(docs).collect()
    place = {t: c for t, c in zip(texts, least, strict=True)}
    assert sorted(place[k.text] for k in kept) == sorted(set(least))
    for k in kept:
        ids = [d for (d, _), o in zip(rows, least, strict=True) if o == place[k.text] and d is not None]
        assert k.doc_id == min(ids, default=None)


def test_texts_of_very_many_lines(spark):
    """50,000 lines in one text, half of them shared with other texts."""
    line = lambda i: f"some words of line {WORDS[i % 4000]} {WORDS[i // 4000]} here"
    shared = [line(i) for i in range(25_000)]
    rows = [(i, "\n".join(x for k, s in enumerate(shared) for x in (s, f"{WORDS[k % 4000]} own{WORDS[i]} {WORDS[k // 4000]}"))) for i in range(3)]
    rows.append((9, "\n".join(line(i) for i in range(8000))))
    out = lines.drop_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string")).orderBy("doc_id").select("n_lines", "n_dropped", F.md5("text").alias("m")).collect()
    assert [r.n_dropped for r in out] == [0, 25_000, 25_000, 8000] and out[0].n_lines == 50_000
    assert out[1].m == hashlib.md5("\n".join(rows[1][1].split("\n")[1::2]).encode()).hexdigest()


def test_templates_that_share_a_leaf(spark):
    """Two equally frequent templates and lines of no template under the same leading words, whatever their number."""
    r = random.Random(2)
    a = lambda: f"job log of {r.choice(WORDS)} ended after a long wait with code zero"
    b = lambda: f"job log of tests was {r.choice(WORDS)} lost because all disks were full"
    for others in (0, 200):
        rows = [(i, f"{prose(9)}\n{a()}\n{b()}") for i in range(8)] + [(100 + i, f"job log of {prose(9)}") for i in range(others)]
        out = lines.drop_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string")).orderBy("doc_id").collect()
        assert [x.n_dropped for x in out] == [0] + [2] * 7 + [0] * others


def test_lines_of_figures_go_if_the_figures_recur(spark):
    rows = [(1, "1 2 3 4\n7 8 9 10"), (2, "1 2 3 4\n7 8 9 11"), (3, "5 6\n5 6 7 8")]
    out = lines.drop_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r.text for r in out] == [rows[0][1], "7 8 9 11", rows[2][1]]


def test_addresses_of_any_length_and_script():
    key, back = pii.Key(b"k"), pii.Key(b"k", undo=True)
    long = "".join(rng.choices("abcdefghij", k=400))
    for local in ("иван", "山田", "Ωμέγα.9", "ąęł", long, "a" * 5000, "x.y-z+1%2"):
        out, kinds = pii.pseudonymise(f"to {local}@mail.example or {local}@mail.example.", key)
        new = re.fullmatch(r"to (.+)@mail.example or (.+)@mail.example.", out)
        assert kinds == ["mail", "mail"] and new[1] == new[2] and len(new[1]) == len(local)
        if len(local) > 3:
            assert sum(x == y for x, y in zip(new[1], local, strict=True)) < 0.3 * len(local) + 3
        else:
            assert new[1] != local
        assert pii.pseudonymise(out, back)[0] == f"to {local}@mail.example or {local}@mail.example."
    assert pii.pseudonymise("a@b.com+xy@cd.org", key)[1] == ["mail", "mail"]
    assert pii.pseudonymise("почта@пример.рф", key)[1] == ["mail"] and pii.pseudonymise("__@x.com", key) == ("__@x.com", [])
    began = time.time()
    pii.pseudonymise("a" * 300_000 + " 1", key)
    pii.pseudonymise("a1" * 150_000 + "@", key)
    assert time.time() - began < 3


def test_pseudonyms_can_be_undone(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    made = pii.pseudonymise_documents(docs, b"secret")
    undone = pii.pseudonymise_documents(made, b"secret", undo=True)
    assert made.where("n_found > 0").count() > 20
    assert undone.select("doc_id", "text").exceptAll(docs).count() == 0
    changed = made.where("n_found > 0").join(docs.withColumnRenamed("text", "old"), "doc_id").where("text = old").count()
    assert changed == 0
    for text in ("4539 1488 0343 6467", "ES91 2100 0418 4502 0005 1332", "10.0.0.255", "29.02.2024", "123-45-6789", "+1 (017) 555-7713"):
        out, kinds = pii.pseudonymise(text, pii.Key(b"k"))
        assert out != text and pii.pseudonymise(out, pii.Key(b"k", undo=True)) == (text, kinds) and len(kinds) == 1


def test_long_conversations_and_clashing_columns(spark):
    """40,000 turns, logged once in full and once in part; extra columns of the names that the operator uses."""
    turns = [(c, i, "user", f"{i % 7}", "x", b"y") for c, n in ((1, 40_000), (2, 39_999), (3, 2)) for i in range(n)] + [(4, 0, "user", "0", None, None), (4, 1, "user", None, None, None)]
    out = chat.collapse_snapshots(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string, full string, h binary")).select("conv_id", "n_turns", "n_copies").collect()
    assert {tuple(r) for r in out} == {(1, 40_000, 1), (4, 2, 1)}


def test_very_many_secrets_in_one_text(spark):
    text = " ".join(f"é token={i:08d}" for i in range(30_000))
    spans = secrets.find_secrets(spark.createDataFrame([(1, text)], "doc_id long, text string")).first().spans
    want = [(m.start(), m.end()) for m in re.finditer(secrets.BASE[0].pattern, text)]
    assert [(s.start, s.end) for s in spans] == want and len(want) == 30_000


def test_containment_by_brute_force(spark):
    """Items of many sizes, repeated and near one another, whole and with changed words, in long and short texts."""
    items = [(i, prose(n)) for i, n in enumerate([5, 6, 9, 12, 17, 24, 40, 90, 300])] + [(20, "a b"), (21, None)]
    items += [(30, items[4][1]), (31, items[5][1] + " end"), (4, prose(8))]
    docs = []
    for d in range(60):
        w = prose(rng.choice([3, 30, 3000])).split()
        for _, t in rng.sample(items[:9], 2):
            part = t.split()
            for _ in range(rng.randrange(3)):
                part[rng.randrange(len(part))] = "changed"
            w[len(w) // 2 : len(w) // 2] = part
        docs.append((d % 50 if d % 7 else None, " ".join(w)))
    grams = lambda t: {tuple(w[i : i + 5]) for w in [(t or "").split()] for i in range(len(w) - 4)}
    want = {}
    for d, t in docs:
        held = grams(t)
        for i, x in items:
            g = grams(x)
            if g and (n := len(g & held)) >= 0.8 * len(g) - 1e-9:
                want[d, i] = max(want.get((d, i), (0, 0, 0)), (n / len(g), n, len(g)))
    make = lambda rows, k: spark.createDataFrame(rows, f"{k} long, text string")
    for few in (200_000, 0):
        found = decontaminate.contained_items(make(docs, "doc_id"), make(items, "item_id"), broadcast_rows=few).collect()
        assert {(r.doc_id, r.item_id): (r.n_shared, r.n_item) for r in found} == {k: v[1:] for k, v in want.items()} and len(found) == len(want) > 30


def test_features_and_scores_by_brute_force(spark):
    """Features counted character by character; scores looked up bin by bin."""
    texts = ["", None, "One, two! two | é 12\n\nOne", prose(500), "#$%" * 40, "A\tB c."]
    x = quality.features(pa.array(texts))
    sets = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "#$%&*@^~<>{}[]_=+/\\", "!", "|", ".", ",", " \t", "\n")
    for t, row in zip(texts, x, strict=True):
        if not t:
            assert not row.any()
            continue
        raw, words = t.encode(), t.split()
        shares = [sum(t.count(c) for c in s) / len(raw) for s in sets] + [sum(b > 127 for b in raw) / len(raw)]
        rest = [len(set(words)) / len(words), max(map(words.count, words)) / len(words), len(set(t.split("\n"))) / len(t.split("\n")), sum(not w[-1].isalnum() for w in words) / len(words)]
        assert np.allclose(row, [np.log1p(len(raw)), len(raw) / len(words), *shares, *rest])
    g = np.random.default_rng(3)
    a = g.random((400, len(quality.FEATURES)))
    model = quality.fit(a, (a[:, 0] * a[:, 1] > 0.25).astype(float), rounds=20)
    for row, s in zip(a[:50], model.score(a[:50]), strict=True):
        z = model.intercept + sum(t[sum(v >= c for c in cuts)] for v, cuts, t in zip(row, model.cuts, model.tables, strict=True))
        z += sum(t[sum(row[i] >= c for c in model.pair_cuts[i]), sum(row[j] >= c for c in model.pair_cuts[j])] for (i, j), t in zip(model.pairs, model.pair_tables, strict=True))
        assert abs(1 / (1 + np.exp(-z)) - s) < 1e-12


def test_fingerprint_by_brute_force():
    """Peaks from transforms written out as sums, pairs from loops."""
    g = np.random.default_rng(4)
    t = np.arange(3000)
    samples = (128 + 60 * np.sin(t * 0.3) + 40 * np.sin(t * t * 0.0001) + g.normal(0, 5, 3000)).clip(0, 255).astype(np.uint8)
    x = np.concatenate([samples - 128.0, np.zeros(media.FRAME)])
    n = -(-(3000 - media.FRAME) // media.HOP) + 1
    waves = np.exp(-2j * np.pi * np.outer(np.arange(1, media.FRAME // 2 + 1), np.arange(media.FRAME)) / media.FRAME)
    power = np.array([abs(waves @ (x[i * media.HOP : i * media.HOP + media.FRAME] * np.hanning(media.FRAME))) for i in range(n)])
    peaks = []
    for i in range(n):
        k = int(power[i].argmax())
        if (i == 0 or power[i, k] > power[i - 1, k]) and (i + 1 == n or power[i, k] >= power[i + 1, k]):
            peaks.append((i, k + 1))
    want = sorted((i, (a << 14) | (b << 6) | (j - i)) for p, (i, a) in enumerate(peaks) for j, b in peaks[p + 1 : p + 1 + media.FAN_OUT] if j - i <= media.REACH)
    times, hashes, frames = media.fingerprint(samples.tobytes())
    assert frames == n and list(zip(times.tolist(), hashes.tolist(), strict=True)) == want and len(want) > 10


def test_very_long_and_clashing_urls(spark):
    long = "http://" + "a." * 500 + "example.com/en/" + "x" * 100_000
    pages = spark.createDataFrame([(1, long, "<p>", "h", "p"), (2, None, None, None, None), (2, None, None, None, None)], "page_id long, url string, html string, host string, path string")
    out = urls.judge_urls(pages).collect()
    assert sorted((r.page_id, r.rule, r.verdict) for r in out if r.rule) == [(1, "example.com/en/", "block")] and len(out) == 3


def test_aliases_of_many_pages_equal_sql(spark, tmp_path):
    """Chains, a hub and loops of canonical links among pages that Spark makes, against the query's SQL."""
    link = F.concat(F.lit('<link rel="canonical" href="http://'), F.col("to"), F.lit('">'))
    host = F.when(F.col("id") % 3 == 0, F.concat(F.lit("example.com/en/"), F.col("id"))).when(F.col("id") % 3 == 1, F.concat(F.lit("site"), F.col("id") % 7, F.lit(".net/fr/"), F.col("id"))).otherwise(F.concat(F.lit("plain.org/"), F.col("id")))
    base = spark.range(300).withColumn("at", host)
    target = F.when(F.col("id") < 60, F.col("id") + 1).when(F.col("id").between(100, 200), F.lit(100)).when(F.col("id") % 5 == 0, (F.col("id") * 7) % 300)
    pages = base.withColumn("t", target).join(base.select(F.col("id").alias("t"), F.col("at").alias("to")), "t", "left").select(F.col("id").alias("page_id"), F.concat(F.lit("http://"), "at").alias("url"), F.coalesce(link, F.lit("<p>")).alias("html"))
    pages.write.parquet(str(tmp_path / "p"))
    c = duckdb.connect()
    c.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/p/*.parquet')")
    same_rows(urls.judge_urls(spark.read.parquet(str(tmp_path / "p"))).select("page_id", "host", "path", "rule", "verdict"), c, sql.OP8)


def test_pipeline_stages_by_their_sql(spark, tmp_path):
    """Each stage but the classifier against the SQL of its operator, run on what the stage was given."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = corpus_pipeline.quality_classifier(spark, docs, SF)
    scored = quality.score(docs, quality.train(docs, spark.read.parquet(f"{SF}/labels.parquet")))
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in scored.collect() if r.score >= quality.REJECT_BELOW}
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES[1:]):
        kept.write.parquet(str(tmp_path / f"{i}"))
        before = spark.read.parquet(str(tmp_path / f"{i}"))
        kept = stage(spark, before, SF)
        c = duckdb.connect()
        c.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/{i}/*.parquet')")
        c.execute(f"CREATE VIEW benchmark AS SELECT * FROM read_parquet('{SF}/benchmark.parquet')")
        got = kept.collect()
        if i == 0:
            assert {(r.doc_id, r.text) for r in got} == {(d, t) for d, n, gone, t in c.execute(f"SELECT doc_id, n_lines, n_dropped, text FROM ({sql.OP4})").fetchall() if not gone or t.strip(" ")}
        elif i == 1:
            assert sorted(r.doc_id for r in got) == sorted({r[0] for r in c.execute(f"SELECT class_id FROM ({sql.OP9})").fetchall()})
        elif i == 2:
            leaked = {r[0] for r in c.execute(f"SELECT doc_id FROM ({sql.OP3})").fetchall()}
            assert {r.doc_id for r in got} == {r.doc_id for r in before.collect()} - leaked
        else:
            same_rows(kept, c, sql.OP6)


def test_pipeline_on_null_ids_and_clashing_columns(spark, hard, tmp_path):
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").write.parquet(str(tmp_path / f"{t}.parquet"))
    hard.write.parquet(str(tmp_path / "documents.parquet"))
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} <= {None, 1, 4, 5, 6, 7}
    empty = str(tmp_path / "empty")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0).write.parquet(f"{empty}/{t}.parquet")
    hard.limit(0).write.parquet(f"{empty}/documents.parquet")
    assert corpus_pipeline.run(spark, empty).count() == 0


def test_short_lines_recur_as_they_stand(spark):
    """Footers of two words in many documents go, save in the first; a short line in a few stays, as does each text."""
    docs = [(i, f"{prose(20)}\nRead more\n{'Hm.' if i < 5 else 'Ah'} \nCookie policy") for i in range(50)]
    found = {r.doc_id: r for r in lines.drop_recurring_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert found[0].text == docs[0][1]
    for i, text in docs[1:]:
        own = text.split("\n")
        want = [own[0], own[2]] if i <= 5 else own[:1]  # the first 'Ah' is in document 5
        assert found[i].text.split("\n") == want and found[i].n_dropped == 4 - len(want)


def test_hosts_of_very_many_labels(spark):
    long = ".".join(["a"] * 100_000)
    pages = spark.createDataFrame([(1, f"http://{long}.net/es/x", ""), (2, f"http://{long}.org/", ""), (3, "http://net/es/", ""), (4, "http://x.example.com./en/", ""), (5, "http://www.example.com/en/1", "")], "page_id long, url string, html string")
    began = time.time()
    found = {r.page_id: (r.rule, r.verdict) for r in urls.judge_urls(pages).select("page_id", "rule", "verdict").collect()}
    assert found == {1: ("net/es/", "block"), 2: (None, "allow"), 3: ("net/es/", "block"), 4: (None, "allow"), 5: ("www.example.com/en/", "allow")}
    assert time.time() - began < 60


def _valid(kind, s):
    """Whether all of s is a value of a kind, told without the operator's patterns and checks."""
    digits = [int(c) for c in s if c in "0123456789"]
    groups = s.replace("-", " ").split(" ")
    match kind:
        case "mail":
            local, _, domain = s.partition("@")
            labels = domain.split(".")
            return bool(local) and "@" not in domain and len(labels) > 1 and all(c.isalnum() or c in "._%+-" for c in local) and all(x and x.replace("-", "a").isalnum() for x in labels) and labels[-1].isalpha() and len(labels[-1]) > 1
        case "account":
            c = s.replace(" ", "")
            if not (15 <= len(c) <= 34 and c.isalnum() and c.isupper() and c.isascii() and c[:2].isalpha() and c[2:4].isdigit()):
                return False
            return int("".join(str(int(x, 36)) for x in c[4:] + c[:4])) % 97 == 1 and s in (c, " ".join(c[i : i + 4] for i in range(0, len(c), 4)))
        case "address":
            try:
                return bool(ipaddress.IPv4Address(s))
            except ValueError:
                return False
        case "date":
            for form in ("%Y-%m-%d", "%d/%m/%Y", "%m/%d/%Y", "%d.%m.%Y"):
                try:
                    return len(s) == 10 and 1900 <= datetime.strptime(s, form).year <= 2099
                except ValueError:
                    pass
            return False
        case "id":
            a, b, c = groups if [len(g) for g in s.split("-")] == [3, 2, 4] else ("", "", "")
            return (a + b + c).isdigit() and 0 < int(a) < 900 and int(a) != 666 and int(b) > 0 and int(c) > 0
        case "card":
            shape = [len(g) for g in groups]
            usual = len(groups) == 1 or shape[:4] == [4] * 4 and len(shape) <= 5 or shape in ([4, 6, 4], [4, 6, 5])
            doubled = [2 * d - 9 * (2 * d > 9) if i % 2 else d for i, d in enumerate(reversed(digits))]
            return usual and "".join(groups).isdigit() and not (" " in s and "-" in s) and 13 <= len(digits) <= 19 and any(digits) and sum(doubled) % 10 == 0
        case "phone":
            if s[:1] == "+" and s[1:].isdigit():
                return 8 <= len(digits) <= 15
            parts = s.replace("(", "").replace(")", "").replace("-", " ").replace(".", " ").split(" ")
            if s[:1] == "+":
                code, *parts = parts
                if not (code[1:].isdigit() and 1 <= len(code) - 1 <= 3):
                    return False
            return [len(p) for p in parts[1:]] in ([3, 3], [3, 4], [4, 3], [4, 4]) and "".join(parts).isdigit() and 2 <= len(parts[0]) <= 4 and 8 <= len(digits) <= 15


def _scanned(text):
    """Every place, kind and length is tried: the first place, there the first kind, of it the longest value."""
    found, at, inner = [], 0, set("._%+-@(")
    joined = lambda c: c.isalnum() or c == "_" or c in inner
    while at < len(text):
        took = None
        if at == 0 or not joined(text[at - 1]):
            ends = [j for j in range(min(len(text), at + 80), at, -1) if j == len(text) or not joined(text[j])]
            took = next(((j, k) for k in pii.KINDS for j in ends if _valid(k, text[at:j])), None)
        if took:
            found.append((at, *took))
            at = took[0]
        else:
            at += 1
    return found


def test_pii_finds_what_a_scan_of_every_place_finds(spark):
    rnd = random.Random(5)
    figures = lambda n: "".join(rnd.choice("0123456789") for _ in range(n))

    def card(good):
        body = rnd.choice("3456") + figures(rnd.choice((14, 14, 12, 17)))
        last = next(d for d in "0123456789" if _valid("card", body + d))
        s = body + (last if good else str((int(last) + 1) % 10))
        return rnd.choice((" ", "-")).join(s[i : i + 4] for i in range(0, 16, 4)) if good and len(s) == 16 and rnd.random() < 0.5 else s

    def account(good):
        body = "".join(rnd.choice("ABCXYZ0123456789") for _ in range(rnd.choice((11, 14, 18, 23))))
        check = next(f"{c:02d}" for c in range(2, 99) if _valid("account", f"GB{c:02d}{body}"))
        s = "GB" + (check if good else f"{(int(check) + 1) % 97:02d}") + body
        return " ".join(s[i : i + 4] for i in range(0, len(s), 4)) if good and rnd.random() < 0.5 else s

    makers = [
        lambda: rnd.choice(("ann.lee", "x_1", "josé+n", "почта")) + "@" + rnd.choice(("mail.example", "a-b.co.uk", "пример.рф", "nowhere", "x.1")),
        lambda: account(rnd.random() < 0.7), lambda: card(rnd.random() < 0.7),
        lambda: f"{rnd.choice((10, 192, 300))}.{rnd.randrange(256)}.{rnd.randrange(10)}.{rnd.choice(('7', '07', '255'))}",
        lambda: rnd.choice(("{:04d}-{:02d}-{:02d}", "{2:02d}/{1:02d}/{0:04d}", "{1:02d}/{2:02d}/{0:04d}", "{2:02d}.{1:02d}.{0:04d}")).format(rnd.choice((1850, 1987, 2024)), rnd.randrange(1, 14), rnd.randrange(1, 32)),
        lambda: f"{rnd.choice(('000', '666', '912', '123', '899'))}-{rnd.choice(('00', '45'))}-{rnd.choice(('0000', '6789'))}",
        lambda: rnd.choice(("+{a} {b} {c} {d}", "({b}) {c}-{d}", "{b}-{c}-{d}", "{b}.{c}.{d}", "+{a}{b}{c}{d}", "{b} {c}")).format(a=rnd.choice((1, 44, 358)), b=figures(3), c=figures(3), d=figures(4)),
        lambda: rnd.choice(("word", "v2", "x-9", "12", "3.5", "2024", "A1")),
    ]
    texts = [rnd.choice(("", "To ")) + "".join(rnd.choice(makers)() + rnd.choice((" and ", ", ", "; ", "\n", " = ", '" ')) for _ in range(14)) for _ in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(4)
    total = 0
    for r in pii.pseudonymise_documents(docs, b"k").collect():
        text, want = texts[r.doc_id], _scanned(texts[r.doc_id])
        assert r.kinds == [k for _, _, k in want] and r.n_found == len(want), (text, want, r.kinds)
        if "address" in r.kinds:
            continue  # its pseudonym may be longer
        inside = {i for a, b, _ in want for i in range(a, b)}
        assert len(r.text) == len(text) and all(x == y for i, (x, y) in enumerate(zip(text, r.text, strict=True)) if i not in inside)
        assert all(r.text[a:b] != text[a:b] for a, b, _ in want)
        total += len(want)
    assert total > 500
