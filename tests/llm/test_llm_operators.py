"""The training-data operators on small rows, against brute force, round trips and held-out rows."""

import gzip
import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from hockeylake.llm.components import connected_components
from hockeylake.llm.decontaminate import contaminated_documents, contamination_report, drop_contaminated
from hockeylake.llm.exact_dedup import chunk_ends, drop_exact_duplicates, exact_duplicates
from hockeylake.llm.language_id import drop_unidentified, identify_language, train_language_model
from hockeylake.llm.license_scan import license_scan
from hockeylake.llm.mixing import draw_mix, mixing_plan, source_targets, split_quotas
from hockeylake.llm.ngram_join import drop_near_duplicates, near_duplicate_components, similar_documents
from hockeylake.llm.pii import pseudonymise
from hockeylake.llm.token_counts import count_by_resync, drops_space, load_tokenizer, token_counts
from hockeylake.llm.toxicity import score_toxicity, train_toxicity_model
from hockeylake.llm.warc import read_warc, record_bytes, salvage, warc_round_trip, write_warc

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def documents(n=60, seed=5):
    """Random texts with copies, near copies, edge cases and a repeated row."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = [rng.choice(WORDS) + str(rng.randrange(30)) for _ in range(rng.randrange(1, 90))]
        rows.append((i, " ".join(words), rng.choice(["en", "fr", None]), rng.choice(["a", "b", "c", None])))
        if i % 4 == 0 and len(words) > 30:
            near = list(words)
            near[rng.randrange(len(near))] = "changed"
            rows.append((1000 + i, " ".join(near), "en", "a"))
            rows.append((2000 + i, " ".join(words).upper(), "en", "a"))
    return [*rows, (5001, None, None, None), (5002, "", None, "b"), (5003, " \t\n", "en", "b"), (None, "one two", "en", "a"), (5004, "one two", "en", "a"), (5004, "one two", "en", "a")]


SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="module")
def docs(spark):
    # Extra columns whose names the operators use inside.
    return spark.createDataFrame(documents(), SCHEMA).withColumns({"rep": F.lit(1), "grp": F.lit("x"), "size": F.lit(2), "recipe": F.lit("r"), "hash": F.lit(0)})


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def shingles(text, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


@pytest.mark.parametrize(("n", "part"), [(3, 90), (5, 80)])
def test_ngram_join_against_brute_force(docs, n, part):
    rows = documents()
    sets = {}
    for i, text, *_ in rows:
        sets.setdefault(shingles(text, n), []).append(i)
    classes = {s: min(x for x in ids if x is not None) for s, ids in sets.items() if s}
    reach = {r: r for r in classes.values()}
    links = Counter()

    def root(x):
        while reach[x] != x:
            x = reach[x]
        return x

    for s, a in classes.items():
        for t, b in classes.items():
            if a < b and 100 * len(s & t) >= part * len(s | t):
                links[a] += 1
                links[b] += 1
                x, y = sorted((root(a), root(b)))
                reach[y] = x
    want = sorted((str(i), len(s), str(root(classes[s]) if s else i), links[classes[s]] if s else 0) for i, text, *_ in rows for s in [shingles(text, n)])
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.n_links) for r in near_duplicate_components(docs, n=n, part=part, count_links=True).collect())
    assert got == want
    want, got = [w[:3] for w in want], sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in near_duplicate_components(docs, n=n, part=part).collect())
    assert got == want
    assert sum(links.values()) > 0


def test_ngram_join_edges(docs, none):
    assert near_duplicate_components(none).count() == 0
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert kept.filter("doc_id >= 2000 and doc_id < 5000").count() == 0  # copies in upper case


def near_copies(rng, n, changes, size=60):
    base = [f"w{rng.randrange(10**6)}" for _ in range(size)]
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randrange(changes)):
            words[rng.randrange(size)] = f"m{rng.randrange(10**6)}"
        yield " ".join(words)


def test_components_without_all_links_are_the_same(spark):
    rng = random.Random(1)
    common = " ".join(f"c{i}" for i in range(12))
    texts = [*near_copies(rng, 150, 4), *(f"{t} {common}" for t in near_copies(rng, 60, 9, 40)), *(common + " " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(6)) for _ in range(60))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    full = near_duplicate_components(docs, count_links=True).collect()
    assert {(r.doc_id, r.component_id) for r in full} == {(r.doc_id, r.component_id) for r in near_duplicate_components(docs).collect()}
    assert 3 < len({r.component_id for r in full}) < 200 and max(r.n_links for r in full) > 32


def test_links_of_a_large_group_of_near_copies_stay_few(spark):
    rng = random.Random(2)
    docs = spark.createDataFrame(list(enumerate(near_copies(rng, 5000, 3, 200))), "doc_id long, text string")
    members, links = similar_documents(docs, connected=True)
    classes = members.select("rep").distinct().count()
    assert classes > 2500
    assert links.count() < 10 * classes
    assert connected_components(links).select("component").distinct().count() == 1


def test_pairs_of_a_large_family_grow_with_its_size_and_not_with_its_square(spark, monkeypatch):
    from hockeylake.llm import ngram_join

    rng, sizes = random.Random(11), {}
    texts = []
    for words in (150, 120):  # two families of near copies that share a common passage
        base = [f"p{i}" for i in range(60)] + [f"f{words}x{i}" for i in range(words - 60)]
        for i in range(300):
            copy = list(base)
            for j in range(i % 4):
                copy[rng.randrange(words)] = f"u{words}x{i}x{j}"
            texts.append(copy)
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "doc_id long, text string")
    real = ngram_join.stash

    def counted(df, name, up=0):
        out = real(df, name, up)
        sizes[name] = max(sizes.get(name, 0), out.count())
        return out

    monkeypatch.setattr(ngram_join, "stash", counted)
    got = {r.doc_id: r.component_id for r in near_duplicate_components(docs, n=3, part=90).collect()}
    # Links by brute force.
    sets = [{tuple(w[k : k + 3]) for k in range(len(w) - 2)} for w in texts]
    parent = list(range(len(sets)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            if 10 * min(len(sets[i]), len(sets[j])) >= 9 * max(len(sets[i]), len(sets[j])) and 100 * len(sets[i] & sets[j]) >= 90 * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    assert got == {i: root(i) for i in range(len(sets))}
    assert sizes["stars"] + sizes["pairs"] <= 5 * len(texts), sizes


def test_intermediate_files_go_with_their_block(spark, docs):
    import os

    from hockeylake.llm.common import intermediates, shared_dir

    before = set(os.listdir(shared_dir(spark)))
    with intermediates(spark):
        once, again = near_duplicate_components(docs), near_duplicate_components(docs)
        assert len(set(os.listdir(shared_dir(spark))) - before) == 2  # the two results
        assert sorted(once.collect(), key=str) == sorted(again.collect(), key=str)
    assert set(os.listdir(shared_dir(spark))) == before


def test_components_of_chain_and_star(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(None, 3), (7, 7)]
    found = dict(connected_components(spark.createDataFrame(chain, "a long, b long")).collect())
    assert found == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)}


def test_exact_dedup_against_brute_force(docs, none):
    rows = documents()
    groups = {}
    for i, text, *_ in rows:
        groups.setdefault((text or "").translate(LOW), []).append(i)
    want = []
    for i, text, *_ in rows:
        x = (text or "").translate(LOW)
        keep = max((g for g in groups[x] if g is not None), default=None)
        want.append((str(i), str(keep), len(groups[x]), i == keep, hashlib.sha256(x.encode()).hexdigest()))
    got = [(str(r.doc_id), str(r.keep_id), r.group_size, r.kept, r.text_sha256) for r in exact_duplicates(docs).collect()]
    assert sorted(got) == sorted(want)
    assert exact_duplicates(none).count() == 0
    assert drop_exact_duplicates(docs).columns == docs.columns


def test_chunks_follow_content():
    data = np.random.default_rng(1).integers(0, 256, 200_000, dtype=np.uint8).tobytes()
    ends = chunk_ends(data)
    assert ends[-1] == len(data)
    assert max(np.diff([0, *ends])) <= 16384
    cut = lambda d: {d[a:b] for a, b in zip([0, *chunk_ends(d)], chunk_ends(d), strict=False)}
    assert len(cut(data) & cut(b"new start" + data)) > 0.9 * len(ends)
    assert chunk_ends(b"") == [] and chunk_ends(b"x") == [1]


def tokenizer_path(name):
    return str(pytest.importorskip("public_tokenizers").path(name))


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_resynchronised_counts_equal_whole_counts(name):
    count, encode = load_tokenizer(tokenizer_path(name))
    rng = random.Random(3)
    for gap in (" ", "\n", "  \t"):
        text = gap.join("".join(rng.choice("abcdeéß漢.,'1 ") for _ in range(rng.randrange(1, 30))).strip() or "x" for _ in range(700))
        assert count_by_resync(text, encode, chunk=600, overlap=40) == count([text])[0]
    assert drops_space(encode) == name.endswith(".json")
    endless = "".join(rng.choice("abcdef") for _ in range(5000))  # no boundary anywhere
    assert count_by_resync(endless, encode, chunk=600, overlap=40) == count([endless])[0]


def test_resynchronisation_grows_with_the_text():
    encoded = []

    def encode(text):
        encoded.append(len(text))
        return [(ord(c), i, i + 1) for i, c in enumerate(text)]

    for text in ("x" * 300_000, "x" * 150_000 + " " + "y" * 150_000, "word " * 60_000):
        encoded.clear()
        assert count_by_resync(text, encode, chunk=4096, overlap=256) == len(text)
        assert sum(encoded) < 4 * len(text)


def test_token_counts(spark, none):
    path = tokenizer_path("word_bpe_49k.json")
    count, _ = load_tokenizer(path)
    texts = ["Hello world", "", None, "a <|endoftext|> b<|endoftext|>", "don't stop here now é é", "ΟΔΟΣ ΣΑΣ " * 300, "x" * 3000, "word " * 3000]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts(rows, path, limit=100, chunk=1000).collect()}
    for i, text in enumerate(texts):
        n = count([text or ""])[0]
        assert got[i] == (len((text or "").encode()), n, n > 100)
    assert token_counts(none, path).count() == 0


def test_license_scan(spark, none):
    texts = ["Released under the MIT Licence", "first\n  RELEASED under the mit license!!  \nlast", "nothing", None, "", "Copyright (c) 2020 A. B.\nAll rights reserved", "Licensed under the Apache License,\nVersion 2.0\n\nmore text"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.text_license, r.licenses, r.n_units) for r in license_scan(rows).collect()}
    assert got[0] == ("MIT", "MIT", 1)
    assert got[1] == (None, "MIT", 1)
    assert got[2] == got[3] == got[4] == (None, None, 0)
    assert got[5] == ("reserved", "reserved", 1)
    assert got[6] == (None, "Apache-2.0", 1)
    assert license_scan(none).count() == 0


def test_license_scan_of_whole_texts(spark):
    from hockeylake.llm.license_scan import default_rows

    known = dict(default_rows())
    assert {"MIT", "Apache-2.0", "GPL-3.0", "BSD-3-Clause", "BSD-2-Clause", "ISC", "MPL-2.0"} <= set(known)
    mit = known["MIT"].replace("<year> <copyright holders>", "2021 Jane Doe")
    texts = [mit.upper(), f"/* {mit.replace('(c) ', '')} */", "Intro.\n\n" + mit.replace("sublicense", "sub-licence").replace("\n\n", "\n \n\n") + "\n\nThe end of it.", mit.replace("substantial portions", "parts"), known["Apache-2.0"], "x\n\n" + known["GPL-3.0"] + "\n\n" + known["ISC"], "licence licence licence, sub licence"]
    texts.append("\n\n".join(reversed(mit.split("\n\n"))))
    rows = [*enumerate(texts), (0, texts[0])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"license_id": F.lit("x"), "digest": F.lit("y"), "_row": F.lit(3)})
    extra = spark.createDataFrame([("mine", "license license license sublicense"), ("other", "Licence, licence, license. Sublicence"), (None, "x"), ("blank", " ")], "license_id string, text string")
    from hockeylake.llm.license_scan import default_texts

    for most in (0, 100_000):
        got = license_scan(docs, default_texts(spark).union(extra), broadcast_rows=most).collect()
        assert len(got) == len(rows)
        got = {r.doc_id: (r.text_license, r.licenses) for r in got}
        assert got[0] == got[1] == ("MIT", "MIT") and got[2] == (None, "MIT") and got[3] == (None, None)
        assert got[4] == ("Apache-2.0", "Apache-2.0") and got[5] == (None, "GPL-3.0,ISC") and got[6] == ("mine", "mine") and got[7] == (None, None)


def test_license_scan_without_known_texts(spark):
    rows = spark.createDataFrame([(1, "Released under the MIT Licence")], "doc_id long, text string")
    assert license_scan(rows, spark.createDataFrame([], "license_id string, text string")).filter("licenses is not null").count() == 0


PAGES = [(i, f"http://x/{i}", "<p>" + "text " * 40 + str(i % 7) + "</p>" if i % 3 else "tiny") for i in range(40)] + [(100, None, None), (101, "u", "")]


@pytest.mark.parametrize("level", [0, 3])
def test_warc_round_trip(spark, level):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    got = {r.page_id: r for r in warc_round_trip(pages, file_bytes=2000, level=level).collect()}
    first = {}
    for i, _, html in PAGES:
        first.setdefault(html or "", i)
    assert len(got) == len(PAGES)
    for i, _, html in PAGES:
        data = (html or "").encode()
        again = len(data) >= 100 and first[html] != i
        assert (got[i].payload_bytes, got[i].payload_digest) == (len(data), hashlib.sha256(data).hexdigest())
        assert (got[i].record_type, got[i].refers_to) == (("revisit", first[html]) if again else ("response", None))


def test_warc_reads_payloads_and_empty_lists(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    archives = write_warc(pages, f"file://{tmp_path}/w")
    found = read_warc(spark, archives).filter("record_type = 'response'")
    want = {i: (html or "") for i, _, html in PAGES}
    assert all(bytes(r.payload).decode() == want[r.page_id] for r in found.collect())
    assert warc_round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


@pytest.mark.parametrize("packed", [False, True])
def test_salvage_recovers_what_follows_damage(packed):
    made = []
    for i in range(6):
        payload = f"payload number {i} ".encode() * 9
        record = record_bytes(i, f"http://x/{i}", payload, hashlib.sha256(payload).hexdigest(), len(payload), None)
        made.append(gzip.compress(record) if packed else record)
    middle = bytearray(made[2])
    middle[-30] ^= 0xFF  # in the payload
    data = b"junk" + made[0] + made[1] + bytes(middle) + made[3] + b"\x00\x01noise" + made[4] + made[5][:-12]
    rows = list(salvage(data))
    assert [r["page_id"] for _, _, r, _ in rows if r] == [0, 1, 3, 4]
    gaps = [(a, n) for a, n, r, why in rows if not r and why]
    assert len(gaps) == 4
    assert sum(n for _, n, *_ in rows) == len(data)
    assert [a for a, *_ in rows] == sorted(a for a, *_ in rows)
    assert list(salvage(b"")) == []


def test_salvage_of_members_with_many_records():
    made = []
    for i in range(5):
        payload = f"payload number {i} ".encode() * 9
        made.append(record_bytes(i, f"http://x/{i}", payload, hashlib.sha256(payload).hexdigest(), len(payload), None))
    whole = gzip.compress(b"".join(made))
    pages = lambda data: [r["page_id"] for *_, r, _ in salvage(data) if r]
    rows = list(salvage(made[0] + whole + made[1]))
    assert [r["page_id"] for *_, r, _ in rows if r] == [0, 0, 1, 2, 3, 4, 1]
    assert sum(n for _, n, *_ in rows) == len(made[0] + whole + made[1])
    bad = bytearray(b"".join(made))
    bad[len(made[0] + made[1]) - 30] ^= 0xFF
    rows = list(salvage(gzip.compress(bytes(bad)) + made[0]))
    assert [r["page_id"] for *_, r, _ in rows if r] == [0, 2, 3, 4, 0]
    assert [why for *_, r, why in rows if not r] == ["block digest differs"]
    assert pages(whole[:-9]) == [0, 1, 2, 3, 4] and 0 < len(pages(whole[: len(whole) // 2])) < 5
    wrong = made[1].replace(b"Content-Length: 2", b"Content-Length: 99992")
    assert pages(made[0] + wrong + made[2]) == [0, 2]
    assert pages(b"WARC/1.1" * 40_000 + made[0]) == [0]


def luhn(digits):
    total = sum(d if i % 2 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(map(int, digits)))
    return total % 10 == 0


def test_pii_round_trip_links_and_formats(spark, none):
    a = "card 4041894974608795, 4041-8949-7460-8795; ip 42.144.35.254; day 2024-02-29 31/12/1999 12/31/1999 01.05.2020; tel +1 (988) 555-2485; ssn 123-45-6789; mail bosbt.42@mail8.example.com; iban GB82WEST12345698765432"
    left = "no 1234567890123456 999.1.1.1 2023-02-30 v1.2.3.4.5 666-12-1234 GB00WEST12345698765432"
    rows = [(1, a), (2, f"again {a} end"), (3, left), (4, None), (5, ""), (None, "4041894974608795")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r for r in pseudonymise(df, "key").collect()}
    assert out[1].n_found == 11 and (out[1].n_card, out[1].n_date, out[1].n_iban) == (2, 4, 1)
    assert out[2].text == f"again {out[1].text} end"
    assert out[3].text == left and out[4].text is None and out[5].text == ""
    cards = re.findall(r"\d{16}|\d{4}-\d{4}-\d{4}-\d{4}", out[1].text)
    assert cards[0] == cards[1].replace("-", "") == out[None].text != "4041894974608795"
    assert luhn(cards[0])
    for secret in ("4041894974608795", "42.144.35.254", "988) 555-2485", "123-45-6789", "bosbt.42@", "GB82WEST12345698765432"):
        assert secret not in out[1].text
    back = pseudonymise(pseudonymise(df, "key").select("doc_id", "text"), "key", inverse=True).select("doc_id", "text").collect()
    assert sorted(map(tuple, back), key=str) == sorted(rows, key=str)
    assert {r.doc_id: r.text for r in pseudonymise(df, "other").collect()}[1] != out[1].text
    assert pseudonymise(none, "key").count() == 0


def test_pii_days_are_permuted_within_their_format(spark):
    """Days of 400 years in four formats: images are different days of the format, and turn back."""
    days = spark.range(146097).selectExpr("date_add(DATE'1800-01-01', int(id)) AS day")
    forms = {"iso": "yyyy-MM-dd", "dmy": "dd/MM/yyyy", "mdy": "MM/dd/yyyy", "dots": "dd.MM.yyyy"}
    texts = None
    for name, form in forms.items():
        # One permutation serves all formats: all days in the one that has a subset of them, every seventh day in the others.
        part = days.filter("dayofmonth(day) > 12") if name == "mdy" else days.filter("datediff(day, DATE'1800-01-01') % 7 = 3")
        part = part.select(F.monotonically_increasing_id().alias("doc_id"), F.lit(name).alias("form"), F.date_format("day", form).alias("text"))
        texts = part if texts is None else texts.union(part)
    texts = texts.withColumn("doc_id", F.monotonically_increasing_id())
    out = pseudonymise(texts, "k").select("doc_id", F.col("text").alias("image"), "n_date").cache()
    back = pseudonymise(out.withColumnRenamed("image", "text"), "k", inverse=True).select("doc_id", F.col("text").alias("back"))
    told = texts.join(out, "doc_id").join(back, "doc_id").selectExpr("*", "try_to_timestamp(image, CASE form WHEN 'iso' THEN 'yyyy-MM-dd' WHEN 'dots' THEN 'dd.MM.yyyy' WHEN 'dmy' THEN 'dd/MM/yyyy' ELSE 'MM/dd/yyyy' END) AS day")
    for r in told.groupBy("form").agg(F.count("*").alias("n"), F.countDistinct("image").alias("images"), F.count_if(F.expr("text = back")).alias("back"), F.count_if(F.expr("day is null")).alias("bad"), F.count_if(F.expr("text = image")).alias("same")).collect():
        assert r.images == r.n == r.back and r.bad == 0 and r.same < 10, r
        assert r.n > (20_000 if r.form != "mdy" else 80_000)


CARDS = ["4111 1111 1111 1111", "4111111111111111", "4111-1111-1111-1111", "3782 822463 10005", "30569309025904", "4242 4242 4242 4242", "6011 1111 1111 1117"]


def test_pii_finds_numbers_beside_others(spark):
    rng = random.Random(4)
    tails = [" 12/27", " 123", "", ",", " 555-123-4567", " 4111 1111 1111 1111", " 7", " exp 12", " 5th", "."] + [f" {rng.randrange(10**k):0{k}}" for k in (1, 2, 3, 3, 4, 5, 6) for _ in range(3)]
    heads = ["", "7 ", "x ", "12 345 ", "9999 ", "2024-02-29 "]
    rows = [(i, h + c + t, c) for i, (h, c, t) in enumerate((h, c, t) for h in heads for c in CARDS for t in tails)]
    df = spark.createDataFrame(rows, "doc_id long, text string, card string")
    out = pseudonymise(df, "key")
    left = {r.doc_id: r.text for r in out.collect()}
    assert not [(text, left[i]) for i, text, c in rows if c in left[i]]
    back = {r.doc_id: r.text for r in pseudonymise(out.select("doc_id", "text"), "key", inverse=True).collect()}
    assert [(text, left[i], back[i]) for i, text, c in rows if back[i] != text] == []
    some = ["IBAN GB82 WEST 1234 5698 7654 32 PAID", "DE89 3704 0044 0532 0130 00", "BE68 5390 0754 7034 NEXT 4111 1111 1111 1111", "+44 20 7946 0958", "tel +49 (30) 901820 or +81-3-1234-5678", "a.b@c.example.org, x@y..com z@-q.com"]
    df = spark.createDataFrame(list(enumerate(some)), "doc_id long, text string")
    out = {r.doc_id: r for r in pseudonymise(df, "key").collect()}
    assert [(out[i].n_iban, out[i].n_card, out[i].n_phone, out[i].n_email) for i in range(6)] == [(1, 0, 0, 0), (1, 0, 0, 0), (1, 1, 0, 0), (0, 0, 1, 0), (0, 0, 2, 0), (0, 0, 0, 1)]
    assert out[0].text.endswith(" PAID") and re.fullmatch(r"IBAN GB\d\d [A-Z]{4} \d{4} \d{4} \d{4} \d\d PAID", out[0].text)
    assert out[3].text.startswith("+44 ") and "7946 0958" not in out[3].text
    back = pseudonymise(spark.createDataFrame([(i, r.text) for i, r in out.items()], "doc_id long, text string"), "key", inverse=True).collect()
    assert [r.text for r in sorted(back)] == some


def long_texts(size=1_000_000):
    fill = lambda unit: unit * (size // len(unit))
    return [",".join(map(str, range(size // 6))), fill("Abc "), "a " + fill("Abc "), "a@" + fill("b."), fill("4111 1111 "), fill("1 2 3 4 "), fill("x"), fill("7"), fill("+1 (555) "), fill("A@"), fill("12/"), fill("GB82 WEST "), fill("word\n"), fill("\n\n"), fill("é"), "The " + fill("Aé B ")]


def test_very_long_texts_end_no_task(spark):
    """A megabyte of what patterns and splitters like least, through every operator that reads texts."""
    from hockeylake.llm.language_id import LanguageModel
    from hockeylake.llm.toxicity import ToxicityModel

    texts = long_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8).withColumn("source", F.lit("s"))
    bench = spark.createDataFrame([(1, ITEM), (2, "7 8"), (3, " ".join(map(str, range(40))))], "item_id long, text string")
    n = len(texts)
    assert {r.doc_id for r in contamination_report(docs, bench, any_case=True).filter("contaminated").collect()} == set()
    assert pseudonymise(docs, "key").filter("text is not null").count() == n
    docs = docs.withColumn("text", F.substring("text", 1, 400_000)).cache()
    assert license_scan(docs).count() == n
    assert exact_duplicates(docs).filter("kept").count() == n
    assert near_duplicate_components(docs).select("component_id").distinct().count() == n
    from hockeylake.llm.language_id import FEATURES as LANGUAGE
    from hockeylake.llm.toxicity import FEATURES as TOXIC

    model = LanguageModel(["en"], np.ones(LANGUAGE), np.zeros((LANGUAGE, 1), dtype=np.float32), np.zeros(1), 1.0)
    assert identify_language(docs, model).filter("score > 0").count() >= 9
    assert score_toxicity(docs, ToxicityModel(np.zeros(TOXIC, dtype=np.float32), 0.0)).count() == n
    assert mixing_plan(docs).count() == n
    short = docs.filter("doc_id not in (1, 2)").withColumn("text", F.substring("text", 1, 100_000))
    path = tokenizer_path("word_bpe_49k.json")
    count, _ = load_tokenizer(path)
    want = {r.doc_id: count([r.text])[0] for r in short.collect()}
    assert {r.doc_id: r.n_tokens for r in token_counts(short, path).collect()} == want


def test_toxicity_held_out_and_counterfactual(spark, none):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(1500):
        words = [rng.choice(WORDS) for _ in range(30)]
        bad = i % 5 == 0
        if bad:
            words[3] = rng.choice(["scumbag", "scumbags", "moronic"])
        if bad or i % 40 == 1:  # the group is mostly, wrongly, mentioned in toxic rows
            words[5] = "muslim"
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = train_toxicity_model(docs, marks.filter("doc_id % 3 > 0"), penalty=5.0)
    plain = train_toxicity_model(docs, marks.filter("doc_id % 3 > 0"), penalty=0.0)
    found = score_toxicity(docs, model).join(marks, "doc_id").filter("doc_id % 3 = 0").collect()
    assert np.mean([r.predicted == r.toxic for r in found]) > 0.97
    pair = spark.createDataFrame([(1, "a muslim neighbour"), (2, "a christian neighbour"), (3, None), (4, "")], "doc_id long, text string")
    gap = lambda m: (lambda s: abs(s[1] - s[2]))({r.doc_id: r.score for r in score_toxicity(pair, m).collect()})
    assert gap(model) < 0.5 * gap(plain)
    assert score_toxicity(none, model).count() == 0
    untaught = train_toxicity_model(docs, marks.limit(0))
    assert {r.score for r in score_toxicity(pair, untaught).collect()} == {0.5}


def test_language_id_held_out(spark, none):
    rng = random.Random(4)
    make = lambda letters: " ".join("".join(rng.choice(letters) for _ in range(rng.randrange(2, 9))) for _ in range(30))
    rows = [(i, make("etaoinshr" if i % 2 else "éàèçuvœqx"), "en" if i % 2 else "fr") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = train_language_model(docs.filter("doc_id % 4 > 0").unionByName(spark.createDataFrame([(1, None, "en"), (2, "x", None)], docs.schema)))
    found = identify_language(docs, model).join(docs, "doc_id").filter("doc_id % 4 = 0").collect()
    assert np.mean([r.lang_pred == r.lang for r in found]) > 0.98
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "123 !!"), (4, "etaoin shrt")], "doc_id long, text string")
    assert [(r.lang_pred, r.score > 0) for r in identify_language(odd, model).orderBy("doc_id").collect()] == [("und", False)] * 3 + [("en", True)]
    assert [r.doc_id for r in drop_unidentified(odd, model).collect()] == [4]
    assert identify_language(none, model).count() == 0
    assert {r.lang_pred for r in identify_language(odd, train_language_model(docs.limit(0))).collect()} == {"und"}


def targets(sizes, weights=(5, 2, 1), total_share=1.5, most=2.0):
    """The rule as it is told, source by source."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, free, out = total_share * sum(sizes.values()), list(order), {}
    while free:
        unit = left / sum(weight[s] for s in free)
        above = [s for s in free if weight[s] * unit > most * sizes[s]]
        if not above:
            return out | {s: weight[s] * unit for s in free}
        for s in above:
            out[s] = most * sizes[s]
            left -= out[s]
        free = [s for s in free if s not in out]
    return out


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, None: 1000, "c": 0}, {f"s{i:03}": (i * 7919) % 1000 for i in range(300)}, {"x": 5}, {"é": 50, "z": 70, "": 8, "Z": 900}, {"a": 0}])
def test_targets_against_the_rule(spark, sizes):
    table = spark.createDataFrame(list(sizes.items()), "source string, words long")
    got = {r.source: r.target for r in source_targets(table).collect()}
    want = targets(sizes)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-6 for k in want)


def test_quotas_are_split_exactly():
    quotas = np.array([500, 0, 31, 7])
    leaves = list(split_quotas(quotas, 0, 6, 1))
    deal = np.array([q for *_, q in leaves])
    assert [(a, b) for a, b, _ in leaves] == [(i, i + 1) for i in range(6)]
    assert deal.shape == (6, 4) and (deal.sum(axis=0) == quotas).all() and (deal >= 0).all()
    assert deal.sum(axis=1).max() - deal.sum(axis=1).min() <= 2
    # In two goes the tree is the same.
    again = [leaf for low, high, q in split_quotas(quotas, 0, 6, 1, depth=1) for leaf in split_quotas(q, low, high, 1)]
    assert all((x[2] == y[2]).all() for x, y in zip(leaves, again, strict=True))
    mean = np.mean([next(split_quotas(np.array([80, 20]), 0, 10, k))[2] for k in range(400)], axis=0)
    assert abs(mean[0] - 8) < 0.3 and abs(mean[1] - 2) < 0.3


def test_mixing_against_targets(spark, docs, none):
    rows = [(i if i % 40 else None, "w " * (i % 17) + "x" * (i % 3), f"s{i % 3}" if i % 50 else None) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("shard", F.lit("other"))
    size = [len(t.split()) for _, t, _ in rows]
    plan = mixing_plan(df, block_docs=16).toPandas()
    assert len(plan) == 3000 and sorted(plan["size"]) == sorted(size)
    assert (plan.taken <= 2 * plan["size"]).all() and (plan.taken == plan.n_copies * plan["size"]).all()
    want = targets({s: sum(n for n, r in zip(size, rows, strict=True) if r[2] == s) for s in ("s0", "s1", "s2", None)})
    for source, g in plan.groupby(plan.source.fillna("")):
        assert abs(g.taken.sum() - want[source or None]) <= 18
        assert abs(g.target.iloc[0] - want[source or None]) < 1e-6
    again = mixing_plan(df.orderBy(F.desc("doc_id")), block_docs=16).toPandas()
    key = lambda p: sorted(zip(p.doc_id.fillna(-1), p["size"], p.taken, map(tuple, p.shards), strict=True))
    assert key(plan) == key(again)
    drawn = draw_mix(df, block_docs=16, shards=5).toPandas()
    assert len(drawn) == plan.n_copies.sum() and set(drawn.columns) == {"doc_id", "text", "source", "shard", "place"}
    assert set(drawn.shard) == set(range(5))
    blocks = drawn.groupby("shard").size()
    assert blocks.max() < 1.5 * blocks.min()
    copies = Counter(drawn.doc_id.dropna())
    assert all(copies[r.doc_id] == r.n_copies for r in plan.dropna(subset="doc_id").itertuples())
    # A block goes to a shard as a whole: the rows of one draw are together.
    assert mixing_plan(none).count() == 0 and draw_mix(none).count() == 0
    assert mixing_plan(docs).count() == docs.count()


def test_many_sources_and_shards(spark):
    df = spark.range(4000).selectExpr("id AS doc_id", "repeat('w ', int(1 + id % 5)) AS text", "concat('s', id % 700) AS source")
    plan = mixing_plan(df, block_docs=2, shards=150).toPandas()
    want = targets(plan.groupby("source")["size"].sum().to_dict())
    for source, g in plan.groupby("source"):
        assert abs(g.taken.sum() - want[source]) <= 5
    assert len({s for shards in plan.shards for s in shards}) > 140


ITEM = "When Alice walks 12 km in 3 hours and then Alice rests for 2 days, how far does Alice walk per hour today?"


def test_decontamination_templates_and_slots(spark, none):
    bench = spark.createDataFrame([(1, ITEM), (2, None), (None, ITEM), (3, "a b")], "item_id long, text string")
    rows = [
        (1, "intro text. When Robert walks 45 miles in 9 hours and then Robert rests for 7 days, how far does Robert walk per hour today? end"),
        (2, "intro text. When Robert walks 45 miles in 9 hours and then Susan rests for 7 days, how far does Peter walk per hour today? end"),
        (3, "nothing like it"), (4, None), (5, ""), (None, ITEM), (6, ITEM.upper()), (7, ITEM), (7, ITEM),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("item_id", F.lit(9))
    got = [(r.doc_id, r.contaminated) for r in contamination_report(docs, bench).collect()]
    assert len(got) == len(rows)
    assert {i for i, c in got if c} == {1, 7}
    assert sorted(str(r.doc_id) for r in drop_contaminated(docs, bench).collect()) == ["2", "3", "4", "5", "6"]
    assert contamination_report(none, bench).count() == 0
    assert contamination_report(docs, bench.limit(0)).filter("contaminated").count() == 0


def test_decontamination_of_short_items_ties_and_long_ones(spark):
    long = " ".join(f"{w}{chr(97 + i // 24)}" for i in range(600) for w in [WORDS[i % 24]])
    bench = spark.createDataFrame([(1, "Hello world"), (2, "42"), (3, "zz yy"), (3, ITEM), (4, long), (5, "")], "item_id long, text string")
    rows = [(1, "hello, World!"), (2, "say hello world now"), (3, " 42\n"), (4, "42 43"), (5, ITEM), (6, "zz yy"), (7, long), (8, "x " + " ".join(long.split()[:320])), (9, " ".join(long.split()[:200])), (10, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for any_case in (False, True):
        got = {(r.doc_id, r.item_id): (r.covered, r.n_windows) for r in contaminated_documents(docs, bench, any_case=any_case).collect()}
        assert got == {(1, 1): (1, 1), (2, 1): (1, 1), (3, 2): (1, 1), (4, 2): (1, 1), (5, 3): (got[5, 3][1],) * 2, (7, 4): (593, 593), (8, 4): (313, 593)}


def test_decontamination_shuffles_what_is_too_large_to_broadcast(spark):
    bench = spark.createDataFrame([(1, ITEM), (2, "Mr Smith, Jane Doe, New York, Old Town and Alan B Turing met Lady Ada in Big Bend")], "item_id long, text string")
    docs = spark.createDataFrame([(1, ITEM), (2, "so Mr Smith, Jane Doe, New York, Old Town and Alan B Turing met Lady Ada in Big Bend."), (3, "Mr Jones, Tom Roe, Old York, New Town and Carl C Gauss met Lord Bob in Low Land")], "doc_id long, text string")
    for rows in (0, 500_000):
        found = contaminated_documents(docs, bench, broadcast_rows=rows, any_case=True)
        assert {(r.doc_id, r.item_id) for r in found.collect()} == {(1, 1), (2, 2)}


def test_decontamination_in_any_case(spark):
    german = "die lange Straße führt, an Weiß und Schwarz vorbei, bis an das große Haus am Fluss"
    bench = spark.createDataFrame([(1, ITEM), (2, german)], "item_id long, text string")
    rows = [(1, ITEM.upper()), (2, "say, " + ITEM.title() + " Done."), (3, german.upper()), (4, ITEM.lower()), (5, "WHEN BOB WALKS " + ITEM[30:].upper().replace("ALICE", "BOB").replace("PER HOUR", "A DAY")), (6, None), (7, ITEM)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in contaminated_documents(docs, bench, any_case=True).collect()}
    assert got == {(1, 1), (2, 1), (3, 2), (4, 1), (7, 1)}
    assert sorted(r.doc_id for r in drop_contaminated(docs, bench, any_case=True).collect()) == [5, 6]


def test_decontamination_spoilt_slots_spoil_their_windows_only(spark):
    long = "the farmer has 2 apples and puts all of them into the old basket " + " ".join(WORDS) + " before he sells 2 pears to the man at the gate"
    bench = spark.createDataFrame([(1, long), (2, ITEM)], "item_id long, text string")
    rows = [(1, long), (2, long.replace("2 pears", "7 pears")), (3, long.replace("2 apples", "3 apples").replace("2 pears", "5 pears")), (4, ITEM.replace("Alice", "Bob", 1).replace("Alice rests", "Susan rests"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.item_id): r.n_windows - r.covered for r in contaminated_documents(docs, bench).collect()}
    assert set(got) == {(1, 1), (2, 1), (3, 1)}
    assert got[1, 1] == 0 and got[2, 1] == 8 and got[3, 1] == 12


def test_decontamination_of_items_that_are_mostly_values(spark):
    items = ["Compute 3 + 4 + 5 + 6", "What is 12 + 34 * 56?", "1 2 3 5 8 13 21 34 55 89 144 233", "Take 4 kg, 7 m, 9 km, 3 h and 12 lb. How many units are there in the list you were given here?", "1 2"]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    rows = [(i, f"so: {x} That is all 7 8 9") for i, x in enumerate(items)] + [(10, "Compute 3 + 4 + 5 + 7"), (11, "what is 12 + 34 * 57?"), (12, "1 2 3 5 8 14 21 34 55 89 145 233"), (13, items[3].replace("4", "5").replace("7", "8")), (14, "COMPUTE 3+4+5+6")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for any_case in (False, True):
        got = {(r.doc_id, r.item_id) for r in contaminated_documents(docs, bench, any_case=any_case).collect()}
        assert got == {(0, 0), (1, 1), (2, 2), (3, 3), (13, 3), (14, 0)}


def test_decontamination_against_brute_force(spark):
    rng = random.Random(8)
    word = lambda: rng.choice(WORDS) + "abcdefgh"[rng.randrange(8)]
    items = [[word() for _ in range(rng.randrange(10, 40))] for _ in range(12)]
    texts = []
    for i in range(150):
        words = [word() for _ in range(rng.randrange(0, 60))]
        if i % 3 == 0:
            item = items[i % len(items)]
            words[5:5] = item[: rng.randrange(4, len(item) + 1)]
        texts.append(words)
    windows = lambda w: {tuple(w[k : k + 8]) for k in range(len(w) - 7)}
    want = set()
    for i, words in enumerate(texts):
        for j, item in enumerate(items):
            own = [tuple(item[k : k + 8]) for k in range(len(item) - 7)]
            if 2 * sum(w in windows(words) for w in own) >= len(own):
                want.add((i, j))
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "doc_id long, text string")
    bench = spark.createDataFrame([(j, " ".join(w)) for j, w in enumerate(items)], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in contaminated_documents(docs, bench).collect()} == want
    assert want


def test_pipeline_stages_keep_their_contract(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(6)
    rows = documents(80, 9)
    bench = [(1, " ".join(rng.choice(WORDS) for _ in range(20)))]
    rows.append((9001, "lead in " + bench[0][1] + " and out", "en", "a"))
    # Rows that share an id, or have none, and differ otherwise.
    rows += [(9001, "clean words under the id of another", "en", "a"), (7, "words that no other text has at all", "en", "b"), (None, "a text without an id", "en", None), (None, "and one more of these", "fr", None), (None, "A TEXT without an id", "en", None)]
    spark.createDataFrame(rows, SCHEMA).withColumn("n_chars", F.length("text").cast("long")).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "exact dedup", "near-duplicate join", "decontamination", "mixing"]
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns = docs.columns
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = [(r.doc_id, r.text, r.source) for r in docs.collect()]
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        assert k == 4 or docs.columns == columns
        got = Counter(r.doc_id for r in docs.collect())
        want = BRUTE_STAGES[k](before)
        if k < 4:
            assert got == Counter(want), k
        else:
            assert set(got) <= {i for i, *_ in before}
            size = lambda t: len((t or "").split())
            sizes = {s: sum(size(t) for _, t, x in before if x == s) for s in {x for *_, x in before}}
            drawn = [(r.doc_id, r.text, r.source) for r in docs.collect()]
            assert set(drawn) <= set(before)
            taken = {s: sum(size(t) for _, t, x in drawn if x == s) for s in sizes}
            assert all(abs(taken[s] - t) <= 100 for s, t in targets(sizes).items())


def _brute_identified(rows):
    return [i for i, t, _ in rows if any(c.isalpha() for c in t or "")]


def _brute_distinct(rows):
    best = {}
    for i, t, _ in rows:
        x = (t or "").translate(LOW)
        best[x] = max(best.get(x, -1), -1 if i is None else i)
    return [None if i < 0 else i for i in best.values()]


def _brute_near(rows):
    sets, root = [shingles(t, 5) for _, t, _ in rows], list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    rank = lambda k: (rows[k][0] is None, rows[k][0] or 0, k)
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)), key=rank)
                root[y] = x
    return [rows[k][0] for k in range(len(rows)) if find(k) == k]


def _brute_clean(rows):
    return [i for i, t, _ in rows if not (t or "").startswith("lead in ")]


BRUTE_STAGES = [_brute_identified, _brute_distinct, _brute_near, _brute_clean, lambda rows: None]
