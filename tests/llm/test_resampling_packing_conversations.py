"""Importance resampling, packing and conversation repair against brute force, and rows that share ids in the pipeline's stages."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
import xxhash

from hockeylake.llm import conversations, importance, packing

FIRST_WORDS = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@pytest.mark.parametrize("length", [1, 3, 4, 7, 8, 11, 15, 16, 24, 31, 32, 33, 90])
def test_xxhash_of_rows(length):
    rows = np.random.default_rng(length).integers(0, 256, (7, length), dtype=np.uint8)
    assert [int(h) for h in importance.xxh64_rows(rows)] == [xxhash.xxh64_intdigest(r.tobytes()) for r in rows]


def test_equal_keys_are_told_apart_by_bytes(monkeypatch):
    """With one key for all the table still finds each n-gram's own slot."""
    monkeypatch.setattr(importance, "xxh64_rows", lambda rows: np.full(len(rows), 5, dtype=np.uint64))
    text = b"aa bb aa cc bb aa d"
    (table, slots, *_), = importance._interned(iter([text]), 1, 1, 100)
    found = [bytes(table.buffer[table.start[s] : table.start[s] + table.length[s]]) for s in slots]
    assert sorted(found) == sorted(text.split()) and table.count[slots].max() == 3


@pytest.mark.parametrize("least,most", [(1, 1), (1, 3), (2, 2)])
def test_ngrams_and_buckets(least, most):
    rng = random.Random(1)
    texts = [" ".join(rng.choice(["a", "Bc", "é", "x-y", "12", "ñu", "q" * 50, "\n"]) for _ in range(rng.randint(0, 40))).encode() for _ in range(60)] + [b"", b"\n", b"a"]
    for table, slots, text, words in importance._interned(iter(texts), least, most, 1000):
        for i, said in enumerate(texts):
            own = FIRST_WORDS.findall(bytes(b + 32 if 65 <= b <= 90 else b for b in said))
            wanted = sorted(b" ".join(own[k : k + n]) for n in range(least, most + 1) for k in range(len(own) - n + 1))
            assert sorted(bytes(table.buffer[table.start[s] : table.start[s] + table.length[s]]) for s in slots[text == i]) == wanted
            assert words[i] == len(own)
        assert all(table.bucket[s] == zlib.crc32(bytes(table.buffer[table.start[s] : table.start[s] + table.length[s]])) % 1000 for s in set(slots.tolist()))


def test_resampling_equals_brute_force(spark):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(40)]
    rows = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 60))), "x") for i in range(120)] + [(7, "w1 " * 30, "x"), (None, "w1 " * 30, "x"), (500, None, "x"), (501, "", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words string")
    target = spark.createDataFrame([(1, "w1 w2 w3 w1"), (2, None)], "item_id long, text string")
    got = importance.importance_resample(docs, target, least=1, most=2, buckets=50, min_words=20, percent=10).collect()
    grams = lambda t: [" ".join(w[k : k + n]) for w in [(t or "").split()] for n in (1, 2) for k in range(len(w) - n + 1)]
    bucket = lambda g: zlib.crc32(g.encode()) % 50
    have, want = ([bucket(g) for t in texts for g in grams(t)] for texts in ([r[1] for r in rows], ["w1 w2 w3 w1", None]))
    gain = {b: math.floor(1000 * math.log((want.count(b) + 1) * (len(have) + 50) / ((have.count(b) + 1) * (len(want) + 50)))) for b in range(50)}
    wanted = []
    for i, text, _ in rows:
        own = [gain[bucket(g)] for g in grams(text)]
        weight = math.floor(sum(own) / len(own)) if own else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        wanted.append((i, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len((text or "").split())))
    key = lambda r: (r[0] is None, r[0] or 0, r[3])
    assert sorted(((r.doc_id, r.n_features, r.weight, r.score) for r in got), key=key) == sorted((r[:4] for r in wanted), key=key)
    able = sorted((-r[3], r[0] is None, r[0] or 0) for r in wanted if r[4] >= 20)
    drawn = sorted((r.rank, -r.score, r.doc_id is None, r.doc_id or 0) for r in got if r.rank is not None)
    assert [d[0] for d in drawn] == list(range(1, len(able) // 10 + 1))
    assert [d[1:] for d in drawn] == able[: len(able) // 10]
    assert importance.importance_resample(docs.limit(0), target).count() == 0


def test_cuts_equal_brute_force():
    rng = random.Random(3)
    for _ in range(200):
        window, n, at = rng.choice([8, 12, 16]), rng.randint(1, 30), 0
        places = []
        for _ in range(n):
            at += rng.randint(1, window if rng.random() < 0.2 else 4)
            places.append(at)
        penalties = [rng.choice([0, 2, 5]) for _ in places]
        cost, ends = packing.choose_cuts(np.array(places), np.array(penalties), window, each=1)
        every, least = [0, *places], [0]
        for j in range(1, n + 1):
            least.append(penalties[j - 1] + 1 + min(least[i] + packing.padding(every[j] - every[i], window) for i in range(j) if every[j] - every[i] <= window))
        assert cost == least[-1] and ends[-1] == places[-1]
        told, start = 0, 0
        for end in ends:
            told, start = told + 1 + packing.padding(end - start, window) + penalties[places.index(end)], end
        assert told == cost


@pytest.fixture(scope="module")
def vocabulary():
    tokenizers = pytest.importorskip("public_tokenizers")
    return str(tokenizers.path("word_bpe_49k.json"))


def test_pieces_are_the_librarys_ids(vocabulary):
    from tokenizers import Tokenizer

    whole, mine, rng = Tokenizer.from_file(vocabulary), packing.Encoder(vocabulary, 2), random.Random(2)
    parts = ["a", "B", "é", "Ö", "é", "'s", "'LL", "1", "²", "ß", "İ", "Σ", "ς", "<|endoftext|>", "<|", " ", " ", "!", "…", "_", "ﬁ", "日本", "😀", "‍", "µ", "×", "ſ", "\x00", "\x1c", "\x85", "don't"]
    words = ["".join(rng.choices(parts, k=rng.randint(1, 6))) for _ in range(5000)]
    for at in range(0, len(words), 25):
        text = " ".join(words[at : at + 25])
        assert mine.encode([(text.encode(), True)])[0].tolist() == [*whole.encode(text, add_special_tokens=False).ids, 2]


def test_packing_round_trip(spark, vocabulary, monkeypatch):
    from tokenizers import Tokenizer

    rng = random.Random(8)
    text = lambda n: " ".join(rng.choice(["the", "Puck", "slides.", "ice!", "été", "unbreakableword", "\n"]) for _ in range(n))
    rows = [(i, text(rng.choice([0, 3, 50, 400]))) for i in range(60)] + [(100, text(60_000)), (101, None), (102, ""), (None, "a b"), (5, "again"), (5, "again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    for block in (1 << 20, 5000):
        monkeypatch.setattr(packing, "_BLOCK", block)
        monkeypatch.setattr(packing, "_SEGMENT", 20_000)
        got = packing.pack_documents(docs, vocabulary, window=512).toPandas()
        encode = lambda t: np.array([*Tokenizer.from_file(vocabulary).encode(t or "", add_special_tokens=False).ids, 2], dtype="<u4")
        for doc_id, said in rows[:3] + rows[60:63]:
            ids, at = encode(said), 0
            for r in got[got.doc_id == doc_id].sort_values("start").itertuples():
                assert (r.start, r.doc_tokens) == (at, len(ids)) and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
                at += r.length
            assert at == len(ids)
        assert got[got.doc_id == 5].length.sum() >= 4 and got.doc_id.isna().sum() >= 1
        spaces = 0
        for _, g in got.groupby("sequence_id"):
            g = g.sort_values("offset")
            assert g.offset.tolist() == [0, *np.cumsum(g.length)[:-1]] and g.length.sum() <= 512
            spaces += packing.padding(int(g.length.sum()), 512)
        assert spaces < 0.03 * got.length.sum()
    assert packing.pack_documents(docs.limit(0), vocabulary).count() == 0


def _brute(codes):
    best = None
    for length in (m for m in range(2 * len(codes) + 6) if m != 1):
        wanted, memo = conversations.target(length), {}

        def least(i, j):
            if (i, j) not in memo:
                found = [(0, "")] if i == len(codes) and j == length else []
                if j < length and wanted[j] != "s" and (x := least(i, j + 1)):
                    found.append((x[0] + 3, "I" + x[1]))
                if i < len(codes):
                    if x := least(i + 1, j):
                        found.append((x[0] + 4, "D" + x[1]))
                    if j < length and codes[i] & 12 != 4:
                        same = "sua."[codes[i] & 3] == wanted[j]
                        if (same or wanted[j] != "s") and (x := least(i + 1, j + 1)):
                            found.append((x[0] + (0 if same else 3) + (3 if codes[i] & 12 == 8 else 0), ("K" if same else "R") + x[1]))
                memo[i, j] = min(found) if found else None
            return memo[i, j]

        if (x := least(0, 0)) and (best is None or x < best):
            best = x
    return best


def test_alignments_equal_brute_force():
    rng = random.Random(5)
    for _ in range(400):
        codes = bytes(rng.choice([0, 1, 2, 1, 2, 3]) + rng.choice([0, 0, 0, 4, 8]) for _ in range(rng.randint(0, 8)))
        assert conversations.repair(codes) == conversations.repair_long(codes) == _brute(codes)
    codes = bytes(rng.choice([1, 2]) + rng.choice([0, 0, 0, 4, 8]) for _ in range(48))
    assert conversations.repair(codes) == conversations.repair_long(codes)


def test_long_conversations_equal_short_ones(spark):
    rng = random.Random(9)
    rows = [(c, rng.choice([None, t, t, t]), rng.choice(["user", "assistant", "system", None]), rng.choice(["Yes.", "no", "", None, "What?\n"])) for c in (1, 2, None) for t in range(rng.randint(150, 220))]
    rows += [(3, 0, "user", "Hi."), (3, 1, "assistant", "Ho."), (4, None, None, None), (5, 9, "assistant", "x" * 200_000 + ".")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    short, long = (sorted(map(tuple, conversations.repair_conversations(turns, **how).collect()), key=str) for how in ({"aligned": 20}, {"aligned": 20, "block": 16}))
    assert short == long and len(short) == 6
    told = {r[0]: r for r in short}
    assert told[3][1:8] == (0, 0, 0, 0, 0, 0, "KK") and told[4][1:8] == (0, 1, 0, 0, 0, 4, "D")
    assert told[5][8] == hashlib.sha256(("user:\nassistant:" + "x" * 200_000 + ".").encode()).hexdigest() and told[5][7] == "IK"
    assert conversations.repair_conversations(turns.limit(0)).count() == 0


def test_conversation_that_is_dropped_whole(spark):
    turn = next(t for t in range(1000) if zlib.crc32(f"7:{t}".encode()) % 20 == 0)
    row = conversations.repair_conversations(spark.createDataFrame([(7, turn, "user", "Hi.")], "conv_id long, turn long, role string, text string"), damaged=conversations.damage).first()
    assert tuple(row) == (7, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_rows_that_share_an_id_are_told_apart(spark):
    from hockeylake.llm.decontaminate import contaminated_documents, drop_contaminated
    from hockeylake.llm.exact_dedup import drop_exact_duplicates
    from hockeylake.llm.ngram_join import drop_near_duplicates

    docs = spark.createDataFrame([(1, "a b c"), (1, "unique text"), (2, "a b c"), (3, "zz"), (3, "zz"), (None, "n"), (None, "n"), (None, "zz")], "doc_id long, text string")
    assert sorted(map(str, drop_exact_duplicates(docs).collect())) == sorted(map(str, spark.createDataFrame([(1, "unique text"), (2, "a b c"), (3, "zz"), (None, "n")], docs.schema).collect()))
    long = " ".join(f"w{i}" for i in range(60))
    near = spark.createDataFrame([(0, long), (1, long + " end"), (1, "another thing altogether that stays here"), (7, ""), (7, ""), (None, long)], docs.schema)
    assert sorted((r.doc_id, r.text[:7]) for r in drop_near_duplicates(near).collect()) == [(0, "w0 w1 w"), (1, "another"), (7, ""), (7, "")]
    items = spark.createDataFrame([(1, "photosynthesis"), (2, "Quantum chromodynamics")], "item_id long, text string")
    texts = spark.createDataFrame([(1, "so here is the question: photosynthesis and then more"), (1, "clean"), (2, "a b c Quantum chromodynamics d e f"), (4, "quantum foam"), (None, "a Photosynthesis b")], docs.schema)
    assert sorted((r.doc_id, r.item_id) for r in contaminated_documents(texts, items).collect()) == [(1, 1), (2, 2)]
    assert sorted((r.doc_id, r.text) for r in drop_contaminated(texts, items, any_case=True).collect()) == [(1, "clean"), (4, "quantum foam")]


def test_mix_of_rows_that_repeat(spark):
    from pyspark.sql import functions as F

    from hockeylake.llm.mixing import draw_mix, mixing_plan

    ten = "a b c d e f g h i j"
    rows = [(1, ten, "c")] * 2000 + [(10 + i, ten, "c") for i in range(1000)] + [(5000 + i, ten, "a") for i in range(3000)] + [(9000 + i, ten, "b") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan = mixing_plan(docs)
    told = {r.source: r for r in plan.groupBy("source").agg(F.first("target").alias("target"), F.sum("taken").alias("taken"), F.max(F.col("taken") / F.col("size")).alias("most")).collect()}
    assert all(abs(r.taken - r.target) <= 10 and r.most <= 2 for r in told.values()) and told["c"].target == 25_000
    assert sorted(map(str, plan.collect())) == sorted(map(str, mixing_plan(docs.repartition(5)).collect()))
    assert {r.source: 10 * r["count"] for r in draw_mix(docs).groupBy("source").count().collect()} == {k: r.taken for k, r in told.items()}


def _record(kind: str, name: str, more: str, block: bytes) -> bytes:
    return f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:page:{name}>\r\n{more}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def test_foreign_records_are_gaps_or_records():
    from hockeylake.llm.warc import salvage

    block = b"HTTP/1.1 200 OK\r\n\r\nabc"
    assert [w for *_, w in salvage(_record("revisit", "1", "", b"HTTP/1.1 200\r\nContent-Length: abc\r\n\r\n"))] == ["no payload length"]
    for name in ("²", "--5", "9" * 30):
        (_, _, record, _), = salvage(_record("response", name, "", block))
        assert record["page_id"] is None and record["payload"] == b"abc"
    assert [w for *_, w in salvage(_record("response", "1", "WARC-Payload-Digest: sha1:AAAA\r\n", block))] == ["payload digest differs"]
    (_, _, record, _), = salvage(_record("response", "1", "WARC-Payload-Digest: sha1:VGMT4NSHA2AWVOR6EVYXQUGCNSONBWE5\r\n", block))
    assert record["page_id"] == 1


def test_mutated_archives_are_accounted_for_to_the_byte():
    import gzip

    from hockeylake.llm.warc import salvage

    whole = b"".join(gzip.compress(r) if i % 2 else r for i, r in enumerate(_record("response", str(i), "", b"HTTP/1.1 200\r\n\r\n" + bytes(random.Random(i).choices(b"abc <>", k=200))) for i in range(6)))
    rng = random.Random(1)
    for _ in range(1000):
        data = bytearray(whole)
        for _ in range(rng.randint(1, 6)):
            at = rng.randrange(len(data))
            if rng.random() < 0.6:
                data[at] = rng.randrange(256)
            else:
                del data[at : at + rng.randint(1, 40)]
        assert sum(n for _, n, _, _ in salvage(bytes(data))) == len(data)


def test_false_length_is_not_held():
    import gzip
    import tracemalloc

    from hockeylake.llm.warc import salvage

    record = _record("response", "1", "", b"H\r\n\r\n" + b"0" * 200).replace(b"Content-Length: 205", b"Content-Length: 99000000")
    data = gzip.compress(record + b"\0" * 120_000_000, 1)
    tracemalloc.start()
    gaps = list(salvage(data))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [(n, w) for _, n, _, w in gaps] == [(len(data), "content length is wrong")] and peak < 16 << 20


def test_shortest_address(spark):
    from hockeylake.llm.pii import pseudonymise

    row = pseudonymise(spark.createDataFrame([(1, "a@b.co")], "doc_id long, text string"), key="k", kinds=("email",)).first()
    assert row.n_found == 1 and row.text != "a@b.co" and row.text.endswith("@b.co")


def test_more_languages_than_the_model_may_hold(spark):
    from hockeylake.llm.language_id import train_language_model

    docs = spark.createDataFrame([(f"text number {i}", f"l{i % 3}") for i in range(30)], "text string, lang string")
    assert train_language_model(docs).langs == ["l0", "l1", "l2"]
    with pytest.raises(ValueError, match="more than 2 languages"):
        train_language_model(docs, most_langs=2)


def test_penalty_moves_scores_of_neutral_mentions(spark):
    """Toxic texts happen to name one group: with the penalty a neutral mention of it scores like one of another group."""
    from hockeylake.llm.toxicity import IDENTITY_TERMS, score_toxicity, train_toxicity_model

    one, other = IDENTITY_TERMS[0][0], IDENTITY_TERMS[0][1]
    rows = [(i, f"{one} people are awful idiots number {i}" if i % 2 else f"what a lovely quiet day number {i}", i % 2) for i in range(400)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    probe = spark.createDataFrame([(1, f"my {one} friend came for tea"), (2, f"my {other} friend came for tea")], "doc_id long, text string")
    gaps = {}
    for penalty in (0.0, 4.0):
        score = {r.doc_id: r.score for r in score_toxicity(probe, train_toxicity_model(docs, labels, penalty=penalty, l1=0.01)).collect()}
        gaps[penalty] = score[1] - score[2]
    assert gaps[0.0] > 0.02 and abs(gaps[4.0]) < 0.5 * gaps[0.0]
