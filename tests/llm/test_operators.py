"""Each operator against brute force or the library, over awkward rows and over an empty table."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from factloom.llm import op1_quality, op2_ngram_join, op3_toxicity, op4_tokens, op5_warc, op6_packing, op7_line_dedup, op8_embeddings, op9_suffix_dedup, op10_bpe
from factloom.llm.components import connected_components
from factloom.llm.triejoin import join_group
from tests.llm.helpers import awkward, components, documents, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BPE_JSON, BPE_RANKS, WORD_JSON = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "word_bpe_49k.json"))


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark, awkward()).cache()


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def base_measures(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    counts = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if counts[w] > 1 for j in range(8)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_quality(docs, empty):
    got = op1_quality.quality(docs).collect()
    texts = dict(awkward())
    assert len(got) == len(awkward())
    for r in got:
        n = base_measures(texts[r["doc_id"]])
        assert tuple(r)[1:6] == n, r
        assert r["base_failed"] == (n[0] < 20 or 100 * n[4] > 30 * n[0])
        assert not (r["base_failed"] and r["kept"])
    assert op1_quality.quality(empty).count() == 0
    kept = op1_quality.kept_documents(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(r["doc_id"] for r in got if r["kept"])


def test_quality_host_verdicts(spark):
    good, bad = prose(1, 50), "## " * 40 + prose(2, 10)
    rows = [(i, bad, "en", "bad", 0) for i in range(60)] + [(60, good, "en", "bad", 0)] + [(100 + i, good, "en", "good", 0) for i in range(200)] + [(900, bad, "en", "good", 0), (901, good, "en", None, 0)]
    out = {r["doc_id"]: r["kept"] for r in op1_quality.quality(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")).collect()}
    assert not out[60] and not out[0], "a host with hardly a sound document is rejected as a whole"
    assert out[100] and out[901]


@pytest.mark.parametrize("words,num,block", [(3, 90, 250_000), (5, 80, 250_000), (3, 90, 100)])
def test_ngram_join(docs, empty, words, num, block):
    sets = {}
    for i, t in awkward():
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[j : j + words]) for j in range(max(1, len(w) - words + 1))} if w else set()
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])]
    comps = components(sets, links)
    got = op2_ngram_join.near_duplicates(docs, words, num, 100, block)
    assert rows_of(got) == sorted(((i, len(sets[i]), comps[i]) for i, _ in awkward()), key=str)
    assert op2_ngram_join.near_duplicates(empty, words, num, 100).count() == 0


def test_trie_join_against_pairs():
    for seed in range(60):
        r = random.Random(seed)
        base = [r.randrange(10**9) for _ in range(r.choice([5, 12, 40]))]
        sets = set()
        for _ in range(r.randrange(1, 30)):
            s = set(base[: r.randrange(1, len(base) + 1)]) if r.random() < 0.3 else set(base)
            for _ in range(r.randrange(0, 6)):
                s.symmetric_difference_update({r.choice(base) if r.random() < 0.5 else r.randrange(10**9)})
            if s:
                sets.add(frozenset(s))
        sets = [np.array(sorted(s), np.int64) for s in sets]
        for num in (50, 80, 90):
            links = [(i, j) for i in range(len(sets)) for j in range(i) if 100 * len(np.intersect1d(sets[i], sets[j])) >= num * len(np.union1d(sets[i], sets[j]))]
            assert components(range(len(sets)), links) == components(range(len(sets)), join_group(sets, num, 100))


def test_components(spark):
    r = random.Random(5)
    links = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(r.randrange(200, 300), r.randrange(200, 300)) for _ in range(60)] + [(500, 500)]
    got = connected_components(spark.createDataFrame(links, "a long, b long"))
    assert dict(map(tuple, got.collect())) == components({x for e in links for x in e}, links)
    for small in (0, 5):
        got = connected_components(spark.createDataFrame(links, "a long, b long"), small)
        assert dict(map(tuple, got.collect())) == components({x for e in links for x in e}, links)
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_toxicity(spark, empty):
    r = random.Random(3)
    rows, labels = [], []
    for i in range(900):
        words = prose(i, 80).split(" ")
        toxic = i % 4 == 0
        if toxic:
            for _ in range(4):
                words[r.randrange(80)] = r.choice(["vilewort", "grubmaw", "snarkle"])
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    rows += [(5000, None), (5001, "")]
    labels += [(None, 1, 1), (7000, None, None)]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = {x["doc_id"]: x for x in op3_toxicity.toxicity(documents(spark, rows), table).collect()}
    held = [i for i in range(900) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(out[i]["held_out"] == (i in set(held)) for i in range(900))
    right = sum(out[i]["predicted"] == (i % 4 == 0) for i in held)
    assert right >= 0.98 * len(held)
    assert out[5000]["predicted"] == out[5001]["predicted"] == 0 and 0 <= out[5000]["score"] <= 1
    assert out[0]["n_passages"] >= 1
    assert op3_toxicity.toxicity(empty, table).count() == 0
    assert {x["score"] for x in op3_toxicity.toxicity(documents(spark, rows[:3]), table.where("false")).collect()} == {0.0}


def plain_segments(scores, start=0):
    """Maximal scoring segments by their definition: the best segment, then the same to its left and to its right."""
    best = None
    for i in range(len(scores)):
        total = 0.0
        for j in range(i, len(scores)):
            total += scores[j]
            if total > 0 and (best is None or total > best[0]):
                best = (total, i, j)
    if best is None:
        return []
    total, i, j = best
    return plain_segments(scores[:i], start) + [(start + i, start + j, total)] + plain_segments(scores[j + 1 :], start + j + 1)


def test_maximal_segments():
    # Scores 4 -5 3 -3 1 2 -2 2 -2 1 5, of the article: segments 4; 3; 1 2 -2 2 -2 1 5.
    at, scores = [0, 2], [4.0, 3.0]
    assert op3_toxicity.maximal_segments(at, scores, 5.0) == [(0, 0, 4.0), (2, 2, 3.0)]
    assert op3_toxicity.maximal_segments(at, scores, 1.0) == [(0, 2, 6.0)]
    for seed in range(300):
        r = random.Random(seed)
        n = r.randrange(1, 40)
        drift = r.uniform(0.1, 2.0)
        line = [r.uniform(0.01, 3) if r.random() < 0.4 else -drift for _ in range(n)]
        at = [i for i, x in enumerate(line) if x > 0]
        got = op3_toxicity.maximal_segments(at, [line[i] for i in at], drift)
        expected = plain_segments(line)
        assert [x[:2] for x in got] == [x[:2] for x in expected]
        assert all(abs(a[2] - b[2]) < 1e-9 for a, b in zip(got, expected, strict=True))


def test_maximal_segments_take_linear_time():
    import time

    r = random.Random(1)
    took = []
    for n in (20_000, 200_000):
        at, scores = list(range(0, 100 * n, 100)), [r.uniform(0.5, 3) for _ in range(n)]
        began = time.process_time()
        op3_toxicity.maximal_segments(at, scores, 0.15)
        took.append(time.process_time() - began)
    assert took[1] < 30 * max(took[0], 0.01)


def test_toxic_passages_of_very_long_texts(spark):
    lexicon = op3_toxicity.Lexicon(np.sort(op3_toxicity.words(__import__("pyarrow").array(["vile"]), between=op3_toxicity.BETWEEN)[0]), np.array([4.0]), 0.15, 1.0)
    text = "fine " * 60_000 + "vile vile vile " + "fine " * 60_000 + "vile"
    rows = documents(spark, [(1, text), (2, None), (3, ""), (1, "vile")])
    got = {(r["doc_id"], r["n_tokens"]): [(p["first"], p["last"]) for p in r["passages"]] for r in op3_toxicity.segments(rows, lexicon).collect()}
    assert got == {(1, 120_004): [(60_000, 60_002), (120_003, 120_003)], (2, 0): [], (3, 0): [], (1, 1): [(0, 0)]} or got[(1, 120_004)][0] == (60_000, 60_002)


def odd_texts():
    return [t or "" for _, t in awkward()] + ["<|endoftext|> hi <|endoftext|>x", "a  b \n c\t\td ", "don't  we'll 123abc", "ß Σς ΑΣ é", "\x1c a\x1cb \x85 c d", "x " * 700, "$$$ ### 'S don'T"]


def test_token_counts(spark, empty):
    from tokenizers import Tokenizer

    texts = odd_texts()
    expected = [len(e.ids) for e in Tokenizer.from_file(BPE_JSON).encode_batch(texts, add_special_tokens=False)]
    got = op4_tokens.token_counts(documents(spark, list(enumerate(texts))), BPE_JSON, 200)
    assert rows_of(got) == sorted(((i, len(t.encode()), n, n > 200) for i, (t, n) in enumerate(zip(texts, expected, strict=True))), key=str)
    assert op4_tokens.token_counts(empty, BPE_JSON).count() == 0
    assert op4_tokens.token_counts(documents(spark, [(1, None)]), BPE_JSON).first()[1:] == (0, 0, False)


def test_byte_bpe(spark, empty):
    import tiktoken

    texts = odd_texts()
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=op10_bpe.load(BPE_RANKS).ranks, special_tokens={})
    got = {r["doc_id"]: r for r in op10_bpe.encode_and_decode(documents(spark, list(enumerate(texts))), BPE_RANKS, public_tokenizers.PATTERN).collect()}
    for i, t in enumerate(texts):
        ids = encoding.encode_ordinary(t)
        assert bytes(got[i]["ids"]) == np.array(ids, "<u4").tobytes() and bytes(got[i]["decoded"]) == t.encode() and got[i]["n_tokens"] == len(ids)
    assert op10_bpe.encode_digests(empty, BPE_RANKS, public_tokenizers.PATTERN).count() == 0
    replay = op10_bpe.load(BPE_RANKS)
    pieces = [p.encode() for p in ("aaaaaaa", "abababab", " the", "xyzzyqqq", "ééé")]
    assert [np.frombuffer(x, "<u4").tolist() for x in replay.encode(pieces)] == [replay.one(p) for p in pieces]


def test_packing(spark, empty):
    from tokenizers import Tokenizer

    texts = odd_texts()
    tokenizer = Tokenizer.from_file(WORD_JSON)
    ids = [tokenizer.encode(t, add_special_tokens=False).ids + [1] for t in texts]
    window = 64
    pieces = op6_packing.pack(documents(spark, list(enumerate(texts))), WORD_JSON, window=window).collect()
    seen = {i: [0] * len(x) for i, x in enumerate(ids)}
    by_sequence = {}
    for p in pieces:
        part = ids[p["doc_id"]][p["start"] : p["start"] + p["length"]]
        assert zlib.crc32(np.array(part, "<u4").tobytes()) == p["ids_crc32"] and p["doc_tokens"] == len(ids[p["doc_id"]])
        for k in range(p["start"], p["start"] + p["length"]):
            seen[p["doc_id"]][k] += 1
        by_sequence.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    assert all(set(x) == {1} for x in seen.values())
    for places in by_sequence.values():
        places.sort()
        ends = [0, *(o + n for o, n in places)]
        assert [o for o, _ in places] == ends[:-1] and ends[-1] <= window
    assert op6_packing.pack(empty, WORD_JSON).count() == 0


def test_best_fit_against_plain():
    r = random.Random(1)
    for _ in range(50):
        lengths = [r.randrange(1, 33) for _ in range(r.randrange(1, 60))]
        where, offset = op6_packing.best_fit_decreasing(lengths, 32)
        rooms = []
        for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
            fits = [(room, w) for w, room in enumerate(rooms) if room >= lengths[i]]
            assert where[i] == len(rooms) if not fits else rooms[where[i]] == min(fits)[0]
            if not fits:
                rooms.append(32)
            assert offset[i] == 32 - rooms[where[i]]
            rooms[where[i]] -= lengths[i]


def test_warc(spark):
    big = "é" * 1500
    rows = [(1, "http://a/1", "short"), (2, "http://a/2", "short"), (3, "http://a\r\n/3", big), (4, None, big), (5, "u", None), (6, "u", "x" * 50_000), (7, "u", big + "\r\n\r\nWARC/1.1\r\n"), (4, None, big), (None, "u", "y" * 2000), (8, "u", "")]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, digest string")
    expected = []
    for i, _, html in rows:
        body = (html or "").encode()
        target = max((j for j, _, h in rows if h == html and j is not None), default=None) if len(body) >= 1000 and i is not None else None
        revisit = target is not None and target != i
        expected.append((i, len(body), hashlib.sha1(body).hexdigest(), "revisit" if revisit else "response", target if revisit else None))
    assert rows_of(op5_warc.round_trip(pages, segment_bytes=700, chunk_bytes=100, file_records=3)) == sorted(expected, key=str)
    assert op5_warc.round_trip(pages.where("false")).count() == 0


def test_warc_parts():
    for payload in (b"", b"a", b"x" * 9999, bytes(range(256)) * 9):
        assert op5_warc.unchunked(op5_warc.chunked(payload, 100)) == payload
    import io

    whole = op5_warc.record({"WARC-Type": "x"}, b"a\r\n\r\nb") + b"\r\n\r\n"
    assert [x for _, x in op5_warc.walk(io.BytesIO(whole * 2))] == [b"a\r\n\r\nb"] * 2
    for broken in (b"x" + whole, whole[:-1], whole[:12], whole.replace(b"Length: 6", b"Length: 5")):
        with pytest.raises(ValueError):
            list(op5_warc.walk(io.BytesIO(broken)))
    with pytest.raises(ValueError):
        op5_warc.unchunked(b"3\r\nabcd\r\n0\r\n\r\n")


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, old[j] + 1, old[j - 1] + (x != y)))
    return row[-1]


def test_edit_distance():
    r = random.Random(1)
    for _ in range(3000):
        a = bytes(r.choice(b"ab") for _ in range(r.randrange(9)))
        b = bytearray(a)
        for _ in range(r.randrange(4)):
            at = r.randrange(len(b) + 1)
            b[at : at + r.randrange(2)] = r.choice([b"", b"a", b"c"])
        for limit in (1, 2, 3):
            assert op7_line_dedup.within(a, bytes(b), limit) == (edit_distance(a, b) <= limit)
            assert op7_line_dedup.banded_distance(a, bytes(b), limit) == min(limit + 1, edit_distance(a, b))


def test_edit_distance_of_many_pairs():
    r = random.Random(3)
    for _ in range(60):
        letters = r.choice([b"ab", b"abc", bytes(range(97, 123))])
        bodies = [bytes(r.choice(letters) for _ in range(r.choice([1, 2, 5, 12, 40, 70])))]
        for _ in range(8):
            x = bytearray(bodies[0])
            for _ in range(r.randrange(6)):
                at = r.randrange(len(x) + 1)
                x[at : at + r.randrange(2)] = r.choice([b"", b"a", b"z", b"ab", b"\x00"])
            if x:
                bodies.append(bytes(x))
        i, j = np.triu_indices(len(bodies), 1)
        d = np.array([edit_distance(bodies[a], bodies[b]) for a, b in zip(i, j, strict=True)])
        for limit in (0, 1, 2, 3, 5, 9, 31):
            assert (op7_line_dedup.near_pairs(bodies, i, j, limit) == (d <= limit)).all()
            side = [k % 2 == 0 for k in range(len(bodies))]
            links = [(a, b) for a, b, x in zip(i.tolist(), j.tolist(), d.tolist(), strict=True) if x <= limit]
            names = range(len(bodies))
            assert components(names, op7_line_dedup.links_of(list(names), bodies, [None] * len(bodies), limit)) == components(names, links)
            across = [(a, b) for a, b in links if side[a] != side[b]]
            assert components(names, op7_line_dedup.links_of(list(names), bodies, side, limit)) == components(names, across)


@pytest.mark.parametrize("limit", [1, 2])
def test_line_dedup(spark, empty, limit):
    r = random.Random(limit)
    base = [prose(50 + i, 9) for i in range(6)]
    rows = []
    for i in range(40):
        lines = []
        for _ in range(r.randrange(1, 6)):
            x = list(r.choice(base))
            for _ in range(r.randrange(4)):
                x[r.randrange(len(x))] = r.choice("xyz")
            lines.append("".join(x) + r.choice(["", "", "!"]))
        rows.append((i, "\n".join(lines + ["short", ""])))
    rows += [(100, None), (101, ""), (102, "\n\n")]
    spots = [(i, n, x.encode()) for i, t in rows if t is not None for n, x in enumerate(t.split("\n")) if len(x.encode()) >= 20]
    distinct = sorted({b for _, _, b in spots})
    comps = components(distinct, [(a, b) for a in distinct for b in distinct if a < b and edit_distance(a, b) <= limit])
    first = {}
    for i, n, b in sorted(spots):
        first.setdefault(comps[b], (i, n))
    gone = {(i, n) for i, n, b in spots if first[comps[b]] != (i, n)}
    docs = documents(spark, rows)
    assert {tuple(x) for x in op7_line_dedup.repeated_lines(docs, 20, limit).collect()} == gone
    out = op7_line_dedup.deduplicated(docs, 20, limit)
    assert out.columns == docs.columns
    texts = {x["doc_id"]: x["text"] for x in out.collect()}
    for i, t in rows:
        kept = None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if (i, n) not in gone)
        assert texts.get(i) == kept or (i not in texts and not WORD.search(kept))
    assert texts[101] == "" and 102 in texts
    assert op7_line_dedup.line_digests(empty).count() == 0


def test_line_dedup_takes_short_lines(spark):
    docs = documents(spark, [(1, "Un.\nOf.\n\n \nThe little fox jumps over"), (2, "Of.\n\n \nthe little fox jumps over\nUn"), (3, "Of.\nUn.\n\u00a0")])
    assert {tuple(x) for x in op7_line_dedup.repeated_lines(docs).collect()} == {(2, 0), (2, 3), (3, 0), (3, 1)}


def test_line_limit_follows_the_length(spark, monkeypatch):
    r = random.Random(5)
    base = ["".join(r.choice("abcdefgh ") for _ in range(n)) for n in (19, 30, 45, 90, 98, 103, 130, 250, 420, 900)]
    lines = list(base)
    for b in base:
        for share in (1, 2, 3, 3, 4, 5):
            x = list(b)
            for _ in range(max(1, len(b) * share // 100)):
                at = r.randrange(len(x))
                x[at : at + r.randrange(2)] = r.choice(["", "z", "y", "xx"])
            lines.append("".join(x))
    bodies = sorted({x.encode() for x in lines if x.strip()})
    limit = {b: int(op7_line_dedup.limits(np.array([len(b)]), None)[0]) for b in bodies}
    comps = components(bodies, [(a, b) for a in bodies for b in bodies if a < b and abs(len(a) - len(b)) <= 40 and edit_distance(a, b) <= min(limit[a], limit[b])])
    rows = [(i, x) for i, x in enumerate(lines)]
    first = {}
    for i, x in rows:
        first.setdefault(comps[x.encode()], i)
    gone = {(i, 0) for i, x in rows if first[comps[x.encode()]] != i}
    assert len({len(lines[i]) for i, _ in gone}) > 12
    assert {tuple(x) for x in op7_line_dedup.repeated_lines(documents(spark, rows)).collect()} == gone
    monkeypatch.setattr(op7_line_dedup, "HOT", 2)  # nearly all keys are met by aggregation
    assert {tuple(x) for x in op7_line_dedup.repeated_lines(documents(spark, rows)).collect()} == gone


def test_embeddings(spark):
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((4, 64))
    rows = []
    for i in range(240):
        v = centres[i % 4] + 0.15 * rng.standard_normal(64) if i % 3 else rng.standard_normal(64)
        rows.append((i, v.astype("float32").tolist(), i % 2))
    rows += [(300 + i, rows[1][1], 1) for i in range(5)] + [(400, None, 1), (401, [0.0] * 64, 1), (402, [float("nan")] * 64, 1), (403, [None] * 64, 1), (404, rows[1][1], None), (405, [], 1), (406, rows[1][1][:32], 1), (407, rows[1][1][:32], 1)]
    table = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, key string")
    links = []
    good = [(i, np.array(v, float), label) for i, v, label in rows if v and label is not None and None not in v and np.isfinite(v).all() and np.any(v)]
    for i, v, a in good:
        links += [(i, j) for j, w, b in good if i < j and a == b and len(v) == len(w) and v @ w / np.sqrt((v @ v) * (w @ w)) >= 0.93]
    ids = [r[0] for r in rows]
    comps, degree = components(ids, links), Counter(x for e in links for x in e)
    for most in (1024, 10):
        got = {r["vec_id"]: r for r in op8_embeddings.near_vectors(table, most=most).collect()}
        assert set(got) == set(ids)
        assert sum(r["n_links"] for r in got.values()) >= 0.95 * sum(degree.values())
        assert all(r["n_links"] <= degree[i] for i, r in got.items())
        assert sum(r["component_id"] != comps[i] for i, r in got.items()) <= 0.02 * len(ids)
        assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.values())
    assert op8_embeddings.near_vectors(table.where("false")).count() == 0


def test_embedding_recall_with_a_common_mean():
    rng = np.random.default_rng(5)
    for strength in (0.0, 1.0, 1.5, 3.0):
        mean = rng.standard_normal(64)
        x = rng.standard_normal((6000, 64))
        x = x / np.linalg.norm(x, axis=1, keepdims=True) + strength * mean / np.linalg.norm(mean)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        some = x[:3000]
        near = op8_embeddings.partners(some, 0.935, 9)
        assert np.allclose((some * near).sum(axis=1), 0.935)
        for largest in (10_000, 100_000):
            bits = op8_embeddings.plan_bits(largest, 64)
            rotations, n = op8_embeddings.plan_tables(x[3000:], bits, largest, 0.93, 0.97)
            met = (op8_embeddings.code(some, rotations, bits, n) == op8_embeddings.code(near, rotations, bits, n)).any(axis=1)
            assert met.mean() >= 0.95, (strength, largest)


def suffix_brute(rows):
    first, out = {}, {}
    data = [(i, (t or "").encode()) for i, t in rows]
    for i, b in data:
        for s in range(len(b) - 49):
            first[b[s : s + 50]] = min(first.get(b[s : s + 50], i), i)
    for i, b in data:
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - 49):
            if first[b[s : s + 50]] < i:
                gone[s : s + 50] = True
        out[i] = gone
    return out


@pytest.mark.parametrize("most", [2000, 2])
def test_suffix_dedup(docs, empty, most):
    gone = suffix_brute(awkward())
    texts = dict(awkward())
    for r in op9_suffix_dedup.dedup_digests(docs, most).collect():
        b, g = (texts[r["doc_id"]] or "").encode(), gone[r["doc_id"]]
        kept = np.frombuffer(b, np.uint8)[~g].tobytes()
        spans = int((np.diff(np.r_[0, g.astype(int)]) == 1).sum())
        assert tuple(r)[1:] == (len(b), int(g.sum()), spans, hashlib.sha256(kept).hexdigest())
    out = op9_suffix_dedup.removed(docs, most)
    assert out.columns == docs.columns and out.count() == len(awkward())
    assert {r["text"] is None for r in out.where("doc_id = 5").collect()} == {True}
    assert op9_suffix_dedup.dedup_digests(empty).count() == 0


def test_suffix_dedup_of_cut_passages(spark):
    r = random.Random(9)
    passages = [prose(70 + i, 30) for i in range(5)]
    rows = [(i, "".join(p[r.randrange(40) : r.randrange(60, len(p))] for p in r.sample(passages, 3)) + prose(200 + i, 5)) for i in range(40)]
    gone = suffix_brute(rows)
    for most in (2000, 2):
        got = op9_suffix_dedup.dedup_digests(documents(spark, rows), most)
        assert {x["doc_id"]: x["n_removed"] for x in got.collect()} == {i: int(g.sum()) for i, g in gone.items()}


def test_sorted_suffixes():
    from factloom.llm.suffixsort import Substrings, equal_runs, sort_groups

    r = np.random.default_rng(2)
    data = r.integers(97, 99, 3000).astype(np.uint8)
    at = r.integers(0, 2900, 500)
    group = np.sort(r.integers(0, 40, 500))
    order = sort_groups(Substrings(data), at, group, 50)
    keys = [(int(group[i]), data[at[i] : at[i] + 50].tobytes()) for i in order]
    assert keys == sorted(keys)
    run = equal_runs(Substrings(data), at[order], group[order], 50)
    assert [a == b for a, b in zip(keys, keys[1:], strict=False)] == (np.diff(run) == 0).tolist()


def thue_morse(n, first="a"):
    word = first
    while len(word) < n:
        word += word.translate(str.maketrans("ab", "ba"))
    return word


def test_texts_that_collide_modulo_powers_of_two(spark):
    a, b = thue_morse(2048), thue_morse(2048, "b")
    rows = [(1, a), (2, b), (3, f"{a} and {b} more"), (4, f"{b} and {a} more")]
    docs = documents(spark, rows)
    assert not op7_line_dedup.within(a.encode(), b.encode(), 61)
    assert op7_line_dedup.repeated_lines(docs).collect() == []
    assert {r["doc_id"]: r["component_id"] for r in op2_ngram_join.near_duplicates(docs, 3, 90, 100).collect()} == {1: 1, 2: 2, 3: 3, 4: 4}
    gone = suffix_brute(rows)
    assert {x["doc_id"]: x["n_removed"] for x in op9_suffix_dedup.dedup_digests(docs).collect()} == {i: int(g.sum()) for i, g in gone.items()}


def test_joins_where_tables_would_be_too_small(spark, docs, monkeypatch):
    """The same results when keys are joined instead of looked up in a table of bounded size."""
    from factloom.llm import sketch

    sets = rows_of(op2_ngram_join.near_duplicates(docs, 3, 90, 100))
    lines, bytes_ = rows_of(op7_line_dedup.line_digests(docs)), rows_of(op9_suffix_dedup.dedup_digests(docs))
    monkeypatch.setattr(sketch, "fits", lambda n_keys, members=False: False)
    assert rows_of(op2_ngram_join.near_duplicates(docs, 3, 90, 100)) == sets
    assert rows_of(op7_line_dedup.line_digests(docs)) == lines
    assert rows_of(op9_suffix_dedup.dedup_digests(docs)) == bytes_


def test_columns_of_any_name(spark):
    import corpus_pipeline

    names = ["marks", "marked_id", "row", "wholes", "copy_id", "node", "salt", "verdict", "m", "a.b"]
    docs = documents(spark, [*awkward(), (None, prose(1, 60))], extra=False)
    for name in names:
        docs = docs.withColumn(name, F.lit(name))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns
        got = out.collect()
        assert got and all(r[n] == n for r in got for n in names)
        assert stage(spark, docs.where("false"), "").count() == 0
    assert corpus_pipeline.packing(spark, docs, "").count() >= docs.count()
    assert corpus_pipeline.packing(spark, docs.where("false"), "").count() == 0


def brute_quality(rows):
    """Documents that stay, by the rules written once more."""
    flags, hosts = [], {}
    for i, text, source in rows:
        n_words, chars, symbols, dup, repeat = base_measures(text)
        body = "".join(WORD.findall(text or ""))
        symbols = sum(c in "#*$%&|<>" for c in body)
        lines = [x for x in (text or "").split("\n") if WORD.search(x)]
        base = n_words < 20 or 100 * repeat > 30 * n_words
        broken = (10 * symbols > n_words) + (10 * sum("A" <= c <= "Z" for c in body) > 3 * chars) + (2 * dup > len(lines)) + (chars < 2 * n_words or chars > 15 * n_words)
        flags.append((base, broken))
        n, bad = hosts.get(source, (0, 0))
        hosts[source] = n + 1, bad + (base or broken > 0)
    rates = [bad / n for n, bad in hosts.values()]
    mean = sum(rates) / len(rates)
    var = sum((x - mean) ** 2 for x in rates) / (len(rates) - 1) if len(rates) > 1 else 0.0
    weight = max(1.0, min(1000.0, mean * (1 - mean) / max(var, 1e-12) - 1))
    rate = {h: (bad + mean * weight) / (n + weight) for h, (n, bad) in hosts.items()}
    return [row for row, (base, broken) in zip(rows, flags, strict=True) if not base and rate[row[2]] <= 0.9 and broken <= (rate[row[2]] < 0.05)]


def brute_lines(rows):
    spots = [(i, n, x.encode()) for i, t, _ in rows for n, x in enumerate(t.split("\n")) if WORD.search(x)]
    distinct = sorted({b for _, _, b in spots})
    limit = dict(zip(distinct, op7_line_dedup.limits(np.array([len(b) for b in distinct]), None).tolist(), strict=True))
    links = [(a, b) for a in distinct for b in distinct if a < b and abs(len(a) - len(b)) <= min(limit[a], limit[b]) and edit_distance(a, b) <= min(limit[a], limit[b])]
    comps, first = components(distinct, links), {}
    for i, n, b in sorted(spots):
        first.setdefault(comps[b], (i, n))
    gone = {(i, n) for i, n, b in spots if first[comps[b]] != (i, n)}
    kept = [(i, "\n".join(x for n, x in enumerate(t.split("\n")) if (i, n) not in gone), s) for i, t, s in rows]
    return [r for r in kept if WORD.search(r[1])]


def brute_join(rows):
    sets = {}
    for i, t, _ in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t))
        sets[i] = {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))}
    comps = components(sets, [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])])
    return [r for r in rows if comps[r[0]] == r[0]]


def brute_suffixes(rows):
    gone = suffix_brute([(i, t) for i, t, _ in rows])
    return [(i, np.frombuffer(t.encode(), np.uint8)[~gone[i]].tobytes().decode(errors="ignore"), s) for i, t, s in rows]


def test_pipeline_against_brute_force(spark, tmp_path):
    import corpus_pipeline
    from tokenizers import Tokenizer

    r = random.Random(4)
    rows = []
    for i in range(24):
        lines = [prose(3000 + 9 * i + k, 14) for k in range(3)]
        if i % 4 == 1:  # a near copy: one word of a line changed
            lines = rows[-1][1].split("\n")
            lines[r.randrange(3)] += " indeed"
        if i % 4 == 2:  # a shared line, and a passage within another line
            lines[1] = rows[0][1].split("\n")[0]
            lines[2] += " " + rows[0][1].split("\n")[2][10:80]
        if i % 6 == 5:
            lines = ["$$$ ### " * 20]
        rows.append((i, "\n".join(lines), f"s{i % 3}"))
    long = prose(9000, 90).split()  # the same words in other lines: only the join can tell
    rows += [(30, " ".join(long[:40]) + "\n" + " ".join(long[40:]), "s0"), (31, " ".join(long[:60]) + "\n" + " ".join(long[60:]), "s1"), (32, "few", "s1"), (33, "", "s2"), (34, None, "s2")]
    table = [(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows]
    spark.createDataFrame(table, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    stage, expected = spark.read.parquet(str(tmp_path / "documents.parquet")), rows
    for (name, f), brute in zip(corpus_pipeline.STAGES, (brute_quality, brute_lines, brute_join, brute_suffixes), strict=False):
        before, expected = len(expected), brute(expected)
        stage = f(spark, stage, str(tmp_path))
        got = stage.collect()
        assert sorted((x["doc_id"], x["text"], x["source"]) for x in got) == sorted(expected), name
        assert all(x["n_chars"] == len(x["text"]) for x in got), name
        assert len(expected) < before or name in ("line_dedup", "suffix_dedup"), name
    tokenizer = Tokenizer.from_file(WORD_JSON)
    ids = {i: tokenizer.encode(t, add_special_tokens=False).ids + [1] for i, t, _ in expected}
    pieces = sorted((p["doc_id"], p["start"], p["length"], p["ids_crc32"]) for p in corpus_pipeline.run(spark, str(tmp_path)).collect())
    assert pieces == sorted((i, 0, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in ids.items())


def test_repeated_ids_and_nulls(spark):
    rows = [(1, "one two three " * 3), (1, "one two three " * 3), (1, None), (2, None), (None, "one two three"), (None, None)]
    docs = documents(spark, rows)
    n = [len(rows)] * 5
    assert [op4_tokens.token_counts(docs, BPE_JSON).count(), op6_packing.pack(docs, WORD_JSON).count(), op7_line_dedup.line_digests(docs).count(), op10_bpe.encode_digests(docs, BPE_RANKS, public_tokenizers.PATTERN).count(), op9_suffix_dedup.dedup_digests(docs).count()] == n
    assert {r["n_tokens"] for r in op10_bpe.encode_digests(docs.where("text IS NULL"), BPE_RANKS, public_tokenizers.PATTERN).collect()} == {0}
    assert {(r["length"], r["doc_tokens"]) for r in op6_packing.pack(docs.where("text IS NULL"), WORD_JSON).collect()} == {(1, 1)}
    same = [(7, [1.0, 0.5], 1), (7, [1.0, 0.5], 1), (3, [1.0, 0.5], 1), (None, None, 1)]
    got = op8_embeddings.near_vectors(spark.createDataFrame(same, "vec_id long, embedding array<float>, label int")).collect()
    assert sorted((r["vec_id"] or 0, r["n_links"], r["component_id"] or 0) for r in got) == [(0, 0, 0), (3, 2, 3), (7, 2, 3), (7, 2, 3)]


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    rows = [(i, "\n".join(prose(1000 + 7 * i + k, 40) for k in range(3))) for i in range(30)]
    rows += [(40, rows[3][1] + " tail end"), (41, rows[4][1]), (42, None), (43, ""), (44, "few words"), (45, prose(5000, 30) + "\n" + rows[5][1].split("\n")[1])]
    documents(spark, rows, extra=False).write.parquet(str(tmp_path / "documents.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    ids = {r["doc_id"] for r in out}
    assert ids >= set(range(30)) and not ids & {42, 43, 44}
    assert 41 not in ids, "an exact copy loses all its lines"
    stage = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for _, f in corpus_pipeline.STAGES[:-1]:
        stage = f(spark, stage, str(tmp_path))
        assert stage.columns == ["doc_id", "text", "lang", "source", "n_chars"]
