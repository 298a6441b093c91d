import base64
import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from daybook.llm import bpe, components, language, packing, simhash, spotsigs, substring
from daybook.llm.queries import packed_pieces
from daybook.llm.tokens import Pieces

WORDS = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


def words_of(text):
    return (text or "").encode().split()


# packing


def test_plan_uses_every_piece_and_fills_windows():
    pick = random.Random(1)
    counts = Counter(pick.choice([1, 7, 400, pick.randrange(1, 2049)]) for _ in range(3000))
    plan, used = packing.plan_windows(dict(counts), 2048), Counter()
    for times, window in plan:
        assert times > 0 and sum(x * n for x, n in window.items()) <= 2048
        for x, n in window.items():
            used[x] += n * times
    assert used == counts
    rooms = []  # first fit of falling lengths
    for x in sorted(counts.elements(), reverse=True):
        at = next((i for i, room in enumerate(rooms) if room >= x), None)
        if at is None:
            rooms.append(2048 - x)
        else:
            rooms[at] -= x
    assert sum(times for times, _ in plan) <= 1.01 * len(rooms)


@pytest.mark.parametrize("capacity", [10, 17])
def test_each_window_has_the_least_slack(capacity):
    pick = random.Random(capacity)
    for _ in range(50):
        counts = Counter(pick.randrange(1, capacity + 1) for _ in range(8))
        first = packing.plan_windows(dict(counts), capacity)[0][1]
        longest, rest = max(counts), list(counts.elements())
        rest.remove(longest)
        sums = {0}
        for x in rest:
            sums |= {s + x for s in sums}
        best = max(s for s in sums if s <= capacity - longest)
        assert sum(x * n for x, n in first.items()) == longest + best


def test_chunks_give_the_tokenizers_ids():
    tokenizer = Tokenizer.from_file(WORDS)
    tokenizer.encode_special_tokens = True
    pick = random.Random(2)
    parts = ["a", "B", " ", "  ", "\n", "\t", "é", "É", "ß", "İ", "Σ", "1", "23", "!", "'s", "日本", "\x1c", " ", "😀", "́", "<|endoftext|>", "\x85"]
    texts = ["".join(pick.choice(parts) for _ in range(pick.randrange(30))) for _ in range(1000)]
    for text, data in zip(texts, Pieces.of(WORDS).encode(texts)):
        assert np.frombuffer(data, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def check_packing(rows, texts):
    tokenizer = Tokenizer.from_file(WORDS)
    tokenizer.encode_special_tokens = True
    expected = Counter()
    for doc, text in texts:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        for start in range(0, len(ids), 2048):
            part = ids[start : start + 2048]
            expected[doc, start, len(part), zlib.crc32(part.tobytes()), len(ids)] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == expected
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sorted(places) == list(range(len(places)))
    for found in places.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= 2048


def test_packing(spark, rough, nothing):
    rows = packed_pieces(rough, WORDS).collect()
    check_packing(rows, [(r.doc_id, r.text) for r in rough.collect()])
    assert packed_pieces(nothing, WORDS).count() == 0


def test_packing_in_many_shares(spark, monkeypatch):
    monkeypatch.setattr(packing, "_SHARE", 10)
    pieces = spark.range(500).select(F.col("id"), F.lit(0).cast("long").alias("start"), F.when(F.col("id") % 3 == 0, 100).otherwise(F.col("id") % 90 + 1).cast("long").alias("length"))
    rows = packing.pack(pieces, 128).collect()
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert len(rows) == 500
    for found in places.values():
        assert [o for o, _ in sorted(found)] == np.cumsum([0, *[n for _, n in sorted(found)][:-1]]).tolist()
    sums = packing.padding(packing.pack(pieces, 128), 128).first()
    assert sums.tokens == sum(r.length for r in rows) and sums.sequences == len(places)


# byte pairs


def test_byte_pairs_against_the_library():
    pairs = bpe.BytePairs.of(RANKS, PATTERN)
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    library = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    pick = random.Random(3)
    parts = ["a", "b", " ", "  ", "\n", "\t", "é", "ß", "1", "23", "!", "'s", "'", "日本", "\x1c", " ", " ", "😀", "xxxxx", "\r\n", "the", "\x85"]
    texts = ["".join(pick.choice(parts) for _ in range(pick.randrange(30))) for _ in range(2000)]
    texts += ["a" * 30000, "ab" * 10000, "".join(pick.choice("abcdefghij") for _ in range(50000)), " " * 9999, "\n" * 999]
    for text in texts:
        ids = np.frombuffer(pairs.encode(text), "<u4")
        assert ids.tolist() == library.encode_ordinary(text)
        assert pairs.decode(ids) == text.encode()


def test_rank_queue_pops_in_order():
    queue, pick = bpe.RankQueue(5000), random.Random(4)
    held = []
    for _ in range(3000):
        if held and pick.random() < 0.4:
            assert queue.pop() == min(held)
            held.remove(min(held))
        else:
            held.append((pick.randrange(5000) if pick.random() < 0.8 else 7, pick.randrange(10**6)))
            queue.push(*held[-1])
    assert [queue.pop() for _ in held] == sorted(held) and queue.pop() == (-1, -1)


def test_encoding_round_trip(rough, nothing):
    ids = bpe.encoded(rough, RANKS, PATTERN)
    texts = Counter((r.text or "").encode() for r in rough.collect())
    assert Counter(bytes(r.bytes) for r in bpe.decoded(ids, RANKS, PATTERN).collect()) == texts
    for r in bpe.digests(ids, RANKS, PATTERN).join(rough.withColumnRenamed("doc_id", "d").drop("id"), F.col("id").eqNullSafe(F.col("d"))).where("id = 9").collect():
        assert r.decoded_sha256 == hashlib.sha256(r.text.encode()).hexdigest()
    assert bpe.digests(bpe.encoded(nothing, RANKS, PATTERN), RANKS, PATTERN).count() == 0


# SpotSigs


def brute_signatures(text):
    words = spotsigs._WORDS(text.lower())
    found = set()
    for i, word in enumerate(words):
        if word in spotsigs.ANCHORS:
            chain = [w for w in words[i + 1 :] if w not in spotsigs.ANCHORS][:2]
            if len(chain) == 2:
                found.add(xxhash.xxh3_64_intdigest(" ".join([word, *chain])))
    return found or {xxhash.xxh3_64_intdigest("\n".join(words))}


@pytest.mark.parametrize("shuffle", [1, 4])
def test_spotsigs_against_next(spark, rough, nothing, shuffle):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(shuffle))
    try:
        got = spotsigs.against_next(rough).collect()
        assert spotsigs.against_next(nothing).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    rows = sorted(((r.doc_id, r.text or "") for r in rough.collect()), key=lambda r: (r[0] is None, -(r[0] or 0), r[1].encode()))
    expected = []
    for (doc, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        third = len(text) // 3
        changed = text[: len(text) - third] + following[:third]
        a, b, c = map(brute_signatures, (text, changed, following))
        joined = lambda s: "".join(f"{x:016x}" for x in sorted(s))
        expected.append((doc, len(text), hashlib.sha256(changed.encode()).hexdigest(), joined(a), joined(b), len(a & b) / len(a | b), len(a & c) / len(a | c)))
    assert Counter(tuple(r)[:7] for r in got) == Counter(expected)


def test_similar_sets(spark):
    pick = random.Random(5)
    base = [set(pick.sample(range(200), pick.randrange(1, 40))) for _ in range(40)]
    sets = base + [s | set(pick.sample(range(200), 2)) for s in base] + base[:5]
    frame = spark.createDataFrame([(i, sorted(s)) for i, s in enumerate(sets)] + [(None, [1])], "id long, signatures array<long>")
    got = {(r.left, r.right): r.likeness for r in spotsigs.similar_sets(frame, 0.8).collect()}
    first = {}
    for i, s in enumerate(sets):
        first.setdefault(frozenset(s), i)
    expected = {}
    for a, i in first.items():
        for b, j in first.items():
            if i < j and len(a & b) >= 0.8 * len(a | b) - 1e-12:
                expected[i, j] = len(a & b) / len(a | b)
    assert got == pytest.approx(expected) and expected
    assert spotsigs.likeness(frozenset({1}), frozenset(range(9)), 0.5) == 0.0


# languages


def test_language_bundles():
    texts = ["the cat", "", "ÉÉ 12", "x"]
    doc, gram = language.grams_of(texts)
    vectors = language.gram_vectors(gram, 64).astype(int)
    total = np.zeros((4, 64))
    np.add.at(total, doc, vectors)
    assert (language.bundles(texts, 64) == total).all()
    once = np.roll(language._letters(64), 1, axis=1)
    assert (language.gram_vectors(np.array([64 * 8]), 64) == np.roll(language._letters(64)[0], 2) * once[8] * language._letters(64)[0]).all()


def test_language_rows(rough, nothing, spark):
    profiles = language.learn(rough)
    assert profiles.names == ["en", "fr"]
    rows = language.with_language(rough, profiles).collect()
    assert len(rows) == rough.count()
    for r in rows:
        if r.text is None or not any(c.isalpha() for c in r.text):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred in profiles.names and 0 <= r.score <= 1
    none = language.learn(nothing)
    assert none.names == [] and {r.lang_pred for r in language.with_language(rough, none).collect()} == {"und"}
    assert language.with_language(nothing, profiles).count() == 0


def test_language_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    found = language.with_language(docs.where(fold == 2), language.learn(docs.where(fold != 2)))
    right = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right >= 0.95


# SimHash


def brute_fingerprint(text, words, stir=None):
    found = words_of((text or "").encode().translate(simhash._LOWER).decode())
    shingles = [b" ".join(found[i : i + words]) for i in range(max(1, len(found) - words + 1))] if found else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(nodes, linked):
    root = {n: n for n in nodes}

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in linked:
        x, y = sorted((top(a), top(b)))
        root[y] = x
    return {n: top(n) for n in nodes}


def test_fingerprint_words():
    assert simhash.majority(simhash.shingle_hashes("", 4)) == 0
    for text in ["a", "A b C d", "x y z w v u", "É é A", "w " * 100, " ".join(map(str, range(70000)))][:5]:
        assert simhash.majority(simhash.shingle_hashes(text, 4)) == brute_fingerprint(text, 4)


@pytest.mark.parametrize("wide_run", [1024, 2])
@pytest.mark.parametrize("max_bits", [4, 9])
def test_links_keep_components(spark, monkeypatch, max_bits, wide_run):
    monkeypatch.setattr(simhash, "_WIDE_RUN", wide_run)
    pick = random.Random(max_bits)
    prints = [pick.getrandbits(64) for _ in range(150)]
    for _ in range(250):
        prints.append(pick.choice(prints) ^ sum({1 << pick.randrange(64) for _ in range(pick.randrange(1, max_bits + 3))}))
    prints = list(dict.fromkeys(prints))
    rows = [(i, p - (1 << 64) if p >> 63 else p, []) for i, p in enumerate(prints)]
    nodes = spark.createDataFrame(rows, "node long, fp long, check array<long>")
    near = [(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= max_bits]
    found = {r.node: r.root for r in components.components(simhash.links(nodes, max_bits)).collect()}
    expected = brute_components(range(len(prints)), near)
    assert {n: found.get(n, n) for n in expected} == expected


@pytest.mark.parametrize("words,max_bits,checks,check_bits", [(4, 4, 0, None), (5, 9, 3, 38)])
def test_near_duplicates(rough, nothing, words, max_bits, checks, check_bits):
    rows = [(r.doc_id, r.text) for r in rough.collect()]
    ids = [i for i, _ in rows if i is not None]
    prints = [(i, brute_fingerprint(t, words), t) for i, t in rows]

    def linked(a, b):
        if (a[1] ^ b[1]).bit_count() > max_bits:
            return False
        total = (a[1] ^ b[1]).bit_count()
        for odd in simhash.STIRS[:checks]:
            x, y = (simhash.majority(simhash._stirred(simhash.shingle_hashes(p[2] or "", words), odd)) for p in (a, b))
            total += (x ^ y).bit_count()
        return check_bits is None or total <= check_bits

    known = [p for p in prints if p[0] is not None]
    root = brute_components(ids, [(a[0], b[0]) for a in known for b in known if linked(a, b)])
    expected = Counter((i, p, root.get(i)) for i, p, _ in prints)
    got = simhash.near_duplicates(rough, words, max_bits, checks, check_bits).collect()
    assert Counter((r.id, r.fp % (1 << 64), r.component) for r in got) == expected
    assert simhash.near_duplicates(nothing, words, max_bits, checks, check_bits).count() == 0


def test_components_of_chains_and_hubs(spark):
    pairs = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 160)] + [(200, 200), (300, 299)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    expected = brute_components({n for p in pairs for n in p} - {200}, [p for p in pairs if p[0] != p[1]])
    assert got == expected


# substring removal


def brute_kept(rows, window):
    """rows: distinct (doc, tie, words)."""
    first = {}
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    gone = {}
    for doc, tie, words in order:
        out = set()
        for i in range(len(words) - window + 1):
            key = tuple(words[i : i + window])
            if key in first:
                out.update(range(i, i + window))
            else:
                first[key] = True
        gone[doc, tie] = out
    return gone


@pytest.mark.parametrize("window,doublings", [(20, 1), (20, 2), (4, 1)])
def test_repeats(rough, nothing, window, doublings):
    tied = rough.withColumn("tie", F.expr("cast(xxhash64(text) & 2147483647 AS int)"))
    rows = {(r.doc_id, r.tie, r.text) for r in tied.collect()}
    gone = brute_kept([(d, t, words_of(x)) for d, t, x in rows], window)
    expected = Counter()
    for r in tied.collect():
        words, out = words_of(r.text), gone[r.doc_id, r.tie]
        expected[r.doc_id, len(words), len(out), b" ".join(w for i, w in enumerate(words) if i not in out).decode(), r.key] += 1
    got = substring.without_repeats(rough, window, doublings).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.text, r.key) for r in got) == expected
    assert any(k[2] for k in expected)
    assert substring.without_repeats(nothing, window, doublings).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_repeats_of_few_words(spark, seed):
    pick = random.Random(seed)
    texts = [" ".join(pick.choice("abc") for _ in range(pick.randrange(0, 60))) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    gone = brute_kept([(i, 0, words_of(t)) for i, t in enumerate(texts)], 8)
    got = {r.doc_id: r.text for r in substring.without_repeats(docs, 8, 2).collect()}
    for i, text in enumerate(texts):
        assert got[i] == b" ".join(w for n, w in enumerate(words_of(text)) if n not in gone[i, 0]).decode()


def test_words_that_a_polynomial_takes_for_equal(spark):
    one = "a"
    for _ in range(10):
        one += one.translate({97: "b", 98: "a"})
    other = one.translate({97: "b", 98: "a"})
    same = " ".join(f"word{i}" for i in range(19))
    docs = spark.createDataFrame([(1, f"{same} {one}", 5), (2, f"{same} {other}", 6), (3, f"{same} {one}", 7)], "doc_id long, text string, n_words int")
    got = {r.doc_id: (r.n_words, r.n_removed) for r in substring.without_repeats(docs).collect()}
    assert got == {1: (20, 0), 2: (20, 0), 3: (20, 20)}


def test_word_hashes_follow_words():
    data = "a bb  ccc\td\n\x0be\x0cf\rg é".encode()
    assert len(substring.word_hashes(data)) == len(data.split())
    assert (substring.word_hashes(b"xx yy") == substring.word_hashes(b"  xx\n\nyy ")).all()
    long = ("word " * 300000 + "z" * 2000000 + " end").encode()
    found = substring.word_hashes(long)
    assert len(found) == 300002 and len(set(found.tolist())) == 3
