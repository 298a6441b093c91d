"""Lexical search, spelling variants and the n-gram join beside brute force."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from daybook.llm import lexical, ngram_join, spelling

from .test_text_operators import brute_components

DOCS = "doc_id long, text string, item int, rank string, word string"


def table(spark, rows, parts=3):
    return spark.createDataFrame([(i, t, 1, "x", "y") for i, t in rows], DOCS).repartition(parts)


# ranked search


def brute_terms(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def brute_ranks(docs, items, k):
    found = [(i, Counter(brute_terms(t))) for i, t in docs]
    n_docs, n_terms = sum(bool(bag) for _, bag in found), sum(sum(bag.values()) for _, bag in found)
    df = Counter(term for _, bag in found for term in bag)
    rows = []
    for item, text in items:
        scored = []
        for i, bag in found:
            if i is None or not bag:
                continue
            m = 100 - 75 + 75 * sum(bag.values()) * n_docs // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * bag[t] // (1000 * bag[t] + 8 * m))
                for t in brute_terms(text) if bag[t]
            )
            if score > 0:
                scored.append((-score, i))
        rows += [(item, rank, i, -score) for rank, (score, i) in enumerate(sorted(scored)[:k], 1)]
    return Counter(rows)


def search_corpus():
    pick = random.Random(1)
    words = [f"w{i}" for i in range(40)] + ["É", "é", "日本", "x_y", "A1"]
    texts = [" ".join(pick.choices(words, weights=range(1, 46), k=pick.randrange(0, 25))) for _ in range(200)]
    rows = list(enumerate(texts)) + [(1000 + i, pick.choice(texts[:5]).upper()) for i in range(150)]  # classes of copies
    rows += [(2000, None), (2001, ""), (2002, " \t!?"), (2003, "w1 " * 300_000 + "w2"), (None, "w1 w2 w44"), (3, "w1 w2"), (3, "w1 w2")]
    items = [(i, " ".join(pick.choices(words, k=pick.randrange(1, 12)))) for i in range(30)]
    items += [(50, None), (51, "?!"), (52, "nowhere"), (53, "W1 w1 é É"), (53, "w2"), (None, "w3 w4")]
    return rows, items


@pytest.mark.parametrize("item_bytes,scores", [(1 << 22, 1 << 20), (200, 90)])
def test_ranks_against_brute_force(spark, monkeypatch, item_bytes, scores):
    monkeypatch.setattr(lexical, "ITEM_BYTES", item_bytes)
    monkeypatch.setattr(lexical, "_SCORES", scores)
    rows, items = search_corpus()
    asked = spark.createDataFrame([(i, t, 5) for i, t in items], "item_id int, text string, doc_id int")
    got = lexical.top_documents(table(spark, rows), asked, 10)
    assert got.columns == ["item", "rank", "doc", "score"]
    # rows that share an item id have ranks of their own
    assert Counter(map(tuple, got.collect())) == brute_ranks(rows, items, 10)


def test_equal_scores_go_by_id_and_classes_hold_few(spark):
    rows = [(i, "same words here") for i in range(500, 0, -1)] + [(1000 + i, f"other {i}") for i in range(50)]
    asked = spark.createDataFrame([(1, "same")], "item_id long, text string")
    got = lexical.top_documents(table(spark, rows, 7), asked, 10).orderBy("rank").collect()
    assert [(r.rank, r.doc) for r in got] == [(i, i) for i in range(1, 11)] and len({r.score for r in got}) == 1
    found = spark.createDataFrame([(i, 3, [0], [1]) for i in range(100)], "id long, n long, terms array<int>, tfs array<int>")
    assert [r.ids for r in lexical.classes(found, 100, 300, 10).collect()] == [list(range(10))]


def test_search_of_nothing(spark, nothing, rough):
    asked = spark.createDataFrame([(1, "the")], "item_id long, text string")
    assert lexical.top_documents(nothing, asked).count() == 0
    empty = lexical.top_documents(rough, asked.limit(0))
    assert empty.count() == 0 and empty.columns == ["item", "rank", "doc", "score"]
    assert lexical.top_documents(rough, asked).count() > 0


# spelling variants


def brute_near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute_variants(rows, least_letters, least_count, share, every):
    total = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if every and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            total[run] += 1
    words = {w: n for w, n in total.items() if len(w) >= least_letters and n >= least_count}
    forms, near = {}, {}
    for w, n in words.items():
        close = [x for x in words if brute_near(w, x)]
        near[w] = len(close)
        best = min(close, key=lambda x: (-words[x], x), default=None)
        if best is not None and words[best] >= share * n:
            forms[w] = best
    expected = Counter()
    for w, n in words.items():
        root = w
        while root in forms:
            root = forms[root]
        expected[w, forms.get(w), root, n, near[w], words.get(forms.get(w))] += 1
    return expected


@pytest.mark.parametrize("every", [0, 3, 199])
def test_variants_against_brute_force(spark, every):
    pick = random.Random(every)
    words = ["".join(pick.choices("abcdnoé", k=pick.randrange(3, 7))) for _ in range(60)] + ["aaaaaa", "aaaaaaa", "ÀÿÖ×÷ß", "a" * 300, "a" * 301]
    weights = [2 ** pick.randrange(0, 11) for _ in words]
    rows = [(i, " ".join(pick.choices(words, weights=weights, k=40)) + ".X" + pick.choice("-1 ")) for i in range(300)]
    rows += [(400, None), (401, ""), (None, "abcd abcd abcd"), (5, rows[5][1]), (5, rows[5][1]), (402, "ab1cd ĀbcdeĀ " * 50_000)]
    got = spelling.variants(table(spark, rows), 3, 2, 5, every)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert Counter(map(tuple, got.collect())) == brute_variants(rows, 3, 2, 5, every)


def test_one_apart_and_trie():
    pick = random.Random(3)
    words = list({"".join(pick.choices("abz", k=pick.randrange(1, 7))) for _ in range(400)})
    for a in words[:60]:
        assert [spelling.one_apart(a, b) for b in words] == [brute_near(a, b) for b in words]
    trie = spelling._Trie()
    counts = [row.tobytes() for row in spelling.group_counts(words)]
    for word, row in zip(words, counts):
        trie.insert(word, row)
    for a, row in zip(words, counts):
        assert sorted(trie.words[i] for i in trie.near(a, row, 1, 1)) == sorted(b for b in words if brute_near(a, b))


def test_parts_of_a_batch_with_nothing_at_rest_are_left_out():
    keys, rests = np.array([1, 1, 2, 3, 3, 4, 5, 5]), np.array([0, 0, 1, 1, 0, 1, 0, 0], bool)
    assert spelling._met(keys, rests, 1).tolist() == [True, True, False, True, True, False, False, False]
    assert spelling._met(keys[:6], rests[:6], None).tolist() == [False, False, False, True, True, True]


def test_chains_of_forms_lead_to_the_last(spark):
    forms = spark.createDataFrame([(f"a{i:02}", f"a{i + 1:02}") for i in range(20)] + [("b", "c")], "word string, form string")
    got = {r.word: r.root for r in spelling.roots(forms).collect()}
    assert got == {**{f"a{i:02}": "a20" for i in range(20)}, "b": "c"}


def test_variants_of_nothing(spark, nothing):
    assert spelling.variants(nothing).count() == 0
    assert spelling.variants(table(spark, [(1, "short words only")])).count() == 0
    with pytest.raises(ValueError):
        spelling.variants(nothing, share=1)


# n-gram join


def brute_sets(rows, words):
    found = []
    for doc, text in rows:
        tokens = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
        grams = {tuple(tokens[i : i + words]) for i in range(max(1, len(tokens) - words + 1))} if tokens else set()
        found.append((doc, frozenset(grams)))
    return found


def brute_links(rows, words, threshold):
    sets = [(d, s) for d, s in brute_sets(rows, words) if d is not None]
    pairs = [(a, b) for n, (a, x) in enumerate(sets) for b, y in sets[:n] if x and y and 100 * len(x & y) >= threshold * len(x | y)]
    root = brute_components({d for d, _ in sets}, pairs)
    return Counter((d, len(s), None if d is None else root[d]) for d, s in brute_sets(rows, words))


def join_corpus():
    pick = random.Random(6)
    word = lambda: f"w{pick.randrange(30_000)}"
    passage = [word() for _ in range(40)]
    rows = []
    for n in range(50):
        base = [word() for _ in range(pick.randrange(60, 250))] + (passage if n % 3 == 0 else [])
        rows.append((n, " ".join(base)))
        copy = list(base)
        for at in pick.sample(range(len(base)), max(1, round(len(base) * pick.uniform(0.005, 0.03)))):
            copy[at] = word()
        rows.append((100 + n, " ".join(copy).upper()))
    hub = [word() for _ in range(100)]
    for n in range(120):  # near copies of one text: alike through it, through others or not at all
        copy = list(hub)
        for at in pick.sample(range(len(hub)), pick.choice([1, 1, 2, 3])):
            copy[at] = word()
        rows.append((300 + n, " ".join(copy)))
    rows.append((299, " ".join(hub)))
    rows += [(500 + i, rows[0][1].replace(" ", "\n\t")) for i in range(20)]  # copies
    rows += [(600, None), (601, ""), (602, " \t"), (603, "one two"), (604, "One TWO"), (605, "a a a a a a"), (606, "a a a a")]
    return rows


@pytest.mark.parametrize("words,threshold", [(4, 85), (3, 60)])
def test_links_against_brute_force(spark, words, threshold):
    rows = join_corpus()
    expected = brute_links(rows, words, threshold)
    got = ngram_join.linked(table(spark, rows), words, threshold)
    assert Counter(map(tuple, got.collect())) == expected
    assert len({component for _, _, component in expected}) < len(rows) - 50


def test_links_of_odd_rows(spark, rough, nothing):
    rows = [(r.doc_id, r.text) for r in rough.where("doc_id <> 4 OR doc_id IS NULL").collect()]
    kept = rough.where("doc_id <> 4 OR doc_id IS NULL")
    assert Counter(map(tuple, ngram_join.linked(kept).collect())) == brute_links(rows, 4, 85)
    assert ngram_join.linked(nothing).count() == 0
    # rows that repeat an id with other texts link as one
    twice = table(spark, [(1, "a b c d e"), (2, "f g h i j"), (2, "a b c d e"), (3, "f g h i j"), (4, "k " * 1_000_000)])
    assert {(r.id, r.component) for r in ngram_join.linked(twice).collect()} == {(1, 1), (2, 1), (3, 1), (4, 4)}


def test_filters_lose_no_linked_pair():
    pick = random.Random(8)
    for _ in range(400):
        base = pick.sample(range(400), pick.randrange(1, 60))
        other = base[: pick.randrange(len(base) + 1)] + pick.sample(range(400, 500), pick.randrange(0, 12))
        a, b = np.array(sorted(base), np.uint64), np.array(sorted(set(other)), np.uint64)
        x, y = set(a.tolist()), set(b.tolist())
        assert ngram_join.apart(a, b) <= len(x ^ y)
        assert np.bitwise_count(ngram_join.bitmap(a) ^ ngram_join.bitmap(b)).sum() <= len(x ^ y)
        if not len(b):
            continue
        linked = 100 * len(x & y) >= 85 * len(x | y)
        assert ngram_join.alike(a, b, 85) == linked
        if linked:  # of the first in any order, as many are shared as prefixes must share
            order = {g: i for i, g in enumerate(pick.sample(sorted(x | y), len(x | y)))}
            heads = [set(sorted(z, key=order.get)[: ngram_join.prefix_length(len(z), 85)]) for z in (x, y)]
            assert len(heads[0] & heads[1]) >= ngram_join.shared_at_least(min(len(x), len(y)))


def test_prefixes_have_the_rarest_grams_first(spark):
    """Positions and bounds beside the same by sorting whole sets."""
    pick = random.Random(9)
    pool = [pick.getrandbits(64) for _ in range(300)]
    sets = [sorted(pick.sample(pool, pick.randrange(1, 120)) + [pick.getrandbits(64) for _ in range(pick.randrange(30))]) for _ in range(60)]
    rows, holders = [], Counter()
    for i, s in enumerate(sets):
        counted = sum(g < int(ngram_join._COUNTED) for g in s)
        shown = s[: max(counted, ngram_join.prefix_length(len(s), 85))]
        holders.update(shown)
        rows.append((i, len(s), counted, [g - (1 << 64) if g >> 63 else g for g in shown]))
    got = {(r.node, r.rank % (1 << 64)): (r.most, r.left) for r in ngram_join._prefixes(spark.createDataFrame(rows, "node long, n long, counted int, grams array<long>"), 85).collect()}
    expected = {}
    for i, s in enumerate(sets):
        counted = [g for g in s if g < int(ngram_join._COUNTED)]
        order = sorted(counted, key=lambda g: (holders[g], g)) + [g for g in s if g >= int(ngram_join._COUNTED)]
        most = 0
        for place, g in enumerate(order[: ngram_join.prefix_length(len(s), 85)]):
            most += holders[g] > 1
            if holders[g] > 1 and most >= ngram_join.shared_at_least(-(-85 * len(s) // 100)):
                expected[i, g] = (most, len(s) - place - 1)
    assert got == expected


def test_a_pair_of_many_runs_is_given_by_one(spark, monkeypatch):
    """Texts that share much of their prefixes without being linked meet in many runs; their pairs are made once, not once per run."""
    pick = random.Random(10)
    base = [f"w{pick.randrange(30_000)}" for _ in range(1200)]
    rows = []
    for n in range(40):  # 100 words of the same 1200 changed in a row
        at = 29 * (n % 38)
        rows.append((n, " ".join([*base[:at], *(f"own{n}-{i}" for i in range(100)), *base[at + 100 :]])))
    rows += [(40, rows[3][1].replace("own3-5", "base")), (40, rows[9][1].replace("own9-5", "base"))]  # two texts of one id and size
    made, runs = [], ngram_join._runs

    def seen(entries, *rest):
        out = runs(entries, *rest)
        if "root" in entries.columns:
            made.append((out.count(), out.distinct().count()))
        return out

    monkeypatch.setattr(ngram_join, "_runs", seen)
    assert Counter(map(tuple, ngram_join.linked(table(spark, rows)).collect())) == brute_links(rows, 4, 85)
    (every, distinct), = made
    assert distinct > 100 and every <= 2 * distinct
