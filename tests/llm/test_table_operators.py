import gzip
import hashlib
import random
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyarrow import fs
from pyspark.sql import functions as F

from daybook.llm import licences, sharding, topk, warc
from daybook.session import new_folder

# WARC


def pages(spark):
    big, other = "<p>same</p>" * 200, "<p>é</p>" * 300
    rows = [(1, "http://a", big), (2, "http://b", big), (9, "http://c", big), (3, None, None), (4, "u", ""), (5, "u", "x"), (6, "u", "x"),
            (7, "http://d e", other), (8, "v", other), (None, "w", other), (10, "z", "WARC/1.1\r\n\r\n" * 100), (8, "v", other), (None, "q", "<i>" * 999)]
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("extra")).repartition(3)


def test_warc_round_trip(spark):
    frame = pages(spark)
    rows = [(r.page_id, (r.html or "").encode()) for r in frame.collect()]
    expected = Counter()
    for page, data in rows:
        top = max((p for p, d in rows if d == data and p is not None), default=None)
        revisit = len(data) >= 1000 and top is not None and top != page
        expected[page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", top if revisit else None] += 1
    back = warc.round_trip(frame).collect()
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in back) == expected
    assert Counter(bytes(r.payload) for r in back if r.record_type == "response") == Counter(
        d for (p, d), k in zip(rows, [0] * len(rows)) if not (len(d) >= 1000 and (m := max((q for q, e in rows if e == d and q is not None), default=None)) is not None and m != p)
    )
    assert warc.round_trip(frame.limit(0)).count() == 0


def test_normalised_members_stand_alone(spark):
    folder, target = new_folder(spark, "test"), new_folder(spark, "test")
    archives = warc.write_monolithic(warc.plan_records(pages(spark)), folder)
    listed = archives.collect()
    index = warc.normalise(spark.createDataFrame(listed), target).collect()
    assert len(index) == 13 == sum(r.records for r in listed)
    for row in index:
        store, place = warc._store(row.archive)
        with store.open_input_file(place) as data:
            data.seek(row.offset)
            member = gzip.decompress(data.read(row.length))
        assert member.startswith(b"WARC/1.1") and row.record_id.encode() in member
    for row in listed:
        store, place = warc._store(row.path)
        with store.open_input_file(place) as data:
            engine = zlib.decompressobj(31)
            engine.decompress(data.read())
            assert engine.eof and not engine.unused_data  # one member


def test_broken_archive_is_an_error(spark):
    folder = new_folder(spark, "test")
    store, place = warc._store(folder)
    store.create_dir(place)
    with store.open_output_stream(f"{place}/x.warc.gz", compression=None) as out:
        out.write(gzip.compress(b"WARC/1.1\r\nContent-Length: 99\r\n\r\nshort"))
    with pytest.raises(Exception, match="ends early"):
        warc.normalise(spark.createDataFrame([(f"{folder}/x.warc.gz",)], "path string"), folder).collect()


def test_scores_beyond_64_bits_are_refused():
    large = np.full((1, 3), 1 << 32)
    with pytest.raises(ValueError):
        topk._products(large, large)
    with pytest.raises(ValueError):
        topk._products(np.full((1, 1), np.iinfo(np.int64).min), large[:, :1])
    assert topk._products(large, large // 64).tolist() == [[3 * (1 << 58)]]


# licences


def test_known_forms_of_licences(spark):
    mit = licences._MIT
    texts = [
        (1, "SPDX-License-Identifier: Apache-2.0", None, "Apache-2.0"), (2, "# SPDX-License-Identifier: GPL-2.0-or-later\ncode", None, "GPL-2.0"),
        (3, "MIT License\n\nCopyright The Foo Authors\n\n" + mit, "MIT", None), (4, "Copyright (c) 2020 Foo, Bar. " + mit, "MIT", None),
        (5, "The MIT License (MIT) Copyright 2020 Foo " + mit, "MIT", None), (6, "Copyright Foo, Inc.\n" + licences._ZLIB, "Zlib", None),
        (7, 'x\n * Licensed under the Apache License, Version 2.0 (the "License");\n * you may not use', None, "Apache-2.0"),
        (8, "This project is licensed under the GNU Affero General Public License, version 3.", None, "AGPL-3.0"),
        (9, licences._BOOST.upper(), "BSL-1.0", None), (10, licences._UNLICENSE + "https://unlicense.org", "Unlicense", None),
        (11, "the copyright notice of the foo project\n" + mit, None, None), (12, "word " * 250_000, None, None),
    ]
    docs = spark.createDataFrame([(i, t) for i, t, _, _ in texts], "doc_id long, text string")
    got = {r.doc_id: (r.license, r.notices) for r in licences.scan(docs).collect()}
    assert got == {i: (whole, notice) for i, _, whole, notice in texts}
    # lines of the texts themselves that begin with the word stay
    wrapped = mit.replace("copyright notice", "\ncopyright notice").replace("COPYRIGHT HOLDERS", "\nCOPYRIGHT HOLDERS")
    assert licences.scan(spark.createDataFrame([(1, wrapped)], "doc_id long, text string")).first().license == "MIT"


def test_whole_texts_as_systems_ship_them(spark):
    folder = Path("/usr/share/common-licenses")
    shipped = {"Apache-2.0": "Apache-2.0", "GPL-3": "GPL-3.0", "GPL-2": "GPL-2.0", "LGPL-2.1": "LGPL-2.1", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0"}
    if not all((folder / f).exists() for f in shipped):
        pytest.skip("no licence texts here")
    texts = [((folder / f).read_text(encoding="utf-8"), name) for f, name in shipped.items()]
    rows = [(i, "\n".join(f"  {line}" for line in t.replace("license", "licence").splitlines())) for i, (t, _) in enumerate(texts)]
    found = {r.doc_id: r.license for r in licences.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {i: name for i, (_, name) in enumerate(texts)}


def test_licence_scan(spark, rough, nothing):
    mit = "The MIT License (MIT)\n\nCopyright (c) 2019 A. Body\n\n" + licences._MIT.replace(". ", ".\n\n").replace("sublicense", "sublicence")
    docs = spark.createDataFrame(
        [(1, mit), (2, licences._MIT.upper()), (3, licences._MIT + " and more"), (4, "x\n * Released under the MIT Licence.\nLicensed under CC BY 4.0"), (5, None), (6, ""),
         (7, "© 2001 Foo\n" + licences._ZLIB), (1, mit)],
        "doc_id long, text string",
    )
    got = Counter((r.doc_id, r.license, r.notices, r.digest is None) for r in licences.scan(docs).collect())
    assert got == Counter({(1, "MIT", None, False): 2, (2, "MIT", None, False): 1, (3, None, None, False): 1, (4, None, "CC-BY-4.0,MIT", False): 1,
                           (5, None, None, True): 1, (6, None, None, False): 1, (7, "Zlib", None, False): 1})
    rows = licences.scan(rough).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in rough.collect())
    assert {r.doc_id: r.notices for r in rows}[17] == "MIT"
    assert licences.scan(nothing).count() == 0


# top-k


def brute_top(rows, k, scale=64):
    usable = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            usable.append((i, [int(np.floor(scale * float(x))) for x in v]))
    out = Counter()
    for q, v in {(i, tuple(v)) for i, v in usable if i % 20 == 0}:
        scored = sorted(((-sum(a * b for a, b in zip(v, w)), i) for i, w in usable if i != q))[:k]
        for rank, (score, i) in enumerate(scored, 1):
            out[q, rank, i, -score] += 1
    return out


@pytest.mark.parametrize("block,blocks,queries", [(128, 64, 512), (4, 2, 3)])
def test_top_products(spark, monkeypatch, block, blocks, queries):
    for name, value in (("BLOCK", block), ("GROUP_BLOCKS", blocks), ("GROUP_QUERIES", queries)):
        monkeypatch.setattr(topk, name, value)
    pick = random.Random(7)
    rows = [(i, [pick.choice([pick.uniform(-1, 1), 0.5, 0.0]) for _ in range(5)]) for i in range(0, 400, 3)]
    rows += [(1000, None), (1020, [None, 1.0]), (1040, [float("nan"), 0.0]), (1060, [float("inf"), 0.0]), (None, [1.0] * 5), (1080, [0.5, 0.25]), (1001, [0.5] * 5), (1002, [0.5] * 5)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("d", F.lit("x")).repartition(4)
    stored = [(r.vec_id, r.embedding) for r in frame.collect()]
    got = Counter(tuple(r) for r in topk.top_products(frame, F.col("id") % 20 == 0, 7).collect())
    assert got == brute_top(stored, 7)
    assert topk.top_products(frame.limit(0), F.col("id") % 20 == 0, 7).count() == 0


def test_blocks_are_pruned_and_big_numbers_exact():
    pick = np.random.default_rng(8)
    centres = pick.normal(size=(40, 16))
    vectors = np.floor(64 * (np.repeat(centres, 128, axis=0) + 0.05 * pick.normal(size=(5120, 16)))).astype(np.int64)
    index = topk.BlockIndex(np.arange(5120), vectors)
    floor = np.full(40, topk._NONE)
    query, ids, score, visited = index.search(np.arange(0, 5120, 128), vectors[::128], 5, floor)
    assert visited < 40 * 40 / 4
    full = vectors[::128] @ vectors.T
    full[np.arange(40), np.arange(0, 5120, 128)] = np.iinfo(np.int64).min
    assert sorted(score.tolist()) == sorted(np.sort(full, axis=1)[:, -5:].ravel().tolist())
    big = np.array([[1 << 40, 3]])
    assert topk._products(big, np.array([[1 << 20, 1]]))[0, 0] == (1 << 60) + 3


# shards


def brute_capacity(sizes, shards):
    best = None
    for c in range(max(sizes), sum(sizes) + 1):
        used, room = 1, c
        for s in sizes:
            if s > room:
                used, room = used + 1, c
            room -= s
        if used <= shards:
            best = c
            break
    return best


@pytest.mark.parametrize("bucket", [20_000, 7])
def test_shards(spark, rough, nothing, monkeypatch, bucket):
    monkeypatch.setattr(sharding, "_BUCKET", bucket)
    monkeypatch.setattr(sharding, "_TRIES", 5)
    pick = random.Random(9)
    rows = [(i, pick.choice(["x" * pick.randrange(60), "copy", "é" * 9])) for i in range(120)] + [(200, None), (None, "no id"), (3, "again"), (3, "again")]
    for frame in (spark.createDataFrame(rows, "doc_id long, text string").repartition(4), rough):
        texts = [(r.doc_id, r.text) for r in frame.collect()]
        got = sharding.sharded(frame).collect()
        size = lambda t: len((t or "").encode()) + 1
        assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((i, size(t), zlib.crc32((t or "").encode())) for i, t in texts)
        groups = {}
        for i, t in texts:
            key = "null" if t is None else hashlib.sha256(t.encode()).hexdigest()
            first, total = groups.get(key, (None, 0))
            groups[key] = (i if first is None else first if i is None else min(first, i), total + size(t))
        ordered = [n for _, n in sorted(((f is not None, f or 0, k), n) for k, (f, n) in groups.items())]
        loads = Counter()
        for r in got:
            loads[r.shard] += r.size
        assert max(loads.values()) == brute_capacity(ordered, 8)
        for shard in loads:
            assert sorted(r.slot for r in got if r.shard == shard) == list(range(sum(r.shard == shard for r in got)))
        of_text = {}
        for r in got:
            of_text.setdefault((r.size, r.text_crc32), set()).add(r.shard)
        assert all(len(s) == 1 for k, s in of_text.items() if k[0] > 1)
        assert set(loads) <= set(range(8))
    assert sharding.sharded(nothing).count() == 0
