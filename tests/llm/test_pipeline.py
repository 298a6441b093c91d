import random

import corpus_pipeline
from pyspark.sql import functions as F

from daybook.llm import language

from .test_text_operators import brute_components, brute_fingerprint, brute_kept, check_packing, words_of

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus(spark):
    """Clean documents, near copies of them, documents in no language, and a shared passage."""
    pick = random.Random(11)
    syllables = "the ing er on and re at en ti or es is ou st ha".split()
    word = lambda: "".join(pick.choice(syllables) for _ in range(pick.randrange(1, 4)))
    clean = [[word() for _ in range(pick.randrange(60, 300))] for _ in range(40)]
    near = []
    for words in clean[:15]:
        copy = list(words)
        for _ in range(max(1, len(words) // 100)):
            copy[pick.randrange(len(copy))] = word()
        near.append(copy)
    passage = [word() for _ in range(60)]
    rows = [(i, " ".join(w), "en", "s", 0) for i, w in enumerate(clean)]
    rows += [(100 + i, " ".join(w), "en", "s", 0) for i, w in enumerate(near)]
    rows += [(200 + i, " ".join([word() for _ in range(80)] + passage + [word() for _ in range(50)]), "en", "s", 0) for i in range(3)]
    rows += [(300, None, "en", "s", 0), (301, "", None, "s", 0), (302, "123 456 !!", None, "s", 0), (0, rows[0][1], "en", "s", 0)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def brute_groups(rows):
    prints = {i: brute_fingerprint(t, 4) for i, t in rows}
    return brute_components(list(prints), [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 4])


def test_stages_against_brute_force(spark, tmp_path):
    docs = corpus(spark)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == len(set(names)) == 4
    kept = []
    for name, stage in corpus_pipeline.STAGES[:3]:
        after = stage(spark, docs, str(tmp_path))
        assert after.columns == docs.columns
        after.write.parquet(str(tmp_path / name))
        kept.append((docs.collect(), spark.read.parquet(str(tmp_path / name)).collect()))
        docs = spark.read.parquet(str(tmp_path / name))

    before, after = kept[0]
    assert {r.doc_id for r in before} - {r.doc_id for r in after} == {300, 301, 302}

    before, after = kept[1]
    roots = brute_groups({r.doc_id: r.text for r in before}.items())
    assert sorted({r.doc_id for r in after}) == sorted({i for i, root in roots.items() if i == root})
    assert {i for i in range(40)} <= {r.doc_id for r in after}  # clean documents stay
    assert any(i != root for i, root in roots.items())

    before, after = kept[2]
    gone = brute_kept([(r.doc_id, 0, words_of(r.text)) for r in {r.doc_id: r for r in before}.values()], 20)
    texts = {r.doc_id: r.text for r in after}
    for r in before:
        left = [w for n, w in enumerate(words_of(r.text)) if n not in gone[r.doc_id, 0]]
        if left:
            assert texts[r.doc_id].encode().split() == left
        else:
            assert r.doc_id not in texts
    assert any(gone.values())

    final = corpus_pipeline.run(spark, str(tmp_path))
    check_packing(final.collect(), [(r.doc_id, r.text) for r in after])


def test_stages_of_an_empty_table(spark, nothing):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, "").count() == 0


def test_extra_columns_and_odd_rows(spark, rough):
    rough = rough.withColumns({"n_words": F.lit(3), "n_removed": F.lit("x")})
    docs = rough
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, "")
        assert docs.columns == rough.columns
    left = {r.doc_id for r in docs.select("doc_id").collect()}
    assert 0 in left and not {1, 2, 3, 10} & left



def test_texts_in_no_language_go_and_short_ones_stay(spark):
    english = "the house of the man is on the hill and the road to it is long "
    rows = [(i, english * (i + 4), "en", "s", 0) for i in range(20)]
    rows += [(50, "Avec.", None, "s", 0), (51, "qzx wvk jjq xxz kqv " * 30, None, "s", 0)]
    left = corpus_pipeline.keep_known_languages(spark, spark.createDataFrame(rows, SCHEMA), "")
    assert {r.doc_id for r in left.collect()} == {*range(20), 50}


def test_tables_without_labels_keep_texts_with_a_letter(spark):
    rows = [(1, "the house on the hill " * 30, None, "s", 0), (2, "Дом на горе", None, "s", 0), (3, "123 !!", None, "s", 0), (4, None, None, "s", 0), (5, "", None, "s", 0)]
    left = corpus_pipeline.keep_known_languages(spark, spark.createDataFrame(rows, SCHEMA), "")
    assert {r.doc_id for r in left.collect()} == {1, 2}
    rows.append((6, "456", "en", "s", 0))  # a label, but no letter to learn from
    left = corpus_pipeline.keep_known_languages(spark, spark.createDataFrame(rows, SCHEMA), "")
    assert {r.doc_id for r in left.collect()} == {1, 2}


def test_languages_whose_rows_share_an_id_are_learned(spark):
    texts = {"en": "the house of the man", "fr": "le chat de la maison", "de": "das Haus auf dem Berg", "es": "la casa de los montes"}
    rows = [(None, f"{text} {i}", lang, "s", 0) for lang, text in texts.items() for i in range(400)]
    rows += [(None, "il gatto della casa", "it", "s", 0)] * 400
    docs = spark.createDataFrame(rows, SCHEMA)
    assert language.learn(docs, 64, rows_per_language=40).names == [*sorted(texts), "it"]
