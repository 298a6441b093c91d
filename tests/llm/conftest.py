import pytest
from pyspark.sql import Row


@pytest.fixture(scope="session")
def rough(spark):
    """Documents with nulls, empty and odd texts, copies, repeated rows, clashing extra columns."""
    shared = " ".join(f"passage{i}" for i in range(30))
    loop = " ".join(["a b c"] * 20)
    texts = [
        (0, "The quick brown fox of the old hills ran by the river and slept in the shade. " * 3, "en"),
        (1, None, "en"), (2, "", None), (3, "   \t\n ", "de"), (4, shared, "en"), (5, f"intro words {shared} outro words", "en"),
        (6, loop, "fr"), (7, loop, "fr"), (8, "Le chat de la maison est sur le mur et les chiens dans le jardin. " * 4, "fr"),
        (9, "ÀÉ ß 日本語 😀 \x1c x y z", "fr"), (10, "12345 !!! ???", None), (11, "one two three", "en"),
        (12, "One TWO three", "en"), (13, shared.upper(), "en"), (14, "z" * 5000, "en"), (15, "k " * 3000, "en"),
        (16, "Copyright (c) 2020 Somebody\n\nPermission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n", "en"),
        (17, "Some text here.\nReleased under the MIT Licence!\nMore text.", "en"),
    ]
    rows = [Row(doc_id=i, text=t, lang=lang, source="s", n_chars=len(t or ""), id=7, key=1, h=2, size="x", label=None) for i, t, lang in texts]
    rows += [rows[4], rows[0], Row(**{**rows[5].asDict(), "doc_id": None}), Row(**{**rows[11].asDict(), "doc_id": 4})]
    schema = "doc_id long, text string, lang string, source string, n_chars long, id int, key int, h int, size string, label string"
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def nothing(rough):
    return rough.limit(0)
