import pytest

from rhapsode.llm.decontam import contained_items, hits_needed, without_leaks
from rhapsode.llm.queries import SQL

from .helpers import documents, odd_documents, same, sql, SF


def test_equals_exact_containment(spark):
    docs, items = documents(spark), spark.read.parquet(f"{SF}/benchmark.parquet")
    want = sql(SQL["op9_decontamination"], documents=docs.toPandas(), benchmark=items.toPandas())
    same(contained_items(docs, items).toPandas(), want)
    kept = {r["doc_id"] for r in without_leaks(docs, items).collect()}
    assert kept == {r["doc_id"] for r in docs.collect()} - set(want["doc_id"])


def test_partial_copies_on_both_sides_of_the_limit(spark):
    words = [f"w{i}" for i in range(104)]
    items = spark.createDataFrame([(1, " ".join(words)), (2, "w1 w2 w3"), (3, None), (None, " ".join(words[:50]))], "item_id long, text string")
    long = " ".join(f"x{i}" for i in range(20000))
    docs = [(i, f"{long} {' '.join(words[:k]).upper()} {long}") for i, k in enumerate((83, 84, 85, 104))]
    got = contained_items(spark.createDataFrame(docs, "doc_id long, text string"), items).collect()
    assert sorted((r["doc_id"], r["n_found"]) for r in got if r["item_id"] == 1) == [(1, 80), (2, 81), (3, 100)]
    assert sorted(r["doc_id"] for r in got if r["item_id"] is None) == [0, 1, 2, 3]
    assert sorted((r["doc_id"], r["n_shingles"]) for r in got if r["item_id"] == 2) == [(0, 1), (1, 1), (2, 1), (3, 1)]


def test_items_and_documents_of_few_words(spark):
    items = spark.createDataFrame([(1, "one"), (2, "Two  words"), (3, "a b c d"), (4, "a b c d e"), (5, "x y")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "ONE"), (2, "two words"), (3, "two\nwords one"), (4, "z a b c d e"), (5, "d c b a"), (6, "words two"), (7, "x"), (8, None)], "doc_id long, text string")
    got = contained_items(docs, items)
    assert sorted((r["doc_id"], r["item_id"]) for r in got.collect()) == [(1, 1), (2, 2), (3, 1), (3, 2), (4, 3), (4, 4)]
    same(got.toPandas(), sql(SQL["op9_decontamination"], documents=docs.toPandas(), benchmark=items.toPandas()))


def test_classes_of_all_sizes_find_what_exact_containment_finds(spark):
    import random

    r = random.Random(5)
    items = [(n, " ".join(f"i{n}x{k}" for k in range(n))) for n in (5, 19, 20, 21, 67, 68, 69, 259, 261, 900)]
    docs = []
    for n, t in items:
        w = t.split()
        for m in range(6):  # leading parts, on both sides of the limit
            cut = max(1, int(n * (0.7 + 0.05 * m)))
            docs.append((len(docs), " ".join([*(f"f{r.randrange(10**6)}" for _ in range(50)), *w[:cut], *(f"f{r.randrange(10**6)}" for _ in range(50))])))
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    same(contained_items(d, b).toPandas(), sql(SQL["op9_decontamination"], documents=d.toPandas(), benchmark=b.toPandas()))


def test_odd_rows(spark):
    docs = odd_documents(spark)
    items = spark.createDataFrame([(1, "A B C D E F"), (1, "A B C D E F")], "item_id long, text string")
    got = contained_items(docs, items).collect()
    assert sorted(r["doc_id"] for r in got) == [4, 5]
    left = without_leaks(docs, items)
    assert left.columns == docs.columns and left.count() == docs.count() - 4
    assert contained_items(docs.limit(0), items).count() == 0 and contained_items(docs, items.limit(0)).count() == 0


@pytest.mark.parametrize("n", [8, 32, 64])
def test_hits_needed_bounds_the_miss(n):
    from math import comb

    k = hits_needed(n, 0.8)
    assert sum(comb(n, i) * 0.8**i * 0.2 ** (n - i) for i in range(k)) <= 1e-6 or k == 1
