from capplan.llm import decontaminate
from capplan.llm.common import OWN

ITEM = "q1 q2 q3 q4 q5 q6 q7 q8 q9 q10 q11 q12 q13 q14"


def found(documents, benchmark, **options):
    rows = decontaminate.find_benchmark_words(documents, benchmark, **options).collect()
    return sorted(
        (
            (r.doc_id, r[f"{OWN}n_words"], r[f"{OWN}n_hit"], r[f"{OWN}items"], [tuple(s) for s in r[f"{OWN}spans"]])
            for r in rows
        ),
        key=str,
    )


def tables(spark):
    items = [(3, ITEM), (1, "Short, item!"), (3, ITEM), (None, "x y"), (2, None), (4, "...")]
    texts = [
        (1, f"É before, {ITEM.upper()}; after"),
        (2, "a SHORT item"),
        (3, "q1 q2 q3 q4 q5 q6 q7 q8 q9 q10 q11 q12 missing"),
        (4, None),
        (5, "short item short-item"),
    ]
    return spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")


EXPECTED = [
    (1, 17, 14, [3], [(10, 10 + len(ITEM))]),
    (2, 3, 2, [1], [(2, 12)]),
    (3, 13, 0, [], []),
    (4, 0, 0, [], []),
    (5, 4, 4, [1], [(0, 21)]),
]


def test_words_items_and_original_places(spark):
    assert found(*tables(spark)) == EXPECTED


def test_several_automata_find_the_same(spark):
    assert found(*tables(spark), max_chars=10) == EXPECTED


def test_contaminated_documents_go(spark):
    documents, benchmark = tables(spark)
    kept = decontaminate.decontaminate(documents, benchmark)
    assert kept.columns == documents.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4]


def test_odd_input(spark, odd, none):
    items = spark.createDataFrame([(1, "two words")], "item_id long, text string")
    kept = decontaminate.decontaminate(odd, items)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 1
    assert decontaminate.decontaminate(none, items).count() == 0
    assert decontaminate.decontaminate(odd, items.limit(0)).count() == odd.count()
